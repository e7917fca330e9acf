"""Write PLANS.md: the physical plan tree of every registered query.

Two settings per query: as planned on the test tables (broadcasts allowed by
the planner's size check) and with broadcast joins disabled, which is the
shape the plan takes once tables are large.

Usage: python tools/explain_all.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.plans.catalog import QUERIES  # noqa: E402
from shelfwise.session import local_session  # noqa: E402

KEYS = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]

LISTING = ("Listing view: documents, labels and events joined on the document id; at scale each is "
           "shuffled once by doc_id and both joins share that partitioning (the planner broadcasts "
           "the small sides of the test tables after its size check). ")
ROW_LEVEL = "Row-level: scan, project, no exchange; the work grows linearly with the table and splits with it."
CONTAINS = ("Two passes over the names, in their scan tasks: the first counts the brands' pieces of four characters, the second "
            "proposes (hash of name, brand) for each brand's rarest piece; lengths are a scalar subquery on the brands. The semi join "
            "verifies with contains. A list's pieces are broadcast (bounded by the list); names are shuffled at most once, by hash.")
NOTES = {
    "run_summary": LISTING + "Narrow form: text presence and length are computed in the documents scan "
                   "task, so no text crosses a shuffle. Partial aggregate per brand, one row per brand and "
                   "task shuffled, a single global aggregate over those rows with the slowest brand as "
                   "min_by: no second scan, no cross join. A hot brand costs nothing extra.",
    "stock_counts": LISTING + "Partial aggregates only.",
    "undescribed_count": LISTING + "Partial aggregates only.",
    "brands_missing": "A distinct count over a documents column only: Catalyst removes the view's outer joins, "
                      "so this is one scan of documents.source and a two-level aggregate (partial dedupe per "
                      "task).",
    "brand_rollup": LISTING + "Partial aggregate per brand.",
    "summary_headings": "As run_summary, renamed.",
    "run_summary_sql": "As run_summary, written in Spark SQL over a DataFrame argument.",
    "slowest_brand": LISTING + "Partial aggregate per brand, then a top-1 (TakeOrderedAndProject).",
    "slowest_brand_daily": "Two mergeable aggregates (per day and brand, then min_by per day); no window, "
                           "so a day with millions of brands is never held by one task.",
    "time_bounds": "Global min/max with partial aggregation.",
    "brand_span": "Partial aggregate per key.",
    "elapsed_minutes": "Partial aggregate per key.",
    "stock_from_observations": "One full shuffle on (key, step bucket): a bucket holds at most 65,536 steps, "
                               "so a hot key spreads over many tasks. Window + aggregate on that partitioning "
                               "fold each bucket into a fixed-size summary; summaries of 1,024 contiguous "
                               "buckets merge exactly, then once per key (small shuffles). JVM only.",
    "brand_prefix_join": "Candidate prefixes of the brand lengths (scalar subqueries) equi-joined to the "
                         "lower-cased brands: a hash join (broadcast when the brand table is small, sort-merge "
                         "otherwise; AQE splits a hot brand), never a nested loop.",
    "portfolio_semi_join": CONTAINS,
    "portfolio_of_parts": CONTAINS + " Here the brands are a table, so the planner chooses the joins by its size.",
    "card_shapes_any_tag": "Parser in mapInPandas, selected by class alone. No exchange.",
    "description_by_path": "Element paths in mapInPandas, one page at a time, the layout number computed in the JVM. No exchange.",
    "cards_table_function": "The parser as a table function called from SQL, on the scan's own partitions. No exchange.",
    "price_parse_sql": "SQL functions, inlined: the plan of price_parse, without Python.",
    "global_position": "The keys were sorted by range partitions and written (not shown: that job runs when the query is built); one "
                       "offset per partition is broadcast, and the texts meet their number by an equi-join.",
    "capture_time_asof": "One shuffle of both sides on (key, time bucket) for the window; bucket summaries, far fewer, carry the rest.",
    "range_summary": LISTING + "Partial aggregates per day and brand are the state a run stores; the range merges them per brand, then once.",
    "brands_seen_bitmap": LISTING + "Bitmaps per day and bucket by partial aggregate, then a bitwise or.",
    "spread_chunks": "One shuffle straight to the partition of the chunk's number.",
    "cards_by_class": "Parser in mapInPandas, one page at a time, Arrow batches capped in bytes; pages without "
                      "the class token are filtered out JVM-side first. No exchange.",
    "cards_by_tag": "Parser in mapInPandas (cards and fields selected by tag), one page at a time; pages "
                    "without the tag are filtered out JVM-side first. No exchange.",
    "page_position": "Window per page: a partition holds one page's cards (bounded by the page).",
    "attach_by_position": "Equi-join on (page_id, pos_in_pg), unique keys on both sides.",
    "replenish_list": LISTING + "The stock filter turns the labels join inner and is pushed to the labels "
                      "scan; at table sizes past the runtime-filter thresholds Spark builds a bloom filter "
                      "from those labels and prunes the documents and events scans before their shuffles "
                      "(tests/test_plans.py).",
    "description_gaps": LISTING,
    "desc_default": LISTING,
    "stock_known": LISTING + "The stock filter is pushed to the labels scan.",
    "row_count": LISTING,
    "preview_top5": LISTING + "Top-5 by doc_id: per-task top-k then a merge (TakeOrderedAndProject).",
    "brand_url": "Distinct brands: partial dedupe per task, small shuffle.",
    "row_label": "Left join documents to labels on doc_id.",
    "null_to_empty": "Left join documents to labels on doc_id.",
}


def tree(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    head = text.split("\n\n\n")[0]
    head = re.sub(r"#\d+L?", "", head)
    return "\n".join(line for line in head.splitlines() if "Initial Plan" not in line)


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print(f"# Physical plans of the registered queries ({os.path.basename(base)})\n")
    print("Generated by `tools/explain_all.py`. Physical plans as planned (AQE may still "
          "coalesce partitions or switch joins at run time); 'at scale' = broadcast joins disabled.\n")
    for name, q in QUERIES.items():
        print(f"## {name}\n\n{NOTES.get(name, ROW_LEVEL)}\n\n```")
        print(tree(q(spark, base)))
        for k in KEYS:
            spark.conf.set(k, "-1")
        scaled = tree(q(spark, base))
        for k in KEYS:
            spark.conf.unset(k)
        print("```\n\nat scale:\n\n```")
        print(scaled)
        print("```\n")


if __name__ == "__main__":
    main()
