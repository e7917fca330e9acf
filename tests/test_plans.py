"""Plan shapes that must hold at scale (broadcast disabled, as for large tables)."""

import re

import pytest

from shelfwise.plans.catalog import QUERIES

BASE = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def exchanges(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (SinglePartition|hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\))", plan), plan


def test_summary_shuffles_documents_once_and_brand_rows_only(no_broadcast):
    ex, plan = exchanges(QUERIES["run_summary"](no_broadcast, BASE))
    doc = [e for e in ex if e.startswith("hashpartitioning(doc_id")]
    assert len(doc) == 3                                   # documents, labels, events: once each
    assert any(e.startswith("hashpartitioning(brand") for e in ex)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_stock_fold_shuffles_on_key_and_segment(no_broadcast):
    ex, plan = exchanges(QUERIES["stock_from_observations"](no_broadcast, BASE))
    assert any("seg" in e for e in ex)
    assert "PythonMapInArrow" not in plan and "MapInPandas" not in plan


def test_prefix_join_is_an_equi_join(no_broadcast):
    ex, plan = exchanges(QUERIES["brand_prefix_join"](no_broadcast, BASE))
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_no_single_partition_below_row_level_queries(no_broadcast):
    for q in ["cards_explode", "price_parse", "text_one_line", "history_union", "report_time_formats",
              "page_attr_on_cards", "quantity_strip", "cards_by_class"]:
        ex, _ = exchanges(QUERIES[q](no_broadcast, BASE))
        assert ex == [], q                                  # row-level work: no shuffle at all


def test_daily_top_and_spans_are_partial_aggregates(no_broadcast):
    for q in ["slowest_brand_daily", "brand_span", "time_bounds", "stock_counts"]:
        _, plan = exchanges(QUERIES[q](no_broadcast, BASE))
        assert "Window" not in plan and "partial_" in plan, q


def test_selective_report_prunes_documents_before_shuffle(no_broadcast):
    spark = no_broadcast
    keys = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
            "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100MB"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)           # the sizes tables have at scale
    try:
        plan = QUERIES["replenish_list"](spark, BASE)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    pruned = [line for line in plan.splitlines() if "might_contain" in line]
    assert any("doc_id" in line for line in pruned) and any("event_id" in line for line in pruned)


def test_every_registered_query_reads_the_tables(spark):
    for name, q in QUERIES.items():
        plan = q(spark, BASE)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "/root/testdata/" in plan, name
