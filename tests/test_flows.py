import datetime as dt
import glob
import os


from shelfwise.plans import catalogue, daily
from shelfwise.schemas import DESCRIPTIONS, HISTORY_TEXT, LANDED_PAGES, STOCK_OBSERVATIONS
from shelfwise.sources import history as H
from shelfwise.sources import landed
from shelfwise.sources import sinks
from shelfwise.streaming import ingest


def card(name, sub, price, disc=None):
    d = f'<div class="discountedPrice">{disc}</div>' if disc else ""
    return (f'<div class="imageWrapper"><div class="name">{name}</div><div class="subText">{sub}</div>'
            f'<div class="price">{price}</div>{d}</div>')


T0 = dt.datetime(2024, 3, 1, 9, 0, 0)
PAGES = [
    (1, "u1", "Nor", None, T0, "<section>" + card("Nor Power 1kg", "1 kg", "৳ 120", "৳ 100")
     + card("Wave Nor", "1 kg", "৳ 99") + card("nor bar", "130 g", "৳ 1,200") + "</section>"),
    (2, "u2", "Vela", None, T0, "<section>" + card("Vela soap", "100 g", "৳ 45")
     + card("Vela gel", "50 g", "৳ 30") + "</section>"),   # no observation at all: failed, page time
    (3, "u3", None, "Dhaka", T0, "<div class='product'><div class='name'>Vela soap</div></div>"),
]
OBS = [
    (1, 1, 1, "1 in bag", False, True, False, T0 + dt.timedelta(seconds=5)),
    (1, 1, 2, "12 in bag", True, True, False, T0 + dt.timedelta(seconds=15)),
    (1, 2, 1, "3 in bag", True, True, False, T0 + dt.timedelta(seconds=20)),
    (1, 3, 1, "add", False, False, False, T0 + dt.timedelta(seconds=25)),
    (2, 1, 1, "x", False, True, True, T0 + dt.timedelta(seconds=90)),
]
DESC = [(1, 1, "Good\nsoap"), (1, 3, ""), (1, 2, "other")]


def test_daily_run_end_to_end(spark, scratch):
    pages = spark.createDataFrame(PAGES, LANDED_PAGES)
    for _ in range(2):                                     # a rerun replaces the day, no double count
        summary = daily.daily_run(spark, pages, spark.createDataFrame(DESC, DESCRIPTIONS),
                                  spark.createDataFrame(OBS, STOCK_OBSERVATIONS), ["Nor", "Vela", "Opal"],
                                  scratch, dt.date(2024, 3, 1)).collect()
    s = summary[0].asDict()
    assert (s["skus"], s["skus_out_of_stock"], s["skus_failed_stock"], s["brands_failed_stock"],
            s["skus_not_described"]) == (4, 1, 2, 1, 1)
    assert str(s["stocking_start_time"]) == "2024-03-01 09:00:00"
    assert s["time_to_scrape_stocks"] == "00:01:30"
    assert s["longest_stock_to_scrape"] == "Vela" and s["longest_time_to_scrape_stock"] == "00:01:30"
    rows = {r.sku: r for r in sinks.read_listings(spark, os.path.join(scratch, "listings")).collect()}
    assert set(rows) == {"Nor Power 1kg", "nor bar", "Vela soap", "Vela gel"}
    assert rows["Vela gel"].stock is None and str(rows["Vela gel"].report_time) == "2024-03-01 09:00:00"
    assert rows["Nor Power 1kg"].stock == 12 and rows["Nor Power 1kg"].price == 120.0
    assert rows["Nor Power 1kg"].price_if_discounted == 100.0 and rows["Nor Power 1kg"].description == "Good soap"
    assert rows["nor bar"].stock == 0 and rows["nor bar"].price == 1200.0 and rows["nor bar"].pos_in_pg == 3
    assert rows["Vela soap"].stock is None and rows["Vela soap"].description is None
    assert str(rows["Vela soap"].report_date) == "2024-03-01"
    csv = glob.glob(os.path.join(scratch, "exports", "stocks_data_2024-03-01.csv", "part-*.csv"))
    text = "".join(open(p).read() for p in csv)
    assert text.startswith("sku,brand,quantity,price,price_if_discounted,pos_in_pg,stock,description,report_time")
    assert "Nor Power 1kg,Nor,1 kg,120.0,100.0,1,12,Good soap,2024-03-01 09:00:15" in text


def test_csv_quoting(spark, scratch):
    df = spark.createDataFrame([("a,b", 'say "hi"', "l1\nl2", "", None)], "a string, b string, c string, d string, e string")
    path = sinks.write_dated_csv(df, scratch, "x_", "2024-01-02")
    parts = [open(p).read() for p in glob.glob(os.path.join(path, "part-*.csv"))]
    data = [t for t in parts if t != "a,b,c,d,e\n"]          # parts of empty partitions hold the header only
    assert data == ['a,b,c,d,e\n"a,b","say ""hi""","l1\nl2",,\n']
    back = sinks.read_csv_text(spark, path, ["a", "b", "c", "d", "e"]).collect()[0]
    assert tuple(back) == ("a,b", 'say "hi"', "l1\nl2", None, None)   # '' and NULL are one thing in CSV


def test_catalogue_history(spark, scratch):
    page = ("<div class='product x'><div class='name'>Vela Soft</div><div class='subText'>100 g</div></div>"
            "<div class='product'><div class='name'>Other thing</div><div class='subText'>1 kg</div></div>"
            "<div class='product'><div class='name'>Nor bar</div></div>")
    pages = spark.createDataFrame([(7, "u", None, "Dhaka\nNorth", dt.datetime(2024, 3, 2, 13, 5), page)], LANDED_PAGES)
    obs = spark.createDataFrame([(7, 1, 1, "4 in bag", True, True, False, None),
                                 (7, 2, 1, "9 in bag", True, True, False, None)], STOCK_OBSERVATIONS)
    new = catalogue.catalogue_rows(pages, obs, ["Vela", "Nor"])
    rows = [tuple(r) for r in new.collect()]
    # 'Nor bar' has no stock reading: dropped; 'Other thing' is outside the portfolio
    assert rows == [("Vela Soft 100g", "4", "Dhaka North", "02-Mar-24, 01:05 PM", dt.date(2024, 3, 2))]
    old = spark.createDataFrame([("Old 1kg", "n/a", "Dhaka", "01-Mar-24, 09:00 AM")], HISTORY_TEXT)
    both = catalogue.with_history(new, old).collect()
    assert [r.sku for r in both] == ["Vela Soft 100g", "Old 1kg"]
    typed = H.typed_history(catalogue.with_history(new, old)).collect()
    assert [r.stock_n for r in typed] == [4, None] and str(typed[0].report_ts) == "2024-03-02 13:05:00"
    path = os.path.join(scratch, "history")
    catalogue.append_catalogue(new, path)
    catalogue.append_catalogue(new, path)
    back = H.read_history(spark, path)
    assert back.count() == 2 and back.select("report_date").distinct().count() == 1   # appends keep duplicates


def test_stream_ingest_equals_batch(spark, scratch):
    pages = spark.createDataFrame(PAGES, LANDED_PAGES)
    landed = os.path.join(scratch, "landed")
    pages.limit(2).write.parquet(landed)
    pages.filter("page_id = 3").write.mode("append").parquet(landed)
    out = os.path.join(scratch, "cards")
    q = ingest.start_card_ingest(spark, landed, out, checkpoint=os.path.join(scratch, "ckpt"))
    q.awaitTermination(180)
    streamed = spark.read.parquet(out)
    batch = daily.search_cards(spark.read.schema(LANDED_PAGES).parquet(landed))
    assert streamed.count() == 5
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_history_union_keeps_identical_rows_and_types(spark):
    new = spark.createDataFrame([("Vela 100g", 4, "Dhaka", "02-Mar-24, 01:05 PM")],
                                "sku string, stock int, location string, report_time string")
    old = spark.createDataFrame([("Vela 100g", "4", "Dhaka", "02-Mar-24, 01:05 PM"), ("x", "n/a", None, "")],
                                HISTORY_TEXT)
    out = H.union_with_history(new, old)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string"] * 4
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == rows[1] == ("Vela 100g", "4", "Dhaka", "02-Mar-24, 01:05 PM")
    assert len(rows) == 3 and out.count() == new.count() + old.count()
    assert tuple(H.null_to_empty(out).collect()[2]) == ("x", "n/a", "", "")


def test_command_line_run(spark, scratch):
    from shelfwise.__main__ import main
    p = {k: os.path.join(scratch, k) for k in ("pages", "desc", "obs", "out")}
    spark.createDataFrame(PAGES, LANDED_PAGES).write.parquet(p["pages"])
    spark.createDataFrame(DESC, DESCRIPTIONS).write.parquet(p["desc"])
    spark.createDataFrame(OBS, STOCK_OBSERVATIONS).write.parquet(p["obs"])
    rows = main(["--pages", p["pages"], "--descriptions", p["desc"], "--observations", p["obs"],
                 "--brands", "Nor,Vela,Opal", "--out", p["out"], "--day", "2024-03-01", "--marker", "ERROR"])
    assert rows[0].skus == 4 and rows[0].skus_failed_stock == 2
    listed = {r.sku: r.description for r in sinks.read_listings(spark, p["out"] + "/listings").collect()}
    assert listed["Vela soap"] == "ERROR" and listed["Nor Power 1kg"] == "Good soap"


def test_history_sheet_export_reads_as_text(spark, scratch):
    path = os.path.join(scratch, "sheet.csv")
    with open(path, "w") as f:
        f.write('sku,stock,location,report_time\n"Vela 100g",12,"Dhaka, North","02-Mar-24, 01:05 PM"\n'
                'x,,,""\n')
    text = H.read_history_csv(spark, path)
    assert [f.dataType.simpleString() for f in text.schema.fields] == ["string"] * 4
    rows = [tuple(r) for r in text.collect()]
    assert rows[0] == ("Vela 100g", "12", "Dhaka, North", "02-Mar-24, 01:05 PM")
    typed = H.typed_history(text).collect()
    assert typed[0].stock_n == 12 and str(typed[0].report_ts) == "2024-03-02 13:05:00"
    assert typed[1].stock_n is None and typed[1].report_ts is None


def test_outputs_follow_declared_schemas(spark, scratch):
    from shelfwise.schemas import LISTINGS, RUN_SUMMARY

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    pages = spark.createDataFrame(PAGES, LANDED_PAGES)
    summary = daily.daily_run(spark, pages, spark.createDataFrame(DESC, DESCRIPTIONS),
                              spark.createDataFrame(OBS, STOCK_OBSERVATIONS), ["Nor"], scratch, "2024-03-01")
    assert shape(summary.schema) == shape(RUN_SUMMARY)
    assert shape(sinks.read_listings(spark, os.path.join(scratch, "listings")).schema) == shape(LISTINGS)


def test_bucketed_descriptions_are_not_shuffled(spark, scratch):
    from shelfwise.operators import listings
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    landed.save_position_table(spark.createDataFrame(DESC, DESCRIPTIONS), "landed_descriptions_t",
                               os.path.join(scratch, "descriptions"), 8)
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        rows = listings.build_listings(daily.search_cards(spark.createDataFrame(PAGES, LANDED_PAGES)),
                                       landed.read_position_table(spark, "landed_descriptions_t"),
                                       spark.createDataFrame(OBS, STOCK_OBSERVATIONS))
        assert rows.count() == 4
        lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k in keys:
            spark.conf.unset(k)
    scan = next(i for i, line in enumerate(lines) if "landed_descriptions_t" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    for line in reversed(lines[:scan]):                      # ancestors up to the join
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            assert "Exchange" not in line, line
            if "Join" in line:
                break
            depth = d


def test_stream_ingest_restarts_from_its_checkpoint(spark, scratch):
    pages = spark.createDataFrame(PAGES, LANDED_PAGES)
    landed_dir, out, ckpt = (os.path.join(scratch, n) for n in ("landed", "cards", "ckpt"))
    pages.filter("page_id = 1").write.parquet(landed_dir)
    ingest.start_card_ingest(spark, landed_dir, out, checkpoint=ckpt).awaitTermination(180)
    assert spark.read.parquet(out).count() == 3
    pages.filter("page_id = 2").write.mode("append").parquet(landed_dir)      # new pages land later
    ingest.start_card_ingest(spark, landed_dir, out, checkpoint=ckpt).awaitTermination(180)
    cards = spark.read.parquet(out)
    assert cards.count() == 5 and cards.dropDuplicates(["page_id", "pos_in_pg"]).count() == 5


def test_daily_run_without_relevant_cards(spark, scratch):
    pages = spark.createDataFrame([(9, "u", "Opal", None, T0, "<p>nothing listed</p>")], LANDED_PAGES)
    summary = daily.daily_run(spark, pages, spark.createDataFrame([], DESCRIPTIONS),
                              spark.createDataFrame([], STOCK_OBSERVATIONS), ["Opal"], scratch, "2024-03-01")
    assert summary.collect() == []                   # no listing, no summary row


def test_daily_run_keeps_every_row_and_other_days(spark, scratch):
    """A run over midnight and without capture times: all its rows, and only its own partition."""
    late = [(1, "u1", "Nor", None, dt.datetime(2024, 3, 2, 0, 1), card("Nor a", "1", "৳ 1") + card("Nor b", "1", "৳ 2")),
            (2, "u2", "Nor", None, None, card("Nor c", "1", "৳ 3"))]
    table = os.path.join(scratch, "listings")

    def run(pages, day):
        return daily.daily_run(spark, spark.createDataFrame(pages, LANDED_PAGES), spark.createDataFrame([], DESCRIPTIONS),
                               spark.createDataFrame([], STOCK_OBSERVATIONS), ["Nor", "Vela"], scratch, day).collect()

    assert run(PAGES, "2024-03-02")[0].skus == 4
    assert run(late, "2024-03-01")[0].skus == 3
    assert sinks.read_listings(spark, table, "2024-03-02").count() == 4
    assert run([], "2024-03-01") == []                       # an empty rerun empties its own day only
    assert sinks.read_listings(spark, table, "2024-03-01").count() == 0
    assert sinks.read_listings(spark, table, "2024-03-02").count() == 4


def test_prefilter_keeps_what_the_parser_matches(spark):
    from shelfwise.operators import extract
    pages = spark.createDataFrame([(1, '<LI>x</LI>'), (2, '<p class="a&#100;">y</p>')], "page_id bigint, html string")
    assert [r.page_id for r in extract.parse_cards(pages, ("LI", None)).collect()] == [1]
    assert [r.page_id for r in extract.parse_cards(pages, ("P", "ad")).collect()] == [2]


def test_unlisted_brands_and_repeated_descriptions(spark, scratch):
    desc = [*DESC, (1, 1, "A newer text"), (1, 1, None)]
    s = daily.daily_run(spark, spark.createDataFrame(PAGES, LANDED_PAGES), spark.createDataFrame(desc, DESCRIPTIONS),
                        spark.createDataFrame(OBS, STOCK_OBSERVATIONS), ["Nor"], scratch, "2024-03-01").collect()[0]
    assert (s["skus"], s["brands_failed_stock"]) == (2, 0)
    rows = {r.sku: r.description for r in sinks.read_listings(spark, os.path.join(scratch, "listings")).collect()}
    assert rows == {"Nor Power 1kg": "Good soap", "nor bar": ""}
