"""Tables of runs: reruns, failures, empty runs; the history, the sheet and the daily state built on them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import __main__ as cli
from shelfwise.operators import reports
from shelfwise.plans import catalogue, daily
from shelfwise.schemas import DESCRIPTIONS, LANDED_PAGES, STOCK_OBSERVATIONS
from shelfwise.sources import history as H
from shelfwise.sources import runs, sinks

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("run", T.StringType())])


def _rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a bigint")


def _state(spark, path, names=None):
    return sorted((r.run, r.a) for r in runs.read_runs(spark, path, SCHEMA, names).collect())


def test_rerun_empty_run_and_missing_table(spark, scratch):
    path = os.path.join(scratch, "t")
    assert _state(spark, path) == [] and runs.committed(spark, path).count() == 0
    runs.write_run(_rows(spark, 1, 2), path, "mon")
    runs.write_run(_rows(spark, 3), path, "tue")
    assert _state(spark, path) == [("mon", 1), ("mon", 2), ("tue", 3)]
    runs.write_run(_rows(spark, 9), path, "mon")                      # replaces its own run only
    assert _state(spark, path) == [("mon", 9), ("tue", 3)]
    runs.write_run(_rows(spark), path, "mon")                         # also by nothing
    assert _state(spark, path) == [("tue", 3)] and _state(spark, path, ["mon"]) == [] == _state(spark, path, ["wed"])
    assert {r.run: (r.seq, r["rows"]) for r in runs.committed(spark, path).collect()} == {"mon": (3, 0), "tue": (1, 1)}
    assert runs.replaced(spark, path).count() == 2
    for bad in ("", "a/b", "..", "a b", "x=y"):
        with pytest.raises(ValueError):
            runs.write_run(_rows(spark, 1), path, bad)


def test_failures_leave_the_old_state(spark, scratch):
    path = os.path.join(scratch, "t")
    runs.write_run(_rows(spark, 1, 2), path, "mon")
    before = runs.read_runs(spark, path, SCHEMA)
    broken = _rows(spark, 1, 2, 3).select(F.when(F.col("a") < 3, F.col("a")).otherwise(F.raise_error(F.lit("lost"))).alias("a"))
    with pytest.raises(Exception, match="lost"):
        runs.write_run(broken, path, "mon")
    assert _state(spark, path) == [("mon", 1), ("mon", 2)]
    runs.stage(_rows(spark, 7), path, "mon")                          # written, never switched in: the job died between
    assert _state(spark, path) == [("mon", 1), ("mon", 2)]
    runs.write_run(_rows(spark, 8), path, "mon")
    assert _state(spark, path) == [("mon", 8)]
    assert sorted(r.a for r in before.collect()) == [1, 2]            # an earlier reader keeps its files


PAGE = ("<div class='product x'><div class='name'>Vela Soft</div><div class='subText'>100 g</div></div>"
        "<div class='product'><div class='name'>Nor bar</div></div><b class='metropolitanAreaName'>Dhaka</b>")


def _catalogue(spark, units="1,200 in bag"):
    pages = spark.createDataFrame([(7, "u", None, None, dt.datetime(2024, 3, 2, 13, 5), PAGE)], LANDED_PAGES)
    obs = spark.createDataFrame([(7, 1, 1, "3 in bag", False, True, False, None), (7, 1, 2, units, True, True, False, None),
                                 (7, 2, 1, "add to bag", False, False, False, None)], STOCK_OBSERVATIONS)
    return pages, obs


def test_catalogue_run_keeps_the_stock_text_and_can_be_rerun(spark, scratch):
    pages, obs = _catalogue(spark)
    want = [("Nor bar None", "0", "Dhaka", "02-Mar-24, 01:05 PM"), ("Vela Soft 100g", "1,200", "Dhaka", "02-Mar-24, 01:05 PM")]
    for _ in range(2):                                                # the same run again gives the same sheet
        sheet = catalogue.catalogue_run(spark, pages, obs, ["Vela", "Nor"], scratch, "2024-03-02")
        assert [tuple(r) for r in sheet.collect()] == want
    pages, obs = _catalogue(spark, "5 in bag")
    sheet = catalogue.catalogue_run(spark, pages, obs, ["Vela"], scratch, "2024-03-03")
    assert sorted(tuple(r) for r in sheet.collect()) == sorted([*want, ("Vela Soft 100g", "5", *want[0][2:])])
    assert H.read_history(spark, os.path.join(scratch, "history")).count() == 3
    catalogue.append_catalogue(catalogue.catalogue_rows(pages, obs, []), os.path.join(scratch, "history"), "2024-03-02")
    assert [r.stock for r in H.read_history(spark, os.path.join(scratch, "history")).collect()] == ["5"]


def test_sheet_holds_no_nulls_and_newest_rows_come_first(spark, scratch):
    rows = [("a", "1", None, "x", dt.date(2024, 3, 1)), (None, 'q"u\note', "l", None, dt.date(2024, 3, 2)), ("b", None, "", "y", None)]
    history = spark.createDataFrame(rows, "sku string, stock string, location string, report_time string, report_date date")
    H.write_sheet(history, os.path.join(scratch, "sheet"))
    got = [tuple(r) for r in H.read_sheet(spark, os.path.join(scratch, "sheet")).collect()]
    assert got == [("", 'q"u\note', "l", ""), ("a", "1", "", "x"), ("b", "", "", "y")]
    H.write_sheet(history.limit(0), os.path.join(scratch, "sheet"))
    assert H.read_sheet(spark, os.path.join(scratch, "sheet")).count() == 0


def test_catalogue_command_line(spark, scratch, capsys):
    pages, obs = _catalogue(spark)
    pages.write.parquet(f"{scratch}/pages")
    obs.write.parquet(f"{scratch}/obs")
    rows = cli.main(["catalogue", "--pages", f"{scratch}/pages", "--observations", f"{scratch}/obs", "--brands", "Vela, ,Nor",
                     "--out", f"{scratch}/out", "--run", "r1"])
    assert [r.stock for r in rows] == ["0", "1,200"] and "2 rows" in capsys.readouterr().out


def _card(name, price):
    return f"<div class='imageWrapper'><div class='name'>{name}</div><div class='price'>Tk {price}</div></div>"


def test_daily_export_is_in_order_and_ranges_merge(spark, scratch):
    brands = ["Vela", "Nor", "Opal", "Vela", "", "Zed"]
    at = dt.datetime(2024, 3, 1, 9)
    summaries = []
    for d in range(3):
        pages = [(i, "u", b, None, at + dt.timedelta(days=d, minutes=7 * i),
                  "".join(_card(f"{b} {k}", d) for k in range(3 - d))) for i, b in enumerate(["Nor", "Vela", "Opal", "Other"])]
        obs = [(i, 1, 1, f"{i * d} in bag", True, True, False, at + dt.timedelta(days=d, minutes=9 * i)) for i in range(3)]
        day = f"2024-03-0{d + 1}"
        s = daily.daily_run(spark, spark.createDataFrame(pages, LANDED_PAGES), spark.createDataFrame([], DESCRIPTIONS),
                            spark.createDataFrame(obs, STOCK_OBSERVATIONS), brands, scratch, day).collect()
        summaries.append(s[0].asDict())
        assert s[0].brands_failed_stock == 1                          # Zed: a repeated brand and '' are no further ones
    export = sinks.read_csv_text(spark, f"{scratch}/exports/stocks_data_2024-03-01.csv", ["sku", "brand"])
    # chunks of three: Vela and Zed (places 0, 5), Nor, Opal
    assert [r.sku for r in export.collect()] == [f"{b} {k}" for b in ("Vela", "Nor", "Opal") for k in range(3)]
    table = sinks.read_listings(spark, f"{scratch}/listings")
    listed = spark.createDataFrame([("Vela",), ("Nor",), ("Opal",), ("Zed",)], "brand string")
    for first, last in ((1, 3), (2, 3), (2, 2), (3, 9)):
        span = [dt.date(2024, 3, d) for d in (first, last)]
        direct = reports.run_summary(table.filter(F.col("report_date").between(*map(F.lit, span))), listed)
        assert daily.range_summary(spark, scratch, *span, brands).collect() == direct.collect()
    assert daily.range_summary(spark, scratch, dt.date(2025, 1, 1), dt.date(2025, 1, 2), brands).collect() == []


def test_brand_bitmaps_count_distinct(spark):
    rows = [(d, f"b{(d * 7 + i) % 40000}") for d in range(3) for i in range(50)] + [(1, None), (2, "unlisted")]
    listings = spark.createDataFrame(rows, "day int, brand string")
    brands = spark.range(40000).selectExpr("concat('b', id) as brand", "cast(id as int) as ord")
    state = reports.brand_bitmaps(listings, brands, ["day"])
    for days in ([0], [0, 2], [0, 1, 2], [7]):
        want = len({b for d, b in rows if d in days and b and b != "unlisted"})
        assert reports.brands_in(state.filter(F.col("day").isin(days))).collect() == [(want,)]
