"""Global position, as-of join, SQL functions, the table function and the physical spread."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelfwise.functions import sql as S
from shelfwise.functions import text as TX
from shelfwise.functions import timefmt as TF
from shelfwise.operators import asof, extract, listings, position, tables
from shelfwise.plans import views as V

BASE = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_position_equals_row_number(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), 5 if rnd.random() < .4 else rnd.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, position_of int").repartition(7)
    got = position.numbered(df, [F.col("k").asc_nulls_last(), F.col("v").desc(), "position_of"])
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1], r[2]))
    assert [tuple(r)[:3] for r in got.orderBy("position").collect()] == want
    assert [r.position for r in got.orderBy("position").collect()] == list(range(1, 2001))
    ties = position.numbered(df, ["k"])                                # equal rows: any order, still every number once
    assert sorted(r.position for r in ties.collect()) == list(range(1, 2001))
    low = ties.groupBy("k").agg(F.min("position").alias("lo"), F.max("position").alias("hi"), F.count("*").alias("n")).collect()
    assert all(r.hi - r.lo + 1 == r.n for r in low)
    assert position.numbered(df.limit(0), ["k"]).count() == 0
    assert "SinglePartition" not in _plan(got)


def test_asof_equals_brute_force(spark):
    rnd, t0 = random.Random(6), dt.datetime(2024, 3, 9, 22)

    def when():
        return None if rnd.random() < .03 else t0 + dt.timedelta(seconds=rnd.choice([1, 60, 9000]) * rnd.randint(0, 300))

    def key():
        return rnd.choice(["hot"] * 5 + ["a", "b", "c", None])

    left = [(i, key(), when()) for i in range(300)]
    right = [(key(), when(), rnd.randint(0, 5), i if rnd.random() < .8 else None) for i in range(300)] + [("a", t0, 9, 9)] * 2
    lt = spark.createDataFrame(left, "i int, k string, t timestamp_ntz")
    rt = spark.createDataFrame(right, "k string, at timestamp_ntz, v int, w int")

    def found(k, t):
        fits = [r for r in right if k is not None and r[0] == k and r[1] is not None and t is not None and r[1] <= t]
        best = max((r[1] for r in fits), default=None)
        # of one time the greatest values; NULL is the smallest
        return max(((r[2], r[3]) for r in fits if r[1] == best), key=lambda x: (x[0], x[1] is not None, x[1] or 0), default=(None, None))

    want = sorted((i, k or "", str(t), *map(str, found(k, t))) for i, k, t in left)
    for seconds, fan in ((3600, 1024), (60, 3), (7, 2)):
        got = asof.asof_join(lt, rt, ["k"], "t", "at", ["v", "w"], seconds, fan).collect()
        assert sorted((r.i, r.k or "", str(r.t), str(r.v), str(r.w)) for r in got) == want
    assert asof.asof_join(lt, rt.limit(0), ["k"], "t", "at", ["v"]).filter("v is not null").count() == 0
    assert asof.asof_join(lt.limit(0), rt, ["k"], "t", "at", ["v"]).count() == 0
    assert "NestedLoop" not in _plan(asof.asof_join(lt, rt, ["k"], "t", "at", ["v"]))


TEXTS = ["Tk 1,234.50", "  Tk 7", "Tk", None, "", "a b c", "1,200 in bag", "১,২০০ in bag", "Tk ১২.৫", "1.5 x", "x 1_000", "x nan",
         " Tk 9", "x 1e3", "- -4", "+5 +6", "99999999999999999999 x", "line\nbreak 2"]
TIMES = ["2024-01-02 03:04:05", "2024-02-30 00:00:00", "x", None, "2024-03-10 02:30:00", ""]


def test_sql_functions_equal_the_column_forms(spark):
    assert set(S.register(spark)) == set(S.definitions())
    df = spark.createDataFrame([(t,) for t in TEXTS], "c string")
    forms = {"money": TX.money, "units": TX.units, "first_token": TX.first_token, "strip_spaces": TX.strip_spaces, "one_line": TX.one_line}
    want = df.select(*[f("c").alias(n) for n, f in forms.items()]).collect()
    got = spark.sql("select " + ", ".join(f"{n}(c) as {n}" for n in forms) + " from {d}", d=df)
    assert got.collect() == want
    assert "Python" not in _plan(got) and "Subquery" not in _plan(got)
    times = spark.createDataFrame([(t,) for t in TIMES], "c string")
    assert spark.sql("select report_time(c) as t from {d}", d=times).collect() == times.select(TF.parse_report_time("c").alias("t")).collect()
    spans = spark.sql("select timestamp_ntz'2024-01-01 23:59:59.9' as a, timestamp_ntz'2024-01-03 00:00:01.1' as b")
    got = spark.sql("select span_seconds(a, b) as s, span_text(span_seconds(a, b)) as t, report_time_text(b) as r, "
                    "span_text(-1) as m from {d}", d=spans).collect()
    s = TF.span_seconds("a", "b")
    assert got == spans.select(s, TF.span_text(s), TF.format_time("b"), TF.span_text(F.lit(-1))).collect() == [(86402, "00:00:02", "2024-01-03 00:00:01", "23:59:59")]


def test_table_function_in_sql(spark):
    tables.register(spark)
    pages = V.shaped_pages(spark, BASE).withColumn("brand", F.lit(None).cast("string"))
    got = spark.sql("select * from page_cards(TABLE(select brand, html, page_id from {p}), 'li', 'link=a, any=.x')", p=pages)
    assert got.columns == ["brand", "page_id", "pos_in_pg", "card_text", "link", "any"]
    want = extract.parse_cards(pages, ("li", None), {"link": ("a", None), "any": (None, "x")}, keep=("brand", "page_id"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = spark.sql("select count(*) as n from page_cards(TABLE(select html from {p} where page_id = 3), '.ad')", p=pages)
    assert one.collect() == [(2,)]
    import pytest
    for bad in ("page_cards(TABLE(select page_id from {p}), 'li')", "page_cards(TABLE(select html from {p}), '')",
                "page_cards(TABLE(select html from {p}), 'li', 'noname')"):
        with pytest.raises(Exception):
            spark.sql(f"select * from {bad}", p=pages).collect()


def test_spread_puts_each_chunk_in_its_partition(spark):
    dealt = listings.spread(spark.range(100).selectExpr("id - 10 as ord"), "ord", 7)
    where = dealt.select("chunk", F.spark_partition_id().alias("p")).distinct().collect()
    assert sorted(tuple(r) for r in where) == [(i, i) for i in range(7)] and dealt.rdd.getNumPartitions() == 7
