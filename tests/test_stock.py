import datetime as dt
import random

from shelfwise.operators import stock
from shelfwise.schemas import STOCK_OBSERVATIONS

from test_text import py_units


def py_fold(steps):
    """Brute force, following the click loop: steps sorted by step number."""
    stk = 0
    for _, text, lim, ctr, fail in sorted(steps, key=lambda s: s[0]):
        if fail:
            return None
        v = py_units(text)
        if v is not None:
            stk = v
            if lim:
                return stk
        if not ctr:
            return stk
    return stk


# (pos_in_pg, step, bag_text, limit_marker, counter_present, failed) on page 1
EDGE = [
    # 1: never parsed, counter gone at step 2 -> 0
    (1, 1, "add", False, True, False), (1, 2, "add", False, False, False),
    # 2: parsed then limit -> 5
    (2, 1, "1 in bag", False, True, False), (2, 2, "5 in bag", True, True, False),
    (2, 3, "9 in bag", False, True, True),                        # after the stop: ignored (even a failure)
    # 3: limit without a number does not stop; counter gone later -> 40
    (3, 1, "40 in bag", False, True, False), (3, 2, "limit", True, True, False),
    (3, 3, "add", False, False, False), (3, 4, "77", True, True, False),
    # 4: counter gone at step 1 -> 0
    (4, 1, "add", False, False, False),
    # 5: failure before the stop -> NULL
    (5, 1, "3 in bag", False, True, False), (5, 2, "x", False, True, True), (5, 3, "4", True, True, False),
    # 6: failure at step 1 -> NULL
    (6, 1, "3", True, True, True),
    # 7: observations end without a stop -> last parsed (1,200 -> 1200)
    (7, 1, "7", False, True, False), (7, 2, "1,200 in bag", False, True, False), (7, 3, "x", False, True, False),
    # 8: NULL flags read as not seen: NULL counter stops
    (8, 1, "6", None, None, None),
]


def _frame(spark, rows):
    data = [(1, p, s, t, lim, ctr, f, None) for p, s, t, lim, ctr, f in rows]
    return spark.createDataFrame(data, STOCK_OBSERVATIONS)


def test_fold_edges(spark):
    expected = {1: 0, 2: 5, 3: 40, 4: 0, 5: None, 6: None, 7: 1200, 8: 6}
    rows = EDGE[:]
    random.Random(3).shuffle(rows)                                # input order must not matter
    for b, fan, lv in ((1, 2, 0), (1, 2, 3), (2, 3, 1), (1 << 16, 1 << 10, 1)):
        got = {r.pos_in_pg: r.stock for r in stock.fold_stock(_frame(spark, rows), bucket_steps=b,
                                                                merge_fanin=fan, merge_levels=lv).collect()}
        assert got == expected, (b, fan, lv)
    by_pos = {}
    for p, s, t, lim, ctr, f in EDGE:
        by_pos.setdefault(p, []).append((s, t, lim, ctr, f))
    assert {p: py_fold(v) for p, v in by_pos.items()} == expected


def test_fold_matches_brute_force_on_random_tables(spark):
    rnd = random.Random(11)
    texts = ["add", "1 in bag", "25 in bag", "1,000 left", "x 5", "", None, "7"]
    rows = []
    for pos in range(1, 120):
        n = rnd.randint(1, 40)
        for s in rnd.sample(range(0, 400), n):
            rows.append((pos, s, rnd.choice(texts), rnd.random() < 0.15, rnd.random() > 0.08, rnd.random() < 0.03))
    # one hot key holding far more steps than any other
    for s in range(0, 3000):
        rows.append((999, s, rnd.choice(texts), rnd.random() < 0.001, rnd.random() > 0.001, rnd.random() < 0.0005))
    by_pos = {}
    for p, s, t, lim, ctr, f in rows:
        by_pos.setdefault(p, []).append((s, t, lim, ctr, f))
    expected = {p: py_fold(v) for p, v in by_pos.items()}
    df = _frame(spark, rows)
    for b, fan, lv in ((1, 2, 2), (1, 7, 1), (16, 4, 1), (1 << 16, 1 << 10, 1), (3, 2, 0)):
        got = {r.pos_in_pg: r.stock for r in stock.fold_stock(df, bucket_steps=b, merge_fanin=fan,
                                                                merge_levels=lv).collect()}
        assert got == expected, (b, fan, lv)


def test_fold_carries_last_observation_time(spark):
    df = spark.sql("""select 1L page_id, 1L pos_in_pg, s step, cast(s as string) bag_text, false limit_marker,
                             true counter_present, false failed,
                             timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s) observed_at
                      from range(0, 50) t(s)""")
    r = stock.fold_stock(df, bucket_steps=7, merge_fanin=2, time_col="observed_at").collect()[0]
    assert r.stock == 49 and str(r.seen_at) == "2024-01-01 00:00:49"


def test_fold_plan_spreads_hot_keys(spark):
    df = _frame(spark, EDGE)
    plan = stock.fold_stock(df)._jdf.queryExecution().executedPlan().toString()
    # the full shuffle is on (key, segment), never on the key alone
    assert "hashpartitioning(page_id" in plan and "seg" in plan
    assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan


def test_fold_time_is_the_end_of_the_reading(spark):
    t = [dt.datetime(2024, 1, 1, 10) + dt.timedelta(hours=h) for h in range(5)]
    rows = [(1, 1, 1, "1", False, True, False, t[0]), (1, 1, 2, "5", True, True, False, t[1]),
            (1, 1, 3, "9", False, True, True, t[3]),                              # after the stop: not read
            (1, 2, 1, "3", False, True, True, t[1]), (1, 2, 2, "4", True, True, False, t[2]),
            (1, 3, 1, "3000000000 in bag", False, True, False, t[2]), (1, 3, 2, "x", False, True, False, None)]
    df = spark.createDataFrame(rows, STOCK_OBSERVATIONS)
    for b, levels in ((1, 0), (1, 2), (1 << 16, 1)):
        got = {r.pos_in_pg: (r.stock, r.seen_at) for r in stock.fold_stock(
            df, bucket_steps=b, merge_fanin=2, merge_levels=levels, time_col="observed_at").collect()}
        assert got == {1: (5, t[1]), 2: (None, t[1]), 3: (3000000000, t[2])}
