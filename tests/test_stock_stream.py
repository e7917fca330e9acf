"""The streaming stock fold: equal to the batch fold, restartable, late rows counted."""

import os
import random

from shelfwise.operators import stock as batch
from shelfwise.schemas import STOCK_OBSERVATIONS
from shelfwise.streaming import stock as S


def _rows(rnd, steps):
    text = ["1,200 in bag", "7 in bag", "add to bag", None, "3.5 x", "৯ in bag"]
    return [(k, 1 + k % 2, s, rnd.choice(text), rnd.random() < .05, rnd.random() > .05, rnd.random() < .02, None)
            for s in steps for k in range(40) if rnd.random() < .8]


def _land(spark, rows, path):
    rows = list(rows)
    random.Random(len(rows)).shuffle(rows)
    spark.createDataFrame(rows, STOCK_OBSERVATIONS).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, scratch):
    rnd = random.Random(17)
    landed, table, checkpoint = (os.path.join(scratch, d) for d in ("landed", "table", "checkpoint"))
    every = []
    for first in (1, 9, 30):                       # three batches, the query stopped and started between them
        rows = _rows(rnd, range(first, first + 8))
        every += rows
        _land(spark, rows, landed)
        S.start_stock_fold(spark, landed, table, checkpoint, 1).awaitTermination(180)
        want = batch.fold_stock(spark.createDataFrame(every, STOCK_OBSERVATIONS)).collect()
        got = S.current_stock(spark, table).collect()
        assert sorted((r.page_id, r.pos_in_pg, str(r.stock)) for r in got) == sorted((r.page_id, r.pos_in_pg, str(r.stock)) for r in want)
        assert sum(r.n_late for r in got) == 0
    before = {(r.page_id, r.pos_in_pg): r.stock for r in got}
    _land(spark, [(0, 1, 2, "99 in bag", True, True, False, None)], landed)           # a step long folded
    S.start_stock_fold(spark, landed, table, checkpoint).awaitTermination(180)
    after = {(r.page_id, r.pos_in_pg): (r.stock, r.n_late) for r in S.current_stock(spark, table).collect()}
    assert {k: v[0] for k, v in after.items()} == before and after[0, 1][1] == 1


def test_fold_of_single_steps():
    start = (None, False, False, None, 0)
    assert S.fold(start, [(1, 4, False, False), (2, None, True, False), (3, 9, True, True)]) == (3, True, False, 4, 0)
    assert S.fold(start, [(1, 4, False, False), (2, 5, True, True)])[2]            # a failure at the stop is a failure
    half = S.fold(start, [(1, 4, False, False)])
    assert S.fold(half, [(1, 8, True, False), (2, 6, True, False)]) == (2, True, False, 6, 1)
