"""The quality classifier's parts against plain versions, and its sample where ids repeat."""

import numpy as np
import pytest

from shelfwise.llm import quality


def test_ratio_and_dual_descent_match_plain_versions():
    rng = np.random.default_rng(3)
    y = np.where(rng.random(60) < .5, 1.0, -1.0)
    rows = [np.flatnonzero(rng.random(30) < (.2 + .3 * (np.arange(30) % 2 == (v > 0)))) for v in y]
    ratio = quality._log_count_ratio(rows, y)
    for f in range(30):
        n = [1 + sum(f in r for r, v in zip(rows, y) if (v > 0) == c) for c in (False, True)]
        total = [sum(len(r) for r, v in zip(rows, y) if (v > 0) == c) + (1 << quality.BITS) for c in (False, True)]
        assert ratio[f] == pytest.approx(np.log(n[1] / total[1]) - np.log(n[0] / total[0]))
    w = quality._dual_descent(rows, ratio, y, 400, 1.0)
    # the same problem as a matrix, solved by projected gradient on its dual
    x = np.zeros((60, (1 << quality.BITS) + 1))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt((ratio[r] ** 2).sum())
        x[i, -1] = 1.0
    q = (x @ x.T) * np.outer(y, y)
    alpha, step = np.zeros(60), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(20_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, 1.0)
    best = alpha.sum() - alpha @ q @ alpha / 2
    primal = w @ w / 2 + np.maximum(0, 1 - y * (x @ w)).sum()
    assert best <= primal + 1e-6 and primal == pytest.approx(best, rel=2e-3)


def _labelled(spark, n_hot):
    rows = [(i, f"good Text {i} ." if i % 2 else f"BAD {i} !! ##") for i in range(400)]
    rows += [(1, f"good Text, another {k}") for k in range(n_hot)] + [(1, "good Text 1 .")] * n_hot + [(2, None), (3, ""), (None, "x")]
    labels = [(i, i % 2, "x", 1) for i in range(400)] + [(5, 0, "x", 1), (6, None, "x", 1), (None, 1, "x", 1), (9999, 1, "x", 1)]
    return (spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id bigint, text string, label string, h bigint"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, text string, toxic int"))


def test_the_sample_is_bounded_where_one_id_holds_most_rows(spark, monkeypatch):
    docs, labels = _labelled(spark, 2000)
    seen = []
    real = quality.common.written
    monkeypatch.setattr(quality.common, "written", lambda df, name: seen.append(real(df, name)) or seen[-1])
    model = quality.train(docs, labels, sample_rows=300)
    several = seen[0].count()
    assert several > 2000 and model["scale"] is not None
    chosen = seen[0].filter(quality.common.hash_fraction(quality.F.struct("id", "h"), 6) < 300 / several).count()
    assert 200 < chosen < 400
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect() if r.doc_id is not None}
    assert np.mean([scores[i] > .5 for i in range(10, 400) if i % 2]) > .9
    assert np.mean([scores[i] < .5 for i in range(10, 400) if not i % 2]) > .9


def test_rows_held_for_the_calibration_are_not_learned(monkeypatch):
    import pandas as pd
    used = []
    monkeypatch.setattr(quality, "_log_count_ratio", lambda rows, y: used.append(len(rows)) or np.ones(1 << quality.BITS))
    x = [np.array([i % 7, 10 + i % 2]) for i in range(40)]
    quality._fit(pd.DataFrame({"id": range(40), "h": 0, "label": [i % 2 for i in range(20)] + [1 - i % 2 for i in range(20)], "x": x}))
    assert used == [30]


def test_calibration_of_separable_rows_is_finite():
    for margin, y in ((np.r_[np.full(50, -1.2), np.full(52, 1.1)], np.r_[-np.ones(50), np.ones(52)]),
                      (np.r_[np.full(3, -9.0), np.full(900, 8.0)], np.r_[-np.ones(3), np.ones(900)]),
                      (np.random.default_rng(1).normal(size=400), np.where(np.random.default_rng(2).random(400) < .3, 1.0, -1.0))):
        a, b = quality._logistic(margin, y)
        p = 1 / (1 + np.exp(-(a * margin + b)))
        t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y <= 0).sum() + 2))
        best = min(((np.logaddexp(0, u * margin + v) - t * (u * margin + v)).sum() + u * u / 2e3)
                   for u in np.linspace(-8, 8, 161) for v in np.linspace(-8, 8, 161))
        assert abs(a) < 50 and abs(b) < 50
        assert -(t * np.log(p) + (1 - t) * np.log(1 - p)).sum() + a * a / 2e3 <= best + 1e-6
