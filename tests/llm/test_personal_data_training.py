"""Personal data: every document is learned from, as a plain fit over all rows shows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import common, pii

PLAIN = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def many(spark):
    """More documents than any former sample; emails, phones and numbers that only some strict pattern confirms."""
    forms = ("please write to user{0}@site{1}.example.com today", "mail u{1}(at)site{1}.example.com or call +1 555 {2:07d} now",
             "order 555-{2:04d}-{1}x, ref {2:07d}", "call +44 20 {2:07d}", "tel 020 {2:07d} or 10.0.0.{1}", "none")
    rows = []
    for i in range(45_000):
        form = 5 if i % 3 else (i * 7919 // 3 + i // 11) % 5
        rows.append((i, forms[form].format(i % 97, i % 13, i * 37 % 9_000_000), "en", "a", 1))
    return spark.createDataFrame(rows, PLAIN).repartition(8).localCheckpoint()


@pytest.fixture(scope="module")
def proposed(many):
    """(kind, features, confirmed, held out) of every proposal of every document."""
    out = []
    for text, apart in many.select("text", common.hash_fraction(F.struct("doc_id", "text"), 8)).collect():
        base = pii.base_spans(text)
        out += [(p[0], pii.features(text, *p), any(a < p[2] and p[1] < b for _, a, b in base), apart < 0.25)
                for p in pii.proposals(text)]
    kind, x, y, held = zip(*out, strict=True)
    return np.array(kind), np.array(x), np.array(y, dtype=float), np.array(held)


def prior(proposed):
    _, _, y, held = proposed
    p = y[~held].mean()
    return np.log(p / (1 - p))


def plain_scores(x, y, seen):
    """Log-odds of all rows by boosted trees fitted to the seen ones, grown on the values themselves."""
    cuts = [np.unique(np.sort(c)[np.searchsorted(np.arange(1, len(c) + 1) / len(c), np.linspace(0.02, 0.98, 25))])
            for c in x[seen].T]
    f = np.full(len(y), np.log(y[seen].mean() / (1 - y[seen].mean())))
    for _ in range(30):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        todo, step = [(np.arange(len(y)), 0)], np.zeros(len(y))
        while todo:
            rows, depth = todo.pop()
            own = rows[seen[rows]]
            gs, hs = g[own].sum(), h[own].sum()
            step[rows] = gs / (hs + 1)
            best = (1e-6, None, None)
            for j, edges in enumerate(cuts if depth < 3 and len(own) >= 20 else []):
                for edge in edges:
                    left = x[own, j] <= edge
                    if min(left.sum(), (~left).sum()) >= 10:
                        gl, hl = g[own[left]].sum(), h[own[left]].sum()
                        gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                        if gain > best[0] * (1 + 1e-9):      # of equal gains the first
                            best = (gain, j, edge)
            if best[1] is not None:
                left = x[rows, best[1]] <= best[2]
                todo += [(rows[left], depth + 1), (rows[~left], depth + 1)]
        f = f + 0.3 * step
    return f


def test_training_takes_every_document(many, proposed):
    trees, limits = pii.train(many)
    kind, x, y, held = proposed
    assert np.isclose(trees.prior, prior(proposed), rtol=0, atol=1e-12)
    score = trees.score(x)
    for k in (4, 5):
        own = held & (kind == k)
        good = [s for s in np.unique(score[own]) if y[own & (score >= s)].mean() >= 0.98]
        assert limits[k] == min(good, default=np.inf)
    assert np.isfinite(limits[5])


def test_trees_equal_a_plain_fit(spark):
    rng = np.random.default_rng(5)
    texts = [f"{'call' if a else 'order'} {'+' if a and c else ''}{b:03d}-{c:04d}-{d} {'x' * e}" for a, b, c, d, e in
             zip(rng.integers(0, 2, 600), rng.integers(0, 999, 600), rng.integers(0, 9999, 600), rng.integers(1, 9999, 600),
                 rng.integers(0, 5, 600), strict=True)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    trees, _ = pii.train(docs)
    rows = []
    for text, apart in docs.select("text", common.hash_fraction(F.struct("doc_id", "text"), 8)).collect():
        base = pii.base_spans(text)
        rows += [(pii.features(text, *p), pii._confirmed(p, base), apart < 0.25) for p in pii.proposals(text)]
    x, y, held = (np.array(c, dtype=float) for c in zip(*rows, strict=True))
    assert np.allclose(trees.score(x), plain_scores(x, y, held == 0), atol=1e-6)


def test_pipeline_stage_learns_from_every_document(spark, many, proposed, monkeypatch):
    seen, fit = [], pii.Trees.fit

    def spy(self, *args):
        seen.append(fit(self, *args).prior)
        return self
    monkeypatch.setattr(pii.Trees, "fit", spy)
    out = corpus_pipeline.personal_data(spark, many, "")
    assert np.allclose(seen, [prior(proposed)], rtol=0, atol=1e-12) and out.columns == many.columns


def test_a_kind_of_one_document_is_held_out(spark):
    docs = spark.createDataFrame([(i, f"call +1 555 {i:07d} or 020 {i:07d}") for i in range(400)] + [(1000, "me@a.example.com")],
                                 "doc_id bigint, text string")
    trees, limits = pii.train(docs)
    assert np.isfinite(limits[4])
