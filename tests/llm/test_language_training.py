"""Language identification: every byte of every labelled text is learned, as plain counts show."""

import collections
import zlib

import numpy as np
import pytest

import corpus_pipeline
from shelfwise.llm import langid

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_counts(rows):
    """Grams of texts that are lower-case letters and single spaces already."""
    found = collections.defaultdict(collections.Counter)
    for _, text, lang, *_ in rows:
        if text is not None and lang is not None and text.strip():
            data = b"   " + text.encode()
            found[lang].update(int.from_bytes(data[i:i + 4], "big") for i in range(len(data) - 3))
    return dict(found)


def counts(model):
    return {lang: dict(zip(np.frombuffer(g, np.int64).tolist(), np.frombuffer(n, np.int64).tolist(), strict=True))
            for lang, g, n in model}


@pytest.fixture(scope="module")
def rows():
    """More text of a language than any former sample, a long text among it."""
    rng = np.random.default_rng(3)
    words = np.array(["lorem", "ipsum", "dolor", "été", "amet", "naïve", "sit", "ω"])
    out = [(i, " ".join(rng.choice(words, 250)), "aa", "s", 1) for i in range(2000)]
    out += [(3000, " ".join(rng.choice(words, 20_000)), "aa", "s", 1), (3001, "fox dog", "bb", "s", 1), (3002, None, "aa", "s", 1),
            (3003, "unlabelled", None, "s", 1), (3004, " ", "cc", "s", 1)]
    return out


def test_training_takes_every_byte(spark, rows, monkeypatch):
    monkeypatch.setattr(langid, "MAX_PIECE", 50_000)
    assert sum(len(r[1].encode()) for r in rows if r[1] and r[2] == "aa") > 2_500_000
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert counts(langid.train(docs)) == plain_counts(rows)
    with pytest.raises(ValueError):
        langid.train(docs, max_langs=1)


def test_pipeline_stage_learns_from_every_document(spark, rows, monkeypatch):
    seen, train = [], langid.train
    monkeypatch.setattr(langid, "train", lambda *a, **k: seen.append(train(*a, **k)) or seen[-1])
    # a language of one document, whose id a fold would have held out
    lone = next(i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 4 == 2)
    every = [*rows, (lone, "щука ёж юла " * 40, "dd", "s", 1)]
    every = [(i, t and " ".join(t.split()) or t, *r) for i, t, *r in every]
    got = corpus_pipeline.language_id(spark, spark.createDataFrame(every, COLUMNS), "")
    assert lone in {r.doc_id for r in got.select("doc_id").collect()}
    assert counts(seen[0]) == plain_counts(every)


def test_rare_contexts_fall_back_to_order_two():
    texts = {"a": b"   abab abba abab cab", "b": b"   bbbb aaaa bbbb abba dab"}
    grams = {}
    for lang, t in texts.items():
        c = collections.Counter(int.from_bytes(t[i:i + 4], "big") for i in range(len(t) - 3))
        grams[lang] = np.array(sorted(c)), np.array([c[g] for g in sorted(c)])
    every = {lang: collections.defaultdict(collections.Counter) for lang in texts}
    for lang, t in texts.items():
        for i in range(3, len(t)):
            for o in range(4):
                every[lang][t[i - o:i]][t[i]] += 1
    common = {c for seen in every.values() for c, n in seen.items() if len(c) < 3 or n.total() >= 3}

    def bits(lang, text):
        out = 0.0
        for i in range(3, len(text)):
            for o in (3, 2, 1, 0):
                c = every[lang].get(text[i - o:i])
                if c and text[i - o:i] in common:
                    out += np.log2(c.total() + len(c)) - np.log2(c[text[i]] or len(c))
                    if text[i] in c:
                        break
            else:
                out += 8.0
        return out

    probes = [b"abba", b"bbbb", b"aaaa ab", b"bab cab", b"abxa"]
    got = langid.Trees(["a", "b"], grams, min_context=3).lengths(probes)
    assert np.allclose(got[:, :2], [[bits(lang, b"   " + p) for lang in "ab"] for p in probes], atol=1e-4)
