"""Benchmark decontamination by winnowing (DataFrame functions only).

An item window is ``window`` consecutive item words (an item of fewer words is
one window). Of the ``window - k + 1`` k-gram hashes inside a window the
smallest is its fingerprint, so equal windows have equal fingerprints and every
shared span of at least ``window`` words shares one. The distinct fingerprints
of a document are joined with those of the item windows; a document with hits
gets the windows behind them as candidates, and each hit is extended: the
window's occurrences in the document are found by comparing all its words, so
results are exact.

Items of fewer words than a window are below the winnowing guarantee: their
whole word sequence is looked up among the document's word sequences of the
same length (only for lengths that some item has).

The fingerprint join broadcasts the benchmark side when the planner's size
check allows it, else both sides shuffle 8-byte hashes. Candidate windows are
gathered per document; texts move once, to meet them.

Defined cases: NULL or wordless documents have no words and no hits; NULL or
wordless items have no window; items with a NULL id mark words as hit but are
not listed or counted; repeated items count once per id; repeated documents
get the same result each; empty tables give no hits (or no rows). Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, row_key, written

# The words of the contract before A-Z are lower-cased, and what separates them.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5


def words(text: Column | str) -> Column:
    """The words of a text with A-Z lower-cased (NULL: none)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(ascii_lower(F.coalesce(c, F.lit(""))), BREAK), "")


def folded_words(text: Column | str) -> Column:
    """The same words folded to lower case of any script: equal words stay equal, and folding whole
    texts is cheap. Only fingerprints are taken from them. (Sigma is folded first, because its
    lower case depends on its neighbours.)"""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.replace(F.coalesce(c, F.lit("")), F.lit("\u03a3"), F.lit("\u03c3"))),
                                  BREAK), "")


def _positions(n: Column, length: int | Column) -> Column:
    """0-based starts of all runs of ``length`` in an array of ``n`` (none when shorter)."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _shifted(a: Column, by: int, b: Column, f) -> Column:
    """``f(a[i], b[i + by])`` for every i that both have."""
    n = F.greatest(F.least(F.size(a), F.size(b) - by), F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(by + 1), n), f)


def _run(a: Column, length: int, f) -> Column:
    """``f`` folded over every ``length`` consecutive elements, in about log2(length) passes.

    ``f`` joins the folds of two neighbouring runs (runs may overlap when ``f`` is idempotent).
    """
    if length == 1:
        return a
    half = length // 2
    if length % 2 == 0:
        return let(_run(a, half, f), lambda x: _shifted(x, half, x, f))
    return let(_run(a, length - 1, f), lambda x: _shifted(x, length - 1, a, f))


def gram_hashes(w: Column, k: int) -> Column:
    """The hash of every k consecutive words."""
    if k == 1:
        return F.transform(w, lambda x: F.xxhash64(x))
    return _run(w, k, lambda a, b: F.xxhash64(a, b))


def fingerprints(w: Column, window: int, k: int) -> Column:
    """Winnowing: the distinct smallest k-gram hashes of all windows of ``window`` words."""
    return let(gram_hashes(w, k), lambda h: F.array_distinct(
        _run(h, window - k + 1, lambda a, b: F.least(a, b))))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, n, joined, folded ARRAY): the distinct windows of every item; n words each."""
    def cut(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0))),
                           lambda i: F.slice(w, i + 1, F.lit(window)))

    w = items.select(F.col(id_col).alias("item_id"), let(words(text_col), cut).alias("exact"),
                     let(folded_words(text_col), cut).alias("folded"))
    return w.select("item_id", F.explode(F.arrays_zip("exact", "folded")).alias("z")) \
        .select("item_id", F.size("z.exact").alias("n"), F.array_join("z.exact", " ").alias("joined"),
                F.col("z.folded").alias("folded")).filter(F.col("n") > 0).distinct()


def fingerprinted(docs: DataFrame, text_col: str = "text", window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """(__id, __h, n_words, prints ARRAY<BIGINT>) of every row, written once to the shared folder."""
    def both(w: Column) -> Column:
        return F.struct(F.size(w).cast("bigint").alias("n_words"), fingerprints(w, window, k).alias("prints"))

    return written(docs.select(*row_key("doc_id", text_col), let(folded_words(text_col), both).alias("f"))
                   .select("__id", "__h", "f.*"), "winnowed")


def candidates(docs: DataFrame, prints: DataFrame, windows: DataFrame, text_col: str, window: int,
               k: int) -> DataFrame:
    """(__id, __h, wins): the item windows that share a fingerprint with a document, as (n, text) structs."""
    distinct = windows.select("n", "joined", "folded").distinct()
    marks = distinct.filter(F.col("n") == window) \
        .select("n", "joined", F.array_min(gram_hashes(F.col("folded"), k)).alias("hash"))
    shared = prints.select("__id", "__h", F.explode("prints").alias("hash")) \
        .join(marks, "hash").select("__id", "__h", "n", "joined")
    d = docs.select(*row_key("doc_id", text_col), F.col(text_col).alias("__text"))
    short = distinct.filter(F.col("n") < window).select("n", "joined", F.xxhash64("folded").alias("hash"))
    lengths = short.select(F.collect_set("n")).scalar()      # at most window - 1 numbers
    runs = d.withColumn("n", F.explode(lengths)).select("__id", "__h", "n", F.explode(let(
        folded_words("__text"), lambda w: F.array_distinct(F.transform(
            _positions(F.size(w), F.col("n")),
            lambda i: F.xxhash64(F.slice(w, i + 1, F.col("n"))))))).alias("hash"))
    return shared.unionByName(runs.join(short, ["hash", "n"]).select("__id", "__h", "n", "joined")) \
        .groupBy("__id", "__h").agg(F.collect_set(F.struct("n", "joined")).alias("wins"))


def occurrences(w: Column, wins: Column) -> Column:
    """ARRAY<STRUCT<at, n, joined>>: where each candidate window occurs in an array of words, exactly."""
    def of_length(n: Column) -> Column:
        def found(texts: Column) -> Column:
            runs = F.transform(_positions(F.size(w), n), lambda p: F.struct(
                p.alias("at"), n.alias("n"), F.array_join(F.slice(w, p + 1, n), " ").alias("joined")))
            return F.filter(runs, lambda r: F.array_contains(texts, r["joined"]))

        return let(F.transform(F.filter(wins, lambda x: x["n"] == n), lambda x: x["joined"]), found)

    return F.flatten(F.transform(F.array_distinct(F.transform(wins, lambda x: x["n"])), of_length))


def covered(spans: Column) -> Column:
    """Number of positions covered by an array of (at, n) spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("upto"))
    return F.aggregate(F.array_sort(spans), start, lambda acc, s: F.struct(
        (acc["total"] + F.greatest(s["at"] + s["n"] - F.greatest(acc["upto"], s["at"]), F.lit(0))).alias("total"),
        F.greatest(acc["upto"], s["at"] + s["n"]).alias("upto")))["total"]


def contamination(docs: DataFrame, items: DataFrame, prints: DataFrame, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  k: int = GRAM) -> DataFrame:
    """(__id, __h, n_hit, item_ids): one row per contaminated document key.

    ``docs`` has ``doc_id`` and ``text_col``, ``prints`` is ``fingerprinted(docs)``;
    ``item_ids`` are the ids, as sorted strings, of the items with an occurring window.
    """
    windows = item_windows(items, item_id, item_text, window)
    found = candidates(docs, prints, windows, text_col, window, k)
    d = docs.select(F.col("doc_id").alias("__k1"), F.xxhash64(text_col).alias("__k2"), F.col(text_col).alias("__text"))
    hits = d.join(found, d["__k1"].eqNullSafe(found["__id"]) & (d["__k2"] == found["__h"])) \
        .select("__id", "__h", let(words("__text"), lambda w: occurrences(w, F.col("wins"))).alias("hits"))
    per_doc = hits.select("__id", "__h", covered(F.col("hits")).alias("n_hit"), F.explode(
        F.array_distinct(F.transform("hits", lambda x: x["joined"]))).alias("joined"))
    windows = windows.select("joined", F.col("item_id").cast("string").alias("item"))
    return per_doc.join(windows, "joined") \
        .groupBy("__id", "__h").agg(F.max("n_hit").alias("n_hit"),
                                    F.sort_array(F.collect_set("item")).alias("item_ids"))


def report(docs: DataFrame, items: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, contaminated) of every row of ``docs``."""
    prints = fingerprinted(docs, text_col)
    found = contamination(docs, items, prints, text_col, **kw)
    d = prints.select(F.col("__id").alias("doc_id"), F.col("__h").alias("__h1"), "n_words")
    return d.join(found, d["doc_id"].eqNullSafe(found["__id"]) & (d["__h1"] == found["__h"]), "left") \
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")) \
        .withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns, without a benchmark window."""
    found = contamination(docs, items, fingerprinted(docs, text_col), text_col, **kw).select("__id", "__h")
    d = docs.withColumn("__k", F.xxhash64(text_col))
    return d.join(found, d["doc_id"].eqNullSafe(found["__id"]) & (d["__k"] == found["__h"]), "left_anti").drop("__k")
