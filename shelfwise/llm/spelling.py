"""Spelling variants by a variable-length gram index.

1. Words are counted inside the scan tasks (each document's distinct runs once)
   and summed.
2. Gram dictionary: grams of ``qmin`` to ``qmax`` code points are counted over
   the words and pruned by frequency: only grams frequent enough to be worth
   extending are kept. The cut grows with the number of grams, so the dictionary
   holds at most ``MOST_GRAMS`` grams of each length (a fixed bound on what is
   broadcast).
3. A word is decomposed: from every start the shortest gram that is no longer
   frequent (or has ``qmax`` code points, or ends the word), without those that
   lie inside another.
4. Affected-gram bound: the most grams of a word that one edit can change (those
   that hold the edited place or begin right after it; nothing else is looked at
   when a gram is cut). A near word keeps all the others, so two near words share
   a gram among each one's bound + 1 rarest (one order for all words): only those
   are indexed.
5. List merging: the words of a list are merged by what is left of them when one
   place is opened; agreeing remainders are verified code point by code point. No
   list is compared pair by pair. A near pair is reported by its first common
   list only. A list expected to be longer than ``LONG_LIST`` is dealt out by the
   remainders themselves, and a word so short that an edit may touch all its
   grams is also indexed under its remainders alone: nothing is capped or lost.

Defined cases: NULL or empty texts hold no words; a NULL id counts as the empty
text before the colon; repeated rows count again; ties of the largest count go to
the smallest word; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices, utf8, written

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_LENGTH = 7
LEAST_COUNT = 2
DROP_EVERY = 31            # a run whose hash this number divides loses a code point
FORM_FACTOR = 10
QMIN, QMAX = 2, 3
LEAST_FREQUENT = 64        # a gram is frequent in more words' starts than this ...
MOST_GRAMS = 1 << 16       # ... and than the number of starts over this
LONG_LIST = 1 << 18        # words of a list that one task merges
FLUSH_WORDS = 300_000      # different words or grams a task holds before it returns their counts
UNIT_ROWS = 100_000        # index rows merged at a time (whole lists)
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def _counts(held: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                      names=[name, "n"])


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of whole texts, with the planted loss of a code point where the hash says so."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, crc = re.compile("[a-zÀ-ÿ]{%d,}" % least_length), zlib.crc32
        held: Counter = Counter()
        for part in slices(batches):
            for key, text in zip(utf8(part.column(0)), utf8(part.column(1)), strict=True):
                # bytes.lower folds A-Z only
                for w, n in Counter(runs.findall(text.lower().decode("utf-8", "replace"))).items():
                    h = crc(key + b":" + w.encode())
                    if h % DROP_EVERY == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < least_length:
                            continue
                    held[w] += n
                if len(held) > FLUSH_WORDS:
                    yield _counts(held, "word")
                    held = Counter()
        yield _counts(held, "word")

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= least_count)


def gram_dictionary(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, least: int = LEAST_FREQUENT,
                    most_grams: int = MOST_GRAMS) -> dict[str, int]:
    """Frequent grams and their number of starts; at most ``most_grams`` of each length."""
    starts = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    cut = max(least, -(-starts // most_grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for part in slices(batches):
            for w in part.column(0).to_pylist():
                for q in range(qmin, qmax + 1):
                    held.update([w[p:p + q] for p in range(len(w) - q + 1)])
            if len(held) > FLUSH_WORDS:
                yield _counts(held, "gram")
                held = Counter()
        yield _counts(held, "gram")

    rows = words.select("word").mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") > cut)
    return {r["gram"]: r["n"] for r in rows.toLocalIterator()}       # bounded by the cut


def decompose(word: str, frequent: dict[str, int], qmin: int = QMIN, qmax: int = QMAX) -> list[tuple[int, int]]:
    """(start, end) of the word's variable-length grams, none inside another."""
    out, last = [], -1
    for p in range(len(word) - qmin + 1):
        e = p + qmin
        while e < len(word) and e - p < qmax and word[p:e] in frequent:
            e += 1
        if e > last:
            out.append((p, e))
            last = e
    return out


def most_affected(grams: list[tuple[int, int]], length: int) -> int:
    """The most grams that one inserted, deleted or replaced code point can change."""
    change = [0] * (length + 2)
    for p, e in grams:
        change[max(0, p - 1)] += 1
        change[e] -= 1
    most = now = 0
    for c in change:
        now += c
        most = max(most, now)
    return most


def indexed_grams(word: str, frequent: dict[str, int], qmin: int = QMIN, qmax: int = QMAX) -> tuple[list[str], bool]:
    """The word's grams to index, rarest first, and whether its bound leaves none that an edit must spare."""
    grams = decompose(word, frequent, qmin, qmax)
    bound = most_affected(grams, len(word))
    order = sorted((frequent.get(word[p:e], 0), word[p:e], p) for p, e in grams)
    return list(dict.fromkeys(g for _, g, _ in order[:bound + 1])), len(grams) <= bound


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), length)


def remainder_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and of every word without its i-th code point, of words of one length."""
    m, length = codes.shape
    with np.errstate(over="ignore"):
        c = (codes.astype(np.uint64) + np.uint64(1)) * MIX
        c ^= c >> np.uint64(29)
        power = np.ones(length + 1, dtype=np.uint64)
        for i in range(length):
            power[i + 1] = power[i] * BASE
        after = np.zeros((m, length + 1), dtype=np.uint64)        # hash of what follows place i
        for i in range(length - 1, -1, -1):
            after[:, i] = c[:, i] * power[length - 1 - i] + after[:, i + 1]
        before = np.zeros(m, dtype=np.uint64)
        out = np.empty((m, length), dtype=np.uint64)
        for i in range(length):
            out[:, i] = before * power[length - 1 - i] + after[:, i + 1]
            before = before * BASE + c[:, i]
    return after[:, 0], out


def _mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(31))) * MIX + b
        return (x ^ (x >> np.uint64(30))) * BASE


def _equal_pairs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of equal keys."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    at = np.flatnonzero(k[1:] == k[:-1])
    left, right, step = [], [], 1
    while len(at):
        left.append(order[at])
        right.append(order[at + step])
        step += 1
        at = at[at + step < len(k)]
        at = at[k[at] == k[at + step]]
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def near_pairs(owner: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one list (``owner``) whose words differ by exactly one edit; every pair once."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    by_size = {}
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        codes = _codes([words[r] for r in rows.tolist()], length)
        whole, without = remainder_hashes(codes)
        by_size[length] = rows, codes, _mix(whole, owner[rows]), _mix(without, owner[rows, None])
    left, right = [], []
    for length, (rows, codes, _, without) in by_size.items():
        place = np.arange(length, dtype=np.uint64)
        a, b = _equal_pairs(_mix(without, place[None, :]).ravel())
        a, b = a // length, b // length
        ok = (owner[rows[a]] == owner[rows[b]]) & ((codes[a] != codes[b]).sum(axis=1) == 1)
        left.append(rows[a[ok]])
        right.append(rows[b[ok]])
        if length - 1 in by_size:
            short_rows, short_codes, short_whole, _ = by_size[length - 1]
            order = np.argsort(short_whole)
            found = short_whole[order]
            flat = without.ravel()
            at = np.minimum(np.searchsorted(found, flat), len(found) - 1)
            hit = np.flatnonzero(found[at] == flat)
            if len(hit):
                a, place, b = hit // length, hit % length, order[at[hit]]
                first = np.unique(a * len(short_rows) + b, return_index=True)[1]
                a, place, b = a[first], place[first], b[first]
                cols = np.arange(length - 1)[None, :]
                cols = cols + (cols >= place[:, None])
                ok = (owner[rows[a]] == owner[short_rows[b]]) & \
                    (codes[a[:, None], cols] == short_codes[b]).all(axis=1)
                left.append(rows[a[ok]])
                right.append(short_rows[b[ok]])
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def merge_lists(owner: np.ndarray, words: list[str], counts: np.ndarray, earlier: np.ndarray) -> tuple:
    """Per row with near words in its list, those not met in an earlier common list: row, number, best row.

    ``earlier`` holds the list keys of each row's word that come before this list, 0 where there is none.
    """
    a, b = near_pairs(owner, words)
    met = np.zeros(len(a), dtype=bool)
    for i in range(earlier.shape[1]):
        mine = earlier[a, i]
        for j in range(earlier.shape[1]):
            met |= (mine != 0) & (mine == earlier[b, j])
    a, b = np.concatenate((a[~met], b[~met])), np.concatenate((b[~met], a[~met]))
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -counts[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.empty(0, np.int64)
    return a[first], np.diff(np.append(first, len(a))), b[first]


def near_words(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, long_list: int = LONG_LIST,
               least_frequent: int = LEAST_FREQUENT, most_grams: int = MOST_GRAMS) -> DataFrame:
    """(word, n_near, best_n, best): of every word (column word, n; no word twice) that has near words."""
    frequent = words.sparkSession.sparkContext.broadcast(
        gram_dictionary(words, qmin, qmax, least_frequent, most_grams))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, h64 = frequent.value, xxhash.xxh3_64_intdigest
        for part in slices(batches, 8192):
            rows = {"key": [], "word": [], "n": [], "earlier": []}

            def put(key: int, word: str, n: int, earlier: list[int], rows=rows) -> None:
                rows["key"].append(key)
                rows["word"].append(word)
                rows["n"].append(n)
                rows["earlier"].append(np.array(earlier, dtype=np.uint64).tobytes())

            for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                grams, unbounded = indexed_grams(word, grams_of, qmin, qmax)
                keys = [h64(g.encode()) | 1 for g in grams]       # never 0
                dealt = [(k, keys[:i]) for i, (k, g) in enumerate(zip(keys, grams, strict=True))
                         if grams_of.get(g, 0) > long_list]
                for i, (k, g) in enumerate(zip(keys, grams, strict=True)):
                    if grams_of.get(g, 0) <= long_list:
                        put(k, word, n, keys[:i])
                if unbounded:
                    dealt.append((0, keys))
                if dealt:
                    left = dict.fromkeys([word, *(word[:i] + word[i + 1:] for i in range(len(word)))])
                    for k, earlier in dealt:
                        for r in left:
                            put(h64(r.encode(), seed=k) & ~1, word, n, earlier)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(rows["key"], dtype=np.uint64).view(np.int64)), pa.array(rows["word"], pa.string()),
                 pa.array(rows["n"], pa.int64()), pa.array(rows["earlier"], pa.binary())],
                names=["key", "word", "n", "earlier"])

    def merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        words_, counts = t.column(1).to_pylist(), t.column(2).to_numpy()
        before = t.column(3).to_pylist()
        earlier = np.zeros((len(words_), max(map(len, before)) // 8), dtype=np.uint64)
        for i, e in enumerate(before):
            earlier[i, :len(e) // 8] = np.frombuffer(e, np.uint64)
        row, near, best = merge_lists(t.column(0).to_numpy().view(np.uint64), words_, counts, earlier)
        return pa.RecordBatch.from_arrays(
            [t.column(1).take(pa.array(row)).combine_chunks(), pa.array(near.astype(np.int64)),
             t.column(2).take(pa.array(best)).combine_chunks(), t.column(1).take(pa.array(best)).combine_chunks()],
            names=["word", "near", "best_n", "best"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            if n and n >= UNIT_ROWS:                       # whole lists only: cut before the last one begins
                same = int(np.searchsorted(key != held[-1].column(0)[-1].as_py(), True)) if key[0] == \
                    held[-1].column(0)[-1].as_py() else 0
                if same < len(key):
                    if same:
                        held.append(batch.slice(0, same))
                    yield merged(held)
                    held, n, batch = [], 0, batch.slice(same)
            held.append(batch)
            n += batch.num_rows
        if held:
            yield merged(held)

    rows = words.select("word", "n").mapInArrow(index, "key bigint, word string, n bigint, earlier binary")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        merge, "word string, near bigint, best_n bigint, best string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form): forms followed to the last, by pointer doubling.

    A form is at least ``FORM_FACTOR`` times as frequent as its word, so chains end and are short.
    """
    to = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = to.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        step = to.join(nxt, "root", "left")
        if step.filter(F.col("__next").isNotNull()).isEmpty():
            return to
        to = written(step.select("word", F.coalesce("__next", "root").alias("root")), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, factor: int = FORM_FACTOR, **index) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; ``index``: parameters of ``near_words``."""
    words = written(word_counts(docs, id_col, text_col, least_length, least_count), "words")
    near = near_words(words, **index)
    has = F.col("best_n") >= F.lit(factor) * F.col("n")
    found = written(words.join(near, "word", "left").select(
        "word", F.when(has, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n")), "variants")
    ends = roots(found.filter(F.col("form").isNotNull()).select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                   "n_near", "form_n")
