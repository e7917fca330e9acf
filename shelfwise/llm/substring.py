"""Substring dedup: words in spans that repeat anywhere in the corpus are removed.

A window is ``window`` consecutive words of one document. Two passes:

1. Count-min prefilter. Every task counts its windows in sketch cells (``DEPTH``
   rows, saturating at two) and returns the cells it touched, cut into shards;
   the shards of all tasks are merged into one bit per cell: counted twice or
   more. A cell never undercounts, so no repeated window is lost.
2. Windows whose cells all say "repeated" are grouped exactly, on 128 bits of
   hash of their word sequence. A task names a window that it holds more than
   once only once (all its occurrences there are repeated already), so a passage
   shared by a third of all documents costs one row per task slice.

Repeated starts return to their documents as runs and the words they cover are
removed. Windows are judged on the input.

The sketch is sized by the amount of text, up to ``MOST_CELLS`` per row (a fixed
bound on the broadcast bits: DEPTH * MOST_CELLS / 8 bytes); beyond it the
estimate is looser, more windows reach the exact pass, and results stay the same.

Defined cases: NULL text has no words; a document shorter than a window keeps
all its words; repeated rows repeat all their windows; rows that share id and
text share one result; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .common import slices, utf8, written

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 35
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
DEPTH = len(MIX)           # sketch rows
SHARD_BITS = 20            # cells of a shard: 2^20 (1 MB while merging, 128 KB as bits)
LEAST_CELLS = 1 << 20
MOST_CELLS = 1 << 29
CELLS_PER_WINDOW = 2.5
BYTES_PER_WORD = 6
FLUSH_WORDS = 1_500_000    # words whose windows a task holds before it returns them


def window_hashes(h: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every ``window`` consecutive word hashes, by doubling."""
    b = np.uint64(base)
    out, length, run, power = None, 0, h, 1           # run: hash of ``power`` consecutive words
    mult = b
    with np.errstate(over="ignore"):
        while True:
            if window & power:
                if out is None:
                    out, length, lift = run, power, mult
                else:
                    n = min(len(out) - power, len(run)) if len(run) > power else 0
                    n = max(0, min(len(run), len(out) - power))
                    out = run[:n] * lift + out[power:power + n]
                    length, lift = length + power, lift * mult
            power *= 2
            if power > window:
                break
            half = power // 2
            n = max(0, len(run) - half)
            run = run[:n] * mult + run[half:half + n]
            mult = mult * mult
    return out[:max(0, len(h) - window + 1)]


def _keys(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of every window of a document, as two uint64 arrays."""
    h64 = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(h64, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        second = (h ^ (h >> np.uint64(29))) * MIX[1]
        second ^= second >> np.uint64(32)
    return window_hashes(h, window, 0x9E3779B97F4A7C15), window_hashes(second, window, 0xD6E8FEB86659FD93)


def _cells(k1: np.ndarray, k2: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of every window in each sketch row."""
    # the upper half of a mixed hash, scaled to the number of cells (below 2^32)
    half = np.uint64(32)
    with np.errstate(over="ignore"):
        return [((k * m >> half) * np.uint64(cells)) >> half for k, m in zip((k1, k2), MIX, strict=True)]


def _pack(v: np.ndarray) -> bytes:
    """Sorted 32-bit numbers, as compressed differences."""
    d = np.diff(v, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)


def _key(id_col: str, text_col: str) -> list[Column]:
    """Identity of a row's result: hashes of its id and of its text, never NULL, so that the
    grouping of its runs and their join with the text share one shuffle."""
    return [F.xxhash64(id_col).alias("__id"), F.xxhash64(text_col).alias("__h")]


def _sizes(docs: DataFrame, text_col: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0)


def sketch(docs: DataFrame, text_col: str, window: int, cells: int) -> DataFrame:
    """(row, shard, bits BINARY): the merged sketch, one bit per cell counted twice or more."""
    shard = SHARD_BITS

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        k1 = np.concatenate([h[0] for h in held])
        k2 = np.concatenate([h[1] for h in held])
        for d, at in enumerate(_cells(k1, k2, cells)):
            at, n = np.unique(at, return_counts=True)
            owner = (at >> np.uint64(shard)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(owner)) + 1
            low = (at & np.uint64((1 << shard) - 1)).astype(np.uint32)
            shards = owner[np.concatenate(([0], cuts))]
            once = [_pack(x) for x in np.split(low, cuts)]
            twice = [_pack(x[m > 1]) for x, m in zip(np.split(low, cuts), np.split(n, cuts), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(shards), pa.int32()), pa.array(shards), pa.array(once, pa.binary()),
                 pa.array(twice, pa.binary())], names=["row", "shard", "once", "twice"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in slices(batches):
            for t in utf8(part.column(0)):
                w = t.split()
                if len(w) >= window:
                    held.append(_keys(w, window))
                    n += len(w)
            if n > FLUSH_WORDS:
                yield from flush(held)
                held, n = [], 0
        if held:
            yield from flush(held)

    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros(1 << shard, dtype=np.uint8)
        for once, twice in zip(pieces["once"], pieces["twice"], strict=True):
            at = _unpack(once)
            c[at] = np.minimum(c[at] + 1, 2)
            c[_unpack(twice)] = 2
        return pd.DataFrame({"row": pieces["row"].iloc[:1], "shard": pieces["shard"].iloc[:1],
                             "bits": [np.packbits(c > 1).tobytes()]})

    return docs.select(text_col).mapInArrow(count, "row int, shard bigint, once binary, twice binary") \
        .groupBy("row", "shard").applyInPandas(merge, "row int, shard bigint, bits binary")


def _load(held: dict) -> list[np.ndarray]:
    """The sketch rows as bit arrays, put together once per worker process."""
    if held["rows"] is None:
        rows = [np.zeros(max(1, held["cells"] // 8), dtype=np.uint8) for _ in range(DEPTH)]
        while held["bits"]:                    # each piece is freed as it is put in its place
            row, shard, bits = held["bits"].pop()
            b = np.frombuffer(zstandard.ZstdDecompressor().decompress(bits), np.uint8)
            rows[row][shard * len(b):(shard + 1) * len(b)] = b
        held["rows"] = rows
    return held["rows"]


def repeated_starts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    window: int = WINDOW) -> DataFrame:
    """(__id, __h, at, n): runs of ``n`` consecutive repeated windows from word ``at`` of a document."""
    spark = docs.sparkSession
    want = int(CELLS_PER_WINDOW * _sizes(docs, text_col) / BYTES_PER_WORD)
    cells = min(MOST_CELLS, max(LEAST_CELLS, -(-want >> SHARD_BITS) << SHARD_BITS))
    merged = written(sketch(docs, text_col, window, cells), "sketch")
    # bounded: DEPTH * cells / 8 bytes
    pieces = [(r["row"], r["shard"], zstandard.ZstdCompressor(level=1).compress(bytes(r["bits"])))
              for r in merged.toLocalIterator()]
    shared = spark.sparkContext.broadcast({"cells": cells, "bits": pieces, "rows": None})
    del pieces
    d = docs.select(*_key(id_col, text_col), F.col(text_col).alias("__text"))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, cells_ = _load(shared.value), shared.value["cells"]
        ids, hashes, held, n = [], [], [], 0
        for part in slices(batches, 64):
            ids_of, hashes_of = part.column(0), part.column(1)
            for i, t in enumerate(utf8(part.column(2))):
                w = t.split()
                if len(w) < window:
                    continue
                k1, k2 = _keys(w, window)
                ok = np.ones(len(k1), dtype=bool)
                for bits, at in zip(rows, _cells(k1, k2, cells_), strict=True):
                    ok &= (bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1
                at = np.flatnonzero(ok)
                n += len(w)
                if len(at):
                    held.append((np.full(len(at), len(ids)), at, k1[at], k2[at]))
                    ids.append(ids_of[i].as_py())
                    hashes.append(hashes_of[i].as_py())
            if n > FLUSH_WORDS:
                yield from named_once(ids, hashes, held)
                ids, hashes, held, n = [], [], [], 0
        yield from named_once(ids, hashes, held)

    def named_once(ids: list, hashes: list, held: list) -> Iterator[pa.RecordBatch]:
        """One named row per window, and runs of the windows that occur here more than once."""
        if held:
            owner, start, k1, k2 = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((k2, k1))
            a, b = k1[order], k2[order]
            new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            group = np.cumsum(new) - 1
            several = np.bincount(group)[group] > 1
            # one named row per window; of those held more than once, the rest are known already.
            # In document order: neighbouring rows then repeat their identity, which compresses
            named = np.sort(order[new])
            known = np.zeros(len(owner), dtype=bool)
            known[order[several]] = True
            at = np.flatnonzero(known)
            brk = np.concatenate(([True], (np.diff(owner[at]) != 0) | (np.diff(start[at]) != 1))) if len(at) else []
            first = at[brk] if len(at) else at
            runs = np.diff(np.append(np.flatnonzero(brk), len(at))) if len(at) else at
            rows_at = np.concatenate((named, first)).astype(np.int64)
            n = np.concatenate((np.where(known[named], -1, 0), runs))
            run = np.concatenate((np.zeros(len(named), bool), np.ones(len(first), bool)))
            # a run is no window: it gets a key of its own, apart from the windows' keys
            key1, key2 = k1[rows_at], k2[rows_at]
            key1[run] ^= np.uint64(0xFFFFFFFFFFFFFFFF)
            who = pa.array(owner[rows_at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()).take(who), pa.array(hashes, pa.int64()).take(who),
                 pa.array(n.astype(np.int32)), pa.array(start[rows_at].astype(np.int32)),
                 pa.array(key1.view(np.int64)), pa.array(key2.view(np.int64))],
                names=["__id", "__h", "n", "at", "k1", "k2"])

    # n = 0: a window named once here; -1: one repeated here, told by a run; above: such a run of n
    found = d.mapInArrow(suspects, "__id bigint, __h bigint, n int, at int, k1 bigint, k2 bigint")
    times = F.count("*").over(Window.partitionBy("k1", "k2"))
    return found.withColumn("times", times) \
        .filter((F.col("n") > 0) | ((F.col("n") == 0) & (F.col("times") > 1))) \
        .select("__id", "__h", "at", F.greatest("n", F.lit(1)).alias("n"))


def _covered(n_words: int, starts: list, counts: list, window: int) -> np.ndarray:
    edge = np.zeros(n_words + 1, dtype=np.int64)
    if starts is not None and len(starts):
        s, c = np.asarray(starts, dtype=np.int64), np.asarray(counts, dtype=np.int64)
        np.add.at(edge, s, 1)
        np.add.at(edge, np.minimum(s + c + window - 1, n_words), -1)
    return np.cumsum(edge[:n_words]) > 0


def remove_repeated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW,
                    digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept STRING) of every row; ``kept`` is the SHA-256 of the kept text if ``digest``."""
    runs = repeated_starts(docs, text_col, id_col, window).groupBy("__id", "__h") \
        .agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    d = docs.select(F.col(id_col).alias("__own"), *_key(id_col, text_col), F.col(text_col).alias("__text"))
    rows = d.join(runs, ["__id", "__h"], "left") \
        .select("__own", "__text", F.col("runs.at").alias("at"), F.col("runs.n").alias("n"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n_words, n_removed, kept = [], [], []
            for t, at, n in zip(utf8(part.column(1)), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                w = t.split()
                gone = _covered(len(w), at, n, window)
                left = b" ".join(w if not gone.any() else [x for x, g in zip(w, gone.tolist(), strict=True) if not g])
                n_words.append(len(w))
                n_removed.append(int(gone.sum()))
                kept.append(hashlib.sha256(left).hexdigest().encode() if digest else left)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string(), safe=False)],
                names=[id_col, "n_words", "n_removed", "kept"])

    return rows.mapInArrow(apply, f"`{id_col}` {id_type}, n_words bigint, n_removed bigint, kept string")
