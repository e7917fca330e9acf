"""Best-fit packing of tokenized documents into sequences, after Martello-Toth
dominance reduction.

1. Documents are tokenized inside the scan task. Documents longer than a sequence
   are cut into whole sequences, a shorter remainder first. Written to the shared
   folder.
2. The instance is the number of pieces of every length: at most ``capacity``
   numbers, whatever the table's size. On it ``reduce`` fixes, for a piece j, the
   set that dominates every other set that could hold j, in bulk:
   j alone if nothing fits beside it; j and k if they fill the sequence, or if k is
   the longest that fits and no two others do; j, k and b if no three others fit,
   k is the longest that fits, b the longest beside both, and no two pieces longer
   than b fit. Some best packing holds those sets, so they are permanent and the
   instance shrinks. ``best_fit`` packs the rest, longest first.
3. The plan (bounded by ``capacity`` too) says which ranks among the pieces of a
   length go to which sequences. Ranks are a task's own count plus the counts of
   the tasks before it, so a length that a third of all pieces share is not
   gathered anywhere.

Defined cases: NULL text is empty, an empty text is the end mark alone (one piece
of length 1); rows with equal or NULL ids are separate documents; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .common import slices, utf8, written

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
END = 0                    # the id that ends a document
# Fixed value: how byte-level BPE splits a text into words.
BYTE_LEVEL_WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it is visible Latin-1,
    else the characters from 256 on, in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of whole texts, as uint32 arrays.

    ``path`` is a file of the tokenizers library. Plain byte-level BPE whose merges make its ids in order is run by
    tiktoken on the same vocabulary (equal ids, several times faster); any other file, and a text that its regular
    expressions refuse (white space by the hundred thousand), by the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._fast()

    def _fast(self):
        import tiktoken
        spec = json.loads(self.tokenizer.to_str())
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special} if model["type"] == "BPE" else {}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        plain = (split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
                 and not spec["normalizer"] and not model.get("byte_fallback") and not model["ignore_merges"]
                 and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
                 and len(vocab) == 256 + len(pairs)
                 and [vocab.get(x + y) for x, y in pairs] == [*range(256, 256 + len(pairs))])
        if not plain:
            return None
        letters = _byte_letters()
        return tiktoken.Encoding("own", pat_str=BYTE_LEVEL_WORDS, special_tokens=special,
                                 mergeable_ranks={bytes(map(letters.__getitem__, t)): i for t, i in vocab.items()})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, rank): ``rank`` counts a task's pieces of that length.

    ``keep_ids`` adds the token ids (ARRAY<INT>).
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast({"path": tokenizer, "encoder": None})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value                                   # one encoder for all tasks of a worker process
        held["encoder"] = encoder = held["encoder"] or Encoder(held["path"])
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for part in slices(batches, 64):
            row, piece, start, length, crc, rank, ids = [], [], [], [], [], [], []
            for r, text in enumerate(utf8(part.column(1))):
                tokens = np.append(encoder.ids(text.decode("utf-8", "replace")), END).astype("<u4")
                for i, (s, n) in enumerate(cut(len(tokens), capacity)):
                    own = tokens[s:s + n]
                    row.append(r)
                    piece.append(i)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(own.tobytes()))
                    rank.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        ids.append(own.view("<i4"))
            columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                       pa.array([task] * len(row), pa.int32()), pa.array(rank, pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32", "task", "rank"]
            if keep_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"
        + (", ids array<int>" if keep_ids else ""))


def _smallest(count: np.ndarray, how_many: int, above: int = 0) -> int:
    """Sum of the ``how_many`` smallest sizes over ``above`` that are left; beyond any capacity if there are fewer."""
    total, left = 0, how_many
    for s in (np.flatnonzero(count[above + 1:]) + above + 1)[:how_many].tolist():
        n = min(left, int(count[s]))
        total, left = total + n * s, left - n
        if not left:
            break
    return total if not left else len(count)


def dominating(j: int, count: np.ndarray) -> tuple[int, ...] | None:
    """The set that dominates all others that could hold a piece of size j; None if these rules show none.

    ``count[s]`` is the number of other pieces of size s; index ``capacity`` is the largest.
    """
    room = len(count) - 1 - j
    fits = np.flatnonzero(count[1:room + 1]) + 1
    if not len(fits):
        return (j,)
    k = int(fits[-1])
    if k == room or _smallest(count, 2) > room:
        return j, k
    if _smallest(count, 3) > room:
        rest = count.copy()
        rest[k] -= 1
        beside = np.flatnonzero(rest[1:room - k + 1]) + 1
        if len(beside) and _smallest(count, 2, above=int(beside[-1])) > room:
            return j, k, int(beside[-1])
    return None


def reduce(count: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Dominating sets fixed for good, as (sizes with their numbers, number of sets); taken out of ``count``."""
    fixed, changed = [], True
    while changed:
        changed = False
        for j in range(len(count) - 1, 0, -1):
            while count[j]:
                count[j] -= 1
                found = dominating(j, count)
                count[j] += 1
                if found is None:
                    break
                sizes = [(s, found.count(s)) for s in dict.fromkeys(found)]
                n = min(int(count[s]) // m for s, m in sizes)      # the rules still hold as pieces go
                for s, m in sizes:
                    count[s] -= n * m
                fixed.append((sizes, n))
                changed = True
    return fixed


def best_fit(count: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit, longest first, of the pieces in ``count``; sequences filled alike are one entry."""
    capacity = len(count) - 1
    open_: list[list] = [[] for _ in range(capacity + 1)]          # by room left
    for s in range(capacity, 0, -1):
        left = int(count[s])
        room = s
        while left:
            while room <= capacity and not open_[room]:
                room += 1
            # the fullest sequence with room, or a new one; it takes pieces of this size while they fit
            sizes, n = open_[room].pop() if room <= capacity else ([], left)
            space = min(room, capacity)
            each = space // s
            whole = min(n, left // each)
            if whole:
                open_[space - each * s].append((sizes + [(s, each)], whole))
                left -= whole * each
            if whole < n and left < each:
                if left:
                    open_[space - left * s].append((sizes + [(s, left)], 1))
                    whole, left = whole + 1, 0
                if sizes and whole < n:
                    open_[space].append((sizes, n - whole))
    return [entry for entries in open_ for entry in entries]


def plan(count: np.ndarray) -> np.ndarray:
    """Rows (size, first rank, pieces of a sequence, first sequence, offset), sorted by size and rank."""
    count = count.copy()
    rows, used, sequence = [], {}, 0
    for sizes, n in [*reduce(count), *best_fit(count)]:
        offset = 0
        for s, m in sizes:
            rows.append((s, used.get(s, 0), m, sequence, offset))
            used[s] = used.get(s, 0) + n * m
            offset += s * m
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece; with ``ids`` if wanted."""
    spark = docs.sparkSession
    own = written(pieces(docs, tokenizer, id_col, text_col, capacity, keep_ids), "pieces")
    held = written(own.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    count = np.zeros(capacity + 1, dtype=np.int64)
    for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect():          # at most capacity rows
        count[r["length"]] = r["n"]
    places = spark.sparkContext.broadcast(plan(count))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    first = held.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = own.join(first, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before")) \
        .drop("before", "task")
    names = [c for c in ranked.columns if c != "rank"]
    out = [f"`{n}` {ranked.schema[n].dataType.simpleString()}" for n in names]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = places.value
        size_at = np.searchsorted(rows[:, 0], np.arange(capacity + 2))             # where a size's rows begin
        for batch in batches:
            size = batch.column(names.index("length")).to_numpy()
            rank = batch.column(len(names)).to_numpy()
            at = np.empty(len(size), dtype=np.int64)
            for s in np.unique(size).tolist():
                mine, lo, hi = size == s, size_at[s], size_at[s + 1]
                at[mine] = lo + np.searchsorted(rows[lo:hi, 1], rank[mine], "right") - 1
            _, begin, each, sequence, offset = rows[at].T
            n = rank - begin
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(sequence + n // each), pa.array(offset + n % each * size)],
                names=[*names, "sequence_id", "offset"])

    placed = ranked.select(*names, "rank").mapInArrow(place, ", ".join([*out, "sequence_id bigint", "offset bigint"]))
    ids = ["ids"] if keep_ids else []
    return placed.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *ids)
