"""Language identification by prediction by partial matching (PPM).

Per language a variable-order byte context tree (orders 0 to 3) is counted over
every labelled text and then frozen. A text's score under a
language is its exact code length: each byte costs the code length of its
longest known context; a byte unseen there pays that context's escape and
falls back one order, down to a uniform order -1. Escape probabilities are
those of method C: with ``n`` occurrences of ``d`` different bytes in a context,
a byte seen ``c`` times has c / (n + d), the escape d / (n + d).

Frozen statistics make the code length of a (context, byte) pair a constant, so
the trees are laid out as tables (all order-2 contexts dense, and for the order-3
contexts seen at least ``min_context`` times the bytes seen there) and a text is
scored by gathers and sums in numpy, any length in bounded chunks.

Texts are read as lower-cased letters, every run of other characters being one
space; thus digits, marks and layout say nothing about the language.

``score`` is the posterior of the predicted language (equal priors, code length
per letter scaled by ``sharpness`` so that long texts do not saturate at once).
``known`` is false when a single order-0 model of all languages codes the text
shorter than the best language does, by more than ``slack_bits``: text of no
learned language.

Training counts every byte of every labelled text with a letter, in the tasks; the
driver and the workers hold the different 4-byte grams of each language (16 bytes
each), whose number grows with the vocabulary and not with the rows. The number of
languages is at most ``max_langs`` (an error beyond, nothing is dropped silently).

A caller may ask for a sample (``sample_bytes``; the queries take all): about so
much text per language, in pieces of ``PIECE_CHARS`` characters (by a hash of id,
text and piece number). A long text then counts for at most ``ROW_BYTES`` of its
language's bytes, or for more where that would leave the sample short. A language
whose pieces were all passed over gives its piece of the smallest hash that holds a
letter, so every label on a text with a letter is learned.

Defined cases: NULL text or text without a letter gives ``und``, score 0; ties
go to the alphabetically first language; no labelled text at all gives ``und``
for every row; repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNDETERMINED = "und"
PIECE_CHARS = 4096
ROW_BYTES = 65_536
MIN_CONTEXT = 8
MAX_LANGS = 200
SHARPNESS = 16.0
SLACK_BITS = 64.0
MAX_PIECE = 1 << 22
SPACE = 32


def folded(c: Column) -> Column:
    """Lower-cased letters, each run of anything else one space (JVM)."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}]+", " ")


def has_letter(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(r"\p{L}")), F.lit(False))


def count_grams(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, gram BIGINT, n BIGINT): 4-byte grams, the three bytes before (spaces before a text) and each byte."""
    def counted(by: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in by.items():
            data = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
            g = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
            # positions whose last byte is context of the next part are no byte of a text
            own = np.ones(len(g), dtype=bool)
            starts = np.cumsum([len(p) for p in parts])[:-1]
            for k in (1, 2, 3):
                own[starts - k] = False
            g, n = np.unique(g[own], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(g)), pa.array(g.astype(np.int64)), pa.array(n)],
                                             names=["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, size = {}, 0
        for part in slices(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                padded = b"   " + text
                for lo in range(0, len(text), MAX_PIECE):
                    by.setdefault(lang, []).append(padded[lo:lo + MAX_PIECE + 3])
                    size += len(by[lang][-1])
                    if size >= MAX_PIECE:
                        yield from counted(by)
                        by, size = {}, 0
        yield from counted(by)

    grams = docs.select(lang_col, text_col).mapInArrow(run, "lang string, gram bigint, n bigint")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """The frozen context trees of all languages as tables of code lengths (bits)."""

    def __init__(self, langs: list[str], grams: dict[str, tuple[np.ndarray, np.ndarray]], min_context: int):
        self.langs = langs
        seen = np.unique(np.concatenate([np.unique((g >> s) & 255) for g, _ in grams.values() for s in (0, 8, 16, 24)]
                                        + [np.array([SPACE])]))
        w = self.width = len(seen) + 1                      # symbol 0: a byte never seen in training
        self.symbol = np.zeros(256, dtype=np.int64)
        self.symbol[seen] = np.arange(1, w)
        n_l = len(langs)
        self.order2 = np.empty((n_l, w ** 3), dtype=np.float32)

        def counts(lang: str) -> tuple[list[np.ndarray], np.ndarray]:
            """The grams' symbols, built anew each time: only one language's are held."""
            g, n = grams[lang]
            return [self.symbol[(g >> k) & 255] for k in (24, 16, 8, 0)], n

        total = np.zeros(w)
        # order-3 contexts common to the tables: seen often enough in some language
        ctx_n = np.zeros(w ** 3, dtype=np.int64)
        for lang in langs:
            s, n = counts(lang)
            total += np.bincount(s[3], n, w)
            c = np.bincount((s[0] * w + s[1]) * w + s[2], n, w ** 3).astype(np.int64)
            np.maximum(ctx_n, c, out=ctx_n)
        kept = np.flatnonzero(ctx_n >= min_context)
        self.context = np.full(w ** 3, -1, dtype=np.int32)
        self.context[kept] = np.arange(len(kept))
        # the bytes that some language has after a common context, by context, then byte; rank: place there, from 1
        def cells(s: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = self.context[(s[0] * w + s[1]) * w + s[2]].astype(np.int64)
            return (at * w + s[3])[at >= 0], n[at >= 0]

        pairs = np.empty(0, dtype=np.int64)
        for lang in langs:
            pairs = np.union1d(pairs, cells(*counts(lang))[0])
        row = pairs // w
        self.first = np.searchsorted(pairs, np.arange(len(kept)) * w)
        self.rank = np.zeros(len(kept) * w, dtype=np.uint8)
        self.rank[pairs] = np.arange(len(pairs)) - self.first[row] + 1
        self.order3 = np.empty((n_l, len(pairs)), dtype=np.float32)
        self.escape = np.empty((n_l, len(kept)), dtype=np.float32)
        uniform = np.full(w, np.log2(256.0))
        self.order0 = self._code(total[None, :], uniform[None, :])[0].astype(np.float32)
        for i, lang in enumerate(langs):
            s, n = counts(lang)
            c0 = np.bincount(s[3], n, w)[None, :]
            b0 = self._code(c0, uniform[None, :])
            c1 = np.bincount(s[2] * w + s[3], n, w * w).reshape(w, w)
            b1 = self._code(c1, np.broadcast_to(b0, (w, w)))
            c2 = np.bincount((s[1] * w + s[2]) * w + s[3], n, w ** 3).reshape(w * w, w)
            b2 = self._code(c2, np.tile(b1, (w, 1)))
            self.order2[i] = b2.reshape(-1)
            cell, n = cells(s, n)
            c3 = np.bincount(np.searchsorted(pairs, cell), n, len(pairs))
            seen3, kinds3 = np.bincount(row, c3, len(kept)), np.bincount(row, c3 > 0, len(kept))
            with np.errstate(divide="ignore", invalid="ignore"):
                whole = np.log2(seen3 + kinds3)
                escape = np.where(seen3 > 0, whole - np.log2(kinds3), 0)
                self.order3[i] = np.where(c3 > 0, whole[row] - np.log2(c3), escape[row] + b2[kept[row] % (w * w), pairs % w])
            self.escape[i] = escape

    @staticmethod
    def _code(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Bits of every byte in each context (rows); unseen bytes pay the escape and the order below."""
        n = counts.sum(axis=1, keepdims=True)
        d = (counts > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.log2(n + d) - np.log2(counts)
            escape = np.log2(n + d) - np.log2(d)
            out = np.where(counts > 0, own, escape + below)
        return np.where(n > 0, out, below)               # a context never seen costs nothing to leave

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of every text under every language, and under order 0 (last column)."""
        pad = b"   "
        out = np.zeros((len(texts), len(self.langs) + 1))
        for group in _pieces(texts):
            data = np.frombuffer(b"".join(pad + p for _, p in group), dtype=np.uint8)
            ends = np.cumsum([len(p) + 3 for _, p in group])
            starts = np.concatenate(([0], ends[:-1]))
            sym, w = self.symbol[data], self.width
            n = len(sym) - 3
            if n <= 0:
                continue
            g2 = (sym[1:n + 1] * w + sym[2:n + 2]) * w + sym[3:]
            ctx = self.context[(sym[:n] * w + sym[1:n + 1]) * w + sym[2:n + 2]]
            deep = np.flatnonzero(ctx >= 0)
            rank = self.rank[ctx[deep].astype(np.int64) * w + sym[3:][deep]]
            met, unmet = deep[rank > 0], deep[rank == 0]
            at3 = self.first[ctx[met]] + rank[rank > 0] - 1
            # positions that begin in the padding of the next text are not code of any text
            valid = np.ones(n, dtype=bool)
            for k in (1, 2, 3):
                inner = starts[1:] - k
                valid[inner[inner >= 0]] = False
            owner = [i for i, _ in group]
            for j in range(len(self.langs)):
                bits = self.order2[j][g2]
                bits[met] = self.order3[j][at3]
                bits[unmet] += self.escape[j][ctx[unmet]]
                bits[~valid] = 0
                np.add.at(out[:, j], owner, np.add.reduceat(bits, np.minimum(starts, n - 1), dtype=np.float64)
                          * (starts < n))
            bits = self.order0[sym[3:]]
            bits[~valid] = 0
            np.add.at(out[:, -1], owner, np.add.reduceat(bits, np.minimum(starts, n - 1), dtype=np.float64)
                      * (starts < n))
        return out


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Groups of (text number, bytes) of bounded total size; a longer text comes in pieces."""
    group, held = [], 0
    for i, t in enumerate(texts):
        for lo in range(0, len(t), MAX_PIECE):
            piece = t[lo:lo + MAX_PIECE]
            group.append((i, piece))
            held += len(piece)
            if held >= MAX_PIECE:
                yield group
                group, held = [], 0
    if group:
        yield group


def _trees(held: dict) -> Trees | None:
    """The tables, built once per worker process and kept beside the broadcast counts."""
    if held["trees"] is None and held["model"]:
        held["trees"] = Trees([p[0] for p in held["model"]], {
            p[0]: (np.frombuffer(p[1], np.int64), np.frombuffer(p[2], np.int64)) for p in held["model"]},
            held["min_context"])
    return held["trees"]


def row_cap(groups: list[tuple[int, int]], sample_bytes: int) -> float:
    """The most bytes one row counts for, of (rows, bytes) of texts of like size: the cap that still fills the sample."""
    left, rows = float(sample_bytes), sum(n for n, _ in groups)
    for n, size in sorted(groups, key=lambda g: g[1] / g[0]):
        if size / n * rows >= left:
            return max(float(ROW_BYTES), left / rows)
        left, rows = left - size, rows - n
    return float("inf")


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          sample_bytes: int | None = None, max_langs: int = MAX_LANGS) -> tuple:
    """The packed gram counts per language, from every text; ``sample_bytes``: from about so much text of each, instead."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if sample_bytes is not None:
        return _train_sampled(known, lang_col, text_col, id_col, sample_bytes, max_langs)
    texts = known.filter(has_letter(F.col(text_col))).select(F.col(lang_col).alias("lang"), folded(F.col(text_col)).alias("text"))
    counts = common.written(count_grams(texts, "lang", "text"), "lang-grams")
    if counts.select("lang").distinct().limit(max_langs + 1).count() > max_langs:
        raise ValueError(f"more than {max_langs} languages; raise max_langs")
    return tuple(sorted(_packed(counts)))


def _train_sampled(known: DataFrame, lang_col: str, text_col: str, id_col: str, sample_bytes: int, max_langs: int) -> tuple:
    size = F.octet_length(text_col)
    # at most 32 sizes of text a language
    sizes = known.groupBy(lang_col, F.length(F.bin(size)).alias("scale")).agg(
        F.count("*"), F.sum(size), F.max(has_letter(F.col(text_col)))).limit(32 * max_langs + 1).collect()
    groups: dict[str, list[tuple[int, int]]] = {}
    for lang, _, n, total, _ in sizes:
        groups.setdefault(lang, []).append((n, total))
    if len(groups) > max_langs:
        raise ValueError(f"more than {max_langs} languages; raise max_langs")
    if not groups:
        return ()
    cap = {lang: min(row_cap(g, sample_bytes), float(1 << 40)) for lang, g in groups.items()}
    share = {lang: min(1.0, sample_bytes / max(1.0, sum(n * min(total / n, cap[lang]) for n, total in g)))
             for lang, g in groups.items()}

    def of_lang(values: dict[str, float]) -> Column:
        return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col(lang_col)]

    part = of_lang(share) * F.least(F.lit(1.0), of_lang(cap) / F.greatest(F.lit(1), size))
    last = F.floor((F.greatest(F.lit(1), F.char_length(text_col)) - 1) / PIECE_CHARS).cast("int")
    rows = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("whole"), part.alias("part"),
                        F.xxhash64(F.struct(id_col, text_col), F.lit(11)).alias("h"), last.alias("last"))

    def pieces(df: DataFrame, numbers: Column) -> DataFrame:
        return df.withColumn("i", F.explode(numbers)).select("lang", "h", "i", F.substring(
            "whole", F.col("i") * PIECE_CHARS + 1, F.lit(PIECE_CHARS)).alias("text")).filter(has_letter(F.col("text")))

    numbers = F.sequence(F.lit(0), F.col("last"))
    taken = F.filter(numbers, lambda i: common.hash_fraction(F.struct(F.col("h"), i)) < F.col("part"))
    counts = count_grams(pieces(rows, taken).select("lang", folded(F.col("text")).alias("text")), "lang", "text")
    model = _packed(counts)
    missing = {r[0] for r in sizes if r[4]} - {r[0] for r in model}
    if missing:
        left = rows.filter(F.col("lang").isin(*missing))
        one = pieces(left, numbers).groupBy("lang").agg(F.min_by("text", F.struct(F.xxhash64("h", "i"), "text")).alias("text"))
        model += _packed(count_grams(one.select("lang", folded(F.col("text")).alias("text")), "lang", "text"))
    return tuple(sorted(model))


def _packed(counts: DataFrame) -> list[tuple[str, bytes, bytes]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            langs, gram, n = np.array(part.column(0).to_pylist(), dtype=object), part.column(1).to_numpy(), part.column(2).to_numpy()
            names = sorted(set(langs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([v[langs == lang].tobytes() for lang in names], pa.binary())
                                                 for v in (gram, n))], names=["lang", "gram", "n"])

    found: dict[str, list[tuple[bytes, bytes]]] = {}
    for lang, gram, n in counts.select("lang", "gram", "n").mapInArrow(run, "lang string, gram binary, n binary").collect():
        found.setdefault(lang, []).append((gram, n))
    rows = []
    for lang, parts in found.items():
        gram, n = (np.frombuffer(b"".join(p), np.int64) for p in zip(*parts, strict=True))
        order = np.argsort(gram)
        rows.append((lang, gram[order].tobytes(), n[order].tobytes()))
    return rows


def predict(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None, min_context: int = MIN_CONTEXT) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score``, ``known`` and ``bits`` (code length) for every row."""
    keep = [id_col] if keep is None else keep
    # the different grams of the languages
    shared = docs.sparkSession.sparkContext.broadcast({"model": model, "min_context": min_context, "trees": None})
    scored = docs.select(*keep, F.when(has_letter(F.col(text_col)), folded(F.col(text_col))).alias("__folded"))
    names = ["lang_pred", "score", "known", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(shared.value)
        for part in slices(batches):
            texts = part.column(len(keep)).cast(pa.binary()).to_pylist()
            n = len(texts)
            pred, score = [UNDETERMINED] * n, np.zeros(n)
            known, best_bits = np.zeros(n, dtype=bool), np.zeros(n)
            at = [i for i, t in enumerate(texts) if t is not None]
            if trees and at:
                bits = trees.lengths([texts[i] for i in at])
                letters = np.array([max(1, len(texts[i])) for i in at], dtype=float)
                own, flat = bits[:, :-1], bits[:, -1]
                best = own.argmin(axis=1)
                low = own[np.arange(len(at)), best]
                gap = (own - low[:, None]) / letters[:, None] * np.minimum(letters, SHARPNESS)[:, None]
                post = 1.0 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
                for k, i in enumerate(at):
                    pred[i] = trees.langs[best[k]]
                score[at], best_bits[at], known[at] = post, low, low <= flat + SLACK_BITS
            yield pa.RecordBatch.from_arrays(
                [part.column(k) for k in range(len(keep))]
                + [pa.array(pred), pa.array(score), pa.array(known), pa.array(best_bits)], names=[*keep, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return scored.mapInArrow(run, f"{fields}, lang_pred string, score double, known boolean, bits double")
