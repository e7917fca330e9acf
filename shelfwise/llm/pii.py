"""Personal data by candidate gradient boosting.

Per text, in the scan task: the four strict patterns give the base spans, which
always stay. High-recall generators propose further, overlapping spans (anything
around an at sign or its written-out forms, and every run of digits with usual
separators). Each proposal gets format features (digits, groups, separators,
lengths) and context features (kind words before it, neighbouring characters);
boosted trees score it, and proposals at or above a calibrated threshold that
overlap no better span are added as ``email_like`` and ``number_like``.

Training: every proposal of every document, as feature rows with the number of
proposals each stands for. A proposal that a strict pattern confirms is a positive,
any other a negative; features that restate a strict rule (checksum, leading plus)
are left out, so the trees learn what personal data looks like around them. Trees
split at up to 25 quantiles of a feature, so rows go by their places between those
and a level of a tree is one sum per (node, feature, place) over the distinct rows,
in whole numbers, so that no order of tasks changes it. The threshold of a kind is
the smallest log-odds whose precision on documents held out of the fit (a quarter by
hash, one at least of each kind), with all above it, reaches ``precision``, however
few they are; if none does, the kind adds nothing. A caller may ask for fewer
documents (``sample_docs`` of each kind, by hash); the queries take all.

All matching is linear in the text's length (the email and ip patterns are
anchored so that long runs are not retried at each character).

Defined cases: NULL text is empty (no span); repeated rows get equal spans;
overlapping base spans of different kinds are all kept; an empty table or a
table without positives adds no spans; other columns are not read. Redaction
replaces the union of overlapping spans once, by the first kind's tag.
"""

from __future__ import annotations

import functools
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .common import slices

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds of the contract in their order, then the added ones.
KINDS = ("email", "ip", "card", "phone", "email_like", "number_like")
BASE_KINDS = KINDS[:4]
CONTEXT_WORDS = (("mail", "contact", "write"), ("phone", "call", "tel", "mobile"), ("card", "visa", "account", "pay"),
                 ("ip", "address", "host", "server"), ("ssn", "passport", "id ", "number"))
PRECISION = 0.98
HELD = 0.25                # share of the documents that the fit does not see
BINS = 26                  # places between at most 25 quantiles
CONTEXT = 32

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_AT = re.compile(r"(?:\x20?(?:\(at\)|\[at\])\x20?|@)[A-Za-z0-9-]+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]+)+")
_LOOSE_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,18}(?![0-9A-Za-z])")
# Whether a text holds a proposal of the kind (JVM form of the two patterns).
_HOLDS = {4: r"[A-Za-z0-9._%+-](?:\x20?(?:\(at\)|\[at\])\x20?|@)[A-Za-z0-9-]++(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]",
          5: _LOOSE_NUMBER.pattern}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _before(text: str, at: int, least: int) -> int:
    """Start of the run of local-part characters that ends at ``at``, not before ``least``."""
    while at > least and text[at - 1] in _LOCAL:
        at -= 1
    return at


def _emails(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    end = 0
    for m in pattern.finditer(text):
        start = _before(text, m.start(), end)
        if start < m.start():
            end = m.end()
            yield start, end


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, stop) of the strict patterns, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text, _AT)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, stop) of the high-recall generators; they may overlap."""
    out = []
    if "@" in text or "(at)" in text or "[at]" in text:
        out += [(4, a, b) for a, b in _emails(text, _LOOSE_AT)]
    return out + [(5, *m.span()) for m in _LOOSE_NUMBER.finditer(text)]


def features(text: str, kind: int, start: int, stop: int) -> list[float]:
    s, ahead = text[start:stop], text[max(0, start - CONTEXT):start].lower()
    groups = re.findall(r"[0-9]+", s)
    seps = re.findall(r"[^0-9A-Za-z]", s.lstrip("+"))
    last = text[start - 1] if start else " "
    follow = text[stop] if stop < len(text) else " "
    return [float(x) for x in (
        kind, len(s), sum(map(len, groups)), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), len(seps), len(set(seps)), sum(c.isalpha() for c in s), s.count("."),
        s.count("-"), s.count(" "), "(" in s, last.isspace(), last.isalnum(), last in ".,;:", follow.isspace(),
        follow.isalnum(), follow in ".,;:", *(any(w in ahead for w in ws) for ws in CONTEXT_WORDS))]


class Trees:
    """Gradient-boosted regression trees for the logistic loss, grown level by level from sums over the rows.

    A tree maps node numbers (root 1, children 2n and 2n + 1) to (value,) or (value, feature, cut): left is
    at most the cut. While it is fitted, rows are places between quantiles and a cut is a place.
    """

    def __init__(self, rounds: int = 30, depth: int = 3, rate: float = 0.3, least: int = 10):
        self.rounds, self.depth, self.rate, self.least = rounds, depth, rate, least
        self.prior, self.trees = 0.0, []

    def fit(self, positives: int, total: int, sums: Callable[[Trees, dict, list[int]], np.ndarray]) -> Trees:
        """``sums(trees so far, growing tree, nodes)``: gradient, hessian and weight by [node, feature, place]."""
        p = min(max(positives / total, 1e-6), 1 - 1e-6)
        self.prior = float(np.log(p / (1 - p)))
        for _ in range(self.rounds):
            tree, nodes = {}, [1]
            while nodes:
                found = sums(self, tree, nodes)
                nodes = [child for node, s in zip(nodes, found, strict=True) for child in self._split(tree, node, s)]
            self.trees.append(tree)
        return self

    def _split(self, tree: dict, node: int, sums: np.ndarray) -> list[int]:
        """Sets the node's split and its children's values; the children that may split again."""
        gs, hs, ws = sums[0].sum(axis=0)
        tree.setdefault(node, (float(gs / (hs + 1.0)),))
        if ws < 2 * self.least:
            return []
        gl, hl, nl = np.moveaxis(np.cumsum(sums, axis=1)[:, :-1], 2, 0)
        gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
        gain[(nl < self.least) | (ws - nl < self.least)] = 0
        j, k = np.unravel_index(gain.argmax(), gain.shape)
        if gain[j, k] <= 1e-6:
            return []
        tree[node] = (*tree[node], int(j), int(k))
        tree[2 * node] = (float(gl[j, k] / (hl[j, k] + 1.0)),)
        tree[2 * node + 1] = (float((gs - gl[j, k]) / (hs - hl[j, k] + 1.0)),)
        return [n for n in (2 * node, 2 * node + 1) if n < 1 << self.depth]

    def at_values(self, cuts: list[np.ndarray]) -> Trees:
        """The fitted trees with the quantiles' values as cuts; places past a feature's last quantile hold nothing."""
        out = Trees(self.rounds, self.depth, self.rate, self.least)
        out.prior = self.prior
        out.trees = [{n: (t[0], t[1], float(cuts[t[1]][t[2]])) if len(t) > 1 else t for n, t in tree.items()}
                     for tree in self.trees]
        return out

    @staticmethod
    def quantiles(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
        order = np.argsort(values, kind="stable")
        share = np.cumsum(weight[order]) / weight.sum()
        return np.unique(values[order][np.searchsorted(share, np.linspace(0.02, 0.98, 25))])

    @staticmethod
    def place(tree: dict, x: np.ndarray) -> np.ndarray:
        """The node of each row, as far as the tree is grown."""
        node = np.ones(len(x), np.int64)
        for n in sorted(tree):
            if len(tree[n]) > 1:
                at = np.flatnonzero(node == n)
                node[at] = 2 * n + (x[at, tree[n][1]] > tree[n][2])
        return node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds, added up in a fixed order: equal rows score equal to the last bit."""
        f = np.full(len(x), self.prior)
        for tree in self.trees:
            value = np.zeros(1 << (self.depth + 1))
            value[list(tree)] = [t[0] for t in tree.values()]
            f += self.rate * value[self.place(tree, x)]
        return f


def _confirmed(span: tuple[int, int, int], base: list[tuple[int, int, int]]) -> bool:
    return any(a < span[2] and span[1] < b for _, a, b in base)


def _feature_rows(texts: DataFrame, text_col: str, at: Column, apart: Column, share: dict[int, float],
                  below: dict[int, float]) -> DataFrame:
    """(kind, x, y, held, n, apart): the different feature rows of the proposals, written. A document is held out
    for a kind when its number is under the kind's ``below``; ``apart`` is the smallest such number of a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n, low = Counter(), {}
            for text, own, other in zip(*(c.to_pylist() for c in part.columns), strict=True):
                spans = [p for p in proposals(text) if own < share[p[0]]]
                base = base_spans(text) if spans else []
                for span in spans:
                    key = (span[0], tuple(features(text, *span)), _confirmed(span, base), other < below[span[0]])
                    n[key] += 1
                    low[key] = min(other, low.get(key, 1.0))
            kind, x, y, held = zip(*n, strict=True) if n else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.bool_()),
                 pa.array(held, pa.bool_()), pa.array(list(n.values()), pa.int64()), pa.array([low[k] for k in n], pa.float64())],
                names=["kind", "x", "y", "held", "n", "apart"])

    return common.written(
        texts.select(text_col, at.alias("at"), apart.alias("apart"))
        .mapInArrow(run, "kind int, x array<double>, y boolean, held boolean, n bigint, apart double")
        .groupBy("kind", "x", "y", "held").agg(F.sum("n").alias("n"), F.min("apart").alias("apart")), "pii-rows")


def _placed(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(kind, places BINARY, y, held, n): the rows that differ in their places between the cuts, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = np.array(part.column(1).to_pylist()).reshape(-1, len(cuts))
            at = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in at], pa.binary()),
                                              *part.columns[2:]], names=["kind", "places", "y", "held", "n"])

    return common.written(
        rows.select("kind", "x", "y", "held", "n")
        .mapInArrow(run, "kind int, places binary, y boolean, held boolean, n bigint")
        .groupBy("kind", "places", "y", "held").agg(F.sum("n").alias("n")), "pii-places")


def _places(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _sums(rows: DataFrame, width: int, total: int) -> Callable[[Trees, dict, list[int]], np.ndarray]:
    """The sums that a level of a tree needs: added up in the tasks, then by cell."""
    scale = float(1 << (52 - total.bit_length()))       # sums of whole numbers below 2 ** 53 are exact in any order

    def sums(trees: Trees, tree: dict, nodes: list[int]) -> np.ndarray:
        size = width * BINS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, number = np.zeros((3, len(nodes) * size)), np.full(1 << (trees.depth + 1), -1)
            number[nodes] = range(len(nodes))
            for part in batches:
                x, y, n = _places(part.column(0), width), *(c.to_numpy(zero_copy_only=False) for c in part.columns[1:])
                node = number[trees.place(tree, x)]
                x, y, n, node = (c[node >= 0] for c in (x, y, n, node))
                prob = 1 / (1 + np.exp(-trees.score(x)))
                cell = (node[:, None] * size + np.arange(width) * BINS + x).ravel()
                for out, v in zip(found, (np.rint((y - prob) * n * scale), np.rint(prob * (1 - prob) * n * scale), n), strict=True):
                    out += np.bincount(cell, np.repeat(v, width), len(out))
            cell = np.flatnonzero(found.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(cell), *(pa.array(f[cell].astype(np.int64)) for f in found)],
                                             names=["cell", "g", "h", "w"])

        # a few thousand cells a level; few reducers, as each level is a job of its own
        cells = rows.mapInArrow(run, "cell bigint, g bigint, h bigint, w bigint").repartition(4, "cell").groupBy("cell") \
            .agg(*[F.sum(c) for c in "ghw"]).collect()
        out = np.zeros((len(nodes) * size, 3))
        for cell, *ghw in cells:
            out[cell] = ghw
        return out.reshape(len(nodes), width, BINS, 3) / (scale, scale, 1)

    return sums


def _limits(rows: DataFrame, trees: Trees, width: int, precision: float) -> dict[int, float]:
    """Each kind's smallest log-odds at which held-out rows keep the precision: sums by ranges of log-odds, then inside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(trees.score(_places(part.column(3), width)))],
                                             names=["kind", "n", "good", "odds"])

    scored = rows.select("kind", "n", F.when(F.col("y"), F.col("n")).otherwise(0).alias("good"), "places") \
        .mapInArrow(run, "kind int, n bigint, good bigint, odds double").groupBy("kind", "odds") \
        .agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    ranges = common.written(scored.repartitionByRange("kind", F.desc("odds")).withColumn("range", F.spark_partition_id()),
                            "pii-odds")
    # the ranges of a kind run down its log-odds; a row for each range
    per = ranges.groupBy("kind", "range").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    above = Window.partitionBy("kind").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("kind", "range", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "good")])
    inside = Window.partitionBy("kind", "range").orderBy(F.desc("odds"))
    found = ranges.join(per, ["kind", "range"]).withColumns(
        {c: F.sum(c).over(inside) + F.col(f"{c}_above") for c in ("n", "good")}) \
        .filter(F.col("good") >= precision * F.col("n")).groupBy("kind").agg(F.min("odds")).collect()
    return {4: np.inf, 5: np.inf} | {kind: odds for kind, odds in found}


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample_docs: int | None = None,
          precision: float = PRECISION) -> tuple[Trees, dict[int, float]] | None:
    """The trees and the threshold of each added kind; None when the fit has no positive or no negative.
    ``sample_docs``: about so many documents that hold a proposal of a kind, instead of all."""
    texts = docs.filter(F.col(text_col).isNotNull())
    at, apart = (common.hash_fraction(F.struct(id_col, text_col), seed) for seed in (7, 8))
    share = dict.fromkeys(_HOLDS, 1.0)
    if sample_docs is not None:
        holds = {kind: F.regexp_like(text_col, F.lit(p)) for kind, p in _HOLDS.items()}
        of = texts.agg(*[F.count(F.when(h, 1)).alias(f"n{kind}") for kind, h in holds.items()]).first()
        share = {kind: sample_docs / max(1, of[f"n{kind}"]) for kind in holds}
        texts = texts.filter(functools.reduce(lambda a, b: a | b, [(at < n) & holds[kind] for kind, n in share.items()]))
    below = dict.fromkeys(_HOLDS, HELD)
    rows = _feature_rows(texts, text_col, at, apart, share, below)
    # a kind that no document was held out for (it has very few) holds out the one of the smallest number
    bare = [r for r in rows.groupBy("kind").agg(F.max("held").alias("held"), F.min("apart").alias("low")).collect() if not r.held]
    if bare:
        below |= {r.kind: float(np.nextafter(r.low, 1)) for r in bare}
        rows = _feature_rows(texts, text_col, at, apart, share, below)
    fit = rows.filter(~F.col("held"))
    n = {r.y: r.n for r in fit.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if len(n) < 2:
        return None
    # different values of a feature: lengths and counts, of which a table of N characters has at most about sqrt(2 N)
    values = fit.select("n", F.posexplode("x")).groupBy("pos", "col").agg(F.sum("n").alias("n")).toPandas()
    cuts = [Trees.quantiles(v["col"].to_numpy(), v["n"].to_numpy(dtype=float)) for _, v in values.groupby("pos")]
    placed = _placed(rows, cuts)
    total = sum(n.values())
    trees = Trees().fit(n[True], total, _sums(placed.filter(~F.col("held")).select("places", "y", "n"), len(cuts), total))
    return trees.at_values(cuts), _limits(placed.filter("held"), trees, len(cuts), precision)


def find_spans(text: str, model: tuple[Trees, dict[int, float]] | None) -> list[tuple[int, int, int]]:
    """All spans (kind number, start, stop): base ones, then accepted proposals."""
    base = base_spans(text)
    if model is None:
        return base
    trees, limits = model
    more = [p for p in proposals(text) if not _confirmed(p, base)]
    if more:
        score = trees.score(np.array([features(text, *p) for p in more]))
        taken: list[tuple[int, int, int]] = []
        for i in np.argsort(-score, kind="stable"):
            if score[i] >= limits[more[i][0]] and not _confirmed(more[i], taken):
                taken.append(more[i])
        base = base + sorted(taken)
    return base


def scan(docs: DataFrame, model: tuple[Trees, dict[int, float]] | None, text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``spans`` ARRAY<STRUCT<kind, start, stop>>, code points, of every row."""
    keep = ["doc_id"] if keep is None else keep
    kept = docs.select(*keep)
    # a few kilobytes of trees, as plain values
    shared = docs.sparkSession.sparkContext.broadcast(
        None if model is None else (model[0].prior, model[0].rate, model[0].trees, model[1]))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        if shared.value is not None:
            trees = Trees(rate=shared.value[1])
            trees.prior, trees.trees = shared.value[0], shared.value[2]
            held = (trees, shared.value[3])
        for part in slices(batches):
            found = [[{"kind": KINDS[k], "start": a, "stop": b} for k, a, b in find_spans(t or "", held)]
                     for t in part.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))]
                                             + [pa.array(found, pa.list_(span))], names=[*keep, "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(
        run, f"{fields}, spans array<struct<kind: string, start: int, stop: int>>")


def redact(docs: DataFrame, model: tuple[Trees, dict[int, float]] | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind's tag; all columns stay."""
    text = F.col(f"__row.{text_col}")
    found = scan(docs.select(F.struct("*").alias("__row"), text_col), model, text_col, keep=["__row"])
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    spans = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["stop"], s["kind"])))
    walked = F.aggregate(spans, empty, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["stop"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(
            text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
        .otherwise(acc["out"]).alias("out")))
    clean = common.let(walked, lambda w: F.concat(w["out"], F.substring(text, w["at"] + 1, F.char_length(text))))
    return found.select(*[
        F.when(F.size("spans") > 0, clean).otherwise(text).alias(c) if c == text_col else F.col("__row")[c].alias(c)
        for c in docs.columns])
