"""Quality classifier: naive Bayes support vectors (NB-SVM).

A text's features are indicators of byte n-grams: 1- to 4-grams of its character
classes (letters and digits folded, marks kept) and 3-grams of its lower-cased
bytes, hashed to ``2 ** BITS`` numbers; whole texts, in bounded chunks. Each
indicator is scaled by its log-count ratio between the classes; on the scaled,
length-normalised vectors a linear hinge-loss model is fitted by dual coordinate
descent. Scores are calibrated by a logistic fit on rows the model has not seen.

The fit uses a sample of about ``sample_rows`` labelled texts: labelled ids are
sampled by hash, then, where ids repeat, their different texts, again by hash.
Ids, labels and text hashes of the sample are broadcast (bounded by the
parameter), so texts do not move; the features of the sample meet in one task.
Every fourth sampled row is held for the calibration: neither the ratios nor the
fit see it. Scoring covers every row and is map-only.

Defined cases: NULL or empty text has no feature and scores by the intercept;
NULL labels are not learned; without labelled rows every score is 0.5, with one
class it is that class's share; repeated rows score alike and are learned once; ids
that repeat in the labels are learned with each label, ids that repeat with other
texts with each text; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import slices, utf8

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 16
SAMPLE_ROWS = 8000
EPOCHS = 12
COST = 1.0
CHUNK = 1 << 18

CLASS = np.arange(256, dtype=np.uint32)
CLASS[ord("a"):ord("z") + 1] = ord("a")
CLASS[ord("A"):ord("Z") + 1] = ord("A")
CLASS[ord("0"):ord("9") + 1] = ord("0")
CLASS[128:] = 128
LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8).astype(np.uint32)


def features(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Sorted feature numbers of a text; ``seen`` is a cleared scratch array of ``2 ** BITS`` flags."""
    shift = np.uint32(32 - BITS)
    data = np.frombuffer(text, dtype=np.uint8)
    for lo in range(0, len(data), CHUNK):
        part = data[lo:lo + CHUNK + 3]
        c, raw = CLASS[part], LOWER[part]
        g = np.zeros_like(c)
        for n in range(1, 5):
            if len(part) < n:
                break
            g = g[:len(part) - n + 1] * np.uint32(257) + c[n - 1:] + np.uint32(1)
            seen[(g * np.uint32(2654435761)) >> shift] = True
        if len(part) >= 3:
            t = (raw[:-2] << np.uint32(16)) + (raw[1:-1] << np.uint32(8)) + raw[2:] + np.uint32(0x5000000)
            seen[(t * np.uint32(2246822519)) >> shift] = True
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def _scratch() -> np.ndarray:
    return np.zeros(1 << BITS, dtype=bool)


def _log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Per feature, the log of its share of class 1's indicators over its share of class 0's (one added to each)."""
    counts = np.ones((2, 1 << BITS))
    for r, v in zip(rows, y, strict=True):
        counts[int(v > 0)][r] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, epochs: int, cost: float) -> np.ndarray:
    """Weights (last: intercept) of the L1-loss linear SVM on unit-length scaled rows."""
    w = np.zeros(len(scale) + 1)
    alpha = np.zeros(len(y))
    norm = [max(1e-12, float(np.sqrt((scale[r] ** 2).sum()))) for r in rows]
    order, rng = np.arange(len(y)), np.random.default_rng(0)
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            x = scale[rows[i]] / norm[i]
            q = float(x @ x) + 1.0
            g = y[i] * (float(w[rows[i]] @ x) + w[-1]) - 1.0
            new = min(max(alpha[i] - g / q, 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * x
                w[-1] += step
    return w


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the calibration, by Newton steps on smoothed targets.

    A step is halved until the loss falls, so that separable rows end at the finite best.
    """
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack((margin, np.ones(len(margin))), axis=1)
    ridge = np.array([1e-3, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((np.logaddexp(0, z) - t * z).sum() + (ridge * v * v).sum() / 2)

    v = np.array([0.0, np.log((pos + 1) / (neg + 1))])
    now = loss(v)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -500, 500)))
        g = x.T @ (p - t) + ridge * v
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(h, g)
        while (new := loss(v - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if now - new < 1e-9:
            break
        v, now = v - step, new
    return float(v[0]), float(v[1])


def _fit(sample: pd.DataFrame) -> dict:
    sample = sample.sort_values(["id", "h", "label"], kind="stable")
    y = np.where(sample["label"].to_numpy() > 0, 1.0, -1.0)
    rows = [np.asarray(r, dtype=np.int64) for r in sample["x"]]
    share = float((y > 0).mean())
    held = np.arange(len(y)) % 4 == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return {"scale": None, "share": share}
    train = np.flatnonzero(~held)
    ratio = _log_count_ratio([rows[i] for i in train], y[train])
    w = _dual_descent([rows[i] for i in train], ratio, y[train], EPOCHS, COST)
    model = {"scale": ratio.astype(np.float32), "w": (ratio * w[:-1]).astype(np.float32), "bias": float(w[-1])}
    margin = np.array([_margin(rows[i], model) for i in np.flatnonzero(held)])
    a, b = _logistic(margin, y[held])
    return model | {"a": a, "b": b, "share": share}


def _margin(x: np.ndarray, model: dict) -> float:
    if not len(x):
        return model["bias"]
    return float(model["w"][x].sum(dtype=np.float64)) / max(
        1e-12, float(np.sqrt((model["scale"][x].astype(np.float64) ** 2).sum()))) + model["bias"]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict:
    """The model, from about ``sample_rows`` labelled texts."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    picked = known.filter(common.hash_fraction(F.col("id"), 5) < share).distinct()
    # an id may repeat with any number of texts: sampled again by text; the broadcasts are bounded by sample_rows
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("__text"))
    several = common.written(texts.select("id", "h").join(F.broadcast(picked), "id").distinct(), "labelled")
    share = min(1.0, sample_rows / max(1, several.count()))
    chosen = several.filter(common.hash_fraction(F.struct("id", "h"), 6) < share)
    d = texts.join(F.broadcast(chosen), ["id", "h"]).select("id", "h", "label", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _scratch()
        for part in slices(batches):
            x = [features(t, seen) for t in utf8(part.column(3))]
            yield pa.RecordBatch.from_arrays([pa.array(part.column(0).to_pylist(), pa.int64()), part.column(1), part.column(2),
                                              pa.array(x, pa.list_(pa.int32()))], names=["id", "h", "label", "x"])

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        m = _fit(sample)
        blob = (lambda v: None if v is None else v.tobytes())
        return pd.DataFrame({"scale": [blob(m["scale"])], "w": [blob(m.get("w"))], "bias": [m.get("bias")],
                             "a": [m.get("a")], "b": [m.get("b")], "share": [m["share"]]})

    rows = d.mapInArrow(run, "id bigint, h bigint, label int, x array<int>").dropDuplicates(["id", "h", "label"])
    fitted = rows.groupBy(F.lit(1).alias("one")) \
        .applyInPandas(fit, "scale binary, w binary, bias double, a double, b double, share double").collect()
    if not fitted:
        return {"scale": None, "share": 0.5}
    m = fitted[0].asDict()
    for k in ("scale", "w"):
        m[k] = None if m[k] is None else np.frombuffer(m[k], np.float32)
    return m


def score(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``score`` in [0, 1] of every row."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)           # 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = shared.value, _scratch()
        for part in slices(batches):
            if m["scale"] is None:
                out = np.full(part.num_rows, m["share"])
            else:
                margin = np.array([_margin(features(t, seen), m) for t in utf8(part.column(len(keep)))])
                out = 1 / (1 + np.exp(-np.clip(m["a"] * margin + m["b"], -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [pa.array(out)],
                                             names=[*keep, "score"])

    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, f"{fields}, score double")


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)), F.lit(0))
