"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Inner product becomes distance: vectors are scaled by the largest norm M and
given one more component sqrt(1 - |x/M|^2); queries are scaled to length one with
a zero there, so the nearest vector is the one of largest inner product. Each of
``tables`` hash tables cuts ``hashes`` Gaussian (2-stable) projections into cells
of width ``width`` x sigma, where sigma is the typical distance of a near
neighbour, measured on a bounded sample. Every vector is in one bucket per table.

A query visits buckets in order of estimated success: with differences to a
neighbour normal of deviation sigma in each projection, a bucket's success
probability is a product of normal interval masses; probing stops when the
visited mass reaches ``mass``. Candidates of all visited buckets of all tables
are scored exactly (double precision, original vectors) and merged.

One sigma does not fit every query. The k-th distance found is an upper bound of
the true one, so a query whose k-th distance exceeds the sigma it was probed with
is probed once more with the next ``2^level`` x sigma that covers it, in tables
whose cells are as much wider. A query that found too few candidates, or whose
sigma would exceed ``SELECTIVE``, is scored against every vector instead.

Nothing is capped: a bucket's candidates and queries are cut into blocks of
about ``BLOCK`` rows, every block pair is scored, and each returns its best ``k``
per query, which loses nothing of the bucket's best ``k``. Equal vectors are one
vector in the index; its ``k + 1`` smallest ids stand for the rest, which can
never be among the ``k`` nearest (ties go to smaller ids).

Defined cases: NULL or empty vectors, zero vectors and vectors with NULL or
non-finite components take no part, neither as query nor as candidate; vectors
of another length are not comparable; rows that repeat id and vector count once;
a query with fewer candidates than ``k`` gets them all; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common
from .common import slices, written

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES = 4
HASHES = 3
WIDTH = 1.1
MASS = 0.6
BLOCK = 8192
SAMPLE_QUERIES = 256
SAMPLE_ROWS = 8192
REACH = 3.0                # cells further than this many sigma are not considered
SELECTIVE = 0.7            # cells wider than this (orthogonal vectors are 1.41 apart) part little
SPREAD = 32                # least number of parts of a comparison with every vector
SEED = 20


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def _projections(dim: int, tables: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """(tables, dim + 1, hashes) Gaussian directions and (tables, hashes) offsets in [0, 1) cells."""
    rng = np.random.default_rng((SEED, dim))
    return rng.standard_normal((tables, dim + 1, hashes)), rng.uniform(0, 1, (tables, hashes))


def _bucket(cells: np.ndarray, dim: int) -> np.ndarray:
    """One BIGINT per row of cell numbers (other buckets share it with probability 2^-63)."""
    h = np.full(len(cells), dim, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for c in cells.T:
            h = (h ^ c.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return (h >> np.uint64(1)).astype(np.int64)


def _mass_below(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in z.tolist()])


def probes(at: np.ndarray, width: float, sigma: float, mass: float) -> np.ndarray:
    """The cells a query visits in one table, in order of estimated success, up to ``mass`` of it.

    ``at``: the query's projections plus offsets, in units of the vectors.
    """
    grid = None
    axes = []
    for x in at:
        cells = np.arange(math.floor((x - REACH * sigma) / width), math.floor((x + REACH * sigma) / width) + 1)
        edges = _mass_below((np.append(cells, cells[-1] + 1) * width - x) / sigma)
        axes.append(cells)
        grid = np.diff(edges) if grid is None else np.multiply.outer(grid, np.diff(edges))
    flat = grid.ravel()
    order = np.argsort(-flat, kind="stable")
    n = min(int(np.searchsorted(np.cumsum(flat[order]), mass)) + 1, len(flat))
    where = np.unravel_index(order[:n], grid.shape)
    return np.stack([a[w] for a, w in zip(axes, where, strict=True)], axis=1)


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) of a list column, by vector length."""
    lists = column.to_pylist()
    sizes = np.array([len(v) for v in lists], dtype=np.int64)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield rows, np.array([lists[i] for i in rows], dtype=np.float64)


def _sigma(reps: DataFrame, queries: DataFrame, n: int, n_queries: int, k: int, top: float) -> float:
    """Typical distance of a k-th neighbour, from a bounded sample."""
    def sample(df: DataFrame, total: int, rows: int) -> pd.DataFrame:
        return df.filter(common.hash_fraction(F.col("vid"), 3) < min(1.0, rows / max(1, total))) \
            .select("vec").limit(2 * rows).toPandas()

    q, c = sample(queries, n_queries, SAMPLE_QUERIES), sample(reps, n, SAMPLE_ROWS)
    dims = [len(v) for v in c["vec"]]
    if q.empty or not dims:
        return 1.0
    dim = max(set(dims), key=dims.count)
    cs = np.array([v for v in c["vec"] if len(v) == dim], dtype=float) / top
    qs = np.array([v for v in q["vec"] if len(v) == dim], dtype=float).reshape(-1, dim)
    if not len(qs) or len(cs) < 2:
        return 1.0
    qs = qs / np.linalg.norm(qs, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(0, 2 - 2 * np.clip(qs @ cs.T, -1, 1)))
    rank = min(d.shape[1] - 1, max(1, round(k * len(cs) / max(1, n))))
    near = np.partition(d, rank, axis=1)[:, rank]
    return float(max(1e-3, np.median(near)))


def search(vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
           is_query: Column | None = None, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH,
           mass: float = MASS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of every query row of ``vectors``."""
    spark = vectors.sparkSession
    ask = F.col(id_col) % 20 == 0 if is_query is None else is_query
    rows = written(vectors.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("vec"),
        F.coalesce(ask, F.lit(False)).alias("ask")).distinct(), "vectors")
    by_vec = Window.partitionBy("vec").orderBy("id")
    low = rows.select("id", "vec").distinct().withColumn("nth", F.row_number().over(by_vec)).filter(F.col("nth") <= k + 1)
    # the smallest id names an equal-vector class; the k + 1 smallest ids of it can be results
    members = written(low.withColumn("vid", F.min("id").over(Window.partitionBy("vec"))), "members")
    reps = members.filter(F.col("nth") == 1).select("vid", "vec")
    asked = rows.filter("ask").select(F.col("id").alias("query_id"), "vec")
    asked = written(asked.join(reps, "vec").select("query_id", "vid", "vec"), "queries")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    n, top = reps.agg(F.count("*"), F.max(norm)).first()
    out = f"query_id {rows.schema['id'].dataType.simpleString()}, rank int, " \
          f"{id_col} {rows.schema['id'].dataType.simpleString()}, score double"
    if not n:
        return spark.createDataFrame([], out)
    queries = asked.groupBy("vid").agg(F.any_value("vec").alias("vec"))
    n_queries = queries.count()
    sigma = _sigma(reps, queries, n, n_queries, k, top)
    id_type = rows.schema["id"].dataType.simpleString()
    shape = f"t int, bucket bigint, vid {id_type}, vec array<double>"

    def index(levels: list[int]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                for at, x in _matrix(part.column(1)):
                    x = x / top
                    x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]])
                    a, b = _projections(x.shape[1] - 1, tables, hashes)
                    who = part.take(pa.array(at))
                    for t, level in itertools.product(range(tables), levels):
                        cells = np.floor(x @ a[t] / (width * sigma * 2 ** level) + b[t]).astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([level * tables + t] * len(at), pa.int32()),
                             pa.array(_bucket(cells, x.shape[1])), *who.columns], names=["t", "bucket", "vid", "vec"])

        return written(reps.mapInArrow(run, shape), "index")

    def visit(asking: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                level = part.column(2).to_numpy()
                for at, x in _matrix(part.column(1)):
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    x = np.hstack([x, np.zeros((len(x), 1))])
                    a, b = _projections(x.shape[1] - 1, tables, hashes)
                    own = sigma * 2.0 ** level[at]
                    for t in range(tables):
                        p = x @ a[t] + b[t] * (width * own)[:, None]
                        cells = [probes(q, width * o, o, mass) for q, o in zip(p, own, strict=True)]
                        rep = np.repeat(at, [len(c) for c in cells])
                        who = part.take(pa.array(rep))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(level[rep] * tables + t, pa.int32()),
                             pa.array(_bucket(np.concatenate(cells), x.shape[1])), who.column(0), who.column(1)],
                            names=["t", "bucket", "vid", "vec"])

        return written(asking.select("vid", "vec", "level").mapInArrow(run, shape), "probes")

    parts = max(SPREAD, -(-n // block))

    def every(df: DataFrame, part: Column) -> DataFrame:
        """Rows in one part of all vectors of their length."""
        return df.select(F.lit(-1).alias("t"), F.xxhash64(F.size("vec"), part).alias("bucket"), "vid", "vec")

    key = ["t", "bucket"]
    group = [*key, "ci", "qi"]

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        cols = {"qvid": [], "vid": [], "score": []}
        if len(q) and len(c):
            cv, ids = np.stack(c["vec"].to_numpy()), c["vid"].to_numpy()
            longest = np.linalg.norm(cv, axis=1).max()
            for lo in range(0, len(q), 256):
                qv = np.stack(q["vec"].iloc[lo:lo + 256].to_numpy())
                s = qv @ cv.T
                m = min(k + 1, s.shape[1])                       # one more for the query itself
                # all that rounding could put among the first m, every tie included
                slack = 4 * cv.shape[1] * np.finfo(float).eps * np.linalg.norm(qv, axis=1) * longest
                cut = np.partition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m] - slack
                for i, qid in enumerate(q["vid"].iloc[lo:lo + 256]):
                    near = np.flatnonzero(s[i] >= cut[i])
                    exact = (cv[near] * qv[i]).sum(axis=1)
                    order = np.lexsort((ids[near], -exact))[:k + 1]
                    cols["qvid"].append(np.full(len(order), qid))
                    cols["vid"].append(ids[near][order])
                    cols["score"].append(exact[order])
        return pd.DataFrame({n: np.concatenate(v) if v else np.empty(0) for n, v in cols.items()})

    per_query = Window.partitionBy("qvid").orderBy(F.desc("score"), "vid")

    def merged(scored: DataFrame) -> DataFrame:
        return scored.groupBy("qvid", "vid").agg(F.max("score").alias("score")) \
            .withColumn("nth", F.row_number().over(per_query)).filter(F.col("nth") <= k + 1).drop("nth")

    def compared(want: DataFrame, have: DataFrame) -> DataFrame:
        """The best of all pairs that share a bucket."""
        sizes = have.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("nc")) \
            .join(want.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("nq")), key)

        def dealt(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
            """Rows in their own block, once for each block of the other side."""
            return df.join(sizes, key).withColumn(mine, F.pmod(F.xxhash64("vid", F.lit(1)), F.col(own)).cast("int")) \
                .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1))) \
                .select(*key, "ci", "qi", "vid", "vec")

        return dealt(want, "nq", "nc", "qi", "ci").groupBy(*group).cogroup(
            dealt(have, "nc", "nq", "ci", "qi").groupBy(*group)).applyInPandas(
                best, f"qvid {id_type}, vid {id_type}, score double")

    near = written(merged(compared(visit(queries.withColumn("level", F.lit(0))), index([0]))), "near")
    # the score at which k + 1 members (one may be the query) are found; NULL if they are fewer
    upto = per_query.rowsBetween(Window.unboundedPreceding, 0)
    found = near.join(members.groupBy("vid").agg(F.count("*").alias("m")), "vid") \
        .withColumn("m", F.sum("m").over(upto)).groupBy(F.col("qvid").alias("vid")) \
        .agg(F.count("*").alias("n_found"), F.max(F.when(F.col("m") > k, F.col("score"))).alias("last"))
    alike = reps.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n_all"))
    away = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("last") / (norm * top)))
    level = F.ceil(F.log2(away / sigma)).cast("int")
    redo = written(
        queries.withColumn("dim", F.size("vec")).join(alike, "dim").join(found, "vid", "left")
        .filter(F.when(F.col("last").isNull(), F.coalesce("n_found", F.lit(0)) < F.col("n_all"))
                .otherwise(away > sigma * (1 + 1e-9)))
        .select("vid", "vec", F.when(sigma * F.pow(F.lit(2.0), level) <= SELECTIVE, level).otherwise(-1).alias("level")),
        "again")
    levels = sorted(r[0] for r in redo.select("level").distinct().collect())
    again = [near]
    if levels and levels[-1] >= 0:
        again.append(compared(visit(redo.filter(F.col("level") >= 0)), index([v for v in levels if v >= 0])))
    if levels and levels[0] < 0:
        all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        again.append(compared(
            every(redo.filter(F.col("level") < 0).withColumn("part", all_parts), F.col("part")),
            every(reps, F.pmod(F.xxhash64("vid", F.lit(2)), F.lit(parts)).cast("int"))))
    if levels:
        near = merged(functools.reduce(DataFrame.unionByName, again))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return asked.select("query_id", F.col("vid").alias("qvid")).join(near, "qvid") \
        .join(members.select("vid", F.col("id").alias(id_col)), "vid").filter(F.col(id_col) != F.col("query_id")) \
        .groupBy("query_id", id_col).agg(F.max("score").alias("score")) \
        .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", id_col, "score")
