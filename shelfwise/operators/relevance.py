"""Which rows belong to which brand.

* prefix rule (search pages): ``sku`` starts with ``brand``, case-insensitive,
  not bounded by a word (``Nor`` also matches ``Nord ...``); the brand is
  literal text, never a LIKE pattern.
* portfolio rule (catalogue page): ``sku`` contains any brand, case-sensitive.

Brand lists are inputs (a Python list or a one-column DataFrame).
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Brands of a list (the driver's own) up to which their pieces are broadcast.
MOST_LISTED = 10_000


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def brand_prefix(sku: ColumnOrName, brand: ColumnOrName) -> Column:
    """``sku`` starts with ``brand`` ignoring case; NULL when either is NULL."""
    return F.startswith(F.lower(_col(sku)), F.lower(_col(brand)))


def brand_prefix_filter(rows: DataFrame, sku: str = "sku", brand: str = "brand") -> DataFrame:
    """Rows already tagged with their brand: keep those whose sku starts with it."""
    return rows.filter(brand_prefix(sku, brand))


def brands_frame(spark, brands: Sequence[str] | DataFrame, col: str = "brand") -> DataFrame:
    if isinstance(brands, DataFrame):
        return brands.select(F.col(brands.columns[0]).alias(col)) if col not in brands.columns else brands
    return spark.createDataFrame([(b, i) for i, b in enumerate(brands)], f"{col} string, ord int")


def brand_prefix_join(rows: DataFrame, brands: Sequence[str] | DataFrame, sku: str = "sku",
                      brand: str = "brand") -> DataFrame:
    """Untagged rows × brands where the sku starts with the brand (theta join made equi).

    Each row proposes its prefixes ``lower(sku)[:L]`` for the lengths L of the
    brands and is equi-joined to ``lower(brand)``. The result is exactly the theta join
    (a row matching two brands appears twice) without a nested loop: the brand
    side is broadcast while small (size known to the planner) and shuffled
    otherwise. The brand lengths are scalar subqueries, not a collect.
    """
    b = brands_frame(rows.sparkSession, brands, brand).select(brand)
    rows = rows.drop(brand)                     # the matched brand takes that name
    # empty brands are ignored (they would match every row)
    b = b.withColumn("__key", F.lower(F.col(brand))).filter(F.length("__key") >= 1)
    maxlen = b.select(F.max(F.length("__key"))).scalar()
    lengths = b.select(F.collect_set(F.length("__key"))).scalar()
    low = F.lower(F.col(sku))
    cand = rows.withColumn("__len", F.explode(F.sequence(F.lit(1), F.least(F.length(low), maxlen))))
    # only lengths some brand has, before anything is shuffled
    cand = cand.filter((F.col("__len") >= 1) & F.array_contains(lengths, F.col("__len")))
    cand = cand.withColumn("__key", F.substring(low, 1, F.col("__len")))
    joined = cand.join(b, on="__key", how="inner")
    return joined.drop("__key", "__len")


def portfolio_flag(sku: ColumnOrName, brands: Sequence[str]) -> Column:
    """1 when ``sku`` contains any brand (case-sensitive), else 0; NULL sku gives NULL."""
    arr = F.array(*[F.lit(b) for b in brands if b]).cast("array<string>")      # empty brands are ignored
    return F.exists(arr, lambda b: F.contains(_col(sku), b)).cast("int")


def portfolio_filter(rows: DataFrame, brands: Sequence[str], sku: str = "sku") -> DataFrame:
    """Rows outside the portfolio are skipped before any further work."""
    return rows.filter(portfolio_flag(sku, brands) == 1)


def _grams(text: ColumnOrName, q: int) -> Column:
    """The pieces of ``q`` characters of a text, in one pass over it."""
    return F.regexp_extract_all(_col(text), F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1))


def _wanted(rows: DataFrame, sku: str, index: DataFrame, pieces: Column) -> DataFrame:
    """(__k, ..): pieces of the texts that the index (column __gram, their hash) holds; no others leave their task."""
    cut = rows.select(F.xxhash64(sku).alias("__k"), F.explode(pieces).alias("__piece"))
    return cut.select("__k", F.xxhash64("__piece").alias("__gram")).join(index, "__gram")


def portfolio_semi_join(rows: DataFrame, brands: Sequence[str] | DataFrame, sku: str = "sku",
                        brand: str = "brand", q: int = 4) -> DataFrame:
    """Rows whose sku contains at least one brand (EXISTS), each row once; empty and NULL brands are ignored.

    One plan for any brand count. A brand of ``q`` characters or more is indexed by the
    rarest of its pieces of ``q`` in the skus (one that no sku holds: it matches nothing);
    a shorter one is its own piece. The skus propose only indexed pieces, told by a
    hash of the sku; the semi join on that hash verifies with ``contains``, which
    also settles equal hashes.
    """
    if isinstance(brands, DataFrame):
        b = brands_frame(rows.sparkSession, brands, brand).select(F.col(brand).alias("__b")) \
            .filter(F.length("__b") >= 1).distinct()
    else:                                       # a local relation: no job, and a size the planner knows
        b = rows.sparkSession.createDataFrame(pa.table({"__b": pa.array(dict.fromkeys(x for x in brands if x), pa.string())}))

    def small(df: DataFrame) -> DataFrame:
        # what comes of a list is bounded by the list; of a table, the planner knows or finds out
        return F.broadcast(df) if not isinstance(brands, DataFrame) and len(brands) <= MOST_LISTED else df

    long = b.filter(F.length("__b") >= q).select("__b", F.explode(F.array_distinct(_grams("__b", q))).alias("__piece")) \
        .select("__b", F.xxhash64("__piece").alias("__gram"))
    held = _wanted(rows, sku, small(long.select("__gram").distinct()), _grams(sku, q)).groupBy("__gram").agg(F.count("*").alias("__n"))
    rarest = long.join(small(held), "__gram", "left").groupBy("__b") \
        .agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("__n"), "__gram")).alias("__r")) \
        .filter(F.col("__r.__n") > 0).select(F.col("__r.__gram").alias("__gram"), "__b")
    index = b.filter(F.length("__b") < q).select(F.xxhash64("__b").alias("__gram"), "__b").unionByName(rarest)
    # only lengths that some brand asks for are cut out of the texts; they are a scalar subquery on the brands
    lengths = b.select(F.collect_set(F.least(F.length("__b"), F.lit(q)))).scalar()
    none = F.array().cast("array<string>")
    pieces = F.concat(*[F.when(F.array_contains(lengths, F.lit(n)), F.array_distinct(_grams(sku, n)) if n < q else _grams(sku, n))
                        .otherwise(none) for n in range(1, q + 1)])
    pairs = _wanted(rows, sku, small(index), pieces).select("__k", "__b").distinct()
    return rows.join(pairs, (F.xxhash64(rows[sku]) == pairs["__k"]) & F.contains(rows[sku], pairs["__b"]), "left_semi")
