"""Mixing sources to target weights by temperature (DataFrame functions only).

Source weights are the sources' token shares raised to an exponent and
normalised: 1 keeps the shares, 0 makes sources equal. The exponent is bisected
until the weights meet a target: an entropy (bits), or a repetition limit (no
source is read more than ``max_epochs`` times at the given budget; the smallest
exponent that keeps it). Each bisection round evaluates the inner points of its
bracket in one aggregate over the written source table and returns a handful of
numbers, so the number of sources is not limited.

The weights are realised as budgeted block permutations: a source with target
``t`` of its ``n`` tokens gives ``floor(t / n)`` whole epochs and, of one more
epoch, the documents in that epoch's pseudo-random order until the rest of its
budget is met. Every document copy has a place ``u`` in [0, 1) of the source's
schedule, hence a block (``floor(u * blocks)``) and an order inside it: each
block holds all sources at about the target weights.

A source's running token sum is taken in two levels (hash buckets, then inside a
bucket), so a source with a third of all rows is not one task. The cut of every
source is a small table; documents are never shuffled for it, they meet it in
the scan task (broadcast by the planner's size check).

Defined cases: NULL source is a source of its own; documents without tokens
(NULL or empty text) belong to no epoch's budget and are emitted once per whole
epoch; a source without tokens has weight 0 and is left out; ties in the
pseudo-random order fall back to the id, and rows equal in both are taken or
left together; an empty table gives no rows. Output columns are prefixed
``mix_``; existing columns of these names are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

TOKEN = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 4.0
BLOCKS = 64
BUCKETS = 1024
ORDER_BITS = 40
POINTS = 31              # inner points of a bracket: five bisections a round
ROUNDS = 9


def tokens(text: Column | str) -> Column:
    """Whitespace-separated words of a text, BIGINT (NULL: 0)."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(TOKEN)),
                      F.lit(0)).cast("bigint")


def place(id_col: str, epoch: int | Column, seed: int) -> Column:
    """The document's place in an epoch's permutation: a pseudo-random integer of ORDER_BITS bits."""
    e = F.lit(epoch) if isinstance(epoch, int) else epoch
    return F.pmod(F.xxhash64(F.col(id_col), e.cast("int"), F.lit(seed)), F.lit(1 << ORDER_BITS))


def _measures(sources: DataFrame, points: list[float], budget: float, largest: float) -> list[tuple[float, float]]:
    """(entropy in bits, most epochs of a source) of the weights at each exponent."""
    # shares relative to the largest source: no overflow at any exponent
    x = sources.select("n", (F.log("n") - F.lit(math.log(largest))).alias("x"))
    aggs = []
    for a in points:
        w = F.exp(F.col("x") * a)
        aggs += [F.sum(w), F.sum(w * F.col("x") * a), F.max(w / F.col("n"))]
    row = x.agg(*aggs).first()
    out = []
    for i in range(len(points)):
        z, wx, most = row[3 * i:3 * i + 3]
        out.append(((math.log(z) - wx / z) / math.log(2), most / z * budget))
    return out


def _largest(sources: DataFrame) -> float:
    return float(sources.agg(F.max("n")).first()[0])


def exponent(sources: DataFrame, budget: float, max_epochs: float | None = MAX_EPOCHS,
             entropy: float | None = None) -> float:
    """The exponent in [0, 1] that meets the target, by bisection.

    With ``entropy``: the largest exponent whose entropy reaches it (0 when even
    equal weights do not). Else: the smallest exponent at which no source exceeds
    ``max_epochs`` (1 when even the plain shares do).
    """
    lo, hi, largest = 0.0, 1.0, _largest(sources)

    def met(m: tuple[float, float]) -> bool:
        """Whether the target lies at or below this exponent."""
        return m[0] < entropy if entropy is not None else m[1] <= max_epochs

    ends = _measures(sources, [lo, hi], budget, largest)
    if met(ends[0]):
        return lo
    if not met(ends[1]):
        return hi
    for _ in range(ROUNDS):
        inner = [lo + (hi - lo) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
        states = _measures(sources, inner, budget, largest)
        cut = next((i for i, m in enumerate(states) if met(m)), POINTS)
        lo, hi = ([lo, *inner][cut], [*inner, hi][cut])
    return lo if entropy is not None else hi


def plan(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
         budget: float | None = None, max_epochs: float | None = MAX_EPOCHS, entropy: float | None = None,
         seed: int = 17) -> DataFrame:
    """One row per source: ``__source``, n (tokens), weight, target, epochs, cut_at, cut_id.

    A document copy of epoch ``e`` is taken when ``e < epochs``, or ``e ==
    epochs`` and its (place, id) is at most (cut_at, cut_id).
    """
    doc = docs.select(F.col(source_col).alias("__source"), F.col(id_col).alias("__id"), tokens(text_col).alias("t"))
    doc = written(doc, "mix-tokens")
    sources = written(doc.groupBy("__source").agg(F.sum("t").alias("n")).filter(F.col("n") > 0).coalesce(1),
                      "mix-sources")
    total = sources.agg(F.sum("n")).first()[0]
    if not total:
        return sources.select("__source", "n", *[F.lit(0.0).alias(c) for c in ("weight", "target")],
                              F.lit(0).cast("bigint").alias("epochs"), F.lit(0).cast("bigint").alias("cut_at"),
                              F.lit(None).cast(docs.schema[id_col].dataType).alias("cut_id"))
    budget = float(total if budget is None else budget)
    a = exponent(sources, budget, max_epochs, entropy)
    top = math.log(_largest(sources))
    raw = F.exp((F.log("n") - F.lit(top)) * F.lit(a))
    z = sources.agg(F.sum(raw)).first()[0]
    limit = F.col("n") * F.lit(float(max_epochs)) if max_epochs is not None else F.lit(float("inf"))
    goal = sources.withColumn("weight", raw / F.lit(z)) \
        .withColumn("target", F.least(F.col("weight") * F.lit(budget), limit)) \
        .withColumn("epochs", F.floor(F.col("target") / F.col("n")).cast("bigint")) \
        .withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("n")).cast("bigint"))
    same = doc["__source"].eqNullSafe(goal["__source"])
    last = doc.join(goal.select("__source", "epochs", "rest"), same).drop(goal["__source"]) \
        .filter((F.col("rest") > 0) & (F.col("t") > 0)) \
        .withColumn("at", place("__id", F.col("epochs"), seed)) \
        .withColumn("bucket", F.floor(F.col("at") / F.lit((1 << ORDER_BITS) // BUCKETS)).cast("int"))
    by_source = Window.partitionBy("__source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = last.groupBy("__source", "bucket").agg(F.sum("t").alias("bt"), F.max("rest").alias("brest")) \
        .withColumn("before", F.coalesce(F.sum("bt").over(by_source), F.lit(0))) \
        .filter((F.col("before") < F.col("brest")) & (F.col("before") + F.col("bt") >= F.col("brest"))) \
        .select(F.col("__source").alias("__s"), F.col("bucket").alias("__b"), "before")
    inside = Window.partitionBy("__source", "bucket").orderBy("at", "__id") \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = last.join(buckets, last["__source"].eqNullSafe(buckets["__s"]) & (last["bucket"] == buckets["__b"])) \
        .withColumn("upto", F.col("before") + F.sum("t").over(inside)) \
        .filter(F.col("upto") >= F.col("rest")) \
        .groupBy("__source").agg(F.min(F.struct(F.col("at").alias("cut_at"), F.col("__id").alias("cut_id"))).alias("c")) \
        .select(F.col("__source").alias("__s"), "c.*")
    return goal.join(cut, goal["__source"].eqNullSafe(cut["__s"]), "left") \
        .select("__source", "n", "weight", "target", "epochs",
                F.coalesce("cut_at", F.lit(-1)).cast("bigint").alias("cut_at"), "cut_id")


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
        seed: int = 17, blocks: int = BLOCKS, **target) -> DataFrame:
    """Document copies: all columns of ``docs`` and mix_epoch, mix_block, mix_order, mix_weight.

    Reading by (mix_block, mix_order) gives the mixture; ``target`` as in :func:`plan`.
    """
    how = written(plan(docs, source_col, text_col, id_col, seed=seed, **target), "mix-plan")
    how = how.select("__source", *[F.col(c).alias(f"__{c}") for c in how.columns[1:]])
    d = docs.drop("mix_epoch", "mix_block", "mix_order", "mix_weight")
    joined = d.join(how, d[source_col].eqNullSafe(how["__source"]))
    last = place(id_col, F.col("__epochs"), seed)
    taken = (last < F.col("__cut_at")) | ((last == F.col("__cut_at")) & (
        F.col("__cut_id").isNull() | F.coalesce(F.col(id_col) <= F.col("__cut_id"), F.lit(True))))
    copies = F.col("__epochs") + F.when(taken, 1).otherwise(0)
    out = joined.withColumn("mix_epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0), (copies - 1).cast("int")))))
    u = (F.col("mix_epoch") + place(id_col, F.col("mix_epoch"), seed) / F.lit(float(1 << ORDER_BITS))) \
        / F.greatest(F.col("__target") / F.col("__n"), F.lit(1e-12))
    return out.withColumn("mix_block", F.least(F.floor(u * blocks), F.lit(blocks - 1)).cast("int")) \
        .withColumn("mix_order", F.xxhash64(F.col(id_col), F.col("mix_epoch"), F.lit(seed + 1))) \
        .withColumn("mix_weight", F.col("__weight")).drop(*how.columns)
