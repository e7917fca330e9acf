"""Conversation prefix trie: double-array tries per prefix shard.

1. Turns are put in order by a global position (range partitions and offsets, so
   a conversation of any length is no single group) and conversations rebuilt. A
   turn is 128 bits of hash of its role and text, and its number of words; texts
   are not moved.
2. Conversations become sequences of at most ``layer`` turns; what is longer goes
   on in the next layer, whose tries begin at the node reached. Equal sequences of
   a layer are one row with its number of conversations (groups of copies shrink
   before anything is dealt out).
3. Sequences are dealt into parts by their prefix: the first turn, or twice the
   turns where a part would hold more than ``shard_turns``. Whole parts share a
   shard; every shard packs one double array (BASE and CHECK over the shard's own
   dense turn ids) and is traversed for its nodes and their aggregates.
4. Nodes above the cuts are shared by parts: their aggregates are merged globally
   by node.

A node is known by its depth and 128 bits of hash of its turns.

Defined cases: rows with NULL conv_id belong to no conversation; equal turns of a
conversation order by role and text; NULL role or text is empty; a conversation
left without turns is a member of the root only; for negative ids c - c % 20
truncates towards zero, as in SQL; an empty table gives no rows, not even a root;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.position import numbered
from . import common
from .common import written

cloudpickle.register_pickle_by_value(common)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP = 20               # conversations that share an opening
MOST_SHARED = 4          # they share fewer turns than this
LAYER = 4096             # turns of a sequence
SHARD_TURNS = 200_000    # turns packed into one double array
WORD = r"[^\x20\x09-\x0D]+"
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MASK = (1 << 64) - 1
NODE = "depth bigint, p1 bigint, p2 bigint, conv_id bigint, parent_conv_id bigint, q1 bigint, q2 bigint, " \
       "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint"


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with their shared openings: (c, depth, k1, k2, words) per turn, and (c, total)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("c"), "turn", F.xxhash64(role, text).alias("k1"),
        F.xxhash64(text, F.lit(7), role).alias("k2"), F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("words"),
        role.alias("role"), F.substring(text, 1, 64).alias("begin"))
    placed = numbered(turns, ["c", F.col("turn").asc_nulls_first(), "role", "begin", "k1", "k2"], "at") \
        .select("c", "k1", "k2", "words", "at")
    convs = placed.groupBy("c").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    rows = placed.join(convs, "c").select("c", "k1", "k2", "words", (F.col("at") - F.col("first") + 1).alias("i"))
    heads = rows.filter(F.col("i") < MOST_SHARED).groupBy(F.col("c").alias("a")) \
        .agg(F.sort_array(F.collect_list(F.struct("i", "k1", "k2", "words"))).alias("head"))      # three at most
    h = shared_turns(F.col("c"))
    opening = F.when(h > 0, F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1,
                                    h.cast("int"))).otherwise(F.array().cast(heads.schema["head"].dataType))
    info = written(convs.withColumn("a", F.col("c") - F.col("c") % GROUP).join(heads, "a", "left").select(
        "c", h.alias("h"), opening.alias("opening"),
        (F.size(opening) + F.greatest(F.col("n") - h, F.lit(0))).cast("bigint").alias("total")), "conversations")
    own = rows.join(info.select("c", "h", F.size("opening").alias("base")), "c").filter(F.col("i") > F.col("h")) \
        .select("c", (F.col("base") + F.col("i") - F.col("h")).cast("bigint").alias("depth"), "k1", "k2", "words")
    shared = info.select("c", F.posexplode("opening").alias("at", "t")) \
        .select("c", (F.col("at") + 1).cast("bigint").alias("depth"), "t.k1", "t.k2", "t.words")
    return own.unionByName(shared), info.select("c", "total")


def step(key: tuple[int, int], k1: int, k2: int) -> tuple[int, int]:
    """The hash of a node from its parent's and its turn's."""
    return (key[0] * MULTIPLIERS[0] + k1 + 1) & MASK, (key[1] * MULTIPLIERS[1] + k2 + 1) & MASK


def _signed(v: list[int]) -> pa.Array:
    return pa.array(np.array(v, dtype=np.uint64).view(np.int64))


def keyed(rows: DataFrame, depth: Column, names: tuple[str, str]) -> DataFrame:
    """``rows`` (s1, s2, k1s, k2s) with the node hash after the first ``depth`` turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("s1", "s2", "k1s", "k2s", "__depth")]
            ends = []
            for s1, s2, k1s, k2s, n in zip(*lists, strict=True):
                key = (s1 & MASK, s2 & MASK)
                for x, y in zip(k1s[:n], k2s[:n], strict=True):
                    key = step(key, x, y)
                ends.append(key)
            keep = [i for i, n in enumerate(b.schema.names) if n not in (*names, "__depth")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), _signed([e[0] for e in ends]), _signed([e[1] for e in ends])],
                names=[*(b.schema.names[i] for i in keep), *names])

    kept = [f for f in rows.schema.fields if f.name not in names]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), *(f"{n} bigint" for n in names)])
    return rows.select(*[f.name for f in kept], depth.cast("int").alias("__depth")).mapInArrow(run, schema)


def sequences(turns: DataFrame, convs: DataFrame, layer: int) -> list[DataFrame]:
    """Per layer: (c, len, more, s1, s2, e1, e2, k1s, k2s, ws), the conversations' sequences with start and end node."""
    at = (F.col("depth") - 1)
    cuts = turns.withColumn("layer", F.floor(at / layer)).groupBy("c", "layer") \
        .agg(F.sort_array(F.collect_list(F.struct("depth", "k1", "k2", "words"))).alias("t")) \
        .join(convs, "c", "right").select(
            "c", F.coalesce("layer", F.lit(0)).alias("layer"), F.coalesce(F.size("t"), F.lit(0)).alias("len"),
            (F.col("total") > (F.coalesce("layer", F.lit(0)) + 1) * layer).alias("more"),
            *[F.coalesce(F.col(f"t.{n}"), F.array().cast(kind)).alias(out) for n, out, kind in
              (("k1", "k1s", "array<bigint>"), ("k2", "k2s", "array<bigint>"), ("words", "ws", "array<int>"))])
    cuts = written(cuts, "sequences")
    most = cuts.agg(F.max("layer")).first()[0]
    out = []
    for j in range(0 if most is None else most + 1):
        rows = cuts.filter(F.col("layer") == j).drop("layer")
        if j:
            rows = rows.join(out[-1].select("c", F.col("e1").alias("s1"), F.col("e2").alias("s2")), "c")
        else:
            rows = rows.withColumns({"s1": F.lit(0).cast("bigint"), "s2": F.lit(0).cast("bigint")})
        out.append(written(keyed(rows, F.col("len"), ("e1", "e2")), "layer"))
    return out


def parts(rows: DataFrame, layer: int, shard_turns: int) -> DataFrame:
    """``rows`` with ``cut`` and the hash (u1, u2) of the node at that depth: no part holds over ``shard_turns`` turns."""
    settled, cut = None, 1
    while True:
        rows = written(keyed(rows, F.least("len", F.lit(cut)), ("u1", "u2")), "parts").withColumn("cut", F.lit(cut))
        large = rows.filter(F.col("len") >= cut).groupBy("u1", "u2").agg(F.sum("len").alias("t")) \
            .filter(F.col("t") > shard_turns).select("u1", "u2", F.lit(True).alias("large"))
        large = written(large, "large")
        if cut >= layer or large.isEmpty():
            return rows if settled is None else settled.unionByName(rows)
        told = rows.join(large, ["u1", "u2"], "left")
        ahead = F.col("large") & (F.col("len") >= cut)
        done = told.filter(~F.coalesce(ahead, F.lit(False))).select(*rows.columns)
        settled = done if settled is None else settled.unionByName(done)
        rows, cut = told.filter(ahead).drop("large", "u1", "u2", "cut"), min(2 * cut, layer)


def dense(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ids of turns, from 0."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    ids = np.empty(len(a), dtype=np.int64)
    ids[order] = np.cumsum(new) - 1
    return ids, int(new.sum())


def pack(parent: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BASE, CHECK and each node's place, of a trie given by its nodes' parents and labels (node 0 is the root).

    The child of place s by label x is at BASE[s] + x, and CHECK there is s; CHECK is -1 at the root and where
    nothing is. Nodes of many children are placed first; those of one child fill the holes.
    """
    n = len(parent)
    child = np.arange(1, n)
    child = child[np.lexsort((label[1:], parent[1:]))]
    first = np.flatnonzero(np.concatenate(([True], np.diff(parent[child]) != 0))) if n > 1 else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(child)))
    used = np.zeros(n + 1024, dtype=bool)
    used[0] = True
    place, base = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    begin: dict[int, int] = {}
    for g in np.argsort(-size, kind="stable")[:int((size > 1).sum())].tolist():
        own = child[first[g]:first[g] + size[g]]
        away = label[own] - label[own[0]]
        at = begin.get(len(own), 1)
        while True:
            if len(used) < at + away[-1] + 2048:
                used = np.concatenate((used, np.zeros(len(used) + int(away[-1]) + 2048, dtype=bool)))
            free = at + np.flatnonzero(~used[at:at + 1024])
            for d in away[1:]:
                free = free[~used[free + d]]
                if not len(free):
                    break
            if len(free):
                break
            at += 1024
        begin[len(own)] = int(free[0])
        place[own] = free[0] + away
        used[place[own]] = True
        base[parent[own[0]]] = free[0] - label[own[0]]
    alone = child[first[size == 1]]
    holes = np.flatnonzero(~used)
    if len(holes) < len(alone):
        holes = np.append(holes, len(used) + np.arange(len(alone) - len(holes)))
    place[alone] = holes[:len(alone)]
    base[parent[alone]] = place[alone] - label[alone]
    slots = int(place.max()) + 1
    base_at, check = np.zeros(slots, dtype=np.int64), np.full(slots, -1, dtype=np.int64)
    base_at[place] = base
    check[place[1:]] = place[parent[1:]]
    return base_at, check, place


def grow(labels: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Parents and labels of the trie of the sequences labels[starts:starts + sizes]."""
    state = np.zeros(len(starts), dtype=np.int64)
    parent, label, n = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
    rows, level = np.flatnonzero(sizes > 0), 0
    while len(rows):
        code, at = np.unique(state[rows] * width + labels[starts[rows] + level], return_inverse=True)
        parent.append(code // width)
        label.append(code % width)
        state[rows] = n + at
        n += len(code)
        level += 1
        rows = rows[sizes[rows] > level]
    return np.concatenate(parent), np.concatenate(label)


def _flat(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _add_up(p: np.ndarray, multiplier: int, k: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return p * np.uint64(multiplier) + k + np.uint64(1)


def shard_nodes(t: pa.Table, offset: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """A shard's nodes, and its parts and short rows for the nodes above the cuts."""
    size, cut = t.column("len").to_numpy().astype(np.int64), t.column("cut").to_numpy().astype(np.int64)
    n, low = t.column("n").to_numpy(), t.column("low").to_numpy()
    k1, k2 = _flat(t, "k1s").view(np.uint64), _flat(t, "k2s").view(np.uint64)
    words = _flat(t, "ws").astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))[:-1]
    key = [t.column(c).to_numpy().view(np.uint64) for c in ("s1", "s2")]
    # the way from the layer's start to each row's cut
    path = [[p] for p in key]
    deepest = int(np.minimum(cut - 1, size).max())
    for d in range(deepest):
        on = size > d
        at = begin[on] + d
        nxt = [p[-1].copy() for p in path]
        nxt[0][on] = _add_up(path[0][-1][on], MULTIPLIERS[0], k1[at])
        nxt[1][on] = _add_up(path[1][-1][on], MULTIPLIERS[1], k2[at])
        for p, x in zip(path, nxt, strict=True):
            p.append(x)
    whole = np.flatnonzero(size >= cut)                  # rows of parts; the others end above their cut
    ids, width = dense(k1, k2)
    part, n_parts = dense(t.column("u1").to_numpy()[whole].view(np.uint64), t.column("u2").to_numpy()[whole].view(np.uint64))
    width = max(width, n_parts, 1)
    ids = ids.copy()
    ids[begin[whole] + cut[whole] - 1] = part            # a part's first node is told by the part, not by its last turn
    starts, sizes = begin[whole] + cut[whole] - 1, size[whole] - cut[whole] + 1
    base, check, _ = pack(*grow(ids, starts, sizes, width))
    # traverse: every sequence walks through the arrays
    slots = len(check)
    convs, children, leaves, saved = (np.zeros(slots, dtype=np.int64) for _ in range(4))
    least = np.full(slots, np.iinfo(np.int64).max)
    level, w, depth = (np.zeros(slots, dtype=np.int64) for _ in range(3))
    hashes = [np.zeros(slots, dtype=np.uint64) for _ in key]
    parent_of_top = [np.zeros(slots, dtype=np.uint64) for _ in key]
    state, rows, d = np.zeros(len(whole), dtype=np.int64), np.arange(len(whole)), 0
    above = [np.stack(p)[np.minimum(cut[whole] - 1, deepest), whole] if len(whole) else p[0][:0] for p in path]
    while len(rows):
        at = starts[rows] + d
        nxt = base[state[rows]] + ids[at]
        if not (check[nxt] == state[rows]).all():
            raise AssertionError("a sequence leaves its trie")
        np.add.at(convs, nxt, n[whole[rows]])
        np.minimum.at(least, nxt, low[whole[rows]])
        level[nxt], w[nxt], depth[nxt] = d + 1, words[at], cut[whole[rows]] + d
        before = [h[state[rows]] for h in hashes] if d else [a[rows] for a in above]
        for i, (k, m) in enumerate(zip((k1, k2), MULTIPLIERS, strict=True)):
            hashes[i][nxt] = _add_up(before[i], m, k[at])
            if not d:
                parent_of_top[i][nxt] = before[i]
        state[rows] = nxt
        d += 1
        rows = rows[sizes[rows] > d]
    nodes = np.flatnonzero(check >= 0)
    np.add.at(children, check[nodes], 1)
    # what lies below a layer's last nodes
    more = t.column("b_children").to_pylist()
    deep = np.flatnonzero(np.array([more[r] is not None for r in whole.tolist()], dtype=bool))
    for total, name in ((children, "b_children"), (leaves, "b_leaves"), (saved, "b_saved")):
        total[state[deep]] += np.array([t.column(name)[int(r)].as_py() for r in whole[deep]], dtype=np.int64)
    leaves[nodes[children[nodes] == 0]] = 1
    saved[nodes] += (convs[nodes] - 1) * w[nodes]
    for lv in range(d, 1, -1):
        at = nodes[level[nodes] == lv]
        np.add.at(leaves, check[at], leaves[at])
        np.add.at(saved, check[at], saved[at])
    top = level[nodes] == 1
    up = [np.where(top, parent_of_top[i][nodes], hashes[i][check[nodes]]) for i in (0, 1)]
    found = pa.RecordBatch.from_arrays(
        [pa.array(depth[nodes] + offset), *(pa.array(h[nodes].view(np.int64)) for h in hashes), pa.array(least[nodes]),
         pa.array(least[check[nodes]], mask=top), *(pa.array(u.view(np.int64)) for u in up), pa.array(convs[nodes]),
         pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes])],
        names=["depth", "p1", "p2", "conv_id", "parent_conv_id", "q1", "q2", "n_convs", "n_children", "n_leaves", "saved"])
    # one row per part, and one per sequence that ends above its cut
    first = whole[np.unique(part, return_index=True)[1]] if len(whole) else whole
    at_top = base[0] + np.arange(n_parts)
    short = np.flatnonzero(size < cut)
    who = np.concatenate((first, short))
    long = np.concatenate((np.ones(len(first), bool), np.zeros(len(short), bool)))
    steps = np.where(long, cut[who] - 1, size[who])

    def both(a: np.ndarray, b: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate((a, b)).astype(np.int64))

    none = np.zeros(len(short), dtype=np.int64)
    ways = [pa.array([[int(x) for x in np.stack(p)[:s + 1, r].view(np.int64)] for r, s in zip(who, steps, strict=True)],
                     pa.list_(pa.int64())) for p in path]
    told = pa.array([words[begin[r]:begin[r] + s] for r, s in zip(who, steps, strict=True)], pa.list_(pa.int64()))
    return found, pa.RecordBatch.from_arrays(
        [*ways, told, pa.array(long.astype(np.int64)), both(convs[at_top], n[short]), both(least[at_top], low[short]),
         both(leaves[at_top], none), both(saved[at_top], none)],
        names=["way1", "way2", "words", "top", "n_convs", "conv_id", "n_leaves", "saved"])


def tries(rows: DataFrame, shard_turns: int, offset: int) -> DataFrame:
    """The nodes of the double arrays of whole parts (struct ``node``), and their parts (struct ``part``)."""
    node = pa.struct([(n, pa.int64()) for n in
                      ("depth", "p1", "p2", "conv_id", "parent_conv_id", "q1", "q2", "n_convs", "n_children", "n_leaves", "saved")])
    part = pa.struct([("way1", pa.list_(pa.int64())), ("way2", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())),
                      *((n, pa.int64()) for n in ("top", "n_convs", "conv_id", "n_leaves", "saved"))])

    def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, parts_ = shard_nodes(pa.Table.from_batches(held).combine_chunks(), offset)
        yield pa.RecordBatch.from_arrays([nodes.to_struct_array().cast(node), pa.nulls(nodes.num_rows, part)], names=["node", "part"])
        yield pa.RecordBatch.from_arrays([pa.nulls(parts_.num_rows, node), parts_.to_struct_array().cast(part)], names=["node", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns, last = [], 0, None
        for b in batches:
            if not b.num_rows:
                continue
            u1, u2 = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("u1", "u2"))
            size = b.column(b.schema.get_field_index("len")).to_numpy()
            new = np.concatenate(([last != (u1[0], u2[0])], (u1[1:] != u1[:-1]) | (u2[1:] != u2[:-1])))
            lo = 0
            for i in np.flatnonzero(new).tolist():       # a part begins: close the shard if it is full
                turns += int(size[lo:i].sum())
                held += [b.slice(lo, i - lo)] if i > lo else []
                lo = i
                if turns >= shard_turns:
                    yield from out(held)
                    held, turns = [], 0
            held.append(b.slice(lo))
            turns += int(size[lo:].sum())
            last = (u1[-1], u2[-1])
        if held:
            yield from out(held)

    kind = "node struct<" + NODE.replace(" bigint", ":bigint") + ">, part struct<way1:array<bigint>, way2:array<bigint>, " \
        "words:array<bigint>, top:bigint, n_convs:bigint, conv_id:bigint, n_leaves:bigint, saved:bigint>"
    return rows.repartition("u1", "u2").sortWithinPartitions("u1", "u2").mapInArrow(run, kind)


def merge_upper(parts_: DataFrame, offset: int) -> DataFrame:
    """Nodes above the cuts (NODE columns and ``rel``, the depth in the layer), merged over all parts."""
    last = F.size("way1") - 1
    each = parts_.select("*", F.posexplode("way1").alias("rel", "p1")).select(
        "rel", "p1", F.get("way2", F.col("rel")).alias("p2"), "n_convs", "conv_id", "n_leaves", "saved",
        ((F.col("top") == 1) & (F.col("rel") == last)).cast("bigint").alias("n_children"),
        F.when(F.col("rel") > 0, F.get("words", F.col("rel") - 1)).otherwise(0).alias("w"),
        F.slice("way1", 1, F.col("rel") + 1).alias("way1"), F.slice("way2", 1, F.col("rel") + 1).alias("way2"))
    key = ["rel", "p1", "p2"]
    up = written(each.groupBy(*key).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"), F.sum("n_children").alias("n_children"), F.first("w").alias("w"),
        F.first("way1").alias("way1"), F.first("way2").alias("way2")), "upper")
    q = [F.get(c, F.col("rel") - 1) for c in ("way1", "way2")]
    up = up.withColumns({"q1": q[0], "q2": q[1]})
    kids = up.filter(F.col("rel") > 0).groupBy((F.col("rel") - 1).alias("rel"), F.col("q1").alias("p1"), F.col("q2").alias("p2")) \
        .agg(F.count("*").alias("kids"))
    up = up.join(kids, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    given = up.select(((F.col("n_convs") - 1) * F.col("w")).alias("own"), (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                      "way2", F.posexplode("way1").alias("rel", "p1")) \
        .groupBy("rel", "p1", F.get("way2", F.col("rel")).alias("p2")).agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    return up.join(given, key).select(
        (F.col("rel") + offset).cast("bigint").alias("depth"), "p1", "p2", "conv_id",
        F.lit(None).cast("bigint").alias("parent_conv_id"), "q1", "q2", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("saved") + F.col("own")).alias("saved"), "rel")


def prefix_trie(conversations: DataFrame, layer: int = LAYER, shard_turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """Nodes (columns of ``NODE``) and their ends: (depth, p1, p2, conv_id) per conversation."""
    turns, convs = rebuilt(conversations)
    layers = sequences(turns, convs, layer)
    names = [x.split()[0] for x in NODE.split(", ")]
    spark = conversations.sparkSession
    nodes = ends = upper = spark.createDataFrame([], NODE)
    ends = ends.select("depth", "p1", "p2", "conv_id")
    below = spark.createDataFrame([], "e1 bigint, e2 bigint, b_children bigint, b_leaves bigint, b_saved bigint")
    for j in reversed(range(len(layers))):
        rows = layers[j]
        ends = ends.unionByName(rows.filter(~F.col("more")).select(
            (F.col("len") + j * layer).cast("bigint").alias("depth"), F.col("e1").alias("p1"), F.col("e2").alias("p2"), F.col("c").alias("conv_id")))
        same = rows.groupBy("s1", "s2", "e1", "e2", "len").agg(
            F.count("*").alias("n"), F.min("c").alias("low"), F.max("more").alias("more"),
            *[F.first(c).alias(c) for c in ("k1s", "k2s", "ws")])
        cut = parts(same, layer, shard_turns)
        if j + 1 < len(layers):
            last = F.col("more") & (cut["e1"] == below["e1"]) & (cut["e2"] == below["e2"])
            cut = cut.join(below, last, "left").drop(below["e1"], below["e2"])
        else:
            cut = cut.withColumns({c: F.lit(None).cast("bigint") for c in ("b_children", "b_leaves", "b_saved")})
        found = written(tries(cut, shard_turns, j * layer), "tries")
        up = written(merge_upper(found.filter(F.col("part").isNotNull()).select("part.*"), j * layer), "upper")
        below = up.filter(F.col("rel") == 0).select(
            F.col("p1").alias("e1"), F.col("p2").alias("e2"), F.col("n_children").alias("b_children"),
            F.col("n_leaves").alias("b_leaves"), F.col("saved").alias("b_saved"))
        nodes = nodes.unionByName(found.filter(F.col("node").isNotNull()).select("node.*"))
        upper = upper.unionByName((up.filter(F.col("rel") > 0) if j else up).select(*names))
    # a parent above a cut, or at the end of the layer before
    whose = upper.unionByName(nodes.filter(F.col("depth") % layer == 0) if len(layers) > 1 else nodes.limit(0)).select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("__parent"))
    known = nodes.filter(F.col("parent_conv_id").isNotNull())
    asked = nodes.filter(F.col("parent_conv_id").isNull()).unionByName(upper)
    asked = asked.join(whose, ["depth", "q1", "q2"], "left").withColumn("parent_conv_id", F.col("__parent")).select(*names)
    return known.unionByName(asked), ends


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256): SHA-256 of the ascending ids, comma-joined, read as a sorted stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            cols = [b.column(i).to_numpy() for i in range(3)]
            ids = b.column(3).to_pylist()
            if not ids:
                continue
            new = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in cols], axis=0)))).tolist()
            done = []
            for lo, hi in zip(new, [*new[1:], len(ids)], strict=True):
                this, text = tuple(int(c[lo]) for c in cols), ",".join(map(str, ids[lo:hi]))
                if this == key:
                    sha.update(("," + text).encode())
                    continue
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = this, hashlib.sha256(text.encode())
            yield rows(done)
        if key is not None:
            yield rows([(*key, sha.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([d[i] for d in done], pa.int64()) for i in range(3)),
                                           pa.array([d[3] for d in done], pa.string())], names=["depth", "p1", "p2", "ends_sha256"])

    key = ["depth", "p1", "p2"]
    return ends.select(*key, "conv_id").repartition(*key).sortWithinPartitions(*key, "conv_id") \
        .mapInArrow(run, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")
