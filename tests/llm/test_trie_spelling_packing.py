"""The prefix trie, the spelling variants and the packing against brute force, on small tables of edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from check_llm import BASE
from shelfwise.llm import catalog, packing, spelling, trie

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- conversation prefix trie ---------------------------------------------------------------

def brute_nodes(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - int(np.fmod(c, 20))
        rebuilt[c] = own.get(first, [])[:h] + v[h:]
    members, kids = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in kids[k])
    ends = {k: ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(k)))) for k, m in members.items()}
    return collections.Counter(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
         hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in members.items())


def nodes_of(conversations, **kw):
    nodes, ends = trie.prefix_trie(conversations, **kw)
    found = nodes.join(trie.ends_digest(ends), ["depth", "p1", "p2"], "left").fillna({"ends_sha256": EMPTY_SHA})
    return collections.Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved,
                                r.ends_sha256) for r in found.collect())


TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, n bigint"


def some_conversations(rnd):
    """Shared openings, copies, long ones, ties and NULLs; one conversation holds a third of all rows."""
    base = [("u", "a b"), ("v", "c"), ("u", ""), (None, None), ("u", "d e f"), ("v", "x\ty")]
    long = [rnd.choice(base) for _ in range(60)]
    rows = [(None, 1, "u", "no conversation"), (-25, 0, "u", "below zero"), (-20, 0, "u", "a b")]
    for c in rnd.sample(range(300), 50):
        n = rnd.choice([1, 1, 2, 3, 5, 12])
        v = long[:n] if rnd.random() < .6 else [rnd.choice(base) for _ in range(n)]
        rows += [(c, None if rnd.random() < .05 else i, r, x) for i, (r, x) in enumerate(v)]
    rows += [(7, i, "u", x) for i, (_, x) in enumerate(long)] + rows[3:6]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("kw", [{}, {"layer": 16, "shard_turns": 40}])
def test_trie_matches_brute_force(spark, kw):
    rows = some_conversations(random.Random(3))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    assert nodes_of(df, **kw) == brute_nodes(rows)


def test_trie_query_and_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{BASE}/conversations.parquet").collect()]
    got = catalog.op11_prefix_trie(spark, BASE).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert collections.Counter(map(tuple, got.collect())) == brute_nodes(rows)
    assert nodes_of(spark.createDataFrame([], TURNS)) == {}
    assert nodes_of(spark.createDataFrame([(None, 1, "u", "x", "", 1)], TURNS)) == {}


def test_double_array_holds_its_trie():
    rnd = np.random.default_rng(2)
    for width in (3, 40):
        sizes = rnd.integers(0, 9, 400)
        labels = rnd.integers(0, width, int(sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        parent, label = trie.grow(labels, starts, sizes, width)
        base, check, place = trie.pack(parent, label)
        assert len(set(place.tolist())) == len(parent) == len({(p, x) for p, x in zip(parent[1:], label[1:])}) + 1
        assert (base[place[parent[1:]]] + label[1:] == place[1:]).all() and (check[place[1:]] == place[parent[1:]]).all()
        prefixes = {tuple(labels[s:s + d]) for s, n in zip(starts, sizes) for d in range(n + 1)}
        assert int((check >= 0).sum()) == len(prefixes) - 1


# --- spelling variants ----------------------------------------------------------------------

def brute_variants(rows):
    counts = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, degree = {}, {}
    for w in n:
        beside = [v for v in n if near(w, v)]
        degree[w] = len(beside)
        best = min(beside, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], degree[w], n.get(form[w])))
    return out


WORDS = "doc_id bigint, text string, word string, n bigint, form string"


@pytest.fixture(scope="module")
def spelled():
    rnd = random.Random(8)
    syllables = ["ab", "ba", "é", "x", "or", "Ó", "to"]
    words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(3, 7))) for _ in range(60)]
    words += [w[:i] + rnd.choice("abxé") + w[i + rnd.randint(0, 1):] for w in words for i in (0, len(w) // 2, len(w) - 1)]
    texts = [" ".join(rnd.choices(words, k=80)) for _ in range(40)]
    often = " ".join(["Aabaabaab"] * 120 + ["aabaabaa"] * 12 + ["aabaabaaba"] * 12 + ["abaabaab", "abaabaab"] + ["aabaabaabab"] + ["aaaaaaaa", "aaaaaaa"] * 3)
    return [*enumerate(texts), (None, often), (7, often), (None, None), (3, ""), (4, "× ÷ 12 _"), (9, "a" * 3000 + " " + "a" * 2999)] \
        + [(9, "a" * 3000 + " " + "a" * 2999)]


@pytest.mark.parametrize("kw", [{}, {"long_list": 10, "least_frequent": 3}, {"qmax": 6, "least_frequent": 2, "long_list": 50}])
def test_variants_match_brute_force(spark, spelled, kw):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in spelled], WORDS)
    got = spelling.variants(df, **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute_variants(spelled)
    assert any(r[2] not in (r[0], r[1]) for r in rows) or kw                 # a chain of forms


def test_variants_of_empty_tables(spark):
    assert spelling.variants(spark.createDataFrame([], WORDS)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None, "", 1, "")], WORDS)).count() == 0


def test_near_words_share_an_indexed_gram():
    """What the bound promises: an edit spares one of the indexed grams, or both words are marked unbounded."""
    rnd = random.Random(4)
    corpus = ["".join(rnd.choice("aab") for _ in range(rnd.randint(5, 12))) for _ in range(300)]
    for qmin, qmax, least in ((2, 3, 5), (2, 5, 3), (3, 6, 2)):
        grams = collections.Counter(w[p:p + q] for w in corpus for q in range(qmin, qmax + 1) for p in range(len(w) - q + 1))
        frequent = {g: n for g, n in grams.items() if n > least}
        for w in corpus:
            i, c = rnd.randint(0, len(w)), rnd.choice("abc")
            for v in (w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]):
                a, loose_a = spelling.indexed_grams(w, frequent, qmin, qmax)
                b, loose_b = spelling.indexed_grams(v, frequent, qmin, qmax)
                assert set(a) & set(b) or loose_a and loose_b, (w, v)


def test_the_gram_dictionary_is_bounded(spark):
    words = spark.createDataFrame([("".join(random.Random(i).choice("abcdefgh") for _ in range(9)), 2) for i in range(500)],
                                  "word string, n bigint").dropDuplicates(["word"])
    got = spelling.gram_dictionary(words, 2, 4, 1, 20)
    assert all(len([g for g in got if len(g) == q]) <= 20 for q in (2, 3, 4))


# --- packing --------------------------------------------------------------------------------

def used(count, sets):
    total = np.zeros_like(count)
    for sizes, n in sets:
        assert n > 0 and sum(s * m for s, m in sizes) <= len(count) - 1
        for s, m in sizes:
            total[s] += n * m
    return total


def fewest(items, capacity):
    """Fewest sequences, over all subsets."""
    best = [(1, 0)] + [(99, 0)] * ((1 << len(items)) - 1)
    for m in range(1 << len(items)):
        n, fill = best[m]
        for i, x in enumerate(items):
            if not m >> i & 1:
                best[m | 1 << i] = min(best[m | 1 << i], (n, fill + x) if fill + x <= capacity else (n + 1, x))
    return best[-1][0] if items else 0


def best_fit_one_by_one(items, capacity):
    room = []
    for x in sorted(items, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= x]
        if fits:
            room[min(fits, key=room.__getitem__)] -= x
        else:
            room.append(capacity - x)
    return len(room)


def test_fixed_sets_lose_nothing_and_best_fit_is_best_fit():
    rnd, fixed = random.Random(1), 0
    for _ in range(500):
        capacity = rnd.choice([10, 12, 20, 30])
        least = rnd.choice([1, 2, 3, capacity // 4])
        items = [rnd.randint(least, capacity) for _ in range(rnd.randint(0, 8))]
        count = np.bincount(items, minlength=capacity + 1).astype(np.int64)
        left = count.copy()
        sets = packing.reduce(left)
        assert (used(count, sets) + left == count).all()
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        fixed += len(items) - len(rest)
        assert sum(n for _, n in sets) + fewest(rest, capacity) == fewest(items, capacity)
        packed = packing.best_fit(count.copy())
        assert (used(count, packed) == count).all()
        assert sum(n for _, n in packed) == best_fit_one_by_one(items, capacity)
    assert fixed > 1000


def test_encoder_equals_the_tokenizers_library():
    own, ref, rnd = packing.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER), random.Random(3)
    parts = [" ", "  ", "\n", "\t", " ", "a", "b", "The", "é", "1", "23", "'s", "'", "!", "<|endoftext|>", " ", "中",
             "x y", "...", "​", "\x00", "\x1f", "́", "€", "½", "٣", "\U0001f9ff", "﻿"]
    for _ in range(3000):
        x = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert own.ids(x).tolist() == ref.encode(x, add_special_tokens=False).ids, repr(x)
    assert own.fast is not None and len(own.ids(" " * 200_000)) == 200_000
    other = public_tokenizers.path("word_bpe_49k.json")
    assert packing.Encoder(other).fast is None
    assert packing.Encoder(other).ids("two words").tolist() == Tokenizer.from_file(other).encode("two words").ids


def test_packing_is_whole_and_gapless(spark):
    schema = "doc_id bigint, text string, length bigint, rank string, task string"
    long = " ".join(f"word{i}" for i in range(4000))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (None, "no id"), (4, long), (5, "a " * 2047), (6, "a" + " a" * 4093)]
    rows += [(100 + i, "one two three") for i in range(200)] + [(400 + i, long[:i * 37]) for i in range(60)]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], schema).repartition(5)
    got = packing.pack(df, TOKENIZER, keep_ids=True).collect()
    ref, want = Tokenizer.from_file(TOKENIZER), collections.Counter()
    for i, text in rows:
        ids = [*ref.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        for piece, s in enumerate([0, *range(first, len(ids), 2048)]):
            own = ids[s:first if not s else s + 2048]
            want[i, piece, s, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), tuple(own)] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 2048) + 2
    assert packing.pack(spark.createDataFrame([], schema), TOKENIZER).count() == 0


def test_packing_query(spark):
    got = catalog.op13_packing(spark, BASE)
    assert got.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"),
                          ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    assert got.agg(F.count_distinct("doc_id")).first()[0] == docs.count()
