"""Registered queries of the training-data operators, and DuckDB SQL where it can express them.

Each query is thin: the operator does the work, the query derives the digest
columns from its output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, langid, mixing, packing, pii, quality, secret_scan, simhash, spelling, substring
from . import trie, warc
from .common import table

# Production parameters of the mixing query and of the pipeline's last stage.
MIX_MAX_EPOCHS = 1.25
NEIGHBOURS = 20
QUALITY_CUT = 0.3


def _digest(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ",").cast("binary"), 256)


def _written_spans(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def _kept(kinds) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def op1_secrets(spark: SparkSession, base: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, base, "documents"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    return found.select("doc_id", *[_count(k) for k in kinds],
                        _digest(_written_spans(_kept(kinds))).alias("base_sha256"),
                        F.array_join(_written_spans(F.col("spans")), ",").alias("spans"))


def op2_decontamination(spark: SparkSession, base: str) -> DataFrame:
    found = decontam.report(table(spark, base, "documents"), table(spark, base, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        _digest(F.col("item_ids")).alias("items_sha256"), "contaminated")


def op3_simhash(spark: SparkSession, base: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, base, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_substrings(spark: SparkSession, base: str) -> DataFrame:
    return substring.remove_repeated(table(spark, base, "documents"), digest=True) \
        .select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op5_mixing(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return mixing.mix(docs, max_epochs=MIX_MAX_EPOCHS).select(
        "doc_id", "source", "mix_epoch", "mix_block", "mix_order", "mix_weight")


def _languages(spark: SparkSession, docs: DataFrame, keep: list[str]) -> DataFrame:
    held = quality.crc_fold(F.col("doc_id"), 4) == 2
    model = langid.train(docs.filter(~held))
    return langid.predict(docs, model, keep=keep)


def op6_language(spark: SparkSession, base: str) -> DataFrame:
    found = _languages(spark, table(spark, base, "documents"), ["doc_id"])
    return found.select("doc_id", (quality.crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
                        "known")


def op7_personal_data(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    found = pii.scan(docs, pii.train(docs))
    return found.select("doc_id", *[_count(k) for k in pii.BASE_KINDS],
                        _digest(_written_spans(_kept(pii.BASE_KINDS))).alias("base_sha256"),
                        F.array_join(_written_spans(F.col("spans")), ",").alias("spans"))


def op8_archives(spark: SparkSession, base: str) -> DataFrame:
    return warc.round_trip(table(spark, base, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality(spark: SparkSession, base: str) -> DataFrame:
    docs, held = table(spark, base, "documents"), quality.crc_fold(F.col("doc_id"), 5) == 0
    model = quality.train(docs, table(spark, base, "labels").filter(~held))
    return quality.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op10_neighbours(spark: SparkSession, base: str) -> DataFrame:
    return ann.search(table(spark, base, "embeddings"), NEIGHBOURS)


def op11_prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    nodes, ends = trie.prefix_trie(table(spark, base, "conversations"))
    return nodes.join(trie.ends_digest(ends), ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op12_spelling(spark: SparkSession, base: str) -> DataFrame:
    return spelling.variants(table(spark, base, "documents"))


def op13_packing(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(table(spark, base, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def pipeline(spark: SparkSession, base: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, base)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets, "op2_decontamination": op2_decontamination, "op3_simhash": op3_simhash,
    "op4_substrings": op4_substrings, "op5_mixing": op5_mixing, "op6_language": op6_language,
    "op7_personal_data": op7_personal_data, "op8_archives": op8_archives, "op9_quality": op9_quality,
    "op10_neighbours": op10_neighbours, "op11_prefix_trie": op11_prefix_trie, "op12_spelling": op12_spelling,
    "op13_packing": op13_packing, "pipeline": pipeline,
}

_ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
           "[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")
_SECRET_RULES = (("assign", _ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16),
                 ("github", "gh[opsu]_[A-Za-z0-9]+", 0, 40), ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
                 ("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40))


def _secret_sql() -> str:
    parts = []
    for rank, (kind, regex, group, least) in enumerate(_SECRET_RULES):
        parts.append(f"""
    SELECT k, {rank} AS rank, '{kind}' AS kind, size, value,
           gap_sum + size_sum - size AS start, gap_sum + size_sum AS stop
    FROM (SELECT k, i, size, value,
                 sum(gap) OVER (PARTITION BY k ORDER BY i) AS gap_sum,
                 sum(size) OVER (PARTITION BY k ORDER BY i) AS size_sum
          FROM (SELECT k, unnest(range(1, len(m) + 1)) AS i, unnest(list_transform(m, lambda x: length(x))) AS size,
                       unnest(list_transform(v, lambda x: length(x))) AS value,
                       unnest(list_transform(g[:len(m)], lambda x: length(x))) AS gap
                FROM (SELECT k, regexp_extract_all(t, '{regex}', 0) AS m, regexp_extract_all(t, '{regex}', {group}) AS v,
                             string_split_regex(t, '{regex}') AS g FROM d)))
    WHERE value >= {least}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)}),
j AS (SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
             string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS every
      FROM s GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN j USING (k)"""


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_secrets": _secret_sql(),
    "op2_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0))),
dw AS (SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS (SELECT k, i, iw.n, item_id FROM dw JOIN iw USING (n, win)),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM h) GROUP BY k),
it AS (SELECT k, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT k, item_id::VARCHAR AS s FROM h) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN it USING (k)""",
    "op4_substrings": r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
           FROM documents),
win AS (SELECT k, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
        FROM (SELECT k, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY h) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT k, unnest(range(i, i + 35)) AS p FROM rep),
ws AS (SELECT k, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT k, string_agg(x, ' ' ORDER BY p) AS t FROM ws ANTI JOIN gone USING (k, p) GROUP BY k),
n AS (SELECT k, count(*) AS c FROM gone GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (k) LEFT JOIN n USING (k)""",
    "op8_archives": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
           FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> ((3 - i % 4) * 5)::INT) & 31) + 1)::INT, 1)), '')
             AS payload_digest, min(page_id) OVER (PARTITION BY h) AS low FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN low IS NULL OR page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN low IS NULL OR page_id = low THEN NULL ELSE low END AS refers_to
FROM b""",
}

# CRC-32 in SQL: the table of the 256 byte values from the polynomial, then one step a byte.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY b) AS tab FROM (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) AS v
  FROM (SELECT unnest(range(256)) AS b)))"""


def _crc(text: str) -> str:
    """CRC-32 of the UTF-8 of ``text``, of characters below U+0100, with ``tab`` at hand."""
    byte = (f"flatten(list_transform(range(1, length({text}) + 1), lambda i: CASE WHEN unicode(substr({text}, i, 1)) < 128 "
            f"THEN [unicode(substr({text}, i, 1))::BIGINT] "
            f"ELSE [(192 + unicode(substr({text}, i, 1)) // 64)::BIGINT, (128 + unicode(substr({text}, i, 1)) % 64)::BIGINT] END))")
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLE_SQL["op11_prefix_trie"] = rf"""
WITH {_CRC_TABLE},
o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
      FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, n, {_crc('c::VARCHAR')} % 4 AS h FROM (SELECT c, count(*) AS n FROM o GROUP BY c), crc),
t AS (SELECT n.c, a.i AS d, a.r, a.x FROM n JOIN o a ON a.c = n.c - n.c % 20 WHERE a.i <= n.h
      UNION ALL
      SELECT o.c, o.i - n.h + least(n.h, coalesce(a.n, 0)), o.r, o.x
      FROM o JOIN n USING (c) LEFT JOIN n a ON a.c = n.c - n.c % 20 WHERE o.i > n.h),
l AS (SELECT n.c, coalesce(list(md5(length(r) || ':' || r || x) ORDER BY d) FILTER (d IS NOT NULL), []) AS l,
             coalesce(list(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) ORDER BY d) FILTER (d IS NOT NULL), []) AS w
      FROM n LEFT JOIN t USING (c) GROUP BY n.c),
p AS (SELECT c, d, len(l) AS total, md5(d || array_to_string(l[1:d], '')) AS k,
             CASE WHEN d > 0 THEN md5((d - 1) || array_to_string(l[1:d - 1], '')) END AS pk, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS w
      FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM l)),
node AS (SELECT k, any_value(d) AS depth, any_value(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
                string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (total = d) AS ends FROM p GROUP BY k),
kids AS (SELECT pk AS k, count(*) AS kids FROM node WHERE pk IS NOT NULL GROUP BY pk),
below AS (SELECT a.k, count(*) FILTER (kids.kids IS NULL) AS n_leaves, sum((n_convs - 1) * w) AS saved
          FROM (SELECT DISTINCT a.k, b.k AS bk FROM p a JOIN p b ON a.c = b.c AND a.d <= b.d) a
          JOIN node ON node.k = a.bk LEFT JOIN kids ON kids.k = a.bk GROUP BY a.k)
SELECT node.conv_id, depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids, 0) AS n_children, n_leaves,
       saved::BIGINT AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node LEFT JOIN (SELECT k, conv_id FROM node) up ON up.k = node.pk LEFT JOIN kids ON kids.k = node.k JOIN below ON below.k = node.k"""

ORACLE_SQL["op12_spelling"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, run, count(*) AS n
      FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
      GROUP BY doc_id, run),
h AS (SELECT *, {_crc("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM r, crc),
v AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END
             AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT word, n, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b USING (i, rest) WHERE a.word <> b.word
      UNION SELECT d.word, w.word, w.n FROM d JOIN w ON w.word = d.rest
      UNION SELECT w.word, d.word, d.n FROM d JOIN w ON w.word = d.rest),
f AS (SELECT w.word, w.n, count(near) AS n_near, max(near_n) AS best_n, arg_min(near, row(-near_n, near)) AS best
      FROM w LEFT JOIN e USING (word) GROUP BY w.word, w.n),
g AS (SELECT word, n, n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM f),
up AS (SELECT word, form AS at FROM g WHERE form IS NOT NULL
       UNION ALL SELECT up.word, g.form FROM up JOIN g ON g.word = up.at WHERE g.form IS NOT NULL),
top AS (SELECT up.word, up.at AS root FROM up JOIN g ON g.word = up.at WHERE g.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM g LEFT JOIN top USING (word)"""
