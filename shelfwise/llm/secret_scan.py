"""Secret scans with a trigram inverted index (DataFrame functions only).

Every rule is a regex. From it a Boolean trigram query is derived: an OR of
branches, each an AND of the trigrams that every match of that branch must
contain (in lower case). Postings (trigram, document) are built for the trigrams that some
query names, with one posting per document however often the trigram occurs;
intersecting them (a grouped AND/OR over a document's postings, combined in the
scan task first) gives each rule's candidates, and the regex verifies the whole
text of candidates only. A rule whose regex has no mandatory trigram scans every
text. An index over a table bucketed by document id joins without moving text;
otherwise texts move once, to meet their candidates' bits.

Positions count code points: the pieces between matches and the matches
themselves give every match's start and end.

Defined cases: NULL text scans as empty; repeated rows and repeated ids keep a
row each (postings of an id are shared, the verification decides); NULL ids are
candidates of every rule; empty table gives no rows; other columns are kept out.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

MOST_BRANCHES = 200
SMALL_CLASS = 8


@dataclass(frozen=True)
class Rule:
    """``regex``: Java regex without lookaround; ``group``: the captured value (0: the match);
    ``least``: its smallest length, shorter matches are dropped."""
    kind: str
    regex: str
    least: int = 1
    group: int = 0


# The base patterns and lengths of the contract, then the added kinds.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
ADDED_RULES = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)


def _branches(node) -> list[list[str | None]]:
    """Alternatives of a parsed regex, each a list of literal characters and gaps (None)."""
    out: list[list[str | None]] = [[]]
    for op, arg in node:
        if op is C.LITERAL:
            ways = [[chr(arg).lower()]]
        elif op is C.SUBPATTERN:
            ways = _branches(arg[-1])
        elif op is C.BRANCH:
            ways = [w for alt in arg[1] for w in _branches(alt)]
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= SMALL_CLASS:
            ways = [[chr(a).lower()] for _, a in arg]
        elif op is C.MAX_REPEAT and arg[1] == 1:
            ways = _branches(arg[2]) + ([[]] if arg[0] == 0 else [])
        elif op is C.MAX_REPEAT and arg[0] >= 1:
            ways = [[*w, None] for w in _branches(arg[2])]
        else:
            ways = [[None]]
        if len(out) * len(ways) > MOST_BRANCHES:
            ways = [[None]]
        out = [a + w for a in out for w in ways]
    return out


def trigram_query(regex: str) -> list[frozenset[str]] | None:
    """The Boolean trigram query of a regex: OR over the sets, AND inside; None when it has none.

    Lower-cased; characters that other scripts fold to ASCII never match here,
    because the rules match ASCII letters only.
    """
    query = set()
    for way in _branches(_parser.parse(regex)):
        runs = "".join("\n\n" if c is None else c for c in way).split("\n\n")
        grams = frozenset(r[i:i + 3] for r in runs for i in range(len(r) - 2))
        if not grams:
            return None
        query.add(grams)
    # a branch that asks for more than another one adds nothing
    return sorted((q for q in query if not any(o < q for o in query)), key=sorted)


def _document(id_col: str, text: Column) -> Column:
    """The posting's document: its id, or the hash of the text where the id is NULL."""
    return F.coalesce(F.xxhash64(F.lit(1), F.when(F.col(id_col).isNotNull(), F.col(id_col))),
                      F.xxhash64(F.lit(2), text))


def postings(docs: DataFrame, grams: list[str], text_col: str = "__text") -> DataFrame:
    """(gram, __doc): the inverted index of ``docs`` for the given trigrams."""
    low = docs.select("__doc", F.lower(text_col).alias("__low"))
    found = F.array_compact(F.array(*[F.when(F.contains("__low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("__doc", F.explode(found).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(__doc, c_<kind> BOOLEAN ...): the documents whose postings satisfy some rule's query."""
    grams = sorted({g for q in queries.values() for way in q for g in way})
    has = {g: f"__g{i}" for i, g in enumerate(grams)}
    held = index.groupBy("__doc").agg(*[F.bool_or(F.col("gram") == g).alias(n) for g, n in has.items()])

    def holds(query: list[frozenset[str]]) -> Column:
        out = F.lit(False)
        for way in query:
            every = F.lit(True)
            for g in sorted(way):
                every = every & F.col(has[g])
            out = out | every
        return out

    flags = held.select("__doc", *[holds(q).alias(f"c_{k}") for k, q in queries.items()])
    any_of = F.lit(False)
    for k in queries:
        any_of = any_of | F.col(f"c_{k}")
    return flags.filter(any_of)


def spans_of(text: Column, rule: Rule) -> Column:
    """ARRAY<STRUCT<start, stop>> of a rule's matches, leftmost and non-overlapping, in code points."""
    matches = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    values = matches if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    sizes = let(F.transform(F.split(text, rule.regex, -1), F.length), lambda gaps: let(
        F.transform(values, F.length), lambda value: F.transform(matches, lambda m, i: F.struct(
            F.get(gaps, i).alias("gap"), F.length(m).alias("size"), F.get(value, i).alias("value")))))
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    walked = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda acc, s: F.struct(
        (acc["at"] + s["gap"] + s["size"]).alias("at"),
        F.when(s["value"] >= rule.least, F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["size"]).alias("stop")))))
        .otherwise(acc["out"]).alias("out")))["out"]
    return walked


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + ADDED_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, spans ARRAY<STRUCT<start, rank, kind, stop>>) for every row, by start, then rule order."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("__id"), text.alias("__text")) \
        .withColumn("__doc", _document("__id", F.col("__text")))
    flags = {}
    if indexed:
        grams = sorted({g for q in indexed.values() for way in q for g in way})
        found = candidates(postings(d, grams), indexed)
        d = d.join(found, "__doc", "left")
        flags = {k: F.coalesce(F.col(f"c_{k}"), F.lit(False)) for k in indexed}
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def column(rank: int, r: Rule) -> Column:
        found = spans_of(F.col("__text"), r)
        if r.kind in flags:
            found = F.when(flags[r.kind], found).otherwise(none)
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                     F.lit(r.kind).alias("kind"), s["stop"].alias("stop")))

    columns = [column(rank, r) for rank, r in enumerate(rules)]
    return d.select(F.col("__id").alias(id_col), F.array_sort(F.concat(*columns)).alias("spans"))
