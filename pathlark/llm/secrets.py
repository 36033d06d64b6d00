"""Secrets by regular expressions behind a trigram index, in DataFrame expressions only.

Each rule's regular expression is turned into a Boolean query over lower-cased trigrams that any match
must contain (``trigram_query``). The index holds, for each trigram that the rules ask for, the documents
that have it. Postings of a rule's trigrams are intersected per document, as bits; a document whose bits
meet the query is verified with the expression itself. Rules without a mandatory trigram scan all texts.

Spans come from the pieces between matches: a match starts where the lengths of the pieces and matches
before it end. Positions are code points.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlark.llm.common import read_table
from pathlark.session import fresh_path

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse

# Kind, expression, least length of a match or of its second group. The first three are the base
# rules, in their order.
RULES = [
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 20),
    ("hex", r"[0-9a-f]{24,}", 24),
    ("github", r"gh[opsu]_[A-Za-z0-9]{36,}", 40),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 39),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 20),
    ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 20),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 20),
    ("url_password", r"[a-z]+://[A-Za-z0-9._-]+:[A-Za-z0-9._!$%-]+@", 8),
]
BASE = [r[0] for r in RULES[:3]]
#: Strings a literal part may stand for before its query is cut.
SPELLINGS = 64

ALL, ANY = "all", "any"
Query = tuple  # (ALL, parts), (ANY, parts), ("has", trigram) or ("true",)
TRUE = ("true",)


def both(a: Query, b: Query) -> Query:
    return b if a == TRUE else a if b == TRUE or a == b else (ALL, (a, b))


def either(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return TRUE if TRUE in parts or not parts else parts[0] if len(parts) == 1 else (ANY, tuple(parts))


def _of_strings(found: frozenset[str]) -> Query:
    """One of these strings is in the text."""
    one = []
    for s in sorted(found):
        grams = sorted({s[i : i + 3] for i in range(len(s) - 2)})
        one.append(reduce(both, (("has", g) for g in grams), TRUE))
    return either(one)


def _exact(op, arg) -> frozenset[str] | None:
    """The few strings that a node stands for, lower-cased, if it is that simple."""
    if op is sre.LITERAL:
        return frozenset({chr(arg).lower()})
    if op is sre.IN:
        if all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 4:
            return frozenset(chr(v).lower() for _, v in arg)
        return None
    if op is sre.SUBPATTERN:
        return _joined(arg[-1])
    if op is sre.BRANCH:
        parts = [_joined(p) for p in arg[1]]
        if any(p is None for p in parts):
            return None
        found = frozenset().union(*parts)
        return found if len(found) <= SPELLINGS else None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 1:
        inner = _joined(arg[2])
        return None if inner is None else inner | (frozenset() if arg[0] else frozenset({""}))
    return None


def _joined(nodes) -> frozenset[str] | None:
    found = frozenset({""})
    for op, arg in nodes:
        own = _exact(op, arg)
        if own is None or len(own) * len(found) > SPELLINGS:
            return None
        found = frozenset(a + b for a, b in product(found, own))
    return found


def _query(nodes) -> Query:
    out, run = TRUE, frozenset({""})
    for op, arg in nodes:
        own = _exact(op, arg)
        if own is not None and len(own) * len(run) <= SPELLINGS:
            run = frozenset(a + b for a, b in product(run, own))
            continue
        out, run = both(out, _of_strings(run)), own or frozenset({""})
        if op is sre.SUBPATTERN:
            out = both(out, _query(arg[-1]))
        elif op is sre.BRANCH and own is None:
            out = both(out, either([_query(p) for p in arg[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and own is None and arg[0] >= 1:
            out = both(out, _query(arg[2]))
    return both(out, _of_strings(run))


def trigram_query(expression: str) -> Query:
    """What trigrams the lower-cased text of any match must have."""
    return _query(sre_parse.parse(expression))


def trigrams(query: Query) -> set[str]:
    return {query[1]} if query[0] == "has" else set().union(*map(trigrams, query[1])) if query != TRUE else set()


def condition(query: Query, bits: Column, number: dict[str, int]) -> Column:
    if query == TRUE:
        return F.lit(True)
    if query[0] == "has":
        k = number[query[1]]
        return F.coalesce(F.get(bits, F.lit(k // 62)).bitwiseAND(F.lit(1 << k % 62)) != 0, F.lit(False))
    parts = [condition(q, bits, number) for q in query[1]]
    return reduce(lambda a, b: a & b if query[0] == ALL else a | b, parts)


def write_postings(docs: DataFrame, grams: list[str], out: str) -> None:
    """A row for each asked-for trigram of each text, in a folder per trigram's number."""
    has = F.array(*(F.when(F.contains(F.col("small"), F.lit(g)), F.lit(i)) for i, g in enumerate(grams)))
    docs = docs.select("doc_id", F.lower("text").alias("small"))  # a column, so that it is made once
    docs.select("doc_id", F.explode(F.array_compact(has)).alias("gram")).write.parquet(out)


def spans(text: Column, kind: str, expression: str, least: int) -> Column:
    """Matches of a rule as structs of start, rank of the kind, end and kind; leftmost, not overlapping."""
    rank = [r[0] for r in RULES].index(kind)
    regex = F.lit(expression)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    kept = F.regexp_extract_all(text, regex, F.lit(2 if kind == "assign" else 0))
    return F.when(text.rlike(expression), _placed(F.split(text, expression, -1), found, kept, rank, kind, least)).otherwise(F.array().cast(SPAN))


SPAN = "array<struct<start:long,rank:int,end:long,kind:string>>"


def _placed(pieces: Column, found: Column, kept: Column, rank: int, kind: str, least: int) -> Column:
    """Starts by sums of lengths, in blocks of 256 so that many matches cost no square of their number."""
    size = 256
    steps = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: (F.length(p) + F.length(m)).cast("long"))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / size).cast("int")), lambda b: total(F.slice(steps, b * size + 1, size)))
    start = lambda i: (
        total(F.slice(blocks, 1, F.floor(i / size).cast("int")))
        + total(F.slice(steps, (F.floor(i / size) * size + 1).cast("int"), (i % size).cast("int"))) + F.length(F.get(pieces, i)))
    placed = F.transform(found, lambda m, i: F.struct(
        start(i).alias("start"), F.lit(rank).alias("rank"), (start(i) + F.length(m)).alias("end"), F.lit(kind).alias("kind"), F.length(F.get(kept, i)).alias("n")))
    return F.transform(F.filter(placed, lambda s: s["n"] >= least), lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])).cast(SPAN)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, the spans of all rules in order of start, then of rule, for each row.

    Null and empty texts have none. Rows with equal or null doc_id stay rows of their own; their postings are
    pooled, which may verify more and changes no result. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    queries = {kind: trigram_query(rule) for kind, rule, _ in RULES}
    grams = sorted(set().union(*map(trigrams, queries.values())))
    number = {g: i for i, g in enumerate(grams)}
    out = fresh_path(spark, "postings")
    write_postings(docs, grams, out)
    postings = spark.read.schema("doc_id long, gram int").parquet(out)
    words = range(-(-len(grams) // 62))
    bit = F.expr("shiftleft(1L, gram % 62)")
    bits = postings.groupBy("doc_id").agg(F.array(*(F.coalesce(F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, bit)), F.lit(0)) for w in words)).alias("bits"))
    rules = [F.when(condition(queries[kind], F.col("bits"), number), F.lit(kind)) for kind, _, _ in RULES if queries[kind] != TRUE]
    candidates = bits.select(F.col("doc_id").alias("id"), F.array_compact(F.array(*rules)).alias("rules")).filter(F.size("rules") > 0)
    rows = docs.join(candidates, docs["doc_id"].eqNullSafe(candidates["id"]), "left")
    found = []
    for kind, rule, least in RULES:
        own = spans(F.col("text"), kind, rule, least)
        if queries[kind] != TRUE:
            own = F.when(F.array_contains("rules", kind), own).otherwise(F.array().cast(SPAN))
        found.append(own)
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("found"))


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(rank: int):
    return lambda s: s["rank"] == rank


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    counts = [F.size(F.filter("found", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


def _sql() -> str:
    quoted = [(i, kind, rule.replace("'", "''"), least) for i, (kind, rule, least) in enumerate(RULES)]
    parts = " UNION ALL ".join(f"""
SELECT r, {i} AS rank, '{kind}' AS kind, [length(x) for x in regexp_extract_all(text, '{rule}', 0)] AS m,
  [length(x) for x in regexp_extract_all(text, '{rule}', {2 if kind == "assign" else 0})] AS k,
  [length(x) for x in string_split_regex(text, '{rule}')] AS p, {least} AS least FROM t WHERE regexp_matches(text, '{rule}')"""
                           for i, kind, rule, least in quoted)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
a AS ({parts}),
b AS (SELECT r, rank, kind, least, m, k, p, unnest(range(1, len(m) + 1)) AS i FROM a),
s AS (SELECT r, rank, kind, coalesce(list_sum(p[1:i]), 0) + coalesce(list_sum(m[1:i - 1]), 0) AS s, m[i] AS n FROM b WHERE k[i] >= least),
x AS (SELECT r, rank, kind, s, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS span FROM s),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY s, rank) AS spans FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (r)
"""


ORACLE = _sql()
