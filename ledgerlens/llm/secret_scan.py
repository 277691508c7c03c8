"""Secret scans through a trigram inverted index.

From every rule's regular expression follows a Boolean query over trigrams: which of them a text must
hold for the expression to match (case folded).  The index lists, for each trigram that any rule
names, the documents holding it; a rule's candidates are the intersections of postings its query
asks for.  Only candidates are matched against the expression.  Expressions without a mandatory
trigram scan every text.

Spans are counted in code points, end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import land

try:  # the parser of regular expressions of the standard library
    from re import _constants as _c, _parser
except ImportError:
    import sre_constants as _c
    import sre_parse as _parser

MOST_STRINGS = 64  # alternatives that are still spelled out
STEP = 128  # matches whose lengths are summed as one block


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` in the common subset of Java, RE2 and Python; the match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False
    base: bool = False


# The base rules of the registered query, in their order, then those that the method adds.
RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True, True),
    SecretRule("access", r"AKIA[A-Z0-9]+", 16, base=True),
    SecretRule("hex", r"[0-9a-f]+", 32, base=True),
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
    SecretRule("hosting_token", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    SecretRule("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]+", 15),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    SecretRule("maps_key", r"AIza[A-Za-z0-9_-]+", 39),
    SecretRule("payment_key", r"[rs]k_live_[A-Za-z0-9]+", 32),
)

# A Boolean query in disjunctive form: any of the sets of trigrams must be there as a whole.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _and(one: Query, other: Query) -> Query:
    return _least(frozenset(a | b for a in one for b in other))


def _least(query: Query) -> Query:
    return frozenset(a for a in query if not any(b < a for b in query))


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _needs(strings: set[str]) -> Query:
    return _least(frozenset(_grams(s) for s in strings)) if strings else ANY


def _walk(nodes, strings: set[str], query: Query) -> tuple[set[str], Query]:
    """Extend every string that may stand just before by what follows; strings end where they cannot be spelled out.

    ``strings`` are all texts the part since the last cut may have; ``query`` holds for what came before.
    """
    for op, value in nodes:
        choices: set[str] | None = None
        if op is _c.LITERAL and value < 128:
            choices = {chr(value).lower()}
        elif op is _c.SUBPATTERN:
            strings, query = _walk(value[-1], strings, query)
            continue
        elif op is _c.BRANCH:
            parts = [_walk(branch, {""}, ANY) for branch in value[1]]
            if all(part_query == ANY for _, part_query in parts):
                choices = set().union(*(s for s, _ in parts))
            else:
                either = _least(frozenset().union(*(_and(q, _needs(s)) for s, q in parts)))
                query, strings = _and(_and(query, _needs(strings)), either), {""}
                continue
        elif op is _c.IN and all(o is _c.LITERAL for o, _ in value) and len(value) <= 8:
            choices = {chr(v).lower() for _, v in value}
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and value[:2] == (0, 1):
            inner, inner_query = _walk(value[2], {""}, ANY)
            choices = inner | {""} if inner_query == ANY else None
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and value[0] >= 1:
            inner, inner_query = _walk(value[2], {""}, ANY)
            query, strings = _and(_and(query, _needs(strings)), _and(inner_query, _needs(inner))), {""}
            continue
        if choices is not None and len(choices) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, choices)}
        else:
            query, strings = _and(query, _needs(strings)), choices if choices is not None else {""}
    return strings, query


def trigram_query(pattern: str) -> Query:
    """What a match of ``pattern`` requires, in folded case; ``ANY`` where no trigram is mandatory."""
    strings, query = _walk(_parser.parse(pattern), {""}, ANY)
    return _and(query, _needs(strings))


def build_index(df: DataFrame, grams: list[str], key: str, text: str) -> DataFrame:
    """Postings (gram, doc): the documents that hold each of ``grams``, case folded."""
    folded = df.select(F.col(key).alias("doc"), F.lower(text).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return folded.select("doc", F.explode(held).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(doc, kinds): per document, the kinds whose query the postings satisfy.

    Postings meet the clauses they belong to; a document stands in a clause's intersection if all the
    clause's trigrams list it.  Clauses follow from the rules alone.
    """
    spark = index.sparkSession
    clauses = [
        (f"{kind} {number}", kind, gram, len(clause))
        for kind, query in queries.items() for number, clause in enumerate(sorted(map(sorted, query))) for gram in clause
    ]
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("clause", "kind", "g", "size"), c)]) for c in clauses])
    wanted = spark.range(1).select(F.inline(listed))
    intersections = index.join(F.broadcast(wanted), F.col("gram") == F.col("g")).groupBy("doc", "clause", "kind", "size").agg(
        F.count_distinct("gram").alias("n")
    ).where("n = size")
    return intersections.groupBy("doc").agg(F.collect_set("kind").alias("kinds"))


def _running(lengths: Column) -> Column:
    """Running sums of an array, in blocks so that appending stays cheap for very many matches."""
    empty = F.array().cast("array<bigint>")

    def grow(state: Column, x: Column) -> Column:
        return F.struct((state["at"] + x).alias("at"), F.concat(state["out"], F.array(state["at"] + x)).alias("out"))

    def block(state: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(state["at"].alias("at"), empty.alias("out")), grow)
        return F.element_at(F.transform(F.array(inner), lambda r: F.struct(
            r["at"].alias("at"), F.concat(state["out"], F.array(r["out"])).alias("out"))), 1)

    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(STEP))
    parts = F.transform(starts, lambda s: F.slice(lengths, s, F.lit(STEP)))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
    return F.flatten(F.aggregate(parts, zero, block)["out"])


def spans(text: Column, rule: SecretRule) -> Column:
    """Array of (start, end) of the rule's leftmost non-overlapping matches that are long enough.

    The expression is run as "as little as possible, then a match or the end", which cuts the text at
    every match's end; the running lengths of the pieces are the ends.
    """
    pattern = F.lit(("(?i)" if rule.any_case else "") + rf"(?s)(.*?)(?:({rule.pattern})|\z)")
    lengths = lambda group: F.transform(F.regexp_extract_all(text, pattern, F.lit(group)), lambda s: F.char_length(s).cast("bigint"))
    ends, whole = _running(lengths(0)), lengths(2)
    counted = lengths(rule.group + 2) if rule.group else whole
    joined = F.arrays_zip(ends.alias("end"), whole.alias("n"), counted.alias("m"))
    kept = F.filter(joined, lambda x: (x["n"] > 0) & (x["m"] >= rule.least))
    return F.transform(kept, lambda x: F.struct((x["end"] - x["n"]).alias("start"), x["end"].alias("end")))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint>>")


def scan(df: DataFrame, rules: tuple[SecretRule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_<kind> for the base kinds, base_sha256, spans; one row per input row.

    spans lists kind:start:end by start, then by order of the rules, comma-joined; base_sha256 is the
    digest of the same list of base kinds.  Null and empty texts have no spans.  Rows with equal or
    null keys share postings, which only makes them candidates; their own texts decide.  Repeated
    rows stay; other columns are ignored; an empty table gives an empty result.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query != ANY}
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    if indexed:
        grams = sorted({gram for query in indexed.values() for clause in query for gram in clause})
        found = land(candidates(build_index(df, grams, key, text), indexed))
        rows = rows.join(found, F.col("k").eqNullSafe(F.col("doc")), "left")
    by_kind = []
    for rule in rules:
        if rule.kind in indexed:
            worth = F.array_contains(F.coalesce(F.col("kinds"), F.array().cast("array<string>")), F.lit(rule.kind))
        elif rule.least and rule.pattern.endswith("+") and "(" not in rule.pattern:
            worth = F.rlike("t", F.lit(f"{rule.pattern[:-1]}{{{rule.least},}}"))  # a full scan: most texts have no run this long
        else:
            worth = F.lit(True)
        by_kind.append(F.when(worth, spans(F.col("t"), rule)).otherwise(_no_spans()).alias(f"s_{rule.kind}"))
    matched = rows.select("k", *by_kind)

    def tag(rule: SecretRule) -> Column:
        place = F.lit(rules.index(rule)).alias("place")
        return F.transform(F.col(f"s_{rule.kind}"), lambda s: F.struct(
            s["start"].alias("start"), place, s["end"].alias("end"), F.lit(rule.kind).alias("kind")))

    def joined(chosen: list[SecretRule]) -> Column:
        tagged = [tag(rule) for rule in chosen]
        return F.array_join(F.transform(F.sort_array(F.concat(*tagged)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = [rule for rule in rules if rule.base]
    return matched.select(
        F.col("k").alias(key), *[F.size(f"s_{rule.kind}").cast("bigint").alias(f"n_{rule.kind}") for rule in base],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(list(rules)).alias("spans"),
    )


def sql(rules: tuple[SecretRule, ...] = RULES) -> str:
    """The same spans in SQL, every rule over every text."""
    parts, places = [], {rule.kind: i for i, rule in enumerate(rules)}
    for rule in rules:
        pattern = (("(?i)" if rule.any_case else "") + rf"(?s)(.*?)(?:({rule.pattern})|\z)").replace("'", "''")
        group = rule.group + 2 if rule.group else 2
        lists = ", ".join(f"unnest(regexp_extract_all(t, '{pattern}', {g})) AS {n}" for g, n in ((0, "piece"), (2, "match"), (group, "value")))
        parts.append(f"""
  SELECT r, '{rule.kind}' AS kind, {places[rule.kind]} AS place, ends - length(match) AS starts, ends FROM (
    SELECT r, match, value, sum(length(piece)) OVER (PARTITION BY r ORDER BY i) AS ends FROM (
      SELECT r, {lists}, unnest(range(len(regexp_extract_all(t, '{pattern}', 0)))) AS i FROM texts))
  WHERE length(match) > 0 AND length(value) >= {rule.least}""")
    base = [rule for rule in rules if rule.base]
    counts = ", ".join(f"count(*) FILTER (s.kind = '{rule.kind}') AS n_{rule.kind}" for rule in base)
    listed = "string_agg(s.kind || ':' || s.starts || ':' || s.ends, ',' ORDER BY s.starts, s.place)"
    kinds = ", ".join(f"'{rule.kind}'" for rule in base)
    return f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)})
SELECT t.doc_id, {counts}, sha256(coalesce({listed} FILTER (s.kind IN ({kinds})), '')) AS base_sha256, coalesce({listed}, '') AS spans
FROM texts t LEFT JOIN found s ON s.r = t.r GROUP BY t.r, t.doc_id
"""
