"""URL filter by the ratio of two character language models.

Rules (host and path prefix, the longest that fits wins) decide what they can.  The URLs they allow
and block are the text of two variable-order Markov models over a small alphabet; every order is
smoothed with the one below it by the number of distinct successors of its context.  A URL that no
rule fits gets the mean log-probability difference of all its characters, scheme, query and
fragment included, and is allowed from a threshold on.  The threshold is calibrated on rule-decided
URLs that the models have not seen, a fifth of them by hash: the one with the least sum of error rates.

All counts are over all URLs.  The model has at most ``len(ALPHABET)``^(ORDER+1) rows, about four
million, whatever the data; that bounds its broadcast.  With it, a URL's characters are looked up
and summed before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import hash48, land
from ledgerlens.operators.stability import materialise

ORDER = 3
START = "^"
OTHER = "*"
# Digits fold to 0; what is not listed folds to OTHER.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_~%+:@=,;!$()" + OTHER + START
BINS = 100  # calibration bins per unit of mean log-probability difference
CLIP = 2000  # bins to either side
HELD = 5  # one in so many rule-decided URLs, by hash, is kept from the models and calibrates


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rule list of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    host = F.regexp_extract(_behind(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind(url), r"^[^/?#]*([^?#]*)", 1)


def _behind(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Name of the longest rule that fits the host or one it is a subdomain of, and the path's beginning."""
    chosen = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, rule.name) if chosen is None else chosen.when(fits, rule.name)
    return F.lit(None).cast("string") if chosen is None else chosen


def symbols(text: Column) -> Column:
    """The text in the model's alphabet."""
    listed = "".join(c for c in ALPHABET if c not in "0" + OTHER + START)
    known = "".join(f"\\{c}" if not c.isalnum() else c for c in listed)
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.regexp_replace(lowered, f"[^{known}0]", OTHER)


def _grams(urls: DataFrame) -> DataFrame:
    padded = F.concat(F.lit(START * ORDER), F.col("s"))
    at = F.sequence(F.lit(1), F.length("s"))
    return urls.where(F.length("s") > 0).withColumn(
        "gram", F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(ORDER + 1))))
    )


def ratios(counts: DataFrame) -> DataFrame:
    """(gram, allow, block) counts → (gram, ratio): log-probability of its last character, allowed minus blocked."""
    lower = None
    for order in range(ORDER + 1):
        grams = counts.groupBy(F.substring("gram", ORDER + 1 - order, order + 1).alias("gram")).agg(
            F.sum("allow").alias("allow"), F.sum("block").alias("block")
        ).withColumn("context", F.substring("gram", 1, order))
        contexts = grams.groupBy("context").agg(*[
            measure for side in ("allow", "block") for measure in (
                F.sum(side).alias(f"{side}_n"), F.sum((F.col(side) > 0).cast("bigint")).alias(f"{side}_t"))
        ])
        joined = grams.join(contexts, "context")
        if lower is None:
            joined = joined.select("*", *[F.lit(1.0 / len(ALPHABET)).alias(f"{side}_below") for side in ("allow", "block")])
        else:
            below = lower.select(F.col("gram").alias("suffix"), *[F.col(f"{s}_p").alias(f"{s}_below") for s in ("allow", "block")])
            joined = joined.join(below, F.substring("gram", 2, order) == F.col("suffix"))
        lower = joined.select("gram", *[
            F.when(F.col(f"{s}_n") == 0, F.col(f"{s}_below")).otherwise(
                (F.col(s) + F.col(f"{s}_t") * F.col(f"{s}_below")) / (F.col(f"{s}_n") + F.col(f"{s}_t"))
            ).alias(f"{s}_p") for s in ("allow", "block")
        ])
    return lower.select("gram", (F.log("allow_p") - F.log("block_p")).alias("ratio"))


def calibrated_threshold(scores: DataFrame) -> Column:
    """Scalar: where the shares of blocked URLs at or above it and of allowed URLs below it sum to the least."""
    binned = scores.where("ruled is not null and held").groupBy(
        F.greatest(F.least(F.floor(F.col("score") * BINS), F.lit(CLIP)), F.lit(-CLIP)).alias("bin")
    ).agg(*[F.sum(F.when(F.col("ruled") == v, F.col("copies")).otherwise(0)).alias(v) for v in ("allow", "block")])
    # At most 2·CLIP + 1 bins, whatever the data.
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    errors = binned.select(
        "bin", F.sum("allow").over(everything).alias("a"), F.sum("block").over(everything).alias("b"),
        F.coalesce(F.sum("allow").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("block").over(below), F.lit(0)).alias("stopped"),
    ).where("a > 0 and b > 0").select("bin", (F.col("lost") / F.col("a") + (F.col("b") - F.col("stopped")) / F.col("b")).alias("error"))
    best = errors.agg(F.min_by("bin", F.struct("error", F.abs("bin"), "bin")).alias("bin"))
    return best.select(F.coalesce(F.col("bin") / F.lit(float(BINS)), F.lit(0.0))).scalar()


def judge(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, host, path, rule (null where none fits), verdict, score; one row per input row.

    A URL that is null or has no ``://`` has an empty host and path; its characters, if any, are scored
    like any other's, and none at all score 0.  Where the rules do not decide held-out URLs of both
    kinds, the threshold is 0.  Repeated rows stay; other columns are
    ignored; an empty table gives an empty result.
    """
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.verdict)]) if rules else None
    distinct = df.select(F.col(key).alias("k"), F.coalesce(F.col(url), F.lit("")).alias("u")).groupBy("k", "u").agg(F.count("*").alias("copies"))
    split = distinct.select("k", "u", "copies", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    ruled = split.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    urls = land(ruled.select(
        "k", "u", "copies", "host", "path", "rule",
        (verdicts[F.col("rule")] if rules else F.lit(None).cast("string")).alias("ruled"),
        symbols(F.col("u")).alias("s"), (hash48("u") % HELD == 0).alias("held"),
    ))
    grams = _grams(urls)
    counts = materialise(grams.groupBy("gram").agg(*[
        F.sum(F.when((F.col("ruled") == v) & ~F.col("held"), F.col("copies")).otherwise(0)).alias(v) for v in ("allow", "block")
    ]))
    model = ratios(counts).withColumnRenamed("gram", "g")
    summed = grams.join(F.broadcast(model), F.col("gram") == F.col("g")).groupBy("k", "u").agg(
        (F.sum("ratio") / F.count("*")).alias("mean")
    ).select(F.col("k").alias("k2"), F.col("u").alias("u2"), "mean")
    scores = land(
        urls.join(summed, F.col("k").eqNullSafe(F.col("k2")) & (F.col("u") == F.col("u2")), "left")
        .select("k", "host", "path", "rule", "ruled", "held", "copies", F.coalesce("mean", F.lit(0.0)).alias("score"))
    )
    threshold = calibrated_threshold(scores)
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    judged = scores.select("k", "host", "path", "rule", verdict.alias("verdict"), "score", "copies")
    return judged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(
        F.col("k").alias(key), "host", "path", "rule", "verdict", "score"
    )


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same judgement in SQL; the score is left out, as sums of logarithms follow the order of rows."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = "\n".join(
        f"    WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'" for r in ordered
    )
    verdict = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in ordered)
    listed = "".join(c for c in ALPHABET if c not in "0" + OTHER + START)
    known = "".join(f"\\{c}" if not c.isalnum() else c for c in listed)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    orders = []
    for n in range(ORDER + 1):
        below = f"{1.0 / len(ALPHABET)!r}::DOUBLE" if n == 0 else "b.{0}_p"
        p = ", ".join(
            f"CASE WHEN c.{s}_n = 0 THEN {below.format(s)} ELSE (g.{s} + c.{s}_t * {below.format(s)}) / (c.{s}_n + c.{s}_t)::DOUBLE END AS {s}_p"
            for s in ("allow", "block")
        )
        join = "" if n == 0 else f" JOIN p{n - 1} b ON b.gram = substr(g.gram, 2)"
        orders.append(f"""
g{n} AS (SELECT substr(gram, {ORDER + 1 - n}) AS gram, sum(allow)::BIGINT AS allow, sum(block)::BIGINT AS block FROM counts GROUP BY 1),
c{n} AS (SELECT substr(gram, 1, {n}) AS context, sum(allow) AS allow_n, sum(block) AS block_n,
              count(*) FILTER (allow > 0) AS allow_t, count(*) FILTER (block > 0) AS block_t FROM g{n} GROUP BY 1),
p{n} AS MATERIALIZED (SELECT g.gram, {p} FROM g{n} g JOIN c{n} c ON c.context = substr(g.gram, 1, {n}){join})""")
    return f"""
WITH behind AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS u, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
split AS (
  SELECT r, page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM behind
),
ruled AS (
  SELECT *, CASE
{fits}
  END AS rule FROM split
),
urls AS MATERIALIZED (
  SELECT *, CASE rule {verdict} END AS ruled,
         ('0x' || substr(md5(u), 1, 12))::BIGINT % {HELD} = 0 AS held,
         regexp_replace(translate(u, '{upper}123456789', '{lower}000000000'), '[^{known}0]', '{OTHER}', 'g') AS s FROM ruled
),
grams AS (
  SELECT r, ruled, held, substr('{START * ORDER}' || s, i, {ORDER + 1}) AS gram FROM (SELECT r, ruled, held, s, unnest(range(1, length(s) + 1)) AS i FROM urls)
),
counts AS MATERIALIZED (
  SELECT gram, count(*) FILTER (ruled = 'allow' AND NOT held) AS allow, count(*) FILTER (ruled = 'block' AND NOT held) AS block FROM grams GROUP BY gram
),{",".join(orders)},
means AS (
  SELECT r, sum(ln(p.allow_p) - ln(p.block_p)) / count(*) AS mean FROM grams g JOIN p{ORDER} p ON p.gram = g.gram GROUP BY r
),
scores AS MATERIALIZED (
  SELECT u.*, coalesce(m.mean, 0.0) AS score FROM urls u LEFT JOIN means m ON m.r = u.r
),
binned AS (
  SELECT greatest(least(floor(score * {BINS})::BIGINT, {CLIP}), -{CLIP}) AS bin, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
  FROM scores WHERE ruled IS NOT NULL AND held GROUP BY 1
),
errors AS (
  SELECT bin, (sum(a) OVER w - a)::DOUBLE / sum(a) OVER () + (sum(b) OVER () - sum(b) OVER w + b)::DOUBLE / sum(b) OVER () AS error
  FROM binned WHERE (SELECT sum(a) > 0 AND sum(b) > 0 FROM binned) WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING)
),
chosen AS (SELECT coalesce((SELECT bin FROM errors ORDER BY error, abs(bin), bin LIMIT 1) / {float(BINS)}::DOUBLE, 0.0) AS threshold)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict FROM scores, chosen
"""
