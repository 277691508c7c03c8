"""Mixing sources to target weights by hash-threshold histograms.

Sizes are summed by source and hash bucket.  A source's budget is some whole repeats of it plus a
rest; the rest is the documents whose hash lies under a threshold.  The threshold's bucket follows
from the running sums of the buckets; only that bucket is summed again by finer hash bits, and so on
until the bits are spent.  Budgets are nested: a larger one takes the same documents and more.
Documents are filtered by comparing their hash with their source's threshold; nothing is sorted but
the at most 4,096 buckets of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import hash48, land, word_count
from ledgerlens.operators.ranking import running_totals
from ledgerlens.operators.stability import materialise

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
MOST = 3  # a target is at most this many times its source's size
HASH_BITS = 48
LEVEL_BITS = 12
SALTS = 32


def _sized(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    return df.select(F.col(source).cast("string").alias("src"), word_count(text).alias("size"), hash48(key).alias("h"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, sources: int | None = None) -> DataFrame:
    """(src, source_size) → with target.  Sources rank by code point, null last.

    A cap binds for the sources with the least cap per weight.  With the first k of them at their
    caps, the others get (total − caps)/(other weights) per unit of weight; the largest such rate
    over k is the one at which shares add up to the total.  ``sources``: how many there are, if known.
    """
    ranked = running_totals(sizes.withColumn("nul", F.col("src").isNull()), order=[F.col("nul"), F.col("src")]).select(
        "src", "source_size", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
        .cast("bigint").alias("weight"),
    )
    capped = ranked.withColumn("cap", F.col("source_size") * most).withColumn("nul", F.col("src").isNull())
    ordered = materialise(running_totals(
        capped.withColumn("room", F.col("cap") / F.col("weight")), order=[F.col("room"), F.col("nul"), F.col("src")], sums=("cap", "weight"),
    ), sources)
    whole = ordered.agg(F.struct(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))).scalar()
    total, weight = whole["size"], whole["weight"]
    rate = ordered.agg(F.max(
        (total - (F.col("cum_cap") - F.col("cap"))) / (weight - (F.col("cum_weight") - F.col("weight")))
    )).scalar()
    return ordered.select("src", "source_size", F.least(F.col("cap").cast("double"), rate * F.col("weight")).alias("target"))


def thresholds(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: src, source_size, target, repeats, cut (48-bit hash; documents below it are taken once more)."""
    rows = land(_sized(df, key, text, source))
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    sources = sizes.count()  # the rows of all tables below but the buckets
    targets = materialise(source_targets(sizes, weights, most, sources), sources)
    repeats = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    state = targets.select(
        "src", "source_size", "target", repeats.cast("bigint").alias("repeats"), F.lit(0).cast("bigint").alias("prefix"),
        F.lit(0).cast("bigint").alias("before"),
    ).withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size"))
    for used in range(LEVEL_BITS, HASH_BITS + 1, LEVEL_BITS):
        bucket = F.shiftright("h", HASH_BITS - used)
        if used == LEVEL_BITS:
            within = rows
        else:  # only the boundary bucket of each source goes on; it is spread by hash, so no source is hot
            border = state.select(F.col("src").alias("s"), "prefix")
            within = rows.join(
                border, F.col("src").eqNullSafe(F.col("s")) & (F.shiftright("h", HASH_BITS - used + LEVEL_BITS) == F.col("prefix")), "left_semi",
            )
        sums = within.groupBy("src", bucket.alias("bucket")).agg(F.sum("size").alias("inside"))
        earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = sums.withColumn("ahead", F.coalesce(F.sum("inside").over(earlier), F.lit(0))).withColumnRenamed("src", "s")
        fits = state.drop("prefix", "inside").join(buckets, F.col("src").eqNullSafe(F.col("s"))).where(
            F.col("before") + F.col("ahead") <= F.col("rest")
        )
        last = F.max_by(F.struct("bucket", "ahead", "inside"), "bucket").alias("last")
        state = materialise(
            fits.groupBy("src", "source_size", "target", "repeats", "rest", "before").agg(last).select(
                "src", "source_size", "target", "repeats", "rest", F.col("last.bucket").alias("prefix"),
                (F.col("before") + F.col("last.ahead")).alias("before"), F.col("last.inside").alias("inside"),
            ), sources,
        )
    nearer = F.col("before") + F.col("inside") / 2.0 <= F.col("rest")
    return land(state.select("src", "source_size", "target", "repeats", (F.col("prefix") + nearer.cast("bigint")).alias("cut")))


def planned(df: DataFrame, cuts: DataFrame, key: str, source: str, columns: list[Column]) -> DataFrame:
    """``columns`` of ``df`` with its source's cuts and ``_copies``, how often the mix takes the row.

    A source may hold a third of all rows, so both sides carry a salt: should the join shuffle, a
    source spreads over ``SALTS`` tasks.
    """
    salted = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        *[F.col(c).alias(f"_{c}") for c in ("src", "source_size", "target", "repeats", "cut")], "_salt",
    )
    rows = df.select(*columns, F.col(source).cast("string").alias("_from"), hash48(key).alias("_h"))
    rows = rows.withColumn("_spread", F.pmod(F.col("_h"), F.lit(SALTS)).cast("int"))
    joined = rows.join(salted, F.col("_from").eqNullSafe(F.col("_src")) & (F.col("_spread") == F.col("_salt")))
    return joined.withColumn("_copies", F.col("_repeats") + (F.col("_h") < F.col("_cut")).cast("bigint"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key``, size (words), source_size, target, taken (words the mix takes, repeats counted); one row per input row.

    Null texts have size 0; a null source is a source of its own, ranked last; null keys share one
    hash.  Rows that repeat a key are taken or left together.  An empty table gives an empty result.
    """
    cuts = thresholds(df, key, text, source)
    rows = planned(df, cuts, key, source, [F.col(key).alias("_key"), word_count(text).alias("_size")])
    return rows.select(
        F.col("_key").alias(key), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def take(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the mix: each row as often as it is taken, all columns kept."""
    cuts = thresholds(df, key, text, source)
    rows = planned(df, cuts, key, source, [F.col(c).alias(f"in_{i}") for i, c in enumerate(df.columns)])
    repeated = rows.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return repeated.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(df.columns)])


def sql(weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> str:
    """The same mix in SQL, with documents sorted by hash."""
    listed = ", ".join(map(str, weights))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS h
  FROM documents
),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([{listed}])[(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {len(weights)} + 1]::BIGINT AS weight
  FROM sized GROUP BY source
),
capped AS (
  SELECT *, {most} * source_size AS cap,
         sum({most} * source_size) OVER byroom - {most} * source_size AS caps, sum(weight) OVER byroom - weight AS weights,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS total_weight
  FROM ranked
  WINDOW byroom AS (ORDER BY ({most} * source_size)::DOUBLE / weight, source IS NULL, encode(source) ROWS UNBOUNDED PRECEDING)
),
targets AS (
  SELECT source, source_size,
         least(cap::DOUBLE, max((total - caps)::DOUBLE / (total_weight - weights)::DOUBLE) OVER () * weight) AS target
  FROM capped
),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN least({most}, floor(target / source_size)) ELSE 0 END::BIGINT AS repeats FROM targets
),
grouped AS (
  SELECT source, h, sum(size)::BIGINT AS inside FROM sized GROUP BY source, h
),
running AS (
  SELECT source, h, inside, sum(inside) OVER (PARTITION BY source ORDER BY h) - inside AS before FROM grouped
)
SELECT s.doc_id, s.size, p.source_size, p.target,
       (s.size * (p.repeats + (r.before::BIGINT + r.inside / 2.0 <= p.target - p.repeats * p.source_size)::BIGINT))::BIGINT AS taken
FROM sized s
JOIN planned p ON p.source IS NOT DISTINCT FROM s.source
JOIN running r ON r.source IS NOT DISTINCT FROM s.source AND r.h = s.h
"""
