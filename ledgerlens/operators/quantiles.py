"""Exact quantiles and order statistics that neither sort nor gather a group into one task.

Selection by refinement: values are counted in buckets that keep their order (by sign and magnitude
first, map-side folded), the buckets holding wanted positions are found in that small table, and only
their values are counted again, in finer buckets, until a bucket holds one value.  No row is shuffled
but the counts; a value held by a third of all rows is one count.  Where the distinct values themselves
are wanted in order (bin borders of whole distributions), :func:`place_counts` places them in slots.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import Placement, place, unfold
from ledgerlens.operators.stability import landed


def value_counts(df: DataFrame, value: str, by=()) -> DataFrame:
    """(by, value, n) without nulls and NaNs."""
    return (
        df.select(*by, F.col(value).alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def place_counts(counts: DataFrame, by=()) -> Placement:
    """Distinct values with their counts, cut into ordered slots per group."""
    return place(counts, [F.col("value")], sums=["n"], by=by)


def _pick(placement: Placement, wanted) -> DataFrame:
    """One row per group with v0, v1, … = the values at the 0-based positions ``wanted(total)``."""
    by = list(placement.by)
    # The slot table has at most slots + groups rows; the group totals ride along with its rows.
    slots = placement.slots.withColumn("total", F.sum("_in_n").over(Window.partitionBy(*by)))
    positions = wanted(F.col("total"))

    def holds(start: Column, size: Column, position: Column) -> Column:
        return (start <= position) & (position < start + size)

    touched = slots.where(
        reduce(lambda x, y: x | y, [holds(F.col("_before_n"), F.col("_in_n"), p) for p in positions])
    )
    rows = unfold(placement, touched, carry=["total"])
    start = F.col("cum_n") - F.col("n")
    return rows.groupBy(*by).agg(
        F.max("total").alias("total"),
        *[F.max(F.when(holds(start, F.col("n"), p), F.col("value"))).alias(f"v{i}") for i, p in enumerate(positions)],
    )


def quantiles_placed(placement: Placement, probs: Sequence[float], alias: str = "q") -> DataFrame:
    """Linear-interpolation quantiles (the numpy/SQL ``percentile_cont`` rule) as one array per group."""

    return _interpolated(_pick(placement, _spots(probs)), probs, placement.by, alias)


MAGNITUDES = 8  # first buckets: so many per doubling
FINE = 4096  # buckets that a bucket is cut into


def _by_magnitude(value: Column) -> Column:
    """A whole number that never falls as the value rises: sign, and the logarithm of the size in eighths of a doubling."""
    size = F.log2(F.abs(value).cast("double"))
    step = F.floor(F.greatest(F.least(size, F.lit(1100.0)), F.lit(-1100.0)) * MAGNITUDES).cast("int")
    return F.when(value == 0, F.lit(0)).when(value > 0, step + 10_000).otherwise(-(step + 10_000))


def selected(df: DataFrame, value: str, wanted, by=()) -> DataFrame:
    """One row per group with ``total`` and v0, v1, … = the values at the 0-based positions ``wanted(total)``; null outside 0..total−1.

    Nulls and NaNs take no part.  The values are written once and read per round: one pass by
    magnitude, then one for each further 12 bits that the wanted values need to be told apart.
    Between rounds the driver holds one row per group and position; groups are columns, quarters
    and the like, not customers.
    """
    keys = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    x, spark = F.col("value"), df.sparkSession
    values = landed(rows.select(*keys, F.col(value).alias("value")).where(x.isNotNull() & ~F.isnan(x.cast("double"))))
    count = len(wanted(F.lit(1)))
    spot = F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    # As many buckets as groups times magnitudes: bounded by the number format.
    whole, running = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bucket")
    buckets = values.groupBy(*keys, _by_magnitude(x).alias("bucket")).agg(*spot).withColumns(
        {"total": F.sum("n").over(whole), "upto": F.sum("n").over(running)})
    position, total, before = F.col("position"), F.col("total"), F.col("upto") - F.col("n")
    holds = (position >= before) & (position < F.col("upto"))
    outside = ((position < 0) | (position >= total)) & (F.col("upto") == total)
    found = buckets.withColumn("spots", F.array(*[p.cast("bigint") for p in wanted(total)])).select(
        *keys, "total", "n", "lo", "hi", "upto", F.posexplode("spots").alias("spot", "position")).where(holds | outside).select(
        *keys, "total", "spot", (position - before).alias("inside"), F.when(holds, F.col("lo")).alias("lo"), F.when(holds, F.col("hi")).alias("hi"))
    shape, hits = found.schema, [tuple(r) for r in found.collect()]
    low, high = len(keys) + 3, len(keys) + 4
    while any(h[low] is not None and h[low] < h[high] for h in hits):
        told = [h for h in hits if h[low] is None or not h[low] < h[high]]
        open_ = spark.createDataFrame([h for h in hits if h[low] is not None and h[low] < h[high]], shape).toDF(
            *[f"_{k}" for k in keys], "total", "spot", "inside", "from", "to")
        ranges = open_.select(*[f"_{k}" for k in keys], "from", "to").distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        share = (x - F.col("from")).cast("double") / (F.col("to") - F.col("from")).cast("double")
        cut = values.join(ranges, same & (x >= F.col("from")) & (x <= F.col("to"))).groupBy(
            *keys, "from", F.least(F.floor(share * FINE), F.lit(FINE - 1)).cast("int").alias("bucket")).agg(*spot)
        cut = cut.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "from").orderBy("bucket"))).withColumnRenamed("from", "low")
        into = cut.join(open_, same & (F.col("low") == F.col("from")) & (F.col("inside") < F.col("upto")) & (F.col("inside") >= before))
        hits = told + [tuple(r) for r in into.select(*keys, "total", "spot", (F.col("inside") - before).alias("inside"), "lo", "hi").collect()]
    return spark.createDataFrame(hits, shape).groupBy(*keys).agg(
        F.max("total").alias("total"), *[F.max(F.when(F.col("spot") == i, F.col("lo"))).alias(f"v{i}") for i in range(count)]).drop("_all")


def _interpolated(picked: DataFrame, probs: Sequence[float], by, alias: str) -> DataFrame:
    values = []
    for i, p in enumerate(probs):
        position = (F.col("total") - 1).cast("double") * F.lit(float(p))
        low, high = F.col(f"v{2 * i}").cast("double"), F.col(f"v{2 * i + 1}").cast("double")
        values.append(low + (high - low) * (position - F.floor(position)))
    return picked.select(*by, F.array(*values).alias(alias), F.col("total").alias("n"))


def _spots(probs: Sequence[float]):
    def spots(total: Column) -> list[Column]:
        out = []
        for p in probs:
            position = (total - 1).cast("double") * F.lit(float(p))
            out += [F.floor(position).cast("bigint"), F.ceil(position).cast("bigint")]
        return out

    return spots


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by=(), alias: str = "q") -> DataFrame:
    """Exact quantiles of ``value`` per group: (by, q array<double>, n)."""
    return _interpolated(selected(df, value, _spots(probs), by), probs, by, alias)


def quantiles_many(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns in one pass: (column, q, n)."""
    return quantiles(melt(df, columns), "value", probs, by=["column"])


def melt(df: DataFrame, columns: Sequence[str], keep=(), name: str = "column") -> DataFrame:
    """Long form (keep…, name, value double) of numeric columns."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    return df.select(*keep, F.expr(f"stack({len(columns)}, {pairs}) as (`{name}`, value)"))


def scalar_quantile(df: DataFrame, value: str, p: float) -> Column:
    """One exact quantile as a scalar subquery usable inside any expression."""
    return quantiles(df, value, [p]).select(F.col("q")[0]).scalar()


def order_statistic(df: DataFrame, value: str, position) -> DataFrame:
    """(total, v0): the value at 1-based position ``position(total)``, null when it lies outside; no row without values."""
    return selected(df, value, lambda total: [position(total) - 1])
