"""Exploration tables: profiles, series, histograms, correlations, concentration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.money import exact_sum, in_units
from ledgerlens.operators.quantiles import melt, quantiles, scalar_quantile
from ledgerlens.operators.ranking import by_score, place, unfold, whole
from ledgerlens.operators.stability import landed, ship


def null_profile(df: DataFrame) -> DataFrame:
    """(column, missing, missing_pct) for columns that have nulls; one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return (
        counts.select("total", F.expr(f"stack({len(df.columns)}, {pairs}) as (`column`, missing)"))
        .where("missing > 0")
        .select("column", "missing", F.round(F.col("missing") * 100.0 / F.col("total"), 1).alias("missing_pct"))
        .orderBy(F.desc("missing"), "column")
    )


def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, quartiles exact; ``df`` is worked out once, its values are written."""
    long = landed(melt(df, columns).where(F.col("value").isNotNull()))
    moments = long.groupBy("column").agg(
        F.count("value").alias("n"), F.round(F.avg("value"), digits).alias("mean"),
        F.round(F.stddev_samp("value"), digits).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quartiles = quantiles(long, "value", [0.25, 0.5, 0.75], by=["column"]).drop("n")
    return moments.join(quartiles, "column").select(
        "column", "n", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max",
    )


def overview(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("CustomerID").alias("n_customers"),
        F.count_distinct("StockCode").alias("n_products"),
        F.to_date(F.min("InvoiceDate")).cast("string").alias("first_day"),
        F.to_date(F.max("InvoiceDate")).cast("string").alias("last_day"),
    )


def top_countries(tx: DataFrame, n: int) -> DataFrame:
    return (
        tx.groupBy(F.col("Country").alias("country")).agg(in_units(exact_sum("TotalPrice")).alias("revenue"))
        .orderBy(F.desc("revenue"), "country").limit(n)
    )


def monthly_series(tx: DataFrame) -> DataFrame:
    """Distinct invoices, revenue and distinct customers per month."""
    # Lines fold to one row per invoice before the distinct counts multiply their input.
    invoices = tx.groupBy(F.col("year_month").alias("month"), "InvoiceNo", "CustomerID").agg(
        exact_sum("TotalPrice").alias("revenue"))
    return invoices.groupBy("month").agg(
        F.count_distinct("InvoiceNo").alias("transactions"),
        in_units(F.sum("revenue")).alias("revenue"),
        F.count_distinct("CustomerID").alias("customers"),
    )


def _bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the top edge belongs to the last bin."""
    width = (high - low) / F.lit(bins)
    return F.coalesce(F.least(F.floor(F.try_divide(value - low, width)), F.lit(bins - 1)), F.lit(0)).cast("int")


def histogram(df: DataFrame, value: str, bins: int, by=(), upper_quantile: float | None = None,
              lower_quantile: float | None = None, clip: bool = False) -> DataFrame:
    """(by…, bin, n, bin_start, bin_end) over fixed equal-width bins.

    Quantile bounds either drop what lies beyond them or, with ``clip``, fold it into the end bins.
    """
    x = F.col(value).cast("double")
    probs = [0.0 if lower_quantile is None else lower_quantile, 1.0 if upper_quantile is None else upper_quantile]
    if lower_quantile is None and upper_quantile is None:
        bounds = df.agg(F.array(F.min(x), F.max(x)).alias("q"))
    else:
        bounds = quantiles(df, value, probs)
    edge = bounds.select("q").scalar()
    placed = df.where(x.isNotNull()).withColumns({"_low": edge[0], "_high": edge[1]})
    if clip:
        x = F.least(F.greatest(x, F.col("_low")), F.col("_high"))
    else:
        placed = placed.where((x >= F.col("_low")) & (x <= F.col("_high")))
    width = (F.col("_high") - F.col("_low")) / F.lit(bins)
    return placed.groupBy(
        *by, _bin_number(x, F.col("_low"), F.col("_high"), bins).alias("bin"), "_low", "_high"
    ).agg(F.count(F.lit(1)).alias("n")).select(
        *by, "bin", "n", (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"),
    )


def _comoments(x: np.ndarray) -> np.ndarray:
    """Per ordered pair of columns, over rows where both exist: n, mean of the first, and sums of squares and products about the means."""
    known = ~np.isnan(x)
    there = known.astype(float)
    n = there.T @ there
    filled = np.where(known, x, 0.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        near = np.where(there.sum(axis=0) > 0, filled.sum(axis=0) / there.sum(axis=0), 0.0)  # shift towards the means before squaring
        moved = np.where(known, x - near, 0.0)
        mean = np.where(n > 0, (moved.T @ there) / n, 0.0)
        square = (moved * moved).T @ there - n * mean * mean
        product = moved.T @ moved - n * mean * mean.T
    return np.stack([n, mean + near[:, None], square, product])


def correlations(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Strict lower triangle of the correlation matrix, pairwise over rows where both values exist.

    A task adds up the moments of its rows in matrix products, one row per customer going in and one
    per pair of features coming out; nulls and NaNs are masks.  Moments of tasks meet about their common
    mean, so large means cost no digits.
    """
    names = list(columns)
    ship(df.sparkSession)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, mean, square, product = _comoments(np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1))
                i, j = np.tril_indices(len(names), -1)
                values = (n[i, j], mean[i, j], mean[j, i], square[i, j], square[j, i], product[i, j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, values)], ["i", "j", "n", "mx", "my", "xx", "yy", "xy"])

    parts = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).mapInArrow(
        moments, "i int, j int, n double, mx double, my double, xx double, yy double, xy double").where("n > 0")
    pair = Window.partitionBy("i", "j")  # one row per batch of rows
    middle = lambda m: F.sum(F.col("n") * F.col(m)).over(pair) / F.sum("n").over(pair)
    parts = parts.withColumns({"mean_x": middle("mx"), "mean_y": middle("my")})
    shifted = parts.withColumns({"dx": F.col("mx") - F.col("mean_x"), "dy": F.col("my") - F.col("mean_y")})
    whole = lambda c, a, b: F.sum(F.col(c) + F.col("n") * F.col(a) * F.col(b))
    sums = shifted.groupBy("i", "j").agg(
        whole("xx", "dx", "dx").alias("xx"), whole("yy", "dy", "dy").alias("yy"), whole("xy", "dx", "dy").alias("xy"),
        F.sum(F.col("n") * F.col("mean_x") * F.col("mean_x")).alias("size_x"), F.sum(F.col("n") * F.col("mean_y") * F.col("mean_y")).alias("size_y"))
    label = F.array(*[F.lit(n) for n in names])
    # A constant column has no correlation: what is left of its variance is rounding.
    varies = (F.col("xx") > F.col("size_x") * 1e-26) & (F.col("yy") > F.col("size_y") * 1e-26)
    r = F.when(varies, F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))
    return sums.select(label[F.col("i")].alias("row_feature"), label[F.col("j")].alias("col_feature"),
                       (r if digits is None else F.round(r, digits)).alias("r"))


def revenue_concentration(tx: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Share of revenue held by the top share of customers: (share, n_customers, revenue_share)."""
    customers = tx.groupBy(F.col("CustomerID").alias("customer_id")).agg(exact_sum("TotalPrice").alias("revenue"))
    placement = place(customers, by_score("revenue"), sums=["revenue"])
    size, ranked = whole(placement), unfold(placement)
    # Each row carries the shares it closes (usually none), so the table is read once.
    closing = F.array_compact(F.array(*[
        F.when(F.col("rank") == F.floor(size["n"] * F.lit(float(s))), F.lit(float(s))) for s in shares
    ]))
    return ranked.select("rank", "cum_revenue", F.explode(closing).alias("share"), size["revenue"].alias("total")).select(
        "share", F.col("rank").alias("n_customers"),
        F.round(F.col("cum_revenue").cast("double") / F.col("total").cast("double"), 9).alias("revenue_share"),
    )


def quantile_below(df: DataFrame, value: str, p: float) -> DataFrame:
    """Rows strictly below the p-quantile (the scatter filters)."""
    return df.where(F.col(value) < scalar_quantile(df, value, p))


def rank_slice(df: DataFrame, score: str, start: int, stop: int, key: str = "customer_id") -> DataFrame:
    """Rows ranked start+1..stop by score; only the top ``stop`` rows leave the executors' heaps."""
    top = df.orderBy(*by_score(score, key)).limit(stop)
    order = Window.orderBy(*by_score(score, key))  # at most ``stop`` rows remain here
    return top.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") > start)
