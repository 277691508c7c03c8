"""Cleaning rules, outlier caps, currency conversion and the temporal split."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import Settings
from ledgerlens.operators.quantiles import melt, quantiles
from ledgerlens.schemas import INVOICE_LINE_COLUMNS, require_columns


def rules(settings: Settings) -> dict[str, Column]:
    """The row filters in the order they apply."""
    return {
        "has_customer": F.col("CustomerID").isNotNull(),
        "not_cancelled": ~F.coalesce(F.col("InvoiceNo").startswith("C"), F.lit(False)),
        "is_product": ~F.coalesce(F.col("StockCode").isin(*settings.non_product_codes), F.lit(False)),
        "positive": (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0),
    }


def valid_lines(raw: DataFrame, settings: Settings) -> DataFrame:
    require_columns(raw, INVOICE_LINE_COLUMNS)
    for condition in rules(settings).values():
        raw = raw.where(condition)
    return raw


def outlier_caps(valid: DataFrame, percentile: float) -> DataFrame:
    """One row (cap_quantity, cap_price): each column's own percentile, rounded to BIGINT."""
    found = quantiles(melt(valid, ["Quantity", "UnitPrice"]), "value", [percentile / 100.0], by=["column"])

    def cap(name: str) -> Column:
        return F.max(F.when(F.col("column") == name, F.round(F.col("q")[0]).cast("bigint")))

    return found.agg(cap("Quantity").alias("cap_quantity"), cap("UnitPrice").alias("cap_price"))


def price_lines(valid: DataFrame, caps: DataFrame | None, settings: Settings) -> DataFrame:
    """Cap, convert, and multiply out."""
    if caps is not None:
        valid = valid.withColumns({
            "Quantity": F.least("Quantity", caps.select("cap_quantity").scalar()),
            "UnitPrice": F.least("UnitPrice", caps.select("cap_price").scalar()),
        })
    if settings.convert_to_inr:
        valid = valid.withColumn("UnitPrice", F.col("UnitPrice") * F.lit(settings.inr_rate))
    return valid.withColumns({
        "TotalPrice": F.col("Quantity") * F.col("UnitPrice"),
        "year_month": F.date_format("InvoiceDate", "yyyy-MM"),
    })


def clean(raw: DataFrame, settings: Settings, caps: DataFrame | None = None) -> DataFrame:
    """All rules, then winsorising at the configured percentile, conversion and line totals."""
    valid = valid_lines(raw, settings)
    if caps is None:
        caps = outlier_caps(valid, settings.outlier_percentile)
    return price_lines(valid, caps, settings)


def retention_report(raw: DataFrame, settings: Settings) -> DataFrame:
    """Rows left after each rule, counted in one scan: (step, n_rows, pct_of_raw)."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("raw")]
    for name, condition in rules(settings).items():
        passed = passed & condition
        counts.append(F.count_if(passed).alias(name))
    steps = ["raw", *rules(settings)]
    pairs = ", ".join(f"{i}, '{name}', {name}" for i, name in enumerate(steps))
    return (
        raw.agg(*counts)
        .select("raw", F.expr(f"stack({len(steps)}, {pairs}) as (step_no, step, n_rows)"))
        .select("step_no", "step", "n_rows",
                F.round(F.try_divide(F.col("n_rows") * 100.0, F.col("raw")), 1).alias("pct_of_raw"))
    )


def between_dates(tx: DataFrame, first: date, last: date) -> DataFrame:
    """Rows whose calendar day lies in [first, last]; the range reaches the Parquet scan.

    A month column, where the table has one, gets its own range: stored tables are partitioned by it.
    """
    if "year_month" in tx.columns:
        tx = tx.where(F.col("year_month").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    stamp = F.col("InvoiceDate")
    return tx.where((stamp >= F.lit(first)) & (stamp < F.lit(last + timedelta(days=1))))


def temporal_split(tx: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(observation, holdout); the windows never overlap."""
    return (
        between_dates(tx, settings.observation_start, settings.observation_end),
        between_dates(tx, settings.holdout_start, settings.holdout_end),
    )
