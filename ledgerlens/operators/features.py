"""Customer features.

Lines are folded bottom-up — (customer, invoice, day) → (customer, day) → customer — so every
shuffle carries partial sums and a customer owning a third of all lines is reduced map-side first.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.money import exact_sum, in_units, minor_ratio
from ledgerlens.operators.stability import materialise


def order_totals(tx: DataFrame) -> DataFrame:
    """One row per customer, invoice and day."""
    return tx.groupBy(
        F.col("CustomerID").alias("customer_id"), "InvoiceNo", F.to_date("InvoiceDate").alias("day")
    ).agg(exact_sum("TotalPrice").alias("revenue"), F.sum("Quantity").alias("items"))


def daily_totals(tx: DataFrame, extra=()) -> DataFrame:
    """One row per customer and day (and ``extra`` keys)."""
    return tx.groupBy(*extra, F.col("CustomerID").alias("customer_id"), F.to_date("InvoiceDate").alias("day")).agg(
        exact_sum("TotalPrice").alias("revenue")
    )


def _rfm_measures(end: Column) -> list[Column]:
    repeats = F.count(F.lit(1)) - 1
    later_revenue = F.sum("revenue") - F.min_by("revenue", "day")
    return [
        repeats.alias("frequency"),
        F.date_diff(F.max("day"), F.min("day")).alias("recency"),
        F.date_diff(end, F.min("day")).alias("T"),
        F.coalesce(minor_ratio(later_revenue, F.nullif(repeats, F.lit(0))), F.lit(0.0)).alias("monetary_value"),
    ]


def rfm_from_days(days: DataFrame, end: date) -> DataFrame:
    return days.groupBy("customer_id").agg(*_rfm_measures(F.lit(end)))


def rfm_summary(tx: DataFrame, observation_end: date) -> DataFrame:
    """(customer_id, frequency, recency, T, monetary_value) with purchases counted by day."""
    return rfm_from_days(daily_totals(tx), observation_end)


def quarter_name(day: Column | str) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def quarterly_rfm(tx: DataFrame, min_rows: int) -> DataFrame:
    """RFM of every quarter on its own rows, for quarters with more than ``min_rows`` lines; one job."""
    lines = tx.withColumn("quarter_start", F.trunc(F.to_date("InvoiceDate"), "quarter"))
    days = daily_totals(lines, extra=["quarter_start"])
    last_day = F.date_sub(F.add_months("quarter_start", 3), 1)
    customers = days.groupBy("quarter_start", "customer_id").agg(
        *_rfm_measures(F.first(last_day))
    )
    # One row per quarter, from a scan of the date column alone.
    busy = lines.groupBy("quarter_start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_rows)
    return customers.join(busy.select("quarter_start"), "quarter_start", "left_semi").select(
        quarter_name("quarter_start").alias("quarter"),
        "customer_id", "frequency", "recency", "T", "monetary_value",
    )


def with_cohort(customers: DataFrame, first_day: str = "first_day") -> DataFrame:
    """Add ``cohort_month`` and ``cohort_index`` (position of the month among those that occur).

    The list of months is as long as the calendar, whatever the number of customers.
    """
    month = F.date_format(first_day, "yyyy-MM")
    months = customers.agg(F.array_sort(F.collect_set(month))).scalar()
    return customers.withColumns({
        "cohort_month": month,
        "cohort_index": F.array_position(months, month).cast("int"),
    })


def _gap_deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from integer moments: exact up to the final division."""
    spread = (n * squares - total * total).cast("double")
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double")))


def return_rates(raw: DataFrame) -> DataFrame:
    """Share of a customer's raw lines that are cancellations."""
    cancelled = F.coalesce(F.col("InvoiceNo").startswith("C"), F.lit(False))
    return raw.where(F.col("CustomerID").isNotNull()).groupBy(F.col("CustomerID").alias("customer_id")).agg(
        (F.count_if(cancelled).cast("double") / F.count(F.lit(1)).cast("double")).alias("return_rate")
    )


def customer_features(tx: DataFrame, raw: DataFrame, observation_end: date) -> DataFrame:
    """RFM core, nine behavioural features, cohort and revenue: 16 columns next to the key.

    ``raw`` holds the uncleaned lines of the same window; only the return rate looks at them.
    """
    days = order_totals(tx).groupBy("customer_id", "day").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("items").alias("items"),
        F.count(F.lit(1)).alias("orders"),
        F.max("revenue").alias("top_order"),
    )
    # Bounded by the calendar: at most one row per customer and day reaches this window.
    by_day = Window.partitionBy("customer_id").orderBy("day")
    gap = F.date_diff("day", F.lag("day").over(by_day)).cast("bigint")
    base = days.withColumn("gap", gap).groupBy("customer_id").agg(
        *_rfm_measures(F.lit(observation_end)),
        F.min("day").alias("first_day"),
        F.count_distinct(F.date_format("day", "yyyy-MM")).alias("active_months"),
        F.sum("orders").alias("n_orders"),
        F.sum("items").alias("n_items"),
        minor_ratio(F.sum("revenue"), F.sum("orders")).alias("avg_order_value"),
        in_units(F.max("top_order")).alias("max_order_value"),
        _gap_deviation(F.count("gap"), F.sum("gap"), F.sum(F.col("gap") * F.col("gap"))).alias("std_interpurchase_days"),
        in_units(F.sum("revenue")).alias("total_revenue"),
    )
    products = (
        tx.groupBy(F.col("CustomerID").alias("customer_id"), "StockCode").agg(F.lit(1).alias("one"))
        .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_products"))
    )
    # Written once: the cohort list below looks at all customers before it can number any of them.
    return (
        with_cohort(materialise(base.join(products, "customer_id")))
        .join(return_rates(raw), "customer_id", "left")
        .select(
            "customer_id", "frequency", "recency", "T", "monetary_value",
            F.col("T").alias("tenure_days"), "active_months", "n_orders", "n_items", "n_products",
            "avg_order_value", "max_order_value",
            F.coalesce("std_interpurchase_days", F.lit(0.0)).alias("std_interpurchase_days"),
            F.coalesce("return_rate", F.lit(0.0)).alias("return_rate"),
            "cohort_month", "cohort_index", "total_revenue",
        )
    )


def holdout_actuals(tx: DataFrame) -> DataFrame:
    """(customer_id, holdout_revenue)."""
    return tx.groupBy(F.col("CustomerID").alias("customer_id")).agg(
        in_units(exact_sum("TotalPrice")).alias("holdout_revenue")
    )


def cohort_retention(tx: DataFrame) -> DataFrame:
    """(cohort, month_num, n_active, retention): share of each cohort that bought in month k.

    A customer's months form a set no longer than the calendar, so one shuffle by customer is enough.
    """
    month_no = (F.year("InvoiceDate") * 12 + F.month("InvoiceDate") - 1).cast("int")
    active = (
        tx.groupBy(F.col("CustomerID").alias("customer_id")).agg(F.collect_set(month_no).alias("months"))
        .withColumn("first", F.array_min("months"))
        .select("first", F.explode("months").alias("month"))
        .groupBy("first", (F.col("month") - F.col("first")).alias("month_num"))
        .agg(F.count(F.lit(1)).alias("n_active"))
    )
    size = F.max(F.when(F.col("month_num") == 0, F.col("n_active"))).over(Window.partitionBy("first"))
    return active.select(
        F.format_string("%04d-%02d", F.floor(F.col("first") / 12).cast("int"), (F.col("first") % 12 + 1).cast("int"))
        .alias("cohort"),
        "month_num", "n_active",
        (F.col("n_active").cast("double") / size.cast("double")).alias("retention"),
    )


def cohort_heatmap(retention: DataFrame, periods: int = 13) -> DataFrame:
    """Wide form: one column per month number, missing = 0."""
    wide = (
        retention.where(F.col("month_num") < periods)
        .groupBy("cohort").pivot("month_num", list(range(periods))).agg(F.first("retention"))
        .na.fill(0.0)
    )
    return wide.select("cohort", *[F.col(str(i)).alias(f"month_{i}") for i in range(periods)])


def without_gaps(df: DataFrame, columns) -> list[Column]:
    """Null or NaN → 0, as the matrices expect."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return [
        F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")) if c in doubles else F.col(c), F.lit(0)).alias(c)
        for c in columns
    ]


MATRIX_EXCLUDED = ("target_revenue", "total_revenue", "cohort_month", "cohort_index")
PROBABILITY_COLUMNS = ("predicted_purchases", "p_alive", "predicted_clv")


def value_matrix(features: DataFrame, probabilities: DataFrame, actuals: DataFrame | None = None) -> DataFrame:
    """Training matrix: every feature customer, probability columns prefixed, target 0 when absent.

    Without ``actuals`` the matrix has no target and serves for scoring.
    """
    renamed = probabilities.select("customer_id", *[F.col(c).alias(f"prob_{c}") for c in PROBABILITY_COLUMNS])
    joined, target = features.join(renamed, "customer_id", "left"), []
    if actuals is not None:
        joined, target = joined.join(
            actuals.select("customer_id", F.col("holdout_revenue").alias("target_revenue")), "customer_id", "left"
        ), ["target_revenue"]
    inputs = [c for c in joined.columns if c not in MATRIX_EXCLUDED and c != "customer_id"]
    return joined.select("customer_id", *without_gaps(joined, [*inputs, *target]))


def numeric_matrix(features: DataFrame, probabilities: DataFrame, target: str | None = None) -> DataFrame:
    """Inner-joined matrix with numeric columns only; the target column, if any, comes last."""
    joined = features.join(probabilities.select("customer_id", *PROBABILITY_COLUMNS), "customer_id")
    numeric = [
        f.name for f in joined.schema.fields
        if f.dataType.typeName() in ("double", "float", "integer", "long", "decimal") and f.name not in ("customer_id", target)
    ]
    return joined.select("customer_id", *numeric, *([target] if target else []))


def interval_matrix(features: DataFrame, predictions: DataFrame, actuals: DataFrame | None = None) -> DataFrame:
    """Matrix for the interval model: model outputs as inputs; with ``actuals``, holdout customers only."""
    outputs = ("p_alive", "predicted_clv_bgnbd", "predicted_clv_lgbm")
    joined = features.join(predictions.select("customer_id", *outputs), "customer_id", "left")
    tail = []
    if actuals is not None:
        joined, tail = joined.join(actuals.select("customer_id", "holdout_revenue"), "customer_id"), ["holdout_revenue"]
    inputs = [c for c in joined.columns if c not in ("customer_id", "cohort_month", "cohort_index", "holdout_revenue")]
    return joined.select("customer_id", *without_gaps(joined, inputs), *tail)
