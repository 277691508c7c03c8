"""Declared schemas and the checks that replace in-process argument guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_INVOICES = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DecimalType(18, 4)),
    T.StructField("Customer ID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

INVOICE_LINE_COLUMNS = (
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country",
)
RFM_COLUMNS = ("customer_id", "frequency", "recency", "T", "monetary_value")
BEHAVIOUR_COLUMNS = (
    "tenure_days", "active_months", "n_orders", "n_items", "n_products", "avg_order_value",
    "max_order_value", "std_interpurchase_days", "return_rate",
)
FEATURE_COLUMNS = RFM_COLUMNS + BEHAVIOUR_COLUMNS + ("cohort_month", "cohort_index", "total_revenue")


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail early, with the names, when columns are missing."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """Fail before a join on ``key`` would multiply rows."""
    repeated = duplicate_keys(df, key).limit(3).collect()
    if repeated:
        raise ValueError(f"{name}: {key} repeats, e.g. {', '.join(str(r[key]) for r in repeated)}")
    return df


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once; empty for a well-formed customer table."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
