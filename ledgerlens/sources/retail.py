"""Invoice-line sources: files with the published header, and adapters for other star schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.config import COLUMN_RENAMES, MINOR_PER_UNIT
from ledgerlens.schemas import INVOICE_LINE_COLUMNS, RAW_INVOICES, require_columns
from ledgerlens.sources import workbook


def standardise(raw: DataFrame) -> DataFrame:
    """Published header → internal names; price becomes BIGINT minor units."""
    named = require_columns(raw.withColumnsRenamed(COLUMN_RENAMES), INVOICE_LINE_COLUMNS)
    price = F.round(F.col("UnitPrice") * F.lit(MINOR_PER_UNIT)).cast("bigint")
    return named.withColumn("UnitPrice", price).select(*INVOICE_LINE_COLUMNS)


def _typed(text: DataFrame, timestamp_format: str | None) -> dict[str, Column]:
    """Casts of the raw text columns; whole numbers may be written with decimals (``13085.0``)."""
    def whole(name: str) -> Column:
        number = F.col(name).try_cast("decimal(30,6)")
        return F.when(number == F.floor(number), number.cast("bigint"))

    when = F.col("InvoiceDate")
    casts = {"Quantity": whole("Quantity"), "Customer ID": whole("Customer ID"), "Price": F.col("Price").try_cast("decimal(18,4)")}
    casts["InvoiceDate"] = (
        when.try_cast("timestamp_ntz") if timestamp_format is None
        else F.try_to_timestamp(when, F.lit(timestamp_format)).cast("timestamp_ntz")
    )
    return {name: casts.get(name, F.col(name)) for name in text.columns}


def _bad(name: str, typed: Column) -> Column:
    return (F.trim(F.col(name)) != "") & typed.isNull()


def _text(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "workbook":
        return workbook.read_text(spark, path)
    schema = ", ".join(f"`{field.name}` string" for field in RAW_INVOICES)
    return spark.read.schema(schema).option("header", True).csv(path)


def invoice_rejects(spark: SparkSession, path: str, timestamp_format: str | None = None, fmt: str = "csv") -> DataFrame:
    """Lines of CSV files or workbooks with text that does not fit its column, as text, with the columns at fault."""
    text = _text(spark, path, fmt)
    faults = F.array_compact(F.array(*[
        F.when(_bad(name, typed), F.lit(name)) for name, typed in _typed(text, timestamp_format).items()]))
    return text.withColumn("rejected", faults).where(F.size("rejected") > 0)


def read_invoices(spark: SparkSession, path: str, fmt: str = "csv", timestamp_format: str | None = None,
                  rejects: str = "fail") -> DataFrame:
    """Invoice lines from CSV, workbooks (``workbook``: .xlsx files) or Parquet with a declared schema (no inference pass).

    Text that does not fit its column ends the job with the column and the text.  With
    ``rejects="drop"`` such lines are left out; ``invoice_rejects`` returns them.
    """
    if fmt == "parquet":
        return standardise(spark.read.schema(RAW_INVOICES).parquet(path))
    if fmt not in ("csv", "workbook") or rejects not in ("fail", "drop"):
        raise ValueError(f"unknown format or reject mode: {fmt}, {rejects}")
    return _lines(_text(spark, path, fmt), timestamp_format, rejects)


def lines_of_workbooks(contents: DataFrame, rejects: str = "fail") -> DataFrame:
    """Invoice lines of workbooks held in a ``content`` column."""
    return _lines(workbook.workbook_text(contents), None, rejects)


def _lines(text: DataFrame, timestamp_format: str | None, rejects: str) -> DataFrame:
    typed = _typed(text, timestamp_format)
    if rejects == "drop":
        for name, column in typed.items():
            text = text.where(~F.coalesce(_bad(name, column), F.lit(False)))
        return standardise(text.select(*[column.alias(name) for name, column in typed.items()]))
    return standardise(text.select(*[
        F.when(_bad(name, column), F.raise_error(F.concat(F.lit(f"{name} cannot be read: "), F.col(name)))).otherwise(column).alias(name)
        for name, column in typed.items()
    ]))


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as invoice lines, with the dirt every cleaning rule needs to meet.

    Join sides carry no broadcast hints: Spark compares their size with its own threshold, and
    adaptive execution splits a skewed order or customer in the sort-merge case.
    """
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Buyers join the orders first: the order table is a fraction of the lines, which then move once.
    buyers = (
        table("customer").select("c_custkey", "c_nationkey")
        .join(table("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    orders = (
        table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    quantity = F.col("l_quantity").cast("bigint")
    return joined.select(
        F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""), F.col("o_orderkey").cast("string"))
        .alias("InvoiceNo"),
        F.when(F.col("l_partkey") % 50 == 0, "POST")
        .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("StockCode"),
        F.when(F.col("l_partkey") % 97 != 0, F.concat(F.lit("Item "), F.col("l_partkey").cast("string")))
        .alias("Description"),
        (quantity * F.when(F.col("o_orderkey") % 41 == 0, -1).otherwise(1)).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.expr(
            "(cast(round(l_extendedprice * 100) as bigint) * (100 - cast(round(l_discount * 100) as bigint)))"
            " div cast(l_quantity as bigint)"
        ).alias("UnitPrice"),
        F.when(F.col("o_orderkey") % 37 != 0, F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def event_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as transactions: a second source with the columns the customer features need."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type") == "purchase")
    amount = F.round(F.col("value") * 100).cast("bigint") * F.lit(MINOR_PER_UNIT // 100)
    return events.select(
        F.col("event_id").cast("string").alias("InvoiceNo"),
        F.col("event_type").alias("StockCode"),
        F.lit(1).cast("bigint").alias("Quantity"),
        F.col("ts").alias("InvoiceDate"),
        amount.alias("UnitPrice"),
        F.col("user_id").alias("CustomerID"),
        amount.alias("TotalPrice"),
    )
