"""Invoice lines: sources, cleaning, split and the exploration tables on transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, explore
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.registry import SETTINGS, query

SUM_UNITS = "CAST(CAST(sum(TotalPrice) AS BIGINT) AS DOUBLE) / 10000.0"


@query("source_invoice_lines", "SELECT * REPLACE (CAST(InvoiceDate AS DATE) AS InvoiceDate) FROM raw", ["raw"])
def source_invoice_lines(spark, sf):
    return inputs.raw(spark, sf).withColumn("InvoiceDate", F.to_date("InvoiceDate"))


@query("clean_valid_lines", "SELECT InvoiceNo, StockCode, Quantity, UnitPrice, CustomerID FROM valid", ["valid"])
def clean_valid_lines(spark, sf):
    return cleaning.valid_lines(inputs.raw(spark, sf), SETTINGS).select(
        "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID")


@query("clean_outlier_caps", "SELECT * FROM caps", ["caps"])
def clean_outlier_caps(spark, sf):
    return cleaning.outlier_caps(cleaning.valid_lines(inputs.raw(spark, sf), SETTINGS), SETTINGS.outlier_percentile)


@query("clean_outlier_caps_p995", """
 SELECT CAST(round(quantile_cont(Quantity, 0.995)) AS BIGINT) AS cap_quantity,
        CAST(round(quantile_cont(UnitPrice, 0.995)) AS BIGINT) AS cap_price FROM valid""", ["valid"])
def clean_outlier_caps_p995(spark, sf):
    return cleaning.outlier_caps(cleaning.valid_lines(inputs.raw(spark, sf), SETTINGS), 99.5)


@query("clean_transactions", """
 SELECT InvoiceNo, StockCode, Quantity, UnitPrice, CustomerID, Country, TotalPrice, year_month FROM tx""", ["tx"])
def clean_transactions(spark, sf):
    return inputs.tx(spark, sf).select(
        "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID", "Country", "TotalPrice", "year_month")


@query("clean_retention_report", f"""
 WITH steps AS (
  SELECT 0 AS step_no, 'raw' AS step, count(*) AS n_rows FROM raw
  UNION ALL SELECT 1, 'has_customer', count(*) FROM raw WHERE CustomerID IS NOT NULL
  UNION ALL SELECT 2, 'not_cancelled', count(*) FROM raw WHERE CustomerID IS NOT NULL AND NOT starts_with(InvoiceNo, 'C')
  UNION ALL SELECT 3, 'is_product', count(*) FROM raw WHERE CustomerID IS NOT NULL
    AND NOT starts_with(InvoiceNo, 'C') AND StockCode NOT IN ({inputs.CODES})
  UNION ALL SELECT 4, 'positive', count(*) FROM valid)
 SELECT step_no, step, n_rows, round(n_rows * 100.0 / (SELECT count(*) FROM raw), 1)::DOUBLE AS pct_of_raw FROM steps""",
       ["raw", "valid"])
def clean_retention_report(spark, sf):
    return cleaning.retention_report(inputs.raw(spark, sf), SETTINGS)


@query("clean_temporal_split", f"""
 SELECT side, count(*) AS n_lines, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day
 FROM (SELECT 'observation' AS side, CAST(InvoiceDate AS DATE) AS day FROM obs
       UNION ALL SELECT 'holdout', CAST(InvoiceDate AS DATE) FROM hold) GROUP BY side""", ["obs", "hold"])
def clean_temporal_split(spark, sf):
    observed, held = cleaning.temporal_split(inputs.tx(spark, sf), SETTINGS)
    sides = observed.select(F.lit("observation").alias("side"), F.to_date("InvoiceDate").alias("day")).unionByName(
        held.select(F.lit("holdout").alias("side"), F.to_date("InvoiceDate").alias("day")))
    return sides.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"))


@query("explore_null_profile", """
 WITH n AS (SELECT count(*) AS total, count(*) - count(InvoiceNo) AS InvoiceNo, count(*) - count(StockCode) AS StockCode,
   count(*) - count(Description) AS Description, count(*) - count(Quantity) AS Quantity,
   count(*) - count(InvoiceDate) AS InvoiceDate, count(*) - count(UnitPrice) AS UnitPrice,
   count(*) - count(CustomerID) AS CustomerID, count(*) - count(Country) AS Country FROM raw),
 long AS (UNPIVOT n ON InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
          INTO NAME "column" VALUE missing)
 SELECT "column", missing, round(missing * 100.0 / total, 1)::DOUBLE AS missing_pct FROM long WHERE missing > 0""", ["raw"])
def explore_null_profile(spark, sf):
    return explore.null_profile(inputs.raw(spark, sf))


@query("explore_describe_lines", """
 SELECT "column", count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
   min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
   quantile_cont(value, 0.75) AS p75, max(value) AS max
 FROM (SELECT 'Quantity' AS "column", Quantity::DOUBLE AS value FROM raw
       UNION ALL SELECT 'UnitPrice', UnitPrice / 10000.0 FROM raw) GROUP BY 1""", ["raw"])
def explore_describe_lines(spark, sf):
    lines = inputs.raw(spark, sf).select("Quantity", (F.col("UnitPrice") / 10000.0).alias("UnitPrice"))
    return explore.describe(lines, ["Quantity", "UnitPrice"], digits=4)


@query("explore_overview", """
 SELECT count(*) AS n_rows, count(DISTINCT CustomerID) AS n_customers, count(DISTINCT StockCode) AS n_products,
   CAST(CAST(min(InvoiceDate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(InvoiceDate) AS DATE) AS VARCHAR) AS last_day
 FROM tx""", ["tx"])
def explore_overview(spark, sf):
    return explore.overview(inputs.tx(spark, sf))


@query("explore_top_countries", f"""
 SELECT Country AS country, {SUM_UNITS} AS revenue FROM tx GROUP BY 1 ORDER BY revenue DESC, country LIMIT 10""", ["tx"])
def explore_top_countries(spark, sf):
    return explore.top_countries(inputs.tx(spark, sf), 10)


@query("explore_monthly_series", f"""
 SELECT year_month AS month, count(DISTINCT InvoiceNo) AS transactions, {SUM_UNITS} AS revenue,
   count(DISTINCT CustomerID) AS customers FROM tx GROUP BY 1""", ["tx"])
def explore_monthly_series(spark, sf):
    return explore.monthly_series(inputs.tx(spark, sf))


@query("explore_revenue_histogram", """
 WITH v AS (SELECT TotalPrice / 10000.0 AS x FROM tx), r AS (SELECT min(x) AS lo, quantile_cont(x, 0.95) AS hi FROM v)
 SELECT CAST(least(floor((x - lo) / ((hi - lo) / 200)), 199) AS INTEGER) AS bin, count(*) AS n
 FROM v, r WHERE x <= hi GROUP BY 1""", ["tx"])
def explore_revenue_histogram(spark, sf):
    amounts = inputs.tx(spark, sf).select((F.col("TotalPrice") / 10000.0).alias("x"))
    return explore.histogram(amounts, "x", bins=200, upper_quantile=0.95).select("bin", "n")


@query("explore_revenue_concentration", """
 WITH c AS (SELECT CustomerID AS customer_id, CAST(sum(TotalPrice) AS BIGINT) AS revenue FROM tx GROUP BY 1),
 r AS (SELECT row_number() OVER (ORDER BY revenue DESC, customer_id) AS rank, revenue FROM c),
 t AS (SELECT count(*) AS n, CAST(sum(revenue) AS DOUBLE) AS total FROM c)
 SELECT share, count(*) AS n_customers, round(CAST(sum(revenue) AS DOUBLE) / max(total), 9) AS revenue_share
 FROM r, t, (SELECT unnest([0.1, 0.2, 0.5, 1.0])::DOUBLE AS share) WHERE rank <= floor(n * share) GROUP BY share""", ["tx"])
def explore_revenue_concentration(spark, sf):
    return explore.revenue_concentration(inputs.tx(spark, sf), [0.1, 0.2, 0.5, 1.0])


@query("source_event_purchases_monthly", """
 SELECT strftime(ts, '%Y-%m') AS month, count(DISTINCT CAST(event_id AS VARCHAR)) AS transactions,
   CAST(sum(CAST(round(value * 100) AS BIGINT) * 100) AS DOUBLE) / 10000.0 AS revenue,
   count(DISTINCT user_id) AS customers
 FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def source_event_purchases_monthly(spark, sf):
    from ledgerlens.sources.retail import event_purchases
    return explore.monthly_series(event_purchases(spark, sf).withColumn(
        "year_month", F.date_format("InvoiceDate", "yyyy-MM")))


@query("source_store_round_trip", """
 SELECT year_month, count(*) AS n_lines, CAST(sum(TotalPrice) AS BIGINT) AS revenue FROM tx GROUP BY 1""", ["tx"])
def source_store_round_trip(spark, sf):
    """Clean lines written by month under the shared checkpoint folder and read back."""
    from uuid import uuid4

    from ledgerlens.operators.stability import checkpoint_folder
    from ledgerlens.sources.store import TableStore
    store = TableStore(spark, f"{checkpoint_folder(spark)}/store-{uuid4().hex}")
    table = store.write("transactions_clean", inputs.tx(spark, sf), partition_by="year_month")
    return table.groupBy(F.col("year_month").cast("string").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("TotalPrice").alias("revenue"))


@query("source_invoice_csv", """
 SELECT InvoiceNo, StockCode, Description, Quantity, CAST(InvoiceDate AS DATE) AS day, UnitPrice, CustomerID, Country FROM raw""", ["raw"])
def source_invoice_csv(spark, sf):
    """The lines written as a file with the published header, customer ids as decimals, and read back."""
    from uuid import uuid4

    from ledgerlens.config import MINOR_PER_UNIT
    from ledgerlens.operators.stability import checkpoint_folder
    from ledgerlens.sources.retail import read_invoices
    folder = f"{checkpoint_folder(spark)}/invoices-{uuid4().hex}"
    inputs.raw(spark, sf).select(
        F.col("InvoiceNo").alias("Invoice"), "StockCode", "Description", "Quantity",
        F.date_format("InvoiceDate", "dd/MM/yyyy HH:mm").alias("InvoiceDate"),
        (F.col("UnitPrice") / F.lit(MINOR_PER_UNIT)).cast("decimal(18,4)").alias("Price"),
        F.col("CustomerID").cast("decimal(20,1)").alias("Customer ID"), "Country",
    ).write.option("header", True).csv(folder)
    lines = read_invoices(spark, folder, timestamp_format="dd/MM/yyyy HH:mm")
    return lines.withColumn("day", F.to_date("InvoiceDate")).drop("InvoiceDate")


@query("source_invoice_workbook", """
 SELECT InvoiceNo, StockCode, Description, Quantity, CAST(InvoiceDate AS DATE) AS day, UnitPrice, CustomerID, Country FROM raw""", ["raw"])
def source_invoice_workbook(spark, sf):
    """The lines as workbooks of two sheets each, and read back."""
    import pyarrow as pa

    from ledgerlens.config import MINOR_PER_UNIT
    from ledgerlens.operators.stability import landed, ship, spread
    from ledgerlens.schemas import RAW_INVOICES
    from ledgerlens.sources.retail import lines_of_workbooks
    from ledgerlens.sources.workbook import make_workbook
    ship(spark)
    names = [field.name for field in RAW_INVOICES]
    published = inputs.raw(spark, sf).select(
        F.col("InvoiceNo").alias("Invoice"), "StockCode", "Description", "Quantity", F.col("InvoiceDate").cast("timestamp_ntz").alias("InvoiceDate"),
        (F.col("UnitPrice") / F.lit(MINOR_PER_UNIT)).cast("decimal(18,4)").alias("Price"), F.col("CustomerID").alias("Customer ID"), "Country",
    ).select(*names)

    def pack(batches):
        for batch in batches:
            rows = [list(row.values()) for row in batch.to_pylist()]
            books = [make_workbook(names, rows[at:at + 20_000], 12_000) for at in range(0, len(rows), 20_000)]
            if books:
                yield pa.RecordBatch.from_arrays([pa.array(books, pa.binary())], ["content"])

    lines = lines_of_workbooks(landed(spread(published).mapInArrow(pack, "content binary")))
    return lines.withColumn("day", F.to_date("InvoiceDate")).drop("InvoiceDate")
