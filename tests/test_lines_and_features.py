"""Cleaning rules and customer features on a hand-checked fixture."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import Settings
from ledgerlens.operators import cleaning, explore, features
from ledgerlens.sources.retail import invoice_rejects, read_invoices
from ledgerlens.sources.store import TableStore

SCHEMA = ("InvoiceNo string, StockCode string, Description string, Quantity long, InvoiceDate timestamp_ntz, "
          "UnitPrice long, CustomerID long, Country string")
D = datetime
LINES = [
    ("1", "A", "x", 2, D(2010, 1, 5, 9), 10_000, 1, "UK"),
    ("1", "BB", None, 1, D(2010, 1, 5, 9), 20_000, 1, "UK"),
    ("2", "A", "x", 3, D(2010, 1, 5, 17), 10_000, 1, "UK"),
    ("3", "C", "x", 1, D(2010, 3, 1), 50_000, 1, "UK"),
    ("4", "A", "x", 1, D(2010, 6, 9), 30_000, 1, "UK"),
    ("5", "A", "x", 1, D(2010, 2, 1), 70_000, 2, "FR"),
    ("C6", "A", "x", -1, D(2010, 2, 2), 70_000, 2, "FR"),
    ("7", "POST", "x", 1, D(2010, 2, 3), 10_000, 2, "FR"),
    ("8", "A", "x", 0, D(2010, 2, 3), 10_000, 2, "FR"),
    ("9", "A", "x", 5, D(2010, 2, 3), 0, 2, "FR"),
    ("10", "A", "x", 1, D(2010, 2, 3), 10_000, None, "FR"),
    ("11", "postage", "x", 1, D(2010, 12, 1, 23, 59), 10_000, 3, "FR"),
    ("12", "A", "x", 1, D(2010, 12, 2), 10_000, 3, "FR"),
    ("13", "A", "x", 1, D(2012, 1, 1), 10_000, 3, "FR"),
]
PLAIN = Settings(convert_to_inr=False, outlier_percentile=100.0)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(LINES, SCHEMA)


def test_rules_and_report(raw):
    kept = {r["InvoiceNo"] for r in cleaning.valid_lines(raw, PLAIN).collect()}
    assert kept == {"1", "2", "3", "4", "5", "11", "12", "13"}
    report = {r["step"]: r["n_rows"] for r in cleaning.retention_report(raw, PLAIN).collect()}
    assert report == {"raw": 14, "has_customer": 13, "not_cancelled": 12, "is_product": 11, "positive": 9}


def test_split_has_no_overlap_and_keeps_the_last_evening(raw):
    observed, held = cleaning.temporal_split(cleaning.clean(raw, PLAIN), PLAIN)
    assert {r["InvoiceNo"] for r in observed.collect()} == {"1", "2", "3", "4", "5", "11"}
    assert {r["InvoiceNo"] for r in held.collect()} == {"12"}


def test_caps_and_currency(spark):
    rows = [(str(i), "A", None, i, D(2010, 1, 1), 100, 1, "UK") for i in range(1, 1001)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = cleaning.clean(df, Settings(outlier_percentile=99.0)).agg(
        F.max("Quantity").alias("q"), F.max("UnitPrice").alias("p"), F.max("TotalPrice").alias("t"), F.count("*").alias("n")).first()
    assert (out["q"], out["p"], out["t"], out["n"]) == (990, 10_500, 990 * 10_500, 1000)


def test_missing_columns_are_named(raw):
    with pytest.raises(ValueError, match="Quantity"):
        cleaning.valid_lines(raw.drop("Quantity"), PLAIN)


def test_rfm(raw):
    observed, _ = cleaning.temporal_split(cleaning.clean(raw, PLAIN), PLAIN)
    got = {r["customer_id"]: r for r in features.rfm_summary(observed, date(2010, 12, 1)).collect()}
    one = got[1]
    assert (one["frequency"], one["recency"], one["T"]) == (2, 155, 330)
    assert one["monetary_value"] == pytest.approx((5.0 + 3.0) / 2)
    assert (got[2]["frequency"], got[2]["recency"], got[2]["monetary_value"]) == (0, 0, 0.0)


def test_features(raw):
    observed, _ = cleaning.temporal_split(cleaning.clean(raw, PLAIN), PLAIN)
    raw_observed = cleaning.between_dates(raw, PLAIN.observation_start, PLAIN.observation_end)
    table = features.customer_features(observed, raw_observed, date(2010, 12, 1))
    assert len(table.columns) == 17
    got = {r["customer_id"]: r for r in table.collect()}
    one, two = got[1], got[2]
    assert (one["active_months"], one["n_orders"], one["n_items"], one["n_products"]) == (3, 4, 8, 3)
    assert one["avg_order_value"] == pytest.approx(15.0 / 4) and one["max_order_value"] == 5.0
    assert one["std_interpurchase_days"] == pytest.approx(((55 - 77.5) ** 2 + (100 - 77.5) ** 2) ** 0.5)
    assert (one["cohort_month"], one["cohort_index"]) == ("2010-01", 1)
    assert (two["cohort_month"], two["cohort_index"]) == ("2010-02", 2)
    assert got[3]["cohort_index"] == 3
    assert two["return_rate"] == pytest.approx(1 / 5) and one["return_rate"] == 0.0
    assert one["total_revenue"] == 15.0


def test_retention(raw):
    observed, _ = cleaning.temporal_split(cleaning.clean(raw, PLAIN), PLAIN)
    got = {(r["cohort"], r["month_num"]): r["retention"] for r in features.cohort_retention(observed).collect()}
    assert got == {("2010-01", 0): 1.0, ("2010-01", 2): 1.0, ("2010-01", 5): 1.0, ("2010-02", 0): 1.0, ("2010-12", 0): 1.0}


def test_quarters_below_the_row_limit_are_left_out(raw):
    tx = cleaning.clean(raw, PLAIN)
    assert {r["quarter"] for r in features.quarterly_rfm(tx, 3).collect()} == {"2010Q1"}
    row = features.quarterly_rfm(tx, 3).where("customer_id = 1").first()
    assert (row["frequency"], row["recency"], row["T"]) == (1, 55, 85)


def test_null_profile(raw):
    got = {r["column"]: (r["missing"], r["missing_pct"]) for r in explore.null_profile(raw).collect()}
    assert got == {"Description": (1, 7.1), "CustomerID": (1, 7.1)}


def test_csv_source_and_store(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                    "489434,85048,LAMP,12,2009-12-01 07:45:00,6.95,13085,United Kingdom\n"
                    "489435,22350,\"CAT, BOWL\",1,2009-12-01 07:46:00,2.55,,France\n")
    lines = read_invoices(spark, str(path))
    rows = lines.orderBy("InvoiceNo").collect()
    assert rows[0]["UnitPrice"] == 69_500 and rows[0]["CustomerID"] == 13085
    assert rows[1]["CustomerID"] is None and rows[1]["Description"] == "CAT, BOWL"
    store = TableStore(spark, str(tmp_path / "store"))
    store.write("lines", lines.withColumn("year_month", F.date_format("InvoiceDate", "yyyy-MM")), partition_by="year_month")
    assert store.read("lines").count() == 2
    with pytest.raises(ValueError):
        read_invoices(spark, str(path), "xlsx")


def test_csv_ids_dates_and_rejects(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                    "1,A,,12,01/12/2009 07:45,6.95,13085.0,France\n2,B,,1,01/12/2009 07:46,2.55,13085.5,France\n")
    day_first = "dd/MM/yyyy HH:mm"
    with pytest.raises(Exception, match="Customer ID cannot be read: 13085.5"):
        read_invoices(spark, str(path), timestamp_format=day_first).collect()
    kept = read_invoices(spark, str(path), timestamp_format=day_first, rejects="drop").collect()
    assert [(r["CustomerID"], r["InvoiceDate"].month) for r in kept] == [(13085, 12)]
    assert [(r["Invoice"], r["rejected"]) for r in invoice_rejects(spark, str(path), day_first).collect()] == [("2", ["Customer ID"])]


def test_concentration_and_histogram(spark):
    tx = spark.range(1, 101).select(F.col("id").alias("CustomerID"), F.col("id").alias("TotalPrice"))
    got = {r["share"]: (r["n_customers"], r["revenue_share"]) for r in explore.revenue_concentration(tx, [0.2, 1.0]).collect()}
    assert got == {0.2: (20, round(sum(range(81, 101)) / 5050, 9)), 1.0: (100, 1.0)}
    bins = explore.histogram(spark.range(101), "id", 10).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [10] * 9 + [11]
    assert explore.histogram(spark.range(5).select(F.lit(3).alias("id")), "id", 10).first()["n"] == 5
