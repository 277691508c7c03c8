"""Time the headline queries; prints one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from ledgerlens.plans.catalog import QUERIES

HEADLINE = (
    "clean_transactions", "customers_rfm", "customers_features", "customers_quarterly_rfm", "cohort_retention",
    "explore_monthly_series", "explore_correlations", "metrics_decile_lift", "metrics_qini_coefficient",
    "value_predict_all", "drift_quarterly_rfm", "uplift_ranking", "uplift_qini_curve", "budget_roi_curve",
    "budget_segment_breakdown", "interval_calibration", "attribution_waterfall", "report_kpis",
    "value_fit_purchases", "boost_predictions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("ledgerlens-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerlens-"))
        .config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["explore_overview"](spark, sf_dir).collect()  # load classes before the clock starts
    wanted = sys.argv[1:] or HEADLINE
    times = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
