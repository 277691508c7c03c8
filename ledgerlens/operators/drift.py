"""Population stability index over feature pairs, and the alerts drawn from it.

All features of all periods go through one job: distinct values are counted per (period, feature),
their decile edges are found by ordered slots, and every counted value is binned twice — against its
own period's edges (as baseline) and against the previous period's (as current).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.config import DRIFT_FEATURES
from ledgerlens.operators.features import quarter_name, quarterly_rfm
from ledgerlens.operators.quantiles import melt, place_counts, quantiles_placed, value_counts
from ledgerlens.operators.stability import materialise

EPS = 1e-8  # fixed value: smoothing of empty bins
NAN = float("nan")


def _psi_value(edges: Column, bins: Column) -> Column:
    """Index from (bin → counts) pairs; empty bins count as zero on both sides."""
    k = F.size(edges) - 1

    def side(name: str) -> Column:
        return F.transform(
            F.sequence(F.lit(0), k - 1),
            lambda i: F.coalesce(F.element_at(bins, i)[name], F.lit(0)).cast("double"),
        )

    def shares(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c) + F.lit(EPS) * k
        return F.transform(counts, lambda c: (c + F.lit(EPS)) / total)

    terms = F.zip_with(
        shares(side("expected")), shares(side("actual")), lambda e, a: (a - e) * F.log(a / e)
    )
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def psi_between(long: DataFrame, pairs: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(period, baseline, feature, psi) from long rows (period, feature, value) and period pairs.

    ``pairs`` has one row per period with its baseline.  A side without values gives NaN, a baseline
    with a single distinct edge gives 0.
    """
    placement = place_counts(value_counts(long, "value", by=["period", "feature"]), by=["period", "feature"])
    found = quantiles_placed(placement, [i / bins for i in range(bins + 1)])
    edges = materialise(found.select("period", "feature", F.array_distinct("q").alias("edges")))
    wanted = pairs.select("period", "baseline", F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    named = edges.select(F.col("period").alias("baseline"), "feature", "edges")
    scaffold = wanted.join(named, ["baseline", "feature"], "left")
    columns = ["feature", "edges", F.col("period").alias("pair")]
    roles = (
        scaffold.select(F.col("baseline").alias("period"), *columns, F.lit(True).alias("is_baseline"))
        .unionByName(scaffold.select("period", *columns, F.lit(False).alias("is_baseline")))
        .where(F.col("edges").isNotNull())
    )
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    binned = (
        placement.rows.join(roles, ["period", "feature"])
        .groupBy("pair", "feature", F.size(F.filter(inner, lambda e: e <= F.col("value"))).alias("bin"))
        .agg(F.sum(F.when(F.col("is_baseline"), F.col("n"))).alias("expected"),
             F.sum(F.when(~F.col("is_baseline"), F.col("n"))).alias("actual"))
        .groupBy(F.col("pair").alias("period"), "feature")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("expected", "actual")))).alias("bins"),
             F.sum("expected").alias("n_expected"), F.sum("actual").alias("n_actual"))
    )
    psi = (
        F.when(F.col("n_expected").isNull() | F.col("n_actual").isNull(), F.lit(NAN))
        .when(F.size("edges") < 2, F.lit(0.0))
        .otherwise(_psi_value(F.col("edges"), F.col("bins")))
    )
    return scaffold.join(binned, ["period", "feature"], "left").select("period", "baseline", "feature", psi.alias("psi"))


def feature_psi(baseline: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, psi) between two frames; features absent from either frame are left out."""
    shared = [f for f in features if f in baseline.columns and f in current.columns]
    sides = [melt(df, shared, name="feature").withColumn("period", F.lit(label))
             for label, df in (("baseline", baseline), ("current", current))]
    pairs = baseline.sparkSession.createDataFrame([("current", "baseline")], "period string, baseline string")
    return psi_between(sides[0].unionByName(sides[1]), pairs, shared, bins).select("feature", "psi")


def consecutive(periods: DataFrame) -> DataFrame:
    """(period, baseline): each period with the one before it; the table is as long as the calendar."""
    before = F.lag("period").over(Window.orderBy("period"))
    return periods.select("period").distinct().withColumn("baseline", before).where(F.col("baseline").isNotNull())


def _as_quarters(psi: DataFrame) -> DataFrame:
    return psi.select(F.col("period").alias("quarter"), F.col("baseline").alias("baseline_quarter"), "feature", "psi")


def quarterly_psi(df: DataFrame, date_col: str, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(quarter, baseline_quarter, feature, psi) of row-level features, consecutive present quarters."""
    quartered = df.withColumn("period", quarter_name(date_col))
    shared = [f for f in features if f in df.columns]
    long = melt(quartered, shared, keep=["period"], name="feature")
    return _as_quarters(psi_between(long, consecutive(quartered), shared, bins))


def quarterly_rfm_psi(tx: DataFrame, min_rows: int, features: Sequence[str] = DRIFT_FEATURES, bins: int = 10) -> DataFrame:
    """The same over per-quarter RFM tables."""
    rfm = materialise(quarterly_rfm(tx, min_rows).withColumnRenamed("quarter", "period"))
    long = melt(rfm, features, keep=["period"], name="feature")
    return _as_quarters(psi_between(long, consecutive(rfm), features, bins))


def status(psi: Column, low: float, high: float, strict: bool = False,
           labels: tuple[str, str, str] = ("stable", "moderate", "significant"), unknown: str = "unknown") -> Column:
    """Class of an index; ``strict`` keeps a value equal to a threshold in the lower class."""
    def reaches(limit: float) -> Column:
        return psi > limit if strict else psi >= limit

    return (
        F.when(psi.isNull() | F.isnan(psi), unknown).when(reaches(high), labels[2])
        .when(reaches(low), labels[1]).otherwise(labels[0])
    )


def detect_drift(psi: DataFrame, low: float = 0.10, high: float = 0.20) -> DataFrame:
    """Adds status and alert, rounds the index to 4 digits."""
    state = status(F.col("psi"), low, high)
    return psi.withColumns({
        "status": state, "alert": state.isin("moderate", "significant"),
        "psi": F.when(F.isnan("psi"), F.lit(NAN)).otherwise(F.round("psi", 4)),
    })


def latest_quarter(psi: DataFrame) -> DataFrame:
    return psi.where(F.col("quarter") == psi.agg(F.max("quarter")).scalar())


def alerts(psi: DataFrame, low: float = 0.10, high: float = 0.20) -> DataFrame:
    """(feature, message) for drifted features."""
    state = status(F.col("psi"), low, high)
    # Fixed message formats.
    significant = F.format_string(
        f"🔴 SIGNIFICANT DRIFT on '%s': PSI = %.4f (threshold {high}). Retraining recommended.", "feature", "psi")
    moderate = F.format_string(f"🟡 MODERATE DRIFT on '%s': PSI = %.4f (threshold {low}). Investigate.", "feature", "psi")
    return psi.where(state.isin("moderate", "significant")).select(
        "feature", F.when(state == "significant", significant).otherwise(moderate).alias("message"))


def heatmap(psi: DataFrame, quarters: Sequence[str] | None = None) -> DataFrame:
    """Features × quarters, mean index; without ``quarters`` the pivot lists them (calendar-bounded)."""
    return psi.groupBy("feature").pivot("quarter", list(quarters) if quarters else None).agg(F.avg("psi"))


def density_histograms(baseline: DataFrame, current: DataFrame, feature: str, bins: int = 50) -> DataFrame:
    """(side, bin, n, density) of both sides over one shared equal-width grid."""
    x = F.col(feature).cast("double")
    both = baseline.select(F.lit("baseline").alias("side"), x.alias("x")).unionByName(
        current.select(F.lit("current").alias("side"), x.alias("x"))).where(F.col("x").isNotNull() & ~F.isnan("x"))
    span = both.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    width = (span["high"] - span["low"]) / F.lit(bins)
    number = F.coalesce(F.least(F.floor(F.try_divide(F.col("x") - span["low"], width)), F.lit(bins - 1)), F.lit(0))
    counted = both.groupBy("side", number.cast("int").alias("bin"), width.alias("width")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("side"))  # at most ``bins`` rows per side
    return counted.select("side", "bin", "n", F.try_divide(F.col("n").cast("double"), total * F.col("width")).alias("density"))


def retraining_due(psi: DataFrame, threshold: float = 0.25, run: int = 2) -> DataFrame:
    """(feature, quarter) where the index has exceeded the threshold in ``run`` consecutive quarters."""
    by_quarter = Window.partitionBy("feature").orderBy("quarter")  # one row per quarter
    high = (F.col("psi") > threshold) & ~F.isnan("psi")
    streak = F.min(high.cast("int")).over(by_quarter.rowsBetween(-(run - 1), 0))
    length = F.count(F.lit(1)).over(by_quarter.rowsBetween(-(run - 1), 0))
    return psi.select("feature", "quarter", "psi", streak.alias("streak"), length.alias("length")).where(
        (F.col("streak") == 1) & (F.col("length") == run)).select("feature", "quarter", "psi")


def retraining_decision(psi: DataFrame, coverage: DataFrame, threshold: float = 0.25, run: int = 2,
                        min_coverage: float = 0.80) -> DataFrame:
    """One row (drifted_features, coverage, retrain): a drift streak or low interval coverage asks for a refit."""
    drifted = retraining_due(psi, threshold, run).agg(F.count_distinct("feature").alias("drifted_features"))
    covered = coverage.select("empirical_coverage").scalar()
    return drifted.select(
        "drifted_features", covered.alias("coverage"),
        ((F.col("drifted_features") > 0) | F.coalesce(covered < F.lit(min_coverage), F.lit(False))).alias("retrain"))
