"""Uplift queries: assignment, ranking and curves on deterministic scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import explore, uplift
from ledgerlens.plans.catalog import inputs
from ledgerlens.plans.catalog.evaluation import TREATED
from ledgerlens.plans.catalog.registry import fragment, query

fragment("armed", f"SELECT customer_id, tied_score, actual, {TREATED} AS treatment FROM scores", ["scores"])


def armed(spark, sf):
    return uplift.assign_arms(inputs.score_frame(spark, sf).select("customer_id", "tied_score", "actual"))


@query("uplift_assignment", "SELECT customer_id, treatment FROM armed", ["armed"])
def uplift_assignment(spark, sf):
    return armed(spark, sf).select("customer_id", "treatment")


@query("uplift_arm_summary", """
 SELECT treatment, count(*) AS n, round(avg(actual), 6) AS mean_outcome FROM armed GROUP BY 1""", ["armed"])
def uplift_arm_summary(spark, sf):
    return uplift.arm_summary(armed(spark, sf), "actual").withColumn("mean_outcome", F.round("mean_outcome", 6))


fragment("ranked_uplift", """
 WITH r AS (SELECT customer_id, tied_score AS uplift_score,
   row_number() OVER (ORDER BY tied_score DESC, customer_id) AS uplift_rank, count(*) OVER () AS n FROM scores)
 SELECT customer_id, uplift_score, uplift_rank,
   CASE WHEN uplift_rank <= floor(n * 0.1::DOUBLE) THEN 'Persuadable' WHEN uplift_rank <= floor(n * 0.3::DOUBLE) THEN 'Favourable'
        ELSE 'Neutral/Negative' END AS segment FROM r""", ["scores"])


def ranked(spark, sf):
    return uplift.rank_by_uplift(inputs.score_frame(spark, sf), "tied_score")


@query("uplift_ranking", "SELECT * FROM ranked_uplift", ["ranked_uplift"])
def uplift_ranking(spark, sf):
    return ranked(spark, sf)


@query("uplift_top_persuadable", """
 SELECT * FROM ranked_uplift WHERE segment = 'Persuadable' ORDER BY uplift_score DESC, customer_id LIMIT 10""", ["ranked_uplift"])
def uplift_top_persuadable(spark, sf):
    return uplift.top_persuadable(ranked(spark, sf), 10)


@query("uplift_score_histogram", """
 WITH r AS (SELECT min(uplift_score)::DOUBLE AS lo, max(uplift_score)::DOUBLE AS hi FROM ranked_uplift)
 SELECT segment, CAST(least(floor((uplift_score - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
 FROM ranked_uplift, r GROUP BY 1, 2""", ["ranked_uplift"])
def uplift_score_histogram(spark, sf):
    return explore.histogram(ranked(spark, sf), "uplift_score", bins=50, by=["segment"]).select("segment", "bin", "n")


@query("uplift_score_histogram_trimmed", """
 WITH r AS (SELECT quantile_cont(uplift_score, 0.01) AS lo, quantile_cont(uplift_score, 0.99) AS hi FROM scores)
 SELECT CAST(least(floor((uplift_score - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
 FROM scores, r WHERE uplift_score BETWEEN lo AND hi GROUP BY 1""", ["scores"])
def uplift_score_histogram_trimmed(spark, sf):
    frame = inputs.score_frame(spark, sf).select("customer_id", "uplift_score")
    return explore.histogram(frame, "uplift_score", 50, lower_quantile=0.01, upper_quantile=0.99).select("bin", "n")


@query("uplift_qini_curve", """
 WITH w AS (SELECT row_number() OVER o AS rank, sum(actual * treatment) OVER o AS st, sum(actual * (1 - treatment)) OVER o AS sc,
    sum(treatment) OVER o AS nt FROM armed
   WINDOW o AS (ORDER BY tied_score DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 t AS (SELECT max(rank) AS n FROM w),
 g AS (SELECT (st::DOUBLE / greatest(nt, 1) - sc::DOUBLE / greatest(n - nt, 1)) * nt AS total FROM w, t WHERE rank = n)
 SELECT 0::BIGINT AS rank, 0.0::DOUBLE AS fraction, 0.0::DOUBLE AS qini_model, 0.0::DOUBLE AS qini_random
 UNION ALL
 SELECT rank, round(rank::DOUBLE / n, 9), round((st::DOUBLE / greatest(nt, 1) - sc::DOUBLE / greatest(rank - nt, 1)) * nt * (rank::DOUBLE / n), 4),
   round(total * (rank::DOUBLE / n), 4)
 FROM w, t, g WHERE rank % greatest(n // 100, 1) = 0 OR rank = n""", ["armed"])
def uplift_qini_curve(spark, sf):
    table = uplift.qini_curve(armed(spark, sf), "actual", "tied_score")
    return table.select("rank", F.round("fraction", 9).alias("fraction"), F.round("qini_model", 4).alias("qini_model"),
                        F.round("qini_random", 4).alias("qini_random"))
