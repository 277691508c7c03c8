import math
from decimal import Decimal, getcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.special import digamma, ln_gamma
from ledgerlens.functions.splits import conformal_part, fold_id, treatment_flag
from ledgerlens.config import Settings
from ledgerlens.operators import bgnbd, gamma_gamma


def test_ln_gamma_and_digamma(spark):
    points = [0.05, 0.3, 1.0, 1.7, 2.5, 9.0, 44.4, 100.0, 4000.0]
    rows = spark.createDataFrame([(p,) for p in points], "z double").select(
        "z", ln_gamma(F.col("z")).alias("l"), digamma(F.col("z")).alias("d")).collect()
    for row in rows:
        assert row["l"] == pytest.approx(math.lgamma(row["z"]), abs=2e-9, rel=1e-10)
        step = 1e-4 * max(row["z"], 1.0) if row["z"] > 0.5 else 1e-6
        slope = (math.lgamma(row["z"] + step) - math.lgamma(row["z"] - step)) / (2 * step)
        assert row["d"] == pytest.approx(slope, rel=1e-4, abs=1e-5)


def bernoulli(n):
    out = [Fraction(1)]
    for m in range(1, n + 1):
        out.append(-sum(Fraction(math.comb(m + 1, k)) * out[k] for k in range(m)) / (m + 1))
    return out


BERNOULLI = bernoulli(60)
PI = Decimal("3.14159265358979323846264338327950288419716939937510582097494459")


def exact_gamma(z):
    """Γ to some 50 digits."""
    shift = Decimal(1)
    while z < 60:
        shift, z = shift * z, z + 1
    log = (z - Decimal("0.5")) * z.ln() - z + (2 * PI).ln() / 2
    for k in range(1, 30):
        log += Decimal(BERNOULLI[2 * k].numerator) / Decimal(BERNOULLI[2 * k].denominator) / (2 * k * (2 * k - 1)) / z ** (2 * k - 1)
    return log.exp() / shift


def exact_series(a, b, c, z):
    term, total, k = Decimal(1), Decimal(1), 0
    while k < 50 or abs(term) > abs(total) * Decimal("1e-45"):
        term *= (a + k) * (b + k) / ((c + k) * (k + 1)) * z
        total, k = total + term, k + 1
        if not term:
            break
    return total


def exact_purchases(r, alpha, a, b, x, age, days):
    """Purchases of an active customer by the hypergeometric closed form; two series in 1 − z where z is large (gaps must not be whole)."""
    getcontext().prec = 60
    r, alpha, a, b, x, age, days = (Decimal(repr(float(v))) for v in (r, alpha, a, b, x, age, days))
    aa, bb, c = a + b - 1 - r, a - 1, a + b - 1 + x
    w = (alpha + age) / (alpha + age + days)
    if w > Decimal("0.4"):
        value = exact_series(aa, bb, c, 1 - w)
    else:
        s = c - aa - bb
        value = (exact_gamma(c) * exact_gamma(s) / (exact_gamma(c - aa) * exact_gamma(c - bb)) * exact_series(aa, bb, 1 - s, w)
                 + w ** s * exact_gamma(c) * exact_gamma(-s) / (exact_gamma(aa) * exact_gamma(bb)) * exact_series(c - aa, c - bb, s + 1, w))
    return float(c / bb * (1 - w ** bb * value))


@pytest.mark.parametrize("arrow", [False, True])
@pytest.mark.parametrize("r,alpha,a,b,x,age,days", [
    (0.6, 60.0, 1.5, 2.5, 0, 0, 365), (0.6, 60.0, 1.5, 2.5, 40, 900, 365), (0.25, 4.4, 0.793, 2.426, 5, 38, 39),
    (0.25, 1e-4, 0.8, 2.4, 0, 0, 720), (0.25, 1e-4, 0.8, 2.4, 300, 700, 720), (0.6, 7.2e-7, 1.5, 2.55, 0, 0, 720),
    (0.6, 60.0, 1.0001, 2.5, 2, 30, 365), (2.2, 10.0, 0.3, 0.4, 3, 100, 3650), (0.05, 1e-6, 2.3, 0.7, 0, 0, 720),
    (1.3, 5.0, 6.2, 9.1, 1200, 1500, 360), (0.25, 4.0, 0.1, 0.15, 12, 400, 30), (0.6, 7.2e-7, 1.5, 2.55, 7, 0.001, 720),
    (3.5, 40.0, 30.2, 55.0, 4, 100, 365), (2.1628, 530.6, 1.5e-8, 0.0058, 0, 100, 360), (2.1628, 530.6, 1.5e-8, 0.0058, 17, 900, 30),
    (0.7, 30.0, 0.02, 3e-5, 0, 10, 360), (0.7, 30.0, 5.3, 0.002, 0, 10, 360), (0.7, 30.0, 0.9, 4e-7, 1, 300, 360),
])
def test_purchases_of_active_customers_to_ten_digits(spark, r, alpha, a, b, x, age, days, arrow):
    row = spark.createDataFrame([(x, float(age))], "frequency int, T double")
    plan = [[(float(days), 1.0)], [(float(days), 0.25), (days / 2, 3.0)]]
    got = row.select(bgnbd.active_purchases(bgnbd.PurchaseModel(r, alpha, a, b), plan, arrow).alias("e")).first()["e"]
    want = exact_purchases(r, alpha, a, b, x, age, days)
    assert got["p0"] == pytest.approx(want, rel=1e-10)
    assert got["p1"] == pytest.approx(0.25 * want + 3.0 * exact_purchases(r, alpha, a, b, x, age, days / 2), rel=1e-10)


def test_unknown_histories_have_no_expectation(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, 3, None), (3, 0, 0)], "id int, frequency int, T int").withColumn("recency", F.lit(0))
    got = {r["id"]: r["e"] for r in rows.select("id", bgnbd.expected_purchases(bgnbd.PurchaseModel(0.6, 60.0, 1.0, 2.5), 30).alias("e")).collect()}
    assert got[1] is None and got[2] is None and 0 < got[3] < 1
    assert rows.limit(0).select(bgnbd.expected_purchases(bgnbd.PurchaseModel(0.6, 60.0, 1.5, 2.5), 30)).count() == 0
    with pytest.raises(ValueError):
        bgnbd.expected_purchases(bgnbd.PurchaseModel(0.6, 60.0, 0.0, 2.5), 30)


def test_hash_splits_depend_on_the_key_only(spark):
    ids = spark.range(20000).withColumnRenamed("id", "customer_id")
    split = ids.select("customer_id", fold_id("customer_id", 5).alias("f"), treatment_flag("customer_id", 0.3).alias("t"),
                       conformal_part("customer_id").alias("p"))
    again = ids.repartition(3).select("customer_id", fold_id("customer_id", 5).alias("f"),
                                      treatment_flag("customer_id", 0.3).alias("t"), conformal_part("customer_id").alias("p"))
    assert split.exceptAll(again).count() == 0
    shares = split.agg(F.avg("t").alias("t"), F.avg((F.col("p") == "train").cast("int")).alias("p"),
                       F.avg((F.col("f") == 0).cast("int")).alias("f")).first()
    assert shares["t"] == pytest.approx(0.3, abs=0.02) and shares["p"] == pytest.approx(0.6, abs=0.02)
    assert shares["f"] == pytest.approx(0.2, abs=0.02)


def test_expected_purchases_of_recent_customers_converge(spark):
    new = spark.createDataFrame([(0, 0, 0)], "frequency int, recency int, T int")
    for model, days, want in (((0.25, 1.0, 2.5, 2.4), 720, 1.9107), ((0.25, 1.0, 0.8, 2.4), 360, 7.917)):
        got = new.select(bgnbd.expected_purchases(bgnbd.PurchaseModel(*model), days).alias("e")).first()["e"]
        assert got == pytest.approx(want, rel=1e-3)


def test_likelihood_of_heavy_buyers_is_not_clamped(spark):
    rows = spark.createDataFrame([(0, 1.0, 900.0, 10.0, 1000.0), (1, 1.0, 3.0, 5.0, 9.0)], "i int, weight double, x double, tx double, t double")
    one = [F.lit(1.0)] * 4
    got = {r["i"]: r["ll"] for r in bgnbd._log_likelihood(rows, one).collect()}
    for i, x, tx, t in ((0, 900.0, 10.0, 1000.0), (1, 3.0, 5.0, 9.0)):
        r = al = a = b = 1.0
        base = math.lgamma(r + x) - math.lgamma(r) + r * math.log(al) + math.lgamma(a + b) + math.lgamma(b + x) - math.lgamma(b) - math.lgamma(a + b + x)
        alive, gone = -(r + x) * math.log(al + t), math.log(a / (b + x - 1)) - (r + x) * math.log(al + tx)
        high = max(alive, gone)
        assert got[i] == pytest.approx(base + high + math.log(math.exp(alive - high) + math.exp(gone - high)), rel=1e-9)


def test_histories_are_spread_before_they_are_valued(spark):
    """A table that sits in one partition is valued by all tasks; values in batches are those of the fold over the nodes."""
    rfm = spark.range(400).select(
        F.col("id").alias("customer_id"), (F.col("id") % 9).alias("frequency"), (F.col("id") * 3 % 300).cast("int").alias("recency"),
        (F.col("id") * 3 % 300 + 50).cast("int").alias("T"), (F.col("id") * 1.5 + 10).alias("monetary_value")).coalesce(1)
    scored = gamma_gamma.predict_all(rfm, bgnbd.PurchaseModel(0.6, 60.0, 1.5, 2.5), gamma_gamma.SpendModel(6.0, 4.0, 15.0), Settings(), arrow=True)
    sizes = scored.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) <= 100
    plain = gamma_gamma.predict_all(rfm, bgnbd.PurchaseModel(0.6, 60.0, 1.5, 2.5), gamma_gamma.SpendModel(6.0, 4.0, 15.0), Settings(), arrow=False)
    gap = scored.join(plain.toDF("customer_id", "p", "a", "c", "i"), "customer_id").agg(
        F.count("*"), F.max(F.abs(F.col("predicted_purchases") / F.col("p") - 1)), F.max(F.abs(F.col("predicted_clv") - F.col("c")))).first()
    assert gap[0] == 400 and gap[1] < 1e-10 and gap[2] < 1e-6
