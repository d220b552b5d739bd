"""Counts of 10^10 rows per class or side: no overflow, exact sizes."""
from fractions import Fraction

from pyspark.sql import functions as F

from riskframe.operators import drift, split


def test_apportion_is_exact_at_ten_billion_rows(spark):
    counts = {0: 9_999_999_999, 1: 3_333_333_334, 2: 7}
    df = spark.createDataFrame(list(counts.items()), "label int, n_c long")
    got = {r["label"]: r["test"] for r in split._apportion(df, "label", "n_c", 20, "test").collect()}
    total = sum(counts.values())
    k = -(-total * 20 // 100)
    share = {c: Fraction(k * n, total) for c, n in counts.items()}
    want = {c: int(s) for c, s in share.items()}
    for c in sorted(counts, key=lambda c: (-(share[c] - want[c]), c))[:k - sum(want.values())]:
        want[c] += 1
    assert got == want and sum(got.values()) == k


def test_ks_statistic_at_ten_billion_rows(spark, monkeypatch):
    rows = [("f", v, a, b, 10 ** 10, 10 ** 10, c, d) for v, a, b, c, d in [(1.0, 6 * 10 ** 9, 4 * 10 ** 9, 0.6, 0.4), (2.0, 4 * 10 ** 9, 6 * 10 ** 9, 1.0, 1.0)]]
    e = spark.createDataFrame(rows, "feature string, value double, n_ref long, n_cur long, tot_ref long, tot_cur long, cdf_ref double, cdf_cur double")
    monkeypatch.setattr(drift, "ecdf", lambda long, slices: e)
    r = drift.ks_drift(spark.range(1).select(F.col("id"))).first()
    assert abs(r["ks_statistic"] - 0.2) < 1e-12 and r["p_value"] < 1e-6 and r["is_drift"]
