"""Semantics pinned by SURVEY section 7.5 (T1-T16)."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import clean, drift, features, metrics, text


def test_t1_exactly_half_null_is_kept(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, None, None), (4, "b", "x")],
                               "k int, half string, most string")
    assert clean.drop_sparse(df).columns == ["k", "half"]


def test_t2_right_closed_bins(spark):
    df = spark.createDataFrame([(0,), (3,), (4,), (7,), (14,), (15,)], "t int")
    got = [r[0] for r in df.select(fx.los_group("t")).collect()]
    assert got == [None, "short", "medium", "medium", "long", "very_long"]


def test_t3_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    p = features.scaler_params(df, ["x"]).first()
    assert math.isclose(p["std"], math.sqrt(2 / 3))
    z = [r[0] for r in features.standardize(df, features.scaler_params(df, ["x"])).collect()]
    assert np.allclose(z, [-1.224744871, 0.0, 1.224744871])
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r[0] for r in features.standardize(const, features.scaler_params(const, ["x"])).collect()] == [0.0, 0.0]


def test_t4_smoothed_idf_and_l2(spark):
    docs = spark.createDataFrame([(1, "apple banana"), (2, "apple cherry"), (3, "apple")], "doc_id int, text string")
    w = text.tfidf(docs, "doc_id", "text").where("term in ('apple', 'banana')").toPandas()
    idf_apple = math.log(4 / 4) + 1          # 1.0
    idf_banana = math.log(4 / 2) + 1
    d1 = w[w.doc_id == 1].set_index("term")["weight"]
    norm = math.sqrt(idf_apple ** 2 + idf_banana ** 2 + (math.log(4 / 2) + 1) ** 2)  # + bigram 'apple banana'
    assert math.isclose(d1["apple"], idf_apple / norm, rel_tol=1e-9)
    assert math.isclose(w[w.doc_id == 3]["weight"].iloc[0], 1.0)


def test_t5_mode_ties_smallest_and_median(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("a", 4.0), (None, None)], "c string, x double")
    m = clean.modes(df, ["c"]).first()
    assert m["mode"] == "a" and m["n"] == 2
    assert clean.medians(df, ["x"]).first()["median"] == 2.5


def test_t6_ks_pvalue_series(spark):
    df = spark.createDataFrame([(1.0,), (1.36,), (0.1,)], "lam double")
    got = [r[0] for r in df.select(drift.kolmogorov_p(F.col("lam"))).collect()]
    assert round(got[0], 6) == 0.27 and round(got[1], 6) == 0.049486 and got[2] == 1.0


def test_t10_calibration_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (0.1, 1), (0.1000001, 0), (1.0, 1)], "p double, y int")
    c = {r["bin"]: r["n"] for r in metrics.calibration_curve(df, "y", "p").collect()}
    assert c == {0: 2, 1: 1, 9: 1}


def test_t11_threshold_grid():
    g = metrics.threshold_grid(10, 90, 5)
    assert len(g) == 16 and g[1] == 0.15 and g[-1] == 0.85
    assert len(metrics.threshold_grid(10, 90, 1)) == 80


def test_t13_t14_single_class_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0.2, 0), (0, 0.7, 1)], "y int, p double, yhat int")
    assert metrics.auc(df, "y", "p").first()["auc"] is None
    r = metrics.with_rates(metrics.confusion(df, "y", "yhat")).first()
    assert r["recall"] == 0.0 and r["precision"] == 0.0 and r["f1_score"] == 0.0


def test_t16_summary_denominator(spark):
    per = spark.createDataFrame([("a", 0.5, 0.01, 0.99, True)],
                                "feature string, ks_statistic double, p_value double, drift_score double, is_drift boolean")
    s = drift.drift_summary(per, 4).first()
    assert s["drifted"] == 1 and math.isclose(s["drift_score"], 0.99 / 4) and s["drift_percentage"] == 25.0
    assert s["overall_drift"] is True


def test_validation_rules(spark):
    df = spark.createDataFrame([(130, "Male", 1, 1, 1, 1, 5.0, True), (30, "X", -1, 0, 0, 0, None, False)],
                               "age int, gender string, time_in_hospital int, num_medications int, "
                               "num_procedures int, num_diagnoses int, glucose_level double, insulin boolean")
    v = [r["violations"] for r in clean.violations(df).collect()]
    assert v[0] == "range:age"
    assert set(v[1].split(";")) == {"missing:glucose_level", "range:time_in_hospital", "allowed:gender"}


def test_interval_midpoint_and_risk_band(spark):
    df = spark.createDataFrame([("[40-50)", 0.29), ("none", 0.3), (None, 0.7)], "a string, p double")
    r = df.select(fx.interval_midpoint("a"), fx.risk_band("p")).collect()
    assert [x[0] for x in r] == [45, 50, 50] and [x[1] for x in r] == ["Low", "Medium", "High"]
