"""Exact small-sample p-values, nearest-neighbour information and patience
against plain loops."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest

from riskframe.operators import drift


def _p_of_all_orders(n, m, d):
    hit = total = 0
    for chosen in itertools.combinations(range(n + m), n):
        i = j = 0
        gap = 0.0
        for s in range(n + m):
            i, j = (i + 1, j) if s in chosen else (i, j + 1)
            gap = max(gap, abs(i / n - j / m))
        total += 1
        hit += gap >= d - 1e-12
    return hit / total


@pytest.mark.parametrize("n, m", [(1, 1), (1, 6), (2, 3), (4, 4), (4, 6), (5, 7), (6, 6)])
def test_lattice_p_is_the_share_of_orders(n, m):
    lcm = math.lcm(n, m)                 # the statistic is a whole number of these parts
    for h in range(lcm + 1):
        assert abs(drift.lattice_p(n, m, h / lcm) - _p_of_all_orders(n, m, h / lcm)) < 1e-12


def _p_by_counting(n, m, d):
    """Paths that stay inside, counted with whole numbers."""
    lcm = math.lcm(n, m)
    bound = round(d * lcm)
    row = [0] * (m + 1)
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * (lcm // n) - j * (lcm // m)) >= bound:
                row[j] = 0
            elif i == j == 0:
                row[j] = 1
            else:
                row[j] += row[j - 1] if j else 0
    total = math.comb(n + m, n)
    return (total - row[m]) / total


@pytest.mark.parametrize("n, m", [(200, 200), (200, 199), (37, 200), (150, 100)])
def test_lattice_p_equals_whole_number_counts(n, m):
    for d in (0.02, 0.08, 0.15, 0.3, 0.9):
        h = round(d * math.lcm(n, m)) / math.lcm(n, m)
        want = _p_by_counting(n, m, h)
        assert drift.lattice_p(n, m, h) == pytest.approx(want, rel=1e-9)


def test_ks_methods_by_group(spark):
    rng = np.random.RandomState(5)
    parts = []
    for g, (n, m) in {"a": (40, 30), "b": (300, 20), "c": (25, 25)}.items():
        parts.append(pd.DataFrame({"g": g, "feature": "f", "side": "ref", "value": np.round(rng.randn(n), 1)}))
        parts.append(pd.DataFrame({"g": g, "feature": "f", "side": "cur", "value": np.round(rng.randn(m) + 0.4, 1)}))
    parts.append(pd.DataFrame({"g": "flat", "feature": "f", "side": ["ref", "cur"], "value": [1.0, 1.0]}))
    pdf = pd.concat(parts)
    long = spark.createDataFrame(pdf)
    got = {m: {r["g"]: r for r in drift.ks_drift(long, slices=3, by=["g"], method=m, exact_rows=100).collect()}
           for m in ("asymptotic", "exact", "auto")}
    for g in "abc":
        x = pdf[pdf.g == g]
        ref, cur = x[x.side == "ref"].value.values, x[x.side == "cur"].value.values
        d = max(abs((ref <= v).mean() - (cur <= v).mean()) for v in np.concatenate([ref, cur]))
        assert abs(got["exact"][g]["ks_statistic"] - d) < 1e-12
        assert got["exact"][g]["p_value"] == pytest.approx(_p_by_counting(len(ref), len(cur), d), rel=1e-9)
    assert got["auto"]["b"]["p_value"] == got["asymptotic"]["b"]["p_value"]      # 300 values: beyond the bound
    assert got["auto"]["a"]["p_value"] == got["exact"]["a"]["p_value"]
    assert all("flat" not in rows for rows in got.values())
    with pytest.raises(ValueError):
        drift.ks_drift(long, method="other")


def _psi(n):
    return -0.5772156649015329 + sum(1.0 / i for i in range(1, int(n)))


def _knn_mi(x, y, k):
    keep = np.zeros(len(x), bool)
    total, n = 0.0, 0
    for c in np.unique(y):
        keep |= (y == c) & ((y == c).sum() > 1)
    xs, ys = x[keep], y[keep]
    for a, c in zip(xs, ys):
        near = np.sort(np.abs(xs[ys == c] - a))          # the row itself comes first
        kc = min(k, len(near) - 1)
        d = np.abs(xs - a)
        m = (d == 0).sum() if near[kc] == 0 else (d < near[kc]).sum()
        total += _psi(kc) - _psi(len(near)) - _psi(m)
        n += 1
    return max(0.0, _psi(n) + total / n)


@pytest.mark.parametrize("k, run_rows", [(3, 100_000), (3, 7), (1, 3), (5, 11)])
def test_knn_mutual_info_matches_a_loop(spark, k, run_rows):
    rng = np.random.RandomState(k)
    n = 240
    y = np.concatenate([rng.randint(0, 3, n - 1), [9]])             # class 9 has one row
    pdf = pd.DataFrame({"y": y, "tied": rng.poisson(3 + 2 * (y == 1)), "cont": np.round(rng.randn(n) + y % 3, 6),
                        "flat": 1, "gap": np.where(rng.rand(n) < 0.5, 0, rng.randint(0, 1000, n) * 1000)})
    from riskframe.operators import select
    got = {r["feature"]: r["mi"] for r in select.knn_mutual_info(
        spark.createDataFrame(pdf), ["tied", "cont", "flat", "gap"], "y", k=k, run_rows=run_rows, slices=4).collect()}
    for f, mi in got.items():
        units = np.round(pdf[f].to_numpy() * 1e6).astype(np.int64)
        assert mi == pytest.approx(_knn_mi(units, y, k), abs=1e-8), f
    assert got["flat"] == 0.0 and len(got) == 4


def test_knn_mutual_info_odd_rows(spark):
    from riskframe.operators import select
    rows = [(0, 1.0, None), (1, 1.0, None), (0, None, None), (1, float("nan"), None), (None, 5.0, None),
            (0, 2.0, None), (1, 4.0, None), (1, 4.0, None)]
    got = select.knn_mutual_info(spark.createDataFrame(rows, "y int, v double, gone double"), ["v", "gone"], "y", slices=3)
    mi = {r["feature"]: r["mi"] for r in got.collect()}
    x, y = np.array([1, 1, 2, 4, 4]), np.array([0, 1, 0, 1, 1])
    assert set(mi) == {"v"} and mi["v"] == pytest.approx(_knn_mi(x, y, 3), abs=1e-8)


def test_best_round():
    from riskframe.operators.model import best_round
    assert best_round([3, 2, 2, 2, 2, 1], 3) == (2, 5)       # equal is not lower
    assert best_round([3, 2, 2, 1, 2, 2, 2, 0], 3) == (4, 7)
    assert best_round([1, 2], 1) == (1, 2)
    assert best_round([3, 2, 1], 5) == (3, 3)
    assert best_round([], 5) == (0, 0)


def _boost_rows(spark, seed, n=500, noise=0.35):
    rng = np.random.RandomState(seed)
    x = rng.rand(n, 3)
    y = ((x[:, 0] > 0.5) ^ (rng.rand(n) < noise)).astype(int)
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y, "w": 1.0 + 2 * y,
                                             "held": rng.rand(n) < 0.4})).repartition(1)
    from riskframe.session import cut_lineage
    df = cut_lineage(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    return df.where("not held"), df.where("held")


@pytest.mark.parametrize("seed, patience, weighted", [(1, 2, False), (2, 3, True), (3, 5, False)])
def test_patience_equals_a_plain_loop(spark, seed, patience, weighted):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from riskframe.operators import model as ML
    rows, held = _boost_rows(spark, seed)
    booster = ML.gbt(n_estimators=24, learning_rate=0.4, max_depth=3)
    if weighted:
        booster = booster.setWeightCol("w")
    got = ML.fit_patient(booster, rows, held, patience)

    # one fit per number of rounds, its loss taken from its own raw scores, until the wait ends
    best, low, losses = 0, math.inf, []
    for t in range(1, 25):
        m = booster.fit(rows, {booster.maxIter: t})
        margin = m.transform(held).select("label", (vector_to_array("rawPrediction")[1]).alias("f"))
        losses.append(margin.agg(F.avg(2 * F.log1p(F.exp(-2 * (2 * F.col("label") - 1) * F.col("f"))))).first()[0])
        if losses[-1] < low:
            best, low, kept = t, losses[-1], m
        elif t - best >= patience:
            break
    assert got.best_round == best and got.model.getNumTrees == best
    assert got.losses == pytest.approx(losses, abs=1e-9)
    a = got.model.transform(held).select(vector_to_array("probability")[1]).toPandas().iloc[:, 0]
    b = kept.transform(held).select(vector_to_array("probability")[1]).toPandas().iloc[:, 0]
    assert np.allclose(a, b, atol=1e-12)
    assert got.model.featureImportances.size == 3


def test_cut_model_and_threshold_are_saved(spark):
    from pyspark.ml import PipelineModel

    from riskframe.operators import model as ML
    rows, held = _boost_rows(spark, 4)
    got = ML.fit_patient(ML.gbt(n_estimators=6, max_depth=2), rows, held, 2)
    pipe = PipelineModel([got.model])
    assert ML.stored_threshold(pipe) == 0.5
    tuned = ML.with_threshold(pipe, 0.35)
    assert ML.stored_threshold(pipe) == 0.5                     # the original is left alone
    back = ML.load_pipeline(ML.save_model(tuned, spark, "patient_toy"))
    assert ML.stored_threshold(back) == 0.35 and back.stages[-1].getNumTrees == got.best_round
    p = ML.positive_probability(back.transform(held)).toPandas()
    assert ((p.p1 > 0.35).astype(int) == p.prediction.astype(int)).all()
    with pytest.raises(ValueError):
        ML.fit_patient(ML.gbt(n_estimators=2), rows, held, 0)


def test_search_with_patience(spark):
    from riskframe.operators import model as ML
    rows, held = _boost_rows(spark, 6, 300)
    rows = rows.drop("features").withColumn("fold", (rows.a * 1000).cast("int") % 2)
    g = ML.gbt()
    maps = ML.grid_maps(g, {"n_estimators": [3, 8], "learning_rate": [0.4], "max_depth": [2]})
    got = ML.stopped_search(rows, held.drop("features"), ML.preprocess_stages(["a", "b", "c"]), g, maps,
                            ML.RiskEvaluator("auc"), k=2, patience=2)
    assert len(got.avgMetrics) == 2 and got.best in maps
    assert 1 <= got.bestModel.stages[-1].getNumTrees <= 8


def test_calibration_leaves_out_rows_without_a_probability(spark):
    from riskframe.operators import metrics
    df = spark.createDataFrame([(0.05, 0), (0.95, 1), (None, 1), (float("nan"), 0)], "p double, y int")
    got = {r["bin"]: r["n"] for r in metrics.calibration_curve(df, "y", "p").collect()}
    assert got == {0: 1, 9: 1}
