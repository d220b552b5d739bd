"""Mergeable sketches against exact results, within their stated bounds."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators import sketch as SK
from riskframe.session import scratch_path
from riskframe.streaming import jobs as J


def _gap(a, b):
    at = np.concatenate([a, b])
    return np.abs(np.searchsorted(np.sort(a), at, "right") / len(a) - np.searchsorted(np.sort(b), at, "right") / len(b)).max()


def test_merged_profile_is_within_the_bounds(spark):
    rng = np.random.RandomState(1)
    x = np.concatenate([np.round(rng.randn(60_000), 3), np.zeros(20_000), -np.zeros(5)])
    k = 256
    df = spark.createDataFrame(pd.DataFrame({"feature": "x", "value": x, "part": np.arange(len(x)) % 7}))
    parts = SK.column_sketches(df, ["part"], k=k)
    assert parts.count() == 7
    row = SK.sketch_profile(SK.merge_sketches(parts)).first()
    assert row["n"] == len(x)
    distinct = len(np.unique(x))
    assert abs(row["n_distinct"] - distinct) <= 3 * 1.04 / 2 ** (SK.DISTINCT_LG_K / 2) * distinct
    for q in (25, 50, 75):
        low, high = (x < row[f"q{q}"]).mean(), (x <= row[f"q{q}"]).mean()
        assert low - SK.rank_error(k) <= q / 100 <= high + SK.rank_error(k)


def test_small_columns_are_exact(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 2.0), ("a", None), ("a", float("nan")), ("b", None)],
                               "feature string, value double")
    rows = SK.sketch_profile(SK.column_sketches(df)).collect()
    assert [(r["feature"], r["n"], r["n_distinct"], r["q50"]) for r in rows] == [("a", 3, 3, 2.0)]
    assert SK.sketch_profile(SK.merge_sketches(SK.column_sketches(df.limit(0)))).count() == 0


def test_sketch_drift_is_within_its_bound(spark):
    rng = np.random.RandomState(2)
    sides = {"same": (rng.randn(30_000), rng.randn(20_000)), "moved": (rng.randn(30_000), rng.randn(20_000) + 0.3),
             "atoms": (rng.randint(0, 4, 30_000).astype(float), rng.randint(0, 5, 20_000).astype(float)),
             "flat": (np.ones(50), rng.randn(50))}

    def sketches(i, k):
        return SK.column_sketches(spark.createDataFrame(pd.concat(
            [pd.DataFrame({"feature": f, "value": v[i]}) for f, v in sides.items()])), k=k)
    for k in (512, SK.SKETCH_K):
        got = {r["feature"]: r for r in SK.sketch_drift(sketches(0, k), sketches(1, k)).collect()}
        assert set(got) == {"same", "moved", "atoms"}
        for f, r in got.items():
            assert abs(r["ks_statistic"] - _gap(*sides[f])) <= SK.drift_error(k), (f, k)
        assert got["moved"]["is_drift"] and got["atoms"]["is_drift"]


def test_running_drift_covers_all_batches_and_replays(spark):
    rng = np.random.RandomState(3)
    ref = spark.createDataFrame(pd.DataFrame({"feature": "v", "value": rng.randn(400)}))
    batches = [rng.randn(150) + m for m in (0.0, 0.0, 3.0)]
    out = scratch_path(spark, f"running-drift-{rng.randint(1e9)}-{os.getpid()}")
    fn = J.running_drift_writer(ref, out)
    for i, b in enumerate(batches):
        fn(spark.createDataFrame(pd.DataFrame({"feature": "v", "value": b})), i)

    def rows():
        return {r["batch_id"]: r for r in spark.read.parquet(os.path.join(out, "drift")).collect()}
    first = rows()
    exact = np.concatenate([ref.toPandas().value.to_numpy()])
    for i in range(3):
        seen = np.concatenate(batches[:i + 1])
        assert first[i]["n_cur"] == len(seen)
        assert abs(first[i]["ks_statistic"] - _gap(exact, seen)) <= SK.drift_error()
    fn(spark.createDataFrame(pd.DataFrame({"feature": "v", "value": batches[2]})), 2)        # replayed
    assert rows() == first
    fn(spark.createDataFrame([], "feature string, value double"), 3)                         # nothing new
    assert rows()[3]["ks_statistic"] == first[2]["ks_statistic"]
    assert spark.read.parquet(os.path.join(out, "state")).where(F.col("batch_id") == 3).count() == 1
