"""Preprocessing stages and the training chain against plain versions."""

import math
import random
from statistics import median

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import chain as CH
from riskframe.operators import model as ML
from riskframe.operators.preprocess import CategoryPrep
from riskframe.session import scratch_path

NAN = float("nan")
ROWS = [(1, 1.0, 5, "b", None, False), (2, None, 5, "a", None, False), (3, 4.0, 5, None, None, False),
        (4, 9.0, 5, "b", "only", False), (5, NAN, 5, "a", "only", False), (6, 2.0, 5, "c", None, False),
        (7, 100.0, 7, "z", "other", True), (8, None, None, None, None, True)]
SCHEMA = "id int, x double, k int, c string, e string, held boolean"


def pipeline(drop_first):
    return Pipeline(stages=ML.preprocess_stages(["x", "k"], ["c", "e"], drop_first=drop_first, fit_where="not held"))


def plain(drop_first):
    """The same by hand: medians, means and categories of the rows not held."""
    fit = [r for r in ROWS if not r[5]]
    number = lambda v: None if v is None or math.isnan(v) else float(v)
    out = [[] for _ in ROWS]
    for i in (1, 2):
        m = median([number(r[i]) for r in fit if number(r[i]) is not None])
        filled = [m if number(r[i]) is None else number(r[i]) for r in fit]
        mean, std = np.mean(filled), np.std(filled)
        for o, r in zip(out, ROWS):
            v = m if number(r[i]) is None else number(r[i])
            o.append((v - mean) / std if std else 0.0)
    for i in (3, 4):
        seen = [r[i] for r in fit if r[i] is not None]
        mode = min(set(seen), key=lambda v: (-seen.count(v), v))
        for o, r in zip(out, ROWS):
            o += [float((r[i] or mode) == v) for v in sorted(set(seen))[int(drop_first):]]
    return out


def vectors(model, df):
    return [r["v"] for r in model.transform(df).orderBy("id").select(vector_to_array("features").alias("v")).collect()]


def test_vectors_match_a_plain_version_and_survive_saving(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for drop_first in (False, True):
        model = pipeline(drop_first).fit(df)
        got = vectors(model, df)
        assert np.allclose(got, plain(drop_first))
        names = ML.slot_names(model)
        assert names == ["x", "k"] + ["c_a", "c_b", "c_c", "e_only"] if not drop_first else \
            names == ["x", "k", "c_b", "c_c"]
        path = scratch_path(spark, f"prep-{drop_first}")
        model.write().overwrite().save(path)
        again = PipelineModel.load(path)
        assert vectors(again, df) == got and ML.slot_names(again) == names
        assert model.transform(df).columns == again.transform(df).columns


def test_columns_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "id int, x double, c string")
    model = Pipeline(stages=ML.preprocess_stages(["x"], ["c"])).fit(df)
    assert vectors(model, df) == [[0.0], [0.0]]


def test_many_categories_have_the_same_schema_and_values(spark):
    few = spark.createDataFrame([(i, f"v{i % 5}") for i in range(50)], "id int, c string")
    many = spark.range(50_000).select(F.col("id").cast("int").alias("id"), F.format_string("v%05d", "id").alias("c"))
    prep = CategoryPrep(inputCols=["c"], outputCols=["o"], fill=False)
    small, large = prep.fit(few).transform(few), prep.fit(many).transform(many)
    assert small.dtypes == large.dtypes == [("id", "int"), ("c", "string"), ("o", "vector")]
    from pyspark.ml.functions import vector_to_array as arr
    hot = large.where("id % 9999 = 7").select("id", F.array_position(arr("o"), 1.0).alias("p"), "o").collect()
    assert all(r["p"] == r["id"] + 1 and r["o"].size == 50_000 and r["o"].numNonzeros() == 1 for r in hot)


def chain_rows(spark, n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        x, y = rng.random(), rng.random()
        rows.append((i, x, y, rng.random(), rng.choice(["u", "v", None]), int(x + 0.4 * rng.random() > 1.0), i % 2))
    return spark.createDataFrame(rows, "id long, x double, y double, z double, c string, label int, fold int")


def test_no_unseen_row_takes_part_in_a_fit(spark):
    rows = chain_rows(spark)
    fit, stop = rows.where("id % 5 <> 0"), rows.where("id % 5 = 0").drop("fold")
    booster = ML.gbt(n_estimators=4, max_depth=2, learning_rate=0.3)
    chain = CH.TrainingChain(["x", "y", "z"], ["c"], booster, key="id", k_best=2, neighbours=3)
    for f in CH.cross_fit(chain, fit, stop, folds=2):
        own = {r["id"]: r["label"] for r in fit.where(F.col("fold") != f.fold).collect()}
        used = f.resampled.rows.collect()
        assert {r["id"] for r in used if not r["synthetic"]} == set(own)
        grown = [r for r in used if r["synthetic"]]
        n1 = sum(own.values())
        assert len(grown) == (len(own) - n1) // 2 - n1 > 0
        # grown rows and their neighbours are positive fit rows of this fold
        assert all(own.get(r["id"]) == 1 and own.get(r["nbr"]) == 1 and r["label"] == 1 for r in grown)
        assert "x" in f.resampled.selected and len(f.resampled.selected) == 2
        # scoring adds no row and needs none of the fit's columns
        scored = f.scored.collect()
        assert sorted(r["id"] for r in scored) == sorted(
            r["id"] for r in fit.where(F.col("fold") == f.fold).collect())
        if f.fold:
            continue
        path = scratch_path(spark, "chain")
        f.model.write().overwrite().save(path)
        again = PipelineModel.load(path).transform(fit.select("id", "x", "y", "z", "c"))
        p = {r["id"]: r["probability"][1] for r in again.collect()}
        assert all(abs(p[r["id"]] - r["p1"]) < 1e-12 for r in scored)


def test_grown_rows_lie_between_their_neighbours(spark):
    rows = chain_rows(spark).withColumn("is_val", F.lit(False)).drop("fold")
    chain = CH.TrainingChain(["x", "y"], [], ML.gbt(), key="id", k_best=9)
    got = chain.resample(rows)
    at = {r["id"]: np.array(r["features"]) for r in got.rows.where("synthetic = 0").collect()}
    for r in got.rows.where("synthetic = 1").collect():
        a, b = at[r["id"]], at[r["nbr"]]
        v = np.array(r["features"])
        assert np.all(v >= np.minimum(a, b) - 1e-9) and np.all(v <= np.maximum(a, b) + 1e-9)
