"""Modelling with Spark ML: gradient-boosted trees, class weights, early
stopping, grid / randomized search with stratified folds, isotonic
calibration, threshold wrapper, importances, persistence and a run ledger.

Parameter names of the reference's booster map onto ``GBTClassifier`` (T7):
n_estimators -> maxIter, learning_rate -> stepSize, max_depth -> maxDepth,
min_child_weight -> minInstancesPerNode (approx.), gamma -> minInfoGain
(approx.), subsample -> subsamplingRate, colsample_bytree * colsample_bylevel ->
featureSubsetStrategy; reg_alpha / reg_lambda have no counterpart and are
dropped; scale_pos_weight -> a per-row ``weightCol``.  n_estimators is an upper
bound: boosting stops when a tree no longer lowers the validation loss by
``STOP_GAIN`` times the learning rate, or, with ``patience``, after that many
rounds without a lower validation loss, back at the best round.
"""

from __future__ import annotations

import datetime as dt
import itertools
import math
import os
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import boost
from riskframe.operators import metrics as M
from riskframe.operators.preprocess import CategoryPrep, NumericPrep
from riskframe.session import cut_lineage, scratch_path

SEED = 42
# The reference's search spaces (less reg_alpha / reg_lambda) and fallback model.
ROBUST_GRID = {"n_estimators": [500, 1000], "learning_rate": [0.01, 0.1], "max_depth": [3, 5],
               "scale_pos_weight": ["one", "ratio"]}
RANDOM_SPACE = {"n_estimators": [300, 500, 700, 1000], "learning_rate": [0.01, 0.03, 0.05, 0.07, 0.1],
                "max_depth": [3, 4, 5, 6, 7], "min_child_weight": [1, 3, 5, 7],
                "gamma": [0, 0.1, 0.2, 0.3, 0.5], "subsample": [0.7, 0.8, 0.9],
                "colsample_bytree": [0.7, 0.8, 0.9], "colsample_bylevel": [0.7, 0.8, 0.9],
                "scale_pos_weight": ["one", "half_ratio", "ratio", "ratio_x1_5"]}
PIPELINE_GRID = {"n_estimators": [1000, 1500], "learning_rate": [0.01, 0.05], "max_depth": [4, 5, 6],
                 "min_child_weight": [1, 3], "gamma": [0, 0.1], "subsample": [0.8, 0.9],
                 "colsample_bytree": [0.8, 0.9]}
FALLBACK = {"n_estimators": 500, "learning_rate": 0.1, "max_depth": 3, "scale_pos_weight": "ratio"}
RANDOM_DRAWS = 30
GRID_FOLDS, RANDOM_FOLDS = 3, 5
PATIENCE, SEARCH_PATIENCE = 10, 20
STOP_GAIN = 0.01
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 25_000, 1_000_000
WEIGHT_FACTORS = {"one": None, "half_ratio": 0.5, "ratio": 1.0, "ratio_x1_5": 1.5}


def add_weight_columns(df: DataFrame, label: str, ratio: float) -> DataFrame:
    """ML2: one weight column per scale_pos_weight option (w_one, w_ratio, ...),
    so a search can vary ``weightCol`` like any other parameter."""
    cols = []
    for name, f in WEIGHT_FACTORS.items():
        w = 1.0 if f is None else ratio * f
        cols.append(F.when(F.col(label) == 1, F.lit(float(w))).otherwise(F.lit(1.0)).alias(f"w_{name}"))
    return df.select("*", *cols)


def gbt(features: str = "features", label: str = "label", **ref) -> GBTClassifier:
    """ML1: a GBTClassifier from the reference's parameter names."""
    g = GBTClassifier(featuresCol=features, labelCol=label, seed=SEED, maxBins=64)
    return g.copy(to_param_map(g, ref))


def to_param_map(g: GBTClassifier, ref: dict) -> dict:
    m = {}
    columns = float(ref.get("colsample_bytree", 1)) * float(ref.get("colsample_bylevel", 1))
    if columns < 1:
        m[g.featureSubsetStrategy] = f"{columns:.4g}"
    for k, v in ref.items():
        if k == "n_estimators":
            m[g.maxIter] = int(v)
        elif k == "learning_rate":
            m[g.stepSize] = float(v)
            m[g.validationTol] = STOP_GAIN * float(v)
        elif k == "max_depth":
            m[g.maxDepth] = int(v)
        elif k == "min_child_weight":
            m[g.minInstancesPerNode] = int(v)
        elif k == "gamma":
            m[g.minInfoGain] = float(v)
        elif k == "subsample":
            m[g.subsamplingRate] = float(v)
        elif k == "scale_pos_weight":
            m[g.weightCol] = f"w_{v}"
    return m


def preprocess_stages(num_cols: Sequence[str], cat_cols: Sequence[str] = (), out: str = "features",
                      drop_first: bool = False, fit_where: str = "") -> list:
    """ML11: exact median fill and population scaling for numerics, most
    frequent fill and one-hot for categoricals (an unseen value encodes to all
    zeros, FN12; ``drop_first`` leaves the first category out, FN13); then one
    vector.  ``fit_where`` keeps rows, such as those of early stopping, out of
    the fits."""
    stages, inputs = [], []
    if num_cols:
        scaled = [f"{c}__std" for c in num_cols]
        stages.append(NumericPrep(inputCols=list(num_cols), outputCols=scaled, fitWhere=fit_where))
        inputs += scaled
    if cat_cols:
        coded = [f"{c}__oh" for c in cat_cols]
        stages.append(CategoryPrep(inputCols=list(cat_cols), outputCols=coded, dropFirst=drop_first,
                                   fitWhere=fit_where))
        inputs += coded
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return stages


def fit_tasks(rows: DataFrame, fits: int = 1, n: int | None = None) -> int:
    """Tasks for the ``n`` rows of a booster.  Every tree level is a job over
    all of them, and each task costs the driver a launch and a result: no more
    tasks than the rows fill, nor than there are cores for one of ``fits`` fits
    at a time, but none with more rows than a task should hold."""
    n = rows.count() if n is None else n
    cores = rows.sparkSession.sparkContext.defaultParallelism
    share = cores if fits < 2 else math.ceil(2 * cores / fits)
    return max(1, min(math.ceil(n / ROWS_PER_TASK), share), math.ceil(n / MOST_ROWS_PER_TASK))


def slot_names(model: PipelineModel) -> list[str]:
    """Names of the assembled vector's slots: the column, or column_category."""
    return [s for stage in model.stages if hasattr(stage, "slots") for s in stage.slots()]


def positive_probability(df: DataFrame, prob: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(prob))[1])


class RiskEvaluator(Evaluator):
    """ML6: search objective as an Evaluator.  ``metric`` is "f1" (at 0.5),
    "auc" or "objective" (0.4 * AUC + 0.6 * F1 at 0.3, AGG29); all are the
    distributed aggregates of ``operators.metrics``."""

    def __init__(self, metric: str = "f1", label: str = "label", prob: str = "probability"):
        super().__init__()
        self.metric, self.label, self.prob = metric, label, prob

    def _evaluate(self, dataset):
        d = positive_probability(dataset, self.prob, "__p1")
        if self.metric == "auc":
            return float(M.auc(d, self.label, "__p1").first()["auc"] or 0.0)
        if self.metric == "objective":
            return float(M.weighted_objective(d, self.label, "__p1", 0.3).first()["objective"] or 0.0)
        d = d.withColumn("__yhat", (F.col("__p1") >= 0.5).cast("int"))
        return float(M.with_rates(M.confusion(d, self.label, "__yhat")).first()["f1_score"])

    def of_counts(self, counts: DataFrame, n: int) -> list[float]:
        """The objective of ``n`` models from the rows of either class per
        (model, p)."""
        counts = cut_lineage(counts)
        found: dict[int, dict] = {i: {} for i in range(n)}
        if self.metric != "auc":
            yes = F.col("p") >= (0.5 if self.metric == "f1" else 0.3)
            conf = counts.groupBy("model").agg(
                F.sum(F.when(yes, 0).otherwise(F.col("neg"))).alias("tn"), F.sum(F.when(yes, F.col("neg")).otherwise(0)).alias("fp"),
                F.sum(F.when(yes, 0).otherwise(F.col("pos"))).alias("fn"), F.sum(F.when(yes, F.col("pos")).otherwise(0)).alias("tp"))
            for r in M.with_rates(conf).collect():              # a row per model
                found[r["model"]]["f1"] = r["f1_score"]
        if self.metric != "f1":
            for r in M.auc_of_counts(counts, "p", ["model"]).collect():
                found[r["model"]]["auc"] = r["auc"]
        if self.metric != "objective":
            return [float(v.get(self.metric) or 0.0) for v in found.values()]
        return [0.0 if v.get("auc") is None else 0.4 * v["auc"] + 0.6 * v["f1"] for v in found.values()]

    def isLargerBetter(self):
        return True


def grid_maps(g: GBTClassifier, grid: dict = ROBUST_GRID) -> list:
    """ML4: full grid of param maps."""
    keys = list(grid)
    return [to_param_map(g, dict(zip(keys, vals))) for vals in itertools.product(*[grid[k] for k in keys])]


def random_maps(g: GBTClassifier, space: dict = RANDOM_SPACE, n: int = RANDOM_DRAWS,
                seed: int = SEED) -> list:
    """ML5: n seeded draws from the search space."""
    rng = random.Random(seed)
    return [to_param_map(g, {k: rng.choice(v) for k, v in space.items()}) for _ in range(n)]


def search(train: DataFrame, estimator, maps: list, evaluator: Evaluator, fold_col: str = "fold",
           k: int = 3, parallelism: int = 2):
    """ML4/ML5/ML7: cross-validated search on precomputed stratified folds
    (SMP5), refit of the best map on all training rows (bestModel)."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=k, foldCol=fold_col, parallelism=parallelism, seed=SEED)
    return cv.fit(train)


class Search(NamedTuple):
    avgMetrics: list[float]
    bestModel: PipelineModel
    best: dict


def stopped_search(train: DataFrame, validation: DataFrame, stages: list, booster: GBTClassifier, maps: list,
                   evaluator: Evaluator, fold_col: str = "fold", k: int = 3, parallelism: int = 8,
                   patience: int | None = None) -> Search:
    """ML4/ML5/ML7 with early stopping: like ``search``, but every fit stops on
    the ``validation`` rows, and the preprocessing ``stages`` are fitted once
    per fold instead of once per fold and map.  Maps that differ in maxIter
    only share a fit.  All maps of a fold are boosted together, in one job per
    tree level (``boost``), and scored in one pass over the fold.  The best map
    is fitted again on all train rows, with its preprocessing.  With ``patience``
    every fit waits that many rounds instead of using Spark's tolerance."""
    if not maps:
        raise ValueError("a search needs at least one map")
    held = validation.withColumn(fold_col, F.lit(-1)).withColumn("is_val", F.lit(True))
    rows = train.withColumn("is_val", F.lit(False)).unionByName(held)
    tasks = fit_tasks(rows)

    def prepared(part):
        pre = Pipeline(stages=stages).fit(part.where("not is_val"))
        needed = {booster.getLabelCol(), fold_col, "is_val", booster.getFeaturesCol(),
                  *(m[booster.weightCol] for m in maps if booster.weightCol in m)}
        return pre, cut_lineage(pre.transform(part).select(*sorted(needed)).repartition(tasks))

    alike: dict[tuple, list[int]] = {}
    for i in sorted(range(len(maps)), key=lambda i: -maps[i].get(booster.maxIter, 0)):
        alike.setdefault(tuple(sorted((p.name, v) for p, v in maps[i].items() if p != booster.maxIter)), []).append(i)

    def grown(fit_rows, boosters):
        return boost.grow(fit_rows, boosters, "is_val", None if patience is None else waits(patience))

    def trees(model, m):
        bound = m.get(booster.maxIter, booster.getMaxIter())
        return model.kept(bound) if patience is None else max(1, best_round(model.losses[:bound], patience)[0])

    def scores(fold):
        part = rows.where(F.col(fold_col) != fold)
        pre, fit_rows = prepared(part)
        models = grown(fit_rows, [booster.copy(maps[group[0]]) for group in alike.values()])
        cut = {i: (model, trees(model, maps[i])) for model, group in zip(models, alike.values()) for i in group}
        test_rows = pre.transform(rows.where(F.col(fold_col) == fold))
        if isinstance(evaluator, RiskEvaluator):
            counts = boost.score_counts(test_rows, [cut[i] for i in range(len(maps))], booster.getLabelCol(),
                                        booster.getFeaturesCol())
            return evaluator.of_counts(counts, len(maps))
        test_rows = cut_lineage(test_rows)
        return [evaluator.evaluate(boost.spark_model(*cut[i], booster.copy(m)).transform(test_rows))
                for i, m in enumerate(maps)]

    # folds that leave cores idle are fitted at a time
    at_once = max(1, min(k, parallelism, train.sparkSession.sparkContext.defaultParallelism // tasks))
    with ThreadPool(at_once) as pool:
        folds = pool.map(scores, range(k), chunksize=1)
    avg = [sum(values) / k for values in zip(*folds)]
    best = maps[(max if evaluator.isLargerBetter() else min)(range(len(maps)), key=avg.__getitem__)]
    pre, fit_rows = prepared(rows)
    model, = grown(fit_rows, [booster.copy(best)])
    return Search(avg, PipelineModel([*pre.stages, boost.spark_model(model, trees(model, best), booster.copy(best))]), best)


class Patient(NamedTuple):
    """A booster cut at its best round, and the validation loss of every round
    up to the one that ended the wait."""
    model: GBTClassificationModel
    best_round: int
    losses: list[float]


def best_round(losses: Sequence[float], patience: int) -> tuple[int, int]:
    """(best round, rounds seen), from 1: the wait ends ``patience`` rounds
    after the last strictly lower loss."""
    best, low = 0, math.inf
    for i, loss in enumerate(losses, 1):
        if loss < low:
            best, low = i, loss
        elif i - best >= patience:
            return best, i
    return best, len(losses)


def waits(patience: int):
    """Whether ``patience`` rounds have passed since the lowest loss."""
    def over(losses):
        best, seen = best_round(losses, patience)
        return seen - best >= patience
    return over


def staged_losses(model: GBTClassificationModel, rows: DataFrame) -> list[float]:
    """Mean logistic loss of the first 1, 2, ... trees on ``rows``, each row
    counted once, in one pass over them."""
    weight = model.getOrDefault("weightCol") if model.isDefined("weightCol") else ""
    return list(model.evaluateEachIteration(rows.withColumn(weight, F.lit(1.0)) if weight else rows))


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees, with the parameters of the whole."""
    java = model._java_obj
    jvm = SparkContext._active_spark_context._jvm       # threads of a search have no active session
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), java.trees()[0:n], java.treeWeights()[0:n], java.numFeatures(), java.numClasses()))
    return model._copyValues(cut)


def fit_stopped(booster: GBTClassifier, rows: DataFrame, n: int) -> GBTClassificationModel:
    """A booster stopped by Spark's tolerance on the rows marked ``is_val``.
    ``n`` rows that one task holds are left to Spark ML; more are boosted in
    one job per tree level (``boost``)."""
    if n <= ROWS_PER_TASK:
        return booster.fit(rows, {booster.validationIndicatorCol: "is_val"})
    grown, = boost.grow(rows, [booster], "is_val")
    return boost.spark_model(grown, grown.kept(), booster)


def fit_patient(booster: GBTClassifier, rows: DataFrame, stopping: DataFrame, patience: int = PATIENCE) -> Patient:
    """ML3: boost until the loss on ``stopping`` has not fallen for
    ``patience`` rounds, and keep the trees up to the best round.

    The boosting itself waits (``boost``), so no round is fitted twice.  Rows
    that one task holds are left to Spark ML, which boosts a fixed number of
    rounds and cannot go on from a model: there the number is doubled from
    ``2 * patience`` until the wait ends.  Either gives the same trees, but
    for equal gains, which rounding tells apart.  ``rows`` should be
    checkpointed, as every tree level passes over them."""
    if patience < 1:
        raise ValueError("patience must be one round or more")
    limit = booster.getMaxIter()
    if rows.count() > ROWS_PER_TASK:
        both = rows.withColumn("__stop", F.lit(False)).unionByName(stopping.withColumn("__stop", F.lit(True)))
        grown, = boost.grow(both, [booster], "__stop", waits(patience))
        best, seen = best_round(grown.losses, patience)
        return Patient(boost.spark_model(grown, max(best, 1), booster), max(best, 1), grown.losses[:seen])
    rounds = min(limit, 2 * patience)
    while True:
        model = booster.fit(rows, {booster.maxIter: rounds})
        losses = staged_losses(model, stopping)
        best, seen = best_round(losses, patience)
        if seen - best >= patience or rounds >= limit:
            return Patient(first_trees(model, max(best, 1)), max(best, 1), losses[:seen])
        rounds = min(limit, 2 * rounds)


def with_threshold(model: PipelineModel, threshold: float) -> PipelineModel:
    """ML10: a copy of the pipeline whose classifier keeps the tuned threshold
    among its parameters, saved and loaded with it."""
    last = model.stages[-1].copy()
    last.setThresholds([1.0 - threshold, float(threshold)])
    return PipelineModel([*model.stages[:-1], last])


def stored_threshold(model: PipelineModel, default: float = 0.5) -> float:
    last = model.stages[-1]
    return float(last.getThresholds()[1]) if last.isSet("thresholds") else default


def fit_with_fallback(train: DataFrame, estimator, maps: list, evaluator: Evaluator,
                      fallback: GBTClassifier, run=search, **kw):
    """ML8: the search (``run``), or a fixed model when the search fails."""
    try:
        return run(train, estimator, maps, evaluator, **kw).bestModel, "search"
    except Exception:  # noqa: BLE001 -- any search failure falls back, as the reference does
        return fallback.fit(train), "fallback"


def search_table(cv_model, maps: list) -> DataFrame:
    """One row per param map: its settings and the mean fold metric."""
    spark = SparkSession.getActiveSession()
    rows = []
    for i, (m, v) in enumerate(zip(maps, cv_model.avgMetrics)):
        desc = ";".join(f"{p.name}={val}" for p, val in sorted(m.items(), key=lambda x: x[0].name))
        rows.append((i, desc, float(v)))
    return spark.createDataFrame(rows, "map_id int, params string, avg_metric double")


def fit_isotonic(val_scored: DataFrame, label: str = "label", p: str = "p1"):
    """ML9: isotonic map from validation scores to outcome rates (prefit)."""
    return IsotonicRegression(featuresCol=p, labelCol=label, predictionCol="p_cal").fit(val_scored)


def apply_threshold(df: DataFrame, p: str, threshold: float, out: str = "decision") -> DataFrame:
    """ML10: the decision uses the stored (tuned) threshold, not 0.5 (R8)."""
    return df.withColumn(out, (F.col(p) >= F.lit(float(threshold))).cast("int"))


def importance_table(model, features_df: DataFrame, features: str = "features") -> DataFrame:
    """ML13: (feature, importance) from ``featureImportances``, slot names from
    the assembled vector's ML attribute metadata (bounded by the slot count)."""
    meta = features_df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in meta.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = model.featureImportances.toArray()
    spark = features_df.sparkSession
    return spark.createDataFrame([(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)],
                                 "feature string, importance double")


def save_model(model, spark: SparkSession, name: str, promote: bool = False) -> str:
    """SNK3/SNK4: write the fitted pipeline/model under the shared folder;
    promotion writes the same model to ``prod/<name>``."""
    path = scratch_path(spark, os.path.join("models", name))
    model.write().overwrite().save(path)
    if promote:
        model.write().overwrite().save(scratch_path(spark, os.path.join("prod", name)))
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def ledger_rows(run_id: str, kind: str, items: dict, ts: dt.datetime | None = None) -> list:
    ts = ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return [(run_id, ts, kind, str(k), None if v is None else float(v) if isinstance(v, (int, float)) else None,
             None if isinstance(v, (int, float)) else str(v)) for k, v in items.items()]


def append_ledger(spark: SparkSession, path: str, rows: list) -> DataFrame:
    """SNK6/SNK7: (run_id, ts, kind, name, value, text) rows in a Parquet
    ledger partitioned by run: params, metrics, confusion counts and model info
    land in one table, and writing a run again replaces that run only."""
    df = spark.createDataFrame(rows, "run_id string, ts timestamp_ntz, kind string, name string, "
                                     "value double, text string")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    return spark.read.parquet(path).select(*df.columns)


def make_pipeline(stages: list, estimator) -> Pipeline:
    return Pipeline(stages=[*stages, estimator])
