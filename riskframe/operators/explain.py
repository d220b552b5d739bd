"""Per-row additive explanations, global importance, dependence tables.

Linear scores are explained with column arithmetic only:
``contribution_j = w_j * (x_j - mean_j)``.  Tree ensembles are explained by
path attribution: the saved model's node table (bounded by trees x nodes) is
shipped to the tasks, and each Arrow batch walks every tree for all its rows
at once with NumPy, adding ``weight * (prediction(child) - prediction(node))``
to the split feature.  Contributions plus the bias equal the raw margin.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TOP_CONTRIBUTIONS = 10   # fixed value: contributions kept per scored row


# ---------------------------------------------------------------- linear ---
def linear_weights(fit: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """A one-row table of univariate least-squares slopes and means
    (w_j = cov(x_j, y) / var(x_j), 0 for a constant column) plus the base
    rate: a transparent linear score fitted with one aggregate."""
    aggs = [F.avg(F.col(label).cast("double")).alias("base")]
    for c in features:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"),
                 F.coalesce(F.try_divide(F.covar_pop(x, F.col(label).cast("double")), F.var_pop(x)),
                            F.lit(0.0)).alias(f"w__{c}")]
    return fit.agg(*aggs)


def linear_contributions(df: DataFrame, params: DataFrame, features: Sequence[str],
                         key: str) -> DataFrame:
    """ML14 (linear): adds ``score`` and an array of (feature, contribution).
    The fitted one-row parameters (two numbers per feature) are applied as
    literals (JN4), so the plan has no join at all."""
    p = params.first().asDict()
    contrib = F.array(*[F.struct(F.lit(c).alias("feature"),
                                 (F.lit(p[f"w__{c}"]) * (F.col(c).cast("double") - F.lit(p[f"m__{c}"])))
                                 .alias("contribution"))
                        for c in features])
    out = df.select(key, *features, F.lit(p["base"]).alias("base"), contrib.alias("contributions"))
    return out.withColumn("score", F.col("base") + F.aggregate(
        "contributions", F.lit(0.0), lambda acc, s: acc + s["contribution"]))


def top_contributions(df: DataFrame, key: str, arr: str = "contributions",
                      k: int = TOP_CONTRIBUTIONS) -> DataFrame:
    """TOP4: per row, the k largest |contribution| with sign kept, ties by
    feature name; sorted inside the row's array (no shuffle), then exploded
    to (key, rank, feature, contribution)."""
    def cmp(a, b):
        da, db = F.abs(a["contribution"]), F.abs(b["contribution"])
        return (F.when(da > db, -1).when(da < db, 1)
                 .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0))
    top = F.slice(F.array_sort(F.col(arr), cmp), 1, k)
    return df.select(key, F.posexplode(top).alias("pos", "c")).select(
        key, (F.col("pos") + 1).alias("rank"), "c.feature", "c.contribution")


def explode_contributions(df: DataFrame, key: str, arr: str = "contributions") -> DataFrame:
    return df.select(key, F.explode(arr).alias("c")).select(key, "c.feature", "c.contribution")


def mean_abs_contribution(long: DataFrame) -> DataFrame:
    """AGG25: global importance = mean |contribution| per feature."""
    return long.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))


def top_features(importance: DataFrame, k: int = 10, col: str = "mean_abs") -> DataFrame:
    """TOP5: the k most important features, name as tie-break."""
    return importance.orderBy(F.col(col).desc(), F.col("feature")).limit(k)


def dependence(df: DataFrame, feature: str, arr: str = "contributions") -> DataFrame:
    """ML15: (value, n, mean contribution) for one feature -- the data behind
    a dependence plot, from the row's own array, aggregated per distinct value."""
    c = F.filter(arr, lambda s: s["feature"] == feature)[0]["contribution"]
    v = df.select(F.col(feature).cast("double").alias("value"), c.alias("contribution"))
    return v.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.avg("contribution").alias("mean_contribution"))


# ----------------------------------------------------------------- trees ---
def tree_tables(spark: SparkSession, model_path: str):
    """Read a saved GBT model's node table and tree weights (bounded by the
    model size) into NumPy arrays, one entry per tree."""
    nodes = spark.read.parquet(os.path.join(model_path, "data")).select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
        "nodeData.split.numCategories").toPandas()
    tm = spark.read.parquet(os.path.join(model_path, "treesMetadata"))
    # columns are (tree id, metadata json, weight); older writers name them _1.._3
    meta = tm.select(F.col(tm.columns[0]).alias("treeID"), F.col(tm.columns[-1]).alias("weights")).toPandas()
    weights = dict(zip(meta["treeID"], meta["weights"]))
    trees = []
    for tid, g in nodes.groupby("treeID"):
        g = g.sort_values("id")
        n = int(g["id"].max()) + 1
        pred = np.zeros(n); left = -np.ones(n, int); right = -np.ones(n, int)
        feat = np.zeros(n, int); thr = np.zeros(n); cats = [None] * n
        for r in g.itertuples(index=False):
            i = int(r.id)
            pred[i], left[i], right[i] = r.prediction, r.leftChild, r.rightChild
            feat[i] = r.featureIndex
            if r.numCategories is not None and r.numCategories > 0:
                cats[i] = np.asarray(r.leftCategoriesOrThreshold, dtype=float)
            elif r.leftCategoriesOrThreshold is not None and len(r.leftCategoriesOrThreshold):
                thr[i] = r.leftCategoriesOrThreshold[0]
        trees.append((float(weights[tid]), pred, left, right, feat, thr, cats))
    return trees


def _walk(trees, X: np.ndarray):
    m = X.shape[0]
    contrib = np.zeros_like(X, dtype=float)
    bias = 0.0
    rows = np.arange(m)
    for w, pred, left, right, feat, thr, cats in trees:
        node = np.zeros(m, int)
        by_set = [i for i, c in enumerate(cats) if c is not None]
        bias += w * pred[0]
        active = left[node] >= 0
        while active.any():
            idx = rows[active]
            nd = node[idx]
            f = feat[nd]
            x = X[idx, f]
            go_left = x <= thr[nd]
            for n_ in by_set:                      # the few categorical nodes of this tree
                here = nd == n_
                go_left[here] = np.isin(x[here], cats[n_])
            child = np.where(go_left, left[nd], right[nd])
            np.add.at(contrib, (idx, f), w * (pred[child] - pred[nd]))
            node[idx] = child
            active = left[node] >= 0
    return contrib, bias


def vector_slot_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of an assembled vector's slots from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    names = {a["idx"]: a["name"] for g in meta.get("attrs", {}).values() for a in g}
    n = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(n)]


def tree_contributions(df: DataFrame, trees, names: Sequence[str], key: str,
                       features: str = "features", k: int | None = TOP_CONTRIBUTIONS) -> DataFrame:
    """ML14 (trees) + TOP4: (key, rank, feature, contribution, bias) with the
    k largest |contribution| per row (all when k is None)."""
    long = tree_explanations(df, trees, names, [key], features, k).select(
        key, "bias", F.posexplode("explanation").alias("pos", "c"))
    return long.select(key, (F.col("pos") + 1).alias("rank"), "c.feature", "c.contribution", "bias")


def tree_explanations(df: DataFrame, trees, names: Sequence[str], keep: Sequence[str],
                      features: str = "features", k: int | None = TOP_CONTRIBUTIONS) -> DataFrame:
    """ML14 (trees): one row per row of ``df`` with its ``keep`` columns, the
    ordered array ``explanation`` of (feature, contribution) and ``bias``."""
    names = list(names)
    kk = len(names) if k is None else min(k, len(names))
    x = df.select(*keep, vector_to_array(F.col(features)).alias("__x"))
    schema = T.StructType([*x.schema.fields[:-1], T.StructField("bias", T.DoubleType()),
                           T.StructField("feature", T.ArrayType(T.StringType())),
                           T.StructField("contribution", T.ArrayType(T.DoubleType()))])

    def fn(it):
        labels = np.asarray(names, dtype=object)
        for pdf in it:
            if len(pdf) == 0:
                continue
            X = np.nan_to_num(np.vstack(pdf["__x"].to_numpy()).astype(float), nan=0.0)
            if X.shape[1] != len(names):
                raise ValueError(f"{X.shape[1]} vector slots but {len(names)} names")
            c, bias = _walk(trees, X)
            sel = np.lexsort((np.tile(np.arange(len(names)), (len(X), 1)), -np.abs(c)))[:, :kk]
            yield pdf.drop(columns="__x").assign(
                bias=bias, feature=list(labels[sel]), contribution=list(np.take_along_axis(c, sel, axis=1)))
    out = x.mapInPandas(fn, schema)
    return out.select(*keep, F.arrays_zip("feature", "contribution").alias("explanation"), "bias")
