"""Classification metrics as aggregates over a scored table.

Rank metrics (AUC, AP, curve points) first group rows by distinct score --
partial aggregation collapses the data map-side -- and then take skew-safe
running sums over the score order (``prefix.running_sum``), so no window ever
holds a whole class or subgroup in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.common import attach
from riskframe.operators.prefix import running_sum


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (T14)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, label: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """AGG11: tn, fp, fn, tp (bigint) per group."""
    y, p = F.col(label), F.col(pred)
    aggs = [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp")]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def with_rates(conf: DataFrame) -> DataFrame:
    """AGG12/AGG13 from confusion counts: accuracy, precision (=PPV), recall
    (=sensitivity), specificity (null when undefined, as the reference has no
    guard), F1, NPV; undefined precision/recall/F1/NPV -> 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    return conf.select(
        "*",
        F.try_divide(tp + tn, n).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        F.try_divide(tn, tn + fp).alias("specificity"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        _div0(tn, tn + fn).alias("negative_predictive_value"))


def brier(df: DataFrame, label: str, prob: str) -> DataFrame:
    """AGG16: mean squared error of the probability."""
    return df.agg(F.avg(F.pow(F.col(prob) - F.col(label), 2)).alias("brier_score"))


def score_counts(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (the input of every rank metric)."""
    return df.groupBy(*group_cols, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def auc(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = (),
        slices: int | None = None) -> DataFrame:
    """AGG14: ROC AUC with ties (Mann-Whitney): for each distinct score,
    pos * (negatives below + half the tied negatives), over P * N.  Null when
    a group has one class only (T13)."""
    return auc_of_counts(score_counts(df, label, score, group_cols), score, group_cols, slices)


def auc_of_counts(counts: DataFrame, score: str, group_cols: Sequence[str] = (),
                  slices: int | None = None) -> DataFrame:
    """``auc`` from the positives and negatives per distinct score."""
    g = list(group_cols)
    cum = running_sum(counts, g, [score], ["neg"], slices=slices)
    part = cum.select(*g, "pos", "neg",
                      (F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("u"))
    aggs = [F.sum("u").alias("u"), F.sum("pos").alias("P"), F.sum("neg").alias("N")]
    t = part.groupBy(*g).agg(*aggs) if g else part.agg(*aggs)
    return t.select(*g, F.when((F.col("P") > 0) & (F.col("N") > 0),
                               F.col("u") / F.col("P").cast("double") / F.col("N")).alias("auc"))


def average_precision(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = (),
                      slices: int | None = None) -> DataFrame:
    """AGG15 (with WIN6 folded in): step-wise AP = sum over distinct scores,
    descending, of (R_i - R_{i-1}) * P_i; the recall step at a score is
    pos / P, so no lag is needed.  Not the trapezoid rule."""
    g = list(group_cols)
    sc = score_counts(df, label, score, g)
    cum = running_sum(sc, g, [score], ["pos", "neg"], descending=True, slices=slices)
    part = cum.select(*g, "pos",
                      (F.col("pos").cast("double") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("s"))
    aggs = [F.sum("s").alias("s"), F.sum("pos").alias("P")]
    t = part.groupBy(*g).agg(*aggs) if g else part.agg(*aggs)
    return t.select(*g, F.try_divide(F.col("s"), F.col("P")).alias("average_precision"))


def rank_metrics(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = (),
                 slices: int | None = None) -> DataFrame:
    """AUC and AP from ONE ascending running sum: the descending counts AP
    needs are totals minus the ascending sums before each score."""
    g = list(group_cols)
    sc = score_counts(df, label, score, g)
    j = running_sum(sc, g, [score], ["pos", "neg"], slices=slices, totals=True)
    pos_d = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    neg_d = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    part = j.select(*g, "pos", "neg",
                    (F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("u"),
                    (F.col("pos").cast("double") * pos_d / (pos_d + neg_d)).alias("s"))
    aggs = [F.sum("u").alias("u"), F.sum("s").alias("s"), F.sum("pos").alias("P"), F.sum("neg").alias("N")]
    t = part.groupBy(*g).agg(*aggs) if g else part.agg(*aggs)
    return t.select(*g, F.when((F.col("P") > 0) & (F.col("N") > 0),
                               F.col("u") / F.col("P").cast("double") / F.col("N")).alias("auc"),
                    F.try_divide(F.col("s"), F.col("P")).alias("average_precision"))


def curve_points(df: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """WIN1: one row per distinct score (descending thresholds): tp, fp at
    ``score >= threshold`` and tpr, fpr, precision, recall."""
    sc = score_counts(df, label, score)
    j = running_sum(sc, [], [score], ["pos", "neg"], descending=True, slices=slices, totals=True)
    j = j.withColumnRenamed("tot_pos", "P").withColumnRenamed("tot_neg", "N")
    return j.select(
        F.col(score).alias("threshold"),
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.try_divide(F.col("cum_pos"), F.col("P")).alias("tpr"),
        F.try_divide(F.col("cum_neg"), F.col("N")).alias("fpr"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"))


def _edges(n_bins: int) -> list[float]:
    # the reference's bin edges are i * (1 / n_bins), as a float product
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def bin_index(p: Column, edges: Sequence[float]) -> Column:
    """Index of the (lo, hi] bin holding p; values at an edge go down (T10)."""
    expr = None
    for i, e in enumerate(edges):
        cond = p <= F.lit(float(e))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(edges))) if expr is not None else F.lit(0)


def calibration_curve(df: DataFrame, label: str, prob: str, n_bins: int = 10) -> DataFrame:
    """AGG17: per non-empty uniform bin: n, mean probability, positive share.
    Rows without a probability (null or NaN) are in no bin."""
    b = bin_index(F.col(prob), _edges(n_bins)).alias("bin")
    return df.where(F.col(prob).isNotNull() & ~F.isnan(prob)).groupBy(b).agg(F.count(F.lit(1)).alias("n"),
                             F.avg(prob).alias("prob_pred"),
                             F.avg(F.col(label).cast("double")).alias("prob_true"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """AGG18: precision / recall / F1 / support for class 0 and 1, plus macro
    and support-weighted averages (one aggregate pass)."""
    c = confusion(df, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    rows = []
    for cls, t, f_p, f_n, sup in (("0", tn, fn, fp, tn + fp), ("1", tp, fp, fn, tp + fn)):
        rows.append(F.struct(F.lit(cls).alias("cls"), _div0(t, t + f_p).alias("precision"),
                             _div0(t, t + f_n).alias("recall"),
                             _div0(2 * t, 2 * t + f_p + f_n).alias("f1"),
                             sup.alias("support")))
    per = c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    tot = per.agg(F.sum("support").alias("s"))
    w = attach(per, tot)
    avg = per.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                  F.sum("support").alias("support"))
    wavg = w.agg(F.lit("weighted avg").alias("cls"),
                 (F.sum(F.col("precision") * F.col("support")) / F.first("s")).alias("precision"),
                 (F.sum(F.col("recall") * F.col("support")) / F.first("s")).alias("recall"),
                 (F.sum(F.col("f1") * F.col("support")) / F.first("s")).alias("f1"),
                 F.sum("support").alias("support"))
    return per.unionByName(avg).unionByName(wavg)


def subgroup_metrics(df: DataFrame, label: str, pred: str, score: str,
                     features: Sequence[str], min_rows: int = 10) -> DataFrame:
    """AGG19 + FLT2/FLT4: per (feature, group): n, accuracy, precision, recall,
    F1 and AUC when both classes occur.  The grouping features are stacked into
    (feature, grp) rows, so all groups of all features come from one
    aggregate instead of a scan per group; null groups and groups with fewer
    than ``min_rows`` rows are dropped."""
    long = (df.select(F.col(label).alias("y"), F.col(pred).alias("p"), F.col(score).alias("s"),
                      *[F.col(f).cast("string").alias(f) for f in features])
              .unpivot(["y", "p", "s"], list(features), "feature", "grp")
              .where(F.col("grp").isNotNull()))
    conf = with_rates(confusion(long, "y", "p", ["feature", "grp"]))
    conf = conf.withColumn("n", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")) \
               .where(F.col("n") >= min_rows)
    a = auc(long, "y", "s", ["feature", "grp"])
    return (conf.join(a, ["feature", "grp"], "left")
                .select("feature", "grp", "n", "accuracy", "precision", "recall",
                        F.col("f1_score").alias("f1"), "auc"))


def threshold_grid(start: int = 10, stop: int = 90, step: int = 5) -> list[float]:
    """T11: thresholds as integers / 100 (16 values for 10..85 step 5)."""
    return [k / 100 for k in range(start, stop, step)]


def threshold_sweep(df: DataFrame, label: str, prob: str,
                    thresholds: Sequence[float] | None = None) -> DataFrame:
    """TOP8 input: confusion counts and F1 at every threshold (``p >= t``).

    No cross join: each row gets k = number of thresholds at or below its
    probability (a literal CASE chain), rows collapse to at most T+1 groups,
    and suffix sums over that tiny table give the counts for every t."""
    ts = sorted(thresholds or threshold_grid())
    T = len(ts)
    p = F.col(prob)
    k = None
    for i in range(T - 1, -1, -1):                   # highest threshold first
        cond = p >= F.lit(float(ts[i]))
        k = F.when(cond, F.lit(i + 1)) if k is None else k.when(cond, F.lit(i + 1))
    k = k.otherwise(F.lit(0))
    per_k = df.groupBy(k.alias("k")).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                        F.count_if(F.col(label) == 0).alias("neg"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i + 1, float(t)) for i, t in enumerate(ts)] + [(0, None)],
                                 "k int, threshold double")
    full = grid.join(F.broadcast(per_k), "k", "left").fillna(0, ["pos", "neg"])
    w = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(F.lit(1))
    s = full.select("k", "threshold", F.sum("pos").over(w).alias("tp"),
                    F.sum("neg").over(w).alias("fp"),
                    F.sum("pos").over(w_all).alias("P"), F.sum("neg").over(w_all).alias("N"))
    s = s.where(F.col("k") > 0).select(
        "threshold", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"),
        (F.col("N") - F.col("fp")).alias("tn"))
    return with_rates(s)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """TOP8: highest F1, first (smallest) threshold on ties."""
    return sweep.orderBy(F.col("f1_score").desc(), F.col("threshold").asc()).limit(1)


def evaluation(df: DataFrame, label: str, prob: str, threshold: float = 0.5) -> DataFrame:
    """F7 evaluation document as one row: confusion, rates, AUC, AP, Brier."""
    d = df.select(F.col(label).alias("y"), F.col(prob).alias("p"),
                  (F.col(prob) >= F.lit(threshold)).cast("int").alias("yhat"))
    conf = d.agg(F.count_if((F.col("y") == 0) & (F.col("yhat") == 0)).alias("tn"),
                 F.count_if((F.col("y") == 0) & (F.col("yhat") == 1)).alias("fp"),
                 F.count_if((F.col("y") == 1) & (F.col("yhat") == 0)).alias("fn"),
                 F.count_if((F.col("y") == 1) & (F.col("yhat") == 1)).alias("tp"),
                 F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier_score"))
    conf = with_rates(conf)
    one = attach(conf, rank_metrics(d, "y", "p"))  # both sides are one row
    return one.select("accuracy", "precision", "recall", F.col("recall").alias("sensitivity"),
                      "specificity", "f1_score", "auc", "average_precision", "brier_score",
                      F.col("precision").alias("positive_predictive_value"),
                      "negative_predictive_value", "tn", "fp", "fn", "tp")


def weighted_objective(df: DataFrame, label: str, prob: str, threshold: float = 0.3,
                       w_auc: float = 0.4, w_f1: float = 0.6) -> DataFrame:
    """AGG29: 0.4 * AUC + 0.6 * F1 at threshold 0.3 (the reference's search objective)."""
    d = df.select(F.col(label).alias("y"), F.col(prob).alias("p"),
                  (F.col(prob) >= F.lit(threshold)).cast("int").alias("yhat"))
    f1 = with_rates(confusion(d, "y", "yhat")).select("f1_score")
    a = auc(d, "y", "p")
    return attach(f1, a).select(
        "auc", "f1_score", (F.lit(w_auc) * F.col("auc") + F.lit(w_f1) * F.col("f1_score")).alias("objective"))
