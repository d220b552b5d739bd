"""Data drift between a reference and a current table.

The per-column loop of the reference becomes one plan: numeric features are
unpivoted to (feature, value, side), counted per distinct value (map-side
partial aggregation), and the two empirical CDFs come from one skew-safe
running sum ordered by value inside each feature.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskframe.operators.common import attach
from riskframe.operators.prefix import running_sum

# Fixed values (reference behaviour).
P_SIGNIFICANT = 0.05      # per-feature drift when p < 0.05
OVERALL_SHARE = 0.1       # overall drift when drifted > 10% of common columns
KS_TERMS = 100            # terms of the Kolmogorov series
KS_SMALL_LAMBDA = 0.2     # below this the series is not used: p = 1
KS_EXACT_ROWS = 10_000    # method "auto": exact p-value up to this size of the larger sample
HIST_BINS = 30
TOP_SCORES = 20
TOP_DISTRIBUTIONS = 5
AUC_FLOOR = 0.7
DRIFT_MESSAGE = "DATA DRIFT ALERT: Significant data drift detected with score %.4f. %d features have drifted."
AUC_MESSAGE = "PERFORMANCE ALERT: Model performance has degraded. AUC: %.4f"


def common_columns(a: DataFrame, b: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ10 / SET2: column names present in both, sorted (the reference's set
    order is arbitrary)."""
    return sorted((set(a.columns) & set(b.columns)) - set(exclude))


def stack_sides(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """SRC6: one (side, feature, value) table from a reference and a current frame."""
    def long(df, side):
        return (df.select(*[F.col(c).cast("double").alias(c) for c in features])
                  .unpivot([], list(features), "feature", "value")
                  .withColumn("side", F.lit(side)))
    return long(ref, "ref").unionByName(long(cur, "cur"))


def kolmogorov_p(lam: Column) -> Column:
    """AGG21: two-sided asymptotic p-value 2 * sum_k (-1)^(k-1) exp(-2 k^2 lam^2),
    clamped to [0, 1]; 1 for lam < 0.2 (T6)."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < KS_SMALL_LAMBDA, F.lit(1.0)).otherwise(p)


def lattice_p(n: int, m: int, d: float) -> float:
    """AGG21, exact: the probability that, over all orders of n and m untied
    values, the two empirical CDFs part by ``d`` or more somewhere.

    A random order is a walk from (0, 0) to (n, m) that takes its next step
    from the values left over.  The walk is followed by the number of steps,
    with the probability of every point that it reaches without having met the
    bound; what meets the bound is added up and leaves.  Only sums of positive
    numbers occur, so small p-values keep their digits.  O((n + m) * width)
    time and O(n) memory.
    """
    lcm = n // math.gcd(n, m) * m
    bound = round(d * lcm)                      # |i / n - j / m| >= d in whole numbers
    if bound <= 0:
        return 1.0
    up, right = lcm // n, lcm // m
    inside = np.zeros(n + 2)                    # by i; one spare place for the step
    inside[0] = 1.0
    met = 0.0
    lo = hi = 0                                 # points reached: i in lo..hi
    for s in range(n + m):
        i = np.arange(lo, hi + 1)
        left_n, left_m = n - i, m - (s - i)
        here = inside[lo:hi + 1] / (n + m - s)
        to_n, to_m = here * left_n, here * np.maximum(left_m, 0)
        inside[lo:hi + 1] = to_m
        inside[lo + 1:hi + 2] += to_n
        lo, hi = max(lo, s + 1 - m), min(hi + 1, n)
        i = np.arange(lo, hi + 1)
        out = np.abs(i * up - (s + 1 - i) * right) >= bound
        if out.any():
            met += inside[lo:hi + 1][out].sum()
            inside[lo:hi + 1][out] = 0.0
            kept = np.flatnonzero(~out)
            if not kept.size:
                break
            lo, hi = lo + int(kept[0]), lo + int(kept[-1])
    return float(min(met, 1.0))


@F.pandas_udf(DoubleType())
def exact_ks_p(n: pd.Series, m: pd.Series, d: pd.Series) -> pd.Series:
    """``lattice_p`` per row; null where the sizes are null."""
    return pd.Series([None if pd.isna(a) else lattice_p(int(a), int(b), float(x)) for a, b, x in zip(n, m, d)],
                     dtype="float64")


def value_counts_by_side(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, feature, value, n_ref, n_cur) with nulls dropped (they have no rank)."""
    return (long.where(F.col("value").isNotNull() & ~F.isnan("value"))
                .groupBy(*by, "feature", "value")
                .agg(F.count_if(F.col("side") == "ref").alias("n_ref"),
                     F.count_if(F.col("side") == "cur").alias("n_cur")))


def ecdf(long: DataFrame, slices: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """WIN2: both empirical CDFs at every distinct value of every feature, per
    group of ``by``; groups may be many, so their offsets are not broadcast."""
    return ecdf_of_counts(value_counts_by_side(long, by), slices, by, not by)


def ecdf_of_counts(counts: DataFrame, slices: int | None = None, by: Sequence[str] = (),
                   bounded_groups: bool = True) -> DataFrame:
    """The same from value counts (*by, feature, value, n_ref, n_cur)."""
    j = running_sum(counts, [*by, "feature"], ["value"], ["n_ref", "n_cur"], slices=slices, totals=True,
                    bounded_groups=bounded_groups)
    j = j.withColumnRenamed("tot_n_ref", "tot_ref").withColumnRenamed("tot_n_cur", "tot_cur")
    return j.select(*by, "feature", "value", "n_ref", "n_cur", "tot_ref", "tot_cur",
                    F.try_divide(F.col("cum_n_ref"), F.col("tot_ref")).alias("cdf_ref"),
                    F.try_divide(F.col("cum_n_cur"), F.col("tot_cur")).alias("cdf_cur"))


def ks_drift(long: DataFrame, slices: int | None = None, by: Sequence[str] = (), method: str = "asymptotic",
             exact_rows: int = KS_EXACT_ROWS) -> DataFrame:
    """AGG20 + AGG21 + FLT3: per feature D = max |F_ref - F_cur|, p-value,
    drift score 1 - p and flag p < 0.05.  Features with <= 1 distinct value
    on either side are skipped (no row).

    ``by`` compares the sides once per group of these columns.  ``method`` is
    "asymptotic" (Kolmogorov series), "exact" (lattice walk) or "auto": exact
    where neither side has more than ``exact_rows`` values, as a walk of
    n + m steps is one row's work in one task, and the series beyond."""
    points = ecdf(long, slices, by) if by else ecdf(long, slices)
    return _ks(points, by, method, exact_rows)


def ks_of_counts(counts: DataFrame, slices: int | None = None) -> DataFrame:
    """The same from value counts, for a side that was counted before."""
    return _ks(ecdf_of_counts(counts, slices))


def _ks(e: DataFrame, by: Sequence[str] = (), method: str = "asymptotic", exact_rows: int = KS_EXACT_ROWS) -> DataFrame:
    if method not in ("asymptotic", "exact", "auto"):
        raise ValueError(f"unknown method: {method}")
    per = e.groupBy(*by, "feature").agg(
        F.max(F.abs(F.col("cdf_ref") - F.col("cdf_cur"))).alias("ks_statistic"),
        F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur"),
        F.count_if(F.col("n_ref") > 0).alias("u_ref"), F.count_if(F.col("n_cur") > 0).alias("u_cur"))
    per = per.where((F.col("u_ref") > 1) & (F.col("u_cur") > 1))
    n_ref, n_cur = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")   # the product passes 2 ** 63
    p = kolmogorov_p(F.sqrt(n_ref * n_cur / (n_ref + n_cur)) * F.col("ks_statistic"))
    if method != "asymptotic":
        small = F.lit(True) if method == "exact" else F.greatest("n_ref", "n_cur") <= exact_rows
        walked = exact_ks_p(F.when(small, F.col("n_ref")), F.when(small, F.col("n_cur")), F.col("ks_statistic"))
        p = F.coalesce(walked, p)
    per = per.withColumn("p_value", p)
    return per.select(*by, "feature", "ks_statistic", "p_value",
                      (F.lit(1.0) - F.col("p_value")).alias("drift_score"),
                      (F.col("p_value") < P_SIGNIFICANT).alias("is_drift"))


def drift_summary(per_feature: DataFrame, n_common: int, run_ts: Column | None = None) -> DataFrame:
    """AGG22: overall flag when drifted > 10% of *all* common columns; mean
    score and percentage also divide by all common columns, skipped ones
    included (T16).  No common columns -> null score and percentage (R19)."""
    s = per_feature.agg(F.count_if("is_drift").alias("drifted"),
                        F.coalesce(F.sum("drift_score"), F.lit(0.0)).alias("score_sum"))
    n = F.lit(n_common).cast("bigint")
    out = s.select(
        F.col("drifted").cast("bigint").alias("drifted"), n.alias("features"),
        F.try_divide(F.col("score_sum"), n).alias("drift_score"),
        F.try_divide(F.col("drifted") * 100.0, n).alias("drift_percentage"),
        (F.col("drifted") > n * OVERALL_SHARE).alias("overall_drift"))
    if run_ts is not None:
        out = out.withColumn("run_ts", run_ts)
    return out


def top_drift(per_feature: DataFrame, k: int = TOP_SCORES) -> DataFrame:
    """TOP1 / TOP2: k highest drift scores, name as tie-break."""
    return per_feature.orderBy(F.col("drift_score").desc(), F.col("feature")).limit(k)


def histograms(long: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """AGG23: equal-width histogram per (feature, side) over that side's own
    range, last bin right-closed; a constant side lands in the middle bin."""
    v = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    rng = v.groupBy("feature", "side").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = v.join(F.broadcast(rng), ["feature", "side"])   # one row per (feature, side)
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1))).cast("int")
    return j.groupBy("feature", "side", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def target_drift(df: DataFrame, side_col: str, target: str) -> DataFrame:
    """AGG24: contingency of target by side, with each cell's share of its side,
    expected count and chi-square contribution (their sum is the statistic)."""
    cells = df.groupBy(side_col, target).agg(F.count(F.lit(1)).alias("n"))
    side_tot = cells.groupBy(side_col).agg(F.sum("n").alias("n_side"))
    y_tot = cells.groupBy(target).agg(F.sum("n").alias("n_y"))
    all_tot = cells.agg(F.sum("n").alias("n_all"))
    # targets may have any number of values: that join is left to the runtime size check
    j = attach(cells.join(F.broadcast(side_tot), side_col).join(y_tot, target), all_tot)
    exp = F.col("n_side").cast("double") * F.col("n_y") / F.col("n_all")
    return j.select(side_col, target, "n", (F.col("n") / F.col("n_side")).alias("share"),
                    exp.alias("expected"), (F.pow(F.col("n") - exp, 2) / exp).alias("chi2_part"))


def alerts(summary: DataFrame, performance: DataFrame | None = None,
           auc_floor: float = AUC_FLOOR) -> DataFrame:
    """FN27 + FN25: (kind, message) rows.  Drift alert when overall drift is
    set; performance alert when AUC < floor (a missing AUC never alerts)."""
    drift = summary.where("overall_drift").select(
        F.lit("drift").alias("kind"),
        F.format_string(DRIFT_MESSAGE, F.col("drift_score"), F.col("drifted")).alias("message"))
    if performance is None:
        return drift
    perf = performance.where(F.col("auc").isNotNull() & (F.col("auc") < auc_floor)).select(
        F.lit("performance").alias("kind"),
        F.format_string(AUC_MESSAGE, F.col("auc")).alias("message"))
    return drift.unionByName(perf)
