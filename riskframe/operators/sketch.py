"""Mergeable column sketches: quantiles, distinct counts and drift.

One row per (group, feature) holds a KLL quantile sketch and an HLL distinct
sketch as binary columns.  Rows of files, days or micro-batches merge into one
without reading the values again, so medians, distinct counts and drift cover
everything seen so far at a cost that does not grow with it.  Sketches are built
by Spark's own aggregates, combined map-side: no value is shuffled or sorted.

Bounds (99 %): a rank, hence the rank of a median, is off by ``rank_error(k)``
at most; a distinct count by three times 1.04 / sqrt(2 ^ lg_k).  KLL draws
random bits, so two builds of one column may differ within the bound; up to
``k`` values are kept whole and are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.drift import P_SIGNIFICANT, kolmogorov_p

SKETCH_K = 4096          # quantile sketch: about 100 KB a feature
DISTINCT_LG_K = 12
DRIFT_POINTS = 512       # quantiles of each side by which the two sides are compared


def rank_error(k: int = SKETCH_K) -> float:
    """Bound of a rank's error that a KLL sketch of size ``k`` keeps in 99 %
    of cases (the sketch's published fit)."""
    return 2.296 / k ** 0.9723


def drift_error(k: int = SKETCH_K, points: int = DRIFT_POINTS) -> float:
    """Bound of the error of ``sketch_drift``'s statistic: a rank on each side
    and the share of rows between two quantiles, by which either side's CDF is
    taken too low at most."""
    return 2 * rank_error(k) + 1.0 / points


def column_sketches(long: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """(*by, feature, quantiles, distinct) of a (*by, feature, value) table;
    nulls and NaN are left out, and a feature without values has no row."""
    v = long.where(F.col("value").isNotNull() & ~F.isnan("value")) \
        .withColumn("value", F.col("value").cast("double") + F.lit(0.0))      # one zero
    return v.groupBy(*by, "feature").agg(F.kll_sketch_agg_double("value", k).alias("quantiles"),
                                         F.hll_sketch_agg(F.col("value").cast("string"), lg_k).alias("distinct"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (*by, feature) from any number of rows."""
    return sketches.groupBy(*by, "feature").agg(F.kll_merge_agg_double("quantiles").alias("quantiles"),
                                                F.hll_union_agg("distinct").alias("distinct"))


def sketch_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """AGG4 + AGG7 in approximate form: rows, distinct values and quantiles
    (values of the column) per row of ``sketches``."""
    rest = [c for c in sketches.columns if c not in ("quantiles", "distinct")]
    return sketches.select(*rest, F.kll_sketch_get_n_double("quantiles").alias("n"),
                           F.hll_sketch_estimate("distinct").alias("n_distinct"),
                           *[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q))).alias(f"q{round(100 * q)}")
                             for q in quantiles])


def sketch_drift(reference: DataFrame, current: DataFrame, points: int = DRIFT_POINTS) -> DataFrame:
    """AGG20 + AGG21 from sketches (feature, quantiles, distinct) of two sides:
    the largest gap of the two step functions through ``points`` quantiles each,
    within ``drift_error`` of the exact statistic.  Features that one side
    lacks, or that have one distinct value on a side, have no row."""
    def side(df, name):
        n = F.col("quantiles")
        return df.select("feature", F.kll_sketch_get_n_double(n).alias(f"n_{name}"),
                         F.kll_sketch_get_quantile_double(n, F.array(*[F.lit(i / points) for i in range(points + 1)]))
                         .alias(f"at_{name}"))
    j = side(reference, "ref").join(side(current, "cur"), "feature")
    # the sketch keeps both ends, so one distinct value shows as equal ends
    j = j.where((F.element_at("at_ref", 1) < F.element_at("at_ref", -1)) &
                (F.element_at("at_cur", 1) < F.element_at("at_cur", -1)))

    def share(at, v):           # quantiles at or below v, less the one of rank 0
        return F.greatest(F.size(F.filter(at, lambda q: q <= v)) - 1, F.lit(0)) / points
    gaps = F.transform(F.array_union("at_ref", "at_cur"), lambda v: F.abs(share("at_ref", v) - share("at_cur", v)))
    j = j.select("feature", "n_ref", "n_cur", F.array_max(gaps).alias("ks_statistic"))
    a, b = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    j = j.withColumn("p_value", kolmogorov_p(F.sqrt(a * b / (a + b)) * F.col("ks_statistic")))
    return j.select("feature", "n_ref", "n_cur", "ks_statistic", "p_value",
                    (F.lit(1.0) - F.col("p_value")).alias("drift_score"), (F.col("p_value") < P_SIGNIFICANT).alias("is_drift"))
