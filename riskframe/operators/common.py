"""Small shared plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_K = "__one_row_key"


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate (totals) to every row of
    ``df``.  The right side is one row by construction (a global aggregate), so
    nothing is multiplied and nothing big is broadcast; the optimizer folds the
    constant key and plans a nested-loop join with that one-row build side
    (linear in ``df``).  Used between small tables; large tables take fitted
    parameters as literals instead."""
    left = df.withColumn(_K, F.lit(1))
    right = F.broadcast(one_row.withColumn(_K, F.lit(1)))
    return left.join(right, _K, "inner").drop(_K)


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows
    (a limit+count job that reads at most max_rows+1 rows); otherwise return
    it unchanged so the planner keeps a shuffle join."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def ensure_parallel(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that arrives in too few splits (one large row group, a
    handful of files) over the cluster before CPU-heavy per-row work.  On a
    big input with many splits this is a no-op: no shuffle is added."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
