"""Skew-safe running sums over an ordered key.

A running sum written as ``sum(x) over (partition by g order by v)`` puts every
row of a group into one task; with one feature or one class holding a third of
all rows that task never finishes at scale.  Here the rows are instead
range-partitioned on ``(g, v)`` -- Spark samples the key and cuts balanced
slices, splitting a hot group over many tasks -- then:

1. a local running sum per (slice, group) is computed in parallel,
2. slice totals per group (at most ``slices + groups`` rows) give each slice
   its offset with a tiny window,
3. offsets are broadcast back and added.

The sliced table feeds two branches (local sums, slice totals).  Range bounds
come from sampling, and a recomputed branch may sample differently, so the
sliced table is written once with a reliable ``checkpoint()`` into the shared
checkpoint folder; both branches then read the same slice ids, and a lost
executor only costs re-reading that table.

Equal keys land in the same slice, so callers pre-aggregate to one row per
``(g, v)``: then "inclusive" means every row with a key at or before this one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.common import attach
from riskframe.session import cut_lineage

_PID = "__slice"


def _slices(df: DataFrame, slices: int | None) -> int:
    if slices:
        return int(slices)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                sum_cols: Sequence[str], descending: bool = False, prefix: str = "cum_",
                slices: int | None = None, bounded_groups: bool = True,
                totals: bool = False) -> DataFrame:
    """Add ``{prefix}{c}`` = sum of ``c`` over rows of the same group ordered at or
    before this row (by ``order_cols``, ascending unless ``descending``).

    ``(group_cols, order_cols)`` must be unique per row.  ``bounded_groups``
    says the number of groups is small (features, classes, subgroups), which
    bounds the offset table by ``slices + groups`` rows and lets it broadcast;
    otherwise the join is left to AQE's runtime size check.  ``totals`` also
    adds ``tot_{c}``, the group total, taken from the small slice-totals table
    (so callers need not recompute the input for it).
    """
    group_cols, order_cols, sum_cols = list(group_cols), list(order_cols), list(sum_cols)
    okeys = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    n = _slices(df, slices)
    x = (df.repartitionByRange(n, *[F.col(g) for g in group_cols], *okeys)
           .withColumn(_PID, F.spark_partition_id()))
    x = cut_lineage(x)
    w_local = (Window.partitionBy(_PID, *group_cols).orderBy(*okeys)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = x.select("*", *[F.sum(c).over(w_local).alias(f"__loc_{c}") for c in sum_cols])
    slice_tot = x.groupBy(_PID, *group_cols).agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    w_off = (Window.partitionBy(*group_cols).orderBy(_PID)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = slice_tot.select(_PID, *group_cols,
                            *[F.coalesce(F.sum(f"__tot_{c}").over(w_off), F.lit(0))
                              .alias(f"__off_{c}") for c in sum_cols])
    extra = []
    if totals:
        gsum = [F.sum(f"__tot_{c}").alias(f"tot_{c}") for c in sum_cols]
        gt = slice_tot.groupBy(*group_cols).agg(*gsum) if group_cols else slice_tot.agg(*gsum)
        offsets = offsets.join(gt, group_cols, "inner") if group_cols else attach(offsets, gt)
        extra = [F.col(f"tot_{c}") for c in sum_cols]
    if bounded_groups:
        offsets = F.broadcast(offsets)
    out = local.join(offsets, [_PID, *group_cols], "inner")
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"__loc_{c}") + F.col(f"__off_{c}")).alias(f"{prefix}{c}") for c in sum_cols], *extra)


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                out: str = "rank", slices: int | None = None,
                bounded_groups: bool = True) -> DataFrame:
    """1-based position of each row in its group under ``order_cols`` (unique keys);
    the skew-safe form of ``row_number() over (partition by g order by ...)``."""
    one = "__one"
    r = running_sum(df.withColumn(one, F.lit(1).cast("bigint")), group_cols, order_cols,
                    [one], prefix="__cum", slices=slices, bounded_groups=bounded_groups)
    return r.withColumnRenamed(f"__cum{one}", out).drop(one)


HOT_GROUP_ROWS = 1_000_000   # a group above this is spread over slices


def lead_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                value_col: str, out: str, slices: int | None = None,
                hot_rows: int | None = HOT_GROUP_ROWS) -> DataFrame:
    """Skew-safe ``lead(value) over (partition by g order by o)`` for unique
    ``(g, o)``: range slices on (g, o); a local lead inside each (slice, group);
    the last row of a group in a slice takes the value of that group's first row
    in the next slice holding it.  That boundary table has one row per (slice,
    group), so even a group spread over every slice has at most ``slices`` rows
    in its window.

    With ``hot_rows`` set, one grouped count over the group keys (map-side
    combined, one number returned) measures the largest group first; when no
    group exceeds ``hot_rows`` the plain window is used, since no task can
    then receive more than that many rows."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    okeys = [F.col(c).asc() for c in order_cols]
    if hot_rows is not None:
        biggest = (df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"))
                     .agg(F.max("__n").alias("m")).first()["m"]) or 0
        if biggest <= hot_rows:
            w = Window.partitionBy(*group_cols).orderBy(*okeys)
            return df.withColumn(out, F.lead(F.col(value_col)).over(w))
    n = _slices(df, slices)
    x = (df.repartitionByRange(n, *[F.col(g) for g in group_cols], *okeys)
           .withColumn(_PID, F.spark_partition_id()))
    x = cut_lineage(x)
    w = Window.partitionBy(_PID, *group_cols).orderBy(*okeys)
    local = x.select("*", F.lead(F.col(value_col)).over(w).alias("__lead"),
                     F.lead(F.lit(1)).over(w).isNull().alias("__last"))
    firsts = x.groupBy(_PID, *group_cols).agg(
        F.min(F.struct(*[F.col(c) for c in order_cols], F.col(value_col).alias("__v"))).alias("__f"))
    nxt = firsts.select(_PID, *group_cols, F.lead(F.col("__f.__v")).over(
        Window.partitionBy(*group_cols).orderBy(_PID)).alias("__next"))
    j = local.join(nxt, [_PID, *group_cols], "left")
    return j.select(*df.columns, F.when(F.col("__last"), F.col("__next")).otherwise(F.col("__lead")).alias(out))
