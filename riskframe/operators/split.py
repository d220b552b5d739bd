"""Reproducible stratified splits, folds and samples.

Row order inside a class is ``md5(key || seed)`` (ties by key): equal in Spark
and any SQL engine with md5 and stable under re-execution.  The first digits of
the hash are even slices that need no sampling: rows are counted per (class,
slice), which places every cut in one slice, and only that slice is ranked.
Labelling is then a comparison with the cut's hash -- the table itself is
neither shuffled nor checkpointed.  Folds need every rank; they are ranked
within (class, slice) in one shuffle and offset by the slice counts.
Per-class sizes are fixed by largest remainder on the small class-count table,
giving exact totals (60/20/20 at n=100).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42  # fixed value: the reference's random_state


def hash_order(key: str, seed: int = SEED):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


SLICE_DIGITS = 3   # 4,096 even slices per class


def _sliced(df: DataFrame, key: str, seed: int) -> DataFrame:
    h = hash_order(key, seed)
    return df.withColumn("__h", h).withColumn("__s", F.substring("__h", 1, SLICE_DIGITS))


def _slice_counts(x: DataFrame, label: str) -> DataFrame:
    """(label, slice, n, rows of the class in earlier slices)."""
    n = x.groupBy(F.col(label).alias("__c"), "__s").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__c").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    return n.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0)))


def stratified_rank(df: DataFrame, label: str, key: str, seed: int = SEED,
                    out: str = "srank") -> DataFrame:
    """WIN5: 1-based rank of each row within its class by md5 order."""
    x = _sliced(df, key, seed)
    local = F.row_number().over(Window.partitionBy(label, "__s").orderBy("__h", key))
    before = _slice_counts(x, label).select("__c", F.col("__s").alias("__t"), "__before")
    x = x.withColumn("__r", local)
    j = x.join(before, x[label].eqNullSafe(before["__c"]) & (x["__s"] == before["__t"]))
    return j.select(*df.columns, (F.col("__before") + F.col("__r")).alias(out))


def _cut_hashes(df: DataFrame, label: str, key: str, seed: int, cuts: DataFrame,
                names: Sequence[str]) -> DataFrame:
    """(label, one (hash, key) per name): the last row of each cut.  ``cuts``
    has the 1-based positions, one row per class; position 0 gives null."""
    x = _sliced(df.select(label, key), key, seed)
    places = cuts.select(F.col(label).alias("__cc"), F.explode(F.create_map(
        *[v for n in names for v in (F.lit(n), F.col(n))])).alias("__name", "__at"))
    sl = _slice_counts(x, label)
    hit = sl.join(F.broadcast(places), sl["__c"].eqNullSafe(places["__cc"])) \
        .where((F.col("__at") > F.col("__before")) & (F.col("__at") <= F.col("__before") + F.col("__n"))) \
        .select("__c", F.col("__s").alias("__t"), "__name", (F.col("__at") - F.col("__before")).alias("__want"))
    rows = x.join(F.broadcast(hit), x[label].eqNullSafe(hit["__c"]) & (x["__s"] == hit["__t"]))
    rank = F.row_number().over(Window.partitionBy("__c", "__t", "__name").orderBy("__h", key))
    last = rows.withColumn("__r", rank).where("__r = __want")
    return last.groupBy("__c").agg(*[
        F.max(F.when(F.col("__name") == n, F.struct(F.col("__h"), F.col(key).alias("__k")))).alias(f"__cut_{n}")
        for n in names])


def _label_by_cuts(df: DataFrame, label: str, key: str, seed: int, cuts: DataFrame, names: Sequence[str],
                   rest: str, out: str) -> DataFrame:
    """Rows up to the first cut get the first name, and so on; map-only."""
    c = F.broadcast(_cut_hashes(df, label, key, seed, cuts, names))    # one row per class
    me = F.struct(hash_order(key, seed).alias("__h"), F.col(key).alias("__k"))
    part = F.lit(rest)
    for n in reversed(names):
        part = F.when(F.coalesce(me <= F.col(f"__cut_{n}"), F.lit(False)), n).otherwise(part)
    j = df.join(c, df[label].eqNullSafe(c["__c"]), "left")
    return j.select(*df.columns, part.alias(out))


def _apportion(counts: DataFrame, label: str, n_col: str, pct: int, out: str) -> DataFrame:
    """Largest-remainder split of ceil(total * pct / 100) over classes, in
    exact decimal arithmetic (the products pass 2 ** 63 from 10 ** 10 rows)."""
    big = lambda c: F.col(c).cast("decimal(19,0)")
    w_all = Window.partitionBy(F.lit(1))
    c = counts.withColumn("__tot", F.sum(n_col).over(w_all).cast("bigint"))
    c = c.withColumn("__k", F.expr(f"(__tot div 100) * {pct} + cast(ceil((__tot % 100) * {pct} / 100) as bigint)"))
    c = c.withColumn("__p", (big("__k") * big(n_col)).cast("decimal(38,0)"))
    c = c.withColumn("__q", F.expr("cast(__p div cast(__tot as decimal(19,0)) as bigint)"))
    c = c.withColumn("__rem", (F.col("__p") - big("__q") * big("__tot")).cast("decimal(38,0)"))
    c = c.withColumn("__left", F.col("__k") - F.sum("__q").over(w_all))
    c = c.withColumn("__ord", F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy(F.col("__rem").desc(), F.col(label))))
    c = c.withColumn(out, F.col("__q") + (F.col("__ord") <= F.col("__left")).cast("bigint"))
    return c.drop("__tot", "__k", "__p", "__q", "__rem", "__left", "__ord")


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))


def stratified_split(df: DataFrame, label: str, key: str, test_pct: int = 20,
                     val_pct: int = 25, seed: int = SEED, out: str = "split") -> DataFrame:
    """SMP3: train / val / test.  ``test_pct`` of all rows go to test, then
    ``val_pct`` of the rest to val, both stratified by ``label`` (80/20 then
    75/25 = 60/20/20).  The class table has one row per class; its windows are
    over that tiny table only."""
    cuts = _apportion(_class_counts(df, label), label, "n_c", test_pct, "test")
    cuts = cuts.withColumn("n_tv", F.col("n_c") - F.col("test"))
    cuts = _apportion(cuts, label, "n_tv", val_pct, "n_val")
    cuts = cuts.select(label, "test", (F.col("test") + F.col("n_val")).alias("val"))
    return _label_by_cuts(df, label, key, seed, cuts, ["test", "val"], "train", out)


def two_way_split(df: DataFrame, label: str, key: str, hold_pct: int = 20, seed: int = SEED,
                  out: str = "part", names=("fit", "holdout")) -> DataFrame:
    """SMP4: stratified two-way split (holdout share ``hold_pct``)."""
    cuts = _apportion(_class_counts(df, label), label, "n_c", hold_pct, "n_hold")
    cuts = cuts.select(label, F.col("n_hold").alias(names[1]))
    return _label_by_cuts(df, label, key, seed, cuts, [names[1]], names[0], out)


def kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = SEED,
          out: str = "fold") -> DataFrame:
    """SMP5: stratified fold ids 0..k-1 (class rank mod k); usable as
    ``CrossValidator(foldCol=...)``."""
    ranked = stratified_rank(df, label, key, seed)
    return ranked.withColumn(out, ((F.col("srank") - 1) % k).cast("int")).drop("srank")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """SMP1/SMP2: exactly ``min(n, rows)`` rows, reproducible: smallest md5
    order.  Planned as a per-partition top-n plus merge (TakeOrderedAndProject),
    so only n rows per task move."""
    h = "__h"
    return (df.withColumn(h, hash_order(key, seed)).orderBy(h, key).limit(n).drop(h))
