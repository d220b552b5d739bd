"""Mixing sources to target weights by Poisson replication.

A document of a source with mean repetition rate r is repeated k times, k the
Poisson(r) quantile of a uniform number hashed from its id, so any part of the
corpus can be drawn anew, alone, with the same result.  A row without an id is
drawn by its content and its number among the rows of that content.  Expected documents per
source are exactly the target shares.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest table of rates that is broadcast (rows); larger ones are joined.
BROADCAST_SOURCES = 20_000
#: Without given weights a source weighs (its documents) ** SMOOTHING.
SMOOTHING = 0.5


#: Rows of one content without an id that are numbered by one task.
NUMBERED_AT_ONCE = 1000


def keyed(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with ``__key``, the text that a row is drawn by: its id, or
    ``null|content digest|number``.  Rows without an id are counted per
    content before they are numbered, so a content that many of them share is
    one group with a count, and its numbers are dealt to many tasks."""
    with_id = docs.where(docs[id_col].isNotNull()).withColumn("__key", F.col(id_col).cast("string"))
    content = F.md5(F.concat_ws("|", *[F.coalesce(docs[c].cast("string"), F.lit("")) for c in docs.columns]))
    same = docs.where(docs[id_col].isNull()).select(content.alias("__digest"), F.struct(*docs.columns).alias("__row")) \
        .groupBy("__digest").agg(F.first("__row").alias("__row"), F.count("*").alias("__n"))
    dealt = same.withColumn("__from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"),
                                                           F.lit(NUMBERED_AT_ONCE).cast("bigint")))) \
        .repartition("__digest", "__from")
    last = F.least(F.col("__n"), F.col("__from") + NUMBERED_AT_ONCE - 1)
    numbered = dealt.withColumn("__number", F.explode(F.sequence(F.col("__from"), last)))
    key = F.concat_ws("|", F.lit("null"), F.col("__digest"), F.col("__number").cast("string"))
    without = numbered.select(*[F.col("__row")[c].alias(c) for c in docs.columns], key.alias("__key"))
    return with_id.unionByName(without)


def uniform(seed: int, key):
    """Uniform number in [0, 1) from the first 52 bits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), key)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2 ** 52))


def poisson_cdf(rate):
    """P(X <= 0), P(X <= 1), ... far into the tail, as an array column."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    step = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct((-rate).alias("logp"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["logp"] + F.log(rate) - F.log(k.cast("double"))).alias("logp"),
            (acc["sum"] + F.exp(acc["logp"] + F.log(rate) - F.log(k.cast("double")))).alias("sum"),
            F.concat(acc["cdf"], F.array(
                acc["sum"] + F.exp(acc["logp"] + F.log(rate) - F.log(k.cast("double"))))).alias("cdf")),
        lambda acc: acc["cdf"])
    return F.when(rate > 0, step).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, source_col: str = "source", weights: DataFrame | None = None,
                 total: int | None = None, smoothing: float = SMOOTHING) -> DataFrame:
    """(source, n, rate, cdf): rate = share of the weight * total / n.

    ``weights`` is a table (source, weight); a source without a weight gets
    none of the mix.  ``total`` defaults to the number of documents.
    """
    n = docs.groupBy(docs[source_col].alias("__source")).agg(F.count("*").alias("n"))
    if weights is None:
        w = n.withColumn("weight", F.pow("n", F.lit(float(smoothing))))
    else:
        given = weights.groupBy(weights[weights.columns[0]].alias("__given")) \
            .agg(F.sum(weights[weights.columns[1]].cast("double")).alias("weight"))
        w = n.join(given, n["__source"].eqNullSafe(given["__given"]), "left") \
            .select("__source", "n", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"))
    sums = w.agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).first()
    goal = float((sums["n"] or 0) if total is None else total)
    rate = F.col("weight") * (goal / sums["weight"]) / F.col("n") if sums["weight"] else F.lit(0.0)
    return w.select("__source", rate.alias("__rate")).withColumn("__cdf", poisson_cdf(F.col("__rate")))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None,
                source_col: str = "source", id_col: str = "doc_id", seed: int = 1, copy_col: str = "copy",
                key_col: str = "shuffle_key", smoothing: float = SMOOTHING) -> DataFrame:
    """Every row of ``docs`` repeated by its Poisson count, with its number
    ``copy`` (from 1) and ``shuffle_key``, in a globally shuffled order: rows
    are dealt to partitions by the hashed key and sorted by it there.

    A null source is a source.  Rows with one id get equal counts each; rows
    without an id are drawn one by one (``keyed``), equal ones too.  Texts are
    not looked at.  Columns of ``docs`` named like the two new ones are
    replaced.
    """
    rates = source_rates(docs, source_col, weights, total, smoothing)
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    columns = [c for c in docs.columns if c not in (copy_col, key_col)]
    rows = keyed(docs.select(*[docs[c] for c in columns]), id_col)
    got = rows.join(rates, rows[source_col].eqNullSafe(rates["__source"]))
    times = F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))
    # the draw is a column of its own, so it is hashed once
    got = got.select(*columns, "__key", "__cdf", uniform(seed, F.col("__key")).alias("__u")) \
        .withColumn("__times", times).where("__times > 0")
    got = got.select(*columns, "__key", F.explode(F.sequence(F.lit(1), F.col("__times"))).alias(copy_col))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("shuffle"), F.col("__key"), F.col(copy_col).cast("string")))
    return got.withColumn(key_col, key).drop("__key").repartition(F.col(key_col)).sortWithinPartitions(key_col)
