"""Structured Streaming versions of the reference's time-driven work.

* STR1 -- react to new files: a file source over the table folder, run with
  ``trigger(availableNow=True)`` (process what has arrived, then stop).
* STR2 -- score records as they arrive: stateless stream-static joins + the
  fitted scorer, appended to a Parquet prediction log (SNK9).
* STR3 -- daily cadence: tumbling one-day windows with a watermark; append
  mode emits a window once the watermark passes its end, rows later than the
  watermark are dropped.
* STR4 -- drift + alerts per micro-batch against a fixed reference, written by
  ``foreachBatch`` keyed by batch id (a replayed batch overwrites itself); or
  over all batches so far, from mergeable sketches.
* STR5 -- validation with quarantine: ``foreachBatch`` routes each batch to a
  valid and a quarantine sink.

Every sink and checkpoint lives under the shared folder named by
``spark.checkpoint.dir``, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.operators import drift as D
from riskframe.operators import sketch as SK
from riskframe.session import materialize, scratch_path
from riskframe.sources.tables import table

DAY_WINDOW = "1 day"
WATERMARK = "1 hour"


def run_dir(spark: SparkSession, name: str, run_id: str | None = None) -> str:
    """Sink + checkpoint folder for one stream run under the shared folder."""
    return scratch_path(spark, os.path.join("streams", name, run_id or uuid.uuid4().hex))


def file_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """STR1: a streaming read of ``<folder>/<name>.parquet`` and every
    ``<name>*.parquet`` that arrives later, with the table's schema fixed up
    front from the first file."""
    schema = table(spark, folder, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def run_available(writer, checkpoint: str):
    """Start with ``availableNow`` and block until everything that has arrived
    is processed (the sensor-with-timeout of a scheduler, without polling)."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def daily_moments(events: DataFrame, ts: str = "ts", by: str = "event_type",
                  value: str = "value", delay: str = WATERMARK) -> DataFrame:
    """STR3: per one-day window and group: count, sum, mean, min, max, population
    std of ``value``.  The event time is read as UTC."""
    e = events.withColumn("__t", F.col(ts).cast("timestamp"))
    agg = (e.withWatermark("__t", delay)
            .groupBy(F.window("__t", DAY_WINDOW).alias("w"), F.col(by))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"),
                 F.min(value).alias("min_value"), F.max(value).alias("max_value"),
                 F.stddev_pop(value).alias("std")))
    return agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), by,
                      "n", "total", "mean", "min_value", "max_value", "std")


def open_days(events: DataFrame, ts: str = "ts", by: str = "event_type", value: str = "value",
              delay: str = WATERMARK) -> DataFrame:
    """Closing flush of ``daily_moments`` for a source that has ended: the
    windows that the watermark has not passed, as a batch over their rows only
    (the bound is one number, so it reaches the scan as a filter)."""
    last = events.agg(F.max(F.col(ts).cast("timestamp")).alias("m")) \
        .select(F.date_trunc("day", F.col("m") - F.expr(f"interval {delay}")).cast("string").alias("d")).first()["d"]
    if last is None:
        return daily_moments(events, ts, by, value, delay)
    # a window that ends exactly at the watermark is closed: it starts a day before this one
    return daily_moments(events.where(F.col(ts).cast("timestamp_ntz") >= F.lit(last).cast("timestamp_ntz")), ts, by, value, delay)


def append_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    return run_available(df.writeStream.format("parquet").outputMode(mode).option("path", path), checkpoint)


def drift_batch_writer(reference_long: DataFrame, out: str, run_ts: str):
    """STR4: a foreachBatch function computing KS drift of the batch against
    the fixed reference, the summary and alerts; results are written under
    ``batch_id=<n>`` with overwrite, so a replayed batch does not duplicate.

    The reference is counted once, when the writer is made; a micro-batch reads
    its value counts, not its rows."""
    ref = materialize(D.value_counts_by_side(reference_long), "drift_reference")
    feats = reference_long.select("feature").distinct().count()   # bounded: feature names

    def fn(batch: DataFrame, batch_id: int):
        cur = D.value_counts_by_side(batch.select("feature", "value").withColumn("side", F.lit("cur")))
        counts = ref.unionByName(cur).groupBy("feature", "value").agg(
            F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
        per = D.ks_of_counts(counts)
        summary = D.drift_summary(per, feats, F.lit(run_ts).cast("timestamp"))
        res = (per.select(F.lit("feature").alias("record"), "feature", "ks_statistic", "p_value",
                          "drift_score", "is_drift", F.lit(None).cast("string").alias("message"))
               .unionByName(summary.select(F.lit("summary").alias("record"),
                                           F.lit(None).cast("string").alias("feature"),
                                           F.lit(None).cast("double").alias("ks_statistic"),
                                           F.lit(None).cast("double").alias("p_value"), "drift_score",
                                           F.col("overall_drift").alias("is_drift"),
                                           F.lit(None).cast("string").alias("message")))
               .unionByName(D.alerts(summary).select(F.lit("alert").alias("record"),
                                                     F.lit(None).cast("string").alias("feature"),
                                                     F.lit(None).cast("double").alias("ks_statistic"),
                                                     F.lit(None).cast("double").alias("p_value"),
                                                     F.lit(None).cast("double").alias("drift_score"),
                                                     F.lit(None).cast("boolean").alias("is_drift"),
                                                     "message")))
        res.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
    return fn


def _written(spark, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def running_drift_writer(reference_long: DataFrame, out: str):
    """STR4 over the stream so far: a foreachBatch function that merges the
    sketches of the batch with those of all batches before it and compares
    the whole with the reference.

    ``state/batch_id=<n>`` holds the merged sketches up to batch n, so a batch
    costs its own rows and one row per feature; a replayed batch finds its
    state written, leaves it and writes the same result again."""
    ref = materialize(SK.merge_sketches(SK.column_sketches(reference_long)), "drift_reference")

    def fn(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession

        def state(n):
            return os.path.join(out, "state", f"batch_id={n}")
        if not _written(spark, state(batch_id)):
            both = SK.column_sketches(batch.select("feature", "value"))
            if batch_id > 0:
                both = both.unionByName(spark.read.parquet(state(batch_id - 1)))
            SK.merge_sketches(both).write.mode("overwrite").parquet(state(batch_id))
        drift = SK.sketch_drift(ref, spark.read.parquet(state(batch_id)))
        drift.write.mode("overwrite").parquet(os.path.join(out, "drift", f"batch_id={batch_id}"))
    return fn


def validation_batch_writer(out: str):
    """STR5: route each micro-batch to ``valid`` and ``quarantine`` sinks
    (quarantined rows keep their violation list); keyed by batch id."""
    def fn(batch: DataFrame, batch_id: int):
        v = clean.violations(batch)
        v = v.withColumn("route", F.when(F.col("n_violations") == 0, "valid").otherwise("quarantine"))
        v.write.mode("overwrite").partitionBy("route").parquet(os.path.join(out, f"batch_id={batch_id}"))
    return fn
