"""Queries: streaming jobs run to completion with availableNow, read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import explain as X
from riskframe.plans.base import R, r6, sql_e
from riskframe.plans.drift import _KS_CTES, _SUM
from riskframe.plans.explain import LIN, _LC, _LW
from riskframe.session import materialize
from riskframe.sources.encounters import encounter_features, encounters
from riskframe.sources.tables import table
from riskframe.streaming import jobs as J


_DAILY = ("select window_start, window_end, event_type, n, round(total, 6) as total, round(mean, 6) as mean, "
          "round(min_value, 6) as min_value, round(max_value, 6) as max_value, round(std, 6) as std from "
          "(select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end, event_type, "
          "count(*) as n, sum(value) as total, avg(value) as mean, min(value) as min_value, max(value) as max_value, "
          "stddev_pop(value) as std from events group by 1, 2, 3) w")


def _rounded(moments):
    return moments.select("window_start", "window_end", "event_type", "n",
                          *[r6(c).alias(c) for c in ("total", "mean", "min_value", "max_value", "std")])


def _closed_days(spark, sf_dir):
    d = J.run_dir(spark, "daily_moments")
    agg = J.daily_moments(J.file_stream(spark, sf_dir, "events"))
    J.append_parquet(agg, os.path.join(d, "out"), os.path.join(d, "chk"))
    return spark.read.parquet(os.path.join(d, "out"))


@R.add("stream_daily_moments", ["STR1", "STR3"], sql_e(
    _DAILY + " where window_end <= (select max(ts) from events) - interval 1 hour", views=()))
def stream_daily_moments(spark, sf_dir):
    return _rounded(_closed_days(spark, sf_dir))


@R.add("stream_daily_flushed", ["STR3"], sql_e(_DAILY, views=()))
def stream_daily_flushed(spark, sf_dir):
    """The closed days of the stream and, as the source has ended, the open ones."""
    return _rounded(_closed_days(spark, sf_dir).unionByName(J.open_days(table(spark, sf_dir, "events"))))


def _linear_params(spark, sf_dir):
    e = encounters(spark, sf_dir).withColumn("label", fx.label_from("readmitted"))
    return X.linear_weights(e, LIN, "label")


@R.add("stream_scores", ["STR2", "SNK9", "ML16"], sql_e(
    "select encounter_id, round(score, 6) as score, score >= 0.5 as prediction, "
    "case when score < 0.3 then 'Low' when score < 0.7 then 'Medium' else 'High' end as risk_level from "
    "(select encounter_id, any_value(base) + sum(contribution) as score from LC, LW group by encounter_id) s",
    ctes=[_LW, _LC]))
def stream_scores(spark, sf_dir):
    params = materialize(_linear_params(spark, sf_dir), "linear_params")   # one row, fitted in batch
    d = J.run_dir(spark, "scores")
    feats = encounter_features(spark, sf_dir, J.file_stream(spark, sf_dir, "orders"))
    scored = X.linear_contributions(feats, params, LIN, "encounter_id")
    log = scored.select("encounter_id", r6("score").alias("score"), (F.col("score") >= 0.5).alias("prediction"),
                        fx.risk_band("score").alias("risk_level"))
    J.append_parquet(log, os.path.join(d, "log"), os.path.join(d, "chk"))
    return spark.read.parquet(os.path.join(d, "log"))


_REQ = ("R as (select encounter_id, cast(regexp_extract(age, '(\\d+)', 1) as int) + 5 as age, gender, "
        "time_in_hospital - 1 as time_in_hospital, num_medications, num_procedures, number_diagnoses as num_diagnoses, "
        "case when num_medications = 0 then null else total_charge / 1000 end as glucose_level, "
        "insulin <> 'No' as insulin from E)")


@R.add("stream_validation", ["STR5", "FLT1"], sql_e(
    "select encounter_id, route, n_violations from (select encounter_id, "
    "cast((glucose_level is null)::int + (age < 0 or age > 120)::int + (time_in_hospital < 0)::int"
    " + (num_medications < 0)::int + (num_procedures < 0)::int + (num_diagnoses < 0)::int"
    " + (gender not in ('Male', 'Female', 'Other'))::int as int) as n_violations from R) v, "
    "lateral (select case when n_violations = 0 then 'valid' else 'quarantine' end as route) r", ctes=[_REQ]))
def stream_validation(spark, sf_dir):
    d = J.run_dir(spark, "validation")
    feats = encounter_features(spark, sf_dir, J.file_stream(spark, sf_dir, "orders"))
    req = feats.select(
        "encounter_id", fx.interval_midpoint("age").alias("age"), "gender",
        (F.col("time_in_hospital") - 1).alias("time_in_hospital"), "num_medications", "num_procedures",
        F.col("number_diagnoses").alias("num_diagnoses"),
        F.when(F.col("num_medications") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("total_charge") / 1000).alias("glucose_level"),
        (F.col("insulin") != "No").alias("insulin"))
    J.run_available(req.writeStream.foreachBatch(J.validation_batch_writer(os.path.join(d, "out"))),
                    os.path.join(d, "chk"))
    out = spark.read.parquet(os.path.join(d, "out"))
    return out.select("encounter_id", "route", "n_violations")


_EV_LG = ("LG as (select case when ts < timestamp '2024-01-16 00:00:00' then 'ref' else 'cur' end as side, "
          "event_type as feature, cast(value as double) as value from events)")
_EV_SM = ("RS as (select SM.*, n, score_sum / n as score, drifted > n * 0.1 as overall from SM, "
          "(select count(distinct feature) as n from LG where side = 'ref') f)")


@R.add("stream_drift", ["STR4", "FN27", "SNK8"], sql_e(
    "select 'feature' as record, feature, round(ks_statistic, 6) as ks_statistic, round(p_value, 6) as p_value, "
    "round(1.0 - p_value, 6) as drift_score, p_value < 0.05 as is_drift, cast(null as varchar) as message from KS union all "
    "select 'summary', null, null, null, round(score, 6), overall, null from RS union all "
    "select 'alert', null, null, null, null, null, format('DATA DRIFT ALERT: Significant data drift detected with score {:.4f}. "
    "{:d} features have drifted.', score, drifted) from RS where overall",
    [_EV_LG, *_KS_CTES[1:], _SUM, _EV_SM], views=()))
def stream_drift(spark, sf_dir):
    """One micro-batch per arrival: the twin holds for a table that arrives at once."""
    ev = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ref = (ev.where(F.col("ts") < cut)
             .select(F.col("event_type").alias("feature"), F.col("value").cast("double").alias("value"))
             .withColumn("side", F.lit("ref")))
    d = J.run_dir(spark, "drift")
    cur = (J.file_stream(spark, sf_dir, "events").where(F.col("ts") >= cut)
             .select(F.col("event_type").alias("feature"), F.col("value").cast("double").alias("value")))
    J.run_available(cur.writeStream.foreachBatch(
        J.drift_batch_writer(ref, os.path.join(d, "out"), "2024-02-01 00:00:00")), os.path.join(d, "chk"))
    return spark.read.parquet(os.path.join(d, "out")).select(
        "record", "feature", *[r6(c).alias(c) for c in ("ks_statistic", "p_value", "drift_score")], "is_drift", "message")


FILES_PER_BATCH = 8


@R.add("stream_drift_running", ["STR4", "AGG20", "AGG21"])
def stream_drift_running(spark, sf_dir):
    """Drift of all events after the cut, day files arriving in several
    micro-batches, from merged sketches; the state after the last one."""
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feature"), F.col("value").cast("double").alias("value"), "ts")
    d = J.run_dir(spark, "drift_running")
    days, out = os.path.join(d, "in"), os.path.join(d, "out")
    cur = ev.where(F.col("ts") >= cut).select("feature", "value", F.to_date("ts").alias("day"))
    cur.write.partitionBy("day").parquet(days)
    arriving = spark.readStream.schema(cur.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(days)
    J.run_available(arriving.writeStream.foreachBatch(J.running_drift_writer(ev.where(F.col("ts") < cut), out)),
                    os.path.join(d, "chk"))
    res = spark.read.parquet(os.path.join(out, "drift"))
    last = res.agg(F.max("batch_id").alias("batch_id"))
    return res.join(F.broadcast(last), "batch_id").select(          # one row
        "feature", "n_ref", "n_cur", r6("ks_statistic").alias("ks_statistic"), r6("p_value").alias("p_value"), "is_drift")
