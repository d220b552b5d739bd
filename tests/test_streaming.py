"""Streaming semantics: closed daily windows, late rows behind the watermark."""

import datetime as dt
import os
import tempfile

import pandas as pd

from riskframe.streaming import jobs as J


def _write(folder, name, rows):
    pdf = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    pdf.to_parquet(os.path.join(folder, name), index=False)


def test_daily_windows_drop_late_rows(spark):
    src = tempfile.mkdtemp(prefix="rf-stream-src-")
    _write(src, "events.parquet", [
        (1, dt.datetime(2024, 1, 1, 10), 1, "click", 1.0, "{}"),
        (2, dt.datetime(2024, 1, 2, 10), 1, "click", 2.0, "{}"),
        (3, dt.datetime(2024, 1, 3, 10), 1, "click", 3.0, "{}"),
    ])
    d = J.run_dir(spark, "test_daily")
    out, chk = os.path.join(d, "out"), os.path.join(d, "chk")
    J.append_parquet(J.daily_moments(J.file_stream(spark, src, "events")), out, chk)
    first = spark.read.parquet(out).toPandas()
    assert sorted(first["window_start"].dt.day.tolist()) == [1, 2]          # Jan 3 still open
    _write(src, "events-2.parquet", [
        (4, dt.datetime(2024, 1, 1, 12), 1, "click", 100.0, "{}"),        # behind the watermark: dropped
        (5, dt.datetime(2024, 1, 5, 10), 1, "click", 5.0, "{}"),
    ])
    J.append_parquet(J.daily_moments(J.file_stream(spark, src, "events")), out, chk)
    allw = spark.read.parquet(out).toPandas().sort_values("window_start")
    assert allw["window_start"].dt.day.tolist() == [1, 2, 3]
    assert allw["n"].tolist() == [1, 1, 1] and allw["total"].tolist() == [1.0, 2.0, 3.0]


def test_closed_and_open_days_are_every_day_once(spark):
    for last in (dt.datetime(2024, 1, 3, 0, 30), dt.datetime(2024, 1, 3, 1), dt.datetime(2024, 1, 3, 5)):
        src = tempfile.mkdtemp(prefix="rf-stream-src-")
        _write(src, "events.parquet", [
            (1, dt.datetime(2024, 1, 1, 10), 1, "click", 1.0, "{}"),
            (2, dt.datetime(2024, 1, 2, 10), 1, "click", 2.0, "{}"),
            (3, last, 1, "click", 3.0, "{}")])
        d = J.run_dir(spark, "test_open")
        out = os.path.join(d, "out")
        J.append_parquet(J.daily_moments(J.file_stream(spark, src, "events")), out, os.path.join(d, "chk"))
        rest = J.open_days(spark.read.parquet(os.path.join(src, "events.parquet")))
        days = spark.read.parquet(out).unionByName(rest).toPandas()
        assert sorted(days["window_start"].dt.day.tolist()) == [1, 2, 3], last


def test_drift_batch_replay_is_idempotent(spark):
    import numpy as np
    from pyspark.sql import functions as F
    rng = np.random.RandomState(4)
    ref = spark.createDataFrame(pd.DataFrame({"feature": "v", "value": rng.randn(300)})).withColumn("side", F.lit("ref"))
    cur = spark.createDataFrame(pd.DataFrame({"feature": "v", "value": rng.randn(200) + 1.0}))
    out = os.path.join(J.run_dir(spark, "test_drift_replay"), "out")
    fn = J.drift_batch_writer(ref, out, "2024-02-01 00:00:00")
    fn(cur, 0)
    first = spark.read.parquet(out).count()
    fn(cur, 0)                                   # the same micro-batch replayed after a failure
    res = spark.read.parquet(out)
    assert res.count() == first
    row = res.where("record = 'feature'").first()
    assert row["is_drift"] is True and row["p_value"] < 0.05
    assert res.where("record = 'alert'").count() == 1
