"""Batch scoring (the request handler as a table job) and live performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import metrics as M
from riskframe.operators.common import attach


def scored_record(df: DataFrame, key: str, prob: str, threshold: float, model_version: str,
                  run_ts: Column, explanation: str | None = None) -> DataFrame:
    """ML16 / F5: (patient_id, readmission_risk, readmission_prediction,
    risk_level, timestamp, model_version, explanation).  The run time is a
    parameter so results are reproducible; a record without a key gets the
    time id FN23; ``explanation`` names the column with the row's ordered
    top-k (feature, contribution) array."""
    why = F.array() if explanation is None else F.col(explanation)
    return df.select(F.coalesce(F.col(key).cast("string"), fx.request_id(run_ts)).alias("patient_id"),
                     F.col(prob).alias("readmission_risk"),
                     (F.col(prob) >= F.lit(float(threshold))).alias("readmission_prediction"),
                     fx.risk_band(prob).alias("risk_level"),
                     fx.iso_time(run_ts).alias("timestamp"),
                     F.lit(model_version).alias("model_version"),
                     why.cast("array<struct<feature:string,contribution:double>>").alias("explanation"))


def live_performance(scored: DataFrame, label: str, prob: str, threshold: float = 0.5) -> DataFrame:
    """ML17 / AGG18: accuracy and class-1 precision / recall / F1 / support plus
    AUC on current data; any failure becomes a one-row error record."""
    cols = "accuracy double, precision double, recall double, f1 double, support bigint, auc double, error string"
    try:
        d = scored.select(F.col(label).alias("y"), F.col(prob).alias("p"),
                          (F.col(prob) >= F.lit(float(threshold))).cast("int").alias("yhat"))
        r = M.with_rates(M.confusion(d, "y", "yhat"))
        a = M.auc(d, "y", "p")
        out = attach(r, a).select("accuracy", "precision", "recall", F.col("f1_score").alias("f1"),
                                  (F.col("tp") + F.col("fn")).alias("support"), "auc",
                                  F.lit(None).cast("string").alias("error"))
        out.schema  # noqa: B018 -- resolve now so analysis errors are caught here
        return out
    except Exception as e:  # noqa: BLE001 -- the reference returns an error document
        spark = scored.sparkSession
        return spark.createDataFrame([(None, None, None, None, None, None, str(e))], cols)
