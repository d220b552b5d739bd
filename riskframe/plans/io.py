"""Queries: file sources and sinks round trips over the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import drift as D
from riskframe.operators import split
from riskframe.plans.base import E_COLUMNS, R, r6, sql_e, sql_clean_select
from riskframe.plans.drift import _KS_CTES, _SUM, FEATURES, per_feature
from riskframe.plans.metrics import _EVAL_COLS as EVAL_COLS
from riskframe.plans.split import _SPLIT_BODY, _SPLIT_CTES
from riskframe.session import scratch_path
from riskframe.sources import files
from riskframe.sources.encounters import encounters


def _tmp(spark, name):
    return scratch_path(spark, os.path.join("io", name, uuid.uuid4().hex))


@R.add("csv_roundtrip", ["SRC1", "SRC2"], sql_e(f"select {sql_clean_select(exclude=())} from E"))
def csv_roundtrip(spark, sf_dir):
    e = encounters(spark, sf_dir)
    path = _tmp(spark, "csv")
    files.write_csv(e, path, sentinel=None)                 # raw file keeps the '?' markers
    return files.read_csv(spark, path, schema=e.schema).select(*E_COLUMNS)


@R.add("split_table_scan", ["SNK1", "SNK2", "SRC3", "SRC5"], sql_e(
    "select s.encounter_id, s.label, E.total_charge from (" + _SPLIT_BODY + ") s "
    "join E on E.encounter_id = s.encounter_id where s.split = 'train'",
    ctes=["L as (select *, case when readmitted = '<30' then 1 else 0 end as label from E)",
          "K as (select encounter_id, label, row_number() over (partition by label order by "
          "md5(cast(encounter_id as varchar) || '42'), encounter_id) as srank from L)"] + _SPLIT_CTES[2:]))
def split_table_scan(spark, sf_dir):
    e = encounters(spark, sf_dir).withColumn("label", fx.label_from("readmitted"))
    s = split.stratified_split(e, "label", "encounter_id").select("encounter_id", "label", "total_charge", "split")
    path = _tmp(spark, "splits")
    files.write_splits(s, path)
    return files.require_rows(files.read_split(spark, path, "train"), "train split").drop("split")


@R.add("drift_results_log", ["SNK8", "FN24", "FN26"], sql_e(
    f"select cast(drifted as bigint) as drifted, cast({len(FEATURES)} as bigint) as features, "
    f"round(score_sum / {len(FEATURES)}, 6) as drift_score, round(drifted * 100.0 / {len(FEATURES)}, 6) as drift_percentage, "
    f"drifted > {len(FEATURES)} * 0.1 as overall_drift, '2024-02-01T00:00:00' as stamp, cast(drifted as bigint) as doc_drifted, "
    f"round(score_sum / {len(FEATURES)}, 6) as doc_score, '2024-02-01' as doc_day from SM", _KS_CTES + [_SUM]))
def drift_results_log(spark, sf_dir):
    """The appended result row, with fields of its JSON document read back."""
    pf, n = per_feature(spark, sf_dir)
    run_ts = F.lit("2024-02-01 00:00:00").cast("timestamp")
    summary = D.drift_summary(pf, n, run_ts)
    path = _tmp(spark, "drift_results")
    files.append_results(summary.withColumn("doc", F.to_json(F.struct(*summary.columns)))
                         .withColumn("stamp", fx.iso_time("run_ts")), path)
    doc = F.from_json("doc", "drifted bigint, drift_score double, run_ts string")
    return spark.read.parquet(path).select(
        "drifted", "features", r6("drift_score").alias("drift_score"), r6("drift_percentage").alias("drift_percentage"),
        "overall_drift", "stamp", doc["drifted"].alias("doc_drifted"), r6(doc["drift_score"]).alias("doc_score"),
        F.substring(doc["run_ts"], 1, 10).alias("doc_day"))


@R.add("metrics_json", ["SNK5", "FN26"], R.sql["evaluation"])
def metrics_json(spark, sf_dir):
    from riskframe.operators import metrics as M
    from riskframe.sources.encounters import scored
    ev = M.evaluation(scored(spark, sf_dir), "label", "score", 0.5)
    path = _tmp(spark, "evaluation_json")
    files.write_json_doc(ev, path)
    return spark.read.json(path).select(*[r6(c).alias(c) for c in EVAL_COLS], "tn", "fp", "fn", "tp")
