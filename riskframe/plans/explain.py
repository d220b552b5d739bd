"""Queries: explanations (linear with SQL twins, trees rows-only) and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import explain as X
from riskframe.operators import model as ML
from riskframe.operators import score as SC
from riskframe.plans.base import R, r6, sql_e
from riskframe.plans.model import fitted, tuned
from riskframe.session import scratch_path
from riskframe.sources.encounters import drift_side, encounters, scored

LIN = ["time_in_hospital", "num_medications", "num_procedures", "num_lab_procedures", "number_diagnoses",
       "number_outpatient", "number_emergency", "number_inpatient", "total_charge"]


def linear(spark, sf_dir):
    e = encounters(spark, sf_dir).withColumn("label", fx.label_from("readmitted"))
    p = X.linear_weights(e, LIN, "label")
    return X.linear_contributions(e, p, LIN, "encounter_id")


_LW = ("LW as (select avg(case when readmitted = '<30' then 1.0 else 0.0 end) as base, " + ", ".join(
    f"avg(cast({c} as double)) as m_{c}, coalesce(covar_pop(cast({c} as double), case when readmitted = '<30' then 1.0 else 0.0 end) "
    f"/ nullif(var_pop(cast({c} as double)), 0), 0.0) as w_{c}" for c in LIN) + " from E)")
_LC = ("LC as (" + " union all ".join(
    f"select encounter_id, '{c}' as feature, w_{c} * (cast({c} as double) - m_{c}) as contribution from E, LW"
    for c in LIN) + ")")
_TOP = ("TP as (select encounter_id, cast(row_number() over (partition by encounter_id order by abs(contribution) desc, "
        "feature) as int) as rank, feature, contribution from LC)")


@R.add("linear_top_contributions", ["ML14", "TOP4", "WIN3"], sql_e(
    "select encounter_id, rank, feature, round(contribution, 6) + 0.0 as contribution from TP where rank <= 10",
    ctes=[_LW, _LC, _TOP]))
def linear_top_contributions(spark, sf_dir):
    t = X.top_contributions(linear(spark, sf_dir), "encounter_id")
    return t.select("encounter_id", F.col("rank").cast("int"), "feature", r6("contribution").alias("contribution"))


@R.add("mean_abs_contribution", ["AGG25", "TOP5"], sql_e(
    "select feature, round(avg(abs(contribution)), 6) as mean_abs from LC group by feature "
    "order by avg(abs(contribution)) desc, feature limit 5", ctes=[_LW, _LC]))
def mean_abs_contribution(spark, sf_dir):
    long = X.explode_contributions(linear(spark, sf_dir), "encounter_id")
    top = X.top_features(X.mean_abs_contribution(long), 5)
    return top.select("feature", r6("mean_abs").alias("mean_abs"))


@R.add("dependence_table", ["ML15"], sql_e(
    "select cast(E.num_medications as double) as value, count(*) as n, round(avg(contribution), 6) as mean_contribution "
    "from E join LC on LC.encounter_id = E.encounter_id and LC.feature = 'num_medications' group by 1",
    ctes=[_LW, _LC]))
def dependence_table(spark, sf_dir):
    lin = linear(spark, sf_dir)
    d = X.dependence(lin, "num_medications")
    return d.select("value", "n", r6("mean_contribution").alias("mean_contribution"))


@R.add("linear_scores", ["ML16", "FN16", "FN17", "FN24"], sql_e(
    "select encounter_id, round(score, 6) as score, score >= 0.5 as prediction, "
    "case when score < 0.3 then 'Low' when score < 0.7 then 'Medium' else 'High' end as risk_level from "
    "(select encounter_id, any_value(base) + sum(contribution) as score from LC, LW group by encounter_id) s",
    ctes=[_LW, _LC]))
def linear_scores(spark, sf_dir):
    lin = linear(spark, sf_dir)
    return lin.select("encounter_id", r6("score").alias("score"), (F.col("score") >= 0.5).alias("prediction"),
                      fx.risk_band("score").alias("risk_level"))


@R.add("live_performance", ["ML17", "AGG18"], sql_e(
    "select round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy, "
    "round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as precision, "
    "round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall, "
    "round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1, tp + fn as support, "
    "round(auc, 6) as auc, cast(null as varchar) as error from "
    "(select count_if(label = 0 and score < 0.5) as tn, count_if(label = 0 and score >= 0.5) as fp, "
    "count_if(label = 1 and score < 0.5) as fn, count_if(label = 1 and score >= 0.5) as tp from SC2) c, "
    "(select sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from "
    "(select *, sum(neg) over (order by score rows between unbounded preceding and current row) as cum_neg from "
    "(select score, count_if(label = 1) as pos, count_if(label = 0) as neg from SC2 group by score) q) u) a",
    ctes=["SC2 as (select * from S where admit_ts >= timestamp '1998-01-01 00:00:00')"], views=("E", "S")))
def live_performance(spark, sf_dir):
    cur = scored(spark, sf_dir).where(drift_side() == "cur")
    p = SC.live_performance(cur, "label", "score", 0.5)
    return p.select(*[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
                    F.col("support").cast("bigint"), r6("auc").alias("auc"), "error")


def _deployed(spark, sf_dir):
    """(frame scored by the promoted pipeline, its trees, its slot names, its
    threshold): the tuned pipeline is promoted, and the copy in ``prod`` is read back."""
    frame, _, _ = fitted(spark, sf_dir)
    ML.save_model(tuned(spark, sf_dir), spark, "readmission_gbt", promote=True)
    prod = ML.load_pipeline(scratch_path(spark, "prod/readmission_gbt"))
    trees = X.tree_tables(spark, ML.save_model(prod.stages[-1], spark, "readmission_gbt_trees"))
    scored_frame = ML.positive_probability(prod.transform(frame))
    return scored_frame, trees, X.vector_slot_names(scored_frame), ML.stored_threshold(prod)


@R.add("tree_contributions", ["ML14", "TOP4"])
def tree_contributions(spark, sf_dir):
    df, trees, names, _ = _deployed(spark, sf_dir)
    t = X.tree_contributions(df, trees, names, "encounter_id")
    return t.select("encounter_id", "rank", "feature", r6("contribution").alias("contribution"), r6("bias").alias("bias"))


@R.add("scored_table", ["ML16", "FN23", "FN24", "FN26", "SNK4", "SNK9"])
def scored_table(spark, sf_dir):
    df, trees, names, threshold = _deployed(spark, sf_dir)
    why = X.tree_explanations(df, trees, names, ["encounter_id", "p1"])
    run_ts = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rec = SC.scored_record(why, "encounter_id", "p1", threshold, "readmission_gbt", run_ts, "explanation")
    return rec.withColumn("json", F.to_json(F.struct(*rec.columns)))
