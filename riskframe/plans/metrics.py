"""Queries: evaluation metrics on the scored view S."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import metrics as M
from riskframe.plans.base import R, r6, sql_e
from riskframe.sources.encounters import scored


def S(spark, sf_dir):
    return scored(spark, sf_dir)


def _s(body, ctes=()):
    return sql_e(body, ctes=list(ctes), views=("E", "S"))


_CONF = ("C as (select count_if(label = 0 and score < {t}) as tn, count_if(label = 0 and score >= {t}) as fp, "
         "count_if(label = 1 and score < {t}) as fn, count_if(label = 1 and score >= {t}) as tp from S)")
_RATES = ("round((tp + tn) / (tn + fp + fn + tp), 6) as accuracy, "
          "round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as precision, "
          "round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall, "
          "round(case when tn + fp = 0 then null else tn / (tn + fp) end, 6) as specificity, "
          "round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1_score, "
          "round(case when tn + fn = 0 then 0 else tn / (tn + fn) end, 6) as negative_predictive_value")
_RATE_COLS = ["accuracy", "precision", "recall", "specificity", "f1_score", "negative_predictive_value"]


@R.add("confusion_metrics", ["AGG11", "AGG12", "AGG13", "FN16"],
       _s(f"select tn, fp, fn, tp, {_RATES} from C", [_CONF.format(t=0.5)]))
def confusion_metrics(spark, sf_dir):
    d = S(spark, sf_dir).withColumn("pred", fx.decision("score", 0.5))
    c = M.with_rates(M.confusion(d, "label", "pred"))
    return c.select("tn", "fp", "fn", "tp", *[r6(x).alias(x) for x in _RATE_COLS])


_SC = "SC as (select score, count_if(label = 1) as pos, count_if(label = 0) as neg from S group by score)"
_AUC_RAW = ("select sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from "
            "(select *, sum(neg) over (order by score rows between unbounded preceding and current row) "
            "as cum_neg from SC) u")
_AP_RAW = ("select sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) as average_precision from "
           "(select *, sum(pos) over (order by score desc rows between unbounded preceding and current row) as cum_pos, "
           "sum(neg) over (order by score desc rows between unbounded preceding and current row) as cum_neg from SC) u")
_AUC_SQL = f"select round(auc, 6) as auc from ({_AUC_RAW}) a"
_AP_SQL = f"select round(average_precision, 6) as average_precision from ({_AP_RAW}) a"


@R.add("roc_auc", ["AGG14"], _s(_AUC_SQL, [_SC]))
def roc_auc(spark, sf_dir):
    return M.auc(S(spark, sf_dir), "label", "score").select(r6("auc").alias("auc"))


@R.add("average_precision", ["AGG15", "WIN6"], _s(_AP_SQL, [_SC]))
def average_precision(spark, sf_dir):
    return M.average_precision(S(spark, sf_dir), "label", "score").select(
        r6("average_precision").alias("average_precision"))


@R.add("brier_score", ["AGG16"], _s("select round(avg(pow(score - label, 2)), 6) as brier_score from S"))
def brier_score(spark, sf_dir):
    return M.brier(S(spark, sf_dir), "label", "score").select(r6("brier_score").alias("brier_score"))


_EVAL_COLS = ["accuracy", "precision", "recall", "sensitivity", "specificity", "f1_score", "auc",
              "average_precision", "brier_score", "positive_predictive_value",
              "negative_predictive_value"]


@R.add("evaluation", ["AGG11", "AGG12", "AGG13", "AGG14", "AGG15", "AGG16", "SNK5"], _s(
    "select R.*, round(A.auc, 6) as auc, round(P.average_precision, 6) as average_precision, "
    "round(B.brier_score, 6) as brier_score from "
    f"(select tn, fp, fn, tp, {_RATES}, round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) "
    "as sensitivity, round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as positive_predictive_value "
    f"from C) R, ({_AUC_RAW}) A, "
    f"({_AP_RAW}) P, "
    "(select avg(pow(score - label, 2)) as brier_score from S) B", [_CONF.format(t=0.5), _SC]))
def evaluation(spark, sf_dir):
    e = M.evaluation(S(spark, sf_dir), "label", "score", 0.5)
    return e.select(*[r6(c).alias(c) for c in _EVAL_COLS], "tn", "fp", "fn", "tp")


@R.add("roc_points", ["WIN1"], _s(
    "select score as threshold, cast(cum_pos as bigint) as tp, cast(cum_neg as bigint) as fp, round(cum_pos / P, 6) as tpr, "
    "round(cum_neg / N, 6) as fpr, round(cum_pos / (cum_pos + cum_neg), 6) as precision from "
    "(select score, sum(pos) over (order by score desc rows between unbounded preceding and current row) as cum_pos, "
    "sum(neg) over (order by score desc rows between unbounded preceding and current row) as cum_neg, "
    "sum(pos) over () as P, sum(neg) over () as N from SC) u", [_SC]))
def roc_points(spark, sf_dir):
    c = M.curve_points(S(spark, sf_dir), "label", "score")
    return c.select("threshold", F.col("tp").cast("bigint").alias("tp"),
                    F.col("fp").cast("bigint").alias("fp"),
                    r6("tpr").alias("tpr"), r6("fpr").alias("fpr"), r6("precision").alias("precision"))


def _bin_case(col, n_bins=10):
    step = 1.0 / n_bins
    parts = [f"when {col} <= cast('{repr(i * step)}' as double) then {i - 1}" for i in range(1, n_bins)]
    return "case " + " ".join(parts) + f" else {n_bins - 1} end"


@R.add("calibration_curve", ["AGG17", "T10"], _s(
    f"select {_bin_case('score')} as bin, count(*) as n, round(avg(score), 6) as prob_pred, "
    "round(avg(label), 6) as prob_true from S group by 1"))
def calibration_curve(spark, sf_dir):
    c = M.calibration_curve(S(spark, sf_dir), "label", "score", 10)
    return c.select("bin", "n", r6("prob_pred").alias("prob_pred"), r6("prob_true").alias("prob_true"))


@R.add("class_report", ["AGG18"], _s(
    "select cls, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, "
    "cast(support as bigint) as support from ("
    "select '0' as cls, case when tn + fn = 0 then 0 else tn / (tn + fn) end as precision, "
    "case when tn + fp = 0 then 0 else tn / (tn + fp) end as recall, "
    "case when 2 * tn + fn + fp = 0 then 0 else 2 * tn / (2 * tn + fn + fp) end as f1, tn + fp as support from C "
    "union all select '1', case when tp + fp = 0 then 0 else tp / (tp + fp) end, "
    "case when tp + fn = 0 then 0 else tp / (tp + fn) end, "
    "case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, tp + fn from C) k "
    "union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from K2 "
    "union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), "
    "round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from K2",
    [_CONF.format(t=0.5),
     "K2 as (select case when tn + fn = 0 then 0 else tn / (tn + fn) end as precision, "
     "case when tn + fp = 0 then 0 else tn / (tn + fp) end as recall, "
     "case when 2 * tn + fn + fp = 0 then 0 else 2 * tn / (2 * tn + fn + fp) end as f1, tn + fp as support from C "
     "union all select case when tp + fp = 0 then 0 else tp / (tp + fp) end, "
     "case when tp + fn = 0 then 0 else tp / (tp + fn) end, "
     "case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, tp + fn from C)"]))
def class_report(spark, sf_dir):
    d = S(spark, sf_dir).withColumn("pred", fx.decision("score", 0.5))
    r = M.class_report(d, "label", "pred")
    return r.select("cls", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), F.col("support").cast("bigint").alias("support"))


def subgroup_frame(spark, sf_dir):
    s = S(spark, sf_dir)
    s = s.withColumn("age_numeric", fx.interval_midpoint("age"))
    s = s.withColumn("comorbidity_count", fx.truthy_count(["diag_1", "diag_2"]))
    return s.select("encounter_id", "label", "score", fx.decision("score", 0.5).alias("pred"),
                    fx.age_group("age_numeric").alias("age_group"), "gender",
                    fx.comorbidity_group("comorbidity_count").alias("comorbidity_group"),
                    fx.los_group("time_in_hospital").alias("los_group"))


_SUB_SRC = (
    "G as (select label, score, case when score >= 0.5 then 1 else 0 end as pred, "
    "case when a > 0 and a <= 30 then '<30' when a > 30 and a <= 50 then '30-50' "
    "when a > 50 and a <= 70 then '50-70' when a > 70 then '>70' end as age_group, gender, "
    "case when cc = 0 then 'None' when cc >= 1 and cc <= 3 then 'Few' when cc > 3 then 'Many' end as comorbidity_group, "
    "case when time_in_hospital > 0 and time_in_hospital <= 3 then 'short' "
    "when time_in_hospital > 3 and time_in_hospital <= 7 then 'medium' "
    "when time_in_hospital > 7 and time_in_hospital <= 14 then 'long' "
    "when time_in_hospital > 14 then 'very_long' end as los_group from "
    "(select *, case when regexp_extract(age, '(\\d+)', 1) = '' then 50 else cast(regexp_extract(age, '(\\d+)', 1) as int) + 5 end as a, "
    "(case when diag_1 is null or diag_1 = '' then 0 else 1 end) + (case when diag_2 is null or diag_2 = '' then 0 else 1 end) as cc from S) x)")
_SUB_LONG = ("L as (" + " union all ".join(
    f"select '{f}' as feature, {f} as grp, label, score, pred from G"
    for f in ["age_group", "gender", "comorbidity_group", "los_group"]) + ")")


@R.add("subgroup_metrics", ["AGG19", "FLT2", "FLT4", "FN10", "T13"], _s(
    "select c.feature, c.grp, c.n, round((tp + tn) / n, 6) as accuracy, "
    "round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as precision, "
    "round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall, "
    "round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1, "
    "round(a.auc, 6) as auc from "
    "(select feature, grp, count(*) as n, count_if(label = 0 and pred = 0) as tn, count_if(label = 0 and pred = 1) as fp, "
    "count_if(label = 1 and pred = 0) as fn, count_if(label = 1 and pred = 1) as tp from L where grp is not null "
    "group by 1, 2 having count(*) >= 10) c left join "
    "(select feature, grp, case when sum(pos) > 0 and sum(neg) > 0 then sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) end as auc "
    "from (select *, sum(neg) over (partition by feature, grp order by score rows between unbounded preceding and current row) as cum_neg "
    "from (select feature, grp, score, count_if(label = 1) as pos, count_if(label = 0) as neg from L where grp is not null group by 1, 2, 3) q) u "
    "group by 1, 2) a on a.feature = c.feature and a.grp = c.grp", [_SUB_SRC, _SUB_LONG]))
def subgroup_metrics(spark, sf_dir):
    g = subgroup_frame(spark, sf_dir)
    m = M.subgroup_metrics(g, "label", "pred", "score",
                           ["age_group", "gender", "comorbidity_group", "los_group"])
    return m.select("feature", "grp", F.col("n").cast("bigint").alias("n"),
                    *[r6(c).alias(c) for c in ["accuracy", "precision", "recall", "f1", "auc"]])


def _sweep_sql(ts):
    vals = ", ".join(f"(cast('{k / 100!r}' as double))" for k in ts)
    return (f"TH as (select col0 as threshold from (values {vals}) v(col0)), "
            "SW as (select threshold, count_if(label = 1 and score >= threshold) as tp, "
            "count_if(label = 0 and score >= threshold) as fp, count_if(label = 1 and score < threshold) as fn, "
            "count_if(label = 0 and score < threshold) as tn from TH, S group by threshold)")


@R.add("threshold_sweep", ["TOP8", "T11"], _s(
    f"select threshold, tp, fp, fn, tn, {_RATES} from SW", [_sweep_sql(range(10, 90, 5))]))
def threshold_sweep(spark, sf_dir):
    sw = M.threshold_sweep(S(spark, sf_dir), "label", "score", M.threshold_grid(10, 90, 5))
    return sw.select("threshold", *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")],
                     *[r6(c).alias(c) for c in _RATE_COLS])


@R.add("best_threshold", ["TOP8"], _s(
    "select threshold, round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1_score "
    "from SW order by 2 desc, threshold limit 1", [_sweep_sql(range(10, 90, 1))]))
def best_threshold(spark, sf_dir):
    sw = M.threshold_sweep(S(spark, sf_dir), "label", "score", M.threshold_grid(10, 90, 1))
    sw = sw.withColumn("f1_score", r6("f1_score"))
    return M.best_threshold(sw).select("threshold", "f1_score")


@R.add("weighted_objective", ["AGG29", "ML6"], _s(
    "select round(A.auc, 6) as auc, round(F.f1, 6) as f1_score, round(0.4 * A.auc + 0.6 * F.f1, 6) as objective from "
    f"({_AUC_RAW}) A, "
    "(select case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end as f1 from C) F",
    [_CONF.format(t=0.3), _SC]))
def weighted_objective(spark, sf_dir):
    w = M.weighted_objective(S(spark, sf_dir), "label", "score", 0.3)
    return w.select(r6("auc").alias("auc"), r6("f1_score").alias("f1_score"), r6("objective").alias("objective"))


@R.add("risk_bands", ["FN16", "FN17"], _s(
    "select encounter_id, score, case when score >= 0.5 then 1 else 0 end as decision, "
    "case when score < 0.3 then 'Low' when score < 0.7 then 'Medium' else 'High' end as risk_level from S"))
def risk_bands(spark, sf_dir):
    s = S(spark, sf_dir)
    return s.select("encounter_id", "score", fx.decision("score", 0.5).alias("decision"),
                    fx.risk_band("score").alias("risk_level"))


@R.add("quality_gate", ["FN28"], _s(
    "select round(f1, 6) as f1_score, round(auc, 6) as auc, (f1 < 0.9 and auc < 0.95) as below_target from "
    f"({_AUC_RAW}) A, "
    "(select case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end as f1 from C) F",
    [_CONF.format(t=0.5), _SC]))
def quality_gate(spark, sf_dir):
    w = M.weighted_objective(S(spark, sf_dir), "label", "score", 0.5)
    return w.select(r6("f1_score").alias("f1_score"), r6("auc").alias("auc"),
                    ((F.col("f1_score") < 0.9) & (F.col("auc") < 0.95)).alias("below_target"))
