"""Queries: feature selection, class weights and Spark ML models (rows-only
checks for anything that depends on a fitted booster)."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import balance as B
from riskframe.operators import chain as CH
from riskframe.operators import clean
from riskframe.operators import explain as X
from riskframe.operators import features as FT
from riskframe.operators import metrics as M
from riskframe.operators import model as ML
from riskframe.operators import select as SEL
from riskframe.operators import split
from riskframe.plans.base import R, r6, sql_e
from riskframe.plans.split import _INNER_CTES, _SPLIT_BODY, _SPLIT_CTES
from riskframe.session import cut_lineage, materialize, scratch_path
from riskframe.sources.encounters import encounters, source_key

MI_FEATURES = ["time_in_hospital", "num_medications", "num_procedures", "num_lab_procedures",
               "number_diagnoses", "number_outpatient", "number_emergency", "number_inpatient",
               "total_charge"]
MODEL_FEATURES = MI_FEATURES + ["age_numeric", "age_med_interaction", "med_per_day", "total_encounters",
                                "is_elderly", "high_diag_complexity"]
CATEGORICAL = ["race", "insulin", "payer_code"]
SINGLE = dict(ML.FALLBACK, max_depth=4)     # the model of the scoring queries
PATIENT = {k: v for k, v in SINGLE.items() if k != "scale_pos_weight"}


def model_frame(spark, sf_dir):
    """Label and stratified split of E, then cleaning fitted on the train rows
    (R3) and features."""
    e = clean.sentinel_to_null(encounters(spark, sf_dir)).withColumn("label", fx.label_from("readmitted"))
    s = split.stratified_split(e, "label", "encounter_id")
    c = clean.clean_table(s, fit=s.where(F.col("split") == "train"))
    return FT.engineered_features(FT.structured_features(c))


def train_frame(frame, folds: int = 0):
    """Train rows with weight columns (and stratified folds for a search)."""
    tr = frame.where(F.col("split") == "train")
    if folds:
        tr = split.kfold(tr, "label", "encounter_id", k=folds)
    ratio = B.class_balance(tr, "label").first()["ratio"]
    return ML.add_weight_columns(tr, "label", ratio), ratio


def _stopping_rows(frame):
    """Train rows and, marked ``is_val``, the validation rows that end the
    boosting; dealt evenly and written once, as boosting passes over them many
    times."""
    tr, ratio = train_frame(frame)
    val = ML.add_weight_columns(frame.where(F.col("split") == "val"), "label", ratio)
    both = tr.withColumn("is_val", F.lit(False)).unionByName(val.withColumn("is_val", F.lit(True)))
    both = both.select("encounter_id", "label", "is_val", "w_ratio", *MODEL_FEATURES, *CATEGORICAL)
    return cut_lineage(both.repartition(ML.fit_tasks(both))), ratio


def _single(ref):
    g = ML.gbt(**ref).setParams(validationIndicatorCol="is_val")
    return ML.make_pipeline(ML.preprocess_stages(MODEL_FEATURES, CATEGORICAL, drop_first=True,
                                                 fit_where="not is_val"), g)


_CACHE = {}


def fitted(spark, sf_dir):
    """Train once per session and state of the input files: median/one-hot
    pipeline + GBT with class weight = imbalance ratio and early stopping on
    the validation rows."""
    key = ("gbt", source_key(spark, sf_dir))
    if key in _CACHE:
        return _CACHE[key]
    frame = model_frame(spark, sf_dir)
    rows, ratio = _stopping_rows(frame)
    model = _single(SINGLE).fit(rows)
    _CACHE[key] = (frame, model, ratio)
    return _CACHE[key]


def scored_split(spark, sf_dir, which):
    frame, model, _ = fitted(spark, sf_dir)
    return ML.positive_probability(model.transform(frame.where(F.col("split") == which)))


def tuned(spark, sf_dir):
    """The fitted pipeline with the threshold of best F1 on the validation
    rows among its parameters."""
    key = ("tuned", source_key(spark, sf_dir))
    if key not in _CACHE:
        _, model, _ = fitted(spark, sf_dir)
        sweep = M.threshold_sweep(scored_split(spark, sf_dir, "val"), "label", "p1", M.threshold_grid(10, 90, 5))
        _CACHE[key] = ML.with_threshold(model, M.best_threshold(sweep).first()["threshold"])        # one number
    return _CACHE[key]


def fitted_patient(spark, sf_dir):
    """Up to 500 rounds with a patience of 10 on the validation rows, cut at
    the best round; once per state of the input files.  Without class weights,
    so that the fit lowers the same loss that the wait looks at."""
    key = ("patient", source_key(spark, sf_dir))
    if key not in _CACHE:
        frame = model_frame(spark, sf_dir)
        rows, _ = _stopping_rows(frame)
        pre = Pipeline(stages=ML.preprocess_stages(MODEL_FEATURES, CATEGORICAL, drop_first=True,
                                                   fit_where="not is_val")).fit(rows)
        ready = cut_lineage(pre.transform(rows).select("label", "is_val", "features"))
        got = ML.fit_patient(ML.gbt(**PATIENT), ready.where("not is_val"), ready.where("is_val"), ML.PATIENCE)
        _CACHE[key] = frame, PipelineModel([*pre.stages, got.model]), got
    return _CACHE[key]


_MI_SQL = [
    "LG as (" + " union all ".join(
        f"select '{f}' as feature, cast({f} as double) as value, label from TRN" for f in MI_FEATURES) + ")",
    "VC as (select feature, value, count(*) as n, count_if(label = 1) as n_pos from LG where value is not null group by 1, 2)",
    "BN as (select feature, cast(floor(10 * (sum(n) over (partition by feature order by value rows between unbounded preceding and current row) - n) "
    "/ sum(n) over (partition by feature)) as int) as bin, n, n_pos from VC)",
    "CX as (select feature, bin, sum(n) as nx, sum(n_pos) as n1 from BN group by 1, 2)",
    "CE as (select feature, bin, nx, 1 as y, n1 as nxy from CX union all select feature, bin, nx, 0, nx - n1 from CX)",
    "CF as (select * from CE where nxy > 0)",
    "MI as (select CF.feature, sum(nxy / nt * ln((nxy / nt) / ((nx / nt) * (ny / nt)))) as mi from CF "
    "join (select feature, y, sum(nxy) as ny from CF group by 1, 2) a on a.feature = CF.feature and a.y = CF.y "
    "join (select feature, sum(nxy) as nt from CF group by 1) b on b.feature = CF.feature group by 1)",
]
_TRN = ["L2 as (select *, case when readmitted = '<30' then 1 else 0 end as label from E)",
        "TRN as (select L2.* from L2 join (" + _SPLIT_BODY + ") s on s.encounter_id = L2.encounter_id "
        "where s.split = 'train')"]


def _mi(spark, sf_dir):
    e = encounters(spark, sf_dir).withColumn("label", fx.label_from("readmitted"))
    tr = split.stratified_split(e, "label", "encounter_id").where(F.col("split") == "train")
    return SEL.mutual_info(tr, MI_FEATURES, "label")


@R.add("mutual_info", ["AGG26", "T8"], sql_e("select feature, round(mi, 6) as mi from MI",
                                             ctes=_SPLIT_CTES + _TRN + _MI_SQL))
def mutual_info(spark, sf_dir):
    return _mi(spark, sf_dir).select("feature", r6("mi").alias("mi"))


@R.add("top_k_features", ["TOP6"], sql_e(
    "select feature, round(mi, 6) as mi from MI order by mi desc, feature limit 40", ctes=_SPLIT_CTES + _TRN + _MI_SQL))
def top_k_features(spark, sf_dir):
    return SEL.k_best(_mi(spark, sf_dir), 40).select("feature", r6("mi").alias("mi"))


_KMI_SQL = [
    "LN as (" + " union all ".join(
        f"select '{f}' as feature, cast({f} as double) as value, label as y from TRN" for f in MI_FEATURES) + ")",
    "UC as (select feature, y, cast(round(value / 1e-6) as bigint) as u, count(*) as n from LN "
    "where value is not null group by 1, 2, 3)",
    "UR as (select *, row_number() over (partition by feature, y order by u) as rn, "
    "sum(n) over (partition by feature, y) as nc from UC)",
    # the k-th other row among the k distinct values on either side
    "ND as (select a.feature, a.y, a.u, a.n, a.nc, least(3, a.nc - 1) as k, abs(b.u - a.u) as d, "
    "sum(b.n) over (partition by a.feature, a.y, a.u order by abs(b.u - a.u)) - 1 as seen from UR a join UR b "
    "on a.feature = b.feature and a.y = b.y and b.rn between a.rn - 3 and a.rn + 3 where a.nc > 1)",
    "RD as (select feature, y, u, any_value(n) as n, any_value(nc) as nc, any_value(k) as k, min(d) as r from ND "
    "where seen >= k group by 1, 2, 3)",
    "IN1 as (select x.feature, x.y, x.u, any_value(x.n) as n, any_value(x.nc) as nc, any_value(x.k) as k, sum(p.n) as m "
    "from RD x join RD p on p.feature = x.feature and p.u >= x.u - x.r and p.u <= x.u + x.r "
    "where p.u = x.u or abs(p.u - x.u) < x.r group by 1, 2, 3)"]


def _psi(x):
    """digamma of a whole number, as SQL."""
    y = f"({x} + 6.0::double)"
    return (f"(ln({y}) - 0.5 / {y} - 1.0 / (12.0 * pow({y}, 2)) + 1.0 / (120.0 * pow({y}, 4)) - 1.0 / (252.0 * pow({y}, 6)) "
            f"+ 1.0 / (240.0 * pow({y}, 8)) - " + " - ".join(f"1.0::double / ({x} + {i})" for i in range(6)) + ")")


@R.add("knn_mutual_info", ["AGG26"], sql_e(
    f"select feature, round(greatest(0.0, {_psi('sum(n)')} + sum(n * {_psi('k')}) / sum(n) - sum(n * {_psi('nc')}) / sum(n) "
    f"- sum(n * {_psi('m')}) / sum(n)), 6) as mi from IN1 group by feature", ctes=_SPLIT_CTES + _TRN + _KMI_SQL))
def knn_mutual_info(spark, sf_dir):
    """Information of each feature about the label on the train rows, by
    nearest neighbours."""
    tr = _train_labelled(spark, sf_dir)
    return SEL.knn_mutual_info(tr, MI_FEATURES, "label").select("feature", r6("mi").alias("mi"))


@R.add("class_weight_grid", ["ML2", "AGG8"], sql_e(
    "select option, round(pos_weight, 6) as pos_weight from (select 'one' as option, 1.0 as pos_weight "
    "union all select 'half_ratio', r / 2 from RT union all select 'ratio', r from RT "
    "union all select 'ratio_x1_5', r * 1.5 from RT) g",
    ctes=["RT as (select count_if(readmitted <> '<30') / count_if(readmitted = '<30') as r from E)"]))
def class_weight_grid(spark, sf_dir):
    e = encounters(spark, sf_dir).select(fx.label_from("readmitted").alias("label"))
    return B.pos_weight_grid(B.class_balance(e, "label")).select("option", r6("pos_weight").alias("pos_weight"))


_FILLED = [f"coalesce(cast({c} as double), (select median(cast({c} as double)) from TRN)) as {c}" for c in MI_FEATURES]
_CATS = {c: f"coalesce(nullif({c}, '?'), (select nullif({c}, '?') from TRN where nullif({c}, '?') is not null "
            f"group by 1 order by count(*) desc, 1 limit 1))" for c in CATEGORICAL}
_PREP_SQL = [
    f"FE as (select encounter_id, {', '.join(_FILLED)}, {', '.join(f'{x} as {c}' for c, x in _CATS.items())} from E)",
    "FT as (select FE.* from FE semi join TRN using (encounter_id))",
    "PS as (" + " union all ".join(
        f"select encounter_id, '{c}' as slot, case when s = 0 then 0.0 else ({c} - m) / s end as value "
        f"from FE, (select avg({c}) as m, stddev_pop({c}) as s from FT) p" for c in MI_FEATURES) + ")",
    # categories of the train rows, without the first
    "PC as (" + " union all ".join(
        f"select encounter_id, '{c}_' || v as slot, cast({c} = v as int) as value from FE, "
        f"(select distinct nullif({c}, '?') as v from TRN where nullif({c}, '?') is not null order by 1 offset 1) d"
        for c in CATEGORICAL) + ")"]


@R.add("preprocessed_matrix", ["ML11", "FN13"], sql_e(
    "select encounter_id, slot, round(cast(value as double), 6) as value from "
    "(select * from PS union all select * from PC) x", ctes=_SPLIT_CTES + _TRN + _PREP_SQL))
def preprocessed_matrix(spark, sf_dir):
    """The vector that the boosters are fitted on, slot by slot, for every
    encounter; fitted on the train rows."""
    e = clean.sentinel_to_null(encounters(spark, sf_dir)).withColumn("label", fx.label_from("readmitted"))
    rows = split.stratified_split(e, "label", "encounter_id")
    prep = Pipeline(stages=ML.preprocess_stages(MI_FEATURES, CATEGORICAL, drop_first=True,
                                                fit_where="split = 'train'")).fit(rows)
    names = F.array(*[F.lit(n) for n in ML.slot_names(prep)])
    long = prep.transform(rows).select("encounter_id", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return long.select("encounter_id", F.get(names, F.col("i")).alias("slot"), r6("value").alias("value"))


def _chain(spark, sf_dir):
    """The chain on every fold of the fit rows, once per state of the input:
    counts per fold and class, metrics per fold.  A fifth of the train rows
    stops the boosting."""
    key = ("chain", source_key(spark, sf_dir))
    if key not in _CACHE:
        frame = model_frame(spark, sf_dir)
        tr = split.two_way_split(frame.where(F.col("split") == "train"), "label", "encounter_id",
                                 hold_pct=CH.HOLD_PCT, seed=7)
        cols = ["encounter_id", "label", *MODEL_FEATURES, *CATEGORICAL]
        fit = split.kfold(tr.where("part = 'fit'"), "label", "encounter_id", k=CH.FOLDS).select(*cols, "fold")
        fit = materialize(fit.repartition(ML.fit_tasks(tr)), "chain")       # every fold reads columns of it many times
        stop = materialize(tr.where("part = 'holdout'").select(*cols), "chain")
        booster = ML.gbt(**PATIENT)
        counts, metrics = [], []
        for f in CH.cross_fit(CH.TrainingChain(MODEL_FEATURES, CATEGORICAL, booster), fit, stop):
            counts += [(f.fold, r["label"], r["synthetic"], r["count"])
                       for r in f.resampled.rows.groupBy("label", "synthetic").count().collect()]
            ev = M.evaluation(f.scored, "label", "p1", 0.5).first().asDict()
            metrics.append((f.fold, ",".join(f.resampled.selected), f.model.stages[-1].getNumTrees,
                            *[float(ev[m]) if ev[m] is not None else None for m in ("f1_score", "recall", "auc")]))
        _CACHE[key] = counts, metrics
    return _CACHE[key]


_CHAIN_CTES = _INNER_CTES + [
    "FR as (select K2.encounter_id, K2.label from K2 join H on K2.label = H.label where srank > n_hold)",
    "FF as (select label, (row_number() over (partition by label order by "
    "md5(cast(encounter_id as varchar) || '42'), encounter_id) - 1) % 5 as fold from FR)",
    "FN as (select f.fold, count_if(label = 0) as n0, count_if(label = 1) as n1 from FF, "
    "(select unnest(range(0, 5)) as fold) f where FF.fold <> f.fold group by f.fold)"]


@R.add("training_chain_counts", ["TOP6", "SMP4", "SMP5", "SMP6", "SET3"], sql_e(
    "select cast(fold as int) as fold, label, synthetic, n from ("
    "select fold, 0 as label, 0 as synthetic, n0 as n from FN union all select fold, 1, 0, n1 from FN "
    "union all select fold, 1, 1, cast(floor(0.5 * n0) as bigint) - n1 from FN) c where n > 0", ctes=_CHAIN_CTES))
def training_chain_counts(spark, sf_dir):
    """Rows that the booster of each fold is fitted on."""
    return spark.createDataFrame(_chain(spark, sf_dir)[0], "fold int, label int, synthetic int, n long")


@R.add("training_chain_scores", ["TOP6", "SMP6", "SMP4", "ML1", "ML3", "ML11"])
def training_chain_scores(spark, sf_dir):
    """Selected slots, trees and metrics of each fold, on its own unseen rows."""
    return spark.createDataFrame(_chain(spark, sf_dir)[1], "fold int, selected string, trees int, f1_score double, "
                                                           "recall double, auc double")


@R.add("gbt_test_scores", ["ML1", "ML2", "ML3", "ML10", "ML11", "FN16", "FN17"])
def gbt_test_scores(spark, sf_dir):
    t = ML.stored_threshold(tuned(spark, sf_dir))
    test = ML.apply_threshold(scored_split(spark, sf_dir, "test"), "p1", t)
    return test.select("encounter_id", "label", r6("p1").alias("probability"), "decision",
                       F.lit(t).alias("threshold"), fx.risk_band("p1").alias("risk_level"))


@R.add("patient_rounds", ["ML3", "SNK6"])
def patient_rounds(spark, sf_dir):
    """Ledger of the booster with patience: validation loss per round, the
    round that it was cut at and its metrics on the test rows."""
    frame, model, got = fitted_patient(spark, sf_dir)
    test = ML.positive_probability(model.transform(frame.where(F.col("split") == "test")))
    ev = M.evaluation(test, "label", "p1", 0.5).first().asDict()
    run = "patient-" + os.path.basename(sf_dir.rstrip("/"))
    rows = ML.ledger_rows(run, "params", {**PATIENT, "patience": ML.PATIENCE})
    rows += ML.ledger_rows(run, "round", {f"{i:04d}": v for i, v in enumerate(got.losses, 1)})
    rows += ML.ledger_rows(run, "metrics", {"best_round": got.best_round, "best_loss": got.losses[got.best_round - 1], **ev})
    led = scratch_path(spark, f"ledger/{run}-{spark.sparkContext.applicationId}")
    return ML.append_ledger(spark, led, rows).where(F.col("run_id") == run)


@R.add("patient_scores", ["ML1", "ML3"])
def patient_scores(spark, sf_dir):
    frame, model, _ = fitted_patient(spark, sf_dir)
    return _test_scores(model, frame)


@R.add("gbt_feature_importance", ["ML13", "TOP3"])
def gbt_feature_importance(spark, sf_dir):
    frame, model, _ = fitted(spark, sf_dir)
    feats = model.transform(frame.limit(1))
    imp = ML.importance_table(model.stages[-1], feats)
    return imp.orderBy(F.col("importance").desc(), "feature").limit(20)


def _search(spark, sf_dir, which):
    """(frame, search with early stopping on the validation rows, its maps),
    once per state of the input; the spaces, draws and folds are the library's."""
    key = (which, source_key(spark, sf_dir))
    if key not in _CACHE:
        frame = model_frame(spark, sf_dir)
        g = ML.gbt()
        maps, k, metric = (ML.grid_maps(g), ML.GRID_FOLDS, "f1") if which == "grid" \
            else (ML.random_maps(g), ML.RANDOM_FOLDS, "objective")
        tr, ratio = train_frame(frame, folds=k)
        val = ML.add_weight_columns(frame.where(F.col("split") == "val"), "label", ratio)
        cols = ["encounter_id", "label", *[c for c in val.columns if c.startswith("w_")], *MODEL_FEATURES, *CATEGORICAL]
        found = ML.stopped_search(cut_lineage(tr.select(*cols, "fold")), cut_lineage(val.select(*cols)),
                                  ML.preprocess_stages(MODEL_FEATURES, CATEGORICAL, drop_first=True), g, maps,
                                  ML.RiskEvaluator(metric), k=k)
        _CACHE[key] = frame, found, maps
    return _CACHE[key]


@R.add("cv_grid_search", ["ML4", "ML6", "SMP5"])
def cv_grid_search(spark, sf_dir):
    _, found, maps = _search(spark, sf_dir, "grid")
    return ML.search_table(found, maps)


@R.add("best_model_scores", ["ML7"])
def best_model_scores(spark, sf_dir):
    """The best map, fitted again on all train rows, scores the test rows."""
    frame, found, _ = _search(spark, sf_dir, "grid")
    return _test_scores(found.bestModel, frame)


def _test_scores(model, frame):
    test = ML.positive_probability(model.transform(frame.where(F.col("split") == "test")))
    return test.select("encounter_id", "label", r6("p1").alias("probability"), fx.decision("p1").alias("decision"))


@R.add("random_search", ["ML5", "ML6"])
def random_search(spark, sf_dir):
    _, found, maps = _search(spark, sf_dir, "random")
    return ML.search_table(found, maps)


@R.add("fallback_scores", ["ML8"])
def fallback_scores(spark, sf_dir):
    """The fixed model that takes over when a search fails (here: one without
    maps) scores the test rows."""
    frame = model_frame(spark, sf_dir)
    rows, _ = _stopping_rows(frame)
    model, how = ML.fit_with_fallback(rows, _single({}), [], ML.RiskEvaluator("f1"), _single(ML.FALLBACK))
    return _test_scores(model, frame).withColumn("model", F.lit(how))


@R.add("isotonic_calibrated", ["ML9", "R6"])
def isotonic_calibrated(spark, sf_dir):
    iso = ML.fit_isotonic(scored_split(spark, sf_dir, "val"))
    test = iso.transform(scored_split(spark, sf_dir, "test"))
    return test.select("encounter_id", "label", r6("p1").alias("probability"), r6("p_cal").alias("calibrated"))


@R.add("model_ledger", ["SNK3", "SNK4", "SNK5", "SNK6", "SNK7", "FN28"])
def model_ledger(spark, sf_dir):
    frame, model, ratio = fitted(spark, sf_dir)
    path = ML.save_model(tuned(spark, sf_dir), spark, "readmission_gbt", promote=True)
    test = scored_split(spark, sf_dir, "test")
    ev = M.evaluation(test, "label", "p1", 0.5).first().asDict()
    run = "gbt-" + os.path.basename(sf_dir.rstrip("/"))
    rows = ML.ledger_rows(run, "params", {**SINGLE, "scale_pos_weight": ratio,
                                          "trees": model.stages[-1].getNumTrees,
                                          "threshold": ML.stored_threshold(tuned(spark, sf_dir))})
    rows += ML.ledger_rows(run, "metrics", {k: v for k, v in ev.items()})
    names = X.vector_slot_names(model.transform(frame.limit(1)))
    n = {r["split"]: r["count"] for r in frame.groupBy("split").count().collect()}      # three rows
    rows += ML.ledger_rows(run, "model_info", {"model_path": path, "n_features": len(names), "features": ",".join(names),
                                               "n_train": n.get("train", 0), "n_validation": n.get("val", 0),
                                               "version": "1",
                                               "below_target": float(ev["f1_score"] < 0.9 and (ev["auc"] or 0) < 0.95)})
    led = scratch_path(spark, f"ledger/{run}-{spark.sparkContext.applicationId}")
    return ML.append_ledger(spark, led, rows).where(F.col("run_id") == run)


KNN_FEATURES = ["time_in_hospital", "num_medications", "num_procedures", "number_diagnoses",
                "number_outpatient", "number_emergency", "number_inpatient", "num_lab_procedures"]


def _train_labelled(spark, sf_dir):
    e = encounters(spark, sf_dir).withColumn("label", fx.label_from("readmitted"))
    return split.stratified_split(e, "label", "encounter_id").where(F.col("split") == "train")


_M = ["M as (select * from TRN where label = 1)"]
_KNN_SQL = _M + [
    "P as (select a.encounter_id as key, b.encounter_id as nbr, " + " + ".join(
        f"pow(cast(a.{f} as double) - cast(b.{f} as double), 2)" for f in KNN_FEATURES) +
    " as d2 from M a join M b on a.encounter_id <> b.encounter_id)",
    "NN as (select key, nrank, nbr, d2 from (select *, cast(row_number() over (partition by key order by d2, nbr) as int) "
    "as nrank from P) r where nrank <= 5)"]


@R.add("knn_minority", ["JN5"], sql_e(
    "select key as encounter_id, nrank, nbr, round(sqrt(d2), 6) as dist from NN", ctes=_SPLIT_CTES + _TRN + _KNN_SQL))
def knn_minority(spark, sf_dir):
    tr = _train_labelled(spark, sf_dir)
    nn = B.knn(tr.where(F.col("label") == 1), "encounter_id", KNN_FEATURES, k=5)
    return nn.select("encounter_id", "nrank", "nbr", r6("dist").alias("dist"))


_SMOTE_SQL = _SPLIT_CTES + _TRN + _KNN_SQL + [
    "CN as (select count_if(label = 1) as n_min, count_if(label = 0) as n_maj, "
    "cast(floor(0.5 * count_if(label = 0)) as bigint) - count_if(label = 1) as n_new from TRN)",
    "MR as (select M.*, row_number() over (order by md5(cast(encounter_id as varchar) || '42'), encounter_id) as r from M)",
    "GE as (select MR.*, unnest(range(1, cast(n_new // n_min + case when r <= n_new % n_min then 1 else 0 end as bigint) + 1)) as copy "
    "from MR, CN)",
    "GH as (select *, md5(concat_ws('|', cast(encounter_id as varchar), cast(copy as varchar), '42')) as h from GE)",
    "GU as (select *, cast(('0x' || substr(h, 1, 8))::BIGINT % 5 + 1 as int) as nrank, "
    "('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0 as u from GH)",
    "SY as (select GU.encounter_id, GU.copy, " + ", ".join(
        f"GU.{f} + GU.u * (NB.{f} - GU.{f}) as {f}" for f in KNN_FEATURES) +
    " from GU join NN on NN.key = GU.encounter_id and NN.nrank = GU.nrank join M NB on NB.encounter_id = NN.nbr)",
]


@R.add("smote_synthetic", ["SMP6", "SET3"], sql_e(
    "select encounter_id, cast(copy as int) as copy, " + ", ".join(f"round({f}, 6) as {f}" for f in KNN_FEATURES) + " from SY",
    ctes=_SMOTE_SQL))
def smote_synthetic(spark, sf_dir):
    tr = _train_labelled(spark, sf_dir)
    s = B.smote(tr, "label", "encounter_id", KNN_FEATURES, k=5, ratio=0.5)
    return s.where("synthetic = 1").select("encounter_id", F.col("copy").cast("int"),
                                           *[r6(F.col(f).cast("double")).alias(f) for f in KNN_FEATURES])


@R.add("smote_class_counts", ["SMP6", "SET3", "AGG9"], sql_e(
    "select label, synthetic, count(*) as n from (select label, 0 as synthetic from TRN "
    "union all select 1, 1 from SY) t group by 1, 2", ctes=_SMOTE_SQL))
def smote_class_counts(spark, sf_dir):
    tr = _train_labelled(spark, sf_dir)
    s = B.smote(tr, "label", "encounter_id", KNN_FEATURES, k=5, ratio=0.5)
    return s.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))
