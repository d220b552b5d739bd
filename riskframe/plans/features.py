"""Queries: structured features, fitted transforms, projections, feature matrix."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import clean
from riskframe.operators import features as FT
from riskframe.operators import split
from riskframe.operators import text as T
from riskframe.plans.base import E_COLUMNS, E_STRING, R, r6, sql_clean_select, sql_e
from riskframe.plans.clean import _MODE_PAYER, clean_encounters, requests
from riskframe.plans.split import _SPLIT_BODY, _SPLIT_CTES
from riskframe.session import scratch_path
from riskframe.sources import files
from riskframe.sources.encounters import encounters
from riskframe.sources.tables import table

NUMERIC = ["time_in_hospital", "num_medications", "num_procedures", "num_lab_procedures",
           "number_diagnoses", "number_outpatient", "number_emergency", "number_inpatient",
           "total_charge"]
_AGE_SQL = ("(case when regexp_extract(age, '(\\d+)', 1) = '' then 50 "
            "else cast(regexp_extract(age, '(\\d+)', 1) as int) + 5 end)")
_LOS_SQL = ("case when time_in_hospital > 0 and time_in_hospital <= 3 then 'short' "
            "when time_in_hospital > 3 and time_in_hospital <= 7 then 'medium' "
            "when time_in_hospital > 7 and time_in_hospital <= 14 then 'long' "
            "when time_in_hospital > 14 then 'very_long' end")
_CLEAN = f"C as (select {sql_clean_select(fill={'payer_code': '(select v from mode_payer)'})} from E)"


def structured(spark, sf_dir):
    return FT.structured_features(clean_encounters(spark, sf_dir))


_STRUCT_SQL = (f"select encounter_id, {_AGE_SQL} as age_numeric, "
               "(case when diag_1 is null or diag_1 = '' then 0 else 1 end) + "
               "(case when diag_2 is null or diag_2 = '' then 0 else 1 end) as comorbidity_count, "
               f"{_AGE_SQL} * num_medications as age_med_interaction, {_LOS_SQL} as los_group")


@R.add("structured_features", ["FN2", "FN3", "FN4", "FN9", "FN11", "T2", "T15"], sql_e(
    "select *, " + ", ".join(f"cast(coalesce(los_group = '{b}', false) as int) as los_{b}" for b in fx.LOS_LABELS) +
    f" from ({_STRUCT_SQL} from C) s", ctes=[_MODE_PAYER, _CLEAN]))
def structured_features(spark, sf_dir):
    s = structured(spark, sf_dir)
    return s.select("encounter_id", "age_numeric", "comorbidity_count", "age_med_interaction",
                    "los_group", *[f"los_{b}" for b in fx.LOS_LABELS])


@R.add("engineered_features", ["FN4", "FN5", "FN6", "FN7", "FN8", "R18"], sql_e(
    "select encounter_id, num_medications * num_procedures as med_proc_interaction, "
    "num_medications / (case when time_in_hospital = 0 then 1 else time_in_hospital end) as med_per_day, "
    "num_lab_procedures * num_lab_procedures as num_lab_procedures_squared, "
    "num_medications * num_medications as num_medications_squared, "
    "number_diagnoses * number_diagnoses as number_diagnoses_squared, "
    "case insulin when 'Down' then 0 when 'No' then 1 when 'Steady' then 2 when 'Up' then 3 else -1 end as total_meds, "
    f"cast({_AGE_SQL} > 60 as int) as is_elderly, "
    "number_outpatient + number_emergency + number_inpatient as total_encounters, "
    "cast(number_diagnoses > 7 as int) as high_diag_complexity from C", ctes=[_MODE_PAYER, _CLEAN]))
def engineered_features(spark, sf_dir):
    s = structured(spark, sf_dir)
    coded = clean.encode_categories(s, ["insulin"])
    e = FT.engineered_features(coded)
    return e.select("encounter_id", "med_proc_interaction", r6("med_per_day").alias("med_per_day"),
                    "num_lab_procedures_squared", "num_medications_squared", "number_diagnoses_squared",
                    "total_meds", "is_elderly", "total_encounters", "high_diag_complexity")


def train_rows(spark, sf_dir, df):
    s = split.stratified_split(df.withColumn("label", fx.label_from("readmitted")), "label", "encounter_id")
    return s.where(F.col("split") == "train")


_TRAIN = ["TRN as (select E.* from E join (" + _SPLIT_BODY + ") s on s.encounter_id = E.encounter_id "
          "where s.split = 'train')"]
_SCALER_SQL = "SP as (" + " union all ".join(
    f"select '{c}' as col_name, avg(cast({c} as double)) as mean, stddev_pop(cast({c} as double)) as std from TRN"
    for c in NUMERIC) + ")"


@R.add("scaler_params", ["AGG10", "T3", "R2"], sql_e(
    "select col_name, round(mean, 6) as mean, round(std, 6) as std from SP",
    ctes=_SPLIT_CTES + _TRAIN + [_SCALER_SQL]))
def scaler_params(spark, sf_dir):
    e = encounters(spark, sf_dir)
    p = FT.scaler_params(train_rows(spark, sf_dir, e), NUMERIC)
    return p.select("col_name", r6("mean").alias("mean"), r6("std").alias("std"))


_SCALED_SQL = "select encounter_id, " + ", ".join(
    f"round(case when (select std from SP where col_name = '{c}') = 0 then 0.0 else "
    f"({c} - (select mean from SP where col_name = '{c}')) / (select std from SP where col_name = '{c}') end, 6) as {c}"
    for c in NUMERIC) + " from E"


@R.add("standardized_features", ["FN15", "JN4", "R2"], sql_e(_SCALED_SQL, ctes=_SPLIT_CTES + _TRAIN + [_SCALER_SQL]))
def standardized_features(spark, sf_dir):
    e = encounters(spark, sf_dir)
    p = FT.scaler_params(train_rows(spark, sf_dir, e), NUMERIC)
    z = FT.standardize(e.select("encounter_id", *NUMERIC), p, NUMERIC)
    return z.select("encounter_id", *[r6(c).alias(c) for c in NUMERIC])


_PAYER_VALUES = "PV as (select distinct nullif(payer_code, '?') as v from TRN where nullif(payer_code, '?') is not null)"


def _payer_query(spark, sf_dir, drop_first):
    e = clean.sentinel_to_null(encounters(spark, sf_dir))
    return FT.one_hot(e.select("encounter_id", "payer_code"), train_rows(spark, sf_dir, e), "payer_code", drop_first,
                      wide=True)


def _payer_sql(drop_first):
    # vocabulary fitted on train rows; the SQL twin lists the observed values
    vals = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    if drop_first:
        vals = vals[1:]
    cols = ", ".join(f"cast(coalesce(nullif(payer_code, '?') = '{v}', false) as int) as "
                     f"{FT.safe_name('payer_code_' + v)}" for v in vals)
    return sql_e(f"select encounter_id, {cols} from E")


@R.add("one_hot_payer", ["FN12", "T15"], _payer_sql(False))
def one_hot_payer(spark, sf_dir):
    return _payer_query(spark, sf_dir, False)


@R.add("one_hot_payer_drop_first", ["FN13"], _payer_sql(True))
def one_hot_payer_drop_first(spark, sf_dir):
    return _payer_query(spark, sf_dir, True)


_SERVE = list(FT.SERVING_FEATURES) + [f"los_{b}" for b in fx.LOS_LABELS]


@R.add("conform_requests", ["PRJ9", "JN3", "FN18"], sql_e(
    "select encounter_id, age as age_numeric, time_in_hospital, num_medications, num_procedures, num_diagnoses, "
    "glucose_level, cast(insulin as int) as insulin, case when coalesce(d.text, '') <> '' then 1 else 0 end as has_clinical_notes, "
    "age * num_medications as age_med_interaction, " + ", ".join(
        f"cast(coalesce(({_LOS_SQL}) = '{b}', false) as int) as los_{b}" for b in fx.LOS_LABELS) +
    ", 0 as glucose_missing from R left join documents d on d.doc_id = R.encounter_id",
    ctes=["R as (select encounter_id, cast(regexp_extract(age, '(\\d+)', 1) as int) + 5 as age, gender, "
          "time_in_hospital - 1 as time_in_hospital, num_medications, num_procedures, number_diagnoses as num_diagnoses, "
          "case when num_medications = 0 then null else total_charge / 1000 end as glucose_level, "
          "insulin <> 'No' as insulin from E)"]))
def conform_requests(spark, sf_dir):
    r = requests(spark, sf_dir)
    d = table(spark, sf_dir, "documents").select("doc_id", fx.has_text("text").alias("noted"))
    r = r.join(d, r.encounter_id == d.doc_id, "left")      # a flag crosses the join, not the text
    r = r.select("*", F.col("age").alias("age_numeric"),
                 F.coalesce("noted", F.lit(0)).alias("has_clinical_notes"),
                 (F.col("age") * F.col("num_medications")).alias("age_med_interaction"),
                 F.col("insulin").cast("int").alias("insulin_i"))
    r = r.drop("insulin").withColumnRenamed("insulin_i", "insulin")
    r = r.select("*", *fx.one_hot(fx.los_group("time_in_hospital"), fx.LOS_LABELS, "los"))
    return FT.conform(r, ["encounter_id"] + _SERVE + ["glucose_missing"])


@R.add("known_columns", ["PRJ3"], sql_e(
    "select encounter_id, time_in_hospital, num_lab_procedures, num_procedures, num_medications, number_outpatient, "
    "number_emergency, number_inpatient, number_diagnoses, age, insulin from E"))
def known_columns(spark, sf_dir):
    return FT.select_known(encounters(spark, sf_dir), keep=["encounter_id"])


@R.add("squared_columns", ["PRJ4", "FN6"], sql_e(
    "select encounter_id, diag_1, diag_2, num_lab_procedures * num_lab_procedures as num_lab_procedures_squared, "
    "num_medications * num_medications as num_medications_squared, "
    "number_diagnoses * number_diagnoses as number_diagnoses_squared from E"))
def squared_columns(spark, sf_dir):
    e = FT.engineered_features(encounters(spark, sf_dir))
    diag = FT.select_prefix(e, "diag_", 5).columns
    return e.select("encounter_id", *diag, *FT.select_prefix(e, suffix="_squared", limit=None).columns)


@R.add("advanced_selection", ["PRJ3", "PRJ4"], sql_e(
    "select encounter_id, time_in_hospital, num_lab_procedures, num_procedures, num_medications, number_outpatient, "
    "number_emergency, number_inpatient, number_diagnoses, age, insulin, num_medications * num_procedures as "
    "med_proc_interaction, round(num_medications / case when time_in_hospital = 0 then 1 else time_in_hospital end, 6) "
    "as med_per_day, case when cast(regexp_extract(age, '(\\d+)', 1) as int) + 5 > 60 then 1 else 0 end as is_elderly, "
    "number_outpatient + number_emergency + number_inpatient as total_encounters, "
    "case when number_diagnoses > 7 then 1 else 0 end as high_diag_complexity, diag_1, diag_2, "
    "num_lab_procedures * num_lab_procedures as num_lab_procedures_squared, "
    "num_medications * num_medications as num_medications_squared, "
    "number_diagnoses * number_diagnoses as number_diagnoses_squared from E"))
def advanced_selection(spark, sf_dir):
    e = FT.engineered_features(FT.structured_features(encounters(spark, sf_dir)))
    return FT.advanced_selection(e, keep=["encounter_id"]).withColumn("med_per_day", r6("med_per_day"))


@R.add("clinical_selection", ["PRJ5"], sql_e(
    "select encounter_id, age, race, gender, time_in_hospital, num_lab_procedures, num_procedures, num_medications, "
    "number_outpatient, number_emergency, number_inpatient, number_diagnoses, diag_1, diag_2 from E"))
def clinical_selection(spark, sf_dir):
    return FT.clinical_selection(encounters(spark, sf_dir), keep=["encounter_id"])


@R.add("numeric_projection", ["PRJ6"], sql_e(
    "select " + ", ".join(c for c in E_COLUMNS if c not in E_STRING and c != "admit_ts") + " from E"))
def numeric_projection(spark, sf_dir):
    return FT.numeric_only(encounters(spark, sf_dir))


_FM_BODY = (
    f"select s.encounter_id, s.age_numeric, s.comorbidity_count, s.age_med_interaction, " +
    ", ".join(f"cast(coalesce(s.los_group = '{b}', false) as int) as los_{b}" for b in fx.LOS_LABELS) + ", " +
    ", ".join(f"coalesce(cast(len(regexp_extract_all(coalesce(d.text, ''), '{p}')) as bigint), 0) as ent_{n}"
              for n, p in T.ENTITY_RULES) +
    ", s.readmitted_30d, " + ", ".join(f"Z.{c}" for c in NUMERIC) +
    " from (" + _STRUCT_SQL + ", case when readmitted = '<30' then 1 else 0 end as readmitted_30d from C) s "
    "join Z on Z.encounter_id = s.encounter_id left join documents d on d.doc_id = s.encounter_id")
_FM_CTES = [_MODE_PAYER, _CLEAN, *_SPLIT_CTES, *_TRAIN, _SCALER_SQL, f"Z as ({_SCALED_SQL})"]
ENTITY_COLUMNS = [f"ent_{n}" for n, _ in T.ENTITY_RULES]


def scaled_matrix(spark, sf_dir):
    """(matrix without texts, scaler parameters): structured features and all
    numeric columns scaled with the train rows' parameters, split and target."""
    s = structured(spark, sf_dir).withColumn("readmitted_30d", fx.label_from("readmitted"))
    s = split.stratified_split(FT.with_target(s), "readmitted_30d", "encounter_id")
    params = FT.scaler_params(s.where(F.col("split") == "train"), NUMERIC)
    num = FT.numeric_only(s, exclude=["patient_nbr"]).columns
    return FT.standardize(s.select(*num, "split"), params, NUMERIC), params


def with_entities(spark, sf_dir, matrix):
    ents = T.entity_counts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return matrix.join(ents, matrix.encounter_id == ents.doc_id, "left").drop("doc_id").fillna(0, ENTITY_COLUMNS)


@R.add("feature_matrix", ["PRJ7", "JN1", "JN2", "SRC4", "PRJ6", "R4"], sql_e(_FM_BODY, ctes=_FM_CTES))
def feature_matrix(spark, sf_dir):
    m = with_entities(spark, sf_dir, scaled_matrix(spark, sf_dir)[0])
    return m.select("encounter_id", "age_numeric", "comorbidity_count", "age_med_interaction",
                    *[f"los_{b}" for b in fx.LOS_LABELS], *ENTITY_COLUMNS, "readmitted_30d",
                    *[r6(c).alias(c) for c in NUMERIC])


@R.add("feature_table", ["SNK2", "SNK3", "SRC3", "SRC4", "JN1", "JN2", "ML12"])
def feature_table(spark, sf_dir):
    """The whole matrix with topics and entities, written by split; scaler,
    vocabulary and topic loadings are saved beside it.  The rows returned are
    made again from the source tables with the transforms that were read
    back, next to the row that was written."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = scratch_path(spark, os.path.join("features", uuid.uuid4().hex))
    matrix, params = scaled_matrix(spark, sf_dir)
    vocab, n_docs, loadings = T.fit_topics(docs, "doc_id", "text")
    for name, t in (("scaler", params), ("vocabulary", vocab), ("n_docs", n_docs), ("loadings", loadings)):
        t.write.parquet(os.path.join(base, name))

    def topics():
        saved = [spark.read.parquet(os.path.join(base, n)) for n in ("vocabulary", "n_docs", "loadings")]
        scores = T.topic_scores(docs, "doc_id", "text", *saved)
        ordered = F.sort_array(F.collect_list(F.struct("topic", r6("score").alias("score"))))
        return scores.groupBy("doc_id").agg(F.transform(ordered, lambda x: x["score"]).alias("topics"))

    t = topics()
    whole = with_entities(spark, sf_dir, matrix)
    whole = whole.join(t, whole.encounter_id == t.doc_id, "left").drop("doc_id")
    files.write_splits(whole, os.path.join(base, "matrix"))
    back = spark.read.parquet(os.path.join(base, "matrix"))
    again = FT.standardize(encounters(spark, sf_dir).select("encounter_id", *NUMERIC),
                           spark.read.parquet(os.path.join(base, "scaler")), NUMERIC)
    again = again.select(F.col("encounter_id").alias("id"), *[r6(c).alias(f"scored_{c}") for c in NUMERIC])
    return back.join(again, back.encounter_id == again.id).drop("id") \
        .select(*[r6(c).alias(c) if c in NUMERIC else F.col(c) for c in back.columns],
                *[f"scored_{c}" for c in NUMERIC])


@R.add("column_profile", ["PRJ8"], sql_e(" union all ".join(
    f"select '{c}' as col_name, case when {'true' if c in E_STRING else 'false'} or count(distinct {c}) < 10 "
    f"then 'categorical' else 'numeric' end as kind from E" for c in E_COLUMNS if c != "admit_ts")))
def column_profile(spark, sf_dir):
    e = encounters(spark, sf_dir).drop("admit_ts")
    return FT.column_profile(e)


@R.add("gender_codes", ["JN3", "R9"], sql_e(
    "select encounter_id, gender, case gender when 'Male' then 0 when 'Female' then 1 when 'Other' then 2 else 0 end "
    "as gender_code from E"))
def gender_codes(spark, sf_dir):
    e = encounters(spark, sf_dir)
    return e.select("encounter_id", "gender", fx.gender_code("gender").alias("gender_code"))


# Columns that are constant over the whole sf0.01 feature matrix: comorbidity
# (both diagnosis columns always present) and entity types that never occur.
# The Spark query decides from the data at any scale; SQL cannot return a
# data-dependent column set, so this twin lists the sf0.01 result (at sf0.001
# the PERCENT entity never occurs either and is dropped as well).
_FM_KEPT = ["encounter_id", "age_numeric", "age_med_interaction"] + [f"los_{b}" for b in fx.LOS_LABELS] + \
    ["ent_CARDINAL", "ent_EMAIL", "ent_PERCENT", "ent_PROPER", "readmitted_30d"] + NUMERIC


@R.add("drop_constant_features", ["PRJ2", "R15"], sql_e(
    "select " + ", ".join(_FM_KEPT) + " from (" + _FM_BODY + ") fm", ctes=_FM_CTES))
def drop_constant_features(spark, sf_dir):
    """PRJ2 over the whole feature matrix: min == max per column, one pass."""
    return clean.drop_constant(feature_matrix(spark, sf_dir))
