"""Queries: ingest, cleaning, labels, profiles, codes, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import clean
from riskframe.plans.base import E_COLUMNS, E_NUMERIC, E_STRING, R, r6, sql_clean_select, sql_e
from riskframe.sources.encounters import encounters


def clean_encounters(spark, sf_dir):
    """E -> sentinel nulls -> sparse drop -> mode/median fill (whole-table fit)."""
    return clean.clean_table(clean.sentinel_to_null(encounters(spark, sf_dir)))


_MODE_PAYER = ("mode_payer as (select payer_code as v from E where payer_code <> '?' "
               "group by payer_code order by count(*) desc, payer_code limit 1)")
_LOS_SQL = ("case when time_in_hospital > 0 and time_in_hospital <= 3 then 'short' "
            "when time_in_hospital > 3 and time_in_hospital <= 7 then 'medium' "
            "when time_in_hospital > 7 and time_in_hospital <= 14 then 'long' "
            "when time_in_hospital > 14 then 'very_long' end")


@R.add("readmission_by_los_gender", ["SRC2", "PRJ1", "AGG5", "FN1", "FN9"], sql_e(f"""
select {_LOS_SQL} as los_group, gender, count(*) as n,
  cast(sum(case when readmitted = '<30' then 1 else 0 end) as bigint) as positives,
  round(avg(case when readmitted = '<30' then 1.0 else 0.0 end), 6) as rate
from E group by 1, 2"""))
def readmission_by_los_gender(spark, sf_dir):
    c = clean_encounters(spark, sf_dir)
    c = c.select(fx.label_from("readmitted").alias("label"),
                 fx.los_group().alias("los_group"), "gender")
    return c.groupBy("los_group", "gender").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("label").cast("bigint").alias("positives"),
        r6(F.avg(F.col("label").cast("double"))).alias("rate"))


def _union(parts):
    return "\nunion all\n".join(parts)


@R.add("null_share", ["SRC2", "AGG1"], sql_e(_union([
    f"select '{c}' as col_name, round(avg(case when "
    f"{'nullif(' + c + ", '?')" if c in E_STRING else c} is null then 1.0 else 0.0 end), 6)"
    f" as null_share from E" for c in E_COLUMNS])))
def null_share(spark, sf_dir):
    e = clean.sentinel_to_null(encounters(spark, sf_dir))
    return clean.null_share(e).select("col_name", r6("null_share").alias("null_share"))


@R.add("drop_sparse", ["PRJ1", "SRC2"], sql_e(f"select {sql_clean_select()} from E"))
def drop_sparse(spark, sf_dir):
    return clean.drop_sparse(clean.sentinel_to_null(encounters(spark, sf_dir)))


@R.add("missing_total", ["AGG2"], sql_e("select cast((" + " + ".join(
    f"count_if({'nullif(' + c + ", '?')" if c in E_STRING else c} is null)"
    for c in E_COLUMNS) + ") as bigint) as n_missing from E"))
def missing_total(spark, sf_dir):
    return clean.missing_total(clean.sentinel_to_null(encounters(spark, sf_dir)))


@R.add("column_modes", ["AGG3"], sql_e(_union([
    f"(select '{c}' as col_name, {c} as mode, count(*) as n from E where {c} <> '?' "
    f"group by {c} order by count(*) desc, {c} limit 1)" for c in E_STRING])))
def column_modes(spark, sf_dir):
    e = clean.sentinel_to_null(encounters(spark, sf_dir))
    return clean.modes(e, E_STRING).select("col_name", "mode", F.col("n").cast("bigint"))


@R.add("column_medians", ["AGG4"], sql_e(_union([
    f"select '{c}' as col_name, round(median(cast({c} as double)), 6) as median from E"
    for c in E_NUMERIC])))
def column_medians(spark, sf_dir):
    e = encounters(spark, sf_dir)
    return clean.medians(e, E_NUMERIC).select("col_name", r6("median").alias("median"))


@R.add("impute", ["AGG5", "JN4"], sql_e(
    f"select {sql_clean_select(fill={'payer_code': '(select v from mode_payer)'})} from E",
    ctes=[_MODE_PAYER]))
def impute(spark, sf_dir):
    return clean_encounters(spark, sf_dir)


@R.add("readmitted_counts", ["AGG6", "FN1"], sql_e(
    "select readmitted, case when readmitted = '<30' then 1 else 0 end as label, "
    "count(*) as n from E group by 1, 2"))
def readmitted_counts(spark, sf_dir):
    e = encounters(spark, sf_dir)
    return (e.groupBy("readmitted", fx.label_from("readmitted").alias("label"))
             .agg(F.count(F.lit(1)).alias("n")))


@R.add("distinct_counts", ["AGG7"], sql_e(_union([
    f"select '{c}' as col_name, count(distinct "
    f"{'nullif(' + c + ", '?')" if c in E_STRING else c}) as n_distinct from E"
    for c in E_COLUMNS])))
def distinct_counts(spark, sf_dir):
    e = clean.sentinel_to_null(encounters(spark, sf_dir))
    return clean.distinct_counts(e)


@R.add("label_counts", ["AGG9"], sql_e(
    "select case when readmitted = '<30' then 1 else 0 end as label, count(*) as n "
    "from E group by 1"))
def label_counts(spark, sf_dir):
    e = encounters(spark, sf_dir).select(fx.label_from("readmitted").alias("label"))
    return clean.value_counts(e, "label")


@R.add("imbalance_ratio", ["AGG8"], sql_e(
    "select count_if(readmitted <> '<30') as n_neg, count_if(readmitted = '<30') as n_pos, "
    "round(count_if(readmitted <> '<30') / count_if(readmitted = '<30'), 6) as ratio from E"))
def imbalance_ratio(spark, sf_dir):
    from riskframe.operators.balance import class_balance
    e = encounters(spark, sf_dir).select(fx.label_from("readmitted").alias("label"))
    return class_balance(e, "label").select("n_neg", "n_pos", r6("ratio").alias("ratio"))


@R.add("drop_constant_male", ["PRJ2"], sql_e(
    "select " + ", ".join(c for c in E_COLUMNS if c != "gender") +
    " from E where gender = 'Male'"))
def drop_constant_male(spark, sf_dir):
    e = encounters(spark, sf_dir).where(F.col("gender") == "Male")
    return clean.drop_constant(e)


_CODED = ["race", "gender", "age", "insulin", "payer_code", "diag_1", "diag_2"]


@R.add("category_codes", ["FN14", "WIN4"], sql_e(
    "select encounter_id, " + ", ".join(
        f"coalesce(k_{c}.code, -1) as {c}" for c in _CODED) +
    ", readmitted from C " + " ".join(
        f"left join k_{c} on k_{c}.v = C.{c}" for c in _CODED),
    ctes=[_MODE_PAYER,
          f"C as (select {sql_clean_select(fill={'payer_code': '(select v from mode_payer)'})} from E)"] +
         [f"k_{c} as (select v, cast(row_number() over (order by v) - 1 as int) as code "
          f"from (select distinct {c} as v from C where {c} is not null) d)" for c in _CODED]))
def category_codes(spark, sf_dir):
    c = clean_encounters(spark, sf_dir)
    coded = clean.encode_categories(c, _CODED)
    return coded.select("encounter_id", *_CODED, "readmitted")


_REQ_SQL = """
R as (select encounter_id,
  cast(regexp_extract(age, '(\\d+)', 1) as int) + 5 as age,
  gender,
  time_in_hospital - 1 as time_in_hospital,
  num_medications, num_procedures,
  number_diagnoses as num_diagnoses,
  case when num_medications = 0 then null else total_charge / 1000 end as glucose_level,
  insulin <> 'No' as insulin
from E)"""


def requests(spark, sf_dir):
    """Request records (F4 schema) derived from E: stay days after the admission
    day (so a 0-day stay is out of range) and no glucose for orders without
    line items (a missing required field)."""
    e = encounters(spark, sf_dir)
    return e.select(
        "encounter_id",
        fx.interval_midpoint("age").alias("age"),
        "gender",
        (F.col("time_in_hospital") - 1).alias("time_in_hospital"),
        "num_medications", "num_procedures",
        F.col("number_diagnoses").alias("num_diagnoses"),
        F.when(F.col("num_medications") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("total_charge") / 1000).alias("glucose_level"),
        (F.col("insulin") != "No").alias("insulin"))


@R.add("validate_requests", ["FLT1", "STR5"], sql_e(
    "select encounter_id, concat_ws(';', "
    "case when glucose_level is null then 'missing:glucose_level' end, "
    "case when age < 0 or age > 120 then 'range:age' end, "
    "case when time_in_hospital < 0 then 'range:time_in_hospital' end, "
    "case when num_medications < 0 then 'range:num_medications' end, "
    "case when num_procedures < 0 then 'range:num_procedures' end, "
    "case when num_diagnoses < 0 then 'range:num_diagnoses' end, "
    "case when gender not in ('Male', 'Female', 'Other') then 'allowed:gender' end) as violations, "
    "cast((glucose_level is null)::int + (age < 0 or age > 120)::int + (time_in_hospital < 0)::int"
    " + (num_medications < 0)::int + (num_procedures < 0)::int + (num_diagnoses < 0)::int"
    " + (gender not in ('Male', 'Female', 'Other'))::int as int) as n_violations from R",
    ctes=[_REQ_SQL]))
def validate_requests(spark, sf_dir):
    return clean.violations(requests(spark, sf_dir)).select(
        "encounter_id", "violations", "n_violations")
