"""Queries: stratified split, split sizes, folds, inner split, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import split
from riskframe.plans.base import R, sql_e
from riskframe.sources.encounters import encounters


def labelled(spark, sf_dir):
    e = encounters(spark, sf_dir)
    return e.withColumn("label", fx.label_from("readmitted"))


_RANK = ("K as (select encounter_id, label, row_number() over (partition by label order by "
         "md5(cast(encounter_id as varchar) || '{seed}'), encounter_id) as srank from {src})")
_LAB = "L as (select *, case when readmitted = '<30' then 1 else 0 end as label from E)"


def _apportion_sql(src, ncol, pct, out):
    return (f"(select *, q + (row_number() over (order by rem desc, label) <= k - sum(q) over ())"
            f"::bigint as {out} from (select *, sum({ncol}) over () as tot, "
            f"cast(ceil(sum({ncol}) over () * {pct} / 100.0) as bigint) as k, "
            f"cast(floor(cast(ceil(sum({ncol}) over () * {pct} / 100.0) as bigint) * {ncol} / "
            f"(sum({ncol}) over ())) as bigint) as q, "
            f"(cast(ceil(sum({ncol}) over () * {pct} / 100.0) as bigint) * {ncol}) % "
            f"(sum({ncol}) over ()) as rem from {src}) a)")


_CUTS = [
    "N as (select label, count(*) as n_c from L group by label)",
    f"T as (select label, n_c, n_test, n_c - n_test as n_tv from {_apportion_sql('N', 'n_c', 20, 'n_test')} t)",
    f"V as (select label, n_test, n_val from {_apportion_sql('T', 'n_tv', 25, 'n_val')} v)",
]
_SPLIT_BODY = ("select K.encounter_id, K.label, case when srank <= n_test then 'test' "
               "when srank <= n_test + n_val then 'val' else 'train' end as split "
               "from K join V on K.label = V.label")
_SPLIT_CTES = [_LAB, _RANK.format(seed=42, src="L")] + _CUTS


@R.add("stratified_split", ["SMP3", "WIN5"], sql_e(_SPLIT_BODY, ctes=_SPLIT_CTES))
def stratified_split(spark, sf_dir):
    s = split.stratified_split(labelled(spark, sf_dir), "label", "encounter_id")
    return s.select("encounter_id", "label", "split")


@R.add("split_sizes", ["SMP3", "T12"], sql_e(
    "select split, label, count(*) as n from (" + _SPLIT_BODY + ") s group by 1, 2",
    ctes=_SPLIT_CTES))
def split_sizes(spark, sf_dir):
    s = split.stratified_split(labelled(spark, sf_dir), "label", "encounter_id")
    return s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@R.add("kfold_ids", ["SMP5"], sql_e(
    "select encounter_id, label, cast((srank - 1) % 5 as int) as fold from K",
    ctes=[_LAB, _RANK.format(seed=42, src="L")]))
def kfold_ids(spark, sf_dir):
    return split.kfold(labelled(spark, sf_dir), "label", "encounter_id", k=5).select(
        "encounter_id", "label", "fold")


_INNER_CTES = _SPLIT_CTES + [
    "TR as (select L.* from L join (" + _SPLIT_BODY + ") s on s.encounter_id = L.encounter_id "
    "where s.split = 'train')",
    _RANK.format(seed=7, src="TR").replace("K as", "K2 as"),
    "N2 as (select label, count(*) as n_c from TR group by label)",
    f"H as (select label, n_hold from {_apportion_sql('N2', 'n_c', 20, 'n_hold')} h)",
]


@R.add("inner_split", ["SMP4"], sql_e(
    "select K2.encounter_id, K2.label, case when srank <= n_hold then 'holdout' else 'fit' end "
    "as part from K2 join H on K2.label = H.label", ctes=_INNER_CTES))
def inner_split(spark, sf_dir):
    s = split.stratified_split(labelled(spark, sf_dir), "label", "encounter_id")
    tr = s.where(F.col("split") == "train")
    return split.two_way_split(tr, "label", "encounter_id", hold_pct=20, seed=7).select(
        "encounter_id", "label", "part")


@R.add("seeded_sample", ["SMP1"], sql_e(
    "select encounter_id, patient_nbr, total_charge, readmitted from E order by "
    "md5(cast(encounter_id as varchar) || '42'), encounter_id limit 1000"))
def seeded_sample(spark, sf_dir):
    e = encounters(spark, sf_dir)
    return split.seeded_sample(e, "encounter_id", 1000).select(
        "encounter_id", "patient_nbr", "total_charge", "readmitted")


@R.add("detail_sample", ["SMP2"], sql_e(
    "select encounter_id, readmitted from E order by "
    "md5(cast(encounter_id as varchar) || '11'), encounter_id limit 10"))
def detail_sample(spark, sf_dir):
    e = encounters(spark, sf_dir)
    return split.seeded_sample(e, "encounter_id", 10, seed=11).select("encounter_id", "readmitted")
