"""Queries: drift between admissions before 1998 (reference) and after (current)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import drift as D
from riskframe.operators import metrics as M
from riskframe.operators import sketch as SK
from riskframe.plans.base import R, r6, sql_e
from riskframe.sources.encounters import drift_side, encounters, scored

FEATURES = ["time_in_hospital", "num_medications", "num_procedures", "num_lab_procedures",
            "number_diagnoses", "number_outpatient", "number_emergency", "number_inpatient",
            "total_charge"]


def sides(spark, sf_dir):
    e = encounters(spark, sf_dir).withColumn("side", drift_side())
    return e.where("side = 'ref'").drop("side"), e.where("side = 'cur'").drop("side")


def long_sides(spark, sf_dir):
    ref, cur = sides(spark, sf_dir)
    feats = D.common_columns(ref.select(*FEATURES), cur.select(*FEATURES))
    return D.stack_sides(ref, cur, feats), len(feats)


def per_feature(spark, sf_dir):
    long, n = long_sides(spark, sf_dir)
    return D.ks_drift(long), n


_SIDE = "case when admit_ts < timestamp '1998-01-01 00:00:00' then 'ref' else 'cur' end"
_LG = ("LG as (" + " union all ".join(
    f"select {_SIDE} as side, '{f}' as feature, cast({f} as double) as value from E" for f in FEATURES) + ")")
_VC = ("VC as (select feature, value, count_if(side = 'ref') as n_ref, count_if(side = 'cur') as n_cur "
       "from LG where value is not null and not isnan(value) group by 1, 2)")
_CU = ("CU as (select *, sum(n_ref) over (partition by feature order by value rows between unbounded preceding and current row) as cum_ref, "
       "sum(n_cur) over (partition by feature order by value rows between unbounded preceding and current row) as cum_cur, "
       "sum(n_ref) over (partition by feature) as tot_ref, sum(n_cur) over (partition by feature) as tot_cur from VC)")
_PF = ("PF as (select feature, max(abs(cum_ref / tot_ref - cum_cur / tot_cur)) as d, any_value(tot_ref) as n_ref, "
       "any_value(tot_cur) as n_cur from CU group by feature "
       "having count_if(n_ref > 0) > 1 and count_if(n_cur > 0) > 1)")
_KS = ("KS as (select feature, d as ks_statistic, case when lam < 0.2 then 1.0 else least(greatest(2 * "
       "list_sum(list_transform(range(1, 101), lambda k: (case when k % 2 = 1 then 1.0 else -1.0 end) * "
       "exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) end as p_value from "
       "(select *, sqrt(n_ref * n_cur / (n_ref + n_cur)) * d as lam from PF) x)")
_KS_CTES = [_LG, _VC, _CU, _PF, _KS]
_SUM = ("SM as (select count_if(p_value < 0.05) as drifted, coalesce(sum(1.0 - p_value), 0.0) as score_sum from KS)")


@R.add("drift_features", ["AGG20", "AGG21", "FLT3", "PRJ10", "SET2", "SRC6", "WIN2"], sql_e(
    "select feature, round(ks_statistic, 6) as ks_statistic, round(p_value, 6) as p_value, "
    "round(1.0 - p_value, 6) as drift_score, p_value < 0.05 as is_drift from KS", _KS_CTES))
def drift_features(spark, sf_dir):
    pf, _ = per_feature(spark, sf_dir)
    return pf.select("feature", r6("ks_statistic").alias("ks_statistic"), r6("p_value").alias("p_value"),
                     r6("drift_score").alias("drift_score"), "is_drift")


@R.add("drift_summary", ["AGG22", "T16", "SNK8"], sql_e(
    f"select cast(drifted as bigint) as drifted, cast({len(FEATURES)} as bigint) as features, "
    f"round(score_sum / {len(FEATURES)}, 6) as drift_score, round(drifted * 100.0 / {len(FEATURES)}, 6) as drift_percentage, "
    f"drifted > {len(FEATURES)} * 0.1 as overall_drift from SM", _KS_CTES + [_SUM]))
def drift_summary(spark, sf_dir):
    pf, n = per_feature(spark, sf_dir)
    s = D.drift_summary(pf, n)
    return s.select("drifted", "features", r6("drift_score").alias("drift_score"),
                    r6("drift_percentage").alias("drift_percentage"), "overall_drift")


@R.add("drift_top", ["TOP1"], sql_e(
    "select feature, round(1.0 - p_value, 6) as drift_score from KS order by 1.0 - p_value desc, feature limit 20",
    _KS_CTES))
def drift_top(spark, sf_dir):
    pf, _ = per_feature(spark, sf_dir)
    return D.top_drift(pf, 20).select("feature", r6("drift_score").alias("drift_score"))


@R.add("drift_histograms", ["AGG23", "TOP2"], sql_e(
    "select h.feature, h.side, h.bin, count(*) as n from (select LG.feature, LG.side, "
    "cast(case when r.hi = r.lo then 15 else least(floor((value - r.lo) / (r.hi - r.lo) * 30), 29) end as int) as bin "
    "from LG join (select feature, side, min(value) as lo, max(value) as hi from LG where value is not null group by 1, 2) r "
    "on r.feature = LG.feature and r.side = LG.side where value is not null) h "
    "where h.feature in (select feature from KS order by 1.0 - p_value desc, feature limit 5) group by 1, 2, 3",
    _KS_CTES))
def drift_histograms(spark, sf_dir):
    long, _ = long_sides(spark, sf_dir)
    top5 = D.top_drift(D.ks_drift(long), 5).select("feature")
    h = D.histograms(long.join(F.broadcast(top5), "feature", "left_semi"))  # at most 5 names
    return h.select("feature", "side", "bin", "n")


@R.add("ecdf_points", ["WIN2"], sql_e(
    "select feature, value, round(cum_ref / tot_ref, 6) as cdf_ref, round(cum_cur / tot_cur, 6) as cdf_cur from CU",
    _KS_CTES[:3]))
def ecdf_points(spark, sf_dir):
    long, _ = long_sides(spark, sf_dir)
    e = D.ecdf(long)
    return e.select("feature", "value", r6("cdf_ref").alias("cdf_ref"), r6("cdf_cur").alias("cdf_cur"))


@R.add("target_drift", ["AGG24"], sql_e(
    "select side, label, n, round(n / n_side, 6) as share, round(n_side * n_y / n_all, 6) as expected, "
    "round(pow(n - n_side * n_y / n_all, 2) / (n_side * n_y / n_all), 6) as chi2_part from "
    "(select *, sum(n) over (partition by side) as n_side, sum(n) over (partition by label) as n_y, "
    "sum(n) over () as n_all from (select side, label, count(*) as n from "
    f"(select {_SIDE} as side, case when readmitted = '<30' then 1 else 0 end as label from E) a group by 1, 2) b) c"))
def target_drift(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("side", drift_side())
    t = D.target_drift(s, "side", "label")
    return t.select("side", "label", "n", r6("share").alias("share"), r6("expected").alias("expected"),
                    r6("chi2_part").alias("chi2_part"))


@R.add("drift_alerts", ["FN27", "FN25", "ML17"], sql_e(
    "select 'drift' as kind, format('DATA DRIFT ALERT: Significant data drift detected with score {:.4f}. "
    f"{{:d}} features have drifted.', score_sum / {len(FEATURES)}, drifted) as message from SM "
    f"where drifted > {len(FEATURES)} * 0.1 union all "
    "select 'performance', format('PERFORMANCE ALERT: Model performance has degraded. AUC: {:.4f}', auc) from "
    "(select sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) as auc from "
    "(select *, sum(neg) over (order by score rows between unbounded preceding and current row) as cum_neg from "
    "(select score, count_if(label = 1) as pos, count_if(label = 0) as neg from S "
    f"where {_SIDE} = 'cur' group by score) q) u) a where auc < 0.7",
    _KS_CTES + [_SUM], views=("E", "S")))
def drift_alerts(spark, sf_dir):
    pf, n = per_feature(spark, sf_dir)
    summary = D.drift_summary(pf, n)
    cur = scored(spark, sf_dir).where(drift_side() == "cur")
    perf = M.auc(cur, "label", "score")
    return D.alerts(summary, perf)


_MONTH_CTES = [
    "ML as (" + " union all ".join(
        f"select cast(month(admit_ts) as int) as month, '{f}' as feature, cast({f} as double) as value, "
        f"case when year(admit_ts) = 1998 then 1 else 0 end as cur from E where year(admit_ts) in (1997, 1998)"
        for f in FEATURES) + ")",
    "MV as (select month, feature, value, sum(1 - cur) as a, sum(cur) as b from ML "
    "where value is not null and not isnan(value) group by 1, 2, 3)",
    "MC as (select *, sum(a) over w as ca, sum(b) over w as cb, sum(a) over (partition by month, feature) as n, "
    "sum(b) over (partition by month, feature) as m from MV "
    "window w as (partition by month, feature order by value rows between unbounded preceding and current row))",
    "MD as (select month, feature, cast(any_value(n) as bigint) as n, cast(any_value(m) as bigint) as m, "
    "cast(max(abs(ca * m - cb * n)) as bigint) as bound, max(abs(ca / n - cb / m)) as d from MC group by 1, 2 "
    "having count_if(a > 0) > 1 and count_if(b > 0) > 1)",
    # the walk: probability per i of having met nothing after s steps, and of having met the bound
    "WK as (select month, feature, n, m, bound, cast(0 as bigint) as s, [1.0::double] || "
    "list_transform(range(0, n), lambda i: 0.0::double) as q, 0.0::double as met from MD where greatest(n, m) <= 10000 union all "
    "select month, feature, n, m, bound, s + 1, list_transform(range(0, n + 1), lambda i: "
    "case when s + 1 - i not between 0 and m or abs(i * m - (s + 1 - i) * n) >= bound then 0.0 else z[i + 1] end), "
    "met + list_sum(list_transform(range(0, n + 1), lambda i: "
    "case when s + 1 - i between 0 and m and abs(i * m - (s + 1 - i) * n) >= bound then z[i + 1] else 0.0 end)) from "
    "(select *, list_transform(range(0, n + 1), lambda i: (q[i + 1] * greatest(m - s + i, 0) + "
    "case when i = 0 then 0.0 else q[i] * (n - i + 1) end) / (n + m - s)) as z from WK where s < n + m) w)",
    "MP as (select MD.*, case when greatest(MD.n, MD.m) <= 10000 then case when MD.bound = 0 then 1.0 else least(met, 1.0) end "
    "when lam < 0.2 then 1.0 else least(greatest(2 * list_sum(list_transform(range(1, 101), lambda k: "
    "(case when k % 2 = 1 then 1.0 else -1.0 end) * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) end as p_value from "
    "(select *, sqrt(cast(n as double) * m / (n + m)) * d as lam from MD) MD "
    "left join WK on WK.month = MD.month and WK.feature = MD.feature and WK.s = MD.n + MD.m)"]


@R.add("drift_monthly", ["AGG20", "AGG21", "FLT3"], sql_e(
    "select month, feature, round(d, 6) as ks_statistic, round(p_value, 6) as p_value, p_value < 0.05 as is_drift from MP",
    _MONTH_CTES).replace("with ", "with recursive ", 1))
def drift_monthly(spark, sf_dir):
    """Every month of 1998 against the same month of 1997, with exact p-values
    up to 10,000 admissions a month."""
    e = encounters(spark, sf_dir).where(F.year("admit_ts").isin(1997, 1998))
    long = (e.select(F.month("admit_ts").alias("month"),
                     F.when(F.year("admit_ts") == 1998, "cur").otherwise("ref").alias("side"),
                     *[F.col(c).cast("double").alias(c) for c in FEATURES])
             .unpivot(["month", "side"], FEATURES, "feature", "value"))
    pf = D.ks_drift(long, by=["month"], method="auto")
    return pf.select("month", "feature", r6("ks_statistic").alias("ks_statistic"), r6("p_value").alias("p_value"), "is_drift")


@R.add("sketch_profile", ["AGG4", "AGG7"])
def sketch_profile(spark, sf_dir):
    """Rows, distinct values and quartiles of the features, from sketches per
    admission year merged into one."""
    e = encounters(spark, sf_dir)
    long = (e.select(F.year("admit_ts").alias("year"), *[F.col(c).cast("double").alias(c) for c in FEATURES])
            .unpivot(["year"], FEATURES, "feature", "value"))
    return SK.sketch_profile(SK.merge_sketches(SK.column_sketches(long, ["year"])))
