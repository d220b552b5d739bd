"""Encounter (E) and scored-encounter (S) views derived from the driver tables.

``orders`` plays the encounter, ``customer`` the patient and the next order of
the same customer the return visit.  The DataFrame form is what queries use;
``E_SQL`` / ``S_SQL`` are the same definitions as text, for the SQL twins.

Plan shape: lineitem is summed per (order, supplier) and then per order, in
tasks of a bounded number of lines, and joined to orders on the order key; the
next visit comes from a skew-safe ``lead`` over range slices of (customer, date,
order); the customer table and the per-user event aggregates are then joined on
the customer key (AQE broadcasts them when small, sort-merge otherwise).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.prefix import lead_within
from riskframe.session import materialize, snapshot
from riskframe.sources.tables import table, table_path

# Fixed values shared with the SQL twin (FIXTURES.md section 3).
DRIFT_CUTOFF = "1998-01-01 00:00:00"   # reference side = admit_ts before this
SCORE_LEVELS = 1000                    # distinct deterministic scores

LINES_PER_TASK = 500_000               # line items whose sums one task holds


def line_totals(lines: DataFrame, rows_per_task: int = LINES_PER_TASK) -> DataFrame:
    """Per order: its items, distinct suppliers and quantity.  Nearly every
    (order, supplier) is a row of its own, so summing before the shuffle only
    fills a hash table with all rows of an input split, and a shuffle of a fixed
    number of partitions gives each task a share that grows with the table.
    The lines are dealt by (order, supplier) instead, which spreads a hot order
    over its suppliers, and the sums by order, each to as many partitions as
    the lines fill: a task holds about ``rows_per_task`` of them at any size."""
    n = max(lines.sparkSession.sparkContext.defaultParallelism, math.ceil(lines.count() / rows_per_task))
    pairs = (lines.select("l_orderkey", "l_suppkey", "l_quantity")
             .repartition(n, "l_orderkey", "l_suppkey")
             .groupBy("l_orderkey", "l_suppkey")
             .agg(F.count(F.lit(1)).alias("n_items"), F.sum("l_quantity").alias("qty")))
    return (pairs.repartition(n, "l_orderkey")
            .groupBy("l_orderkey")
            .agg(F.sum("n_items").alias("n_items"),
                 F.count("l_suppkey").alias("n_supp"),
                 F.sum("qty").alias("qty")))


def _side_tables(spark: SparkSession, sf_dir: str):
    li = line_totals(table(spark, sf_dir, "lineitem"))
    ev = (table(spark, sf_dir, "events")
          .groupBy("user_id")
          .agg(F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("n_click"),
               F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("n_error"),
               F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("n_purchase")))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return li, ev, cust


ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
              "o_orderdate")


SOURCES = ("orders", "lineitem", "customer", "events")
_MEMO: dict = {}


def clear_cache() -> None:
    """Forget materialised encounter tables (the bench times every query cold)."""
    _MEMO.clear()


def source_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Session and state of the files that E is made of."""
    return (spark.sparkContext.applicationId, snapshot(spark, *(table_path(sf_dir, n) for n in SOURCES)))


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E, written once per session and state of its input files as a Parquet
    table in the shared folder: almost every consumer makes several passes
    (profile, fit, rank, final plan), each pass would otherwise repeat the
    three joins and the line-item aggregation, and reads only its columns."""
    key = source_key(spark, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = materialize(_encounters(spark, sf_dir), "encounters")
    return _MEMO[key]


def _encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, ev, cust = _side_tables(spark, sf_dir)
    # next visit of the same customer: a skew-safe lead (a customer with a third
    # of all orders is spread over many tasks instead of one), on the order
    # columns only, so the joins below stay prunable
    o = lead_within(table(spark, sf_dir, "orders").select(*ORDER_COLS),
                    ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "next_ts")
    o = (o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
          .join(cust, F.col("c_custkey") == F.col("o_custkey"), "inner")
          .join(ev, F.col("user_id") == F.col("o_custkey"), "left"))
    return _columns(o, with_outcome=True)


def encounter_features(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """E without the outcome, for an arriving (possibly streaming) ``orders``
    frame: stream-static joins to the per-order, per-customer and per-user
    aggregates; the outcome needs the customer's next visit and is not known
    at arrival.  The aggregates are written once per state of the input files,
    so a micro-batch reads them instead of all line items and events."""
    key = ("sides", source_key(spark, sf_dir))
    if key not in _MEMO:
        _MEMO[key] = tuple(materialize(t, "encounter_sides") for t in _side_tables(spark, sf_dir))
    li, ev, cust = _MEMO[key]
    o = (orders.select(*ORDER_COLS)
         .join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
         .join(cust, F.col("c_custkey") == F.col("o_custkey"), "inner")
         .join(ev, F.col("user_id") == F.col("o_custkey"), "left"))
    return _columns(o, with_outcome=False)


def _columns(o: DataFrame, with_outcome: bool) -> DataFrame:
    key = F.col("o_orderkey")
    ck = F.col("o_custkey")
    age_lo = ((ck % 10) * 10).cast("string")
    age_hi = ((ck % 10) * 10 + 10).cast("string")
    return o.select(
        key.alias("encounter_id"),
        ck.alias("patient_nbr"),
        F.col("c_mktsegment").alias("race"),
        F.when(ck % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(F.lit("["), age_lo, F.lit("-"), age_hi, F.lit(")")).alias("age"),
        (key % 20).cast("int").alias("time_in_hospital"),
        F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("num_medications"),
        F.coalesce(F.col("n_supp"), F.lit(0)).cast("bigint").alias("num_procedures"),
        F.coalesce(F.col("qty"), F.lit(0)).cast("double").alias("num_lab_procedures"),
        (F.lit(1) + key % 11).cast("int").alias("number_diagnoses"),
        F.coalesce(F.col("n_click"), F.lit(0)).cast("bigint").alias("number_outpatient"),
        F.coalesce(F.col("n_error"), F.lit(0)).cast("bigint").alias("number_emergency"),
        F.coalesce(F.col("n_purchase"), F.lit(0)).cast("bigint").alias("number_inpatient"),
        F.when(key % 4 == 0, "No").when(key % 4 == 1, "Steady")
         .when(key % 4 == 2, "Up").otherwise("Down").alias("insulin"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "?")
         .otherwise(F.col("o_orderpriority")).alias("payer_code"),
        F.when(key % 10 < 7, "?").otherwise(F.col("o_orderstatus")).alias("weight"),
        F.col("o_orderstatus").alias("diag_1"),
        F.col("c_mktsegment").alias("diag_2"),
        F.col("o_totalprice").alias("total_charge"),
        F.col("o_orderdate").alias("admit_ts"),
        *([F.when(F.col("next_ts").isNull(), "NO")
           .when(F.col("next_ts") < F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), "<30")
           .otherwise(">30").alias("readmitted")] if with_outcome else []),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E plus a 0/1 label and a deterministic score with 1000 levels (many ties)."""
    e = encounters(spark, sf_dir)
    return e.select(
        "*",
        F.when(F.col("readmitted") == "<30", 1).otherwise(0).alias("label"),
        ((F.col("encounter_id") * 37 + F.col("patient_nbr") * 11) % SCORE_LEVELS)
        .cast("double").__truediv__(F.lit(float(SCORE_LEVELS))).alias("score"),
    )


def drift_side(col="admit_ts"):
    """'ref' before the cut-off, 'cur' from it on."""
    return F.when(F.col(col) < F.lit(DRIFT_CUTOFF).cast("timestamp_ntz"), "ref").otherwise("cur")


E_SQL = """
select o.o_orderkey as encounter_id,
  o.o_custkey as patient_nbr,
  c.c_mktsegment as race,
  case when o.o_custkey % 2 = 0 then 'Female' else 'Male' end as gender,
  concat('[', cast((o.o_custkey % 10) * 10 as varchar(10)), '-', cast((o.o_custkey % 10) * 10 + 10 as varchar(10)), ')') as age,
  cast(o.o_orderkey % 20 as int) as time_in_hospital,
  cast(coalesce(li.n_items, 0) as bigint) as num_medications,
  cast(coalesce(li.n_supp, 0) as bigint) as num_procedures,
  cast(coalesce(li.qty, 0) as double) as num_lab_procedures,
  cast(1 + o.o_orderkey % 11 as int) as number_diagnoses,
  cast(coalesce(ev.n_click, 0) as bigint) as number_outpatient,
  cast(coalesce(ev.n_error, 0) as bigint) as number_emergency,
  cast(coalesce(ev.n_purchase, 0) as bigint) as number_inpatient,
  case when o.o_orderkey % 4 = 0 then 'No' when o.o_orderkey % 4 = 1 then 'Steady'
       when o.o_orderkey % 4 = 2 then 'Up' else 'Down' end as insulin,
  case when o.o_orderpriority = '1-URGENT' then '?' else o.o_orderpriority end as payer_code,
  case when o.o_orderkey % 10 < 7 then '?' else o.o_orderstatus end as weight,
  o.o_orderstatus as diag_1,
  c.c_mktsegment as diag_2,
  o.o_totalprice as total_charge,
  o.o_orderdate as admit_ts,
  case when o.next_ts is null then 'NO'
       when o.next_ts < o.o_orderdate + interval '30' day then '<30'
       else '>30' end as readmitted
from (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
        lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as next_ts
      from orders) o
join customer c on c.c_custkey = o.o_custkey
left join (select l_orderkey, count(*) as n_items, count(distinct l_suppkey) as n_supp,
             sum(l_quantity) as qty from lineitem group by l_orderkey) li
  on li.l_orderkey = o.o_orderkey
left join (select user_id,
    sum(case when event_type = 'click' then 1 else 0 end) as n_click,
    sum(case when event_type = 'error' then 1 else 0 end) as n_error,
    sum(case when event_type = 'purchase' then 1 else 0 end) as n_purchase
  from events group by user_id) ev on ev.user_id = o.o_custkey
"""

S_SQL = """
select E.*,
  case when readmitted = '<30' then 1 else 0 end as label,
  cast((encounter_id * 37 + patient_nbr * 11) % 1000 as double) / 1000 as score
from E
"""


def with_views(body: str, views=("E", "S")) -> str:
    """Prefix a SQL body with the E (and S) CTEs so DuckDB can run it on base tables."""
    parts = []
    if "E" in views or "S" in views:
        parts.append(f"E as ({E_SQL})")
    if "S" in views:
        parts.append(f"S as ({S_SQL})")
    return "with " + ",\n".join(parts) + "\n" + body
