"""Cleaning: sentinel nulls, sparse/constant column drops, profiles, imputation,
category codes and record validation.

Every per-column statistic is one multi-expression aggregate or one unpivot +
grouped aggregate -- never one Spark job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, NumericType, StringType

from riskframe.operators.prefix import rank_within, running_sum

SENTINEL = "?"          # fixed value: the reference's missing marker
SPARSE_SHARE = 0.5      # fixed value: drop when null share is strictly above this
BROADCAST_CODES = 1_000_000   # largest code table sent to every task


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ6: numeric columns in table order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def sentinel_to_null(df: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """SRC2: the sentinel string becomes null in every string column."""
    cols = set(string_columns(df))
    return df.select(*[F.nullif(F.col(c), F.lit(sentinel)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def null_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG1: (col_name, null_share) from one aggregate pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "col_name", "null_share")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(col_name, n_null) from one aggregate pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "col_name", "n_null")


def missing_total(df: DataFrame) -> DataFrame:
    """AGG2: total number of missing cells."""
    return null_counts(df).agg(F.sum("n_null").cast("bigint").alias("n_missing"))


def sparse_columns(df: DataFrame, threshold: float = SPARSE_SHARE) -> list[str]:
    """Columns whose null share is strictly above ``threshold`` (T1).  The driver
    receives one number per column only."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_sparse(df: DataFrame, threshold: float = SPARSE_SHARE) -> DataFrame:
    """PRJ1: drop columns with null share > threshold."""
    return df.drop(*sparse_columns(df, threshold))


def null_share_map(df: DataFrame) -> dict[str, float]:
    """One aggregate pass: column -> null share (one number per column)."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return {c: row[c] for c in df.columns}


def clean_table(df: DataFrame, threshold: float = SPARSE_SHARE, fit: DataFrame | None = None) -> DataFrame:
    """PRJ1 + AGG5 in one profile: a single null-share pass decides both which
    columns are dropped (share > threshold) and which remaining columns need a
    fitted fill; modes / medians are computed only for those columns."""
    shares = null_share_map(fit if fit is not None else df)
    keep = [c for c in df.columns if not (shares[c] is not None and shares[c] > threshold)]
    out = df.select(*keep)
    need = [c for c in keep if shares[c]]
    if not need:
        return out
    src = (fit if fit is not None else df).select(*need)
    params = impute_params(src)          # strings and numbers; other types keep their nulls
    return impute(out, params=params)


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """PRJ2 test: at most one distinct non-null value <=> min == max (or all null).
    Exact, one pass, no shuffle of values."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}")]
    row = df.agg(*aggs).first()
    return [c for c in cols if row[f"mn_{c}"] is None or row[f"mn_{c}"] == row[f"mx_{c}"]]


def drop_constant(df: DataFrame, fit: DataFrame | None = None) -> DataFrame:
    """PRJ2: drop constant columns, decided on ``fit`` (train) when given (R15)."""
    return df.drop(*constant_columns(fit if fit is not None else df, df.columns))


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_name, value) for the given columns, values as strings, nulls removed."""
    return (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], list(cols), "col_name", "value")
              .where(F.col("value").isNotNull()))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG7: exact non-null distinct count per column.  Values are deduplicated
    map-side per (col_name, value) before the shuffle, then counted per column."""
    cols = list(cols or df.columns)
    return (_long_values(df, cols).distinct()
            .groupBy("col_name").agg(F.count(F.lit(1)).alias("n_distinct")))


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """AGG6 / AGG9: (value, n) for one column, nulls included as a group."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG3: most frequent non-null value per column, ties -> smallest value (T5).

    Two grouped aggregates and a join -- no window, so a column with huge
    cardinality is spread over all tasks instead of one."""
    counts = _long_values(df, cols).groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("col_name").agg(F.max("n").alias("n"))
    return (counts.join(top, ["col_name", "n"], "inner")
                  .groupBy("col_name").agg(F.min("value").alias("mode"), F.first("n").alias("n")))


def medians(df: DataFrame, cols: Sequence[str], slices: int | None = None) -> DataFrame:
    """AGG4: exact interpolated median per numeric column (median of 1..4 is 2.5).

    Counts per distinct value, a skew-safe running count, then the values at
    positions floor((n+1)/2) and ceil((n+1)/2) are averaged."""
    vals = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot([], list(cols), "col_name", "value")
              .where(F.col("value").isNotNull() & ~F.isnan("value"))
              .groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n")))
    j = running_sum(vals, ["col_name"], ["value"], ["n"], slices=slices, totals=True)
    lo = F.floor((F.col("tot_n") + 1) / 2)
    hi = F.ceil((F.col("tot_n") + 1) / 2)
    return j.groupBy("col_name").agg(
        ((F.min(F.when(F.col("cum_n") >= lo, F.col("value"))) +
          F.min(F.when(F.col("cum_n") >= hi, F.col("value")))) / 2).alias("median"))


def impute_params(fit: DataFrame, cat_cols: Sequence[str] | None = None,
                  num_cols: Sequence[str] | None = None) -> dict[str, object]:
    """AGG5 fit: mode for string columns, median for numeric ones.  Returns one
    value per column (bounded by the column count)."""
    cat_cols = list(string_columns(fit) if cat_cols is None else cat_cols)
    num_cols = list(numeric_columns(fit) if num_cols is None else num_cols)
    params: dict[str, object] = {}
    if cat_cols:
        for r in modes(fit, cat_cols).collect():
            params[r["col_name"]] = r["mode"]
    if num_cols:
        for r in medians(fit, num_cols).collect():
            params[r["col_name"]] = r["median"]
    return params


def impute(df: DataFrame, fit: DataFrame | None = None, cat_cols=None, num_cols=None,
           params: dict | None = None) -> DataFrame:
    """AGG5 apply: ``coalesce(col, fitted value)``.  An integer column that gets
    a median becomes double, as a median need not be whole; other values are
    cast to the column type.  Parameters are fitted on ``fit`` (train, R3) or
    on ``df``."""
    if params is None:
        params = impute_params(fit if fit is not None else df, cat_cols, num_cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in params and params[c] is not None:
            kind = DoubleType() if isinstance(types[c], IntegralType) else types[c]
            out.append(F.coalesce(F.col(c).cast(kind), F.lit(params[c]).cast(kind)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def code_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """WIN4 fit: (col_name, value, code) with dense alphabetical codes 0..n-1 per
    column, from the distinct values (never a window over raw rows)."""
    d = _long_values(df, cols).distinct()
    return (rank_within(d, ["col_name"], ["value"], out="code")
            .withColumn("code", (F.col("code") - 1).cast("int")))


def encode_categories(df: DataFrame, cols: Sequence[str], codes: DataFrame | None = None,
                      missing_code: int = -1) -> DataFrame:
    """FN14: replace each string column with its alphabetical code (null -> -1).
    One count of the codes per column (one row per column returned) tells which
    tables have at most ``BROADCAST_CODES`` rows and are broadcast; a larger one
    is left to a shuffle join."""
    codes = codes if codes is not None else code_table(df, cols)
    sizes = {r["col_name"]: r["count"] for r in codes.groupBy("col_name").count().collect()}
    out = df
    for c in cols:
        t = (codes.where(F.col("col_name") == c)
                  .select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}")))
        if sizes.get(c, 0) <= BROADCAST_CODES:
            t = F.broadcast(t)
        out = out.join(t, out[c].cast("string") == t[f"__v_{c}"], "left")
    return out.select(*[F.coalesce(F.col(f"__c_{c}"), F.lit(missing_code)).alias(c)
                        if c in set(cols) else F.col(c) for c in df.columns])


# Request validation rules (F4 record).
AGE_RANGE = (0, 120)
ALLOWED_GENDERS = ("Male", "Female", "Other")
NON_NEGATIVE = ("time_in_hospital", "num_medications", "num_procedures", "num_diagnoses")
REQUIRED = ("age", "gender", "time_in_hospital", "num_medications", "num_procedures",
            "num_diagnoses", "glucose_level", "insulin")


def violations(df: DataFrame, required=REQUIRED, non_negative=NON_NEGATIVE,
               age_range=AGE_RANGE, genders=ALLOWED_GENDERS) -> DataFrame:
    """FLT1: adds ``violations`` (rule names joined by ';', '' when valid) and
    ``n_violations``.  Rules: required present, age in range, counts >= 0,
    gender in the allowed set."""
    rules = []
    for c in required:
        if c in df.columns:
            rules.append(F.when(F.col(c).isNull(), F.lit(f"missing:{c}")))
    if "age" in df.columns:
        rules.append(F.when((F.col("age") < age_range[0]) | (F.col("age") > age_range[1]),
                            F.lit("range:age")))
    for c in non_negative:
        if c in df.columns:
            rules.append(F.when(F.col(c) < 0, F.lit(f"range:{c}")))
    if "gender" in df.columns:
        rules.append(F.when(F.col("gender").isNotNull() & ~F.col("gender").isin(*genders),
                            F.lit("allowed:gender")))
    arr = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return df.withColumn("violations", F.array_join(arr, ";")) \
             .withColumn("n_violations", F.size(arr).cast("int"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT1 routing: (valid rows, quarantined rows with their violations)."""
    v = violations(df)
    return v.where("n_violations = 0").drop("violations", "n_violations"), v.where("n_violations > 0")
