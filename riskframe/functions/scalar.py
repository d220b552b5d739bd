"""Scalar feature expressions.  Each returns a ``Column``; all are codegen-able
built-ins so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
POSITIVE_LABEL = "<30"                       # readmitted within 30 days
LOS_EDGES = (0, 3, 7, 14, float("inf"))      # length-of-stay bins, right-closed
LOS_LABELS = ("short", "medium", "long", "very_long")
AGE_EDGES = (0, 30, 50, 70, float("inf"))    # subgroup age bins, right-closed
AGE_LABELS = ("<30", "30-50", "50-70", ">70")
COMORB_EDGES = (0, 1, 3, float("inf"))       # subgroup comorbidity bins, right-closed
COMORB_LABELS = ("None", "Few", "Many")
RISK_BANDS = ((0.3, "Low"), (0.7, "Medium"))  # below 0.3 Low, below 0.7 Medium, else High
RISK_TOP = "High"
GENDER_CODES = (("Male", 0), ("Female", 1), ("Other", 2))  # serving-time map, unknown -> 0
AGE_DEFAULT = 50                             # no digits in the age interval
AGE_OFFSET = 5                               # interval start + 5 = midpoint
ELDERLY_AGE = 60
COMPLEX_DIAGNOSES = 7
NOTE_PREFIX_CHARS = 1000                     # optional cap the reference used for tagging


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_from(c, positive: str = POSITIVE_LABEL) -> Column:
    """FN1: 1 when the outcome string equals ``positive``, else 0 (null -> 0)."""
    return F.coalesce((col_(c) == F.lit(positive)).cast("int"), F.lit(0))


def interval_midpoint(c, default: int = AGE_DEFAULT, offset: int = AGE_OFFSET) -> Column:
    """FN2: first integer of an interval string plus ``offset``; no digits -> default."""
    first = F.regexp_extract(col_(c).cast("string"), r"(\d+)", 1)
    return (F.when(col_(c).isNull() | (first == ""), F.lit(default))
            .otherwise(first.cast("int") + F.lit(offset)))


def truthy_count(cols: Sequence[str], numeric: bool = False) -> Column:
    """FN3: per row, number of columns holding a value (non-null, non-empty; or non-zero)."""
    if not cols:
        return F.lit(0)
    if numeric:
        parts = [F.coalesce((F.col(c) != 0).cast("int"), F.lit(0)) for c in cols]
    else:
        parts = [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 0).otherwise(1)
                 for c in cols]
    return reduce(add, parts)


def safe_ratio(a, b) -> Column:
    """FN5: a / b with a zero denominator replaced by 1."""
    den = col_(b)
    return col_(a) / F.when(den == 0, F.lit(1)).otherwise(den)


def row_sum(cols: Sequence[str], skip_nulls: bool = True) -> Column:
    """FN7: row-wise sum; ``skip_nulls`` mirrors ``sum(axis=1)``, else null propagates."""
    parts = [F.coalesce(F.col(c), F.lit(0)) if skip_nulls else F.col(c) for c in cols]
    return reduce(add, parts) if parts else F.lit(0)


def flag(c, threshold) -> Column:
    """FN8: 1 when value > threshold."""
    return (col_(c) > F.lit(threshold)).cast("int")


def bin_right_closed(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """FN9/FN10: label of the (lo, hi] interval holding the value; outside -> null."""
    x = col_(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(lo)
        if hi != float("inf"):
            cond = cond & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def los_group(c="time_in_hospital") -> Column:
    return bin_right_closed(c, LOS_EDGES, LOS_LABELS)


def age_group(c="age_numeric") -> Column:
    return bin_right_closed(c, AGE_EDGES, AGE_LABELS)


def comorbidity_group(c="comorbidity_count", reference_form: bool = False) -> Column:
    """FN10 with the fix R12: 0 -> None, 1..3 -> Few, >3 -> Many.  The reference's
    (0,1]/(1,3]/(3,inf) form is kept behind ``reference_form``."""
    if reference_form:
        return bin_right_closed(c, COMORB_EDGES, COMORB_LABELS)
    x = col_(c)
    return (F.when(x == 0, "None").when((x >= 1) & (x <= 3), "Few")
             .when(x > 3, "Many"))


def one_hot(c, values: Sequence[str], prefix: str | None = None) -> list[Column]:
    """FN11: one 0/1 column per vocabulary value; unknown/null -> all zeros."""
    p = prefix or (c if isinstance(c, str) else "oh")
    return [F.coalesce((col_(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{p}_{v}")
            for v in values]


def standardize(c, mean: float, std: float) -> Column:
    """FN15: (x - mean) / population std; a constant column maps to 0."""
    if std is None or std == 0:
        return (col_(c) - F.lit(mean if mean is not None else 0.0)) * F.lit(0.0)
    return (col_(c) - F.lit(mean)) / F.lit(std)


def decision(p, threshold: float = 0.5) -> Column:
    """FN16: 1 when probability >= threshold."""
    return (col_(p) >= F.lit(threshold)).cast("int")


def risk_band(p) -> Column:
    """FN17: Low / Medium / High."""
    x = col_(p)
    expr = None
    for hi, lab in RISK_BANDS:
        expr = F.when(x < F.lit(hi), lab) if expr is None else expr.when(x < F.lit(hi), lab)
    return expr.otherwise(RISK_TOP)


def has_text(c) -> Column:
    """FN18: 1 when the text is non-empty."""
    return (F.coalesce(col_(c), F.lit("")) != "").cast("int")


def text_or_empty(c) -> Column:
    """FN19: null text -> ''."""
    return F.coalesce(col_(c), F.lit(""))


def truncate(c, n: int = NOTE_PREFIX_CHARS) -> Column:
    """FN20: first ``n`` characters (an optional cost cap; queries use whole texts)."""
    return F.substring(col_(c), 1, n)


def gender_code(c="gender") -> Column:
    """JN3: serving-time category map; unknown -> 0."""
    m = F.create_map(*[x for k, v in GENDER_CODES for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[col_(c)], F.lit(0)).cast("int")


def request_id(ts) -> Column:
    """FN23: compact time id ``P%Y%m%d%H%M%S``."""
    return F.concat(F.lit("P"), F.date_format(col_(ts), "yyyyMMddHHmmss"))


def iso_time(ts) -> Column:
    """FN24: ISO-8601 text of a timestamp."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss")
