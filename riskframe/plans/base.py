"""Shared pieces for registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.sources.encounters import with_views

E_COLUMNS = ["encounter_id", "patient_nbr", "race", "gender", "age", "time_in_hospital",
             "num_medications", "num_procedures", "num_lab_procedures", "number_diagnoses",
             "number_outpatient", "number_emergency", "number_inpatient", "insulin",
             "payer_code", "weight", "diag_1", "diag_2", "total_charge", "admit_ts",
             "readmitted"]
E_STRING = ["race", "gender", "age", "insulin", "payer_code", "weight", "diag_1", "diag_2",
            "readmitted"]
E_NUMERIC = ["encounter_id", "patient_nbr", "time_in_hospital", "num_medications",
             "num_procedures", "num_lab_procedures", "number_diagnoses", "number_outpatient",
             "number_emergency", "number_inpatient", "total_charge"]


class Registry:
    """Collects (name -> spark callable) and (name -> SQL) pairs."""

    def __init__(self):
        self.queries = {}
        self.sql = {}
        self.ids = {}

    def add(self, name, ids, sql=None):
        def deco(fn):
            self.queries[name] = fn
            self.ids[name] = ids
            if sql is not None:
                self.sql[name] = sql
            return fn
        return deco


R = Registry()


def r6(c):
    """Round a float result to 6 places (both engines round the same way)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def sql_e(body, ctes=(), views=("E",)):
    """SQL body over E (and S) plus extra CTEs."""
    if not views:
        return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body
    s = with_views("", views)
    if ctes:
        s = s.rstrip() + ",\n" + ",\n".join(ctes) + "\n"
    return s + body


def sql_clean_select(exclude=("weight",), fill=None):
    """SELECT list for E after sentinel->null, with optional fill expressions."""
    fill = fill or {}
    parts = []
    for c in E_COLUMNS:
        if c in exclude:
            continue
        x = f"nullif({c}, '?')" if c in E_STRING else c
        if c in fill:
            x = f"coalesce({x}, {fill[c]})"
        parts.append(f"{x} as {c}")
    return ", ".join(parts)
