"""Imports every plan module so its queries register, then exposes them."""

from __future__ import annotations

import functools
import importlib
import re

from riskframe.plans.base import R

_MODULES = ["clean", "split", "metrics", "drift", "text", "features", "model", "explain", "stream", "io"]


def _load():
    for m in _MODULES:
        importlib.import_module(f"riskframe.plans.{m}")


def _utc(fn):
    """Run a query builder in a UTC session: the driver tables hold
    timestamp_ntz values and daily windows / formatting must not shift."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def all_queries():
    _load()
    return {k: _utc(v) for k, v in R.queries.items()}


_COUNT_IF = re.compile(r"count_if\(([^()]*)\) as (\w+)")


def all_sql():
    """SQL twins; DuckDB's count_if is HUGEINT, so named counts are cast to
    BIGINT like Spark's."""
    _load()
    return {k: _COUNT_IF.sub(r"cast(count_if(\1) as bigint) as \2", v) for k, v in R.sql.items()}


def survey_ids():
    _load()
    return dict(R.ids)
