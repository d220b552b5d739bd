"""Fitted preprocessing as Spark ML stages (ML11): exact median fill and
population scaling of numbers, most-frequent fill and one-hot vectors of
categories.  The models hold their parameters as ML params, so a saved
``PipelineModel`` holds them too; applying them is column arithmetic and the
JVM's own indexer and encoder, without a join or a Python worker.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.operators import clean

#: Categories of one column beyond which a fit stops with an error: the model holds them all.
MAX_CATEGORIES = 1_000_000


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Input and output columns, one for one."""


class _Fitted(_Columns):
    fitWhere = Param(Params._dummy(), "fitWhere", "SQL condition on the rows that are fitted on; '' for all",
                     TypeConverters.toString)

    def _fit_rows(self, df: DataFrame) -> DataFrame:
        where = self.getOrDefault(self.fitWhere)
        return df.where(where) if where else df


def _number(c: str):
    """The column as double, NaN as null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


class NumericPrep(Estimator, _Fitted):
    """Fits exact medians, then means and population deviations of the filled
    columns.  A column without any value is filled with 0."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fitWhere=""):
        super().__init__()
        self._setDefault(fitWhere="")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NumericPrepModel:
        cols = self.getInputCols()
        rows = self._fit_rows(dataset).select(*[_number(c).alias(c) for c in cols])
        found = {r["col_name"]: r["median"] for r in clean.medians(rows, cols).collect()}
        medians = [float(found.get(c) or 0.0) for c in cols]
        filled = [F.coalesce(F.col(c), F.lit(m)) for c, m in zip(cols, medians)]
        row = rows.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)],
                       *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)]).first()
        each = range(len(cols))
        return NumericPrepModel(inputCols=cols, outputCols=self.getOutputCols(), medians=medians,
                                means=[float(row[f"m{i}"] or 0.0) for i in each],
                                deviations=[float(row[f"s{i}"] or 0.0) for i in each])


class NumericPrepModel(Model, _Columns):
    """(x or median - mean) / deviation; 0 where the deviation is 0."""

    medians = Param(Params._dummy(), "medians", "fill per column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean per filled column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviation per filled column",
                       TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, medians=None, means=None, deviations=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def slots(self) -> list[str]:
        return list(self.getInputCols())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fits = zip(self.getInputCols(), self.getOutputCols(), *[self.getOrDefault(p) for p in (
            self.medians, self.means, self.deviations)])
        return dataset.withColumns({out: fx.standardize(F.coalesce(_number(c), F.lit(med)), mean, std)
                                    for c, out, med, mean, std in fits})


class CategoryPrep(Estimator, _Fitted):
    """Fits the sorted categories of every column and, with ``fill``, its most
    frequent one (the smallest of equally frequent ones), which replaces
    nulls.  ``dropFirst`` leaves the first category without a slot."""

    fill = Param(Params._dummy(), "fill", "replace nulls by the most frequent category", TypeConverters.toBoolean)
    dropFirst = Param(Params._dummy(), "dropFirst", "no slot for the first category", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fill=True, dropFirst=False, fitWhere=""):
        super().__init__()
        self._setDefault(fitWhere="", fill=True, dropFirst=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryPrepModel:
        cols = self.getInputCols()
        counts = clean._long_values(self._fit_rows(dataset), cols).groupBy("col_name", "value") \
            .agg(F.count(F.lit(1)).alias("n"))
        values: dict[str, list] = {c: [] for c in cols}
        for r in counts.toLocalIterator():
            found = values[r["col_name"]]
            found.append((r["value"], r["n"]))
            if len(found) > MAX_CATEGORIES:
                raise ValueError(f"{r['col_name']}: more than {MAX_CATEGORIES} categories")
        first = int(self.getOrDefault(self.dropFirst))
        labels = {c: sorted(v for v, _ in found)[first:] for c, found in values.items()}
        modes = {c: min(found, key=lambda x: (-x[1], x[0]))[0] for c, found in values.items()
                 if found and self.getOrDefault(self.fill)}
        return CategoryPrepModel(inputCols=cols, outputCols=self.getOutputCols(), labels=json.dumps(labels),
                                 modes=json.dumps(modes))


class CategoryPrepModel(Model, _Columns):
    """One sparse vector per column, a slot for every label; null (where it is
    not filled), unseen and dropped categories are all zeros."""

    labels = Param(Params._dummy(), "labels", "JSON: categories with a slot, per column", TypeConverters.toString)
    modes = Param(Params._dummy(), "modes", "JSON: fill per column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labels=None, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def categories(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.labels))

    def slots(self) -> list[str]:
        labels = self.categories()
        return [f"{c}_{v}" for c in self.getInputCols() for v in labels[c]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        labels, modes = self.categories(), json.loads(self.getOrDefault(self.modes))
        pairs = list(zip(self.getInputCols(), self.getOutputCols()))
        # a column without slots (one category, and that dropped) is an empty vector
        none = array_to_vector(F.array().cast("array<double>"))
        out = dataset.withColumns({o: none.alias(o, metadata={"ml_attr": {"num_attrs": 0}})
                                   for c, o in pairs if not labels[c]})
        pairs = [(c, o) for c, o in pairs if labels[c]]
        if not pairs:
            return out
        texts, codes = [f"__{o}_text" for _, o in pairs], [f"__{o}_code" for _, o in pairs]
        # a literal fill per column; F.lit(None) leaves the nulls to the unknown slot
        out = out.withColumns({t: F.coalesce(F.col(c).cast("string"), F.lit(modes.get(c)))
                               for (c, _), t in zip(pairs, texts)})
        indexed = out
        for (c, _), text, code in zip(pairs, texts, codes):
            indexed = StringIndexerModel.from_labels(labels[c], inputCol=text, outputCol=code,
                                                     handleInvalid="keep").transform(indexed)
        # the indexer's metadata names the slots, so this fit runs no job
        encoder = OneHotEncoder(inputCols=codes, outputCols=[o for _, o in pairs], dropLast=True)
        return encoder.fit(indexed).transform(indexed).drop(*texts, *codes)
