"""Shared pieces of the training-data operators.

Conventions: an operator selects the columns that it needs before anything
else, so extra columns (also ones named like its results) do no harm; a null
text has no words, and a null id stays null in the result.
"""

from __future__ import annotations

import atexit
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import shared_dir

_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read it
    back: later steps scan only the columns they need, and a lost executor
    costs a read.  ``drop_scratch`` (also run when the driver ends) removes
    these tables."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _SCRATCH:
        atexit.register(drop_scratch)
    _SCRATCH.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch() -> None:
    """Delete the scratch tables written so far; results that read them must
    have been written by then."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        if spark.sparkContext._jsc is None:
            continue
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def map_texts(df: DataFrame, fn, fields: list[T.StructField], text_col: str = "text",
              carry: list[str] | None = None) -> DataFrame:
    """Apply ``fn(list of UTF-8 texts) -> list of columns`` to Arrow batches.

    The result has the ``carry`` columns unchanged, followed by ``fields``.
    Nothing is shuffled.
    """
    carry = list(df.columns) if carry is None else carry
    src = df.select(*[df[c] for c in carry], df[text_col].cast("binary").alias("__text"))
    if text_col in carry:      # do not send the text twice
        src = df.select(*[df[c] for c in carry])
    at = src.columns.index(text_col if text_col in carry else "__text")
    keep = [i for i, c in enumerate(src.columns) if c != "__text"]
    schema = T.StructType([src.schema.fields[i] for i in keep] + fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        made = list(to_arrow_schema(T.StructType(fields)))
        for b in batches:
            texts = b.column(at).cast(pa.binary()).to_pylist()
            new = fn(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in keep] + [pa.array(v, f.type) for v, f in zip(new, made)],
                schema=pa.schema([b.schema.field(i) for i in keep] + made))

    return src.mapInArrow(run, schema)


def sha_of(column):
    """Lowercase hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(column.cast("binary"), 256)
