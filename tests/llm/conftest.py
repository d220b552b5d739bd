import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents-like table from texts (ids from 0) or (id, text) pairs."""
    def make(texts, source="s"):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", source, len(t) if t is not None else None) for i, t in rows], DOCS)
    return make


@pytest.fixture
def odd(spark):
    """Rows every operator must stand: nulls anywhere, empty and long texts,
    repeated rows, and extra columns named like results."""
    rows = [(1, "plain words in a row " * 20, "en", "a", 5), (1, "plain words in a row " * 20, "en", "a", 5),
            (2, "", None, None, None), (3, None, "en", "a", None), (None, "text without an id", "en", None, 3),
            (None, None, None, None, None), (4, "été ñandú 漢字 😀 " * 3000, "fr", "b", 7), (5, " \n\t ", "en", "b", 4),
            (6, "word " * 40_000, "en", "b", 200_000)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    return df.select("*", F.lit(7).alias("n_words"), F.lit("x").alias("kept"), F.lit(0.5).alias("score"),
                     F.lit("y").alias("host"), F.lit(3).alias("copy"), F.lit(1).alias("h1"))
