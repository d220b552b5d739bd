"""Quality scores from compression with dictionaries of good and bad text.

One zstandard dictionary is built from text labelled good and one from text
labelled bad.  A text that shrinks more with the good one is likely good: the
difference of the compressed sizes per byte of text becomes a probability by
logistic calibration on labelled rows that the dictionaries have not seen.
Nothing else of the text enters the score.

Fitting reads a bounded sample (``DICTIONARY_ROWS`` ids per class, one piece of
at most ``PIECE`` bytes of each; ``CALIBRATION_ROWS`` ids) in one scan; scoring
reads every whole text.  Rows of the held-out fold never take part in fitting.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import map_texts, scratch_table

DICTIONARY_ROWS, PIECE = 1024, 1024         # a dictionary of at most 1 MB per class
CALIBRATION_ROWS, LEVEL, CUT = 12_000, 6, 0.7
FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
#: Bytes added to a text's length, so that few bytes do not make a large difference.
SMOOTHING = 64
SIZES = [T.StructField(c, T.LongType()) for c in ("__n", "__good", "__bad")]


def fold(id_col):
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def compressed_sizes(dictionaries: tuple[bytes, bytes]):
    """texts -> (bytes, compressed with the good dictionary, with the bad one)."""
    state: list = []

    def make(d: bytes):
        import zstandard
        given = {"dict_data": zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if d else {}
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False,
                                        write_dict_id=False, **given).compress

    def fn(texts):
        if not state:
            state.extend(make(d) for d in dictionaries)
        return [[len(t or b"") for t in texts], *[[len(c(t or b"")) for t in texts] for c in state]]
    return fn


def features(n, good, bad) -> np.ndarray:
    """Intercept and the difference of the compressed sizes per 100 bytes."""
    n, good, bad = (np.asarray(x, np.float64) for x in (n, good, bad))
    return np.stack([np.ones_like(n), 100 * (bad - good) / (n + SMOOTHING)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton steps on the penalised log-likelihood (the intercept is free)."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[0] = np.log(share / (1 - share))
    if y.min() == y.max():
        return w
    free = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + free, x.T @ (y - p) - free @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality"):
    """((good, bad) dictionaries, weights) from the folds that are not held out.

    An id with labels of both kinds is left out; of several texts of one id
    the least is taken, so that the fit is the same in every run and reads at
    most one text of each chosen id.
    """
    y = labels[label_col].cast("int")
    marks = labels.where(y.isin(0, 1) & labels[id_col].isNotNull()).groupBy(labels[id_col].alias("__id")) \
        .agg(F.min(y).alias("__y"), F.max(y).alias("__most")).where("__y = __most") \
        .withColumn("__fold", fold(F.col("__id"))).where(F.col("__fold") != HELD_OUT) \
        .withColumn("__order", F.xxhash64(F.lit(17), "__id"))

    def chosen(part, where, rows):
        return marks.where(where).orderBy("__order", "__id").limit(rows) \
            .select("__id", "__y", F.lit(part).alias("__part"))

    calibration = F.col("__fold") == CALIBRATION
    # at most 2 * DICTIONARY_ROWS + CALIBRATION_ROWS ids: broadcast, so the texts are scanned once
    ids = chosen(1, ~calibration & (F.col("__y") == 1), DICTIONARY_ROWS) \
        .unionByName(chosen(0, ~calibration & (F.col("__y") == 0), DICTIONARY_ROWS)) \
        .unionByName(chosen(2, calibration, CALIBRATION_ROWS))
    base = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = scratch_table(base.join(F.broadcast(ids), base["id"] == ids["__id"]).where("text is not null")
                          .groupBy("id", "__y", "__part").agg(F.min("text").alias("text")), "quality-sample")
    raw = texts.where(F.col("__part") != 2).select("id", "__part", F.col("text").cast("binary").alias("b"))
    start = F.pmod(F.xxhash64(F.lit(23), "id"), F.greatest(F.octet_length("b") - PIECE + 1, F.lit(1)))
    pieces = raw.select("__part", "id", F.substring("b", start.cast("int") + 1, F.lit(PIECE)).alias("p")).collect()

    def dictionary(part):
        rows = sorted(((r["id"], bytes(r["p"])) for r in pieces if r["__part"] == part))
        return b"\n".join(p for _, p in rows)

    dictionaries = dictionary(1), dictionary(0)
    seen = map_texts(texts.where(F.col("__part") == 2), compressed_sizes(dictionaries), SIZES, "text", ["id", "__y"])
    rows = sorted(tuple(r) for r in seen.collect())
    table = np.array([r[1:] for r in rows], np.float64).reshape(-1, 4)
    return dictionaries, fit_logistic(features(*table[:, 1:].T), table[:, 0])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", cut: float = CUT) -> DataFrame:
    """Per document: ``held_out``, ``score`` (0 to 1, higher is better) and
    ``predicted`` (1 from ``cut`` on).

    A null text is an empty one, and an empty text gets the score of its
    (empty) compressed sizes.  Without labels of both kinds every score is the
    same.  A null id is in the fold of the empty string.  Repeated rows are
    scored each; an id with labels of both kinds teaches nothing.
    """
    dictionaries, weights = fit(docs, labels, id_col, text_col, label_col)
    sizes = compressed_sizes(dictionaries)

    def fn(texts):
        s = features(*sizes(texts)) @ weights
        return [(1 / (1 + np.exp(-np.clip(s, -30, 30)))).tolist()]

    got = map_texts(docs, fn, [T.StructField("score", T.DoubleType())], text_col, [id_col])
    return got.select(id_col, (fold(F.col(id_col)) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))
