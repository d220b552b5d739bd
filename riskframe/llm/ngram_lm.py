"""Stupid-backoff scores from n-gram counts of the whole corpus.

score(w | context) = count(context w) / count(context) if the n-gram occurs,
else 0.4 times the score with one context word fewer; a single word has its
share of all tokens.  Counts leave the scored document out, so a text is not
fluent for repeating itself and the backoff is at work on the corpus itself.

The joins run on packed rows: the exploded n-grams of a block of documents are
one row per (block, hash bucket) with its distinct hashes and counts, so the
count table of a bucket is made in one task from pre-aggregated rows, however
often an n-gram occurs; the totals return to the block, where the logarithms
are summed per document.  Blocks and buckets have bounded size; their numbers
grow with the corpus.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import map_texts
from riskframe.llm.words import U64, alnum_words, mix, word_hashes

ORDER, ALPHA = 3, 0.4
#: Text bytes per block of documents, and n-grams per hash bucket.
BLOCK_BYTES, BUCKET_GRAMS = 4_000_000, 4_000_000
#: Hashes have so many bits more than it takes to number the corpus' n-grams:
#: an unseen n-gram is taken for another with probability 2 ** -SPARE_BITS.
SPARE_BITS = 24
_COEF = mix(np.arange(701, 709, dtype=U64)) | U64(1)


def hash_bits(grams: int) -> int:
    return min(64, max(grams, 1).bit_length() + SPARE_BITS)


def gram_hashes(words: np.ndarray, order: int, bits: int = 64) -> np.ndarray:
    """Hashes of the runs of ``order`` words, by their first word."""
    n = len(words) - order + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, order, U64)
    for k in range(order):
        out += words[k:n + k] * _COEF[k]
    return mix(out) >> U64(64 - bits)


def bucket_edges(grams: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """Where each bucket (an equal range of hashes) starts in sorted hashes."""
    step = 2 ** bits // buckets
    return np.searchsorted(grams, np.arange(1, buckets, dtype=U64) * U64(step)) if buckets > 1 \
        else np.zeros(0, np.int64)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, byte planes apart, compressed."""
    import zstandard
    v = np.ascontiguousarray(values, U64).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(v.T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(U64).ravel()


class Block:
    """The n-grams of a block of documents."""

    def __init__(self, texts, order: int, bits: int = 64):
        words = [word_hashes(w) if (w := alnum_words(t)) else np.zeros(0, U64) for t in texts]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.order = order
        parts = [[gram_hashes(w, k, bits) for w in words] for k in range(1, order + 1)]
        flat = [np.concatenate(p) if p else np.zeros(0, U64) for p in parts]
        self.grams, place, self.counts = np.unique(np.concatenate(flat), return_inverse=True, return_counts=True)
        ends = np.cumsum([len(f) for f in flat])[:-1]
        #: for each order the number of every n-gram, document after document
        self.place = np.split(place, ends)
        self.sizes = [np.array([len(x) for x in p], np.int64) for p in parts]

    def left_out(self, totals: np.ndarray) -> list[np.ndarray]:
        """Counts of every n-gram without its own document."""
        out = []
        for place, sizes in zip(self.place, self.sizes):
            doc = np.repeat(np.arange(len(sizes)), sizes)
            _, pair, own = np.unique(doc * max(len(self.grams), 1) + place, return_inverse=True, return_counts=True)
            out.append(totals[place] - own[pair])
        return out

    def scores(self, totals: np.ndarray, tokens: int, alpha: float) -> np.ndarray:
        """Sum of the log scores per document."""
        count = self.left_out(totals)
        n_docs = len(self.lengths)
        first = np.concatenate([[0], np.cumsum(self.lengths)])
        doc = np.repeat(np.arange(n_docs), self.lengths)
        rest = np.maximum(tokens - self.lengths, 0)[doc]
        log = np.log(np.maximum(count[0], 1)) - np.log(rest + 1.0)       # an unseen word counts as one
        within = np.arange(len(doc)) - first[doc]
        for k in range(2, self.order + 1):
            at = np.flatnonzero(within >= k - 1)                         # words with k - 1 words before them
            c, context = count[k - 1], count[k - 2]
            # the n-gram ending at word i starts at i - k + 1; documents have k - 1 fewer of them
            mine = at - (k - 1) - _missing(self.lengths, k)[doc[at]]
            before = at - 1 - (k - 2) - _missing(self.lengths, k - 1)[doc[at]]
            seen = c[mine] > 0
            log[at] = np.where(seen, np.log(np.maximum(c[mine], 1)) - np.log(np.maximum(context[before], 1)),
                               math.log(alpha) + log[at])
        out = np.zeros(n_docs)
        np.add.at(out, doc, log)
        return out


def _missing(lengths: np.ndarray, k: int) -> np.ndarray:
    """n-grams of order ``k`` fewer than words in the documents before each."""
    lost = np.minimum(lengths, k - 1)
    return np.cumsum(lost) - lost


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
              alpha: float = ALPHA, block_bytes: int = BLOCK_BYTES, bucket_grams: int = BUCKET_GRAMS) -> DataFrame:
    """Per row: ``n_tokens``, ``log_score`` (sum of natural logarithms) and
    ``mean_log_score`` (null without tokens).

    A null or empty text has no tokens and log score 0.  Rows are scored each;
    a copy in another row counts as another document.  Rows with a null id are
    scored like others.
    """
    base = docs.select(docs[id_col], docs[text_col].cast("string").alias("text"))
    size = map_texts(base, lambda ts: [[len(alnum_words(t)) for t in ts], [len(t or b"") for t in ts]],
                     [T.StructField("words", T.LongType()), T.StructField("bytes", T.LongType())], "text", []) \
        .agg(F.sum("words").alias("words"), F.sum("bytes").alias("bytes")).first()
    tokens, n_bytes = size["words"] or 0, size["bytes"] or 0
    blocks = max(1, math.ceil(n_bytes / block_bytes))
    buckets = max(1, math.ceil(tokens * order / bucket_grams))
    bits = hash_bits(tokens * order)
    row = base.withColumn("block", F.pmod(F.xxhash64(F.col(id_col), F.col("text")), F.lit(blocks)).cast("int")) \
        .select("block", F.col(id_col), F.col("text").cast("binary").alias("text"))

    def explode(pdf):
        import pandas as pd
        b = Block(pdf["text"], order, bits)
        cut = bucket_edges(b.grams, buckets, bits)
        return pd.DataFrame({
            "bucket": np.arange(buckets, dtype=np.int32), "block": int(pdf["block"].iloc[0]),
            "grams": [pack(np.diff(g, prepend=U64(0))) for g in np.split(b.grams, cut)],
            "counts": [pack(c) for c in np.split(b.counts, cut)]})

    def count(pdf):
        import pandas as pd
        grams = [np.cumsum(unpack(g), dtype=U64) for g in pdf["grams"]]
        counts = [unpack(c).astype(np.int64) for c in pdf["counts"]]
        _, place = np.unique(np.concatenate(grams), return_inverse=True)
        own = np.concatenate(counts)
        total = np.bincount(place, weights=own).astype(np.int64)[place] if len(own) else own
        others = np.split(total - own, np.cumsum([len(g) for g in grams])[:-1])
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "others": [pack(o) for o in others]})

    def score(left, right):
        import pandas as pd
        b = Block(left["text"], order, bits)
        parts = [unpack(x).astype(np.int64) for x in right.sort_values("bucket")["others"]]
        totals = b.counts + np.concatenate(parts)
        log = b.scores(totals, tokens, alpha)
        n = b.lengths
        return pd.DataFrame({id_col: left[id_col], "n_tokens": n, "log_score": log,
                             "mean_log_score": [x / k if k else None for x, k in zip(log, n)]})

    exploded = row.groupBy("block").applyInPandas(explode, "bucket int, block int, grams binary, counts binary")
    totals = exploded.groupBy("bucket").applyInPandas(count, "block int, bucket int, others binary")
    out = T.StructType([base.schema.fields[0], T.StructField("n_tokens", T.LongType()),
                        T.StructField("log_score", T.DoubleType()), T.StructField("mean_log_score", T.DoubleType())])
    return row.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(score, out)
