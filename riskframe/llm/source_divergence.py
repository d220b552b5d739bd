"""Source divergence audit: how far the sources of a language stand apart.

Terms are counted per (language, source).  Inside a task the terms of a batch
of texts are found with one table look-up per byte and packed by length: up to
8 bytes become one 64-bit word, up to 16 bytes two, and longer terms go to
separate buckets of bytes.  The words are radix-sorted and their runs counted;
the long buckets are sorted as bytes.  Partial counts are added up by Spark.

Shares are whole billionths, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and a
term's divergence is floor((p - q)^2 / (p + q)); all arithmetic is on integers.

Pairs of sources are summed in tiles: the kept terms of a language are dealt to
blocks, its sources to groups, and a task compares two groups of sources over
one block of terms.  Only sums per pair leave a tile.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import scratch_table

#: A-Z are lower-cased, a-z and all beyond ASCII stay, the rest separates (0).
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 0 for c in range(256))
#: Bytes of text that are packed and sorted at once (a longer text is one batch).
BATCH_BYTES = 4 << 20
#: Sources in one group, and cells (sources x terms) in one block of a tile, on average: at least
#: ``TILE_CELLS`` and so many times the pairs of the tile, whose sums leave it, that those stay few.
TILE_SOURCES, TILE_CELLS, CELLS_PER_PAIR = 256, 100_000, 16
MIN_DOCS, TOP_TERMS, SCALE = 10, 10, 1_000_000_000
U64 = np.uint64
#: Masks that keep the first 0..8 bytes of a big-endian word.
_KEEP = np.array([(2 ** 64 - 1) ^ (2 ** (64 - 8 * n) - 1) for n in range(8)] + [2 ** 64 - 1], dtype=U64)


# ------------------------------------------------------- counting inside tasks

def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by ``keys``, the most significant one first: least
    significant digit first, 16 bits at a time (numpy sorts 16-bit numbers by
    radix).  Digits in which all rows agree are skipped."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        digits = np.ascontiguousarray(key, dtype="<u8").view("<u2").reshape(-1, 4)
        for d in range(4):
            digit = digits[:, d]
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def count_runs(group: np.ndarray, words: list[np.ndarray], doc: np.ndarray):
    """(group, words, occurrences, documents) of every distinct (group, words).
    ``doc`` must rise from row to row."""
    if not len(group):
        return group, words, group, group
    order = radix_order([group.astype(U64), *words])
    keys = [group[order], *[w[order] for w in words]]
    doc = doc[order]
    change = np.ones(len(order), bool)
    change[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    new_doc = change.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(change)
    return keys[0][at], [k[at] for k in keys[1:]], np.diff(np.append(at, len(order))), \
        np.add.reduceat(new_doc.astype(np.int64), at)


def count_terms(texts: list[bytes], group: list[int]) -> Iterator[tuple]:
    """Yields (groups, terms, occurrences, documents) of the texts, one tuple
    for each length bucket; ``group[i]`` is the group of text i."""
    data = b" ".join(texts).translate(TERM_BYTES) + bytes(17)
    raw = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff((raw != 0).view(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return
    length = end - start
    first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    doc = np.searchsorted(first, start, side="right") - 1
    of_doc = np.asarray(group, np.int64)
    # the big-endian word that begins at every byte
    word = np.ndarray((len(raw) - 7,), ">u8", buffer=data, strides=(1,))
    short, middle, long = length <= 8, (length > 8) & (length <= 16), np.flatnonzero(length > 16)
    for bucket, size in ((short, 1), (middle, 2)):
        s, n, d = start[bucket], length[bucket], doc[bucket]
        words = [word[s + 8 * k].astype(U64) for k in range(size)]
        words[-1] &= _KEEP[n - 8 * (size - 1)]
        groups, words, times, docs = count_runs(of_doc[d], words, d)
        terms = np.stack(words, axis=1).astype(">u8").view(f"S{8 * size}").ravel()
        yield groups, terms.tolist(), times, docs
    buckets: dict[int, list] = {}
    for i in long.tolist():
        buckets.setdefault(int(of_doc[doc[i]]), []).append((data[start[i]:end[i]], int(doc[i])))
    for g, rows in buckets.items():
        rows.sort()
        runs = [(term, [d for _, d in run]) for term, run in groupby(rows, key=lambda r: r[0])]
        yield (np.full(len(runs), g), [t for t, _ in runs], np.array([len(d) for _, d in runs]),
               np.array([len(set(d)) for _, d in runs]))


def _batches(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes, at least one text each."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _count_batches(batches):
    import pyarrow.compute as pc
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                        ("times", pa.int64()), ("docs", pa.int64())])
    for b in batches:
        langs, sources = (b.column(i).to_pylist() for i in (0, 1))
        column = b.column(2).cast(pa.binary())
        names: dict[tuple, int] = {}
        group = [names.setdefault(k, len(names)) for k in zip(langs, sources)]
        lang_of, source_of = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        for lo, hi in _batches(pc.binary_length(column).to_pylist(), BATCH_BYTES):
            texts = column.slice(lo, hi - lo).to_pylist()
            for groups, terms, times, docs in count_terms(texts, group[lo:hi]):
                at = pa.array(groups, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [lang_of.take(at), source_of.take(at), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array(times, pa.int64()), pa.array(docs, pa.int64())], schema=schema)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, times, docs): occurrences and documents."""
    rows = _groups(docs, lang_col, source_col, docs[text_col].cast("string").alias("text")) \
        .select("lang", "source", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = rows.mapInArrow(_count_batches, "lang string, source string, term string, times long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))


def _groups(docs: DataFrame, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    text = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    return docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), *more)


# ------------------------------------------------------------------ divergence

def share(times, total, kept) -> Column:
    """p in billionths; decimal, as 10^9 (count + 2) can pass 2^63."""
    top = (times + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", top, (total + 2 * kept).cast("decimal(20,0)"))


def divergence(p, q) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(times: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """``share`` on arrays: long division, three decimal digits at a time, so
    that nothing passes 2^63 while total + 2 kept is under 9 * 10^15."""
    below = total + 2 * kept
    out, rest = np.divmod(times + 2, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return out + 1


def tile_sums(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of divergences over the columns, for all rows of left and right."""
    out = np.zeros((len(left), len(right)), np.int64)
    for i, p in enumerate(left):
        gap = p - right
        out[i] = (gap * gap // (p + right)).sum(axis=1)
    return out


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, lang_times) of the terms in enough documents."""
    return counts.groupBy("lang", "term").agg(F.sum("times").alias("lang_times"), F.sum("docs").alias("docs")) \
        .where(F.col("docs") >= min_docs).drop("docs")


def group_totals(groups: DataFrame, kept: DataFrame, terms: DataFrame) -> DataFrame:
    """Per occurring (lang, source): ``n`` its occurrences of kept terms,
    ``lang_n`` those of the language, ``v`` its kept terms, ``sources``."""
    own = kept.groupBy("lang", "source").agg(F.sum("times").alias("n"))
    whole = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(
        terms.groupBy("lang").agg(F.sum("lang_times").alias("lang_n"), F.count("*").alias("v")), "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return groups.join(own, ["lang", "source"], "left").join(whole, "lang") \
        .select("lang", "source", zero("n"), zero("lang_n"), zero("v"), "sources")


def top_terms(kept: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Terms that a source uses more than its language, the most divergent first."""
    p, q = share(F.col("times"), F.col("n"), F.col("v")), share(F.col("lang_times"), F.col("lang_n"), F.col("v"))
    rows = kept.join(totals, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")) \
        .where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                               divergence(F.col("p"), F.col("q")).alias("value"))
    return ranked(rows).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def pair_sums(kept: DataFrame, totals: DataFrame, tile_sources: int = TILE_SOURCES,
              tile_cells: int = TILE_CELLS) -> DataFrame:
    """(lang, one, other, value) for every unordered pair of a language's
    sources, without any row per (pair, term)."""
    groups = F.ceil(F.col("sources") / tile_sources)
    wide = F.least(F.col("sources"), F.lit(tile_sources))
    cells = F.greatest(F.lit(tile_cells), CELLS_PER_PAIR * wide * wide)
    blocks = F.greatest(F.ceil(F.col("v") * wide / cells), F.lit(1))
    placed = totals.select("lang", "source", "n", "v", groups.cast("int").alias("groups"),
                           blocks.cast("int").alias("blocks")) \
        .withColumn("own", F.pmod(F.xxhash64("source"), F.col("groups")).cast("int"))
    # the tiles of a source: its own group with every group, as (low, high)
    tiles = F.transform(F.sequence(F.lit(0), F.col("groups") - 1), lambda g: F.struct(
        F.least(g, F.col("own")).alias("low"), F.greatest(g, F.col("own")).alias("high")))
    members = placed.withColumn("tile", F.explode(tiles)) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("lang", "block", "tile.low", "tile.high", "source", "own", "n", "v")
    counts = kept.join(placed.select("lang", "source", "own", "groups", "blocks"), ["lang", "source"]) \
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")) \
        .withColumn("tile", F.explode(tiles)) \
        .select("lang", "block", "tile.low", "tile.high", "source", "term", "times")

    def compare(key, rows, sources):
        import pandas as pd
        lang, _, low, high = key
        sources = sources.sort_values("source", kind="stable")
        terms, term_at = np.unique(rows["term"].to_numpy(dtype=object), return_inverse=True)
        names = sources["source"].to_numpy(dtype=object)
        place = {s: i for i, s in enumerate(names)}
        times = np.zeros((len(names), len(terms)), np.int64)
        times[rows["source"].map(place).to_numpy(dtype=np.int64), term_at] = rows["times"].to_numpy(np.int64)
        v = int(sources["v"].iloc[0]) if len(sources) else 0
        p = shares(times, sources["n"].to_numpy(np.int64)[:, None], v) if v else times
        own = sources["own"].to_numpy()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        sums = tile_sums(p[left], p[right]) if len(terms) else np.zeros((len(left), len(right)), np.int64)
        i, j = np.nonzero((left[:, None] < right[None, :]) if low == high
                          else np.ones((len(left), len(right)), bool))
        text = lambda v: pd.Series(v, dtype=object)
        return pd.DataFrame({"lang": text([lang] * len(i)), "one": text(names[left[i]]),
                             "other": text(names[right[j]]), "value": sums[i, j]})

    keys = ["lang", "block", "low", "high"]
    parts = counts.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(
        compare, "lang string, one string, other string, value long")
    return parts.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): in part ``pair`` every other
    source of the language by divergence summed over its kept terms, in part
    ``term`` the ``top`` terms that the source uses more than its language.

    Terms are runs of letters, A-Z lower-cased, and kept where at least
    ``min_docs`` rows of the language hold them; repeated rows count each.
    Null text, language and source are ''.  A source without terms has counts
    of zero; a language without kept terms has divergences of 0, a language
    with one source no pairs.  An empty table gives no rows.
    """
    counts = scratch_table(term_counts(docs, text_col, lang_col, source_col), "terms")
    terms = scratch_table(kept_terms(counts, min_docs), "kept-terms")
    kept = scratch_table(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "times", "lang_times"),
                         "kept-counts")
    totals = scratch_table(group_totals(_groups(docs, lang_col, source_col).distinct(), kept, terms), "totals")
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    pairs = pair_sums(kept, totals).select("lang", both.alias("x"), "value") \
        .select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    return ranked(pairs).unionByName(top_terms(kept, totals, top))
