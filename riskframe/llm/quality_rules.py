"""Quality rules: statistics per text, hard rules, and an isolation forest.

One pass over the texts gives the rule statistics.  The forest grows random
splits over a bounded sample of them; a text that few splits set apart has a
short path and a high anomaly score.  Statistics vary among good texts too, so
forests are also grown over how far a statistic lies outside of the range that
all but a small share of the rows labelled good keep to (``SHARES_OUTSIDE``);
the forest that tells the labelled rows apart best is taken.  The cut is calibrated on labelled rows of
both kinds: the best balanced accuracy at which at most ``balanced_loss`` of
the rows labelled good are lost.  Without rows labelled bad it is the lowest
score above which at most ``max_good_loss`` of the good ones would be lost.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import map_texts, scratch_table

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Bounds of the fit: rows sampled (lowest hash of the id), trees, rows per tree.
SAMPLE_ROWS, TREES, TREE_ROWS = 8192, 100, 256
MAX_GOOD_LOSS = 0.002
#: Bound on the good rows lost where labelled bad rows show what the cut catches.
BALANCED_LOSS = 0.05
BINS = 10_000
#: Shares of the good rows below and above the ranges that are tried (None: the
#: statistics themselves, first of equals), steps of the statistics in which
#: ranges are found, least width of a range, and most widths outside of one.
SHARES_OUTSIDE = (None, 0.05, 0.005)
RANGE_STEP, LEAST_WIDTH, MOST_WIDTHS = 1e-4, 0.01, 50.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "punct_share", "word_length", "type_share"]
FIELDS = [T.StructField(c, T.LongType()) for c in COUNTS] + \
         [T.StructField("features", T.ArrayType(T.DoubleType()))]


def _classes() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for c in range(256):
        if c in b" \t\n\r\x0b\x0c":
            out[c] = 1
        elif c in SYMBOLS:
            out[c] = 2
        elif 65 <= c <= 90:
            out[c] = 3
        elif 48 <= c <= 57:
            out[c] = 4
        elif 0x80 <= c <= 0xBF:      # inside a character
            out[c] = 6
        elif c < 128 and not 97 <= c <= 122:
            out[c] = 5
    return out


_CLASS = _classes().astype(np.uint8)


def repeated_words(ids: np.ndarray) -> int:
    """Positions inside 3-word windows that occur twice or more in the text."""
    n = len(ids)
    if n < 4:
        return 0
    _, pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    _, code, count = np.unique(pair[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    again = count[code] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= again
    return int(hit.sum())


def statistics(text: bytes | None) -> tuple:
    """The five counts and the feature vector of one text."""
    words = text.split() if text else []
    if not words:
        return (0, 0, 0, 0, 0, [0.0] * len(FEATURES))
    n = len(words)
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=7)
    chars = int(len(text) - kinds[6] - kinds[1])
    numbers: dict[bytes, int] = {}
    ids = np.array(list(map(numbers.setdefault, words, itertools.count())), np.int64)
    repeat = repeated_words(ids)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    # the share of distinct words falls with length: compared at the root of the length
    types = len(numbers) / n ** 0.75
    feats = [kinds[2] / chars, dup / len(lines), repeat / n, kinds[3] / chars, kinds[4] / chars,
             kinds[5] / chars, min(chars / n, 100.0), min(types, 10.0)]
    return (n, chars, int(kinds[2]), dup, repeat, [float(x) for x in feats])


def _stat_columns(texts):
    return [list(c) for c in zip(*map(statistics, texts))] if texts else [[] for _ in FIELDS]


def rule_statistics(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    return map_texts(docs, _stat_columns, FIELDS, text_col, carry)


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


# ---------------------------------------------------------------- the forest

def _c(n: float) -> float:
    """Mean path of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> dict:
    """Random isolation trees as flat arrays (feature -1: leaf)."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth = max(1, math.ceil(math.log2(max(rows, 2))))
    feat, cut, left, path, roots = [], [], [], [], []

    def node():
        for v in (feat, cut, left, path):
            v.append(0)
        return len(feat) - 1

    for _ in range(trees if len(x) else 0):
        todo = [(node(), x[rng.choice(len(x), rows, replace=False)], 0)]
        roots.append(todo[0][0])
        while todo:
            at, part, d = todo.pop()
            lo, hi = part.min(0), part.max(0)
            open_ = np.flatnonzero(hi > lo)
            if d >= depth or len(part) < 2 or not len(open_):
                feat[at], cut[at], left[at], path[at] = -1, 0.0, at, d + _c(len(part))
                continue
            f = int(rng.choice(open_))
            c = float(rng.uniform(lo[f], hi[f]))
            below = part[:, f] < c
            a, b = node(), node()          # children are neighbours
            feat[at], cut[at], left[at], path[at] = f, c, a, 0.0
            todo += [(a, part[below], d + 1), (b, part[~below], d + 1)]
    return {"feature": np.array(feat, np.int16), "cut": np.array(cut, np.float64),
            "left": np.array(left, np.int32), "path": np.array(path, np.float64),
            "roots": np.array(roots, np.int32), "norm": _c(rows) or 1.0, "depth": depth}


def anomaly(forest: dict, x: np.ndarray) -> np.ndarray:
    """2 ** -(mean path / expected path): near 1 is odd, below 0.5 is common."""
    if not len(forest["roots"]) or not len(x):
        return np.zeros(len(x))
    at = np.repeat(forest["roots"][None, :], len(x), 0)
    rows = np.arange(len(x))[:, None]
    for _ in range(forest["depth"]):
        f = forest["feature"][at]
        right = x[rows, np.maximum(f, 0)] >= forest["cut"][at]
        at = np.where(f < 0, at, forest["left"][at] + right)
    return 2.0 ** (-forest["path"][at].mean(1) / forest["norm"])


def ranges_of(counts: list[dict[int, int]], share: float) -> tuple[np.ndarray, np.ndarray]:
    """Per statistic, the steps between which all rows but ``share`` at either
    end lie; ``counts`` has the rows of every step."""
    low, high = [], []
    for steps in counts:
        at = sorted(steps)
        n = np.cumsum([steps[b] for b in at])
        low.append(at[int(np.searchsorted(n, share * n[-1], side="right"))] * RANGE_STEP)
        high.append((at[int(np.searchsorted(n, (1 - share) * n[-1], side="left"))] + 1) * RANGE_STEP)
    return np.array(low), np.array(high)


def outside(x: np.ndarray, ranges: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Logarithm of 1 + the widths of the range that a statistic lies outside of it."""
    if ranges is None or not len(x):
        return x
    low, high = ranges
    far = np.maximum(np.maximum(low - x, x - high), 0) / np.maximum(high - low, LEAST_WIDTH)
    return np.log1p(np.minimum(far, MOST_WIDTHS))


def _scores(forest: dict, values, block: int = 2048) -> np.ndarray:
    x = outside(np.array(values, np.float64).reshape(-1, len(FEATURES)), forest.get("ranges"))
    return np.concatenate([anomaly(forest, x[i:i + block]) for i in range(0, len(x), block)] or [np.zeros(0)])


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        sample_rows: int = SAMPLE_ROWS, max_good_loss: float = MAX_GOOD_LOSS,
        balanced_loss: float = BALANCED_LOSS, seed: int = 7):
    """(forest, threshold) from a table of rule statistics.

    The forests see the ``sample_rows`` rows of lowest id hash that pass the
    base rules; ranges and threshold see every labelled row, through counts of
    steps and a histogram of ``BINS`` scores for each label.  Without rows
    labelled good nothing is rejected (threshold 1); without rows labelled bad
    the forest is that of the statistics themselves; a row with both labels
    counts for both.
    """
    fine = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    # twice the rows wanted lie below this hash, so each task sends its few of them, not a full sample
    n = fine.count()
    order = F.xxhash64(F.lit(seed), F.col(id_col))
    below = min(2 ** 63 - 1, -2 ** 63 + 2 ** 64 * 2 * sample_rows // max(n, 1))

    def lowest(rows):
        return rows.select("features").orderBy(order, id_col, "features").limit(sample_rows).collect()

    sample = lowest(fine.where(order <= below))
    if len(sample) < min(n, sample_rows):        # ids that repeat can leave fewer there
        sample = lowest(fine)
    x = np.array([r[0] for r in sample], np.float64).reshape(-1, len(FEATURES))
    marks = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("__id"), (F.col(label_col) == 1).alias("__good")).distinct()
    known = fine.select(id_col, "features").join(marks, F.col(id_col) == F.col("__id")).select("__good", "features")
    if labels.limit(1).count():
        known = scratch_table(known, "labelled-rules")
    seen = {r["__good"] for r in known.select("__good").distinct().collect()}
    tried = [None]
    if len(seen) == 2:
        rows = known.where("__good").select(F.posexplode("features").alias("i", "v")) \
            .groupBy("i", F.floor(F.col("v") / RANGE_STEP).alias("step")).count().collect()
        counts = [{r["step"]: r["count"] for r in rows if r["i"] == i} for i in range(len(FEATURES))]
        tried = [None if share is None else ranges_of(counts, share) for share in SHARES_OUTSIDE]
    forests = [grow_forest(outside(x, r), seed=seed) | {"ranges": r} for r in tried]
    hist = score_rows(known, forests, ["__good"]).select("__good", F.posexplode("anomaly").alias("forest", "score")) \
        .groupBy("__good", "forest", F.floor(F.col("score") * BINS).cast("int").alias("bin")).count().collect()

    def bins(k, is_good):
        return {r["bin"]: r["count"] for r in hist if r["forest"] == k and r["__good"] == is_good}

    if len(seen) < 2:
        return forests[0], threshold_of(bins(0, True), max_good_loss)
    judged = [balanced_threshold(bins(k, True), bins(k, False), balanced_loss) for k in range(len(forests))]
    best = max(range(len(forests)), key=lambda k: judged[k][1])
    return forests[best], judged[best][0]


def threshold_of(hist: dict[int, int], max_good_loss: float) -> float:
    """Upper edge of the lowest bin above which at most the given share lies."""
    total, above = sum(hist.values()), 0
    if not total:
        return 1.0
    for b in sorted(hist, reverse=True):
        if above + hist[b] > max_good_loss * total:
            return (b + 1) / BINS
        above += hist[b]
    return 0.0


def balanced_threshold(good: dict[int, int], bad: dict[int, int], max_good_loss: float) -> tuple[float, float]:
    """(upper edge of the bin above which the share of bad rows most exceeds
    that of good ones, by how much), of the edges above which at most the given
    share of good rows lies; of equals the highest."""
    n_good, n_bad = sum(good.values()), sum(bad.values())
    best, cut, lost, caught = 0.0, 1.0, 0, 0
    if not n_good:
        return cut, best
    for b in sorted(good.keys() | bad.keys(), reverse=True):
        if lost > max_good_loss * n_good:
            break
        if caught / n_bad - lost / n_good > best:
            best, cut = caught / n_bad - lost / n_good, (b + 1) / BINS
        lost += good.get(b, 0)
        caught += bad.get(b, 0)
    return cut, best


def score_rows(stats: DataFrame, forests: list[dict], carry: list[str]) -> DataFrame:
    """Add ``anomaly``, one score for each of the forests, to rows with
    ``features`` (Arrow batches, no shuffle)."""
    src = stats.select(*[stats[c] for c in carry], "features")
    kind = T.ArrayType(T.DoubleType())
    schema = T.StructType(list(src.schema.fields[:-1]) + [T.StructField("anomaly", kind)])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            values = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            scores = np.stack([_scores(f, values) for f in forests], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(list(scores), pa.list_(pa.float64()))],
                schema=pa.schema([b.schema.field(i) for i in range(b.num_columns - 1)]
                                 + [pa.field("anomaly", pa.list_(pa.float64()))]))
    return src.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``anomaly`` and ``kept``.

    A null or empty text has zero counts and fails the base rules (too few
    words).  Repeated rows are judged each.  With an empty labels table only
    the base rules reject.
    """
    stats = scratch_table(rule_statistics(docs, [id_col], text_col), "rules")
    forest, cut = fit(stats, labels, id_col, **options)
    got = score_rows(stats, [forest], [id_col, *COUNTS]).withColumn("anomaly", F.col("anomaly")[0])
    return got.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= cut))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    The statistics of the first pass fit the forest; the second pass judges
    each row where it lies, so no text is shuffled or joined."""
    stats = scratch_table(rule_statistics(docs, [id_col], text_col), "rules")
    forest, cut = fit(stats, labels, id_col, **options)

    def verdict(texts):
        rows = [statistics(t) for t in texts]
        odd = _scores(forest, [r[5] for r in rows])
        return [[not (r[0] < MIN_WORDS or 100 * r[4] > 50 * r[0]) and bool(o <= cut)
                 for r, o in zip(rows, odd)]]

    got = map_texts(docs, verdict, [T.StructField("__kept", T.BooleanType())], text_col)
    return got.where("__kept").select(*[got[c] for c in docs.columns])
