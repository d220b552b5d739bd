"""Class balance: counts, imbalance ratio, positive-class weights."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """AGG8: one row (n_neg, n_pos, ratio = n_neg / n_pos)."""
    return df.agg(F.count_if(F.col(label) == 0).alias("n_neg"),
                  F.count_if(F.col(label) == 1).alias("n_pos")) \
             .withColumn("ratio", F.col("n_neg") / F.col("n_pos"))


def pos_weight_grid(balance: DataFrame) -> DataFrame:
    """ML2 grid: positive-class weights {1, r/2, r, 1.5 r} with r = n_neg / n_pos."""
    r = F.col("ratio")
    return balance.select(F.explode(F.array(
        F.struct(F.lit("one").alias("option"), F.lit(1.0).alias("pos_weight")),
        F.struct(F.lit("half_ratio").alias("option"), (r / 2).alias("pos_weight")),
        F.struct(F.lit("ratio").alias("option"), r.alias("pos_weight")),
        F.struct(F.lit("ratio_x1_5").alias("option"), (r * 1.5).alias("pos_weight")))).alias("g")).select("g.*")


def weight_column(label: str, pos_weight: float) -> "F.Column":
    """ML2: per-row weight for ``weightCol``: pos_weight for positives, 1 otherwise."""
    return F.when(F.col(label) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0))


# ------------------------------------------------------------ k-NN, SMOTE ---
KNN_K = 5              # fixed value: neighbours per minority row (library default)
SMOTE_RATIO = 0.5      # fixed value: minority grown to 0.5 x majority
SLICE_ROWS = 4096      # distinct vectors per block; bounds the in-task distances
SAMPLE_ROWS = 65_536   # vectors that place the cuts of the boxes; bounds the boxes to a 16th of it
ROUTED_ROWS = 65_536   # searches that meet one block in one task
SEED = 42


def box_tree(sample: np.ndarray, leaves: int) -> dict:
    """k-d tree as flat arrays: each box is cut at the median of its widest
    dimension until there are ``leaves`` of them (fewer where points repeat)."""
    dim, cut, left, leaf = [], [], [], []

    def node():
        for v in (dim, cut, left, leaf):
            v.append(-1)
        return len(dim) - 1

    todo, n = [(node(), sample, leaves)], 0
    while todo:
        at, part, want = todo.pop()
        spread = part.max(0) - part.min(0) if len(part) else np.zeros(1)
        f = int(spread.argmax())
        if want < 2 or not spread[f] > 0:
            leaf[at], n = n, n + 1
            continue
        x = part[:, f]
        c = np.median(x)
        if not (x < c).any():
            c = x[x > x.min()].min()
        a, b = node(), node()                       # children are neighbours
        dim[at], cut[at], left[at] = f, float(c), a
        todo += [(a, part[x < c], want // 2), (b, part[x >= c], want - want // 2)]
    return {"dim": np.array(dim), "cut": np.array(cut, float), "left": np.array(left), "leaf": np.array(leaf)}


def boxes_of(tree: dict, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), int)
    while True:
        i = np.flatnonzero(tree["dim"][at] >= 0)
        if not len(i):
            return tree["leaf"][at]
        at[i] = tree["left"][at[i]] + (x[i, tree["dim"][at[i]]] >= tree["cut"][at[i]])


def boxes_met(x: np.ndarray, r2: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(row, box) pairs where the box meets the row's ball."""
    gap = np.zeros((len(x), len(lo)))
    for i in range(x.shape[1]):
        away = np.maximum(lo[None, :, i] - x[:, i, None], x[:, i, None] - hi[None, :, i])
        gap += np.maximum(away, 0) ** 2
    return np.nonzero(gap <= r2[:, None] * (1 + 1e-9))


def nearest_keys(q: np.ndarray, limit: np.ndarray, points: np.ndarray, keys: list, many: int):
    """(row of ``q``, key, squared distance) of the ``many`` nearest keys of
    each row within its limit, ordered by (row, distance, key)."""
    count = np.array([len(x) for x in keys])
    flat, first = np.concatenate(keys), np.cumsum(count) - count
    # a matrix product, off by ``slack`` at most, leaves few pairs for the exact sum
    middle = points.mean(0)
    near = points - middle
    size = (near ** 2).sum(1)
    out = []
    for s in range(0, len(q), 256):
        part = q[s:s + 256]
        mine = part - middle
        own = (mine ** 2).sum(1)
        rough = size[None, :] + own[:, None] - 2 * (mine @ near.T)
        slack = 1e-12 * (own + size.max())
        bound = limit[s:s + 256] + slack
        full = np.flatnonzero((rough <= bound[:, None]).sum(1) > 8 * many)
        if len(full):                   # every point has a key, and ties at the last distance stay in
            last = np.partition(rough[full], many - 1, axis=1)[:, many - 1]
            bound[full] = np.minimum(bound[full], last + 2 * slack[full])
        row, at = np.nonzero(~(rough > bound[:, None]))
        d2 = np.zeros(len(row))
        for i in range(q.shape[1]):
            d2 += (part[row, i] - points[at, i]) ** 2
        ok = d2 <= limit[s:s + 256][row]
        row, at, d2 = row[ok], at[ok], d2[ok]
        n = count[at]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = flat[np.repeat(first[at], n) + within]
        dist, row = np.repeat(d2, n), np.repeat(row, n)
        order = np.lexsort((key, dist, row))
        row, key, dist = row[order], key[order], dist[order]
        ok = np.arange(len(row)) - np.searchsorted(row, row) < many
        out.append((row[ok] + s, key[ok], dist[ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


def knn(points: DataFrame, key: str, features, k: int = KNN_K, slice_rows: int = SLICE_ROWS,
        seed: int = SEED, sample_rows: int = SAMPLE_ROWS, routed_rows: int = ROUTED_ROWS) -> DataFrame:
    """JN5: exact k nearest other rows (Euclidean, ties by key) as
    (key, nrank, nbr, dist), without emitting all pairs.

    The search is over distinct vectors, each with its k + 1 least keys (no
    other key can be among the nearest k of any row), so a block of
    duplicates, however large, is one point.  A k-d tree cut on a bounded
    sample places the vectors in boxes; a box of more than ``slice_rows`` is
    split by hash.  Each block finds its vectors' nearest keys inside it; the
    last distance is a verified search radius, and the vector is sent only to
    the blocks whose box (its actual bounds in every dimension) meets that
    ball.  A block with more than ``routed_rows`` searches is copied to
    several tasks, each with a share of them.  The k + 1 best are merged per
    vector and joined back to the rows, which leave themselves out."""
    import pandas as pd
    from pyspark.sql import Window

    from riskframe.session import materialize

    spark = points.sparkSession
    feats, many = list(features), k + 1
    d = len(feats)
    base = points.select(F.col(key).cast("long").alias("key"),
                         F.array(*[F.col(f).cast("double") for f in feats]).alias("x"))
    place = F.row_number().over(Window.partitionBy("x").orderBy("key"))    # a top-n: cut before the shuffle
    vectors = base.withColumn("place", place).where(F.col("place") <= many) \
        .groupBy("x").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    vectors = materialize(vectors.select(F.col("keys")[0].alias("vid"), "x", "keys"), "knn")
    n = vectors.count()
    if n == 0:
        return base.select(F.col("key").alias(key), F.lit(1).alias("nrank"), F.col("key").alias("nbr"),
                           F.lit(0.0).alias("dist"))
    below = min(2 ** 63 - 1, -2 ** 63 + 2 ** 64 * sample_rows // n)
    sample = vectors.where(F.xxhash64(F.lit(seed), "vid") <= below).select("x").limit(2 * sample_rows).collect()
    sample = np.array([r["x"] for r in sample], float).reshape(-1, d)
    tree = box_tree(sample, max(1, min(-(-n // slice_rows), sample_rows // 16)))

    def put(it):
        for p in it:
            yield p.assign(box=boxes_of(tree, np.vstack(p["x"].to_numpy())).astype("int32"))

    placed = materialize(vectors.mapInPandas(put, "vid long, x array<double>, keys array<long>, box int"), "knn")
    # one row per box: at most sample_rows / 16
    stats = placed.groupBy("box").agg(F.count(F.lit(1)).alias("n"),
                                      *[F.min(F.col("x")[i]).alias(f"lo{i}") for i in range(d)],
                                      *[F.max(F.col("x")[i]).alias(f"hi{i}") for i in range(d)]).collect()
    lo = np.array([[r[f"lo{i}"] for i in range(d)] for r in stats])
    hi = np.array([[r[f"hi{i}"] for i in range(d)] for r in stats])
    of = np.array([-(-r["n"] // slice_rows) for r in stats])
    start = np.cumsum(of) - of
    blocks = spark.createDataFrame([(r["box"], int(o), int(s)) for r, o, s in zip(stats, of, start)],
                                   "box int, of int, start int")
    slot = (F.col("start") + F.pmod(F.xxhash64("vid"), F.col("of"))).cast("int")
    slotted = placed.join(F.broadcast(blocks), "box").select(slot.alias("slot"), "vid", "x", "keys")

    def inside(p):
        x = np.vstack(p["x"].to_numpy())
        row, nbr, d2 = nearest_keys(x, np.full(len(x), np.inf), x, p["keys"].to_list(), many)
        ends = np.cumsum(np.bincount(row, minlength=len(x)))
        full = np.diff(ends, prepend=0) == many
        return pd.DataFrame({"slot": p["slot"], "vid": p["vid"], "x": p["x"],
                             "r2": np.where(full, d2[ends - 1], np.inf),
                             "nbr": np.split(nbr, ends[:-1]), "d2": np.split(d2, ends[:-1])})

    local = materialize(slotted.groupBy("slot").applyInPandas(
        inside, "slot int, vid long, x array<double>, r2 double, nbr array<long>, d2 array<double>"), "knn")

    def route(it):
        for p in it:
            x = np.vstack(p["x"].to_numpy())
            r2, own, vid = (p[c].to_numpy() for c in ("r2", "slot", "vid"))
            for s in range(0, len(x), 256):
                row, box = boxes_met(x[s:s + 256], r2[s:s + 256], lo, hi)
                m = of[box]
                row = np.repeat(row, m) + s
                to = np.repeat(start[box], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                go = to != own[row]
                row = row[go]
                if not len(row):
                    continue
                yield pd.DataFrame({"slot": to[go].astype("int32"), "vid": vid[row], "x": list(x[row]), "r2": r2[row]})

    sent = materialize(local.select("slot", "vid", "x", "r2")
                       .mapInPandas(route, "slot int, vid long, x array<double>, r2 double"), "knn")
    parts = sent.groupBy("slot").agg(F.ceil(F.count(F.lit(1)) / routed_rows).cast("int").alias("parts"))
    asked = sent.join(parts, "slot").select(
        "slot", F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int").alias("part"), "vid", "x", "r2")
    again = parts.select(F.col("slot").alias("to"), F.col("parts").alias("copies"))
    there = slotted.join(again, F.col("slot") == F.col("to")).select(
        F.col("slot").alias("to"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "x", "keys")

    def beyond(q, p):
        if not len(q) or not len(p):
            return pd.DataFrame({"vid": [], "nbr": [], "d2": []}).astype({"vid": "int64", "nbr": "int64"})
        row, nbr, d2 = nearest_keys(np.vstack(q["x"].to_numpy()), q["r2"].to_numpy(),
                                    np.vstack(p["x"].to_numpy()), p["keys"].to_list(), many)
        return pd.DataFrame({"vid": q["vid"].to_numpy()[row], "nbr": nbr, "d2": d2})

    far = asked.groupBy("slot", "part").cogroup(there.groupBy("to", "copy")) \
        .applyInPandas(beyond, "vid long, nbr long, d2 double")
    found = local.select("vid", F.explode(F.arrays_zip("nbr", "d2")).alias("c")).select("vid", "c.nbr", "c.d2")
    rank = F.row_number().over(Window.partitionBy("vid").orderBy("d2", "nbr"))     # at most k + 1 per block met
    best = found.unionByName(far).withColumn("rank", rank).where(F.col("rank") <= many) \
        .groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("rank", "nbr", "d2"))).alias("near"))
    near = vectors.select("vid", "x").join(best, "vid").select("x", "near")
    others = F.filter("near", lambda c: c["nbr"] != F.col("key"))
    return base.join(near, "x").select(F.col("key"), F.posexplode(F.slice(others, 1, k)).alias("pos", "c")) \
        .select(F.col("key").alias(key), (F.col("pos") + 1).cast("int").alias("nrank"), F.col("c.nbr").alias("nbr"),
                F.sqrt("c.d2").alias("dist"))


def _hash_parts(key_col, copy_col, seed: int):
    h = F.md5(F.concat_ws("|", F.col(key_col).cast("string"), F.col(copy_col).cast("string"), F.lit(str(seed))))
    a = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    b = F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint")
    return a, b


def smote(df: DataFrame, label: str, key: str, features, k: int = KNN_K, ratio: float = SMOTE_RATIO,
          minority: int = 1, seed: int = SEED, nbr_col: str | None = None) -> DataFrame:
    """SMP6 + SET3: grow the minority class to ``ratio`` x majority with rows
    x + u * (neighbour - x).  Deterministic: minority rows in md5 order take
    the copies round-robin; neighbour rank and u come from md5(key|copy|seed).
    Returns the original rows (synthetic = 0) plus the new rows (synthetic = 1,
    ``copy`` > 0, key of the row they were grown from); ``nbr_col`` adds the key
    of the neighbour (null for original rows)."""
    from riskframe.operators.prefix import rank_within
    feats = list(features)
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_min = counts.get(minority, 0)
    n_maj = max(v for c, v in counts.items() if c != minority) if len(counts) > 1 else 0
    n_new = int(ratio * n_maj) - n_min
    named = lambda c: [c.alias(nbr_col)] if nbr_col else []
    orig = df.select(key, label, *feats, F.lit(0).alias("copy"), F.lit(0).alias("synthetic"),
                     *named(F.lit(None).cast(df.schema[key].dataType)))
    if n_new <= 0 or n_min < 2:
        return orig
    k_eff = min(k, n_min - 1)
    mino = df.where(F.col(label) == minority).select(key, label, *feats)
    nn = knn(mino, key, feats, k_eff, seed=seed)
    h = "__h"
    ranked = rank_within(mino.withColumn(h, F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))),
                         [label], [h, key], out="__r").drop(h)
    per, extra = n_new // n_min, n_new % n_min
    copies = F.lit(per) + (F.col("__r") <= extra).cast("int")
    gen = (ranked.select(key, label, *feats, copies.alias("__c")).where(F.col("__c") > 0)
                 .select(key, label, *feats, F.explode(F.sequence(F.lit(1), F.col("__c"))).alias("copy")))
    a, b = _hash_parts(key, "copy", seed)
    gen = gen.withColumn("nrank", (a % k_eff + 1).cast("int")).withColumn("u", b / F.lit(4294967296.0))
    pick = gen.join(nn.select(key, "nrank", "nbr"), [key, "nrank"])
    nbrs = mino.select(F.col(key).alias("nbr"), *[F.col(f).alias(f"__n_{f}") for f in feats])
    syn = pick.join(nbrs, "nbr").select(
        key, label, *[(F.col(f) + F.col("u") * (F.col(f"__n_{f}") - F.col(f))).alias(f) for f in feats],
        "copy", F.lit(1).alias("synthetic"), *named(F.col("nbr")))
    return orig.unionByName(syn)
