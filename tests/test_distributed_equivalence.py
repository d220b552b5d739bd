"""Skew-safe plans against brute force on small fixtures."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.operators import drift, metrics
from riskframe.operators.prefix import rank_within, running_sum


def test_running_sum_matches_window_with_hot_group(spark):
    rng = np.random.RandomState(0)
    g = np.where(rng.rand(3000) < 0.6, "hot", rng.choice(list("abcde"), 3000))
    pdf = pd.DataFrame({"g": g, "v": rng.randint(0, 2000, 3000), "x": rng.randint(1, 5, 3000)})
    df = spark.createDataFrame(pdf).groupBy("g", "v").agg(F.sum("x").alias("x"))
    for desc in (False, True):
        r = running_sum(df, ["g"], ["v"], ["x"], descending=desc, slices=7)
        o = F.col("v").desc() if desc else F.col("v")
        ref = df.withColumn("ref", F.sum("x").over(Window.partitionBy("g").orderBy(o)
                                                   .rowsBetween(Window.unboundedPreceding, 0)))
        j = r.join(ref, ["g", "v"])
        assert j.where("cum_x != ref").count() == 0 and j.count() == df.count()


def test_rank_within_is_row_number(spark):
    df = spark.range(500).withColumn("c", (F.col("id") % 3).cast("int")).withColumn("h", F.md5(F.col("id").cast("string")))
    r = rank_within(df, ["c"], ["h", "id"], slices=5)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("c").orderBy("h", "id")))
    assert r.join(ref, ["id"]).where("rank != rn").count() == 0


def _auc_brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((pp > neg).sum() + 0.5 * (pp == neg).sum() for pp in pos)
    return s / (len(pos) * len(neg))


def _ap_brute(y, p):
    order = np.argsort(-p, kind="stable")
    ys, ps = y[order], p[order]
    ap, P = 0.0, y.sum()
    for t in np.unique(ps)[::-1]:
        sel = ps >= t
        tp = ys[sel].sum()
        ap += (ys[ps == t].sum() / P) * tp / sel.sum()
    return ap


def test_auc_ap_match_brute_force(spark):
    rng = np.random.RandomState(1)
    y = rng.randint(0, 2, 400)
    p = np.round(rng.rand(400) * 0.5 + y * 0.2, 2)          # many ties
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    assert abs(metrics.auc(df, "y", "p", slices=4).first()["auc"] - _auc_brute(y, p)) < 1e-12
    assert abs(metrics.average_precision(df, "y", "p", slices=4).first()["average_precision"] - _ap_brute(y, p)) < 1e-12
    both = metrics.rank_metrics(df, "y", "p", slices=3).first()
    assert abs(both["auc"] - _auc_brute(y, p)) < 1e-12 and abs(both["average_precision"] - _ap_brute(y, p)) < 1e-12


def test_ks_statistic_matches_brute_force(spark):
    rng = np.random.RandomState(2)
    a, b = np.round(rng.randn(300), 1), np.round(rng.randn(200) + 0.3, 1)
    pdf = pd.DataFrame({"feature": "f", "value": np.concatenate([a, b]),
                        "side": ["ref"] * 300 + ["cur"] * 200})
    got = drift.ks_drift(spark.createDataFrame(pdf), slices=3).first()["ks_statistic"]
    grid = np.unique(np.concatenate([a, b]))
    d = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    assert abs(got - d) < 1e-12


def test_lead_within_matches_window_with_hot_key(spark):
    from riskframe.operators.prefix import lead_within
    rng = np.random.RandomState(5)
    n = 3000
    cust = np.where(rng.rand(n) < 0.4, 7, rng.randint(0, 50, n))
    pdf = pd.DataFrame({"k": np.arange(n), "c": cust, "d": rng.randint(0, 300, n)})
    df = spark.createDataFrame(pdf)
    got = lead_within(df, ["c"], ["d", "k"], "d", "nd", slices=6, hot_rows=100)   # force the sliced plan
    ref = df.withColumn("rd", F.lead("d").over(Window.partitionBy("c").orderBy("d", "k")))
    j = got.join(ref, "k")
    assert j.count() == n
    assert j.where("not (nd <=> rd)").count() == 0


def test_knn_exact_against_brute_force_with_duplicates(spark):
    from riskframe.operators.balance import knn
    rng = np.random.RandomState(0)
    n = 300
    X = rng.randint(0, 5, (n, 3)).astype(float)
    X[:60] = 2.0
    pdf = pd.DataFrame({"id": np.arange(n), "a": X[:, 0], "b": X[:, 1], "c": X[:, 2]})
    got = knn(spark.createDataFrame(pdf), "id", ["a", "b", "c"], k=4, slice_rows=50).toPandas()
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(D, np.inf)
    for i in range(n):
        want = np.lexsort((np.arange(n), D[i]))[:4].tolist()
        assert got[got.id == i].sort_values("nrank")["nbr"].tolist() == want


def test_smote_grows_minority_between_neighbours(spark):
    from riskframe.operators.balance import smote
    rng = np.random.RandomState(1)
    n = 200
    y = (np.arange(n) < 30).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.rand(n), "b": rng.rand(n), "y": y})
    s = smote(spark.createDataFrame(pdf), "y", "id", ["a", "b"], k=5, ratio=0.5).toPandas()
    assert (s.y == 1).sum() == int(0.5 * 170) and (s.y == 0).sum() == 170
    syn = s[s.synthetic == 1]
    assert syn.a.between(0, 1).all() and syn.b.between(0, 1).all()


def test_knn_exact_with_hot_duplicate_block(spark):
    from riskframe.operators.balance import knn
    rng = np.random.RandomState(3)
    n = 600
    X = rng.randint(0, 4, (n, 2)).astype(float)
    X[100:500] = [1.0, 2.0]            # two thirds of the rows are one vector
    pdf = pd.DataFrame({"id": np.arange(n), "a": X[:, 0], "b": X[:, 1]})
    got = knn(spark.createDataFrame(pdf), "id", ["a", "b"], k=5, slice_rows=40).toPandas()
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(D, np.inf)
    for i in range(n):
        want = np.lexsort((np.arange(n), D[i]))[:5].tolist()
        assert got[got.id == i].sort_values("nrank")["nbr"].tolist() == want


def test_knn_hot_blocks_and_split_boxes_in_eight_dimensions(spark):
    """Few boxes split by hash, and searches of a block spread over tasks."""
    from riskframe.operators.balance import knn
    rng = np.random.RandomState(4)
    X = rng.randint(0, 3, (400, 8)).astype(float)
    cols = [f"f{i}" for i in range(8)]
    pdf = pd.DataFrame(X, columns=cols).assign(id=np.arange(400))
    got = knn(spark.createDataFrame(pdf), "id", cols, k=3, slice_rows=20, sample_rows=64, routed_rows=50).toPandas()
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(D, np.inf)
    for i in range(400):
        want = np.lexsort((np.arange(400), D[i]))[:3].tolist()
        assert got[got.id == i].sort_values("nrank")["nbr"].tolist() == want


def test_knn_of_nothing_one_and_equal_rows(spark):
    from riskframe.operators.balance import knn
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(7)], "id long, a double, b double")
    assert knn(df.limit(0), "id", ["a", "b"], k=2).count() == 0
    assert knn(df.where("id = 3"), "id", ["a", "b"], k=2).count() == 0
    got = {(r["id"], r["nrank"]): r["nbr"] for r in knn(df, "id", ["a", "b"], k=2).collect()}
    assert len(got) == 14 and got[(0, 1)] == 1 and got[(0, 2)] == 2 and got[(1, 1)] == 0 and got[(6, 2)] == 1


def test_knn_search_meets_a_falling_share_of_boxes():
    from riskframe.operators.balance import box_tree, boxes_met, boxes_of
    rng = np.random.RandomState(6)
    share = []
    for n in (4_000, 32_000, 128_000):
        X = rng.rand(n, 8)
        tree = box_tree(X, n // 250)
        box = boxes_of(tree, X)
        m = box.max() + 1
        lo, hi = np.full((m, 8), np.inf), np.full((m, 8), -np.inf)
        np.minimum.at(lo, box, X)
        np.maximum.at(hi, box, X)
        q = X[:60]
        d2 = ((q ** 2).sum(1)[:, None] + (X ** 2).sum(1)[None] - 2 * q @ X.T)
        r2 = np.sort(np.maximum(d2, 0), axis=1)[:, 5]
        share.append(len(boxes_met(q, r2, lo, hi)[0]) / (60 * m))
    assert share[0] > share[1] > share[2], share
