"""Steps whose cost may grow no faster than the input."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import balance, model, text
from riskframe.sources import encounters


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_of_a_document_are_counted_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "red fox red fox den"), (2, None), (3, "the of"), (None, "fox den den")],
                                 "doc int, body string")
    tf = text.term_counts(docs, "doc", "body")
    assert "hashpartitioning" not in _plan(tf)
    got = {(r.doc, r.term): r.tf for r in tf.collect()}
    one = Counter(["red", "fox", "red", "fox", "den", "red fox", "fox red", "red fox", "fox den"])
    none = Counter(["fox", "den", "den", "fox den", "den den"])
    assert got == {**{(1, t): n for t, n in one.items()}, **{(None, t): n for t, n in none.items()}}


def test_terms_of_repeated_keys_are_added_up(spark, monkeypatch):
    rows = [(1, "fox den"), (1, "fox"), (2, "fox"), (None, "den"), (None, "den fox")]
    docs = spark.createDataFrame(rows, "doc int, body string")
    want = {(1, "fox"): 2, (1, "den"): 1, (1, "fox den"): 1, (2, "fox"): 1, (None, "den"): 2, (None, "fox"): 1,
            (None, "den fox"): 1}
    for most in (100, 1):               # keys that are broadcast; too many for that
        monkeypatch.setattr(text, "REPEATED_KEYS", most)
        tf = text.term_counts(docs, "doc", "body")
        got = [((r.doc, r.term), r.tf) for r in tf.collect()]
        assert len(got) == len(want) and dict(got) == want
        df = {r.term: (r.df, r.tf_total) for r in text.doc_frequencies(tf, "doc").collect()}
        assert df["fox"] == (3, 4) and df["den"] == (2, 3)


def test_topic_scores_are_products_of_one_vector_per_document(spark):
    w = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "b", 1.0), (None, "a", 1.0), (3, "z", 1.0)],
                              "doc int, term string, weight double")
    load = spark.createDataFrame([("a", 0, 0.5), ("a", 1, -1.0), ("b", 0, 2.0), ("b", 1, 0.25)],
                                 "term string, topic int, loading double")
    keys = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "doc int")
    scores = text.project_topics(w, "doc", load)
    assert "MapInArrow" in _plan(scores)        # no row per weight and topic
    got = {(r.doc, r.topic): round(r.score, 9) for r in scores.collect()}
    some = {(1, 0): 1.9, (1, 1): -0.4, (2, 0): 2.0, (2, 1): 0.25}
    assert got == {**some, (None, 0): 0.5, (None, 1): -1.0}
    every = {(r.doc, r.topic): round(r.score, 9) for r in text.project_topics(w, "doc", load, keys).collect()}
    assert every == {**some, **{(d, t): 0.0 for d in (3, 4) for t in (0, 1)}}


def test_tasks_of_a_booster_follow_the_cores_and_stay_bounded(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(3)
    assert model.fit_tasks(df) == 1
    assert model.fit_tasks(df, n=100 * cores * model.ROWS_PER_TASK // 10) == cores
    assert model.fit_tasks(df, n=100 * cores * model.MOST_ROWS_PER_TASK) == 100 * cores
    assert model.fit_tasks(df, fits=2 * cores, n=10 * model.ROWS_PER_TASK) == 1


def test_nearest_keys_by_products_equal_the_exact_sums():
    rng = np.random.default_rng(3)
    for points in (rng.normal(size=(700, 9)) * 50 + 1e5, rng.integers(0, 4, size=(700, 4)).astype(float)):
        keys = [np.sort(rng.choice(10 ** 6, size=rng.integers(1, 5), replace=False)) for _ in points]
        q = points[:300]
        for limit in (np.full(300, np.inf), np.full(300, 3.0)):
            row, key, d2 = balance.nearest_keys(q, limit, points, keys, 4)
            want = []
            for i, x in enumerate(q):
                d = np.zeros(len(points))
                for c in range(points.shape[1]):
                    d += (x[c] - points[:, c]) ** 2
                near = sorted((d[j], k) for j in range(len(points)) if d[j] <= limit[i] for k in keys[j])[:4]
                want += [(i, k, e) for e, k in near]
            assert list(zip(row.tolist(), key.tolist(), d2.tolist())) == want


LINES = "l_orderkey long, l_suppkey long, l_quantity double"


def test_line_items_are_summed_by_as_many_tasks_as_they_fill(spark):
    cores = spark.sparkContext.defaultParallelism
    for k in (20, 40):              # partitions follow the rows, not a setting
        rows = spark.range(k * cores * 10).select(
            (F.col("id") % 97).alias("l_orderkey"), (F.col("id") % 7).alias("l_suppkey"), F.lit(1.0).alias("l_quantity"))
        assert encounters.line_totals(rows, 10).rdd.getNumPartitions() == k * cores
    few = spark.createDataFrame([(1, 1, 1.0)], LINES)
    assert encounters.line_totals(few).rdd.getNumPartitions() == cores


def test_encounters_hold_no_sums_of_a_whole_input_split(spark):
    plan = _plan(encounters._side_tables(spark, "/root/testdata/sf0.001")[0])
    scan = plan[:plan.index("FileScan")]
    below = scan[scan.rindex("Exchange"):]          # between the scan and its shuffle
    assert "REPARTITION_BY_NUM" in below and "Aggregate" not in below


def test_line_totals_equal_counts_and_distinct_counts(spark):
    rows = [(1, 1, 2.0), (1, 1, 2.0), (1, 2, None), (1, None, 3.0), (2, None, None), (2, None, None), (3, 5, 1.5),
            (None, 1, 4.0), (None, 1, 4.0), (None, None, 1.0), *[(4, i % 9, 1.0) for i in range(100)]]
    lines = spark.createDataFrame(rows, LINES)
    want = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_items"),
                                           F.countDistinct("l_suppkey").alias("n_supp"),
                                           F.sum("l_quantity").alias("qty"))
    for most in (1, 1000):
        got = encounters.line_totals(lines, most)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
