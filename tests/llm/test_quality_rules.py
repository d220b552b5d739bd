import random
import re

import numpy as np

from riskframe.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def texts(rng):
    vocab = ["a", "b", "Été", "x#", "*", "漢字", "😀", "end.", "1"]
    out = ["", None, " \n \x0b\x0c", "a", "a a a", "a a a a", "x\n\nx\nx \n x\x85y z\n"]
    for _ in range(60):
        out.append("".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t", "\n\n", "\r\n"])
                           for _ in range(rng.randrange(80))))
    return out


def test_counts_match_brute_force(spark, docs_of):
    all_texts = texts(random.Random(8))
    got = {r["doc_id"]: r for r in q.quality_rules(
        docs_of(all_texts), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    for i, t in enumerate(all_texts):
        n, chars, symbols, dup, repeat = brute(t)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == \
            (n, chars, symbols, dup, repeat), (i, t)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert r["kept"] == (not r["base_failed"])        # nothing to calibrate with


def test_tree_paths_match_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8))
    f = q.grow_forest(x, trees=12, rows=64)

    def walk(row, node):
        while f["feature"][node] >= 0:
            node = f["left"][node] + (row[f["feature"][node]] >= f["cut"][node])
        return f["path"][node]
    want = [2 ** (-np.mean([walk(r, t) for t in f["roots"]]) / f["norm"]) for r in x[:40]]
    assert np.allclose(q.anomaly(f, x[:40]), want)


def test_odd_rows_stand_out():
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(2000, 8)), np.full((5, 8), 9.0)])
    s = q.anomaly(q.grow_forest(x), x)
    assert s[-5:].min() > np.quantile(s[:-5], 0.999)


def test_threshold_loses_at_most_the_given_share():
    hist = {100: 900, 200: 98, 300: 2}
    assert q.threshold_of(hist, 0.002) == 201 / q.BINS
    assert q.threshold_of(hist, 0.5) == 101 / q.BINS
    assert q.threshold_of({}, 0.1) == 1.0


def test_balanced_cut_weighs_both_labels():
    good, bad = {100: 900, 200: 60, 300: 40}, {150: 2, 250: 50, 350: 10}
    assert q.balanced_threshold(good, bad, 0.05)[0] == 201 / q.BINS      # 60 of 62 for 40 of 1000
    assert q.balanced_threshold(good, bad, 0.2)[0] == 201 / q.BINS       # the last 2 are not worth 60 more
    assert q.balanced_threshold(good, bad, 0.03)[0] == 301 / q.BINS
    assert q.balanced_threshold({300: 9}, {100: 9}, 0.05)[0] == 1.0      # nothing gained, nothing rejected
    assert q.balanced_threshold({}, bad, 0.05)[0] == 1.0


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else
                    "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_labelled_good_rows_are_kept_and_junk_goes(spark, docs_of):
    rng = random.Random(9)
    good = [prose(rng, 200) for _ in range(400)]
    junk = [" ".join(w.upper() + "#$%" for w in prose(rng, 200).split()) for _ in range(8)]
    docs = docs_of(good + junk)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in q.quality_rules(docs, labels, max_good_loss=0.01).collect()}
    assert sum(got[i] for i in range(400)) >= 388
    assert not any(got[i] for i in range(400, 408))
    kept = q.keep_good(docs, labels, max_good_loss=0.01)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k}


def test_most_labelled_bad_rows_go_at_the_production_values(spark, docs_of):
    rng = random.Random(10)
    good = [prose(rng, 200) for _ in range(388)]
    # odd but good ones and bad ones of the same kind: 0.2 % of good loss catches nothing
    odd = [" ".join(w.upper() + "#$%" for w in prose(rng, 200).split()) for _ in range(12)]
    junk = [" ".join(w.upper() + "#$" for w in prose(rng, 200).split()) for _ in range(30)]
    rows = [(i, 1, 0) for i in range(400)] + [(i, 0, 0) for i in range(400, 430)]
    got = {r["doc_id"]: r["kept"] for r in q.quality_rules(
        docs_of(good + odd + junk), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()}
    assert sum(got[i] for i in range(400)) >= 0.95 * 400
    assert sum(got[i] for i in range(400, 430)) <= 0.2 * 30


def test_ranges_hold_all_but_the_share():
    rng = np.random.default_rng(3)
    x = rng.normal(size=2000).round(4) + 5
    steps = {}
    for v in x:
        k = int(np.floor(v / q.RANGE_STEP))
        steps[k] = steps.get(k, 0) + 1
    low, high = q.ranges_of([steps], 0.01)
    assert (x < low[0]).sum() <= 20 and (x > high[0]).sum() <= 20
    assert (x < low[0] + 2 * q.RANGE_STEP).sum() + 5 >= 20
    far = q.outside(np.array([[low[0]], [high[0]], [high[0] + 1], [1e9]]), (low, high)).ravel()
    assert far[0] == far[1] == 0 < far[2] < far[3] == np.log1p(q.MOST_WIDTHS)
    assert q.outside(x[:, None], None) is not None and np.array_equal(q.outside(x[:, None], None), x[:, None])


def test_few_good_rows_are_lost_where_statistics_vary(spark, docs_of):
    """Good rows of varying style stay; bad ones break one rule only."""
    rng = random.Random(12)
    good = [prose(rng, rng.randrange(60, 500)) + rng.choice(["", " A. B, c!", " 123 45", "\nx\nx"]) for _ in range(600)]
    junk = [prose(rng, 100) + " #%" * rng.randrange(20, 60) + prose(rng, 50) for _ in range(60)]
    rows = [(i, 1, 0) for i in range(0, 600, 2)] + [(i, 0, 0) for i in range(600, 660, 2)]
    got = {r["doc_id"]: r for r in q.quality_rules(
        docs_of(good + junk), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()}
    kept = lambda ids: [got[i]["kept"] for i in ids if not got[i]["base_failed"]]
    assert sum(kept(range(600))) >= 0.97 * len(kept(range(600)))
    assert sum(kept(range(600, 660))) <= 0.1 * len(kept(range(600, 660))) + 1


def test_the_sample_is_the_rows_of_lowest_hash(spark):
    from pyspark.sql import functions as F
    for ids in (F.col("id"), F.lit(3)):
        stats = spark.range(3000).select(ids.cast("long").alias("doc_id"), F.lit(60).alias("n_words"), F.lit(0).alias("n_repeat_words"),
                                         F.array(*[(F.col("id") * k % 97).cast("double") for k in range(1, 9)]).alias("features"))
        want = [r[0] for r in stats.orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id", "features").limit(200).select("features").collect()]
        labels = spark.createDataFrame([], "doc_id long, quality int")
        forest, cut = q.fit(stats, labels, sample_rows=200)
        same = q.grow_forest(np.array(want))
        assert cut == 1.0 and all(np.array_equal(forest[k], same[k]) for k in ("feature", "cut", "left", "path"))


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, None), (6, 0, 1)], "doc_id long, quality int, toxic int")
    rows = q.quality_rules(odd, labels).collect()
    assert len(rows) == 9
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] == 0)
    assert q.quality_rules(odd.limit(0), labels).count() == 0
    assert q.keep_good(odd, labels).columns == odd.columns
