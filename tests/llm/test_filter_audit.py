import random
from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from riskframe.llm import filter_audit as a

LABELS = "doc_id long, quality int, toxic int"


def facts(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    t = text or ""
    upper = sum("A" <= c <= "Z" for c in t)
    return (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * upper > 5 * len(t),
            any(c in "#$%&*|" for c in t))


def brute(rows, labels):
    """Every order replayed over every document."""
    judged = []
    for doc_id, text, source in rows:
        copy = doc_id is not None and any(
            d is not None and d < doc_id and (t or "") == (text or "") for d, t, _ in rows)
        mine = [x for x in labels if x[0] == doc_id and doc_id is not None]
        judged.append((source or "", facts(text) + (copy,), any(q == 1 for _, q, _ in mine),
                       any(t == 1 for _, _, t in mine)))
    out, removed_by = {}, defaultdict(int)
    for part in {j[0] for j in judged}:
        docs = [j for j in judged if j[0] == part]
        for order in permutations(range(5)):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                removed_by[part, f] += len(gone)
                out[part, "".join("ABCDE"[i] for i in order), k + 1] = [
                    len(left), len(gone), sum(d[1][f] for d in docs) - len(gone),
                    sum(d[1][f] and sum(d[1]) == 1 for d in docs), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: tuple(v) + (removed_by[k[0], "ABCDE".index(k[1][k[2] - 1])],) for k, v in out.items()}


def made(rng):
    pool = ["the", "Cat", "sat", "ON", "a", "mat", "été", "#x", "漢字", "b|c", "x" * 30]
    rows = []
    for i in range(150):
        n = rng.choice([0, 3, 40, 60, 90])
        text = " ".join(rng.choice(pool) if rng.random() < 0.7 else f"w{rng.randrange(99)}" for _ in range(n))
        rows.append((i, rng.choice([text, text, "", None, "same text " * 30]), rng.choice(["s", "s", "t", None])))
    rows += [rows[7], rows[9], (None, "same text " * 30, "t"), (None, None, None), (3, "other row of id 3", "t")]
    return rows


def run(spark, rows, labels, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return a.audit_filters(docs, spark.createDataFrame(labels, LABELS), **options)


def values(df):
    return {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"])
        for r in df.collect()}


def test_every_order_matches_a_replay(spark):
    rng = random.Random(11)
    rows = made(rng)
    labels = [(i, rng.choice([0, 1]), rng.choice([0, 0, 1])) for i in range(0, 150, 2)]
    labels += [(4, 1, None), (4, 0, 1), (None, 1, 1), (9999, 1, 1), (3, None, 1)]
    got, want = values(run(spark, rows, labels)), brute(rows, labels)
    assert got == want and len(want) == 3 * 600


def test_potential_equals_the_mean_over_orders(spark):
    """120 P is an integer and the Shapley values add up to all removals."""
    rng = random.Random(12)
    counts = spark.createDataFrame([("p", m, rng.randrange(1, 10 ** 12), 0, 0) for m in range(32)],
                                   "part string, mask int, n long, good long, toxic long")
    rows = a.order_steps(counts, "ABCDE").collect()
    total = {r["filter"]: r["shapley"] for r in rows}
    last = next(r for r in rows if r["step"] == 5)
    everything = sum(r["n"] for r in counts.collect())
    assert sum(total.values()) == 120 * (everything - last["kept"])
    seen = defaultdict(int)
    for r in rows:
        seen[r["filter"]] += r["removed"]
    assert dict(seen) == total


def test_other_conditions(spark):
    rows = [(1, "a b", "s"), (2, "a b", "s"), (3, "A", "s"), (4, "q " * 9, "s")]
    got = run(spark, rows, [(2, 1, 0)], conditions={"L": F.col("n_words") > 5}, copies="Z")
    by = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["good_lost"], r["shapley"])
          for r in got.collect()}
    assert by == {("LZ", 1): (3, 1, 0, 2), ("LZ", 2): (2, 1, 1, 2), ("ZL", 1): (3, 1, 1, 2), ("ZL", 2): (2, 1, 0, 2)}


@pytest.mark.parametrize("n", [1, 4000])
def test_one_text_of_most_rows(spark, n):
    rows = [(i, "copy", "hot") for i in range(n)] + [(n + i, f"own {i}", "hot") for i in range(5)]
    got = values(run(spark, rows, []))
    assert got["hot", "EABCD", 1][:3] == (6, n - 1, 0)


def test_odd_rows_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1)], LABELS)
    got = values(a.audit_filters(odd, labels))
    assert {k[0] for k in got} == {"", "a", "b"}
    want = brute([(r["doc_id"], r["text"], r["source"]) for r in odd.collect()], [(1, 1, 0), (None, 1, 1)])
    assert got == want
    assert a.audit_filters(odd.limit(0), labels).count() == 0
    assert a.audit_filters(odd, labels.limit(0)).count() == 3 * 600


def test_ids_may_be_strings(spark):
    docs = spark.createDataFrame([("b", "x", "s"), ("a", "x", "s")], "doc_id string, text string, source string")
    labels = spark.createDataFrame([("b", 1, 0)], "doc_id string, quality int, toxic int")
    got = values(a.audit_filters(docs, labels))
    assert got["s", "EABCD", 1][1] == 1 and got["s", "EABCD", 1][4] == 1
