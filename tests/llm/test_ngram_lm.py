import math
import random
from collections import Counter

from riskframe.llm.ngram_lm import lm_scores
from riskframe.llm.words import alnum_words


def brute(texts, order, alpha):
    words = [alnum_words(t.encode() if t else None) for t in texts]
    grams = [Counter(tuple(w[i:i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)) for w in words]
    total = sum(grams, Counter())
    n = sum(map(len, words))
    out = []
    for w, g in zip(words, grams):
        c = lambda x: total[x] - g[x]  # noqa: B023,E731
        s = 0.0
        for i in range(len(w)):
            best = math.log(max(c((w[i],)), 1)) - math.log(n - len(w) + 1)
            for k in range(2, min(order, i + 1) + 1):
                x = tuple(w[i - k + 1:i + 1])
                best = math.log(c(x)) - math.log(c(x[:-1])) if c(x) > 0 else math.log(alpha) + best
            s += best
        out.append((len(w), s))
    return out


def test_scores_match_brute_force(spark, docs_of):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a b c d e f Gg, h. é".split()) for _ in range(rng.choice([0, 1, 2, 5, 60, 200])))
             for _ in range(60)] + ["", None, "solo", "a a a a a a"]
    for order in (1, 2, 3, 4):
        got = {r["doc_id"]: r for r in lm_scores(docs_of(texts), order=order, block_bytes=900, bucket_grams=700).collect()}
        for i, (n, s) in enumerate(brute(texts, order, 0.4)):
            assert got[i]["n_tokens"] == n
            assert math.isclose(got[i]["log_score"], s, rel_tol=1e-9, abs_tol=1e-9)
            assert (got[i]["mean_log_score"] is None) == (n == 0)


def test_blocks_do_not_change_scores(spark, docs_of):
    texts = ["the cat sat on the mat", "the cat ran", "on the mat the dog sat", "unseen things only"] * 5
    a = {r["doc_id"]: r["log_score"] for r in lm_scores(docs_of(texts)).collect()}
    b = {r["doc_id"]: r["log_score"] for r in lm_scores(docs_of(texts), block_bytes=50, bucket_grams=10).collect()}
    assert all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)


def test_odd_rows(spark, odd):
    got = lm_scores(odd).collect()
    assert len(got) == 9
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 5)} == {0}
    assert lm_scores(odd.limit(0)).count() == 0
