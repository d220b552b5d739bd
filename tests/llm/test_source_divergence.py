import random
import re
from collections import Counter, defaultdict

import numpy as np

from riskframe.llm import source_divergence as d

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(rows, min_docs=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts[lang, source].update(terms_of(text))
        docs[lang].update(set(terms_of(text)))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = [g for g in groups if g[0] == lang]
        total = Counter()
        for g in mine:
            total.update(counts[g])

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = shares(counts[lang, source]), shares(total)
        pairs = []
        for g in mine:
            if g[1] != source:
                o = shares(counts[g])
                pairs.append((g[1], sum(f(p[t], o[t]) for t in kept)))
        uses = [(t, f(p[t], q[t])) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", uses, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(found[:most])]
    return sorted(out)


def made(rng, n=160):
    pool = ["a", "The", "été", "漢字", "abcdefgh", "abcdefghi", "sixteenletterswo", "seventeenletterswo", "x" * 40,
            "x" * 41, "ÄÖ", "zz"]
    rows = []
    for _ in range(n):
        source = rng.choice(["s0", "s0", "s1", "s2", None])
        text = rng.choice([" ", "-", "9", "\n"]).join(rng.choice(pool[hash(source or "") % 3:]) for _ in range(
            rng.randrange(30)))
        rows.append((rng.choice(["en", "en", "de", None]), source, rng.choice([text] * 9 + [None])))
    return rows + [rows[0]] * 3 + [("fr", "s0", "two words"), ("fr", "s1", ""), ("it", "s0", "alone")]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    return sorted(tuple(r) for r in d.source_divergence(df, **options).collect())


def test_matches_brute_force(spark):
    rows = made(random.Random(13))
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[2] for r in got} == {"pair", "term"} and ("fr", "s0", "pair", "s1", 0, 1) in got
    assert run(spark, rows, min_docs=1, top=3) == brute(rows, 1, 3)


def test_tiles_and_blocks_give_the_same_sums(spark, monkeypatch):
    rows = [("en", f"s{i % 23}", t) for i, (_, _, t) in enumerate(made(random.Random(14), 400))]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    counts = d.term_counts(docs)
    terms = d.kept_terms(counts, 2)
    kept = counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "times", "lang_times")
    totals = d.group_totals(docs.select("lang", "source").distinct(), kept, terms)
    plain = {frozenset(r[1:3]): r[3] for r in d.pair_sums(kept, totals).collect()}
    monkeypatch.setattr(d, "CELLS_PER_PAIR", 1)
    tiled = {frozenset(r[1:3]): r[3] for r in d.pair_sums(kept, totals, tile_sources=4, tile_cells=8).collect()}
    assert len(plain) == 23 * 22 // 2 and tiled == plain


def test_packed_counts_match_a_counter():
    rng = random.Random(15)
    texts = [" ".join("".join(rng.choice("abÄ漢") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 30])))
                      for _ in range(rng.randrange(40))).encode() for _ in range(80)] + [b"", b"..", "é".encode() * 9]
    group = [rng.randrange(3) for _ in texts]
    want, docs = defaultdict(int), defaultdict(set)
    for i, (t, g) in enumerate(zip(texts, group)):
        for term in terms_of(t.decode()):
            want[g, term.encode()] += 1
            docs[g, term.encode()].add(i)
    got = {}
    for groups, terms, times, n in d.count_terms(texts, group):
        for g, t, c, m in zip(groups.tolist(), terms, times.tolist(), n.tolist()):
            assert (g, t) not in got
            got[g, t] = c, m
    assert got == {k: (v, len(docs[k])) for k, v in want.items()}


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2 ** 63, 5000).astype(np.uint64) >> np.uint64(40), rng.integers(0, 9, 5000).astype(np.uint64)
    assert np.array_equal(d.radix_order([b, a]), np.lexsort((a, b)))
    assert d.radix_order([np.zeros(0, np.uint64)]).tolist() == []


def test_shares_are_exact_for_large_counts(spark):
    rng = random.Random(16)
    for _ in range(200):
        total, kept = rng.randrange(1, 8 * 10 ** 15), rng.randrange(1, 10 ** 6)
        times = rng.randrange(0, total)
        want = 1 + 10 ** 9 * (times + 2) // (total + 2 * kept)
        assert d.shares(np.array([times]), np.array([total]), kept)[0] == want
    big = spark.createDataFrame([(5 * 10 ** 14, 3 * 10 ** 15, 12345)], "t long, n long, v long")
    from pyspark.sql import functions as F
    assert big.select(d.share(F.col("t"), F.col("n"), F.col("v"))).first()[0] == \
        1 + 10 ** 9 * (5 * 10 ** 14 + 2) // (3 * 10 ** 15 + 2 * 12345)


def test_batches_cover_all_texts():
    assert list(d._batches([], 10)) == []
    assert list(d._batches([3, 99, 1, 2, 3, 4], 6)) == [(0, 1), (1, 2), (2, 5), (5, 6)]


def test_odd_rows_and_empty_tables(spark, odd):
    got = sorted(tuple(r) for r in d.source_divergence(odd, min_docs=1).collect())
    assert got == brute([(r["lang"], r["source"], r["text"]) for r in odd.collect()], 1)
    assert d.source_divergence(odd.limit(0)).count() == 0
