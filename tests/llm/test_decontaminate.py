import random
import re

from riskframe.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(text, items):
    """(words, hit positions, items) by comparing all windows."""
    w = WORD.findall(lower(text))
    hit, names = set(), set()
    for name, t in items:
        iw = WORD.findall(lower(t))
        k = min(13, len(iw))
        windows = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if iw else set()
        for i in range(len(w) - k + 1 if iw else 0):
            if tuple(w[i:i + k]) in windows:
                hit.update(range(i, i + k))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def made(rng):
    vocab = ["Ab", "été", "x1", "Ñu", "zz", "q", "漢"]
    phrase = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, phrase(n)) for i, n in enumerate([1, 2, 4, 13, 14, 30, 40, 13])] + [(50, ""), (51, "!!"), (52, None)]
    docs = []
    for _ in range(60):
        parts = [phrase(rng.randrange(1, 30))]
        if rng.random() < 0.7:
            w = WORD.findall(rng.choice(items[:8])[1])
            i = rng.randrange(len(w))
            parts.append(" ".join(w[i:i + 20]))
        docs.append("; ".join(parts + [phrase(5)]))
    return docs + ["", None, "...", "q"], items


def run(spark, docs_of, texts, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: r for r in d.decontaminate(docs_of(texts), bench, **options).collect()}


def test_matches_brute_force(spark, docs_of):
    texts, items = made(random.Random(6))
    got = run(spark, docs_of, texts, items)
    for i, t in enumerate(texts):
        n, hit, names = brute(t, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"]) == (n, hit, names)
        assert got[i]["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_benchmark_in_blocks_gives_the_same(spark, docs_of):
    texts, items = made(random.Random(7))
    a, b = run(spark, docs_of, texts, items), run(spark, docs_of, texts, items, block_words=20)
    assert {k: v.asDict(True) for k, v in a.items()} == {k: v.asDict(True) for k, v in b.items()}


def test_spans_are_places_in_the_original(spark, docs_of):
    items = [(1, "été à la MER")]
    text = "😀 Oh: ÉTÉ?! été  À la, MER; été à LA mer fin"
    row = run(spark, docs_of, [text], items)[0]
    # lower-casing is for A-Z only, so É and À differ from é and à
    assert [text[s["start"]:s["end"]] for s in row["spans"]] == ["été à LA mer"]


def test_drop_keeps_clean_rows_and_columns(spark, docs_of):
    items = [(1, " ".join("w%d" % i for i in range(13)))]
    clean = " ".join("c%d" % i for i in range(300))
    docs = docs_of([clean, items[0][1] + " end", items[0][1] + " " + clean, None, ""])
    kept = d.drop_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4]


def test_odd_rows(spark, odd):
    bench = spark.createDataFrame([(None, "words in a row"), (1, None)], "item_id long, text string")
    rows = d.decontaminate(odd, bench).collect()
    assert len(rows) == 9 and all(r["n_hit"] == 80 and r["item_ids"] == [""] for r in rows if r["doc_id"] == 1)
    none = d.decontaminate(odd, bench.limit(0)).collect()
    assert not any(r["contaminated"] for r in none)
    assert d.decontaminate(odd.limit(0), bench).count() == 0
    assert d.drop_contaminated(odd, bench).columns == odd.columns
