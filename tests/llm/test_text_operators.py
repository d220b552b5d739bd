import hashlib
import math
import random
import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from riskframe.llm import compression_quality as cq
from riskframe.llm import secrets as sec
from riskframe.llm import token_counts as tc
from riskframe.llm.bpe import PATTERN, VOCABULARY, count_tokens


# --------------------------------------------------------------------- secrets

def brute_base(text):
    """Base spans by single-character classes on code points."""
    text = text or ""
    value = r"[A-Za-z0-9+/_.=-]+"
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                   for k in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    out = []
    for m in re.finditer(rf"({key})[\"']? *[:=] *[\"']?({value})", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def secret_texts(rng):
    parts = ["password=abc", "PassWord: 'hunter22'", "token: token: abcdefgh", "api_key=\"A1b2C3d4E5f6\"", "apikey : zz", "ſecret=abcdefg",
             "AKIA" + "Q" * 15, "AKIA" + "Z9" * 8, "AKIAAKIA" + "1" * 30, "0" * 23, "0123456789abcdef" * 2, "deadbeef" * 3 + "G",
             "été", "漢字", "😀", "plain words", "token=\n", "secret = = abcdefgh", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"]
    return ["".join(rng.choice(parts) + rng.choice([" ", "\n", "", ", "]) for _ in range(rng.randrange(8))) for _ in range(150)] + ["", None]


def test_base_spans_match_brute_force(spark, docs_of):
    texts = secret_texts(random.Random(3))
    got = {r["doc_id"]: r for r in sec.scan_secrets(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        want = brute_base(t)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[0] == k for x in want) for k in ("assign", "access", "hex")]
        kept = [x for x in got[i]["spans"].split(",") if x and not x.startswith("random")]
        assert ",".join(kept) == joined


@pytest.mark.parametrize("run, random_", [
    (b"q7Zt9XkP2vLw8RnB4cYd", True), (b"dGhpcyBpcyBub3QgYSBzZWNyZXQ4Nzg", True), (b"Xy7-kQ2_pL9wZr4TnV8sB1", True),
    (b"9f86d081884c7d659a2feaa0c55ad015", False), (b"123e4567-e89b-12d3-a456-426614174000", False),
    (b"1234567890123456789", False), (b"internationalization", False), (b"chapter-1-introduction-to-the-history", False),
    (b"2024-01-31", False), (b"----------------", False)])
def test_token_efficiency(run, random_):
    assert sec.is_random(run) == random_


KEYS = {"base36": "abcdefghijklmnopqrstuvwxyz0123456789", "hex": "0123456789ABCDEF", "letters": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "base62": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "base64": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"}


@pytest.mark.parametrize("before, after", [("", ""), ("com/en/articles/download/", ""), ("--option-name=", "/settings/page"),
                                           ("some_long_variable_", "_and-the-rest-of-it")])
@pytest.mark.parametrize("kind", sorted(KEYS))
def test_keys_are_found_wherever_they_are_joined_to(kind, before, after):
    rng = random.Random(kind)
    found = 0
    for _ in range(200):
        key = "".join(rng.choice(KEYS[kind]) for _ in range(20 if kind != "base64" else 40))
        spans = sec.find_secrets(f"é {before}{key}{after} end".encode())
        s, e = 2 + len(before), 2 + len(before) + len(key)
        found += sum(max(0, min(b, e) - max(a, s)) for _, a, b in spans) >= 0.9 * len(key)
    assert found >= (170 if kind == "hex" else 190)


def test_the_random_part_alone_is_reported_and_redacted():
    key, plain = "q7zt9xkp2vlw8rnb4cyd", "com/en/articles/download/of-the-whole-history/"
    text = f"see {plain}{key}/introduction, {plain}123e4567-e89b-12d3-a456-426614174000 and AKIA{'A' * 16}/{plain}{key}/introduction".encode()
    at = [i for i in range(len(text)) if text.startswith(key.encode(), i)]
    spans = sec.find_secrets(text)
    assert [(s, e) for k, s, e in spans if k == "random"] == [(i, i + len(key)) for i in at]
    clean = sec.redact(text, spans)
    assert clean.count(plain) == 3 and clean.count("[SECRET]") == 3 and not sec.find_secrets(clean.encode())


def test_nothing_is_left_after_redaction():
    rng = random.Random(6)
    parts = ["com", "en", "us", "01", "x1", "b2c", "2024", "download", "Introduction", "q7Zt9XkP2vLw8RnB4cYd", "A1B2", "kQxZvWpLmN", "deadbeef" * 3,
             "123e4567-e89b-12d3-a456-426614174000"]
    for _ in range(500):
        text = "".join(rng.choice(parts) + rng.choice("/-_=+") for _ in range(rng.randrange(1, 12))).encode()
        assert not sec.find_secrets(sec.redact(text, sec.find_secrets(text)).encode()), text


def test_redaction_removes_all_spans_and_keeps_the_rest(spark, docs_of):
    texts = ["été password=hunter22 end", "clean", None, "", "x AKIA" + "A" * 20 + " y q7Zt9XkP2vLw8RnB4cYd"]
    docs = docs_of(texts)
    got = {r["doc_id"]: r for r in sec.redact_secrets(docs).collect()}
    assert [got[i]["text"] for i in range(5)] == ["été [SECRET] end", "clean", None, "", "x [SECRET] y [SECRET]"]
    assert got[0]["n_chars"] == len(got[0]["text"]) and got[1]["n_chars"] == 5
    assert sec.redact_secrets(docs).columns == docs.columns


def test_secrets_odd_rows(spark, odd):
    assert sec.scan_secrets(odd).count() == 9
    assert sec.scan_secrets(odd.limit(0)).count() == 0
    assert sec.redact_secrets(odd).columns == odd.columns


# ---------------------------------------------------------------- token counts

PIECES = ["", "  ", "'s", "\n\n", "a", " b", "'", "l", "ll", "123", "\t \n", "é!!", "   x", "'l", " ", "漢字", "😀"]


def test_edits_match_full_encoding():
    rng = random.Random(5)
    counts = tc.counts_for(VOCABULARY)
    for _ in range(40):
        tree = tc.TokenTree("".join(rng.choice(PIECES + ["word ", "Other, "]) for _ in range(rng.choice([0, 3, 200, 2500]))), counts)
        for _ in range(15):
            n = len(tree.text)
            s = rng.randint(0, n)
            e = min(n, s + rng.choice([0, 0, 1, 2, 5, 400]))
            new = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 2, 5, 700])))
            want = tree.text[:s] + new + tree.text[e:]
            tree.edit(s, e, new)
            assert tree.text == want and tree.tokens == count_tokens(want)
            assert [p for leaf in tree.leaves for p in leaf] == regex.findall(PATTERN, want)
            for (c, t), (c2, t2) in zip(tree.levels, tree.levels[1:]):
                assert [sum(c[i:i + tc.FANOUT]) for i in range(0, len(c), tc.FANOUT)] == c2
                assert [sum(t[i:i + tc.FANOUT]) for i in range(0, len(t), tc.FANOUT)] == t2


def test_an_edit_encodes_its_surroundings_only():
    tree = tc.TokenTree("some ordinary words in a row. " * 5000, tc.counts_for(VOCABULARY))
    whole = tree.encoded
    tree.edit(75_000, 75_009, "changed")
    assert tree.encoded - whole < 200


def test_query_counts_match_full_encoding(spark, docs_of):
    texts = ["short", "", None, "a longer text with words, and more words; " * 30, "été 漢字 " * 50]
    docs = docs_of(texts).withColumn("edits", tc.derived_edits("doc_id", "text"))
    got = {r["doc_id"]: r for r in tc.count_edited(docs).collect()}
    for r in docs.collect():
        t = r["text"] or ""
        assert got[r["doc_id"]]["n_tokens"] == count_tokens(t)
        for e in r["edits"]:
            s = min(e["start"], len(t))
            t = t[:s] + e["new"] + t[max(s, min(e["end"], len(t))):]
        assert got[r["doc_id"]]["n_tokens_edited"] == count_tokens(t)
        assert got[r["doc_id"]]["n_chars_edited"] == len(t)
    plain = {r["doc_id"]: r["n_tokens"] for r in tc.token_counts(docs_of(texts), carry=["doc_id"]).collect()}
    assert plain == {i: count_tokens(t or "") for i, t in enumerate(texts)}


def test_token_counts_odd_rows(spark, odd):
    assert tc.count_edited(odd.withColumn("edits", tc.derived_edits("doc_id", "text"))).count() == 9
    nulls = odd.withColumn("edits", F.lit(None).cast("array<struct<start:int,end:int,new:string>>"))
    assert all(r["n_tokens"] == r["n_tokens_edited"] for r in tc.count_edited(nulls).collect())
    assert tc.count_edited(nulls.limit(0)).count() == 0


# --------------------------------------------------------- quality classifier

def test_logistic_weights_recover_a_rule():
    rng = np.random.default_rng(1)
    x = np.c_[np.ones(4000), rng.normal(size=(4000, 2))]
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 1] - x[:, 2])))).astype(float)
    assert np.allclose(cq.fit_logistic(x, y), [0.5, 2, -1], atol=0.25)
    assert np.all(np.isfinite(cq.fit_logistic(x, np.ones(4000)))) and not cq.fit_logistic(x[:0], y[:0]).any()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = cq.score_quality(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert got["score"].between(0, 1).all()
    good = got["quality"] == 1
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    # the chance that a good text scores above a bad one
    rank = got["score"].rank()
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.97


def test_held_out_labels_are_not_learnt_from(spark, docs_of):
    rng = random.Random(2)
    docs = docs_of([" ".join(rng.choice(["aa", "bb", "cc"]) for _ in range(40)) if i % 2 else "#$% " * 40 for i in range(80)])
    labels = [(i, i % 2, 0) for i in range(80)]
    import zlib
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y, t) for i, y, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = ({r["doc_id"]: r["score"] for r in cq.score_quality(docs, spark.createDataFrame(x, schema)).collect()} for x in (labels, flipped))
    assert a == b


def test_classifier_odd_rows(spark, odd):
    schema = "doc_id long, quality int, toxic int"
    rows = cq.score_quality(odd, spark.createDataFrame([(1, 1, 0), (6, 0, 0), (None, 1, 0), (2, None, None)], schema)).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in cq.score_quality(odd, spark.createDataFrame([], schema)).collect()}) == 1
    assert cq.score_quality(odd.limit(0), spark.createDataFrame([], schema)).count() == 0


def plain_scores(rows, labels):
    """op3 by a direct zstandard loop, for texts of at most one piece."""
    import zlib
    import zstandard
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 4
    kinds = {}
    for i, y in labels:
        if i is not None and y in (0, 1):
            kinds.setdefault(i, set()).add(y)
    marks = {i: y.pop() for i, y in kinds.items() if len(y) == 1 and fold(i) != 2}
    text = {}
    for i, t in rows:
        if t is not None and i in marks:
            text[i] = min(text.get(i, t), t)
    shrink = []
    for y in (1, 0):
        d = b"\n".join(text[i].encode() for i in sorted(text) if marks[i] == y and fold(i) != 3)
        d = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shrink.append(zstandard.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_checksum=False,
                                               write_dict_id=False).compress)

    def difference(t):
        b = (t or "").encode()
        return 100 * (len(shrink[1](b)) - len(shrink[0](b))) / (len(b) + 64)
    x = np.array([difference(text[i]) for i in sorted(text) if fold(i) == 3])
    y = np.array([marks[i] for i in sorted(text) if fold(i) == 3], float)
    a = b = 0.0
    for _ in range(20_000):                         # plain gradient steps
        p = 1 / (1 + np.exp(-(a + b * x)))
        a, b = a - 0.05 * (p - y).mean(), b - 0.05 * (((p - y) @ x + 0.01 * b) / len(y)) / max(1, (x * x).mean())
    return [1 / (1 + math.exp(-min(max(a + b * difference(t), -30), 30))) for _, t in rows]


def test_scores_match_a_direct_loop(spark, docs_of):
    rng = random.Random(8)
    good, bad = ("river stone morning letter garden window music".split(), "buy click free win $$$ now!!! http".split())
    rows = []
    for i in range(400):
        kind = good if rng.random() < 0.6 else bad
        mixed = kind if rng.random() < 0.8 else good + bad
        rows.append((i, " ".join(rng.choice(mixed) for _ in range(rng.randrange(3, 40)))))
    labels = [(i, int(t.split()[0] in good)) for i, t in rows] + [(7, 0), (7, 1), (None, 1), (8, None), (9, 5)]
    rows += [(1000, ""), (1001, None), (5, "a second text of id 5"), (None, "no id")]
    df = spark.createDataFrame([(i, y, 0) for i, y in labels], "doc_id long, quality int, toxic int")
    got = cq.score_quality(docs_of(rows), df).collect()
    want = sorted(zip([i is None for i, _ in rows], [i or 0 for i, _ in rows], plain_scores(rows, labels)))
    mine = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in got)
    assert len(mine) == len(want)
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 2e-3 for a, b in zip(mine, want))
    # the order of the rows and conflicting labels make no difference
    again = cq.score_quality(docs_of(rows[::-1]), df.orderBy(F.rand(3))).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in again) == mine


def test_spans_are_walked_once():
    import time
    rng = random.Random(9)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    text = " ".join(key(32) + rng.choice(["", "-x", "/token=" + key(9)]) for _ in range(20_000))
    begin = time.monotonic()
    spans = sec.find_secrets(text.encode())
    assert len(spans) >= 20_000 and time.monotonic() - begin < 5


def test_random_spans_match_runs_cut_at_base_spans():
    """Every random span lies in a run outside of base spans and is found again
    when its uncovered stretch is scanned alone."""
    rng = random.Random(10)
    for text in secret_texts(rng):
        text = (text or "") + " " + "".join(rng.choice("abcdefXYZ0189+/_=-") for _ in range(60))
        spans = sec.find_secrets(text.encode())
        base = sorted((s, e) for k, s, e in spans if k != "random")
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text):
            free = [i for i in range(*m.span()) if not any(s <= i < e for s, e in base)]
            while free:
                n = next((k for k in range(1, len(free)) if free[k] != free[k - 1] + 1), len(free))
                part = text[free[0]:free[0] + n]
                want += [(free[0] + s, free[0] + e) for k, s, e in sec.find_secrets(part.encode()) if k == "random"]
                free = free[n:]
        assert [(s, e) for k, s, e in spans if k == "random"] == want
