import hashlib
import math
import random

import pytest
import regex as re
from pyspark.sql import functions as F

from riskframe.llm import chat_windows as cw
from riskframe.llm import host_reputation as hr
from riskframe.llm import mixing
from riskframe.llm.queries import ATTACK, chat_digests


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ---------------------------------------------------------------------- mixing

def poisson_quantile(rate, u):
    k, p = 0, math.exp(-rate)
    cdf = p
    while cdf <= u:
        k += 1
        p *= rate / k
        cdf += p
    return k


def brute_counts(rows, weights, total, seed):
    n = {}
    for _, s in rows:
        n[s] = n.get(s, 0) + 1
    w = {s: max(weights.get(s, 0.0), 0.0) for s in n}
    out = []
    for i, s in rows:
        rate = w[s] / sum(w.values()) * total / n[s] if sum(w.values()) else 0.0
        u = int(hashlib.md5(f"{seed}|{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        out.append(poisson_quantile(rate, u) if rate else 0)
    return out


def test_counts_are_poisson_quantiles(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    weights = {"a": 1.0, "b": 3.0, None: 0.5, "unused": 9.0, "c": 0.0}
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = mixing.mix_sources(docs, given, total=900, seed=4)
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert [counts.get(i, 0) for i, _ in rows] == brute_counts(rows, weights, 900, 4)
    assert {r["copy"] for r in got.collect()} == set(range(1, max(counts.values()) + 1))


def test_large_rates_and_target_shares(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "rare").otherwise("big").alias("source"))
    given = spark.createDataFrame([("rare", 1.0), ("big", 1.0)], "source string, weight double")
    n = {r["source"]: r["count"] for r in mixing.mix_sources(docs, given, total=20_000).groupBy("source").count().collect()}
    assert abs(n["rare"] - 10_000) < 500 and abs(n["big"] - 10_000) < 500


def test_order_is_global_and_plan_is_native(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("x").alias("copy"))
    got = mixing.mix_sources(docs)
    keys = [r["shuffle_key"] for r in got.where(F.spark_partition_id() == 0).select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert got.columns == ["doc_id", "source", "copy", "shuffle_key"]       # a clashing column is replaced
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)


def test_mixing_odd_rows(spark, odd):
    got = mixing.mix_sources(odd, total=2000)
    assert got.where("doc_id is null").count() > 0
    twice = got.where("doc_id = 1").groupBy("copy").count().collect()
    assert all(r["count"] == 2 for r in twice)
    assert mixing.mix_sources(odd.limit(0)).count() == 0


def test_rows_without_id_are_drawn_one_by_one(spark, monkeypatch):
    """Equal rows and different ones keep their expected number."""
    monkeypatch.setattr(mixing, "NUMBERED_AT_ONCE", 64)
    n = 5000
    for text in (F.lit("same"), F.col("id").cast("string")):
        docs = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"))
        for seed in (1, 2, 3):
            got = mixing.mix_sources(docs, seed=seed)
            k = got.count()
            assert abs(k - n) < 5 * math.sqrt(n)
            assert got.select("shuffle_key").distinct().count() == k
        docs = docs.unionByName(spark.range(100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source")))
        a, b = (sorted(map(tuple, mixing.mix_sources(d, seed=7).collect()), key=repr) for d in (docs, docs.repartition(7)))
        assert a == b


# ------------------------------------------------------------------ reputation

URLS = [(1, "http://WWW.Spam.Example.com/de/x?y#z"), (2, "https://a.example.net/en/1"), (3, "https://a.example.net/fr/1"),
        (4, "http://net/"), (5, "http://x.net"), (6, "ftp://b.org/fr"), (7, "ftp://b.org/fr/"), (8, None), (9, "no url"),
        (10, "a://b://c/d"), (11, "://h?p/q"), (12, "x://myexample.com/de/"), (13, "x://example.com/de/"), (14, "")]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in hr.url_filter(pages, labels).collect()}
    assert got[1] == ("www.spam.example.com", "/de/x", "example.com/de/", "block")
    assert got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("a.example.net", "/fr/1", "net/", "block")
    assert got[4] == ("net", "/", "net/", "block")
    assert got[5] == ("x.net", "", None, "allow")
    assert got[6] == ("b.org", "/fr", None, "allow")
    assert got[7] == ("b.org", "/fr/", "org/fr/", "allow")
    assert got[8] == got[9] == got[14] == ("", "", None, "allow")
    assert got[10] == ("b:", "//c/d", None, "allow")
    assert got[11] == ("h", "", None, "allow")
    assert got[12][2] is None and got[13][2] == "example.com/de/"


def test_bad_hosts_are_blocked_and_small_ones_shrunk(spark):
    pages, labels, k = [], [], 0
    def add(host, n, bad):
        nonlocal k
        for i in range(n):
            pages.append((k, f"http://{host}/p{i}"))
            labels.append((k, 0 if i < bad else 1, 0))
            k += 1
    add("bad.farm.com", 60, 55)
    add("good.site.com", 300, 6)
    add("one.fine.com", 2, 1)
    for i in range(20):
        add(f"h{i}.site{i}.com", 30, i % 3)
    got = hr.url_filter(spark.createDataFrame(pages, "page_id long, url string"),
                        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    verdict = {r["host"]: r["verdict"] for r in got.collect()}
    assert verdict["bad.farm.com"] == "block"
    assert verdict["good.site.com"] == "allow" and verdict["one.fine.com"] == "allow"
    assert "Python" not in plan_of(got)


def test_hosts_without_pages_back_off_to_domain_suffix_and_root(spark):
    """At a rate of bad pages of 0.26: good hosts stay, bad ones go, new ones
    are judged by what is known of their domain and suffix."""
    pages, labels, k = [], [], 0
    def add(host, n, bad):
        nonlocal k
        for i in range(max(n, 1)):
            pages.append((k, f"http://{host}/p{i}"))
            if n:
                labels.append((k, 0 if i < bad else 1, 0))
            k += 1
    for i in range(30):
        add(f"h{i}.site{i}.com", 40, 8 if i % 2 else 9)
    for i in range(4):
        add(f"w{i}.evil.com", 40, 38)
    add("fine.com", 60, 15)
    for host in ("new.evil.com", "user@new2.evil.com:8080", "new.fine.com", "new.site3.com", "unknown.org", "10.0.0.7", "a.co.uk"):
        add(host, 0, 0)
    got = hr.url_filter(spark.createDataFrame(pages, "page_id long, url string"),
                        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    by = {r["host"]: r for r in got.collect()}
    root = (sum(1 for _, q, _ in labels if q == 0) + 1) / (len(labels) + 2)
    assert 0.25 < root < 0.32
    assert all(r["lower"] is not None for r in by.values())
    blocked = {h for h, r in by.items() if r["verdict"] == "block"}
    assert blocked == {"w0.evil.com", "w1.evil.com", "w2.evil.com", "w3.evil.com", "new.evil.com",
                       "user@new2.evil.com:8080"}


def test_names_and_addresses(spark):
    rows = ["a.b.example.com", "u:p@a.b.example.com:443", "x.co.uk", "co.uk", "10.1.2.3:80", "[::1]", "com", ""]
    df = spark.createDataFrame([(h,) for h in rows], "host string")
    got = [tuple(r) for r in df.select(hr.domain_of(F.col("host")), hr.suffix_of(F.col("host"))).collect()]
    assert got == [("example.com", "com")] * 2 + [("x.co.uk", "co.uk"), ("co.uk", "co.uk"), ("10.1.2.3", "10.1.2.3"),
                                                  ("[::1]", "[::1]"), ("com", "com"), ("", "")]


def test_empty_labels_and_clashing_names(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "z", 1.0, 5), (2, None, "z", 2.0, 5)],
                                  "page_id long, url string, host string, lower double, bad int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, host string")
    assert {r["verdict"] for r in hr.url_filter(pages, none).collect()} == {"allow"}
    marked = spark.createDataFrame([(1, 0, 0, "q"), (1, 1, 0, "q")], "doc_id long, quality int, toxic int, host string")
    assert {r["page_id"]: r["n_labelled"] for r in hr.url_filter(pages, marked).collect()} == {1: 2, 2: 0}


def test_reputation_odd_rows(spark):
    pages = spark.createDataFrame([(None, "http://a.b/c", "z"), (1, None, "z"), (1, None, "z")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert hr.url_filter(pages, labels).count() == 3
    assert hr.url_filter(pages.limit(0), labels).count() == 0


# ------------------------------------------------------------------------ chat

NASTY = ["", "plain", ATTACK, "<s>", "<\\s>", "<\\\\s>", "[INST", "INST]", "<<SYS>>x<</SYS>>", "[ROLE:41]y[/ROLE]", "a<", "a[", "\\", "$1\\1",
         "<</SYS>", "[/INST", "[\\/INST]", "日本 😀 </s>", "x\n\n y ", "<<s>>", "/s>", "<" * 5 + "/s>"]


def conversations(rng):
    rows = []
    for c in range(12):
        n = rng.randrange(1, 25)
        for t in range(n):
            role = "system" if t == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "tool", None, "system"])
            text = rng.choice(NASTY) if rng.random() < 0.6 else "word " * rng.randrange(80)
            rows.append((c, t * rng.choice([1, 1, 1]), role, text if rng.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("span, history, block", [(1024, 256, 128), (40, 40, 4), (30, 0, 1)])
def test_round_trip(spark, monkeypatch, span, history, block):
    monkeypatch.setattr(cw, "BLOCK", block)
    rows = conversations(random.Random(span))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = cw.format_windows(df, span=span, history=history)
    got = {r["conv_id"]: r for r in chat_digests(windows).collect()}
    for c in range(12):
        mine = sorted((t, r or "", x or "") for cc, t, r, x in rows if cc == c)
        said = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert got[c]["n_turns"] == len(mine)
        assert got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)
    assert "Python" not in plan_of(windows)


def test_windows_keep_system_and_limited_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", f"t{t} " + "word " * 20) for t in range(1, 21)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    w = cw.format_windows(df, span=100, history=50).withColumn("read", cw.read_turns(F.col("formatted"))).orderBy("window").collect()
    assert len(w) > 3
    for r in w:
        assert r["read"][0]["role"] == "system" and r["read"][0]["text"] == "be kind"
        repeated = r["read"][1:r["n_repeated"]] if r["window"] else []
        assert len(repeated) <= 2
    new = [t["text"] for r in w for t in r["read"][r["n_repeated"]:]]
    assert new == [x for _, _, _, x in rows]


PIECES = re.compile(cw.PIECE)


def tokens(text):
    return len(PIECES.findall(text)) + cw.TURN_TOKENS


def brute_windows(rows, span, history, block):
    """(windows of one conversation as (repeated turns, new turns)) by a plain loop."""
    rows = sorted(((-1 if t is None else t // block, t is not None, t or 0, r or "", x or "") for t, r, x in rows))
    system = rows[0][3:] if rows[0][3] == "system" else None
    room = span - history - (tokens(system[1]) if system else 0)
    windows, used, last = [], 0, None
    for i, row in enumerate(rows):
        place = sum(1 for o in rows[:i] if o[0] == row[0]) // block
        n = tokens(row[4])
        first = row[0] == rows[0][0] and place == 0 and len(windows) == 1
        if not windows or (row[0], place) != last or used + n > (span if first else room):
            windows.append([])
            used = 0
        windows[-1].append(i)
        used += n
        last = row[0], place
    out = []
    for w in windows:
        new = [rows[i][3:] for i in w]
        head = [] if system is None or not w[0] else [system]
        left = min(history, span - sum(tokens(x) for _, x in [*head, *new]))
        old, k = [], w[0] - 1
        while k >= (1 if system else 0) and (left := left - tokens(rows[k][4])) >= 0:
            old.insert(0, rows[k][3:])
            k -= 1
        out.append((head + old, new))
    return out


@pytest.mark.parametrize("span, history, block", [(60, 20, 128), (100, 0, 4), (90, 60, 5), (40, 40, 3), (1024, 256, 128)])
def test_windows_match_a_plain_loop_and_keep_the_budget(spark, monkeypatch, span, history, block):
    monkeypatch.setattr(cw, "BLOCK", block)
    rng = random.Random(span + block)
    rows = conversations(rng) + [(99, rng.choice([None, 3, 4]), "user", f"text {i} " * 3) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = cw.format_windows(df, span=span, history=history).withColumn("read", cw.read_turns(F.col("formatted"))).collect()
    several = 0
    for c in {r[0] for r in rows}:
        want = brute_windows([r[1:] for r in rows if r[0] == c], span, history, block)
        mine = sorted((r for r in got if r["conv_id"] == c), key=lambda r: r["window"])
        assert [r["window"] for r in mine] == list(range(len(want)))
        for r, (old, new) in zip(mine, want):
            read = [(t["role"], t["text"]) for t in r["read"]]
            assert read == old + new and r["n_repeated"] == len(old)
            size = sum(tokens(x) for _, x in read)
            system = tokens(old[0][1]) if old and old[0][0] == "system" and r["window"] else 0
            assert size <= span or len(new) == 1 and system + tokens(new[0][1]) > span
        several += len(want) > 1
    assert several or span == 1024


def test_chat_odd_rows(spark):
    df = spark.createDataFrame([(None, None, None, None, 1), (1, 5, "user", "a", 1), (1, 5, "user", "a", 1), (1, None, "assistant", "b", 1)],
                               "conv_id long, turn long, role string, text string, window int")
    got = {r["conv_id"]: r["n_turns"] for r in chat_digests(cw.format_windows(df)).collect()}
    assert got == {None: 1, 1: 3}
    assert cw.format_windows(df.limit(0)).count() == 0
