import random
import re

import pytest

from riskframe.llm import license_scan as s

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_base(text):
    w, found = words_of(text), []
    for phrase, label in s.BASE_PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(found)


# ----- an expression by recursive descent over a fixed list of tokens, tried on every prefix

def parse(tokens):
    """Value of exactly these tokens, or None."""
    def alternatives(i):
        v, i = conjunction(i)
        while v and i < len(tokens) and tokens[i] == "or":
            w, i = conjunction(i + 1)
            v = w and v.either(w)
        return v, i

    def conjunction(i):
        v, i = simple(i)
        while v and i < len(tokens) and tokens[i] == "and":
            w, i = simple(i + 1)
            v = w and v.both(w)
        return v, i

    def simple(i):
        if i >= len(tokens):
            return None, i
        if tokens[i] == "(":
            v, i = alternatives(i + 1)
            return (v, i + 1) if v and i < len(tokens) and tokens[i] == ")" else (None, i)
        v = s.license_value(tokens[i])
        if v and i + 1 < len(tokens) and tokens[i + 1] == "with":
            ok = i + 2 < len(tokens) and "exception" in tokens[i + 2]
            return (v.excepted(), i + 3) if ok else (None, i)
        return v, i + 1

    v, i = alternatives(0)
    return v if v and i == len(tokens) else None


def test_expressions_match_recursive_descent():
    rng = random.Random(3)
    pool = ["MIT", "apache-2.0", "GPL-2.0-only", "GPL-3.0+", "AGPL-3.0", "CC0-1.0", "what", "and", "OR", "And", "or",
            "WITH", "with Classpath-exception-2.0", "(", ")", "(", ")", "GCC-exception-3.1"]
    some = 0
    for _ in range(4000):
        if rng.random() < 0.5:
            text = " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))
        else:                                       # mostly well formed
            def expr(d):
                if d == 0 or rng.random() < 0.3:
                    return rng.choice(pool[:6]) + rng.choice(["", "", " WITH Classpath-exception-2.0"])
                x = f"{expr(d - 1)} {rng.choice(['AND', 'OR'])} {expr(d - 1)}"
                return f"({x})" if rng.random() < 0.5 else x
            text = expr(4) + rng.choice(["", " and", " extra", " )", " OR ("])
        tokens = text.replace("(", " ( ").replace(")", " ) ").lower().split()
        want = next((v for n in range(len(tokens), 0, -1) if (v := parse(tokens[:n]))), None)
        got = s.read_expression(text.encode(), 0)
        assert (got and got[2]) == want, text
        if got:
            some += 1
            assert parse(text.encode()[got[0]:got[1]].decode().replace("(", " ( ").replace(")", " ) ")
                         .lower().split()) == want
    assert some > 1500


@pytest.mark.parametrize("text, named, binding, obligation", [
    ("MIT OR GPL-3.0-only", ["gpl-3", "mit"], ["mit"], "notice"),
    ("GPL-3.0-only or MIT and AGPL-3.0", ["agpl-3", "gpl-3", "mit"], ["gpl-3"], "work"),
    ("(GPL-3.0-only OR MIT) AND AGPL-3.0", ["agpl-3", "gpl-3", "mit"], ["agpl-3", "mit"], "service"),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2"], ["gpl-2"], "files"),
    ("GPL-2.0+", ["gpl-2"], ["gpl-2"], "work"),
    ("MIT. And so on", ["mit"], ["mit"], "notice"),
    ("MIT */ and MIT", ["mit"], ["mit"], "notice"),
])
def test_expression_values(text, named, binding, obligation):
    _, _, v = s.read_expression(text.encode(), 0)
    assert (sorted(v.named), sorted(v.binding), s.OBLIGATIONS[v.level]) == (named, binding, obligation)


@pytest.mark.parametrize("text", ["", "unknown", "and MIT", "(MIT", "WITH Classpath-exception-2.0", ")", "\nMIT"])
def test_no_expression(text):
    assert s.read_expression(text.encode(), 0) is None


def one(text):
    return s.scan(text.encode(), *s.build_automaton(s.BASE_PHRASES, s.NOTICES))


def test_tags_give_code_points_of_the_original():
    text = "été 漢\n# SPDX-License-Identifier: (MIT OR Apache-2.0) # end\n\"License-Expression\" = \"ISC\"\n"
    _, notices, found, score = one(text)
    assert notices == []
    assert [(text[a:b], named, binding) for a, b, named, binding, _ in found] == [
        ("(MIT OR Apache-2.0)", ["apache-2", "mit"], ["mit"]), ("ISC", ["isc"], ["isc"])]
    assert 0.99 < score < 1


def test_a_tag_without_an_expression_says_nothing():
    for text in ("SPDX-License-Identifier MIT", "SPDX-License-Identifier: see file", "the SPDX license identifier"):
        assert one(text)[1:] == ([], [], 0.0)


def test_longer_notices_hide_shorter_ones_but_no_base_phrase():
    labels = lambda t: [(n[1], n[2]) for n in one(t)[1]]
    assert labels("Licensed under CC BY-NC 4.0.") == [("cc-by-nc", True)]
    assert labels("CC BY-NC-SA 4.0") == [("cc-by-nc-sa", False), ("cc-by-nc", True)]
    assert labels("Released under the MIT License.") == [("mit", True)]
    assert labels("GNU General Public License, version 3.") == [("gpl-3", False)]
    assert labels("please cc by mail, by nc") == []


def test_base_places_match_brute_force(spark, docs_of):
    rng = random.Random(5)
    pool = "under the mit license apache version 2 cc by nc été Apache MIT 2.0".split()
    texts = [rng.choice([" ", ", ", "-"]).join(rng.choice(pool) for _ in range(rng.randrange(60)))
             + rng.choice(["", " Under the MIT license, version 2", " cc-by/nc cc by nc", "apache LICENSE-version 2.0"])
             for _ in range(200)] + [None, "", "cc by nc " * 5000]
    got = {r["doc_id"]: r for r in s.scan_licenses(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        n, want = brute_base(t)
        assert got[i]["n_words"] == n
        assert sorted((x["word"], x["label"]) for x in got[i]["notices"] if x["base"]) == want
        assert 0 <= got[i]["score"] <= 1 and (got[i]["score"] > 0) == bool(got[i]["notices"])


def test_odd_rows_and_empty_tables(spark, odd):
    got = s.scan_licenses(odd)
    rows = sorted(((r["doc_id"], r["n_words"], len(r["notices"]), r["score"]) for r in got.collect()), key=repr)
    want = [(r["doc_id"], len(words_of(r["text"])), 0, 0.0) for r in odd.collect()]
    assert rows == sorted(want, key=repr)
    assert s.scan_licenses(odd.limit(0)).count() == 0


def test_query_columns(spark, tmp_path, docs_of):
    from riskframe.llm.queries import QUERIES
    docs_of(["Under the MIT License; x under the mit license. SPDX-License-Identifier: ISC", None]) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r.asDict() for r in QUERIES["op12_license_scan"](spark, str(tmp_path)).collect()}
    assert got[0] | {"score": 0} == {"doc_id": 0, "n_words": 13, "n_base": 2, "first_word": 0, "last_word": 5,
                                     "base_labels": "mit", "labels": "isc,mit", "score": 0}
    assert got[1] == {"doc_id": 1, "n_words": 0, "n_base": 0, "first_word": None, "last_word": None,
                      "base_labels": "", "labels": "", "score": 0.0}
