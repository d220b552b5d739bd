"""License scan: notice phrases, identifier tags and license expressions.

One Aho-Corasick automaton over word numbers holds the words of all notice
phrases and of all identifier tags, so a text is scanned once.  What follows a
tag is read by a shunting-yard parser with the precedence with > and > or and
evaluated while it is parsed: "or" takes the alternative that binds least,
"and" binds to both sides, "with" an exception weakens its license.

The automaton is built from the tables below in every worker; its size does
not depend on the data.  Documents are mapped one by one, nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import map_texts
from riskframe.llm.words import alnum_words, char_starts

# Phrases and labels that every scan reports.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notices in the words of their licenses, and labels.
NOTICES = {
    "the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "apache license 2 0": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license v2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license v3": "gpl-3",
    "version 2 of the gnu general public license": "gpl-2",
    "version 3 of the gnu general public license": "gpl-3",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license version 3": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "mozilla public license 2 0": "mpl-2",
    "mozilla public license v 2 0": "mpl-2",
    "eclipse public license version 2": "epl-2",
    "eclipse public license v 2 0": "epl-2",
    "boost software license version 1": "bsl-1",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "2 clause bsd license": "bsd-2-clause",
    "3 clause bsd license": "bsd-3-clause",
    "the isc license": "isc",
    "the zlib license": "zlib",
    "free and unencumbered software released into the public domain": "unlicense",
    "cc0 1 0": "cc0",
    "cc by 3 0": "cc-by",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
}

# Words of the tags that a license expression follows.
TAGS = ("spdx license identifier", "license expression")

# Identifiers of license expressions (lower case), label, and what the license asks for.
IDENTIFIERS = {
    "0bsd": ("0bsd", "none"), "cc0-1.0": ("cc0", "none"), "unlicense": ("unlicense", "none"),
    "wtfpl": ("wtfpl", "none"), "mit-0": ("mit-0", "none"),
    "mit": ("mit", "notice"), "apache-2.0": ("apache-2", "notice"), "apache-1.1": ("apache-1.1", "notice"),
    "bsd-2-clause": ("bsd-2-clause", "notice"), "bsd-3-clause": ("bsd-3-clause", "notice"),
    "bsl-1.0": ("bsl-1", "notice"), "isc": ("isc", "notice"), "zlib": ("zlib", "notice"),
    "artistic-2.0": ("artistic-2", "notice"), "postgresql": ("postgresql", "notice"),
    "python-2.0": ("python-2", "notice"), "psf-2.0": ("psf-2", "notice"), "unicode-3.0": ("unicode-3", "notice"),
    "cc-by-3.0": ("cc-by", "notice"), "cc-by-4.0": ("cc-by", "notice"),
    "lgpl-2.1": ("lgpl-2.1", "files"), "lgpl-2.1-only": ("lgpl-2.1", "files"),
    "lgpl-2.1-or-later": ("lgpl-2.1", "files"), "lgpl-3.0": ("lgpl-3", "files"),
    "lgpl-3.0-only": ("lgpl-3", "files"), "lgpl-3.0-or-later": ("lgpl-3", "files"),
    "mpl-1.1": ("mpl-1.1", "files"), "mpl-2.0": ("mpl-2", "files"), "epl-1.0": ("epl-1", "files"),
    "epl-2.0": ("epl-2", "files"), "cddl-1.0": ("cddl-1", "files"),
    "gpl-2.0": ("gpl-2", "work"), "gpl-2.0-only": ("gpl-2", "work"), "gpl-2.0-or-later": ("gpl-2", "work"),
    "gpl-3.0": ("gpl-3", "work"), "gpl-3.0-only": ("gpl-3", "work"), "gpl-3.0-or-later": ("gpl-3", "work"),
    "cc-by-sa-3.0": ("cc-by-sa", "work"), "cc-by-sa-4.0": ("cc-by-sa", "work"), "eupl-1.2": ("eupl-1.2", "work"),
    "agpl-3.0": ("agpl-3", "service"), "agpl-3.0-only": ("agpl-3", "service"),
    "agpl-3.0-or-later": ("agpl-3", "service"), "sspl-1.0": ("sspl-1", "service"),
    "cc-by-nd-4.0": ("cc-by-nd", "use"), "cc-by-nc-3.0": ("cc-by-nc", "use"), "cc-by-nc-4.0": ("cc-by-nc", "use"),
    "cc-by-nc-sa-4.0": ("cc-by-nc-sa", "use"), "cc-by-nc-nd-4.0": ("cc-by-nc-nd", "use"),
    "busl-1.1": ("busl-1.1", "use"),
}
# Obligations from the weakest to the strongest.
OBLIGATIONS = ("none", "notice", "files", "work", "service", "use")
#: Evidence of one finding; findings of different labels or kinds count as independent.
TAG_WEIGHT, NOTICE_WEIGHT = 0.9, 0.75

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_AFTER_TAG = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?")
_TOKEN = re.compile(rb"[ \t]*([()]|[0-9A-Za-z][0-9A-Za-z.+-]*)")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

NOTICE = T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType()),
                       T.StructField("base", T.BooleanType())])
EXPRESSION = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),          # code points
    T.StructField("licenses", T.ArrayType(T.StringType())),       # all named, sorted
    T.StructField("binding", T.ArrayType(T.StringType())),        # those left by the choices of "or", sorted
    T.StructField("obligation", T.StringType())])
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("notices", T.ArrayType(NOTICE)),
          T.StructField("expressions", T.ArrayType(EXPRESSION)), T.StructField("score", T.DoubleType())]


# ---------------------------------------------------------------- expressions

@dataclass(frozen=True)
class Value:
    """What an expression comes to."""
    level: int
    binding: frozenset
    named: frozenset

    def either(self, other: Value) -> Value:
        """Free choice: the weaker side binds, the left one where they are equal."""
        one = self if self.level <= other.level else other
        return Value(one.level, one.binding, self.named | other.named)

    def both(self, other: Value) -> Value:
        return Value(max(self.level, other.level), self.binding | other.binding, self.named | other.named)

    def excepted(self) -> Value:
        """An exception lets other works use the licensed one: at most its own files are bound."""
        return Value(min(self.level, OBLIGATIONS.index("files")), self.binding, self.named)


def license_value(token: str) -> Value | None:
    """The value of an identifier ("+" means "or later"), None if unknown."""
    found = IDENTIFIERS.get(token) or IDENTIFIERS.get(token.removesuffix("+"))
    if found is None:
        return None
    return Value(OBLIGATIONS.index(found[1]), frozenset([found[0]]), frozenset([found[0]]))


@dataclass
class ShuntingYard:
    """Feed tokens one by one; ``value()`` is that of all fed so far, once
    ``complete``.  ``push`` refuses a token that no expression could have
    there and leaves the state as it was."""
    values: list = field(default_factory=list)
    operators: list = field(default_factory=list)
    open: int = 0
    last: str = "start"        # start, operator, with, license, exception, open, close

    @property
    def complete(self) -> bool:
        return self.open == 0 and self.last in ("license", "exception", "close")

    def push(self, token: str) -> bool:
        ready = self.last in ("start", "operator", "open")          # for an operand
        if token == "(":
            if not ready:
                return False
            self.operators.append("(")
            self.open += 1
            self.last = "open"
        elif token == ")":
            if not self.open or self.last not in ("license", "exception", "close"):
                return False
            self._apply_down_to(0)
            self.operators.pop()
            self.open -= 1
            self.last = "close"
        elif token in _PRECEDENCE:
            if self.last not in ("license", "exception", "close") or token == "with" and self.last != "license":
                return False
            self._apply_down_to(_PRECEDENCE[token])
            self.operators.append(token)
            self.last = "with" if token == "with" else "operator"
        elif self.last == "with":
            if not token.endswith(("-exception", "-exception-2.0", "-exception-3.1", "-syscall-note")):
                return False
            self.values.append(None)
            self.last = "exception"
        else:
            value = license_value(token)
            if value is None or not ready:
                return False
            self.values.append(value)
            self.last = "license"
        return True

    def _apply_down_to(self, precedence: int) -> None:
        while self.operators and self.operators[-1] != "(" and _PRECEDENCE[self.operators[-1]] >= precedence:
            right, left = self.values.pop(), self.values.pop()
            self.values.append(_combine(self.operators.pop(), left, right))

    def value(self) -> Value:
        """The value of a complete expression; the state stays as it is.
        Outside of parentheses at most one operator of each precedence waits."""
        values = list(self.values)
        for op in reversed(self.operators):
            right, left = values.pop(), values.pop()
            values.append(_combine(op, left, right))
        return values[0]


def _combine(op: str, left: Value, right: Value | None) -> Value:
    if op == "with":
        return left.excepted()
    return left.either(right) if op == "or" else left.both(right)


def read_expression(text: bytes, at: int) -> tuple[int, int, Value] | None:
    """(start, end, value) in bytes of the longest complete expression of known
    identifiers that begins at byte ``at``; None if there is none."""
    yard, best, start = ShuntingYard(), None, None
    while m := _TOKEN.match(text, at):
        token, end = m.group(1).decode().lower(), m.end()
        if not yard.push(token):
            bare = token.rstrip(".")              # the end of a sentence
            if bare == token or not yard.push(bare):
                break
            end -= len(token) - len(bare)
        start = m.start(1) if start is None else start
        if yard.complete:
            best = start, end, yard.value()
        at = end
        if end != m.end():
            break
    return best


# ----------------------------------------------------------------------- scan

def build_automaton(phrases: dict[str, str], notices: dict[str, str], tags=TAGS):
    """(word -> number, automaton): values are (words, kind, label)."""
    import ahocorasick
    number: dict[bytes, int] = {}
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for kind, entries in (("tag", dict.fromkeys(tags)), ("notice", notices), ("base", phrases)):
        for phrase, label in entries.items():
            ids = tuple(number.setdefault(w, len(number) + 1) for w in phrase.encode().split())
            auto.add_word(ids, (len(ids), kind, label))
    auto.make_automaton()
    return number, auto


def scan(text: bytes | None, number: dict, auto) -> tuple:
    """(words, notices, expressions, score) of one text."""
    words = alnum_words(text)
    if not words:
        return 0, [], [], 0.0
    get = number.get
    hits = [(end - n + 1, end + 1, kind, label) for end, (n, kind, label)
            in auto.iter(tuple([get(w, 0) for w in words]))]
    if not hits:
        return len(words), [], [], 0.0
    notices = [(s, label, kind == "base") for s, _, kind, label in outermost(hits)]
    expressions = _expressions(text, [e - 1 for _, e, kind, _ in hits if kind == "tag"])
    found = {("notice", label) for _, label, _ in notices}
    found |= {("tag", label) for x in expressions for label in x[2]}
    doubt = 1.0
    for kind, _ in sorted(found):
        doubt *= 1 - (TAG_WEIGHT if kind == "tag" else NOTICE_WEIGHT)
    return len(words), notices, expressions, 1 - doubt


def outermost(hits: list[tuple]) -> list[tuple]:
    """Notices by start, without the further ones that lie inside a longer
    notice (its label says more); base phrases always stay."""
    out, reach = [], -1
    for h in sorted((h for h in hits if h[2] != "tag"), key=lambda h: (h[0], -h[1], h[2])):
        if h[2] == "base" or h[1] > reach:
            out.append(h)
        reach = max(reach, h[1])
    return out


def _expressions(text: bytes, last_words: list[int]) -> list[tuple]:
    """Expressions after the words of these numbers, with their code points."""
    if not last_words:
        return []
    wanted, out, chars = set(last_words), [], None
    for i, m in enumerate(_WORD.finditer(text)):
        if i not in wanted:
            continue
        after = _AFTER_TAG.match(text, m.end())
        got = read_expression(text, after.end()) if after else None
        if got is not None:
            chars = char_starts(text) if chars is None else chars
            start, end, value = got
            out.append((int(chars[start]), int(chars[end]), sorted(value.named), sorted(value.binding),
                        OBLIGATIONS[value.level]))
    return out


_BUILT: dict[tuple, tuple] = {}


def _scanner(phrases: dict[str, str], notices: dict[str, str]):
    key = (tuple(phrases.items()), tuple(notices.items()))

    def fn(texts):
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = build_automaton(phrases, notices)
        rows = [scan(t, *_BUILT[key]) for t in texts]
        return [[r[0] for r in rows], [[dict(zip(NOTICE.names, n)) for n in r[1]] for r in rows],
                [[dict(zip(EXPRESSION.names, x)) for x in r[2]] for r in rows], [r[3] for r in rows]]
    return fn


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """Per document: ``n_words``, ``notices`` (first word's number, label, and
    whether it is one of ``phrases``), ``expressions`` (code points, all
    licenses named, those that bind, their strongest obligation) and ``score``,
    the evidence for any license from 0 (nothing found) towards 1.

    Phrases are matched as whole, consecutive words, lower-cased in A-Z; all
    their places are reported, overlapping ones too.  A tag counts where ":" or
    "=" follows it; the expression is the longest complete one of known
    identifiers that follows in its line, and a tag without one says nothing.
    A null or empty text has no words and no findings.  Repeated rows are
    judged each; null ids stay null.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    source = docs.select(docs[id_col], docs[text_col].cast("string").alias("__body"))
    return map_texts(source, _scanner(phrases, notices), FIELDS, "__body", carry=[id_col])


def base_places(notices="notices"):
    """The notices that are base phrases."""
    return F.filter(notices, lambda n: n["base"])


def all_labels(notices="notices", expressions="expressions"):
    """Distinct, sorted labels of notices and of all licenses named."""
    named = F.flatten(F.transform(expressions, lambda x: x["licenses"]))
    return F.array_sort(F.array_distinct(F.concat(F.transform(notices, lambda n: n["label"]), named)))
