"""Secret scans: known shapes plus a token-efficiency test.

Text that a vocabulary was made for needs few tokens; a random string needs
about one for every character or two.  Runs of key-like characters are secrets
if they have few characters per token (fewer still for letters only), unless
they are a digest of a known length, a UUID or covered by a known shape.  Text
joined to a key by a separator hides it in the ratio of the whole run, so the
pieces between separators are tested too.
Patterns run on UTF-8 bytes (all their classes are ASCII); offsets are code
points.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.bpe import VOCABULARY, encoding
from riskframe.llm.decontaminate import merge_spans
from riskframe.llm.common import map_texts, sha_of
from riskframe.llm.words import char_starts

KINDS = ["assign", "access", "hex", "random"]
# The shapes of the three base kinds.
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")         # runs are maximal
LEAST = {"assign": 6, "access": 20}

_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
_UUID_SHAPE = rb"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_PIECE = re.compile(rb"(?<![A-Za-z0-9])" + _UUID_SHAPE + rb"(?![A-Za-z0-9])|[A-Za-z0-9]+")
_DIGEST = re.compile(rb"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(_UUID_SHAPE + rb"\Z")
#: Below so many characters per token a run counts as random.
MAX_EFFICIENCY = 2.0
#: The same for letters only, with capitals after the first letter or without.
MAX_LETTERS, MAX_LOWER = 1.7, 1.6
LEAST_RANDOM = 16

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
FIELDS = [T.StructField("__s_spans", T.ArrayType(SPAN))]


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes, leftmost and non-overlapping per kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
           if len(m.group(2)) >= LEAST["assign"]]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def _n_tokens(run: bytes, path: str) -> int:
    return len(encoding(path).encode_ordinary(run.decode("ascii")))


def _known(run: bytes) -> bool:
    """A UUID or a digest of a known length."""
    return bool(_UUID.match(run) or len(run) in DIGEST_LENGTHS and _DIGEST.match(run))


def is_random(run: bytes, path: str = VOCABULARY, most: float = MAX_EFFICIENCY) -> bool:
    """Few characters per token, and no digest, UUID, plain word or number."""
    core = run.strip(b"=-_/+")
    if len(core) < LEAST_RANDOM or not any(c > 57 for c in core) or _known(core):
        return False
    if any(48 <= c <= 57 for c in core):
        return len(core) < most * _n_tokens(core, path)
    if not core.isalpha():
        return False
    return len(core) < min(most, MAX_LOWER if core[1:].islower() else MAX_LETTERS) * _n_tokens(core, path)


def _random_parts(run: bytes, at: int, path: str, most: float) -> list[tuple[int, int]]:
    """Extents of a run, which starts at ``at``, that are random: the whole,
    or else pieces and neighbours that are each inefficient (pieces of one or
    two characters tell nothing and join them).  What lies between the parts
    found is tested as a run of its own."""
    if len(run) < LEAST_RANDOM:
        return []
    if is_random(run, path, most):
        return [(at, at + len(run))]
    groups: list[list[tuple[int, int]]] = [[]]
    for m in _PIECE.finditer(run):
        p = m.group()
        if len(p) > 2:
            if not _known(p) and len(p) < most * _n_tokens(p, path):
                groups[-1].append(m.span())
            else:
                groups.append([])
    found = []
    for g in groups:
        if g and g[-1][1] - g[0][0] >= LEAST_RANDOM:
            whole = (g[0][0], g[-1][1])
            joined = is_random(run[whole[0]:whole[1]], path, most)
            found += [whole] if joined else [x for x in g if is_random(run[x[0]:x[1]], path, most)]
    if not found:
        return []
    out, last = [], 0
    for s, e in [*found, (len(run), len(run))]:
        out += _random_parts(run[last:s], at + last, path, most)
        if s < e:
            out.append((at + s, at + e))
        last = e
    return out


def find_secrets(text: bytes | None, path: str = VOCABULARY, most: float = MAX_EFFICIENCY):
    """All spans as (kind, start, end) in code points, by start, then kind."""
    if not text:
        return []
    spans = base_spans(text)
    covered, at = merge_spans((s, e) for s, _, e in spans), 0
    for m in _RUN.finditer(text):             # both lists rise, so each is walked once
        s, end = m.span()
        while at < len(covered) and covered[at][1] <= s:
            at += 1
        k = at
        while s < end:
            a, b = covered[k] if k < len(covered) and covered[k][0] < end else (end, end)
            if s < a:
                spans += [(x, 3, y) for x, y in _random_parts(text[s:a], s, path, most)]
            s, k = b, k + 1
    if not spans:
        return []
    if not text.isascii():
        at = char_starts(text)
        spans = [(int(at[s]), k, int(at[e])) for s, k, e in spans]
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)]


def annotate(docs: DataFrame, carry: list[str], text_col: str = "text", vocabulary: str = VOCABULARY,
             max_efficiency: float = MAX_EFFICIENCY) -> DataFrame:
    def fn(texts):
        return [[[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t, vocabulary, max_efficiency)]
                 for t in texts]]
    return map_texts(docs, fn, FIELDS, text_col, carry)


def _joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: the number of spans of each base kind, the digest of the
    base spans, all ``spans`` as text and ``n_random``.

    A null or empty text has no spans (the digest is that of the empty
    string); repeated rows are scanned each.
    """
    got = annotate(docs, [id_col], **options)
    count = lambda kind: F.size(F.filter("__s_spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("__s_spans", lambda s: s["kind"] != "random")
    return got.select(id_col, *[count(k).alias(f"n_{k}") for k in KINDS],
                      sha_of(_joined(base)).alias("base_sha256"), _joined(F.col("__s_spans")).alias("spans"))


def redact(text: bytes, spans, mark: str = "[SECRET]") -> str:
    """The text with each (merged) span replaced by ``mark``."""
    s = text.decode("utf-8")
    out, last = [], 0
    for _, start, end in sorted(spans, key=lambda x: x[1:]):
        if start >= last:
            out += [s[last:start], mark]
        last = max(last, end)
    return "".join([*out, s[last:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars",
                   vocabulary: str = VOCABULARY, max_efficiency: float = MAX_EFFICIENCY) -> DataFrame:
    """All rows of ``docs`` with their secrets replaced and, where there is
    such a column, the length of the text renewed; nothing else changes."""
    def fn(texts):
        found = [find_secrets(t, vocabulary, max_efficiency) for t in texts]
        return [[redact(t, f) if f else None for t, f in zip(texts, found)]]
    got = map_texts(docs, fn, [T.StructField("__clean", T.StringType())], text_col)
    new = {text_col: F.coalesce(F.col("__clean"), F.col(text_col)).alias(text_col)}
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        new[length_col] = F.when(F.col("__clean").isNotNull(), F.length("__clean").cast(kind)) \
            .otherwise(F.col(length_col)).alias(length_col)
    return got.select(*[new.get(c, F.col(c)) for c in docs.columns])
