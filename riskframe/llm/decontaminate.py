"""Benchmark decontamination with one Aho-Corasick automaton per benchmark block.

Normalised benchmark texts are cut into windows of ``window`` consecutive
words (a shorter text is one window).  The automaton runs over word numbers,
so a text is scanned once, whatever the number of windows; matches are word
positions, which map to code-point offsets of the original text.

The benchmark is the small side, but its size is checked: items are taken in
blocks of at most ``block_words`` words, one automaton each, so what a task
holds is bounded for any benchmark; the blocks' spans are merged per document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import map_texts, scratch_table
from riskframe.llm.words import alnum_words, char_starts

WINDOW = 13
#: Largest number of words in one automaton: about 13 nodes for each of them.
BLOCK_WORDS = 250_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_AUTOMATA: dict[str, tuple] = {}

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FIELDS = [T.StructField("__d_words", T.LongType()),
          T.StructField("__d_hits", T.ArrayType(SPAN)),       # word positions, merged, end exclusive
          T.StructField("__d_items", T.ArrayType(T.StringType())),
          T.StructField("__d_spans", T.ArrayType(SPAN))]      # code points of the original text


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str,
                     block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """Items as (id, normalised words) in blocks of bounded size, read one
    partition at a time."""
    rows = map_texts(benchmark.select(benchmark[item_id].cast("string").alias("id"),
                                      benchmark[text].alias("text")),
                     lambda texts: [[b" ".join(alnum_words(t)) for t in texts]],
                     [T.StructField("words", T.BinaryType())], carry=["id"])
    rows = rows.where(F.octet_length("words") > 0).distinct()
    block, size = [], 0
    for r in rows.toLocalIterator():
        n = bytes(r["words"]).count(b" ") + 1
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r["id"], bytes(r["words"])))
        size += n
    if block:
        yield block


def build_automaton(block: list[tuple[str, bytes]], window: int = WINDOW):
    """(word -> number, automaton whose values are (words, items))."""
    import ahocorasick
    number: dict[bytes, int] = {}
    owners: dict[tuple, set] = {}
    for item, joined in block:
        ids = tuple(number.setdefault(w, len(number) + 1) for w in joined.split(b" "))
        for i in range(max(1, len(ids) - window + 1)):
            owners.setdefault(ids[i:i + window], set()).add(item)
    if not owners:
        return number, None
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for ids, items in owners.items():
        auto.add_word(ids, (len(ids), tuple(items)))
    auto.make_automaton()
    return number, auto


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def scan(text: bytes | None, number: dict, auto):
    """(words, hit word ranges, sorted item ids, original code-point spans)."""
    words = alnum_words(text)
    if not words or auto is None:
        return len(words), [], [], []
    get = number.get
    ids = tuple([get(w, 0) for w in words])
    found, items = [], set()
    for end, (n, owners) in auto.iter(ids):
        found.append((end - n + 1, end + 1))
        items.update(owners)
    if not found:
        return len(words), [], [], []
    hits = merge_spans(found)
    at = np.array([m.span() for m in _WORD.finditer(text)])
    chars = char_starts(text)
    spans = [(int(chars[at[s, 0]]), int(chars[at[e - 1, 1]])) for s, e in hits]
    return len(words), hits, sorted({"" if i is None else i for i in items}), spans


def _scanner(key: str, block, window: int):
    def fn(texts):
        if key not in _AUTOMATA:
            _AUTOMATA.clear()                 # one automaton at a time in a worker
            _AUTOMATA[key] = build_automaton(block.value, window)
        number, auto = _AUTOMATA[key]
        rows = [scan(t, number, auto) for t in texts]
        span = lambda v: [{"start": s, "end": e} for s, e in v]
        return [[r[0] for r in rows], [span(r[1]) for r in rows], [r[2] for r in rows],
                [span(r[3]) for r in rows]]
    return fn


def annotate(docs: DataFrame, benchmark: DataFrame, carry: list[str], text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """``carry`` columns of every row of ``docs`` plus the ``FIELDS``.

    One block (the usual case) is a map over the documents without a shuffle.
    With more blocks each scans the documents in turn, and only rows with a
    hit are merged per row.
    """
    import hashlib
    sc = docs.sparkSession.sparkContext
    scans = []
    blocks = benchmark_blocks(benchmark, item_id, item_text, block_words)
    first = next(blocks, [])
    second = next(blocks, None)

    def one(block, source, columns):
        key = hashlib.sha256(repr((window, block)).encode()).hexdigest()
        return map_texts(source, _scanner(key, sc.broadcast(block), window), FIELDS, text_col, columns)

    if second is None:
        return one(first, docs, carry)
    numbered = scratch_table(docs.select(*[docs[c] for c in dict.fromkeys([*carry, text_col])])
                             .withColumn("__row", F.monotonically_increasing_id()), "decontaminate")
    from itertools import chain
    for block in chain([first, second], blocks):
        hit = one(block, numbered, ["__row"]).where(F.size("__d_hits") > 0)
        scans.append(scratch_table(hit, "hits"))
    union = scans[0]
    for s in scans[1:]:
        union = union.unionByName(s)
    merged = union.groupBy("__row").agg(
        F.flatten(F.collect_list("__d_hits")).alias("h"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__d_items")))).alias("__d_items"),
        F.flatten(F.collect_list("__d_spans")).alias("s"))
    ranges = T.ArrayType(SPAN)

    def tidy(texts):
        return [[len(alnum_words(t)) for t in texts]]

    counted = map_texts(numbered, tidy, FIELDS[:1], text_col, [*carry, "__row"])
    join = counted.join(merged, "__row", "left")
    none = F.array().cast(ranges)
    return join.select(*[join[c] for c in carry], "__d_words",
                       F.coalesce(union_spans(F.col("h")), none).alias("__d_hits"),
                       F.coalesce("__d_items", F.array().cast("array<string>")).alias("__d_items"),
                       F.coalesce(union_spans(F.col("s")), none).alias("__d_spans"))


def union_spans(spans):
    """Merge overlapping or touching spans of an array column."""
    kind = "array<struct<start:int,end:int>>"
    return F.aggregate(
        F.array_sort(spans), F.array().cast(kind),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(x))))


def hit_words(hits="__d_hits"):
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])


def is_contaminated(n_words, n_hit):
    """At least one word in twenty lies in a benchmark window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, the ids of the items with an
    occurring window, ``spans`` (code points of the original text) and
    ``contaminated``.

    A null or empty text has no words, hence no hits and is not contaminated;
    the same holds for an empty benchmark.  Benchmark items without words are
    skipped, a null item id counts as ''.  Repeated rows are judged each.
    """
    got = annotate(docs, benchmark, [id_col], **options)
    return got.select(id_col, F.col("__d_words").alias("n_words"), hit_words().alias("n_hit"),
                      F.col("__d_items").alias("item_ids"), F.col("__d_spans").alias("spans")) \
        .withColumn("contaminated", is_contaminated(F.col("n_words"), F.col("n_hit")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    got = annotate(docs, benchmark, list(docs.columns), **options)
    return got.where(~is_contaminated(F.col("__d_words"), hit_words())).select(*[got[c] for c in docs.columns])
