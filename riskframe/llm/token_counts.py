"""Edit-aware token counts over per-document pre-token trees.

Byte-pair merges never cross a pre-token, so a document's token count is the
sum over its pre-tokens.  The tree's leaves are runs of up to ``LEAF``
pre-tokens with their characters and tokens; each upper level sums ``FANOUT``
nodes of the level below.  An edit finds its leaves by descending the sums,
splits only their text anew (with the context in front that the pattern may
look at, and behind until old and new boundaries meet), and adds the change to
the sums above.  A leaf may grow or empty; the tree is rebuilt when one grows
beyond ``OVERFULL`` leaves.
"""

from __future__ import annotations

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.bpe import PATTERN, VOCABULARY, encoding
from riskframe.llm.common import map_texts

LEAF, FANOUT, OVERFULL = 64, 16, 8
#: The pattern looks at most this far beyond the end of a pre-token.
LOOKAHEAD = 2
_SPLIT = regex.compile(PATTERN)


class TokenCounts(dict):
    """Pre-token -> number of tokens, remembered for a bounded number."""

    LIMIT = 500_000

    def __init__(self, path: str = VOCABULARY):
        super().__init__()
        self.path = path

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        n = len(encoding(self.path).encode_ordinary(piece))
        if len(piece) <= 64:
            self[piece] = n
        return n


_COUNTS: dict[str, TokenCounts] = {}


def counts_for(path: str) -> TokenCounts:
    if path not in _COUNTS:
        _COUNTS[path] = TokenCounts(path)
    return _COUNTS[path]


class TokenTree:
    """Pre-tokens of one text with their token counts in a tree of sums.

    ``encoded`` counts the characters that were split and counted so far.
    """

    def __init__(self, text: str, counts: TokenCounts):
        self.counts = counts
        self.text = text
        self.encoded = 0
        self._build(self._split(text, 0, len(text)))

    def _split(self, text: str, start: int, end: int) -> list[str]:
        self.encoded += end - start
        return _SPLIT.findall(text, start, end)

    def _build(self, pieces: list[str]) -> None:
        self.leaves = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        count = self.counts.__getitem__
        chars = [sum(map(len, x)) for x in self.leaves]
        tokens = [sum(map(count, x)) for x in self.leaves]
        self.levels = [(chars, tokens)]
        while len(chars) > 1:
            chars = [sum(chars[i:i + FANOUT]) for i in range(0, len(chars), FANOUT)]
            tokens = [sum(tokens[i:i + FANOUT]) for i in range(0, len(tokens), FANOUT)]
            self.levels.append((chars, tokens))

    @property
    def tokens(self) -> int:
        return self.levels[-1][1][0]

    def leaf_at(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, its first character)."""
        node, start = 0, 0
        for chars, _ in reversed(self.levels[:-1]):
            node *= FANOUT
            last = min(node + FANOUT, len(chars)) - 1
            while node < last and start + chars[node] <= at:
                start += chars[node]
                node += 1
        return node, start

    def _set_leaf(self, leaf: int, pieces: list[str]) -> None:
        """Replace a leaf and add the change to every sum above it."""
        chars, tokens = self.levels[0]
        dc = sum(map(len, pieces)) - chars[leaf]
        dt = sum(map(self.counts.__getitem__, pieces)) - tokens[leaf]
        self.leaves[leaf] = pieces
        for level_chars, level_tokens in self.levels:
            level_chars[leaf] += dc
            level_tokens[leaf] += dt
            leaf //= FANOUT

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters [start, end) by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        # the last boundary whose pre-token cannot have seen the edit
        first, at = self.leaf_at(max(start - 1, 0))
        while True:
            head, stop = [], at
            for p in self.leaves[first]:
                if stop + len(p) + LOOKAHEAD > start:
                    break
                head.append(p)
                stop += len(p)
            if head or first == 0:
                break
            first -= 1
            at -= self.levels[0][0][first]
        # split on until a new boundary behind the edit is an old one
        last, leaf, where = first, at, []
        boundary = at                       # old boundaries, shifted to the new text
        leaf_end = at + self.levels[0][0][first]
        old = iter(())
        middle: list[str] = []
        edge = start + len(new)
        n_leaves = len(self.leaves)
        bounds: dict[int, tuple[int, int]] = {}
        read = first - 1
        position = at
        for m in _SPLIT.finditer(text, stop):
            middle.append(m.group())
            e = m.end()
            self.encoded += e - m.start()
            if e < edge:
                continue
            while position <= e - shift and read + 1 < n_leaves:
                read += 1
                for k, p in enumerate(self.leaves[read]):
                    position += len(p)
                    bounds[position] = (read, k + 1)
            if e - shift >= end and e - shift in bounds:
                last, k = bounds[e - shift]
                tail = self.leaves[last][k:]
                break
        else:
            last, tail = n_leaves - 1, []
        self.text = text
        for i in range(first + 1, last + 1):
            self._set_leaf(i, [])
        self._set_leaf(first, head + middle + tail)
        if len(self.leaves[first]) > OVERFULL * LEAF:
            self._build([p for x in self.leaves for p in x])


def derived_edits(id_col, text_col):
    """Three edits per text as a column, hashed from the id: a deletion, an
    insertion and a replacement, each in the coordinates of the text that the
    edits before it left; a text shorter than 32 characters gets the insertion
    only."""
    n = F.length(text_col)
    at = lambda k: F.pmod(F.xxhash64(F.lit(k), F.col(id_col)), F.greatest(n - 24, F.lit(1))).cast("int")
    edit = lambda s, e, new: F.struct(s.alias("start"), e.alias("end"), new.alias("new"))
    word = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 6)
    insert = edit(at(2), at(2), F.concat(F.lit(" note "), word))
    rest = F.array(edit(at(1), at(1) + 9, F.lit("")), insert, edit(at(3), at(3) + 5, F.concat(word, F.lit("'s\n"))))
    return F.when(F.coalesce(n, F.lit(0)) >= 32, rest).otherwise(F.array(insert))


EDIT = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                     T.StructField("new", T.StringType())])
FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("n_tokens_edited", T.LongType()),
          T.StructField("n_chars_edited", T.LongType()), T.StructField("chars_encoded", T.LongType()),
          T.StructField("n_leaves", T.IntegerType())]


def count_edited(docs: DataFrame, edits: str = "edits", id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: tokens before and after its ``edits`` (an array column of
    (start, end, new), applied in turn), and how many characters the edits had
    split and counted anew.

    A null text is ''; null edits are none; an edit beyond the text is moved to
    its end.  Nothing is shuffled; a worker holds one document's tree at a time.
    """
    src = docs.select(docs[id_col], docs[text_col].cast("string").alias("text"), docs[edits].alias("edits"))
    schema = T.StructType([src.schema.fields[0], *FIELDS])

    def run(batches):
        import pyarrow as pa
        counts = counts_for(vocabulary)
        for b in batches:
            rows = [(count_one(t.as_py(), e.as_py(), counts)) for t, e in zip(b.column(1), b.column(2))]
            cols = list(zip(*rows)) if rows else [[] for _ in FIELDS]
            kinds = [pa.int64()] * 4 + [pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=[id_col, *[f.name for f in FIELDS]])
    return src.mapInArrow(run, schema)


def count_one(text: str | None, edits, counts: TokenCounts) -> tuple[int, int, int, int, int]:
    tree = TokenTree(text or "", counts)
    before, whole = tree.tokens, tree.encoded
    for e in edits or ():
        if e is not None:
            tree.edit(e["start"] or 0, e["end"] or 0, e["new"] or "")
    return before, tree.tokens, len(tree.text), tree.encoded - whole, len(tree.leaves)


def token_counts(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None,
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """Exact counts without edits: the ``carry`` columns and ``n_tokens``."""
    def fn(texts):
        counts = counts_for(vocabulary)
        return [[TokenTree(t.decode("utf-8") if t else "", counts).tokens for t in texts]]
    return map_texts(docs, fn, [T.StructField("n_tokens", T.LongType())], text_col, carry)
