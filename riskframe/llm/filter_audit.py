"""Filter interaction audit by the potential of the removal game.

The value of a coalition S of filters is the number of documents that at least
one of them removes.  The Hart-Mas-Colell potential P of that game is found
recursively, P(S) = (value(S) + sum of P(S without i) over i in S) / |S|, from
the empty coalition up; a filter's Shapley value is P(all) - P(all without
it).  Any order of the filters walks through nested coalitions, so what a step
removes is the difference of two coalition values: no order is replayed over
the documents.

Documents are reduced to one failure mask each, and those to counts per (part,
mask): what is left to the game is at most 2^filters rows per part.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import map_texts

_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
_LATER_BYTES = bytes(range(0x80, 0xC0))      # all but the first byte of a code point

FACTS = [T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType()),
         T.StructField("n_chars", T.LongType()), T.StructField("n_upper", T.LongType()),
         T.StructField("n_symbols", T.LongType()), T.StructField("digest", T.BinaryType())]
#: Measures of the removal game: all documents, labelled good ones, labelled toxic ones.
MEASURES = ("n", "good", "toxic")


def rules() -> dict[str, Column]:
    """The text rules as conditions on ``FACTS`` that a failing document meets."""
    return {"A": F.col("n_words") < 50,
            "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
            "C": 100 * F.col("n_upper") > 5 * F.col("n_chars"),
            "D": F.col("n_symbols") > 0}


def text_facts(texts: list[bytes | None]) -> list[list]:
    """The ``FACTS`` of every text; words are runs without ASCII white space."""
    out = []
    for t in texts:
        t = t or b""
        words = t.split()
        out.append((len(words), len(set(words)), len(t.translate(None, _LATER_BYTES)),
                    len(t) - len(t.translate(None, _UPPER)), len(t) - len(t.translate(None, _SYMBOLS)),
                    hashlib.sha256(t).digest()))
    return [list(c) for c in zip(*out)] if out else [[] for _ in FACTS]


def mask_of(conditions: dict[str, Column]) -> Column:
    """Bit i is set where the i-th condition holds; a null condition does not."""
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())]
    return sum(bits[1:], bits[0]) if bits else F.lit(0)


def failure_counts(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None,
                   id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail.

    The bit after those of ``conditions`` is the copy filter: a document fails
    it when a row of smaller id, anywhere in the table, has the same text.

    Rows are counted per (text digest, part, mask, id) before they meet the
    labels, and the copies of a text per (digest, part), so a text or an id
    that a third of the rows share is one pre-aggregated group, never a list.
    """
    conditions = rules() if conditions is None else conditions
    copy_bit = 1 << len(conditions)
    source = docs.select(docs[id_col].alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                         docs[text_col].cast("string").alias("text"))
    facts = map_texts(source, text_facts, FACTS, carry=["id", "part"])
    rows = facts.select("id", "part", "digest", mask_of(conditions).alias("mask")) \
        .groupBy("digest", "part", "mask", "id").agg(F.count("*").alias("rows"))
    marked = labels.groupBy(labels[id_col].cast("string").alias("label_key")).agg(
        F.max((labels["quality"] == 1).cast("int")).alias("is_good"),
        F.max((labels["toxic"] == 1).cast("int")).alias("is_toxic")).where("label_key is not null")
    # rows without an id match no label; the digest spreads them over the join's tasks
    rows = rows.withColumn("key", F.coalesce(F.col("id").cast("string"),
                                             F.concat(F.lit("no id "), F.hex("digest"))))
    rows = rows.join(marked, (rows["key"] == marked["label_key"]) & rows["id"].isNotNull(), "left") \
        .select("digest", "part", "mask", "id", F.struct(
            F.col("rows").alias("n"), (F.col("rows") * F.coalesce("is_good", F.lit(0))).alias("good"),
            (F.col("rows") * F.coalesce("is_toxic", F.lit(0))).alias("toxic")).alias("m"))
    at_part = rows.groupBy("digest", "part", "mask").agg(
        F.min("id").alias("least"), F.min_by("m", "id").alias("at_least"),
        *[F.sum(f"m.{m}").alias(m) for m in MEASURES],
        *[F.sum(F.when(F.col("id").isNull(), F.col(f"m.{m}")).otherwise(0)).alias(f"no_id_{m}") for m in MEASURES])
    first = at_part.groupBy(F.col("digest").alias("text")).agg(F.min("least").alias("first"))
    both = at_part.join(first, at_part["digest"] == first["text"])
    is_first = F.coalesce(F.col("least") == F.col("first"), F.lit(False))
    passing = {m: F.col(f"no_id_{m}") + F.when(is_first, F.col(f"at_least.{m}")).otherwise(0) for m in MEASURES}
    split = both.select("part", F.explode(F.array(
        F.struct(F.col("mask"), *[passing[m].alias(m) for m in MEASURES]),
        F.struct((F.col("mask") + copy_bit).alias("mask"), *[(F.col(m) - passing[m]).alias(m) for m in MEASURES])
    )).alias("c")).where("c.n > 0")
    return split.groupBy("part", F.col("c.mask").alias("mask")).agg(*[F.sum(f"c.{m}").alias(m) for m in MEASURES])


def coalition_values(counts: DataFrame, n_filters: int) -> DataFrame:
    """Per part ``total`` documents and, for each measure, the array of values
    of all coalitions: entry S counts what the filters of bit set S remove."""
    entries = F.collect_list(F.struct("mask", *MEASURES))
    parts = counts.groupBy("part").agg(entries.alias("e"), F.sum("n").alias("total"))

    def values(measure):
        def of(s):
            return F.aggregate("e", F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(
                x["mask"].bitwiseAND(s) != 0, x[measure]).otherwise(0))
        return F.transform(F.sequence(F.lit(0), F.lit(2 ** n_filters - 1)), of)

    return parts.select("part", "total", *[values(m).alias(m) for m in MEASURES])


def potentials(values: Column, n_filters: int) -> Column:
    """n! times the potential of every coalition, an exact integer: the
    potential is a sum of integers over sizes 1 to n, all of which divide n!.
    Coalitions without a member have smaller numbers, so one pass in the order
    of the numbers finds all that the recursion needs."""
    def step(acc, s):
        without = [F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(acc, s.bitwiseXOR(F.lit(1 << i)))).otherwise(0)
                   for i in range(n_filters)]
        total = factorial(n_filters) * F.get(values, s) + sum(without[1:], without[0])
        return F.concat(acc, F.array(F.call_function("div", total, F.bit_count(s).cast("bigint"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2 ** n_filters - 1)), F.array(F.lit(0).cast("bigint")), step)


def order_steps(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step of that order.

    ``counts`` has (part, mask, n, good, toxic) with bit i for the filter
    ``names[i]``; the result has kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley (the filter's removals summed over all
    orders: n! times its Shapley value).
    """
    n = len(names)
    every = 2 ** n - 1
    games = coalition_values(counts, n).withColumn("p", potentials(F.col("n"), n))
    orders = F.array(*[F.lit("".join(o)) for o in permutations(names)])
    rows = games.withColumn("filter_order", F.explode(orders)) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    bit = lambda letter: F.call_function("shiftleft", F.lit(1), F.call_function("instr", F.lit(names), letter) - 1)
    letter_at = lambda k: F.substring(F.col("filter_order"), k, F.lit(1))
    before = F.aggregate(F.sequence(F.lit(0), F.col("step") - 1), F.lit(0),
                         lambda acc, k: acc + F.when(k > 0, bit(letter_at(k))).otherwise(0))
    rows = rows.withColumn("filter", letter_at(F.col("step"))).withColumn("before", before) \
        .withColumn("own", bit(F.col("filter")))
    after = F.col("before").bitwiseOR(F.col("own"))
    gain = lambda m: F.get(F.col(m), after) - F.get(F.col(m), F.col("before"))
    rest = F.lit(every).bitwiseXOR(F.col("own"))
    whole = F.lit(every)
    return rows.select(
        "part", "filter_order", "step", "filter", (F.col("total") - F.get("n", after)).alias("kept"),
        gain("n").alias("removed"), (F.get("n", F.col("own")) - gain("n")).alias("redundant"),
        (F.get("n", whole) - F.get("n", rest)).alias("unique_fails"), gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"), (F.get("p", whole) - F.get("p", rest)).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, conditions: dict[str, Column] | None = None,
                  copies: str = "E", **columns) -> DataFrame:
    """The audit of ``conditions`` (name of one letter -> condition on
    ``FACTS``; ``rules()`` by default) and of the copy filter ``copies``.

    Null and empty texts have no words and equal each other; a null source is
    the part ''.  A row without an id has no label and is no copy of another,
    nor is another a copy of it; rows that repeat an id with the same text are
    not copies of each other.  An id with several labels is good (toxic) if one
    of them says so.  An empty table gives no rows.
    """
    conditions = rules() if conditions is None else conditions
    return order_steps(failure_counts(docs, labels, conditions, **columns), "".join(conditions) + copies)
