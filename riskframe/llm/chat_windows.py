"""Chat formatting into budgeted windows.

A window repeats the leading system turn and a limited history, then has new
turns; all three together stay within the budget.  Windows are cut greedily:
the prefix sums of turn tokens say which turn is the first that the window has
no room for, and the next window begins there.  Loss is on the new assistant
turns only, so every assistant text is a target once.

Turns are marked by control strings; where a text contains one (or an escaped
one), a backslash goes in after its first character, and reading back takes it
out again, so formatting is reversible for any text.  Built-in functions only.

Cutting starts anew with every block of at most ``BLOCK`` turns, so a
conversation of any length is cut by many tasks: prefix sums and window numbers
are made within blocks, then over block sums.  Only the last window of a block
can be left with room for the next turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a whole window, of the history in it at most, and turns per block.
SPAN, HISTORY, BLOCK = 1024, 256, 128

# The template's control strings.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE:", "]", "[/ROLE]")
_CONTROL = r"(</?s>|<</?SYS>>|\[/?INST\]|\[ROLE:|\[/ROLE\])"
# the same with backslashes after the first character
_AT_CONTROL = r"([<\[])(?=\\*(/?s>|</?SYS>>|/?INST\]|ROLE:|/ROLE\]))"
_ESCAPED = r"([<\[])\\(?=\\*(/?s>|</?SYS>>|/?INST\]|ROLE:|/ROLE\]))"
#: Pieces that stand for tokens: up to 4 letters, up to 3 digits, or one other sign.
PIECE = r"\p{L}{1,4}|\p{N}{1,3}|[^\s\p{L}\p{N}]"
TURN_TOKENS = 4


def escape(text):
    return F.regexp_replace(text, _AT_CONTROL, "$1" + "\\" * 2)


def unescape(text):
    return F.regexp_replace(text, _ESCAPED, "$1")


def turn_tokens(text):
    """Estimated tokens of a turn, its marks included."""
    return F.regexp_count(text, F.lit(PIECE)).cast("bigint") + TURN_TOKENS


def _marked(role, body):
    """(text before, text after) a turn's body, as columns."""
    before, after = F.concat(F.lit(OTHER[0]), _role_code(role), F.lit(OTHER[1])), F.lit(OTHER[2])
    for name, (a, b) in MARKS.items():
        before = F.when(role == name, F.lit(a)).otherwise(before)
        after = F.when(role == name, F.lit(b)).otherwise(after)
    return before, after


def _role_code(role):
    return F.hex(role.cast("binary"))


def prepared_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text): null role and text are ''."""
    return turns.select(turns[conv_id].alias("conv"), turns[turn].alias("turn"),
                        F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
                        F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"))


def with_blocks(turns: DataFrame) -> DataFrame:
    """Add ``tokens``; ``block`` (of turn numbers), ``pos`` in it and ``part``,
    the piece of at most ``BLOCK`` turns: many turns of one number (or none)
    are one block, but many parts."""
    t = turns.withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK)) \
        .withColumn("tokens", turn_tokens(F.col("text")))
    t = t.withColumn("pos", F.row_number().over(Window.partitionBy("conv", "block").orderBy("turn", "role", "text")))
    return t.withColumn("part", F.floor((F.col("pos") - 1) / BLOCK))


def cut(tokens, first, other):
    """Greedy cuts of an array of (pos, tokens): per turn its window ``w`` from
    0 and ``at``, the tokens before it.  Window 0 has room for ``first``
    tokens, the others for ``other``; one turn always fits."""
    def step(acc, x):
        room = F.when(acc["w"] == 0, first).otherwise(other)
        fits = (acc["used"] == 0) | (acc["used"] + x["tokens"] <= room)
        w = F.when(fits, acc["w"]).otherwise(acc["w"] + 1)
        return F.struct(w.alias("w"), (F.when(fits, acc["used"]).otherwise(F.lit(0)) + x["tokens"]).alias("used"),
                        (acc["at"] + x["tokens"]).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(x["pos"].alias("pos"), w.alias("w"),
                                                              acc["at"].alias("at"), x["tokens"].alias("tokens"))))
                        .alias("out"))
    big = lambda: F.lit(0).cast("bigint")
    empty = F.array().cast("array<struct<pos:int,w:int,at:bigint,tokens:bigint>>")
    return F.aggregate(tokens, F.struct(F.lit(0).alias("w"), big().alias("used"), big().alias("at"),
                                        empty.alias("out")), step, lambda acc: acc["out"])


def placed_turns(t: DataFrame, leads: DataFrame, span: int, history: int) -> DataFrame:
    """(conv, block, pos, window, at, tokens) of turns with blocks; ``leads``
    has (lead_conv, lead_block, lead_tokens) of conversations that begin with
    a system turn."""
    parts = t.groupBy("conv", "block", "part").agg(
        F.array_sort(F.collect_list(F.struct("pos", "tokens"))).alias("x"), F.sum("tokens").alias("sum"))
    parts = parts.join(leads, parts["conv"].eqNullSafe(leads["lead_conv"]), "left")
    other = F.lit(span - history) - F.coalesce("lead_tokens", F.lit(0))
    begins = (F.col("block") == F.col("lead_block")) & (F.col("part") == 0)
    # the conversation's first window has the system turn as a new one, and no history
    first = F.when(F.coalesce(begins, F.lit(False)), F.lit(span)).otherwise(other)
    parts = parts.select("conv", "block", "part", "sum", cut(F.col("x"), first, other).alias("x"))
    earlier = Window.partitionBy("conv").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    windows = F.element_at("x", -1)["w"] + 1
    parts = parts.select("conv", "block", "x", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("tokens_before"),
                         F.coalesce(F.sum(windows).over(earlier), F.lit(0)).alias("windows_before"))
    return parts.select("conv", "block", "tokens_before", "windows_before", F.explode("x").alias("x")).select(
        "conv", "block", "x.pos", (F.col("windows_before") + F.col("x.w")).alias("window"),
        (F.col("tokens_before") + F.col("x.at")).alias("at"), "x.tokens")


def format_windows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", span: int = SPAN, history: int = HISTORY) -> DataFrame:
    """One row per window: conversation, window number from 0, ``formatted``,
    the number of turns repeated at its head, and ``loss`` (code-point offset
    and length of each target in ``formatted``).

    A window's system turn, history and new turns have at most ``span`` tokens.
    Later windows leave ``history`` tokens of room; the history is the turns
    right before the window that start within what is left of the budget, but
    within ``history`` tokens.  A turn is never cut: only where the system turn
    and one new turn exceed the budget by themselves, a window does.

    Turns are ordered by (turn, role, text); null roles and texts are '', null
    turn numbers come first; a null conversation id is one conversation.
    Repeated rows are turns of their own.  Empty input gives no rows.
    """
    if history > span:
        raise ValueError("history must not exceed the span")
    t = with_blocks(prepared_turns(turns, conv_id, turn, role, text))
    body = escape(F.col("text"))
    before, after = _marked(F.col("role"), body)
    turn_text = F.struct("role", before.alias("a"), body.alias("b"), after.alias("z"))
    t = t.withColumn("m", turn_text)
    begin = t.where("pos = 1").groupBy("conv").agg(F.min("block").alias("lead_block"),
                                                   F.min_by(F.struct("m", "tokens"), "block").alias("lead"))
    leads = begin.where("lead.m.role = 'system'").select(
        F.col("conv").alias("lead_conv"), "lead_block", F.col("lead.tokens").alias("lead_tokens"),
        F.col("lead.m").alias("system"))
    # a first part without a system turn has the whole budget too
    rooms = begin.select(F.col("conv").alias("lead_conv"), "lead_block", F.when(
        F.col("lead.m.role") == "system", F.col("lead.tokens")).otherwise(0).alias("lead_tokens"))
    at = placed_turns(t.select("conv", "block", "part", "pos", "tokens"), rooms, span, history)
    placed = at.join(t.select(F.col("conv").alias("tc"), F.col("block").alias("tb"), F.col("pos").alias("tp"), "m"),
                     at["conv"].eqNullSafe(F.col("tc")) & (at["block"] == F.col("tb")) & (at["pos"] == F.col("tp"))) \
        .select("conv", "window", "at", "tokens", "m")
    starts = at.groupBy("conv", "window").agg(F.min("at").alias("start"), F.sum("tokens").alias("new_tokens"))
    new = placed.select("conv", "window", F.lit(True).alias("new"), "at", "m")
    rows = new.unionByName(_history(placed, starts, rooms, span, history)) if history else new
    part = F.struct("at", "new", "m.*")
    g = rows.groupBy("conv", "window").agg(F.array_sort(F.collect_list(part)).alias("turns"))
    g = g.join(leads, g["conv"].eqNullSafe(leads["lead_conv"]), "left")
    head = F.when((F.col("window") > 0) & F.col("system").isNotNull(),
                  F.concat("system.a", "system.b", "system.z")).otherwise(F.lit(""))
    g = g.select("conv", "window", "turns", head.alias("head"))
    old = F.size(F.filter("turns", lambda x: ~x["new"])) + F.when(F.col("head") != "", 1).otherwise(0)
    pieces = F.transform("turns", lambda x: F.concat(x["a"], x["b"], x["z"]))
    formatted = F.concat(F.col("head"), F.array_join(pieces, ""))
    lengths = F.transform("turns", lambda x: F.struct(
        F.length(x["a"]).alias("a"), F.length(x["b"]).alias("b"), F.length(x["z"]).alias("z"),
        (x["new"] & (x["role"] == "assistant")).alias("target")))
    walk = F.aggregate(
        lengths, F.struct(F.length("head").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("s")),
        lambda acc, x: F.struct(
            (acc["at"] + x["a"] + x["b"] + x["z"]).alias("at"),
            F.when(x["target"], F.concat(acc["s"], F.array(F.struct(
                (acc["at"] + x["a"]).alias("start"), x["b"].alias("length"))))).otherwise(acc["s"]).alias("s")),
        lambda acc: acc["s"])
    return g.select(F.col("conv").alias(conv_id), "window", formatted.alias("formatted"), old.alias("n_repeated"),
                    walk.alias("loss"))


def _history(placed: DataFrame, starts: DataFrame, rooms: DataFrame, span: int, history: int) -> DataFrame:
    """The turns that windows repeat, as rows like those of new turns.  Turns
    and windows meet by the conversation and ``history`` tokens of it, so a
    window sees few turns besides its own history."""
    room = F.least(F.lit(history), F.lit(span) - F.col("lead_tokens") - F.col("new_tokens"))
    w = starts.where("start > 0").join(rooms, starts["conv"].eqNullSafe(rooms["lead_conv"])) \
        .select(F.col("conv").alias("wc"), F.col("window").alias("ww"), "start", room.alias("room"),
                F.when(F.col("lead_tokens") > 0, 0).otherwise(-1).alias("after")) \
        .where("room > 0") \
        .withColumn("near", F.explode(F.sequence(F.floor((F.col("start") - F.col("room")) / history),
                                                 F.floor((F.col("start") - 1) / history))))
    t = placed.withColumn("cell", F.floor(F.col("at") / history))
    # the leading system turn (it begins at 0) is repeated anyway
    return t.join(w, t["conv"].eqNullSafe(w["wc"]) & (t["cell"] == w["near"])) \
        .where((F.col("at") < F.col("start")) & (F.col("at") >= F.col("start") - F.col("room"))
               & (F.col("at") > F.col("after"))) \
        .select("conv", F.col("ww").alias("window"), F.lit(False).alias("new"), "at", "m")


# ------------------------------------------------------------- reading it back

def read_turns(formatted):
    """Array of (role, text) of a formatted window."""
    whole = F.regexp_extract_all(formatted, F.lit(
        r"(?s)(<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|\[ROLE:.*?\[/ROLE\])"), 1)

    def one(x):
        rest = F.substring_index(F.substring(x, len(OTHER[0]) + 1, 2 ** 30), OTHER[1], 1)
        role = F.decode(F.unhex(rest), "UTF-8")
        skip = F.length(rest) + len(OTHER[0]) + len(OTHER[1])
        body = F.substring(x, skip + 1, F.length(x) - skip - len(OTHER[2]))
        for name, (a, b) in MARKS.items():
            mine = x.startswith(a)
            role = F.when(mine, F.lit(name)).otherwise(role)
            body = F.when(mine, F.substring(x, F.lit(len(a) + 1), F.length(x) - len(a) - len(b))).otherwise(body)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(whole, one)


def new_turns(formatted, n_repeated):
    return F.slice(read_turns(formatted), n_repeated + 1, F.lit(2 ** 30))


def loss_texts(formatted, loss):
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
