"""Chat turns formatted into training windows under a token budget; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronogrid.session import materialise

BUDGET = 2048  # tokens of a window, repeated turns included
HISTORY = 512  # tokens of earlier turns that a later window repeats, at most
MARKUP = 4  # tokens that a turn's marks cost
BLOCK = 512  # turns of one conversation that are cut into windows together

# The template. A turn is OPEN, its role, MIDDLE, its text, CLOSE.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"

# What is escaped by a backslash: itself, every # of three or more, and the slash of an
# end mark; in a role a colon too. So no mark occurs inside a role or text.
CONTROL = r"\\|#(?=##)|(?<=#)#(?=#)|(?<=##)#|(?<=<)/(?=turn>)"
HEAD = r"(?s)^### ((?:[^\\:]++|\\.)*+): "

SYSTEM, TARGET = "system", "assistant"


def escape(text: Column, control: str = CONTROL) -> Column:
    return F.regexp_replace(text, control, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def pieces(text: Column) -> Column:
    """Tokens of a text by a plain rule: runs of up to four visible characters."""
    return F.regexp_count(text, F.lit(r"[^\x00-\x20]{1,4}"))


def numbered(turns: DataFrame) -> DataFrame:
    """Add `at` (a turn's place in its conversation), `before` and `after` (prefix sums of
    `cost`) and `turns` (of the conversation).

    Turns are sorted by range, so that a long conversation spreads over many tasks; each
    range is summed by itself, and only one row per conversation and range is carried on.
    """
    spark = turns.sparkSession
    order = ["conv", "turn", "role", "text", "row"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.withColumn("row", F.monotonically_increasing_id())  # parts rows that are equal
    dealt = dealt.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    dealt = materialise(dealt, "chat-turns")
    totals = dealt.groupBy("range", "conv").agg(F.count("*").alias("n"), F.sum("cost").alias("sum"))
    whole = Window.partitionBy("conv")
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("range").alias("_range"), F.col("conv").alias("_conv"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum0"),
        F.sum("n").over(whole).alias("turns"),
    )
    inside = Window.partitionBy("range", "conv").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn("n", F.count("*").over(inside)).withColumn("sum", F.sum("cost").over(inside))
    met = summed.join(totals, (F.col("range") == F.col("_range")) & F.col("conv").eqNullSafe(F.col("_conv")))
    after = F.col("sum0") + F.col("sum")
    return met.select(
        "conv", "role", "text", "cost", (F.col("n0") + F.col("n") - 1).alias("at"),
        (after - F.col("cost")).alias("before"), after.alias("after"), "turns",
    )


def in_blocks(turns: DataFrame, history: int) -> DataFrame:
    """One row per BLOCK turns of a conversation: its turns in order, those of the block
    before that may be repeated, and the system turn."""
    home = F.floor(F.col("at") / BLOCK)
    halo = min(BLOCK, -(-history // MARKUP))  # every turn costs MARKUP at least
    last = F.floor((F.col("turns") - 1) / BLOCK)
    near = F.when(F.col("at") % BLOCK >= BLOCK - halo, F.sequence(home, F.least(home + 1, last)))
    blocks = F.when(F.col("first"), F.sequence(F.lit(0).cast("long"), last)).otherwise(
        F.coalesce(near, F.array(home))
    )
    placed = turns.withColumn("first", (F.col("at") == 0) & (F.col("role") == SYSTEM))
    placed = placed.withColumn("block", F.explode(blocks)).withColumn("own", home == F.col("block"))
    turn = F.struct(
        "at", "before", "after", "cost", "own", "first", (F.col("role") == TARGET).alias("target"),
        escape(F.col("role"), CONTROL + "|:").alias("role"), escape(F.col("text")).alias("text"),
    )
    return placed.groupBy("conv", "block").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _starts(budget: int, history: int) -> Column:
    """Structs (at, before) of the turns of a block that begin a window.

    A window takes turns as long as their prefix sum allows; a turn that is larger than
    any window has one of its own.
    """
    system = F.coalesce(F.try_element_at(F.filter("turns", lambda t: t["first"]), F.lit(1))["cost"], F.lit(0))
    later = F.greatest(F.lit(1), F.lit(budget - history) - system)
    kept = F.filter("turns", lambda t: t["own"])
    none = F.array().cast("array<struct<at: bigint, before: bigint>>")

    def step(state: Column, turn: Column) -> Column:
        limit = F.when(state["base"] == 0, F.lit(budget)).otherwise(later)
        over = (turn["after"] - state["base"] > limit) & (turn["before"] > state["base"])
        new = (state["base"] < 0) | over
        start = F.array(F.struct(turn["at"].alias("at"), turn["before"].alias("before")))
        return F.struct(
            F.when(new, turn["before"]).otherwise(state["base"]).alias("base"),
            F.when(new, F.concat(state["starts"], start)).otherwise(state["starts"]).alias("starts"),
        )

    zero = F.struct(F.lit(-1).cast("long").alias("base"), none.alias("starts"))
    return F.aggregate(kept, zero, step, lambda state: state["starts"])


def _window(begin: Column, end: Column, history: int) -> Column:
    """The window of the turns from `begin` up to `end`, after those that it repeats."""
    again = F.filter("turns", lambda t: (t["at"] < begin["at"]) & (t["first"] | (t["before"] >= begin["before"] - history)))
    fresh = F.filter("turns", lambda t: t["own"] & (t["at"] >= begin["at"]) & (t["at"] < end))

    def piece(t: Column) -> Column:
        return F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))

    def mark(state: Column, t: Column) -> Column:
        head = state["at"] + F.lit(len(OPEN + MIDDLE)) + F.length(t["role"])
        span = F.struct(head.alias("start"), F.length(t["text"]).alias("length"))
        hit = t["target"] & (t["at"] >= begin["at"])
        return F.struct(
            (head + F.length(t["text"]) + F.lit(len(CLOSE))).alias("at"),
            F.when(hit, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    every = F.concat(again, fresh)
    none = F.array().cast("array<struct<start: int, length: int>>")
    return F.struct(
        begin["at"].alias("first_turn"),
        F.size(again).alias("repeated"),
        F.aggregate(every, F.lit(0).cast("long"), lambda n, t: n + t["cost"]).alias("tokens"),
        F.array_join(F.transform(every, piece), "").alias("text"),
        F.aggregate(every, F.struct(F.lit(0).alias("at"), none.alias("spans")), mark, lambda s: s["spans"]).alias("mask"),
    )


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Callable[[Column], Column] = pieces,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Cut conversations into formatted training windows of at most `budget` tokens.

    Returns (id_col, first_turn, repeated, tokens, over_budget, text, mask), one row per
    window: the place of its first new turn, the number of turns repeated before that, and
    in `mask` the (start, length) of its targets in `text`, in code points from 0: the
    texts of new assistant turns. Every turn is new in exactly one window.

    Prefix sums of the turns' tokens (`tokens` of the text, and MARKUP) choose spans that
    begin and end with a turn. A later window repeats the conversation's first turn if
    that is a system turn, and the last turns before its own that fit in `history` tokens;
    targets among them are not in the mask. After BLOCK turns a window always ends, so a
    task holds a bounded number of turns of a conversation of any length.

    Turns are ordered by `turn_col` (NULL first), equal ones by role and text; repeated
    rows stay turns of their own. NULL roles and texts are empty; rows with a NULL id are
    one conversation without a name. A turn larger than the budget is alone in a window
    (but for repeated turns), whole, with `over_budget`; very long texts are never cut. An
    empty table gives no window. Other columns are ignored whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.select(
        F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), text.alias("text"),
        (tokens(text) + MARKUP).cast("long").alias("cost"),
    )
    blocks = in_blocks(numbered(turns), history).withColumn("starts", _starts(budget, history))
    end = lambda i: F.coalesce(F.try_element_at("starts", i + 2)["at"], F.lit(1 << 62))
    windows = F.transform("starts", lambda begin, i: _window(begin, end(i), history))
    made = blocks.select("conv", F.inline(windows))
    over = (F.col("tokens") > budget).alias("over_budget")
    return made.select(F.col("conv").alias(id_col), "first_turn", "repeated", "tokens", over, "text", "mask")


def read_back(windows: DataFrame) -> DataFrame:
    """Add what the formatted text says: `turns`, the new (role, text) pairs of a window, and
    `targets`, the texts under its mask."""

    def turn(piece: Column) -> Column:
        head = F.regexp_extract(piece, HEAD, 0)
        return F.struct(
            unescape(F.regexp_extract(piece, HEAD, 1)).alias("role"),
            unescape(F.substring(piece, F.length(head) + F.lit(1), F.length(piece))).alias("text"),
        )

    parts = F.split("text", CLOSE)
    fresh = F.slice(parts, F.col("repeated") + F.lit(1), F.size(parts) - F.col("repeated") - F.lit(1))
    said = lambda span: unescape(F.substring(F.col("text"), span["start"] + F.lit(1), span["length"]))
    return windows.withColumns({"turns": F.transform(fresh, turn), "targets": F.transform("mask", said)})


def digests(windows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation of `format_windows`: counts and hashes of what is read back.

    (id_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). A hash runs
    over one string, so a conversation's texts must fit in one row here; the windows
    themselves have no such limit.
    """
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    parts = read_back(windows).select(
        F.col(id_col).alias("conv"),
        F.struct(
            "first_turn",
            F.array_join(F.transform("turns", line), "").alias("said"),
            F.array_join("targets", "").alias("loss"),
        ).alias("part"),
        F.size("turns").alias("n"),
        F.length("text").alias("chars"),
    )
    told = parts.groupBy("conv").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    loss = F.array_join("parts.loss", "")
    return told.select(
        F.col("conv").alias(id_col),
        "n_turns",
        F.sha2(F.array_join("parts.said", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
