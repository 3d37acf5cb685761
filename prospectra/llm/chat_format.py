"""Chat formatting in budgeted, turn-aligned windows, with native functions only.

A conversation becomes one or more training windows. Prefix sums of the turns'
token counts choose the spans: a window takes turns from its first one on as
long as their sum stays within the budget left by what it repeats. Each window
after the first repeats the system turn (a first turn of role `system`) and
turns just before it, up to `history` tokens or what the budget leaves beside the
window's first turn; what is repeated is never a target again. Every assistant
text is under the loss mask exactly once. No window is over the budget but those of
one turn that alone, or with the system turn, is: these repeat no history.

Template of a turn: `### Role: text</turn>` and a newline. In roles and texts a
backslash is doubled, `</turn>` becomes `<\\/turn>` and `##` becomes `#\\#`, so
that neither control string can occur in a text; dropping each escaping
backslash restores it. A role that is not plain letters, digits, `_` or `-`
is written as `=` and the hex digits of its UTF-8.

Turns are ordered by a range partitioning, which splits a conversation of any
length over many tasks; its prefix sums are those within a part and those of the
parts before. Spans are chosen within blocks of `span` budgets by prefix sum: a
window starts wherever a block starts, in conversations of every length, and has
history of the block before. So a task holds the tokens of one block at a time, and
never a whole conversation. Tokens of a turn are its words plus `turn_tokens` for
the template, at least 1, unless another column expression is given.

`op4_chat_format` alone puts a conversation's texts into one value, as its contract
asks for their digest.

Defined cases: null texts and roles are empty; a null turn counts as 0; rows without
a conv_id form one conversation; ties of `turn` are ordered by role, then text; equal
rows are turns of their own; a very long text is a window of its own; a conversation
of one turn is one window; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

END = "</turn>"
SPAN = 16


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(END), F.lit("<\\/turn>")), F.lit("##"), F.lit("#\\#"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def header(role: Column) -> Column:
    name = F.when(role.rlike(r"\A[A-Za-z0-9_-]+\z"), role).otherwise(F.concat(F.lit("="), F.hex(F.encode(role, "UTF-8"))))
    return F.concat(F.lit("### "), name, F.lit(": "))


def role_of(name: Column) -> Column:
    return F.when(F.startswith(name, F.lit("=")), F.decode(F.unhex(F.substring(name, 2, 1 << 30)), "UTF-8")).otherwise(name)


def word_tokens(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def placed(turns: DataFrame, turn_tokens: int, tokens) -> DataFrame:
    """conv_id, role, text, cost, at of each turn; `at` is the prefix sum of the conversation's costs before it, so no two are equal."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("cost", F.greatest(tokens(F.col("text")) + turn_tokens, F.lit(1)).cast("long")).withColumn("row", F.monotonically_increasing_id())
    order = ("turn", "role", "text", "row")
    dealt = materialize(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    parts = dealt.groupBy("conv_id", "part").agg(F.sum("cost").alias("sum"))
    before = parts.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), (F.sum("sum").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("sum")).alias("before"))
    inside = F.sum("cost").over(Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("cost")
    joined = dealt.withColumn("inside", inside).join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
    return joined.select("conv_id", "role", "text", "cost", (F.col("before") + F.col("inside")).alias("at"))


def windows(turns: DataFrame, budget: int = 1024, history: int = 256, turn_tokens: int = 4, tokens=word_tokens, span: int = SPAN) -> DataFrame:
    """Windows of turns (conv_id, turn, role, text): conv_id, block, window, formatted, mask, first.

    `formatted` is the window's text; `mask` lists (start, length) in code points of each target text, still escaped;
    `first` is the position in `formatted` from which turns are new, i.e. not repeated.
    """
    size = span * budget
    if not 0 <= history <= size:
        raise ValueError(f"history must be between 0 and {size} tokens, not {history}")
    rows = materialize(placed(turns, turn_tokens, tokens), "placed")
    block = F.floor(F.col("at") / size)
    # Each block holds its own turns and those of the block before that its history can reach.
    reach = F.col("at") >= (block + 1) * size - history
    blocks = F.when(reach, F.array(block, block + 1)).otherwise(F.array(block))
    copies = rows.withColumn("block", F.explode(blocks)).withColumn("own", F.col("block") == block)
    held = copies.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("at", "cost", "role", "text", "own"))).alias("t"), F.bool_or("own").alias("any")).where("any")
    # The system turn is known to all blocks.
    opening = rows.where("at = 0 and role = 'system'").select(F.col("conv_id").alias("_c"), F.struct("role", "text", "cost").alias("system"))
    held = held.join(opening, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    fixed = F.coalesce(F.col("system.cost"), F.lit(0).cast("long"))
    one = lambda a, hi: F.array(F.struct(a["from"].alias("from"), hi.alias("to"), a.past.alias("past")))
    begin = F.struct(F.array().cast("array<struct<from:int,to:int,past:int>>").alias("done"), F.lit(-1).alias("from"), F.lit(0).alias("past"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("end"))

    def step(a: Column, x: Column) -> Column:
        """`end` is the prefix sum that the open window must not pass, less what it repeats."""
        opens = x.own & ((a["from"] < 0) | (x["at"] + x.cost > a.end))
        first = x["at"] == 0
        # History gets what the first turn and the system turn leave of the budget, in whole turns.
        room = F.least(F.lit(history), F.lit(budget) - fixed - x.cost)
        fits = F.filter("t", lambda y: (y["at"] < x["at"]) & (x["at"] - y["at"] <= room))
        past = F.when(first, F.lit(0)).otherwise(F.size(fits))
        again = F.when(first, F.lit(0)).otherwise(fixed + F.coalesce(x["at"] - F.get(fits, F.lit(0))["at"], F.lit(0)))
        return F.struct(
            F.when(opens & (a["from"] >= 0), F.concat(a.done, one(a, a.k))).otherwise(a.done).alias("done"),
            F.when(opens, a.k).otherwise(a["from"]).alias("from"),
            F.when(opens, past).otherwise(a.past).alias("past"),
            (a.k + 1).alias("k"),
            F.when(opens, x["at"] + budget - again).otherwise(a.end).alias("end"),
        )

    spans = F.aggregate("t", begin, step, lambda a: F.concat(a.done, one(a, a.k)))
    spans = held.select("conv_id", "block", "t", "system", F.posexplode(spans).alias("window", "span"))
    lo, hi, past = F.col("span.from"), F.col("span.to"), F.col("span.past")
    turn = lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))
    # The system turn is not repeated where the window or its history has it anyway.
    has = F.col("system").isNull() | (F.col("t")[lo - past]["at"] == 0)
    system = F.when(has, F.array().cast("array<struct<role:string,text:string>>")).otherwise(F.array(turn(F.col("system"))))
    cut = spans.select("conv_id", "block", "window", F.inline(F.array(F.struct(F.concat(system, F.transform(F.slice("t", lo - past + 1, past), turn)).alias("again"), F.transform(F.slice("t", lo + 1, hi - lo), turn).alias("new")))))
    part = lambda new: lambda x: F.struct(header(x.role).alias("head"), escape(x.text).alias("body"), (F.lit(new) & (x.role == "assistant")).alias("target"))
    laid = cut.select("conv_id", "block", "window", F.size("again").alias("n_again"), F.inline(F.array(F.struct(F.concat(F.transform("again", part(False)), F.transform("new", part(True))).alias("x")))))
    empty = F.struct(F.lit(0).alias("k"), F.lit(0).alias("at"), F.lit(0).alias("first"), F.array().cast("array<struct<start:int,length:int>>").alias("mask"))

    def lay(a: Column, x: Column) -> Column:
        head, body = F.length(x.head), F.length(x.body)
        target = F.array(F.struct((a["at"] + head).alias("start"), body.alias("length")))
        return F.struct((a.k + 1).alias("k"), (a["at"] + head + body + len(END) + 1).alias("at"), F.when(a.k == F.col("n_again"), a["at"]).otherwise(a["first"]).alias("first"), F.when(x.target, F.concat(a.mask, target)).otherwise(a.mask).alias("mask"))

    formatted = F.array_join(F.transform("x", lambda x: F.concat(x.head, x.body, F.lit(END + "\n"))), "")
    out = laid.select("conv_id", "block", "window", formatted.alias("formatted"), F.inline(F.array(F.aggregate("x", empty, lay))))
    return out.select("conv_id", "block", "window", "formatted", "mask", "first")


def parse(formatted: DataFrame) -> DataFrame:
    """Reads windows back: the new turns of each as (role, text), and the unescaped texts under its mask."""
    body = F.expr("substring(formatted, first + 1)")
    chunks = F.filter(F.split(body, F.lit("</turn>\\n")), lambda c: c != "")
    turn = lambda c: F.struct(role_of(F.regexp_extract(c, r"\A### ([^:]*): ", 1)).alias("role"), unescape(F.substring(c, F.instr(c, ": ") + 2, F.length(c))).alias("text"))
    masked = F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), m.start + 1, m.length)))
    return formatted.select("conv_id", "block", "window", F.transform(chunks, turn).alias("turns"), masked.alias("targets"), F.length("formatted").alias("chars"))


PROBE = "\\### Assistant: </turn> ok"


def op4_chat_format(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    written = materialize(windows(conversations.select("conv_id", "turn", "role", "text").unionByName(probe)), "windows")
    back = parse(written)
    texts = back.select("conv_id", "block", "window", F.size("turns").alias("n"), F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("said"), F.array_join("targets", "").alias("loss"), "chars")
    whole = texts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("block", "window", "said", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    said, loss = F.array_join("w.said", ""), F.array_join("w.loss", "")
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))
