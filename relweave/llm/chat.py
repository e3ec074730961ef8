"""Chat formatting with Spark expressions only: merged turns, marked and escaped, with a loss mask.

A block is ``<s>role`` and the texts of its adjacent turns, each between ``[INST]`` and
``[/INST]``, then ``</s>``. A control string inside a role or text gets a backslash after its
first character; one that has backslashes there already gets one more, so it can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAILS = r"/?INST\]|/?s>|</?SYS>>"
OPEN, CLOSE, TEXT, END = "<s>", "</s>", "[INST]", "[/INST]"
TURN = "struct<role:string,text:string>"
BLOCK = "struct<role:string,texts:array<string>>"
SPAN = "struct<start:bigint,end:bigint>"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, rf"([\[<])(\\*)({TAILS})", r"$1\\$2$3")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, rf"([\[<])\\(\\*)({TAILS})", "$1$2$3")


def merged(turns: Column) -> Column:
    """Blocks of adjacent turns of one role."""
    empty = F.array().cast(f"array<{BLOCK}>")

    def step(blocks: Column, turn: Column) -> Column:
        n = F.size(blocks)
        last = F.element_at(blocks, n)
        same = (n > 0) & (F.when(n > 0, last["role"]) == turn["role"])
        longer = F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(same, F.concat(F.slice(blocks, 1, n - 1), F.array(longer))).otherwise(F.concat(blocks, F.array(fresh))).cast(f"array<{BLOCK}>")

    return F.aggregate(turns, empty, step)


def rendered(block: Column) -> Column:
    texts = F.transform(block["texts"], lambda t: F.concat(F.lit(TEXT), escaped(t), F.lit(END)))
    return F.concat(F.lit(OPEN), escaped(block["role"]), F.array_join(texts, ""), F.lit(CLOSE))


def loss_spans(blocks: Column, learnt: str) -> Column:
    """(start, end) in code points of every text of the learnt role in the formatted conversation."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    kind = f"struct<at:bigint,spans:array<{SPAN}>>"

    def block_step(state: Column, block: Column) -> Column:
        head = F.struct((state["at"] + len(OPEN) + F.length(escaped(block["role"]))).alias("at"), state["spans"].alias("spans")).cast(kind)

        def text_step(inner: Column, text: Column) -> Column:
            start = inner["at"] + len(TEXT)
            end = start + F.length(escaped(text))
            span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))
            spans = F.when(block["role"] == learnt, F.concat(inner["spans"], F.array(span))).otherwise(inner["spans"])
            return F.struct((end + len(END)).cast("long").alias("at"), spans.alias("spans")).cast(kind)

        done = F.aggregate(block["texts"], head, text_step)
        return F.struct((done["at"] + len(CLOSE)).cast("long").alias("at"), done["spans"].alias("spans")).cast(kind)

    return F.aggregate(blocks, zero.cast(kind), block_step)["spans"]


def format_chats(rows: DataFrame, learnt: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss): one row per conversation; `loss` has the spans to learn from.

    Turns are ordered by turn, role and text; null roles and texts count as empty, null
    turns come first, repeated rows are turns of their own, and rows with a null conv_id
    form one conversation. A conversation is one row of the result, so it has to fit into
    one; only its own turns meet in a task. Empty tables give an empty table.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    each = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    blocks = each.select("conv_id", merged(plain).alias("blocks"))
    formatted = F.array_join(F.transform("blocks", rendered), "")
    return blocks.select("conv_id", formatted.alias("formatted"), loss_spans(F.col("blocks"), learnt).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"</s>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        parts = F.split(block, r"\[INST\]")
        role = unescaped(F.substr(F.element_at(parts, 1), F.lit(len(OPEN) + 1)))
        texts = F.slice(parts, 2, F.size(parts) - 1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(F.substr(t, F.lit(1), F.length(t) - len(END))).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learnt_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
