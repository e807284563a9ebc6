"""Operator 7: chat formatting with Spark expressions only.

Output of a conversation: for each run of turns of one role a block `<turn ROLE>\\n ... </turn>\\n`; the
texts of a run are set apart by `<part/>`, so that the turns can be read back. Control characters of the
template inside a text or role are escaped (`\\` as `\\0`, `<` as `\\1`, `>` as `\\2`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

PART, CLOSE = "<part/>", "</turn>\n"
#: Turns of a conversation that are collected together first; what a very long conversation gathers at once stays small.
CHUNK = 256


def escape(c: Column) -> Column:
    for plain, code in (("\\", "\\0"), ("<", "\\1"), (">", "\\2")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in ((">", "\\2"), ("<", "\\1"), ("\\", "\\0")):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans array<struct<start, length>> (code points from 0).

    Rows need conv_id, turn, role, text; more columns are ignored. Order: turn (null first), then role and text
    for ties; repeated rows stay repeated turns. Null text and null role count as empty; a null conv_id is a
    conversation of its own. A loss span is the escaped text of one turn of loss_role. An empty table gives none.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = rows.groupBy("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "turns"))).alias("chunks"))
    turns = whole.select("conv_id", F.flatten(F.transform("chunks", lambda c: c["turns"])).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">\n"))
        before = F.get(F.col("turns"), i - 1)
        head = F.when(i == 0, mark).when(before["role"] == t["role"], F.lit(PART)).otherwise(F.concat(F.lit(CLOSE), mark))
        return F.struct(head.alias("head"), escape(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss"))

    pieces = turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["text"])).alias("at"),
            F.when(p["loss"], F.array_append(a["spans"], F.struct((a["at"] + F.length(p["head"])).alias("start"), F.length(p["text"]).alias("length")))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    text = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"])), ""), F.lit(CLOSE))
    return pieces.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns in a formatted conversation, array<struct<role, text>>."""
    blocks = F.split(formatted, CLOSE)

    def turns(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len("<turn ") + 1)), ">\n", 1)
        body = F.substr(block, F.length(role) + F.lit(len("<turn >\n") + 1))
        return F.transform(F.split(body, PART), lambda p: F.struct(unescape(role).alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def digest(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    read = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(F.array_join(line, "")).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
