"""Chat formatting with a grammar round trip, in DataFrame expressions only.

Grammar of a formatted conversation, a sequence of turns:

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    any other  [ROLE hex of the role's UTF-8]text[/ROLE]

The parser takes the leftmost opening mark, the text up to the first closing mark of its kind, and goes
on behind it. In texts it then takes one backslash from every guarded mark, that is a mark with
backslashes behind its first character.

A conversation is first rendered as it is and parsed back. If the recovered turns are not the source's,
texts whose marks or guards would be misread get one more backslash in each of their marks and
guarded marks, which no text can undo: after that every conversation comes back identical.
``format_level`` says which rendering was taken.

Null text is an empty text, null role an empty role. Turns are ordered by turn (null first), then
role, then text, so repeated rows follow each other. Rows with a null conv_id form one conversation. An empty
table gives no rows; other columns are ignored. A conversation is one row, so it has to fit in a
task's memory; equal conversations meet nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.shared import text_column

# Marks in texts, with any number of backslashes behind the first character.
_MARK = r"([<\[])(\\*)(<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE)"
_GUARDED = r"([<\[])\\(\\*)(<SYS>>|</SYS>>|/?INST\]|/?s>|/?ROLE)"
_TURN = r"(?s)<<SYS>>(.*?)<</SYS>>|\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|\[ROLE ([0-9A-F]*)\](.*?)\[/ROLE\]"

PLAIN_LEVEL, GUARDED_LEVEL = 0, 1


def guarded(text: Column) -> Column:
    """One more backslash in every mark of a text."""
    return F.regexp_replace(text, _MARK, r"$1\\$2$3")


def unguarded(text: Column) -> Column:
    return F.regexp_replace(text, _GUARDED, r"$1$2$3")


def _rendered(turn: Column) -> Column:
    role, text = turn["role"], turn["text"]
    return (
        F.when(role == "system", F.concat(F.lit("<<SYS>>"), text, F.lit("<</SYS>>")))
        .when(role == "user", F.concat(F.lit("[INST]"), text, F.lit("[/INST]")))
        .when(role == "assistant", F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("[ROLE "), F.hex(F.encode(role, "UTF-8")), F.lit("]"), text, F.lit("[/ROLE]")))
    )


def rendered(turns: Column) -> Column:
    """Formatted conversation of an array of struct(role, text)."""
    return F.array_join(F.transform(turns, _rendered), "")


def _between(piece: Column, before: int, after: int) -> Column:
    return F.substring(piece, F.lit(before + 1), F.length(piece) - (before + after))


def _parsed(piece: Column) -> Column:
    at = F.instr(piece, "]")
    other = F.substring(piece, F.lit(7), at - 7)
    raw = (
        F.when(piece.startswith("<<SYS>>"), _between(piece, 7, 8))
        .when(piece.startswith("[INST]"), _between(piece, 6, 7))
        .when(piece.startswith("<s>"), _between(piece, 3, 4))
        .otherwise(F.substring(piece, at + 1, F.length(piece) - at - 7))
    )
    role = (
        F.when(piece.startswith("<<SYS>>"), F.lit("system"))
        .when(piece.startswith("[INST]"), F.lit("user"))
        .when(piece.startswith("<s>"), F.lit("assistant"))
        .otherwise(F.decode(F.unhex(other), "UTF-8"))
    )
    return F.struct(role.alias("role"), unguarded(raw).alias("text"))


def pieces(formatted: Column) -> Column:
    """The turns of a formatted conversation as they stand there."""
    return F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of struct(role, text)."""
    return F.transform(pieces(formatted), _parsed)


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, format_level and ``turns``, which are read back from ``formatted``.

    ``loss_text`` is what the loss mask covers, read back as well: the assistant's texts in order. ``loss_spans`` are the
    masked places of ``formatted``: array of struct(start, length) in characters, guards included.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text_column("text").alias("text"),
    )
    grouped = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("one")).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("source"))
    source = grouped.withColumn("source", F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    # Most conversations come back as they are; the guarded rendering is made for the others only.
    plain = source.withColumn("plain", rendered(F.col("source")))
    tried = plain.withColumn("same", F.concat_ws("", pieces(F.col("plain"))).eqNullSafe(F.col("plain")) & parsed(F.col("plain")).eqNullSafe(F.col("source")))
    shielded = F.transform("source", lambda t: F.struct(t["role"].alias("role"), guarded(t["text"]).alias("text")))
    chosen = tried.select(
        "conv_id",
        F.when(F.col("same"), F.col("plain")).otherwise(rendered(shielded)).alias("formatted"),
        F.when(F.col("same"), F.lit(PLAIN_LEVEL)).otherwise(F.lit(GUARDED_LEVEL)).alias("format_level"),
    )
    read = chosen.withColumn("pieces", pieces(F.col("formatted"))).withColumn("turns", F.transform("pieces", _parsed))
    lengths = F.transform("pieces", lambda p: F.length(p))
    spans = F.transform(
        F.filter(
            F.transform("pieces", lambda p, k: F.struct(p.startswith("<s>").alias("masked"), (F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0), lambda a, n: a + n) + 3).alias("start"), (F.length(p) - 7).alias("length"))),
            lambda x: x["masked"],
        ),
        lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")),
    )
    # The same places, taken from the pieces: cutting every span from the front of a long conversation would take its square.
    masked = F.array_join(F.transform(F.filter("pieces", lambda p: p.startswith("<s>")), lambda p: unguarded(_between(p, 3, 4))), "")
    return read.withColumn("loss_spans", spans).withColumn("loss_text", masked).drop("pieces")
