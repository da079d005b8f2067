"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is rendered with a template, read back by a parser of the template's grammar and compared with its
source. Where they differ, the content in conflict is escaped and the conversation rendered again: level 0 is
plain, level 1 escapes control strings in texts, level 2 roles as well. The parser always unescapes, so the
reader needs no mark; level 2 is always identical.

Grammar: conversation = turn*; turn = START role newline text END newline; role has no newline and no START,
text neither START nor END.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
CLOSE = END + "\n"


def escape_text(text: Column) -> Column:
    """One backslash more in every `<`, backslashes, `|`; undone by unescape_text, whatever the text holds."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: Column, role: Callable[[Column], Column] = lambda c: c, text: Callable[[Column], Column] = lambda c: c) -> Column:
    """turns: array of (role, text) structs -> one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), role(t["role"]), F.lit("\n"), text(t["text"]), F.lit(CLOSE))), "")


def parse(formatted: Column) -> Column:
    """The turns of a rendered string as (role, text, body, start): body is the text as it stands, at code point
    start (from 0). A part that breaks the grammar has null for its text."""
    pieces = F.split(formatted, r"<\|im_start\|>")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substr(piece, F.length(head) + 2, F.length(piece) - F.length(head) - 1 - F.lit(len(CLOSE)))
        good = F.endswith(piece, F.lit(CLOSE)) & ~F.contains(body, F.lit(END)) & (F.length(piece) >= F.length(head) + 1 + len(CLOSE))
        return F.struct(
            unescape_role(head).alias("role"),
            F.when(good, unescape_text(body)).alias("text"),
            F.when(good, body).alias("body"),
            F.length(head).alias("head"),
            F.length(piece).alias("size"),
        )

    turns = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)
    return F.when((formatted == "") | (F.get(pieces, F.lit(0)) == ""), turns)


def _pairs(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, n_turns, level, formatted, turns, loss_spans, loss_text) per conversation, read back from the output.

    Rows are taken by turn, ties by role and text, null turns first; rows that repeat stay. Null roles and texts
    are empty. turns are the parsed (role, text); loss_spans (start, length in code points) mark the assistant
    texts in formatted, and loss_text is what stands there, unescaped. The null conversation is one of its own.
    A conversation is one string, so its rows meet in one task: it must fit into a row, as its result does.
    """
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = rows.groupBy(F.col(conv_col).alias("conv")).agg(F.array_sort(F.collect_list(row)).alias("source"))
    convs = convs.select("conv", _pairs(F.col("source")).alias("source"))
    plain, texts = render(F.col("source")), render(F.col("source"), text=escape_text)
    both = render(F.col("source"), escape_role, escape_text)
    same = lambda form: F.coalesce(_pairs(parse(form)) == F.col("source"), F.lit(False))
    told = convs.withColumn("plain", plain).withColumn("level", F.when(same(F.col("plain")), 0))
    told = told.withColumn("formatted", F.when(F.col("level") == 0, F.col("plain")).otherwise(texts))
    told = told.withColumn("level", F.coalesce("level", F.when(same(F.col("formatted")), 1), F.lit(2)))
    told = told.withColumn("formatted", F.when(F.col("level") == 2, F.when(same(both), both).otherwise(F.raise_error(F.lit("a conversation does not survive its round trip")))).otherwise(F.col("formatted")))
    parsed = told.select("conv", "level", "formatted", parse(F.col("formatted")).alias("parsed"))
    # The text of a turn starts after all turns before it, START, its role and a newline.
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def walk(state: Column, t: Column) -> Column:
        span = F.struct((state["at"] + F.lit(len(START) + 1) + t["head"]).alias("start"), F.length(t["body"]).alias("length"))
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.lit(len(START)) + t["size"]).alias("at"), spans.alias("spans"))

    marked = parsed.withColumn("loss_spans", F.aggregate("parsed", first, walk)["spans"])
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape_text(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return marked.select("conv", F.size("parsed").cast("bigint").alias("n_turns"), "level", "formatted", _pairs(F.col("parsed")).alias("turns"), "loss_spans", loss.alias("loss_text"))
