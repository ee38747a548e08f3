"""Chat formatting with a verified grammar round trip (DataFrame functions only).

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "### " role ": " body "</turn>\\n"

"### " and "</turn>" are control strings and occur nowhere else. Bodies are first rendered as they are and reparsed; where
the recovered turns differ from the source, the conversation's bodies that hold a conflict are escaped, and the result is
reparsed again. An escape is a backslash and a letter (see ESCAPES), so an escaped body holds no control string, and the
parser always undoes escapes: a body with a backslash is a conflict too. A conversation that is still not identical raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, SEP, END = "### ", ": ", "</turn>\n"
#: What is escaped, in the order of escaping; undone in the reverse order.
ESCAPES = (("\\", "\\b"), ("</turn>", "\\t"), ("### ", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (": ", "\\c"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def render(turns: Column, body) -> Column:
    """The formatted text of an array of (role, text); body makes a turn's body from its text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), escape(t["role"], ROLE_ESCAPES), F.lit(SEP), body(t["text"]), F.lit(END))), "")


def parse(formatted: Column) -> Column:
    """Array of (role, text, start, length) read from a formatted text; start and length place the raw body in code points.

    A body ends at its first "</turn>"; whatever else stands before the next head is lost, which shows as a difference.
    """
    chunks = F.slice(F.split(formatted, HEAD), 2, F.greatest(F.size(F.split(formatted, HEAD)) - 1, F.lit(0)))
    head = F.length(F.lit(HEAD))

    def turn(chunk: Column) -> Column:
        at = F.instr(chunk, SEP)
        role = F.substring(chunk, F.lit(1), at - 1)
        rest = F.substring(chunk, at + len(SEP), F.length(chunk))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), F.substring_index(rest, END.rstrip("\n"), 1).alias("raw"), F.length(chunk).alias("size"), (at + len(SEP) - 1).alias("body"))

    # Each turn's start is the length of all chunks before it.
    placed = F.aggregate(
        F.transform(chunks, turn),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<role:string,text:string,start:int,length:int>>").alias("turns")),
        lambda acc, t: F.struct(
            (acc["at"] + head + t["size"]).alias("at"),
            F.concat(acc["turns"], F.array(F.struct(t["role"].alias("role"), unescape(t["raw"]).alias("text"), (acc["at"] + head + t["body"]).cast("int").alias("start"), F.length(t["raw"]).alias("length")))).alias("turns"),
        ),
    )
    return placed["turns"]


def _same(turns: Column, parsed: Column) -> Column:
    pairs = lambda x: F.transform(x, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return pairs(turns) == pairs(parsed)


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conv_id: conv_id, n_turns, formatted, escaped, turns (role, text, start, length), all read from `formatted`.

    conversations: conv_id, turn, role, text; other columns don't matter, whatever their names. Rows of a conversation go by
    turn (null first), then role, then text; repeated rows are repeated turns. A null role or text counts as empty. A null
    conv_id is a conversation of its own. No rows give no rows. turns[].loss marks the turns under the loss mask: those of
    loss_role, whose code points [start, start + length) of `formatted` hold the escaped text.
    """
    rows = conversations.select(F.col("conv_id"), F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("source"))
    plain = grouped.withColumn("plain", render(F.col("source"), lambda text: text))
    plain = plain.withColumn("fits", _same(F.col("source"), parse(F.col("plain"))))
    chosen = plain.withColumn("formatted", F.when(F.col("fits"), F.col("plain")).otherwise(render(F.col("source"), escape))).drop("plain")
    parsed = chosen.withColumn("parsed", parse(F.col("formatted")))
    checked = F.when(_same(F.col("source"), F.col("parsed")), F.col("parsed")).otherwise(F.raise_error(F.lit("a formatted conversation doesn't parse back to its turns")).cast("array<struct<role:string,text:string,start:int,length:int>>"))
    marked = F.transform(checked, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["start"].alias("start"), t["length"].alias("length"), (t["role"] == loss_role).alias("loss")))
    return parsed.select("conv_id", F.size("source").cast("long").alias("n_turns"), "formatted", (~F.col("fits")).alias("escaped"), marked.alias("turns"))


def digest(formatted: DataFrame) -> DataFrame:
    """The digest columns of format_conversations' output; texts under the loss mask are cut out of `formatted` by their spans."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    spans = F.filter("turns", lambda t: t["loss"])
    loss = F.array_join(F.transform(spans, lambda t: unescape(F.substring(F.col("formatted"), t["start"] + 1, t["length"]))), "")
    return formatted.withColumn("loss_text", loss).select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "escaped",
    )
