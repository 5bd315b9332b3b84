"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, then that reply, of which
only the text is trainable. Turns after the last reply (or all, if there is none) form one more example without
a trainable part, so a conversation can be read back whole from its last example.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside texts and roles every ``<|`` (with any number of
backslashes between the two characters) gets one backslash more, so no control string of a text stands in the
output and the inverse is exact; in roles a backslash and a line feed are written ``\\\\`` and ``\\n`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)  # a pair of backslashes stands for one; what is left of \n is a line feed
    return unescape(F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"))


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: its id and ``turns``, an ordered array<struct<role,text>>.

    Order is by turn, then role, then text (null turns first), so repeated rows and ties have a defined place.
    Null roles and texts are empty. A conversation is one training unit, so its turns meet in one row.
    """
    row = F.struct(
        F.col(turn_col).cast("long").alias("t"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    g = df.select(F.col(conv_col).alias(conv_col), row.alias("x")).groupBy(conv_col).agg(F.sort_array(F.collect_list("x")).alias("x"))
    return g.select(conv_col, F.transform("x", lambda x: F.struct(x["role"], x["text"])).alias("turns"))


def examples(conversations: DataFrame, conv_col: str = "conv_id", trainable: str = "assistant") -> DataFrame:
    """One row for each example of ``turns()``.

    Columns: the id, ``example`` (from 0), ``n_turns``, ``formatted``, ``loss_start`` and ``loss_end`` (code points of
    ``formatted``, the end exclusive; equal, if nothing is trainable), ``last`` (whether it holds the whole conversation).
    """
    c = conversations.select(
        conv_col,
        F.size("turns").alias("n"),
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n")).alias("whole"),
                F.char_length(escape(t["text"])).alias("size"),
                (t["role"] == trainable).alias("loss"),
            ),
        ).alias("turn"),
    )
    ends = F.filter(F.transform("turn", lambda t, i: F.when(t["loss"] | (i == F.col("n") - 1), i + 1)), lambda i: i.isNotNull())
    e = c.select(conv_col, "n", "turn", F.posexplode(ends).alias("example", "upto"))
    of = F.element_at("turn", F.col("upto"))
    out = e.select(
        conv_col,
        F.col("example").cast("long").alias("example"),
        F.col("upto").cast("long").alias("n_turns"),
        F.array_join(F.transform(F.slice("turn", F.lit(1), F.col("upto")), lambda t: t["whole"]), "").alias("formatted"),
        F.when(of["loss"], of["size"]).otherwise(0).alias("_size"),
        (F.col("upto") == F.col("n")).alias("last"),
    )
    stop = F.char_length("formatted") - len(END) - 1
    return out.select(conv_col, "example", "n_turns", "formatted", (stop - F.col("_size")).alias("loss_start"), stop.alias("loss_end"), "last")


def parse(formatted: Column) -> Column:
    """The turns, array<struct<role,text>>, of a formatted string."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b: b != "")

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        body = F.substring(b, F.char_length(role) + 2, F.char_length(b) - F.char_length(role) - 1 - len(END) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, turn)


def digests(ex: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Read back from ``examples()``: per conversation its turns' and trainable texts' digests and sizes.

    Texts are read from the formatted strings only: turns from the last example, losses from the masks of all.
    """
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    said = F.when(F.col("last"), F.array_join(F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""))
    e = ex.select(
        conv_col,
        F.struct("example", loss.alias("loss")).alias("x"),
        F.when(F.col("last"), F.col("n_turns")).alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("said"),
        F.char_length("formatted").cast("long").alias("size"),
    )
    g = e.groupBy(conv_col).agg(F.max("n_turns").alias("n_turns"), F.max("said").alias("turns_sha256"), F.sort_array(F.collect_list("x")).alias("x"), F.sum("size").alias("formatted_chars"))
    text = F.array_join(F.transform("x", lambda x: x["loss"]), "")
    return g.select(conv_col, "n_turns", "turns_sha256", F.char_length(text).cast("long").alias("loss_chars"), F.sha2(text.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
