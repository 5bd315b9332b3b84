"""Correction notices: dated events, operations (for/read, add, delete, replace, instruction), references.

Notices are text of the form "P-31.1 [corrected 3 March 2024] ...". Cutting a page into notices, dating them and finding
commands are regex positions; pairing "for" with the following "read" is a look at the next command by a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.text import compact, positions, visible_text

#: Words of events and of commands.
EVENTS = ("corrected", "modified", "added", "changed")
COMMANDS = ("add in a box", "add the structure", "replace the structure with", "replace structure by", "replace by", "replace", "delete", "for", "read", "add")
_SAID = "|".join(c.replace(" ", r"\s+") for c in COMMANDS)
#: A command's mark in the text: what was set in blue, or opened a line, a paragraph or the body.
SIGN = "\x01"
COMMAND = rf"(?i){SIGN}(?:{_SAID})\s*:?"
RULE = r"(?i)\bP-[0-9]+(?:\.[0-9]+)*"
#: What a header can name beside rules: the words before the name, and the characters that names of that kind are made of.
NAMED = {"page": (("page",), "0-9"), "table": (("table",), "A-Za-z0-9.-"), "figure": (("figure", "fig.", "fig"), "A-Za-z0-9.-"), "appendix": (("appendix",), "0-9")}
LEFT = 45


def bracketed(line: Column) -> Column:
    """What stands between the brackets of a line, in order: each ``[`` up to the next ``]``, not empty."""
    opened = F.slice(F.split(line, r"\[", -1), F.lit(2), F.size(F.split(line, r"\[", -1)))
    closed = F.filter(opened, lambda x: F.contains(x, F.lit("]")))
    return F.filter(F.transform(closed, lambda x: F.substring_index(x, "]", 1)), lambda x: x != "")


def is_header(line: Column) -> Column:
    """Whether a bracket of the line begins with the word of an event."""
    word = lambda x: F.lower(F.regexp_extract(x, "^[A-Za-z0-9_]+", 0))
    return F.exists(bracketed(line), lambda x: word(x).isin(*EVENTS))


def notices(pages: DataFrame, id_col: str = "page", text_col: str = "text") -> DataFrame:
    """One row for each notice of a page: ``overlay_id``, ``start``, ``end``, ``header``, ``body``.

    A page is read as lines with their places; those with an event in brackets are headers, and each notice goes on to
    the next one.
    """
    lines = pages.select(id_col, F.col(text_col).alias("t"), F.explode(positions(F.col(text_col), r"[^\r\n]+")).alias("h"))
    e = lines.where(is_header(F.col("h.text")))
    w = Window.partitionBy(id_col).orderBy("h.start")
    e = e.select("*", F.col("h.start").alias("start")).withColumn("end", F.coalesce(F.lead("start").over(w), F.char_length("t"))).withColumn("k", F.row_number().over(w))
    body = F.regexp_replace(F.substring("t", F.col("h.end") + 1, F.col("end") - F.col("h.end")), r"\s+$", "")
    return e.select(id_col, F.format_string("%s:correction:%04d", F.col(id_col).cast("string"), "k").alias("overlay_id"), "start", "end", F.col("h.text").alias("header"), body.alias("body"))


def event_date(text: Column) -> Column:
    """A date written d.m.yyyy or d Month yyyy; null if neither."""
    return F.coalesce(F.try_to_date(text, "d.M.yyyy"), F.try_to_date(F.initcap(F.regexp_replace(text, r"\s+", " ")), "d MMMM yyyy"), F.try_to_date(F.initcap(F.regexp_replace(text, r"\s+", " ")), "d MMM yyyy"))


def events(n: DataFrame) -> DataFrame:
    """``overlay_id``, ``ordinal``, ``event``, ``event_date`` from notice headers: an event's word and the words after it,
    which are a day, month and year, or all three in one."""
    e = n.select("overlay_id", F.split(F.regexp_replace("header", r"[\[\];,()]", " ; "), r"\s+").alias("w"))
    at = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: F.lower(F.element_at("w", i)).isin(*EVENTS))
    e = e.select("overlay_id", "w", F.explode(F.when(F.size("w") > 0, at)).alias("i"))
    later = lambda k: F.coalesce(F.try_element_at("w", F.col("i") + k), F.lit(""))
    one = F.when(later(1).rlike(r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"), F.regexp_extract(later(1), r"^[0-9]+\.[0-9]+\.[0-9]{4}", 0))
    three = F.when(later(1).rlike("^[0-9]{1,2}$") & later(2).rlike("^[A-Za-z]+$") & later(3).rlike("^[0-9]{4}"), F.concat_ws(" ", later(1), later(2), F.left(later(3), F.lit(4))))
    e = e.withColumn("said", F.coalesce(one, three)).where("said is not null")
    order = Window.partitionBy("overlay_id").orderBy("i")
    return e.select("overlay_id", F.row_number().over(order).alias("ordinal"), F.lower(F.element_at("w", F.col("i"))).alias("event"), event_date(F.col("said")).alias("event_date"))


def _marked(body: Column) -> Column:
    """``body`` with a sign before every command: the words of a blue span, and those that open a line, paragraph or body."""
    blue = F.regexp_replace(body, rf"""(?is)<span\b[^>]*\bcolor\s*:\s*blue[^>]*>\s*({_SAID})\s*</span>""", f" {SIGN}$1 ")
    opened = F.regexp_replace(blue, r"(?i)(<br\s*/?>|<p(?:\s[^>]*)?>)", "$1\n")
    return F.array_join(F.transform(F.split(opened, "\n", -1), lambda x: F.regexp_replace(x, rf"(?i)^\s*({_SAID})\b", f" {SIGN}$1 ")), "\n")


def operations(n: DataFrame) -> DataFrame:
    """``overlay_id``, ``ordinal``, ``kind``, ``before_text``, ``after_text``, ``instruction_text`` in order.

    Text before the first command, and a body without one, is an instruction.
    """
    body = visible_text(_marked(F.col("body")))
    e = n.select("overlay_id", body.alias("b")).select("overlay_id", "b", positions(F.col("b"), COMMAND).alias("c"))
    lead = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("instruction").alias("text"))
    e = e.select("overlay_id", "b", F.posexplode(F.concat(F.array(lead), F.col("c"))).alias("i", "x"))
    w = Window.partitionBy("overlay_id").orderBy("i")
    e = e.withColumn("stop", F.coalesce(F.lead("x.start").over(w), F.char_length("b")))
    command = F.btrim(F.lower(F.regexp_replace("x.text", rf"{SIGN}|\s*:$", "")))
    command = F.when(command.startswith("replace"), "replace").when(command.startswith("add"), "add").otherwise(command)
    e = e.select("overlay_id", "i", command.alias("command"), compact(F.substring("b", F.col("x.end") + 1, F.col("stop") - F.col("x.end"))).alias("said"))
    e = e.where("command <> 'instruction' or said <> ''")
    e = e.withColumn("next", F.lead("command").over(w)).withColumn("next_said", F.lead("said").over(w)).withColumn("before", F.lag("command").over(w))
    e = e.where(~((F.col("command") == "read") & F.coalesce(F.col("before") == "for", F.lit(False))))
    pair = (F.col("command") == "for") & F.coalesce(F.col("next") == "read", F.lit(False))
    kind = F.when(pair | (F.col("command") == "replace"), "replacement").when(F.col("command") == "add", "addition").when(F.col("command") == "delete", "deletion").otherwise("instruction")
    out = e.select(
        "overlay_id",
        F.row_number().over(w).alias("ordinal"),
        kind.alias("kind"),
        F.when(pair | (F.col("command") == "delete"), F.col("said")).alias("before_text"),
        F.when(pair, F.col("next_said")).when(F.col("command").isin("add", "replace"), F.col("said")).alias("after_text"),
        F.when(kind == "instruction", F.when(F.col("command") == "instruction", F.col("said")).otherwise(F.concat_ws(" ", "command", "said"))).alias("instruction_text"),
    )
    return out


def selectors(n: DataFrame) -> DataFrame:
    """What a notice's header names: ``overlay_id``, ``kind`` (rule, page, table, figure, appendix, contents), ``value``."""
    kinds = F.array().cast("array<struct<kind:string,value:string>>")
    names = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    words = F.filter(F.split(F.regexp_replace("header", r"[\[\](),;:]", " "), r"\s+"), lambda x: x != "")
    found = [names("rule", F.regexp_extract_all("header", F.lit(RULE), F.lit(0)))]
    for kind, (heads, kept) in NAMED.items():
        at = F.filter(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.lower(F.element_at(words, i)).isin(*heads))  # noqa: B023
        value = F.transform(at, lambda i: F.regexp_extract(F.element_at(words, i + 1), f"^[{kept}]+", 0))  # noqa: B023
        found.append(F.when(F.size(words) > 1, names(kind, F.filter(value, lambda v: v != ""))).otherwise(kinds))
    found.append(F.when(F.exists(words, lambda x: F.lower(x) == "contents"), F.array(F.struct(F.lit("contents").alias("kind"), F.lit("").alias("value")))).otherwise(kinds))
    found = F.concat(*found)
    return n.select("overlay_id", F.explode(found).alias("x")).select("overlay_id", "x.kind", "x.value")


def references(n: DataFrame) -> DataFrame:
    """Rules that a body names, their relation read from the text just before: ``overlay_id``, ``ordinal``, ``rule_id``, ``relation``."""
    e = n.select("overlay_id", "body", F.posexplode(positions(F.col("body"), RULE)).alias("i", "x"))
    left = F.lower(F.substring("body", F.greatest(F.lit(1), F.col("x.start") + 1 - LEFT), F.least(F.col("x.start"), F.lit(LEFT))))
    relation = F.when(left.rlike(r"conflict\w*(?:\s+with)?[^.]*$"), "conflicts_with").when(left.rlike(r"(?:renamed|renumbered|formerly)[^.]*$"), "renamed_from").when(left.rlike(r"\b(?:see|cf\.?)\s[^.]*$"), "see").otherwise("mentions")
    return e.select("overlay_id", (F.col("i") + 1).alias("ordinal"), F.upper("x.text").alias("rule_id"), relation.alias("relation"))
