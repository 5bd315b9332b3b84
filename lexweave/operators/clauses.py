"""Clause inventory: nodes of documents to addressable units of text, with coverage counters and context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.text import sentence_spans, sha_upper

#: Node kinds and the kind of the units they give.
UNIT_KINDS = {"heading": "heading_text", "paragraph": "sentence", "prose": "sentence", "list_item": "list_item", "table_cell": "table_cell", "note": "note", "link": "link_text", "image": "image_payload"}
WHOLE = ("heading", "table_cell", "link")


def clauses(nodes: DataFrame, owner: str = "rule_id") -> DataFrame:
    """Units of a flat node table (owner, ``ordinal``, ``kind``, ``text``): ``unit_id``, ``ordinal``, ``node``,
    ``unit_kind``, ``text_start``, ``text_end``, ``text``, ``text_sha256``, in order of emission.

    Headings, cells and links stay whole; other text is cut to sentences. Images give one unit without text.
    """
    n = nodes.where(F.col("kind").isin(*UNIT_KINDS)).select(owner, F.col("ordinal").alias("node"), "kind", F.coalesce("text", F.lit("")).alias("text"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.char_length("text").alias("end")))
    spans = F.when(F.col("kind") == "image", whole).when(F.col("kind").isin(*WHOLE), F.when(F.col("text") != "", whole)).otherwise(sentence_spans(F.col("text")))
    e = n.select("*", F.posexplode(spans).alias("k", "s"))
    text = F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    kinds = F.create_map(*(F.lit(x) for kv in UNIT_KINDS.items() for x in kv))
    w = Window.partitionBy(owner).orderBy("node", "k")
    e = e.withColumn("ordinal_", F.row_number().over(w))
    return e.select(
        owner,
        F.format_string("%s:clause:%04d", F.col(owner).cast("string"), "ordinal_").alias("unit_id"),
        F.col("ordinal_").alias("ordinal"),
        "node",
        F.element_at(kinds, F.col("kind")).alias("unit_kind"),
        F.col("s.start").alias("text_start"),
        F.col("s.end").alias("text_end"),
        text.alias("text"),
        sha_upper(text).alias("text_sha256"),
    )


def uncovered(nodes: DataFrame, units: DataFrame, owner: str = "rule_id") -> DataFrame:
    """Nodes of which some visible character lies in no unit, or in two: ``code``, ``key``, ``detail``."""
    said = units.groupBy(owner, F.col("node").alias("ordinal")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("text_start", "text"))), lambda x: x["text"]), "").alias("_said"))
    bare = lambda c: F.regexp_replace(c, r"(?U)\s+", "")
    j = nodes.where(F.col("kind").isin(*[k for k in UNIT_KINDS if k != "image"])).join(said, [owner, "ordinal"], "left")
    return j.where(bare(F.coalesce("text", F.lit(""))) != bare(F.coalesce("_said", F.lit("")))).select(F.lit("clause.coverage").alias("code"), F.concat_ws(":", F.col(owner).cast("string"), F.col("ordinal").cast("string")).alias("key"), F.lit("text and units differ").alias("detail"))


def cue(text: Column) -> Column:
    """What a line announces: caption, note, example, rule list or nothing."""
    t = F.lower(F.ltrim(text))
    return F.when(t.rlike(r"^(?:table|fig(?:ure)?\.?)\s+[a-z0-9.]+"), "caption").when(t.rlike(r"^notes?\b\s*[:0-9.]*"), "note").when(t.rlike(r"^examples?\b\s*:?"), "example").when(t.rlike(r":\s*$"), "list_intro").otherwise("none")


def list_family(marker: Column) -> Column:
    """The family of a list marker. A single i, v or x counts as roman; ``peers`` decide elsewhere."""
    core = F.regexp_replace(F.btrim(marker), r"^[(\[]|[)\].:]$", "")
    return (
        F.when(core.rlike(r"^[0-9]+$"), "arabic")
        .when(core.rlike(r"^[ivxlcdm]+$"), "lower_roman")
        .when(core.rlike(r"^[IVXLCDM]+$"), "upper_roman")
        .when(core.rlike(r"^[a-z]$"), "lower_alpha")
        .when(core.rlike(r"^[A-Z]$"), "upper_alpha")
        .when(core.rlike(r"^[•*·–-]$"), "bullet")
        .otherwise("unordered")
    )


def counters(units: DataFrame, owner: str, kinds: tuple[str, ...] = tuple(dict.fromkeys(UNIT_KINDS.values()))) -> DataFrame:
    """Units by owner and kind, zeros kept, with a grand total row (null owner)."""
    wanted = [F.count_if(F.col("unit_kind") == k).alias(k) for k in kinds]
    return units.rollup(owner).agg(*wanted)


def map_offsets(text: Column, origin: Column, start: Column, end: Column) -> Column:
    """Runs of source places behind a span of cleaned text: array<struct<start,end>> of ``origin`` places that follow
    one another (``origin`` holds, for each character of ``text``, where it came from)."""
    at = F.slice(origin, start + 1, end - start)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grow = last["end"] == x
        head = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(grow, F.concat(head, F.array(F.struct(last["start"].alias("start"), (x + 1).alias("end"))))).otherwise(F.concat(acc, F.array(F.struct(x.alias("start"), (x + 1).alias("end")))))

    return F.aggregate(at, empty, step)


def reassemble(spans: DataFrame, owner: str, pos: str, text: str, sep: str = "\n") -> DataFrame:
    """Text of an owner from its ordered pieces."""
    return spans.groupBy(owner).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(pos, text))), lambda x: x[text]), sep).alias("text"))
