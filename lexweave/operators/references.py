"""References in pages and rule documents: link occurrences, rule sections, targets, overlays."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import html as H
from lexweave.functions.text import attribute, mask_comments, positions, resolve_url, strip_comments

LINK = r"(?is)<a\s[^>]*>.*?</a\s*>"
#: The shape of rule ids (a fixed value of the documents read here).
RULE_ID = r"P-[0-9]+(?:\.[0-9]+)*"


def links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Links with their places: the id, ``ordinal``, ``start``, ``end``, ``href``, ``label``. Comments don't count;
    offsets are those of the whole page, as comments are blanked and not cut."""
    masked = mask_comments(F.col(html_col))
    e = pages.select(id_col, F.posexplode(positions(masked, LINK)).alias("i", "x"))
    tag = F.regexp_extract(F.col("x.text"), r"(?is)^(<a\s[^>]*>)", 1)
    return e.select(id_col, (F.col("i") + 1).alias("ordinal"), F.col("x.start").alias("start"), F.col("x.end").alias("end"), attribute(tag, "href").alias("href"), F.regexp_replace(F.regexp_replace("x.text", r"(?s)<[^>]*>", ""), r"\s+", " ").alias("label"))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)


def sections(documents: DataFrame, id_col: str = "document_id", raw_col: str = "raw") -> DataFrame:
    """Rule sections of byte documents by their named anchors: ``rule_id``, ``anchor``, ``start_byte``, ``end_byte``.

    A section begins at the start of the line that holds its anchor and ends where the next one begins; the last ends at
    the first line with a rule-off or at the end of the body. Anchors inside comments don't count.
    """
    view = F.decode(F.col(raw_col), "ISO-8859-1")
    d = documents.select(id_col, mask_comments(view).alias("v"))
    anchor = rf"""(?i)<a\b[^>]*\bname\s*=\s*["']?({RULE_ID})["'\s>]"""
    e = d.select(id_col, "v", F.explode(positions(F.col("v"), anchor)).alias("x"))
    e = e.select(id_col, "v", F.regexp_extract("x.text", f"(?i)({RULE_ID})", 1).alias("anchor"), F.col("x.start").alias("at"))
    before = F.substring("v", F.lit(1), F.col("at"))
    e = e.withColumn("start_byte", F.char_length(before) - F.char_length(F.substring_index(before, "\n", -1)))
    tail = F.substring("v", F.col("at") + 1, F.char_length("v"))
    off = F.least(F.when(F.locate("<hr", F.lower(tail)) > 0, F.locate("<hr", F.lower(tail))), F.when(F.locate("</body>", F.lower(tail)) > 0, F.locate("</body>", F.lower(tail))))
    from pyspark.sql import Window

    w = Window.partitionBy(id_col).orderBy("start_byte", "at")
    last = F.coalesce(F.col("at") + off - 1, F.char_length("v"))
    out = e.withColumn("end_byte", F.coalesce(F.lead("start_byte").over(w), last)).withColumn("ordinal", F.row_number().over(w))
    return out.select(id_col, F.upper("anchor").alias("rule_id"), "anchor", "ordinal", "start_byte", "end_byte")


def section_violations(found: DataFrame, id_col: str = "document_id") -> DataFrame:
    """Rules with two sections in a document, and sections that share a line."""
    from lexweave.operators.validate import duplicates, violations

    return violations(duplicates(found, id_col, "rule_id", code="section.duplicate"), duplicates(found, id_col, "start_byte", code="section.shared_line"))


def occurrences(fragments: DataFrame) -> DataFrame:
    """Reference occurrences of HTML fragments (``rule_id``, ``html``): ``kind`` (href or text), ``text``, ``cited``,
    ``href``, ``start``, ``end``, ``occurrence_id``.

    The scan keeps state (open links, block tags that end them), so it runs as one Arrow function per batch; what a
    reference points at is resolved by joins afterwards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for rule, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k, o in enumerate(H.reference_scan(text or "", rule or "", RULE_ID), 1):
                    rows.append((rule, f"{rule}:xref:{k:04d}", *o))
            names = ["rule_id", "occurrence_id", "kind", "text", "cited", "href", "start", "end"]
            kinds = [pa.string()] * 6 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names=names)

    return fragments.select("rule_id", "html").mapInArrow(run, "rule_id string, occurrence_id string, kind string, text string, cited string, href string, start int, end int")


def resolve(occ: DataFrame, fragments: DataFrame, documents: DataFrame) -> DataFrame:
    """Targets of occurrences by a cascade: the link's anchor, the link's document, the cited id, the document inferred
    from it, else unresolved.

    ``occ`` needs ``occurrence_id``, ``base_url``, ``href``, ``cited``; ``fragments`` has ``document_id``, ``rule_id``,
    ``anchor``; ``documents`` has ``document_id``, ``file``, ``major`` (the first part of ids it holds). Duplicate anchors
    are told apart by the cited id, and otherwise count only if they are one.
    """
    o = occ.withColumn("_u", resolve_url(F.col("base_url"), F.col("href"))).withColumn("_file", F.col("_u.file")).withColumn("_anchor", F.lower("_u.fragment"))
    docs = documents.select("document_id", F.lower("file").alias("_file"))
    o = o.join(docs.withColumnRenamed("document_id", "_doc"), "_file", "left")
    anchors = fragments.select(F.col("document_id").alias("_doc"), F.lower("anchor").alias("_anchor"), "rule_id").groupBy("_doc", "_anchor").agg(F.collect_set("rule_id").alias("_at"))
    o = o.join(anchors, ["_doc", "_anchor"], "left")
    known = fragments.select(F.col("rule_id").alias("_cited"), F.col("document_id").alias("_home")).groupBy("_cited").agg(F.min("_home").alias("_home"))
    o = o.join(known, F.upper(o["cited"]) == known["_cited"], "left")
    majors = documents.select(F.col("document_id").alias("_inferred"), F.col("major").alias("_major"))
    o = o.withColumn("_m", F.regexp_extract(F.upper(F.coalesce("cited", F.lit(""))), r"^(P-[0-9]+)", 1)).join(majors, F.col("_m") == F.col("_major"), "left")
    chosen = F.when(F.array_contains("_at", F.upper("cited")), F.upper("cited")).when(F.size("_at") == 1, F.element_at("_at", 1))
    kind = F.when(chosen.isNotNull(), "href_anchor").when(F.col("_doc").isNotNull() & (F.coalesce("_anchor", F.lit("")) == ""), "href_document").when(F.col("_cited").isNotNull(), "reference_text").when(F.col("_inferred").isNotNull(), "inferred_document").otherwise("unresolved")
    out = o.withColumn("resolution_basis", kind)
    return out.select(
        *occ.columns,
        "resolution_basis",
        F.when(kind == "href_anchor", chosen).when(kind == "reference_text", F.col("_cited")).alias("target_rule"),
        F.when(kind.isin("href_anchor", "href_document"), F.col("_doc")).when(kind == "reference_text", F.col("_home")).when(kind == "inferred_document", F.col("_inferred")).alias("target_document"),
    )


def project(occ: DataFrame, overlays: DataFrame) -> DataFrame:
    """Effective targets: an overlay decides for unresolved occurrences, else the resolved rule or document.

    ``overlays`` has ``occurrence_id``, ``resolution_kind`` (alias, historical, external), ``resolved_rule_id``.
    """
    j = occ.join(overlays, "occurrence_id", "left")
    kind = F.when(F.col("resolution_kind") == "alias", "rule").when(F.col("resolution_kind") == "historical", "historical_rule").when(F.col("target_rule").isNotNull(), "rule").when(F.col("target_document").isNotNull(), "document").otherwise("unresolved")
    return j.select("occurrence_id", F.col("rule_id").alias("source"), kind.alias("kind"), F.coalesce("resolved_rule_id", "target_rule", "target_document", "cited").alias("target"))


def overlay_violations(occ: DataFrame, overlays: DataFrame) -> DataFrame:
    """The unresolved occurrences and the declared overlays must be the same set."""
    from lexweave.operators.validate import exact_cover

    return exact_cover(overlays.select("occurrence_id"), occ.where("resolution_basis = 'unresolved'").select("occurrence_id"), "occurrence_id", "overlay")


def merge_sources(a: DataFrame, b: DataFrame, key: str = "rule_id", restored: tuple[str, ...] = ()) -> DataFrame:
    """Full outer reconciliation of two record tables: ``side`` is both, left or right; ``problem`` names what isn't
    allowed (left only; right only, unless restored). Order: the left ``pos``; a restored row half a step behind its
    ``after_pos`` when ``b`` has that column."""
    left = a.withColumnsRenamed({c: f"a_{c}" for c in a.columns if c != key})
    right = b.withColumnsRenamed({c: f"b_{c}" for c in b.columns if c != key})
    j = left.join(right, key, "full_outer")
    has_after = F.col("b_after_pos") + 0.5 if "after_pos" in b.columns else F.lit(None).cast("double")
    side = F.when(F.col("a_pos").isNotNull() & F.col("b_pos").isNotNull(), "both").when(F.col("a_pos").isNotNull(), "left").otherwise("right")
    problem = F.when(side == "left", "left only").when((side == "right") & ~F.col(key).isin(*restored), "right only") if restored else F.when(side == "left", "left only").when(side == "right", "right only")
    return j.withColumn("side", side).withColumn("problem", problem).withColumn("order_pos", F.coalesce(F.col("a_pos").cast("double"), has_after))


def correction_targets(selectors: DataFrame, refs: DataFrame, strict: bool = True) -> DataFrame:
    """``overlay_id``, ``rule_id``: rule selectors (only targets, if ``strict``) and references that name a target, a
    conflict or a former name."""
    s = selectors.where((F.col("kind") == "rule") & ((F.col("relation") == "target") if strict else F.lit(True)))
    r = refs.where(F.col("relation").isin("target", "conflicts_with", "renamed_from"))
    return s.select("overlay_id", "rule_id").unionByName(r.select("overlay_id", "rule_id")).distinct()


def plain_text(pages: DataFrame, html_col: str = "html") -> Column:
    return strip_comments(F.col(html_col))
