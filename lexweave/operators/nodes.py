"""Roles of document nodes by what stands around them: captions, list families by peers, table rows and footnotes.

Input is the flat tree of ``functions/html.node_table`` (owner, ``ordinal``, ``parent``, ``path``, ``kind``, ``tag``, ``text``).
Windows are partitioned by owner and parent, so a task sees the children of one node at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.operators.clauses import cue

MARKER = r"^\s*[(\[]?([0-9]{1,3}|[ivxlcdm]{1,6}|[IVXLCDM]{1,6}|[A-Za-z]|[•*·–-])(?:[)\].:]|\s)"


def captions(nodes: DataFrame, owner: str) -> DataFrame:
    """``nodes`` with ``cue`` and, for captions, ``caption_of``: the ordinal of the table or image that follows among
    the same siblings, else of the last one before."""
    w = Window.partitionBy(owner, "parent").orderBy("ordinal")
    figure = F.when(F.col("kind").isin("table", "image"), F.col("ordinal"))
    after = F.first(figure, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    before = F.last(figure, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = nodes.withColumn("cue", cue(F.coalesce("text", F.lit(""))))
    return out.withColumn("_f", F.coalesce(after, before)).withColumn("caption_of", F.when((F.col("cue") == "caption") & F.col("kind").isin("paragraph", "heading", "prose"), F.col("_f"))).drop("_f")


def list_families(nodes: DataFrame, owner: str) -> DataFrame:
    """``nodes`` with ``marker`` and ``family`` of list items. A lone i, v or x may be a letter or a numeral: it counts as
    a numeral if all its peers' markers are numerals, and the list has an i; unmarked items are ``unordered``."""
    w = Window.partitionBy(owner, "parent", "kind")
    m = F.when(F.col("kind") == "list_item", F.regexp_extract("text", MARKER, 1))
    n = nodes.withColumn("marker", F.when(m != "", m))
    peers = F.collect_set("marker").over(w)
    every = lambda pattern: F.forall(peers, lambda x: x.rlike(pattern))
    family = (
        F.when(F.col("marker").isNull(), "unordered")
        .when(F.col("marker").rlike("^[0-9]+$"), "arabic")
        .when(F.col("marker").rlike("^[•*·–-]$"), "bullet")
        .when(every("^[ivxlcdm]+$") & F.array_contains(peers, "i"), "lower_roman")
        .when(every("^[IVXLCDM]+$") & F.array_contains(peers, "I"), "upper_roman")
        .when(F.col("marker").rlike("^[a-z]$"), "lower_alpha")
        .when(F.col("marker").rlike("^[A-Z]$"), "upper_alpha")
        .when(F.col("marker").rlike("^[ivxlcdm]+$"), "lower_roman")
        .otherwise("upper_roman")
    )
    return n.withColumn("family", F.when(F.col("kind") == "list_item", family))


def table_roles(nodes: DataFrame, owner: str) -> DataFrame:
    """Rows of tables: owner, ``row`` (its ordinal), ``table``, ``place`` (from 1), ``role``: header if all cells are
    header cells, empty if none has text, else body."""
    cells = nodes.where("kind = 'table_cell'").groupBy(owner, F.col("parent").alias("row")).agg(F.every(F.col("tag") == "th").alias("_h"), F.some(F.coalesce("text", F.lit("")) != "").alias("_t"), F.count(F.lit(1)).alias("n_cells"))
    r = nodes.where("kind = 'table_row'").select(owner, F.col("ordinal").alias("row"), F.col("parent").alias("table")).join(cells, [owner, "row"], "left")
    place = F.row_number().over(Window.partitionBy(owner, "table").orderBy("row"))
    return r.select(owner, "row", "table", place.alias("place"), F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.when(F.col("_h"), "header").when(~F.coalesce("_t", F.lit(False)), "empty").otherwise("body").alias("role"))


def footnotes(nodes: DataFrame, owner: str) -> DataFrame:
    """Paragraphs that start with a footnote mark and follow a table among the same siblings: owner, ``ordinal``,
    ``table``, ``mark``."""
    w = Window.partitionBy(owner, "parent").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    n = nodes.withColumn("table", F.last(F.when(F.col("kind") == "table", F.col("ordinal")), ignorenulls=True).over(w))
    mark = F.regexp_extract("text", r"^\s*(\*+|†|‡|[a-z]\))", 1)
    return n.where(F.col("kind").isin("paragraph", "prose") & F.col("table").isNotNull() & (mark != "")).select(owner, "ordinal", "table", mark.alias("mark"))
