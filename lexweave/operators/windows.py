"""Order-based operators: islands, as-of lookups, ordinals, spans, neighbours, packets, ranking vectors.

All windows are partitioned by an owner; none sorts a whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordinals(df: DataFrame, owner: str, order: list, tag: str, out: str = "ordinal_id") -> DataFrame:
    """``ordinal`` (from 1) within an owner, and ids such as ``P-1:xref:0001``."""
    n = F.row_number().over(Window.partitionBy(owner).orderBy(*order))
    return df.withColumn("ordinal", n).withColumn(out, F.format_string(f"%s:{tag}:%04d", F.col(owner).cast("string"), F.col("ordinal")))


def islands(df: DataFrame, owner: str, order: list, *keys: str, out: str = "island") -> DataFrame:
    """Numbers (from 1) runs of rows with equal ``keys`` within an owner; nulls equal nulls."""
    w = Window.partitionBy(owner).orderBy(*order)
    changed = F.lit(False)
    for k in keys:
        changed = changed | ~F.col(k).eqNullSafe(F.lag(k).over(w))
    return df.withColumn("_new", (changed | (F.row_number().over(w) == 1)).cast("int")).withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def runs(df: DataFrame, owner: str, order: str, *keys: str) -> DataFrame:
    """Each run's key values with its ``first`` and ``last`` place and ``length``."""
    return islands(df, owner, [order], *keys).groupBy(owner, "island", *keys).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length"))


def previous_where(df: DataFrame, owner: str, order: list, value: Column, condition: Column, out: str, inclusive: bool = False) -> DataFrame:
    """As-of lookup: ``value`` of the nearest row before (or at, if ``inclusive``) that fulfils ``condition``."""
    w = Window.partitionBy(owner).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return df.withColumn(out, F.last(F.when(condition, value), ignorenulls=True).over(w))


def span_ends(df: DataFrame, owner: str, start: str, end_of_owner: Column, out: str = "end") -> DataFrame:
    """Half-open spans: each ends where the next begins, the last at the owner's end."""
    return df.withColumn(out, F.coalesce(F.lead(start).over(Window.partitionBy(owner).orderBy(start)), end_of_owner))


def neighbours(df: DataFrame, owner: str, order: list, key: str, radius: int = 2) -> DataFrame:
    """``before`` and ``after``: the keys of up to ``radius`` rows on either side, in order."""
    w = Window.partitionBy(owner).orderBy(*order)
    out = df.withColumn("before", F.array_compact(F.array(*(F.lag(key, k).over(w) for k in range(radius, 0, -1)))))
    return out.withColumn("after", F.array_compact(F.array(*(F.lead(key, k).over(w) for k in range(1, radius + 1)))))


def packets(df: DataFrame, owner: str, order: list, major: str, size: int = 24) -> DataFrame:
    """Runs of equal ``major`` cut into parts of at most ``size``: ``part`` (from 1 for each owner and major),
    ``place`` (from 0 in the part), ``packet_id`` such as ``A-part-001``."""
    r = islands(df, owner, order, major, out="_run")
    r = r.withColumn("_k", F.row_number().over(Window.partitionBy(owner, "_run").orderBy(*order)) - 1)
    r = r.withColumn("_chunk", F.floor(F.col("_k") / size).cast("int")).withColumn("place", (F.col("_k") % size).cast("int"))
    r = r.withColumn("part", F.dense_rank().over(Window.partitionBy(owner, major).orderBy("_run", "_chunk")))
    return r.withColumn("packet_id", F.format_string("%s-part-%03d", F.col(major).cast("string"), F.col("part"))).drop("_run", "_k", "_chunk")


def best(df: DataFrame, owner: str, *vectors: str, pos: str = "pos") -> DataFrame:
    """Of each owner the row with the least vector of arrays and values, compared place by place (a shorter array that
    is a prefix comes first); the first by ``pos`` on ties. One hash aggregate, no sort."""
    rest = [c for c in df.columns if c != owner]
    return df.groupBy(owner).agg(F.min_by(F.struct(*rest), F.struct(*vectors, pos)).alias("_b")).select(owner, "_b.*")


def chain(df: DataFrame, owner: str, order: list, key: str) -> DataFrame:
    """Stage order: ``ordinal`` from 1 and ``next`` (null at the end)."""
    w = Window.partitionBy(owner).orderBy(*order)
    return df.withColumn("ordinal", F.row_number().over(w)).withColumn("next", F.lead(key).over(w))


def precedence(df: DataFrame, target: str) -> DataFrame:
    """Exceptions of a target by specificity (high first), source order, id: ``rank`` from 1."""
    w = Window.partitionBy(target).orderBy(F.col("specificity").desc(), "source_order", "exception_id")
    return df.withColumn("rank", F.row_number().over(w))


def region(df: DataFrame, value: str, ranges: list[tuple[str, int, int]], out: str = "region") -> DataFrame:
    """Classify by inclusive ranges given as literals (name, low, high); null outside of all."""
    c = F.lit(None).cast("string")
    for name, low, high in reversed(ranges):
        c = F.when(F.col(value).between(low, high), name).otherwise(c)
    return df.withColumn(out, c)


def correction_status(operations: DataFrame) -> DataFrame:
    """Per overlay: deleted if all operations are deletions and one says "this section", replaced if any replaces,
    else applied; ``effective_date`` is the latest."""
    g = operations.groupBy("overlay_id").agg(
        F.every(F.col("kind") == "deletion").alias("_all"),
        F.some(F.lower(F.coalesce("instruction_text", F.lit(""))).contains("this section")).alias("_this"),
        F.some(F.col("kind") == "replacement").alias("_rep"),
        F.max("event_date").alias("effective_date"),
    )
    return g.select("overlay_id", F.when(F.col("_all") & F.col("_this"), "deleted").when(F.col("_rep"), "replaced").otherwise("applied").alias("status"), "effective_date")
