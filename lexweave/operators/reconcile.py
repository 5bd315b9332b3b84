"""Reconciling two accounts of the same things: physical records, repairs from literal tables, repeated occurrences,
correction assets, ownership of characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators.validate import violations as union


def artifact(raw: DataFrame, stated: DataFrame) -> DataFrame:
    """Physical records against an artifact's: the same ids; equal spans where the artifact claims primary ownership,
    contained spans where it aggregates; aliases name an owner that is there.

    ``raw`` has ``object_id``, ``start``, ``end``; ``stated`` also ``ownership`` (primary, aggregate, alias) and ``owner``.
    """
    s = stated.select("object_id", F.col("start").alias("_s"), F.col("end").alias("_e"), "ownership", "owner")
    j = raw.join(s, "object_id", "full_outer")
    say = lambda df, code, detail: df.select(F.lit(code).alias("code"), F.col("object_id").alias("key"), detail.alias("detail"))
    place = F.concat_ws("..", F.col("_s").cast("string"), F.col("_e").cast("string"))
    both = j.where(F.col("ownership").isNotNull() & F.col("start").isNotNull())
    owners = raw.select(F.col("object_id").alias("owner"))
    return union(
        say(j.where(F.col("ownership").isNull()), "artifact.missing", F.lit("")),
        say(j.where(F.col("start").isNull() & (F.col("ownership") != "alias")), "artifact.extra", F.lit("")),
        say(both.where((F.col("ownership") == "primary") & ((F.col("start") != F.col("_s")) | (F.col("end") != F.col("_e")))), "artifact.span", place),
        say(both.where((F.col("ownership") == "aggregate") & ((F.col("start") < F.col("_s")) | (F.col("end") > F.col("_e")))), "artifact.containment", place),
        say(s.where("ownership = 'alias'").join(owners, "owner", "left_anti"), "artifact.alias", F.col("owner")),
    )


def repair(df: DataFrame, key: str, column: str, repairs: dict) -> DataFrame:
    """Known faults put right by a literal table: ``column`` of the rows with those keys. The table is part of the plan, so
    no join is needed; ``unused_repairs`` tells which keys met no row."""
    out = F.col(column)
    for k, v in repairs.items():
        out = F.when(F.col(key) == F.lit(k), F.lit(v)).otherwise(out)
    return df.withColumn(column, out)


def unused_repairs(df: DataFrame, key: str, repairs: dict) -> DataFrame:
    spark = df.sparkSession
    declared = spark.createDataFrame([(k,) for k in repairs], f"`{key}` {dict(df.dtypes)[key]}")
    return declared.join(df.select(key), key, "left_anti").select(F.lit("repair.unused").alias("code"), F.col(key).cast("string").alias("key"), F.lit("").alias("detail"))


def unique_occurrences(df: DataFrame, key: list[str], body: Column) -> tuple[DataFrame, DataFrame]:
    """Occurrences of a key once each, and the keys whose repeats differ (violations). Order by the key columns."""
    g = df.groupBy(*key).agg(F.count_distinct(body).alias("_n"), F.min(F.struct(*[c for c in df.columns if c not in key])).alias("_r"))
    bad = g.where("_n > 1").select(F.lit("occurrence.conflict").alias("code"), F.concat_ws("|", *(F.col(k).cast("string") for k in key)).alias("key"), F.concat(F.col("_n").cast("string"), F.lit(" variants")).alias("detail"))
    return g.select(*key, "_r.*"), bad


def is_correction_asset(href: Column, src: Column) -> Column:
    """Whether a link and its icon mark a correction: both paths, without query and fragment, end as those do."""
    path = lambda c: F.lower(F.substring_index(F.substring_index(c, "#", 1), "?", 1))
    return path(href).rlike(r"(?:^|/)changes2?\.html$") & path(src).rlike(r"(?:^|/)alter\.gif$")


def effective_target(occ: DataFrame, overlays: DataFrame, active: DataFrame) -> DataFrame:
    """``occurrence_id``, ``target``, ``target_kind``: an overlay's rule wins; a rule in the corpus is ``rule``, any
    other target ``external_or_historical``."""
    ids = active.select(F.col("rule_id").alias("target"), F.lit(True).alias("_a")).distinct()
    j = occ.join(overlays.select("occurrence_id", "resolved_rule_id"), "occurrence_id", "left").withColumn("target", F.coalesce("resolved_rule_id", "target_rule"))
    return j.join(ids, "target", "left").select("occurrence_id", "target", F.when(F.col("_a"), "rule").otherwise("external_or_historical").alias("target_kind"))


def ownership(claims: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every character of a line has exactly one owner: claims (``line_id``, ``start``, ``end``, ``owner``) partition it."""
    from lexweave.operators.validate import partition_gaps

    return partition_gaps(claims, "line_id", lengths, code="ownership")


def subtract_ranges(spans: DataFrame, holes: DataFrame, owner: str) -> DataFrame:
    """What is left of spans when the ranges of ``holes`` (same owner, apart from each other) are cut out.

    Holes are gathered for each span, as many as overlap it; the rest is arithmetic on neighbours.
    """
    h = holes.select(F.col(owner), F.col("start").alias("_s"), F.col("end").alias("_e"))
    j = spans.withColumn("_k", F.monotonically_increasing_id()).join(h, owner, "left")
    over = (F.col("_s") < F.col("end")) & (F.col("start") < F.col("_e"))
    g = j.groupBy("_k", owner, "start", "end").agg(F.sort_array(F.collect_list(F.when(over, F.struct("_s", "_e")))).alias("h"))
    begins = F.concat(F.array("start"), F.transform("h", lambda x: x["_e"]))
    ends = F.concat(F.transform("h", lambda x: x["_s"]), F.array("end"))
    parts = F.filter(F.arrays_zip(begins.alias("start"), ends.alias("end")), lambda x: x["start"] < x["end"])
    return g.select(owner, F.explode(parts).alias("x")).select(owner, "x.start", "x.end")
