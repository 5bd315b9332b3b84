"""Source files: specifications, digests, offline verification, lines of extracted pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators.validate import duplicates, must_match, violations
from lexweave.plans.lineage import shared_dir


def specs(spark: SparkSession, path: str) -> DataFrame:
    """Source specifications from JSON: ``filename``, ``url``, ``sha256``, ``byte_length``."""
    raw = spark.read.json(path, multiLine=True)
    return raw.select("filename", "url", F.upper("sha256").alias("sha256"), F.col("byte_length").cast("long").alias("byte_length"))


def spec_violations(s: DataFrame) -> DataFrame:
    """File names used twice (in any case), unsafe names, digests and sizes that can't be."""
    return violations(
        duplicates(s.withColumn("_f", F.lower("filename")), "_f", code="spec.filename_duplicate"),
        must_match(s, "filename", F.col("filename").rlike(r"^[A-Za-z0-9][A-Za-z0-9._()-]*$") & ~F.contains("filename", F.lit("..")), "spec.filename_unsafe"),
        must_match(s, "filename", F.col("sha256").rlike("^[0-9A-F]{64}$"), "spec.digest"),
        must_match(s, "filename", F.col("byte_length") > 0, "spec.size"),
    )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``filename``, ``sha256``, ``byte_length`` of all files below ``path``; each is read by one task."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.select(F.substring_index("path", "/", -1).alias("filename"), F.upper(F.sha2("content", 256)).alias("sha256"), F.col("length").alias("byte_length"))


def verify(s: DataFrame, found: DataFrame) -> DataFrame:
    """All failures of files against their specifications: missing, digest, length."""
    j = s.join(found.select(F.lower("filename").alias("_f"), F.col("sha256").alias("_s"), F.col("byte_length").alias("_n")), F.lower("filename") == F.col("_f"), "left")
    say = lambda cond, code, detail: j.where(cond).select(F.lit(code).alias("code"), F.col("filename").alias("key"), detail.alias("detail"))
    there = F.col("_f").isNotNull()
    return violations(
        say(~there, "file.missing", F.lit("")),
        say(there & (F.col("sha256") != F.col("_s")), "file.digest", F.col("_s")),
        say(there & (F.col("byte_length") != F.col("_n")), "file.length", F.col("_n").cast("string")),
    )


def commit(df: DataFrame, path: str, check: DataFrame | None = None) -> str:
    """Write to a staging folder beside ``path`` and rename; with ``check``, only if there are no violations.

    An old version is renamed aside first, put back if the new one can't take its place, and deleted last. So ``path``
    never holds a part of a version; between the two renames it is absent for a moment, as a folder can't be swapped.
    Returns ``written``, or raises.
    """
    from lexweave.operators.validate import require

    if check is not None:
        require(check)
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(path).getFileSystem(spark._jsc.hadoopConfiguration())
    tag = uuid.uuid4().hex
    staged, old = jvm(f"{path}.staged-{tag}"), jvm(f"{path}.old-{tag}")
    df.write.parquet(staged.toString())
    aside = fs.exists(jvm(path))
    if aside and not fs.rename(jvm(path), old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, jvm(path)):
        if aside:
            fs.rename(old, jvm(path))
        raise OSError(f"could not rename {staged.toString()}")
    if aside:
        fs.delete(old, True)
    return "written"


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as a table of pages: ``page`` (the file), ``line`` (from 1), ``text``."""
    raw = spark.read.text(path, wholetext=True).select(F.substring_index(F.col("_metadata.file_path"), "/", -1).alias("page"), F.posexplode(F.split("value", r"\r?\n", -1)).alias("i", "text"))
    return raw.select("page", (F.col("i") + 1).alias("line"), "text")


def headings(lines: DataFrame, pattern: str = r"^(P-[0-9]+(?:\.[0-9]+)*)\b", left: float = 100.0) -> DataFrame:
    """Lines that start a rule: the id at the line's start, near the left edge, all its glyphs bold.

    ``lines`` has ``text``, ``x0`` and ``fonts`` (a font name for each character).
    """
    rule = F.regexp_extract("text", pattern, 1)
    bold = F.forall(F.slice("fonts", F.lit(1), F.greatest(F.char_length(rule), F.lit(1))), lambda f: F.lower(f).contains("bold"))
    return lines.withColumn("rule_id", F.when((rule != "") & (F.col("x0") < left) & bold, rule)).withColumn("starts_rule_heading", F.col("rule_id").isNotNull())


def image_roles(objects: DataFrame, placements: DataFrame, masks: DataFrame) -> DataFrame:
    """Image objects with their role: primary if placed, soft_mask or explicit_mask if another uses them so; unknown else."""
    placed = placements.select("object_id").distinct().withColumn("_p", F.lit(True))
    used = masks.groupBy(F.col("mask_id").alias("object_id")).agg(F.min("mask_kind").alias("_m"))
    return objects.join(placed, "object_id", "left").join(used, "object_id", "left").withColumn("role", F.when(F.col("_p"), "primary").otherwise(F.coalesce("_m", F.lit("unknown")))).drop("_p", "_m")


def staging_dir(spark: SparkSession) -> str:
    return shared_dir(spark)
