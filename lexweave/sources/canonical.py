"""Canonical JSON: strict reading, byte-exact writing, digests, and a store of shards with a manifest."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A shard must stay below this many bytes.
SHARD_LIMIT = 100_000_000


def dumps(value) -> str:
    """Sorted keys, two spaces, no ASCII escapes, no NaN, a line feed at the end."""
    return json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def loads(text: str):
    """Strict parsing: no repeated keys, no NaN or Infinity."""

    def pairs(items: list) -> dict:
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("repeated key")
        return out

    def constant(name: str):
        raise ValueError(f"{name} is no JSON")

    return json.loads(text, object_pairs_hook=pairs, parse_constant=constant)


def _texts(f):
    @F.arrow_udf("string")
    def of(a: pa.Array) -> pa.Array:
        return pa.array([None if x is None else f(x) for x in a.to_pylist()], pa.string())

    return of


def canonical(c: Column) -> Column:
    """A JSON text in canonical form."""
    return _texts(lambda x: dumps(json.loads(x)))(c)


def canonical_without(c: Column, field: str) -> Column:
    """The canonical form of an object without one of its fields."""

    def one(x: str) -> str:
        v = json.loads(x)
        v.pop(field, None)
        return dumps(v)

    return _texts(one)(c)


def problem(c: Column) -> Column:
    """Why a text isn't strict canonical JSON: null if it is."""

    def one(x: str) -> str | None:
        try:
            return None if dumps(loads(x)) == x else "not canonical"
        except ValueError as e:
            return f"invalid: {e}"

    return _texts(one)(c)


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files: ``path``, ``value``, ``problem`` (null for strict canonical ones)."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.withColumn("problem", problem(F.col("value")))


def write_canonical(df: DataFrame, path: str) -> None:
    """One canonical JSON text a row, as text files."""
    df.select(canonical(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("value")).write.mode("overwrite").text(path, lineSep="")


def write_store(nodes: DataFrame, path: str, document: str = "document_id", order: str = "pos") -> DataFrame:
    """A table by document as Parquet, and its manifest: ``document_id``, ``rows``, ``bytes``, ``sha256``.

    The digest covers the documents' canonical rows in order; it is a digest of row digests, so no document
    has to stand in one task as text.
    """
    spark = nodes.sparkSession
    nodes.repartition(document).sortWithinPartitions(document, order).write.mode("overwrite").partitionBy(document).parquet(f"{path}/nodes")
    m = manifest(spark.read.parquet(f"{path}/nodes"), document, order)
    m.write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def manifest(nodes: DataFrame, document: str = "document_id", order: str = "pos") -> DataFrame:
    body = F.to_json(F.struct(*sorted(c for c in nodes.columns if c != document)), {"ignoreNullFields": "false"})
    rows = nodes.select(F.col(document).cast("string").alias(document), F.col(order).alias("_o"), F.sha2(body.cast("binary"), 256).alias("h"), F.octet_length(body).alias("b"))
    g = rows.groupBy(document).agg(F.count(F.lit(1)).alias("rows"), F.sum("b").alias("bytes"), F.sort_array(F.collect_list(F.struct("_o", "h"))).alias("x"))
    return g.select(document, "rows", "bytes", F.upper(F.sha2(F.array_join(F.transform("x", lambda r: r["h"]), "").cast("binary"), 256)).alias("sha256"))


def read_store(spark: SparkSession, path: str, documents: list[str] | None = None, document: str = "document_id") -> DataFrame:
    """The nodes of all or some documents; others' files are not opened."""
    out = spark.read.parquet(f"{path}/nodes")
    return out if documents is None else out.where(F.col(document).isin(*documents))


def verify_store(spark: SparkSession, path: str, document: str = "document_id", order: str = "pos", limit: int = SHARD_LIMIT) -> DataFrame:
    """Violations: documents of one side only, other digests or row counts, shards over the limit."""
    from lexweave.operators.validate import exact_cover, violations

    said = spark.read.parquet(f"{path}/manifest")
    now = manifest(spark.read.parquet(f"{path}/nodes"), document, order)
    j = said.join(now.select(document, F.col("sha256").alias("_s"), F.col("rows").alias("_r")), document)
    bad = j.where("sha256 <> _s or rows <> _r").select(F.lit("shard.digest").alias("code"), F.col(document).alias("key"), F.concat_ws(" rows, ", F.col("rows").cast("string"), F.col("_r").cast("string")).alias("detail"))
    large = said.where(F.col("bytes") >= limit).select(F.lit("shard.size").alias("code"), F.col(document).alias("key"), F.col("bytes").cast("string").alias("detail"))
    return violations(exact_cover(said, now, document, "shard"), bad, large)
