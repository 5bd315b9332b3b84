"""Validation as data: every check is a DataFrame of violations (``code``, ``key``, ``detail``); none means valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "code string, key string, detail string"


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def violations(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def passed(checks: DataFrame) -> bool:
    """Whether there are none."""
    return checks.isEmpty()


class ValidationError(ValueError):
    """Raised at an edge by ``require``: builders stop, validators report."""


def require(checks: DataFrame, first: int = 20) -> None:
    """Raise with the first violations by code and key, if there are any."""
    found = checks.orderBy("code", "key", "detail").limit(first).collect()
    if found:
        raise ValidationError("; ".join(f"{r.code} {r.key}: {r.detail}" for r in found))


def duplicates(df: DataFrame, *keys: str, code: str = "id.duplicate") -> DataFrame:
    """Keys that stand in more than one row."""
    key = F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.lit(code).alias("code"), key.alias("key"), F.concat(F.col("_n").cast("string"), F.lit(" rows")).alias("detail"))


def missing(df: DataFrame, other: DataFrame, key: str, code: str) -> DataFrame:
    """Keys of ``df`` without a row in ``other``."""
    return df.select(key).join(other.select(key), key, "left_anti").distinct().select(F.lit(code).alias("code"), F.col(key).cast("string").alias("key"), F.lit("missing").alias("detail"))


def exact_cover(declared: DataFrame, actual: DataFrame, key: str, code: str = "cover") -> DataFrame:
    """Both sides must hold the same keys: ``<code>.missing`` and ``<code>.extra`` by one full outer join."""
    a, b = declared.groupBy(key).agg(F.lit(True).alias("_a")), actual.groupBy(key).agg(F.lit(True).alias("_b"))
    j = a.join(b, key, "full_outer").where("_a is null or _b is null")
    return j.select(F.concat(F.lit(code), F.when(F.col("_b").isNull(), ".missing").otherwise(".extra")).alias("code"), F.col(key).cast("string").alias("key"), F.when(F.col("_b").isNull(), "declared only").otherwise("actual only").alias("detail"))


def multiset_difference(a: DataFrame, b: DataFrame, code: str) -> DataFrame:
    """Rows that one table has more often than the other, each way."""
    say = lambda d, side: d.select(F.lit(f"{code}.{side}").alias("code"), F.to_json(F.struct(*d.columns)).alias("key"), F.lit("").alias("detail"))
    return violations(say(a.exceptAll(b), "left"), say(b.exceptAll(a), "right"))


def same_order(a: DataFrame, b: DataFrame, key: str, pos: str = "pos", code: str = "order") -> DataFrame:
    """Keys whose places differ between two tables with positions."""
    j = a.select(key, F.col(pos).alias("_p")).join(b.select(key, F.col(pos).alias("_q")), key)
    return j.where("_p <> _q").select(F.lit(code).alias("code"), F.col(key).cast("string").alias("key"), F.concat_ws(" <> ", F.col("_p").cast("string"), F.col("_q").cast("string")).alias("detail"))


def partition_gaps(spans: DataFrame, owner: str, length: DataFrame, start: str = "start", end: str = "end", code: str = "span.partition") -> DataFrame:
    """Owners whose spans don't abut from 0 to their length. ``length`` has the owner and ``length``.

    Windows are partitioned by owner; an owner without spans counts if its length isn't 0.
    """
    w = Window.partitionBy(owner).orderBy(start, end)
    s = spans.withColumn("_expected", F.lag(end, 1, 0).over(w))
    bad = s.where(F.col(start) != F.col("_expected")).select(F.col(owner), F.concat(F.lit("starts at "), F.col(start).cast("string"), F.lit(", expected "), F.col("_expected").cast("string")).alias("detail"))
    last = spans.groupBy(owner).agg(F.max(end).alias("_end"))
    tail = length.join(last, owner, "left").where(F.coalesce("_end", F.lit(0)) != F.col("length")).select(owner, F.concat(F.lit("ends at "), F.coalesce("_end", F.lit(0)).cast("string"), F.lit(" of "), F.col("length").cast("string")).alias("detail"))
    return bad.unionByName(tail).select(F.lit(code).alias("code"), F.col(owner).cast("string").alias("key"), "detail")


def reference_targets(refs: DataFrame, objects: DataFrame, external: tuple[str, ...] = ("external",)) -> DataFrame:
    """Each (``kind``, ``ref_id``) of ``refs`` must hit exactly one object of that kind; external kinds always do."""
    n = objects.groupBy("kind", F.col("object_id").alias("ref_id")).agg(F.count(F.lit(1)).alias("_n"))
    j = refs.where(~F.col("kind").isin(*external)).join(n, ["kind", "ref_id"], "left").where(F.coalesce("_n", F.lit(0)) != 1)
    return j.select(F.when(F.col("_n").isNull(), "ref.unresolved").otherwise("ref.ambiguous").alias("code"), F.concat_ws(":", "kind", F.col("ref_id").cast("string")).alias("key"), F.coalesce(F.col("_n").cast("string"), F.lit("0")).alias("detail"))


def membership(members: DataFrame, objects: DataFrame) -> DataFrame:
    """Every object (``kind``, ``object_id``) stands in exactly one record (``record_id`` of ``members``)."""
    n = members.groupBy("kind", "object_id").agg(F.count(F.lit(1)).alias("_n"))
    j = objects.select("kind", "object_id").distinct().join(n, ["kind", "object_id"], "left").where(F.coalesce("_n", F.lit(0)) != 1)
    return j.select(F.lit("record.membership").alias("code"), F.concat_ws(":", "kind", "object_id").alias("key"), F.coalesce(F.col("_n").cast("string"), F.lit("0")).alias("detail"))


def zero_filled(df: DataFrame, kind: str, kinds: list, by: list[str] | None = None) -> DataFrame:
    """Counts over a fixed domain of kinds, one column each, zeros kept; rows of other kinds don't count."""
    wanted = [F.count_if(F.col(kind) == k).alias(str(k)) for k in kinds]
    return df.groupBy(*(by or [])).agg(*wanted)


def pinned(counts: DataFrame, expected: dict[str, int], code: str = "census") -> DataFrame:
    """A one-row table of counters against pinned numbers."""
    rows = counts.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, expected)), F.array(*(F.col(f"`{k}`").cast("long") for k in expected)))).alias("key", "n"))
    want = F.create_map(*(F.lit(x) for kv in expected.items() for x in kv))
    return rows.where(F.col("n") != F.element_at(want, F.col("key"))).select(F.lit(code).alias("code"), "key", F.concat(F.col("n").cast("string"), F.lit(" instead of "), F.element_at(want, F.col("key")).cast("string")).alias("detail"))


def must_match(df: DataFrame, key: str, condition: Column, code: str, detail: str = "") -> DataFrame:
    """Rows for which ``condition`` isn't true (null counts as not)."""
    return df.where(~F.coalesce(condition, F.lit(False))).select(F.lit(code).alias("code"), F.col(key).cast("string").alias("key"), F.lit(detail).alias("detail"))


def digest_replay(df: DataFrame, key: str, content: Column, digest: str, code: str = "hash") -> DataFrame:
    """Rows whose stored upper-case SHA-256 isn't that of their content."""
    return must_match(df, key, F.col(digest) == F.upper(F.sha2(content.cast("binary"), 256)), code, "digest differs")


def first_errors(checks: DataFrame, n: int) -> DataFrame:
    """The first ``n`` violations of each code, by key: evidence for a report, with the count of all."""
    total = checks.groupBy("code").agg(F.count(F.lit(1)).alias("total"))
    w = Window.partitionBy("code").orderBy("key", "detail")
    return checks.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k").join(total, "code")


class Gate:
    """A registry of named checks, each a function that returns violations; the gate opens if all are empty."""

    def __init__(self) -> None:
        self.checks: dict = {}

    def add(self, name: str, check) -> None:
        self.checks[name] = check

    def report(self, spark: SparkSession) -> DataFrame:
        """``name``, ``passed``, ``n_violations`` of every check."""
        rows = [c().agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_violations")) for n, c in self.checks.items()]
        if not rows:
            return spark.createDataFrame([], "name string, passed boolean, n_violations long")
        return reduce(DataFrame.unionByName, rows).select("name", (F.col("n_violations") == 0).alias("passed"), "n_violations")
