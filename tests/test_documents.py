import json

import pytest
from pyspark.sql import functions as F

from lexweave.operators import reconcile, rulebook, validate
from lexweave.sources import canonical, schema

SCHEMA = {
    "type": "object",
    "required": ["id", "kind"],
    "additionalProperties": False,
    "properties": {
        "id": {"$ref": "#/$defs/id"},
        "kind": {"enum": ["a", "b"]},
        "n": {"type": ["integer", "null"], "minimum": 1},
        "list": {"type": "array", "items": {"$ref": "#/$defs/id"}, "uniqueItems": True, "maxItems": 2},
        "x": {"oneOf": [{"type": "string"}, {"const": 1}]},
    },
    "if": {"properties": {"kind": {"const": "b"}}, "required": ["kind"]},
    "then": {"required": ["n"]},
    "$defs": {"id": {"type": "string", "pattern": "^P-[0-9]+$"}},
}

GOOD = {"id": "P-1", "kind": "a", "n": None, "list": ["P-2"], "x": 1}


def mutated(**change):
    out = {**GOOD, **change}
    return {k: v for k, v in out.items() if v is not ...}


@pytest.mark.parametrize(
    "value,codes",
    [
        (GOOD, []),
        (mutated(id="Q"), ["pattern"]),
        (mutated(id=...), ["required"]),
        (mutated(kind="c"), ["enum"]),
        (mutated(kind="b", n=2), []),
        (mutated(kind="b", n=...), ["required"]),
        (mutated(n=0), ["range"]),
        (mutated(n=True), ["type"]),
        (mutated(list=["P-2", "P-2", 3]), ["type", "size", "uniqueItems"]),
        (mutated(x=True), ["oneOf"]),
        (mutated(more=1), ["additionalProperties"]),
        ([], ["type"]),
    ],
)
def test_one_mutation_one_code(value, codes):
    assert [c for c, _, _ in schema.errors(value, SCHEMA)] == codes


def test_schema_table(spark):
    df = spark.createDataFrame([(1, json.dumps(GOOD)), (2, "{"), (3, json.dumps(mutated(kind="z"))), (4, None)], "k long, json string")
    assert sorted((r.code, r.key) for r in schema.violations(df, "k", "json", SCHEMA).collect()) == [("schema.enum", "3"), ("schema.parse", "2")]
    assert schema.dangling_refs({"a": {"$ref": "#/$defs/no"}, "$defs": {}}) == ["#/$defs/no"] and schema.dangling_refs(SCHEMA) == []
    with pytest.raises(LookupError):
        schema.violations(df, "k", "json", {"$ref": "#/gone"})


def test_artifacts(spark):
    raw = spark.createDataFrame([("a", 0, 5), ("b", 5, 9), ("c", 9, 10)], "object_id string, start int, end int")
    stated = spark.createDataFrame([("a", 0, 5, "primary", None), ("b", 4, 12, "aggregate", None), ("x", 0, 1, "primary", None), ("y", 0, 5, "alias", "a"), ("z", 0, 5, "alias", "gone")], "object_id string, start int, end int, ownership string, owner string")
    assert sorted((r.code, r.key) for r in reconcile.artifact(raw, stated).collect()) == [("artifact.alias", "z"), ("artifact.extra", "x"), ("artifact.missing", "c")]
    moved = stated.withColumn("start", F.when(F.col("object_id") == "a", 1).when(F.col("object_id") == "b", 6).otherwise(F.col("start")))
    assert {"artifact.span", "artifact.containment"} <= {r.code for r in reconcile.artifact(raw, moved).collect()}


def test_repairs_and_occurrences(spark):
    df = spark.createDataFrame([("k1", "bad"), ("k2", "fine")], "k string, v string")
    assert sorted(r.v for r in reconcile.repair(df, "k", "v", {"k1": "good"}).collect()) == ["fine", "good"]
    assert [r.key for r in reconcile.unused_repairs(df, "k", {"k1": "x", "k9": "y"}).collect()] == ["k9"]
    occ = spark.createDataFrame([(0, 5, "P-1", "x"), (0, 5, "P-1", "x"), (5, 9, "P-2", "y"), (5, 9, "P-2", "z")], "start int, end int, target string, body string")
    kept, bad = reconcile.unique_occurrences(occ, ["start", "end", "target"], F.col("body"))
    assert kept.count() == 2 and [r.key for r in bad.collect()] == ["5|9|P-2"]


def test_ranges_and_assets(spark):
    spans = spark.createDataFrame([("d", 0, 10), ("d", 10, 20), ("e", 0, 4)], "o string, start int, end int")
    holes = spark.createDataFrame([("d", 2, 4), ("d", 8, 12)], "o string, start int, end int")
    assert sorted(tuple(r) for r in reconcile.subtract_ranges(spans, holes, "o").collect()) == [("d", 0, 2), ("d", 4, 8), ("d", 12, 20), ("e", 0, 4)]
    a = spark.createDataFrame([("x/changes2.html#a", "ic/ALTER.gif"), ("x/other.html", "alter.gif")], "h string, s string")
    assert [r.y for r in a.select(reconcile.is_correction_asset(F.col("h"), F.col("s")).alias("y")).collect()] == [True, False]
    owned = spark.createDataFrame([("l", 0, 3, "a"), ("l", 3, 5, "b")], "line_id string, start int, end int, owner string")
    assert validate.passed(reconcile.ownership(owned, spark.createDataFrame([("l", 5)], "line_id string, length int")))


def test_effective_targets(spark):
    occ = spark.createDataFrame([("1", "P-1"), ("2", "P-9"), ("3", None)], "occurrence_id string, target_rule string")
    over = spark.createDataFrame([("3", "P-1")], "occurrence_id string, resolved_rule_id string")
    got = reconcile.effective_target(occ, over, spark.createDataFrame([("P-1",)], "rule_id string"))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "P-1", "rule"), ("2", "P-9", "external_or_historical"), ("3", "P-1", "rule")]


def test_rulebook(spark):
    r = rulebook.rulebook(spark)
    assert r.count() == 19 and {x.status for x in r.collect()} == {"partial", "planned"}
    assert r.where("rule_id = 'P-31.1.3.2'").first().priority == [31, 1, 3, 2]
    assert r.where("rule_id = 'P-5'").first().priority == [50]


def test_self_digest(spark):
    from lexweave.operators.ir import self_hash

    body = {"a": 1, "chunk_sha256": "x"}
    got = spark.createDataFrame([(json.dumps(body),)], "j string").select(self_hash(F.col("j"), "chunk_sha256").alias("h")).first().h
    import hashlib

    assert got == hashlib.sha256(canonical.dumps({"a": 1}).encode()).hexdigest().upper()
