"""Rule queries: loading, statistics, lookup, search, activation by facts, and the static rulebook shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexweave.functions.text import normalize_token

LISTS = ("applies_if", "unless", "then", "prefer", "reject", "depends_on", "examples", "tables_or_terms")
CONTEXTS = ("parent", "siblings", "children", "references", "exceptions", "tables")


def _list(df: DataFrame, *paths: str) -> Column:
    """The first of ``paths`` that exists and isn't null, as array<string>; else empty."""
    found = [F.col(p).cast("array<string>") for p in paths if _has(df, p)]
    return F.coalesce(*found, F.array().cast("array<string>"))


def _has(df: DataFrame, path: str) -> bool:
    fields = df.schema
    for name in path.split("."):
        if not hasattr(fields, "fieldNames") or name not in fields.fieldNames():
            return False
        fields = fields[name].dataType
    return True


def normalize_rules(raw: DataFrame, contexts: tuple[str, ...] | None = None) -> DataFrame:
    """Rule records with all fields: conditions fall back to ``logic.*``; ``depends_on`` is the sorted union of the
    declared ids and the lists of ``dependency_context``; missing fields are empty. Needs ``pos`` and ``rule_id``."""
    text = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")) if _has(raw, c) else F.lit("")).alias(c)
    inner = raw.schema["dependency_context"].dataType.fieldNames() if _has(raw, "dependency_context") else []
    deps = [_list(raw, f"dependency_context.{c}") for c in (contexts or inner)]
    return raw.select(
        "pos",
        "rule_id",
        *map(text, ("title", "source_chapter", "source_url", "rule_type", "source_quote", "implementation_status")),
        *(_list(raw, c, f"logic.{c}").alias(c) for c in ("applies_if", "unless", "then", "prefer", "reject")),
        F.array_sort(F.array_distinct(F.concat(_list(raw, "depends_on"), *deps))).alias("depends_on"),
        *(_list(raw, c).alias(c) for c in ("examples", "tables_or_terms")),
    )


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a JSON array file, in file order."""
    raw = spark.read.json(path, multiLine=True)
    return normalize_rules(raw.withColumn("pos", F.monotonically_increasing_id()))


def adapt_edges(edges: DataFrame) -> DataFrame:
    """Edge tables of either naming (``source``/``target`` or ``source_node_id``/``target_node_id``) with ``pos``."""
    names = {"source_node_id": "source", "target_node_id": "target"}
    out = edges.withColumnsRenamed({k: v for k, v in names.items() if k in edges.columns})
    return out if "pos" in out.columns else out.withColumn("pos", F.monotonically_increasing_id())


def stats(rules: DataFrame) -> DataFrame:
    """Counts by chapter and by type in one pass: ``facet``, ``value``, ``n``, by facet and value."""
    pairs = F.explode(F.array(F.struct(F.lit("chapter").alias("facet"), F.col("source_chapter").alias("value")), F.struct(F.lit("rule_type").alias("facet"), F.col("rule_type").alias("value"))))
    return rules.select(pairs.alias("x")).groupBy("x.facet", "x.value").agg(F.count(F.lit(1)).alias("n")).orderBy("facet", "value")


def get(rules: DataFrame, rule_id: str) -> DataFrame:
    """All records of an id, in input order."""
    return rules.where(F.col("rule_id") == rule_id).orderBy("pos")


def haystack() -> Column:
    """The normalised text that ``search`` looks in."""
    lists = F.concat(*(F.col(c) for c in ("applies_if", "then", "prefer", "depends_on")))
    return normalize_token(F.array_join(F.concat(F.array("rule_id", "title", "source_chapter", "rule_type", "source_quote"), lists), " "))


def search(rules: DataFrame, query: str = "", chapter: str | None = None, rule_type: str | None = None, limit: int | None = 20, text: Column | None = None) -> DataFrame:
    """Rules whose normalised text contains the normalised query, equality filters first; in input order, if limited.

    A limit below one still returns one row, as a first match always counts. ``text`` may name a stored haystack.
    """
    out = rules
    if chapter:
        out = out.where(F.col("source_chapter") == chapter)
    if rule_type:
        out = out.where(F.col("rule_type") == rule_type)
    q = normalize_token(F.lit(query or ""))
    out = out.where((q == "") | F.contains(haystack() if text is None else text, q))
    return out if limit is None else out.orderBy("pos").limit(max(limit, 1))


def condition_match(condition: Column, fact: Column) -> Column:
    """Equal, or one contains the other, after normalisation; empty tokens match nothing."""
    return (condition != "") & (fact != "") & (F.contains(condition, fact) | F.contains(fact, condition))


def evaluate(rules: DataFrame, facts: list[str], chapter: str | None = None, rule_type: str | None = None) -> DataFrame:
    """Every rule's state under ``facts``: ``status`` (activated, blocked, inactive), ``condition_score``,
    ``matched_conditions``, ``blocked_by``, and the rule's columns.

    Any matching ``unless`` blocks; a rule is active if it has no ``applies_if`` or one of them matches; the score is
    the number of conditions that match. Facts are a literal list, so no join and no shuffle is needed: each
    condition is tested against them in place.
    """
    tokens = F.array_distinct(F.array(*(normalize_token(F.lit(f)) for f in facts))) if facts else F.array().cast("array<string>")
    hit = lambda c: F.exists(tokens, lambda f: condition_match(normalize_token(c), f))
    out = search(rules, "", chapter, rule_type, None)
    out = out.withColumn("matched_conditions", F.filter("applies_if", hit)).withColumn("blocked_by", F.filter("unless", hit))
    active = (F.size("applies_if") == 0) | (F.size("matched_conditions") > 0)
    return out.withColumn("condition_score", F.size("matched_conditions").cast("long")).withColumn("status", F.when(F.size("blocked_by") > 0, "blocked").when(active, "activated").otherwise("inactive"))


def ranked(evaluated: DataFrame, limit: int = 20) -> DataFrame:
    """The activated rules by (-score, chapter, id, position), at most ``limit``, with their ``rank``.

    Top-k before numbering: only ``limit`` rows meet in one task.
    """
    order = [F.col("condition_score").desc(), "source_chapter", "rule_id", "pos"]
    top = evaluated.where("status = 'activated'").orderBy(*order).limit(max(limit, 0))
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def fact_join(conditions: DataFrame, facts: DataFrame) -> DataFrame:
    """Theta join for fact tables: ``conditions`` (``token``) with each fact (``fact``) that matches; the facts are the
    small side and are broadcast only as far as the planner's size limit allows."""
    return conditions.join(facts, condition_match(F.col("token"), F.col("fact")))


def export(rules: DataFrame) -> DataFrame:
    """One JSON text for each rule."""
    return rules.select("pos", F.to_json(F.struct(*[c for c in rules.columns if c != "pos"])).alias("json"))
