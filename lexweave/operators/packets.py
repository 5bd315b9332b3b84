"""Work packets: rules in order, cut to parts, each with its context, relations and a digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexweave.operators.graph import parent_rules
from lexweave.operators.windows import packets as cut_packets

SIZE = 24


def assign(rules: DataFrame, corpus: str = "corpus", size: int = SIZE) -> DataFrame:
    """Rules (``corpus``, ``pos``, ``rule_id``, ``chapter``) with ``packet_id``, ``part``, ``place``.

    The major section is the id's first part. Runs are found within a corpus: a corpus is the unit that keeps order.
    """
    major = F.regexp_extract("rule_id", r"^([A-Za-z]+-[0-9]+)", 1)
    return cut_packets(rules.withColumn("major", major), corpus, ["pos"], "major", size)


def context(assigned: DataFrame, edges: DataFrame, corpus: str = "corpus", radius: int = 2) -> DataFrame:
    """What a packet's rules need beside them: ``packet_id``, ``rule_id``, ``reasons`` (sorted): neighbours up to ``radius``
    places away, parents, and rules at either end of their edges; none that the packet itself holds."""
    w = Window.partitionBy(corpus).orderBy("pos")
    near = F.array_compact(F.array(*(f("rule_id", k).over(w) for k in range(1, radius + 1) for f in (F.lag, F.lead))))
    neighbours = assigned.select("packet_id", near.alias("near")).select("packet_id", F.explode("near").alias("rule_id"), F.lit("neighbour").alias("reason"))
    parents = assigned.select("packet_id", F.col("rule_id").alias("_r")).join(parent_rules(assigned).withColumnRenamed("rule_id", "_r"), "_r").select("packet_id", F.col("parent").alias("rule_id"), F.lit("parent").alias("reason"))
    out = assigned.select("packet_id", F.col("rule_id").alias("source")).join(edges, "source").select("packet_id", F.col("target").alias("rule_id"), F.lit("outgoing").alias("reason"))
    into = assigned.select("packet_id", F.col("rule_id").alias("target")).join(edges, "target").select("packet_id", F.col("source").alias("rule_id"), F.lit("incoming").alias("reason"))
    every = neighbours.unionByName(parents).unionByName(out).unionByName(into)
    other = every.join(assigned.select("packet_id", "rule_id"), ["packet_id", "rule_id"], "left_anti")
    return other.groupBy("packet_id", "rule_id").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def relations(assigned: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Edges of packets: a ``hierarchy_parent`` for each rule and grouped ``source_citation`` edges with evidence."""
    parents = assigned.select("packet_id", F.col("rule_id").alias("source")).join(parent_rules(assigned).withColumnRenamed("rule_id", "source"), "source")
    up = parents.select("packet_id", "source", F.lit("hierarchy_parent").alias("relation"), F.col("parent").alias("target"), F.array().cast("array<string>").alias("evidence"), F.lit(1).cast("long").alias("multiplicity"))
    cited = occurrences.join(assigned.select("packet_id", F.col("rule_id").alias("source")), "source")
    g = cited.groupBy("packet_id", "source", "target", "kind").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "occurrence_id"))), lambda x: x["occurrence_id"]).alias("evidence"), F.count(F.lit(1)).alias("multiplicity"))
    return up.unionByName(g.select("packet_id", "source", F.lit("source_citation").alias("relation"), "target", "evidence", "multiplicity"))


def manifest(assigned: DataFrame) -> DataFrame:
    """One row for each packet: its rules in order and the digest of their ids."""
    g = assigned.groupBy("packet_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "rule_id"))), lambda x: x["rule_id"]).alias("rules"))
    return g.select("packet_id", F.size("rules").cast("long").alias("n_rules"), "rules", F.upper(F.sha2(F.array_join("rules", "\n").cast("binary"), 256)).alias("packet_sha256"))


def violations(assigned: DataFrame, rules: DataFrame, size: int = SIZE) -> DataFrame:
    """Every rule in exactly one packet, none larger than ``size``."""
    from lexweave.operators.validate import duplicates, exact_cover
    from lexweave.operators.validate import violations as union

    large = assigned.groupBy("packet_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size).select(F.lit("packet.size").alias("code"), F.col("packet_id").alias("key"), F.col("n").cast("string").alias("detail"))
    return union(exact_cover(rules, assigned, "rule_id", "packet.cover"), duplicates(assigned, "rule_id", code="packet.duplicate"), large)
