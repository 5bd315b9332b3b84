"""Graph and hierarchy operators over edge tables: reachability, components, ancestors, edge building, audits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.plans.lineage import cut, drop

#: Fixed order of target kinds in an edge list.
KIND_ORDER = ("rule", "document", "historical_rule", "unresolved")


def khop(edges: DataFrame, seeds: DataFrame, depth: int, reverse: bool = False) -> DataFrame:
    """Nodes within ``depth`` steps of any seed: ``node``, ``depth`` (the least number of steps).

    ``edges`` has ``source`` and ``target``, ``seeds`` has ``node``. A step joins the new frontier only, and drops nodes met
    before by an anti join. The edges are read once and written by their start; every frontier is written, too, so no
    step runs the ones before it again. Walks of one step need no table.
    """
    a, b = ("target", "source") if reverse else ("source", "target")
    e = edges.select(F.col(a).alias("_from"), F.col(b).alias("node")).where("_from is not null and node is not null")
    frontier = seeds.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0))
    if depth < 1:
        return frontier
    if depth > 1:
        e, _ = cut(e)
    found, met = frontier, 0
    for d in range(1, depth + 1):
        step = frontier.select(F.col("node").alias("_from")).join(e, "_from").select("node").distinct()
        frontier = step.join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(d))
        if d < depth:
            frontier, _ = cut(frontier)
            met = frontier.isEmpty()
        found = found.unionByName(frontier)
        if met:
            break
    return found


def dependencies(edges: DataFrame, rule_id: str, depth: int = 1, reverse: bool = False, mode: str = "bfs") -> DataFrame:
    """Edges met on a walk from ``rule_id``: ``pos``, ``source``, ``target``.

    ``bfs`` returns every edge within ``depth`` steps. ``dfs`` reproduces a depth-first walk that marks an edge (by
    its two ends; of parallel edges the first by ``pos``) when it is first met and never expands it again, even with
    more depth left: its result can be smaller. It runs over the edges that ``bfs`` finds, in one task.
    """
    nodes = khop(edges, edges.sparkSession.createDataFrame([(rule_id,)], "node string"), max(depth - 1, 0), reverse)
    near = edges.join(nodes.select(F.col("node").alias("target" if reverse else "source")), "target" if reverse else "source", "left_semi")
    near = near.groupBy("source", "target").agg(F.min("pos").alias("pos"))
    if depth < 1:
        near = near.limit(0)
    if mode == "bfs":
        return near.select("pos", "source", "target")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        here, there = ("target", "source") if reverse else ("source", "target")
        out: dict[str, list] = {}
        for r in pdf.sort_values("pos").itertuples():
            out.setdefault(getattr(r, here), []).append((r.pos, r.source, r.target, getattr(r, there)))
        seen: set = set()
        rows: list = []
        stack = [(iter(out.get(rule_id, [])), depth)]
        while stack:
            it, left = stack[-1]
            e = next(it, None)
            if e is None or left < 1:
                stack.pop()
                continue
            if e[1:3] not in seen:
                seen.add(e[1:3])
                rows.append((len(rows), e[1], e[2]))
                stack.append((iter(out.get(e[3], [])), left - 1))
        return pd.DataFrame(rows, columns=["pos", "source", "target"])

    return near.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(walk, "pos long, source string, target string")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: ``node``, ``root`` (the least node reachable), one row for each node with an edge.

    Null ends and loops are ignored. Alternating large-star and small-star rounds until nothing changes (as many as the
    logarithm of the largest component); each is joins and aggregates, written to the shared folder; two numbers a round
    reach the driver. A small star joins only nodes with several neighbours below them.
    """
    spark = edges.sparkSession
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e, path = cut(e)
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, least_path = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).select(F.col("u").alias("v"), "m"))
        large = e.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = large.join(low.where("n > 1").select("u", "m"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, new_path = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        drop(spark, path)
        drop(spark, least_path)
        now, e, path = _mark(new), new, new_path
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def ancestors(segments: Column, sep: str = ".") -> Column:
    """All proper prefixes of an id given as its segments, nearest first."""
    n = F.size(segments)
    return F.when(n > 1, F.transform(F.sequence(n - 1, F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(segments, F.lit(1), k), sep))).otherwise(F.array().cast("array<string>"))


def parent_rules(rules: DataFrame) -> DataFrame:
    """``rule_id``, ``parent``: the id without its last segment if that is a rule, else ``chapter:`` and the chapter.

    It doesn't climb further. ``rules`` has ``rule_id`` and ``chapter``.
    """
    ids = rules.select(F.col("rule_id").alias("parent")).distinct()
    want = rules.select("rule_id", "chapter", F.when(F.contains("rule_id", F.lit(".")), F.regexp_replace("rule_id", r"\.[^.]*$", "")).alias("near"))
    met = want.join(ids, want["near"] == ids["parent"], "left")
    return met.select("rule_id", F.coalesce("parent", F.concat(F.lit("chapter:"), F.col("chapter"))).alias("parent"))


def _kind_rank(kind: Column) -> Column:
    out = F.lit(len(KIND_ORDER))
    for i, k in enumerate(KIND_ORDER):
        out = F.when(kind == k, i).otherwise(out)
    return out


def edge_id(source: Column, kind: Column, target: Column) -> Column:
    """``edge:`` and the digest of the edge's canonical key."""
    quoted = lambda c: F.to_json(F.struct(c.alias("x")))  # noqa: E731  {"x":"..."}: the value escaped as JSON
    value = lambda c: F.substring(quoted(c), F.lit(6), F.char_length(quoted(c)) - 6)
    text = F.concat(F.lit('{\n  "source_node_id": '), value(source), F.lit(',\n  "target_kind": '), value(kind), F.lit(',\n  "target_node_id": '), value(target), F.lit("\n}\n"))
    return F.concat(F.lit("edge:"), F.upper(F.sha2(text.cast("binary"), 256)))


def aggregate_edges(occurrences: DataFrame) -> DataFrame:
    """Edges with evidence from ``occurrence_id``, ``source``, ``target``, ``kind``: ``edge_id``, the key,
    ``multiplicity``, ``evidence`` (sorted ids). For order use ``edge_order``."""
    g = occurrences.groupBy("source", "kind", "target").agg(F.count(F.lit(1)).alias("multiplicity"), F.array_sort(F.collect_list("occurrence_id")).alias("evidence"))
    return g.select(edge_id(F.col("source"), F.col("kind"), F.col("target")).alias("edge_id"), "source", "kind", "target", "multiplicity", "evidence")


def edge_order() -> list[Column]:
    return [F.col("source"), _kind_rank(F.col("kind")), F.col("target")]


def node_roles(edges: DataFrame) -> DataFrame:
    """``node``, ``kind``, ``roles``: of ``source`` and ``target`` those it plays, in that order."""
    u = edges.select(F.col("source").alias("node"), F.lit("rule").alias("kind"), F.lit("source").alias("role")).unionByName(edges.select(F.col("target").alias("node"), "kind", F.lit("target").alias("role")))
    g = u.groupBy("node").agg(F.min_by("kind", _kind_rank(F.col("kind"))).alias("kind"), F.collect_set("role").alias("r"))
    return g.select("node", "kind", F.filter(F.array(F.lit("source"), F.lit("target")), lambda x: F.array_contains(F.col("r"), x)).alias("roles"))


def audit(edges: DataFrame, nodes: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Violations ``code``, ``key``, ``detail`` of a dependency graph against its occurrences."""
    from lexweave.operators.validate import duplicates, violations

    ends = edges.select(F.explode(F.array("source", "target")).alias("node"))
    evidence = edges.select(F.explode("evidence").alias("occurrence_id"))
    known = occurrences.select("occurrence_id")
    replay = edges.where(F.col("edge_id") != edge_id(F.col("source"), F.col("kind"), F.col("target")))
    return violations(
        duplicates(edges, "edge_id", code="edge.duplicate"),
        duplicates(nodes, "node", code="node.duplicate"),
        ends.join(nodes.select("node"), "node", "left_anti").distinct().select(F.lit("edge.endpoint").alias("code"), F.col("node").alias("key"), F.lit("no such node").alias("detail")),
        replay.select(F.lit("edge.identity").alias("code"), F.col("edge_id").alias("key"), F.lit("not the digest of its key").alias("detail")),
        evidence.exceptAll(known).select(F.lit("evidence.extra").alias("code"), F.col("occurrence_id").alias("key"), F.lit("not an occurrence, or cited twice").alias("detail")),
        known.exceptAll(evidence).select(F.lit("evidence.missing").alias("code"), F.col("occurrence_id").alias("key"), F.lit("cited by no edge").alias("detail")),
        edges.where(F.col("multiplicity") != F.size("evidence")).select(F.lit("edge.multiplicity").alias("code"), F.col("edge_id").alias("key"), F.col("multiplicity").cast("string").alias("detail")),
    )
