"""Semantic IR: flattening nested JSON objects to addressable rows, their references, edges, metrics and checks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators.validate import digest_replay, duplicates, membership, must_match, reference_targets
from lexweave.operators.validate import violations as union

#: Top-level arrays of a chunk and the kind of their objects.
KINDS = {"rules": "rule", "decisions": "decision", "definitions": "definition", "mappings": "mapping", "procedures": "procedure", "constraints": "constraint", "tables": "table", "figures": "figure", "examples": "example", "corrections": "correction", "references": "reference", "symbols": "symbol", "exceptions": "exception"}
EXTERNAL = ("external",)


def pointer(path: list) -> str:
    """A JSON pointer, escaped."""
    return "".join("/" + str(p).replace("~", "~0").replace("/", "~1") for p in path)


def resolve_pointer(value, path: str):
    """The value a JSON pointer names; LookupError if there is none."""
    for part in path.split("/")[1:] if path else []:
        part = part.replace("~1", "/").replace("~0", "~")
        value = value[int(part)] if isinstance(value, list) else value[part]
    return value


def _walk(value, path: list, parent: str | None, kind: str | None) -> Iterator[tuple]:
    """(row type, kind, id, path, parent path, clauses, body) of objects with an ``id`` and of references to them."""
    if isinstance(value, dict):
        here = pointer(path)
        if "ref" in value and isinstance(value["ref"], dict) and {"kind", "id"} <= value["ref"].keys():
            r = value["ref"]
            yield "ref", str(r["kind"]), str(r["id"]), here, parent, [str(c) for c in value.get("clause_ids") or []], ""
        if isinstance(value.get("id"), str):
            yield "object", value.get("kind") or kind or "node", value["id"], here, parent, [str(c) for c in value.get("clause_ids") or []], json.dumps(value, sort_keys=True, ensure_ascii=False)
            parent = here
        for k, v in value.items():
            if k == "ref":
                continue
            yield from _walk(v, [*path, k], parent, KINDS.get(k, kind))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from _walk(v, [*path, i], parent, kind)


def flatten(chunks: DataFrame, id_col: str = "chunk_id", json_col: str = "json") -> DataFrame:
    """All addressable objects and references of chunks: ``row`` (object or ref), ``kind``, ``object_id``, ``path``,
    ``parent``, ``clause_ids``, ``body``. Trees of any depth become flat rows early; later steps are joins."""
    names = [id_col, "row", "kind", "object_id", "path", "parent", "clause_ids", "body"]
    kinds = [pa.string()] * 6 + [pa.list_(pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *r) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if t for r in _walk(json.loads(t), [], None, None)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names=names)

    return chunks.select(F.col(id_col).cast("string"), json_col).mapInArrow(run, f"`{id_col}` string, row string, kind string, object_id string, path string, parent string, clause_ids array<string>, body string")


def objects(flat: DataFrame) -> DataFrame:
    return flat.where("row = 'object'").drop("row")


def refs(flat: DataFrame) -> DataFrame:
    return flat.where("row = 'ref'").drop("row", "body").withColumnRenamed("object_id", "ref_id")


def check(flat: DataFrame, clauses: DataFrame | None = None) -> DataFrame:
    """Violations of a flattened corpus: ids used twice, dangling or ambiguous references, clauses that don't exist."""
    o, r = objects(flat), refs(flat)
    checks = [duplicates(o, "kind", "object_id", code="id.duplicate"), duplicates(o, "path", next(c for c in flat.columns if c not in ("row", "kind", "object_id", "path", "parent", "clause_ids", "body")), code="ast.addressability"), reference_targets(r.select("kind", "ref_id"), o, (*EXTERNAL, "clause", "chapter"))]
    if clauses is not None:
        cited = flat.select("path", F.explode("clause_ids").alias("clause_id"))
        checks.append(cited.join(clauses.select("clause_id"), "clause_id", "left_anti").select(F.lit("clause.unknown").alias("code"), "clause_id", F.col("path").alias("detail")).withColumnRenamed("clause_id", "key"))
    return union(*checks)


def coverage(dispositions: DataFrame, clauses: DataFrame) -> DataFrame:
    """Every clause has exactly one disposition."""
    missing = clauses.select("clause_id").join(dispositions.select("clause_id"), "clause_id", "left_anti").select(F.lit("coverage.disposition_missing").alias("code"), F.col("clause_id").alias("key"), F.lit("").alias("detail"))
    return union(missing, duplicates(dispositions, "clause_id", code="coverage.disposition_duplicate"))


def exception_order(exceptions: DataFrame) -> DataFrame:
    """Exceptions of a target must stand by falling specificity, then source order, and none may tie."""
    from pyspark.sql import Window

    w = Window.partitionBy("target").orderBy(F.col("specificity").desc(), "source_order", "exception_id")
    wrong = exceptions.withColumn("_k", F.row_number().over(w)).where(F.col("_k") != F.col("ordinal"))
    return union(wrong.select(F.lit("exception.order").alias("code"), F.col("exception_id").alias("key"), F.concat(F.lit("place "), F.col("ordinal").cast("string"), F.lit(" instead of "), F.col("_k").cast("string")).alias("detail")), duplicates(exceptions, "target", "specificity", "source_order", code="exception.tie"))


def project_edges(references: DataFrame) -> DataFrame:
    """Typed edges from references and exceptions (``pos``, ``from_kind``, ``from_id``, ``relation``, ``to_kind``,
    ``to_id``, ``clause_ids``): one row for each distinct edge, in first-seen order, its clauses in order without repeats."""
    key = ["from_kind", "from_id", "relation", "to_kind", "to_id"]
    g = references.groupBy(*key).agg(F.min("pos").alias("pos"), F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", "clause_ids"))), lambda x: x["clause_ids"]))).alias("clause_ids"))
    return g


def merge_symbols(symbols: DataFrame) -> DataFrame:
    """Symbols by id in first-seen order (``pos``), with ``conflict`` where redeclarations differ."""
    g = symbols.groupBy("symbol_id").agg(F.min_by("body", "pos").alias("body"), F.min("pos").alias("pos"), F.countDistinct("body").alias("_n"))
    return g.select("symbol_id", "body", "pos", (F.col("_n") > 1).alias("conflict"))


def metrics(flat: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Counts of objects by kind and of references, for each chunk and (null) the corpus."""
    kinds = dict.fromkeys(KINDS.values())
    return flat.rollup(chunk).agg(*(F.count_if((F.col("row") == "object") & (F.col("kind") == k)).alias(k) for k in kinds), F.count_if(F.col("row") == "ref").alias("refs"))


def self_hash(body: Column, digest: str) -> Column:
    """The digest that a canonical JSON object should carry: of its text without the field ``digest`` itself."""
    from lexweave.sources.canonical import canonical_without

    return F.upper(F.sha2(canonical_without(body, digest).cast("binary"), 256))


def finalize(chunks: DataFrame, flat: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """Chunks with their metrics and self digest stamped on: ``metrics`` (JSON) and ``chunk_sha256``."""
    m = metrics(flat, chunk).where(F.col(chunk).isNotNull())
    counted = m.select(chunk, F.to_json(F.struct(*[c for c in m.columns if c != chunk])).alias("metrics"))
    return chunks.join(counted, chunk, "left").withColumn("chunk_sha256", self_hash(F.col("json"), "chunk_sha256"))


def assemble(chunks: DataFrame, packets: DataFrame) -> DataFrame:
    """All chunks in packet order with the corpus position; packets without a chunk, and the other way round, are
    violations that ``assembly_violations`` names."""
    return chunks.join(packets.select(F.col("packet_id").alias("chunk_id"), F.col("pos")), "chunk_id").withColumn("pos", F.col("pos"))


def assembly_violations(chunks: DataFrame, packets: DataFrame, flat: DataFrame, members: DataFrame) -> DataFrame:
    from lexweave.operators.validate import exact_cover

    return union(exact_cover(packets.select(F.col("packet_id").alias("chunk_id")), chunks, "chunk_id", "packet"), membership(members, objects(flat)), check(flat), digest_replay(chunks.where(F.col("chunk_sha256").isNotNull()), "chunk_id", F.col("json"), "chunk_sha256", "hash.chunk") if "chunk_sha256" in chunks.columns else must_match(chunks, "chunk_id", F.lit(True), "hash.chunk"))
