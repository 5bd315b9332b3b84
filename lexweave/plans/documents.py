"""Queries over strict JSON, schemas, corrections, stores and flattened objects, from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import text
from lexweave.operators import clauses, corrections, ir, packets, reconcile, references, rulebook, validate
from lexweave.sources import canonical, schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def canonical_props(spark, sf_dir):
    """Event properties in canonical form: digest and why the stored text isn't it."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", text.sha_upper(canonical.canonical(F.col("props"))).alias("sha256"), canonical.problem(F.col("props")).alias("problem"))


SCHEMA = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 49}}}


def schema_violations(spark, sf_dir):
    """Event properties against a closed schema."""
    return schema.violations(table(spark, sf_dir, "events"), "event_id", "props", SCHEMA).select("code", "key")


def ir_objects(spark, sf_dir):
    """Orders with their lines as nested JSON objects, flattened to addressable objects and references."""
    li = table(spark, sf_dir, "lineitem")
    line = F.struct(F.concat_ws("-", F.lit("line"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.struct(F.struct(F.lit("part").alias("kind"), F.col("l_partkey").cast("string").alias("id")).alias("ref")).alias("of"))
    chunks = li.groupBy(F.col("l_orderkey").cast("string").alias("chunk_id")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(line)).alias("rules"))).alias("json"))
    flat = ir.flatten(chunks)
    return flat.groupBy("chunk_id").agg(F.count_if(F.col("row") == "object").alias("n_objects"), F.count_if(F.col("row") == "ref").alias("n_refs"), F.min("path").alias("first_path"))


def correction_operations(spark, sf_dir):
    """Correction notices written from orders, cut from their pages, dated and parsed into operations."""
    o = table(spark, sf_dir, "orders")
    notice = F.concat(F.lit("P-"), F.col("o_custkey").cast("string"), F.lit(" [corrected "), F.date_format("o_orderdate", "d.M.yyyy"), F.lit("]\nfor "), "o_orderpriority", F.lit("\nread status "), "o_orderstatus", F.lit("\n"))
    pages = o.groupBy(F.col("o_custkey").alias("page")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", notice.alias("n")))), lambda x: x["n"]), "").alias("text"))
    n = corrections.notices(pages)
    ops = corrections.operations(n)
    return ops.select("overlay_id", F.col("ordinal").cast("long").alias("ordinal"), "kind", "before_text", "after_text")


def correction_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    n = o.select(F.col("o_orderkey").cast("string").alias("overlay_id"), F.concat(F.lit("x [modified "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit("; added 1.2.2020]")).alias("header"))
    return corrections.events(n).select("overlay_id", F.col("ordinal").cast("long").alias("ordinal"), "event", F.col("event_date").cast("string").alias("event_date"))


def resolution_cascade(spark, sf_dir):
    """Lines as references: odd ones link to an order, even ones cite a part; open orders and larger parts can be resolved."""
    li = table(spark, sf_dir, "lineitem")
    link = F.col("l_linenumber") % 2 == 1
    occ = li.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("occurrence_id"),
        F.lit("http://h/x/a.html").alias("base_url"),
        F.when(link, F.concat(F.lit("Orders.html#"), F.col("l_orderkey").cast("string"))).alias("href"),
        F.when(~link, F.concat(F.lit("p-9."), F.col("l_partkey").cast("string"))).alias("cited"),
    )
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.lit("O").alias("document_id"), F.concat(F.lit("P-8."), F.col("o_orderkey").cast("string")).alias("rule_id"), F.col("o_orderkey").cast("string").alias("anchor"))
    p = table(spark, sf_dir, "part").where("p_size > 25").select(F.lit("P").alias("document_id"), F.concat(F.lit("P-9."), F.col("p_partkey").cast("string")).alias("rule_id"), F.col("p_partkey").cast("string").alias("anchor"))
    docs = spark.createDataFrame([("O", "orders.html", "P-8"), ("P", "parts.html", "P-9")], "document_id string, file string, major string")
    r = references.resolve(occ, o.unionByName(p), docs)
    return r.groupBy("resolution_basis", "target_document").agg(F.count(F.lit(1)).alias("n"), F.min("target_rule").alias("first_rule"))


def merge_sources(spark, sf_dir):
    """Orders and the orders that lines name, reconciled by a full outer join."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rule_id"), F.col("o_orderkey").alias("pos"))
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("rule_id")).agg(F.min("l_linenumber").alias("pos"))
    return references.merge_sources(o, li).groupBy("side", "problem").agg(F.count(F.lit(1)).alias("n"), F.min("rule_id").alias("first_id"))


def artifact_check(spark, sf_dir):
    """Line spans of documents against an account of them in which every fifth is off by one."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    raw = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("object_id"), F.lit(0).alias("start"), F.char_length("text").alias("end"), "doc_id")
    stated = raw.select("object_id", "start", F.when(F.col("doc_id") % 5 == 0, F.col("end") + 1).otherwise(F.col("end")).alias("end"), F.when(F.col("doc_id") % 2 == 0, "primary").otherwise("aggregate").alias("ownership"), F.lit(None).cast("string").alias("owner"))
    return reconcile.artifact(raw.drop("doc_id"), stated).select("code", "key")


def store_manifest(spark, sf_dir):
    """The manifest of documents sharded by source: rows and bytes."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("document_id"), F.col("doc_id").alias("pos"), F.coalesce("text", F.lit("")).alias("text"))
    return canonical.manifest(d).select("document_id", "rows")


def clause_counters(spark, sf_dir):
    """Clause units of page trees by kind, a row for each page and a total; units cover every visible character once."""
    from lexweave.functions import html

    n = html.node_table(table(spark, sf_dir, "pages"), "page_id", "html")
    return clauses.counters(clauses.clauses(n, "page_id"), "page_id")


def packet_manifest(spark, sf_dir):
    """Orders as rules of their customers: parts of at most four, their rules in order and digests."""
    o = table(spark, sf_dir, "orders")
    r = o.select(F.col("o_custkey").alias("corpus"), F.col("o_orderkey").alias("pos"), F.format_string("C%dX-%d.%d", "o_custkey", F.month("o_orderdate"), "o_orderkey").alias("rule_id"), F.lit("c").alias("chapter"))
    a = packets.assign(r.withColumn("rule_id", F.regexp_replace("rule_id", r"^C([0-9]+)X", "C")), "corpus", 4)
    a = a.withColumn("packet_id", F.concat_ws("/", F.col("corpus").cast("string"), "packet_id"))
    return packets.manifest(a).select("packet_id", "n_rules", "packet_sha256")


def static_rulebook(spark, sf_dir):
    return rulebook.rulebook(spark).select("rule_id", "status", F.array_join(F.transform("priority", lambda x: x.cast("string")), ".").alias("priority"))


def release_gate(spark, sf_dir):
    """A gate of named checks over the tables: each passes if it has no violations."""
    d, lab, o = (table(spark, sf_dir, t) for t in ("documents", "labels", "orders"))
    gate = validate.Gate()
    gate.add("document ids are unique", lambda: validate.duplicates(d, "doc_id"))
    gate.add("labels name documents", lambda: validate.missing(lab, d, "doc_id", "label"))
    gate.add("documents have labels", lambda: validate.missing(d, lab, "doc_id", "label"))
    gate.add("sizes are right", lambda: validate.must_match(d, "doc_id", F.col("n_chars") == F.char_length("text"), "size"))
    gate.add("orders are final", lambda: validate.must_match(o, "o_orderkey", F.col("o_orderstatus") == "F", "status"))
    gate.add("texts are free of controls", lambda: validate.must_match(d, "doc_id", ~text.has_controls(F.col("text")), "control"))
    return gate.report(spark)


QUERIES = {f.__name__: f for f in (canonical_props, schema_violations, ir_objects, correction_operations, correction_dates, resolution_cascade, merge_sources, artifact_check, store_manifest, clause_counters, packet_manifest, static_rulebook, release_gate)}

ORACLES = {
    "canonical_props": r"""SELECT event_id, upper(sha256('{' || chr(10) || '  "k": ' || regexp_extract(props, '"k": *([0-9]+)', 1) || chr(10) || '}' || chr(10))) AS sha256, 'not canonical' AS problem FROM events""",
    "schema_violations": r"""SELECT 'schema.range' AS code, CAST(event_id AS VARCHAR) AS key FROM events WHERE CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) > 49""",
    "ir_objects": "SELECT CAST(l_orderkey AS VARCHAR) AS chunk_id, count(*) AS n_objects, count(*) AS n_refs, '/rules/0' AS first_path FROM lineitem GROUP BY 1",
    "correction_operations": """SELECT format('{}:correction:{:04d}', o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) AS overlay_id, CAST(1 AS BIGINT) AS ordinal, 'replacement' AS kind,
        o_orderpriority AS before_text, 'status ' || o_orderstatus AS after_text FROM orders""",
    "correction_dates": """SELECT CAST(o_orderkey AS VARCHAR) AS overlay_id, CAST(1 AS BIGINT) AS ordinal, 'modified' AS event, strftime(o_orderdate, '%Y-%m-%d') AS event_date FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 2, 'added', '2020-02-01' FROM orders""",
    "resolution_cascade": """WITH l AS (SELECT CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS k, l_orderkey AS o, l_partkey AS p FROM lineitem),
        r AS (SELECT CASE WHEN k = 1 AND o_orderkey IS NOT NULL THEN 'href_anchor' WHEN k = 2 AND p_partkey IS NOT NULL THEN 'reference_text' WHEN k = 2 THEN 'inferred_document' ELSE 'unresolved' END AS resolution_basis,
            CASE WHEN k = 1 AND o_orderkey IS NOT NULL THEN 'O' WHEN k = 2 THEN 'P' END AS target_document,
            CASE WHEN k = 1 AND o_orderkey IS NOT NULL THEN 'P-8.' || o WHEN k = 2 AND p_partkey IS NOT NULL THEN 'P-9.' || p END AS rule
          FROM l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') ON o = o_orderkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 25) ON p = p_partkey)
        SELECT resolution_basis, target_document, count(*) AS n, min(rule) AS first_rule FROM r GROUP BY 1, 2""",
    "merge_sources": """WITH j AS (SELECT o_orderkey, l_orderkey, coalesce(o_orderkey, l_orderkey) AS id FROM orders FULL JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey)
        SELECT CASE WHEN l_orderkey IS NULL THEN 'left' WHEN o_orderkey IS NULL THEN 'right' ELSE 'both' END AS side, CASE WHEN l_orderkey IS NULL THEN 'left only' WHEN o_orderkey IS NULL THEN 'right only' END AS problem,
        count(*) AS n, min(id) AS first_id FROM j GROUP BY 1, 2""",
    "artifact_check": "SELECT 'artifact.span' AS code, 'd' || doc_id AS key FROM documents WHERE doc_id % 5 = 0 AND doc_id % 2 = 0",
    "store_manifest": "SELECT source AS document_id, count(*) AS rows FROM documents GROUP BY source",
    "packet_manifest": """WITH r AS (SELECT o_custkey AS c, o_orderkey AS pos, 'C-' || month(o_orderdate) || '.' || o_orderkey AS id, 'C-' || month(o_orderdate) AS major FROM orders),
        a AS (SELECT *, CASE WHEN major IS NOT DISTINCT FROM lag(major) OVER w THEN 0 ELSE 1 END AS n FROM r WINDOW w AS (PARTITION BY c ORDER BY pos)), b AS (SELECT *, sum(n) OVER (PARTITION BY c ORDER BY pos) AS run FROM a),
        k AS (SELECT *, row_number() OVER (PARTITION BY c, run ORDER BY pos) - 1 AS k FROM b), p AS (SELECT *, dense_rank() OVER (PARTITION BY c, major ORDER BY run, k // 4) AS part FROM k)
        SELECT c || '/' || format('{}-part-{:03d}', major, part) AS packet_id, count(*) AS n_rules, upper(sha256(string_agg(id, chr(10) ORDER BY pos))) AS packet_sha256 FROM p GROUP BY c, major, part""",
    "release_gate": """WITH c AS (
          SELECT 'document ids are unique' AS name, (SELECT count(*) FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)) AS n
          UNION ALL SELECT 'labels name documents', (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
          UNION ALL SELECT 'documents have labels', (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
          UNION ALL SELECT 'sizes are right', (SELECT count(*) FROM documents WHERE coalesce(n_chars <> length(text), true))
          UNION ALL SELECT 'orders are final', (SELECT count(*) FROM orders WHERE coalesce(o_orderstatus <> 'F', true))
          UNION ALL SELECT 'texts are free of controls', (SELECT count(*) FROM documents WHERE coalesce(regexp_matches(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x{9F}]'), true)))
        SELECT name, n = 0 AS passed, n AS n_violations FROM c""",
}
