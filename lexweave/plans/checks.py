"""Queries over files, overlays, projections, repairs, positions, packets and stores, from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import text
from lexweave.operators import clauses, graph, ir, packets, reconcile, references, validate, windows
from lexweave.plans.lineage import shared_dir
from lexweave.sources import canonical, files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(prefix: str, *columns: str):
    return F.concat(F.lit(prefix), F.concat_ws(":", *(F.col(c).cast("string") for c in columns)))


def file_verify(spark, sf_dir):
    """Documents as specified files, held against those that have a label, their texts without white space at the ends."""
    d = table(spark, sf_dir, "documents").select(key("d", "doc_id").alias("filename"), "doc_id", F.coalesce("text", F.lit("")).alias("t"))
    told = d.select("filename", F.lit("").alias("url"), text.sha_upper(F.col("t")).alias("sha256"), F.octet_length("t").cast("long").alias("byte_length"))
    there = d.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi").withColumn("t", F.regexp_replace("t", r"[.]$", ""))
    found = there.select("filename", text.sha_upper(F.col("t")).alias("sha256"), F.octet_length("t").cast("long").alias("byte_length"))
    return files.verify(told, found).select("code", "key")


def overlay_cover(spark, sf_dir):
    """Pending orders as unresolved occurrences, urgent ones as declared overlays: they should be the same set."""
    o = table(spark, sf_dir, "orders").select(key("o", "o_orderkey").alias("occurrence_id"), F.when(F.col("o_orderstatus") == "P", "unresolved").otherwise("href_anchor").alias("resolution_basis"), "o_orderpriority")
    return references.overlay_violations(o, o.where("o_orderpriority = '1-URGENT'")).select("code", "key")


def _occurrences(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as occurrences that name a rule (final), a document (open) or nothing; overlays for two priorities."""
    o = table(spark, sf_dir, "orders")
    final = F.col("o_orderstatus") == "F"
    occ = o.select(
        key("o", "o_orderkey").alias("occurrence_id"),
        key("C", "o_custkey").alias("rule_id"),
        F.when(final, key("R", "o_custkey")).alias("target_rule"),
        F.when(F.col("o_orderstatus") == "O", "D").alias("target_document"),
        F.col("o_orderpriority").alias("cited"),
    )
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "alias").when(F.col("o_orderpriority") == "2-HIGH", "historical")
    over = o.where(kind.isNotNull() & ~final).select(key("o", "o_orderkey").alias("occurrence_id"), kind.alias("resolution_kind"), key("X", "o_custkey").alias("resolved_rule_id"))
    return occ, over


def occurrence_projection(spark, sf_dir):
    return references.project(*_occurrences(spark, sf_dir))


def effective_targets(spark, sf_dir):
    """Targets of orders, an overlay's first; customers of one market segment are the rules in force."""
    occ, over = _occurrences(spark, sf_dir)
    active = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.explode(F.array(key("R", "c_custkey"), key("X", "c_custkey"))).alias("rule_id"))
    return reconcile.effective_target(occ, over, active)


def correction_targets(spark, sf_dir):
    """Rules that an order's notice is about: its customer, and the parts of its returned lines."""
    s = table(spark, sf_dir, "orders").select(key("o", "o_orderkey").alias("overlay_id"), F.lit("rule").alias("kind"), key("C", "o_custkey").alias("rule_id"), F.when(F.col("o_orderstatus") == "F", "target").otherwise("mentions").alias("relation"))
    relation = F.when(F.col("l_returnflag") == "R", "conflicts_with").when(F.col("l_returnflag") == "A", "renamed_from").otherwise("see")
    r = table(spark, sf_dir, "lineitem").select(key("o", "l_orderkey").alias("overlay_id"), key("P", "l_partkey").alias("rule_id"), relation.alias("relation"))
    return references.correction_targets(s, r)


def record_membership(spark, sf_dir):
    """Parts as objects, lines as records: parts that no order or several have."""
    members = table(spark, sf_dir, "lineitem").select(key("o", "l_orderkey").alias("record_id"), F.lit("part").alias("kind"), F.col("l_partkey").cast("string").alias("object_id"))
    objects = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("object_id"))
    return validate.membership(members, objects)


def packet_relations(spark, sf_dir):
    """Hierarchy and citation edges of customers' packets, orders as rules and their lines as citations of parts."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("corpus"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("P-"), F.month("o_orderdate").cast("string"), F.lit("."), F.col("o_orderkey").cast("string")).alias("rule_id"), F.lit("c").alias("chapter"), key("", "o_custkey").alias("packet_id"))
    li = table(spark, sf_dir, "lineitem").join(o.select(F.col("pos").alias("l_orderkey"), F.col("rule_id").alias("source")), "l_orderkey")
    cited = li.select("source", key("p", "l_partkey").alias("target"), F.lit("part").alias("kind"), F.col("l_linenumber").alias("pos"), key("", "l_linenumber", "l_suppkey", "l_quantity").alias("occurrence_id"))
    r = packets.relations(o, cited)
    return r.select("packet_id", "source", "relation", "target", F.array_join("evidence", ",").alias("evidence"), "multiplicity")


def packet_input_check(spark, sf_dir):
    """Orders dealt to their customers as packets, against the orders that have lines: cover, repeats, size."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("rule_id"), key("c", "o_custkey").alias("packet_id"))
    rules = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("rule_id")).distinct()
    return packets.violations(a, rules, 12).select("code", "key")


def typed_edges(spark, sf_dir):
    """Typed edges from orders to parts, each once, with the line numbers that state it in order."""
    li = table(spark, sf_dir, "lineitem")
    e = li.select(F.col("l_linenumber").alias("pos"), F.lit("order").alias("from_kind"), F.col("l_orderkey").alias("from_id"), F.col("l_returnflag").alias("relation"), F.lit("part").alias("to_kind"), F.col("l_partkey").alias("to_id"), F.array("l_linenumber").alias("clause_ids"))
    return ir.project_edges(e).select("from_id", "relation", "to_id", F.col("pos").cast("long").alias("pos"), F.array_join(F.transform("clause_ids", lambda x: x.cast("string")), ",").alias("clauses"))


def occurrence_conflicts(spark, sf_dir):
    """Pairs of order and part that stand in several lines with different quantities."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    return reconcile.unique_occurrences(li, ["l_orderkey", "l_partkey"], F.col("q"))[1].select("code", "key", "detail")


def correction_state(spark, sf_dir):
    """Status and date of orders as notices, their lines as operations."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "R", "deletion").when(F.col("l_returnflag") == "A", "replacement").otherwise("addition")
    ops = li.select(key("o", "l_orderkey").alias("overlay_id"), kind.alias("kind"), F.when(F.col("l_linenumber") == 1, "Delete This Section").alias("instruction_text"), F.col("l_shipdate").alias("event_date"))
    return windows.correction_status(ops).select("overlay_id", "status", F.col("effective_date").cast("date").cast("string").alias("effective_date"))


def first_evidence(spark, sf_dir):
    """The first three violations of each check over orders and documents, with the count of all."""
    o, d = table(spark, sf_dir, "orders"), table(spark, sf_dir, "documents")
    every = validate.violations(validate.must_match(o, "o_orderkey", F.col("o_orderstatus") == "F", "status"), validate.must_match(o, "o_orderkey", F.col("o_orderpriority") != "1-URGENT", "urgent"), validate.must_match(d, "doc_id", F.col("n_chars") > 300, "short"))
    return validate.first_errors(every, 3).select("code", "key", "total")


def correction_assets(spark, sf_dir):
    """Links to correction lists by the icon beside them, written from parts in several spellings."""
    p = table(spark, sf_dir, "part")
    at = lambda c, *v: F.element_at(F.array(*map(F.lit, v)), (c % len(v) + 1).cast("int"))
    href = at(F.col("p_partkey"), "x/Changes.html", "changes2.html?a=1#b", "changes3.html", "mychanges.html", "/a/CHANGES2.HTML")
    src = at(F.col("p_size"), "img/alter.gif", "ALTER.GIF?1", "alter.gif.png")
    return p.select("p_partkey", reconcile.is_correction_asset(href, src).alias("is_asset"))


def span_positions(spark, sf_dir):
    """The place behind each document's first line: its line, the start of that, its byte offset, and the rest read back."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "t", (F.instr("t", "\n")).alias("at"))
    return d.select(
        "doc_id",
        text.line_number(F.col("t"), F.col("at")).cast("long").alias("line"),
        text.line_start(F.col("t"), F.col("at")).cast("long").alias("line_start"),
        text.byte_offset(F.col("t"), F.col("at")).cast("long").alias("byte_offset"),
        text.sha_upper(text.span_text(F.col("t"), F.col("at"), F.char_length("t"))).alias("rest_sha256"),
        F.char_length(text.byte_view(F.encode("t", "UTF-8"))).cast("long").alias("n_bytes"),
    )


def compact_text(spark, sf_dir):
    """Texts with white space folded, and cleaned line by line: sizes and digests."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    return d.select("doc_id", text.sha_upper(text.compact(F.col("t"))).alias("compact_sha256"), text.sha_upper(text.clean(F.col("t"), True)).alias("clean_sha256"))


def forbidden_markers(spark, sf_dir):
    """Placeholders that texts still hold."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    return d.select("doc_id", F.array_join(text.markers(F.col("t"), "License|password|token|TODO"), ",").alias("markers"))


def rule_ids(spark, sf_dir):
    """Rule ids in one spelling: upper case but for a suffix in parentheses."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", text.canonical_rule_id(F.concat(F.lit("p-"), F.col("p_partkey").cast("string"), F.lit(".a"), F.when(F.col("p_size") > 25, "(bC)").otherwise(""))).alias("rule_id"))


def line_cues(spark, sf_dir):
    """What lines announce, and the family of the marker they begin with, written from lines of orders."""
    li = table(spark, sf_dir, "lineitem")
    pick = lambda c, *v: F.element_at(F.array(*map(F.lit, v)), (c.cast("int") % len(v)) + 1)
    said = pick(F.col("l_linenumber"), "Table 3a of", "Fig. 2 shows", "Note: that", "Notes 1", "Examples:", "the following:", "plain text")
    mark = pick(F.col("l_suppkey"), "(1)", "iv.", "B)", "[a]", "•", "XII", "ab")
    return li.groupBy(clauses.cue(said).alias("cue"), clauses.list_family(mark).alias("family")).agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_order"))


def reassembled_turns(spark, sf_dir):
    """Conversations put together again from their turns."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "role").alias("pos"), F.concat_ws(": ", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("said"))
    return clauses.reassemble(c, "conv_id", "pos", "said").select("conv_id", text.sha_upper(F.col("text")).alias("sha256"))


def graph_audit(spark, sf_dir):
    """A citation graph whose nodes and occurrences fall short of its edges: every fault by name."""
    li = table(spark, sf_dir, "lineitem")
    occ = li.select(key("", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("occurrence_id"), key("o", "l_orderkey").alias("source"), key("p", "l_partkey").alias("target"), F.lit("rule").alias("kind"), "l_returnflag").dropDuplicates(["occurrence_id"])
    edges = graph.aggregate_edges(occ)
    nodes = table(spark, sf_dir, "orders").select(key("o", "o_orderkey").alias("node")).unionByName(table(spark, sf_dir, "part").where("p_size > 10").select(key("p", "p_partkey").alias("node")))
    return graph.audit(edges, nodes, occ.where("l_returnflag <> 'A'")).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))


REPAIRS = {1: "one", 2: "two", 5: "five", -7: "none"}


def known_repairs(spark, sf_dir):
    """Names of parts put right by a literal table, and entries of the table that met no row."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    done = reconcile.repair(p, "p_partkey", "p_name", REPAIRS).select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("value"))
    return done.unionByName(reconcile.unused_repairs(p, "p_partkey", REPAIRS).select("key", F.col("code").alias("value")))


def left_over_spans(spark, sf_dir):
    """What is left of a document's characters when lines with a label's spans are cut out: a hole from 10 to 20 and one to the end from 300."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n"))
    whole = d.where("n > 0").select("doc_id", F.lit(0).alias("start"), F.col("n").alias("end"))
    holes = d.where("n > 20").select("doc_id", F.lit(10).alias("start"), F.lit(20).alias("end")).unionByName(d.where("n > 300").select("doc_id", F.lit(300).alias("start"), F.col("n").alias("end")))
    left = reconcile.subtract_ranges(whole, holes, "doc_id")
    return left.select("doc_id", F.col("start").cast("long").alias("from_char"), F.col("end").cast("long").alias("to_char"))


def store_round_trip(spark, sf_dir):
    """Documents written to a sharded store and read back: rows and characters of each shard, and the violations found."""
    import uuid

    path = f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("document_id"), F.col("doc_id").alias("pos"), F.coalesce("text", F.lit("")).alias("text"))
    canonical.write_store(d, path)
    back = canonical.read_store(spark, path).groupBy(F.col("document_id").cast("string").alias("document_id")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.char_length("text")).alias("chars"))
    bad = canonical.verify_store(spark, path).groupBy(F.col("key").alias("document_id")).agg(F.count(F.lit(1)).alias("faults"))
    return back.join(bad, "document_id", "left").select("document_id", "rows", "chars", F.coalesce("faults", F.lit(0)).cast("long").alias("faults"))


QUERIES = {
    f.__name__: f
    for f in (file_verify, overlay_cover, occurrence_projection, effective_targets, correction_targets, record_membership, packet_relations, packet_input_check, typed_edges, occurrence_conflicts, correction_state, first_evidence)
    + (correction_assets, span_positions, compact_text, forbidden_markers, rule_ids, line_cues, reassembled_turns, graph_audit, known_repairs, left_over_spans, store_round_trip)
}

_OCC = """occ AS (SELECT 'o' || o_orderkey AS occurrence_id, 'C' || o_custkey AS source, CASE WHEN o_orderstatus = 'F' THEN 'R' || o_custkey END AS rule, CASE WHEN o_orderstatus = 'O' THEN 'D' END AS doc, o_orderpriority AS cited,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' THEN 'alias' WHEN o_orderstatus <> 'F' AND o_orderpriority = '2-HIGH' THEN 'historical' END AS over, 'X' || o_custkey AS resolved FROM orders)"""

ORACLES = {
    "file_verify": """WITH d AS (SELECT doc_id, 'd' || doc_id AS key, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[.]$', '') AS u, doc_id IN (SELECT doc_id FROM labels) AS there FROM documents)
        SELECT 'file.missing' AS code, key FROM d WHERE NOT there UNION ALL SELECT 'file.digest', key FROM d WHERE there AND t <> u UNION ALL SELECT 'file.length', key FROM d WHERE there AND t <> u""",
    "overlay_cover": """SELECT CASE WHEN o_orderstatus = 'P' THEN 'overlay.extra' ELSE 'overlay.missing' END AS code, 'o' || o_orderkey AS key FROM orders WHERE (o_orderstatus = 'P') <> (o_orderpriority = '1-URGENT')""",
    "occurrence_projection": f"""WITH {_OCC} SELECT occurrence_id, source, CASE WHEN over = 'alias' THEN 'rule' WHEN over = 'historical' THEN 'historical_rule' WHEN rule IS NOT NULL THEN 'rule' WHEN doc IS NOT NULL THEN 'document' ELSE 'unresolved' END AS kind,
        coalesce(CASE WHEN over IS NOT NULL THEN resolved END, rule, doc, cited) AS target FROM occ""",
    "effective_targets": f"""WITH {_OCC}, t AS (SELECT occurrence_id, coalesce(CASE WHEN over IS NOT NULL THEN resolved END, rule) AS target FROM occ)
        SELECT occurrence_id, target, CASE WHEN substr(target, 2) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING') THEN 'rule' ELSE 'external_or_historical' END AS target_kind FROM t""",
    "correction_targets": """SELECT 'o' || o_orderkey AS overlay_id, 'C' || o_custkey AS rule_id FROM orders WHERE o_orderstatus = 'F' UNION SELECT 'o' || l_orderkey, 'P' || l_partkey FROM lineitem WHERE l_returnflag IN ('R', 'A')""",
    "record_membership": """WITH n AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT 'record.membership' AS code, 'part:' || p_partkey AS key, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM part LEFT JOIN n ON k = p_partkey WHERE coalesce(n, 0) <> 1""",
    "packet_relations": """WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS packet_id, 'P-' || month(o_orderdate) || '.' || o_orderkey AS rule FROM orders), ids AS (SELECT rule FROM o)
        SELECT packet_id, rule AS source, 'hierarchy_parent' AS relation, CASE WHEN regexp_replace(rule, '[.][^.]*$', '') IN (SELECT rule FROM ids) THEN regexp_replace(rule, '[.][^.]*$', '') ELSE 'chapter:c' END AS target, '' AS evidence, CAST(1 AS BIGINT) AS multiplicity FROM o
        UNION ALL SELECT packet_id, rule, 'source_citation', 'p' || l_partkey, string_agg(l_linenumber || ':' || l_suppkey || ':' || CAST(l_quantity AS VARCHAR), ',' ORDER BY l_linenumber, l_linenumber || ':' || l_suppkey || ':' || CAST(l_quantity AS VARCHAR)), count(*) FROM lineitem JOIN o ON l_orderkey = o_orderkey GROUP BY packet_id, rule, l_partkey""",
    "packet_input_check": """SELECT 'packet.cover.missing' AS code, CAST(l_orderkey AS VARCHAR) AS key FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'packet.cover.extra', CAST(o_orderkey AS VARCHAR) FROM (SELECT DISTINCT o_orderkey FROM orders) WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL SELECT 'packet.duplicate', CAST(o_orderkey AS VARCHAR) FROM orders GROUP BY o_orderkey HAVING count(*) > 1 UNION ALL SELECT 'packet.size', 'c' || o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 12""",
    "typed_edges": """WITH d AS (SELECT DISTINCT l_orderkey, l_returnflag, l_partkey, l_linenumber FROM lineitem)
        SELECT l_orderkey AS from_id, l_returnflag AS relation, l_partkey AS to_id, CAST(min(l_linenumber) AS BIGINT) AS pos, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS clauses FROM d GROUP BY 1, 2, 3""",
    "occurrence_conflicts": """SELECT 'occurrence.conflict' AS code, l_orderkey || '|' || l_partkey AS key, count(DISTINCT CAST(l_quantity AS INTEGER)) || ' variants' AS detail FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(DISTINCT CAST(l_quantity AS INTEGER)) > 1""",
    "correction_state": """SELECT 'o' || l_orderkey AS overlay_id, CASE WHEN bool_and(l_returnflag = 'R') AND bool_or(l_linenumber = 1) THEN 'deleted' WHEN bool_or(l_returnflag = 'A') THEN 'replaced' ELSE 'applied' END AS status,
        strftime(max(l_shipdate), '%Y-%m-%d') AS effective_date FROM lineitem GROUP BY l_orderkey""",
    "first_evidence": """WITH v AS (SELECT 'status' AS code, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE coalesce(o_orderstatus <> 'F', true) UNION ALL SELECT 'urgent', CAST(o_orderkey AS VARCHAR) FROM orders WHERE coalesce(o_orderpriority = '1-URGENT', true)
          UNION ALL SELECT 'short', CAST(doc_id AS VARCHAR) FROM documents WHERE coalesce(n_chars <= 300, true)), k AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY key) AS k, count(*) OVER (PARTITION BY code) AS total FROM v)
        SELECT code, key, total FROM k WHERE k <= 3""",
    "correction_assets": """SELECT p_partkey, ['x/Changes.html', 'changes2.html?a=1#b', 'changes3.html', 'mychanges.html', '/a/CHANGES2.HTML'][CAST(p_partkey % 5 + 1 AS INTEGER)] IN ('x/Changes.html', 'changes2.html?a=1#b', '/a/CHANGES2.HTML') AND p_size % 3 <> 2 AS is_asset FROM part""",
    "span_positions": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, instr(coalesce(text, ''), chr(10)) AS k FROM documents)
        SELECT doc_id, CASE WHEN k > 0 THEN 2 ELSE 1 END AS line, CAST(k AS BIGINT) AS line_start, CAST(strlen(substr(t, 1, k)) AS BIGINT) AS byte_offset, upper(sha256(substr(t, k + 1))) AS rest_sha256, CAST(strlen(t) AS BIGINT) AS n_bytes FROM d""",
    "compact_text": r"""WITH d AS (SELECT doc_id, replace(coalesce(text, ''), chr(160), ' ') AS t FROM documents), c AS (SELECT doc_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS c, regexp_replace(regexp_replace(regexp_replace(t, '[\t\v\f ]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS u FROM d)
        SELECT doc_id, upper(sha256(c)) AS compact_sha256, upper(sha256(regexp_replace(u, '^\s+|\s+$', '', 'g'))) AS clean_sha256 FROM c""",
    "forbidden_markers": """SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), 'License|password|token|TODO'))), ',') AS markers FROM documents""",
    "rule_ids": """SELECT p_partkey, 'P-' || p_partkey || '.A' || CASE WHEN p_size > 25 THEN '(bC)' ELSE '' END AS rule_id FROM part""",
    "line_cues": """SELECT ['caption', 'caption', 'note', 'note', 'example', 'list_intro', 'none'][CAST(l_linenumber % 7 + 1 AS INTEGER)] AS cue, ['arabic', 'lower_roman', 'upper_alpha', 'lower_alpha', 'bullet', 'upper_roman', 'unordered'][CAST(l_suppkey % 7 + 1 AS INTEGER)] AS family,
        count(*) AS n, min(l_orderkey) AS first_order FROM lineitem GROUP BY 1, 2""",
    "reassembled_turns": """SELECT conv_id, upper(sha256(string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) ORDER BY turn, role, coalesce(role, '') || ': ' || coalesce(text, '')))) AS sha256 FROM conversations GROUP BY conv_id""",
    "graph_audit": """WITH o AS (SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey AS id, 'o' || l_orderkey AS s, 'p' || l_partkey AS t, any_value(l_returnflag) AS f FROM lineitem GROUP BY ALL),
        e AS (SELECT s AS x FROM o UNION SELECT t FROM o), n AS (SELECT 'o' || o_orderkey AS x FROM orders UNION SELECT 'p' || p_partkey FROM part WHERE p_size > 10),
        v AS (SELECT 'edge.endpoint' AS code, x AS key FROM e WHERE x NOT IN (SELECT x FROM n) UNION ALL SELECT 'evidence.extra', id FROM o WHERE f = 'A')
        SELECT code, count(*) AS n, min(key) AS first_key FROM v GROUP BY code""",
    "known_repairs": """SELECT CAST(p_partkey AS VARCHAR) AS key, CASE p_partkey WHEN 1 THEN 'one' WHEN 2 THEN 'two' WHEN 5 THEN 'five' ELSE p_name END AS value FROM part UNION ALL SELECT '-7', 'repair.unused'""",
    "left_over_spans": """WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents) SELECT doc_id, CAST(0 AS BIGINT) AS from_char, CAST(CASE WHEN n > 20 THEN 10 ELSE n END AS BIGINT) AS to_char FROM d WHERE n > 0
        UNION ALL SELECT doc_id, 20, least(n, 300) FROM d WHERE n > 20""",
    "store_round_trip": "SELECT source AS document_id, count(*) AS rows, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS faults FROM documents GROUP BY source",
}
