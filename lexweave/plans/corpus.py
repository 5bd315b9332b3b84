"""Queries over pages, documents and conversations, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import html, text
from lexweave.operators import clauses, graph, references, validate, windows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def xref_occurrences(spark, sf_dir):
    found = references.links(table(spark, sf_dir, "pages"))
    return found.select("page_id", F.format_string("%d:xref:%04d", "page_id", "ordinal").alias("occurrence_id"), "href", "label", F.col("start").cast("long").alias("start_at"), F.col("end").cast("long").alias("end_at"))


_LINKS = r"""
    m AS (SELECT page_id, url, html, unnest(regexp_extract_all(html, '(?s)<!--.*?-->')) AS c FROM pages),
    masked AS (
      SELECT page_id, url,
             array_to_string(list_transform(range(1, len(parts) + 1), lambda i: parts[i] || CASE WHEN i <= len(coms) THEN regexp_replace(coms[i], '[^\r\n]', ' ', 'g') ELSE '' END), '') AS h
      FROM (SELECT page_id, url, string_split_regex(html, '(?s)<!--.*?-->') AS parts, regexp_extract_all(html, '(?s)<!--.*?-->') AS coms FROM pages)
    ),
    cut AS (SELECT page_id, url, h, regexp_extract_all(h, '(?is)<a\s[^>]*>.*?</a\s*>') AS ms, string_split_regex(h, '(?is)<a\s[^>]*>.*?</a\s*>') AS gaps FROM masked),
    links AS (
      SELECT page_id, url, i AS ordinal, ms[i] AS m,
             list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS start_at
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM cut)
    ),
    refs AS (
      SELECT page_id, url, ordinal, regexp_extract(m, '(?i)^<a\s[^>]*href="([^"]*)"', 1) AS href,
             regexp_replace(regexp_replace(m, '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g') AS label,
             CAST(start_at AS BIGINT) AS start_at, CAST(start_at + length(m) AS BIGINT) AS end_at
      FROM links
    )
"""


def xref_edges(spark, sf_dir):
    """Edges from hosts to what their pages link to, with multiplicity and evidence."""
    pages = table(spark, sf_dir, "pages")
    found = references.links(pages).join(pages.select("page_id", references.host(F.col("url")).alias("source")), "page_id")
    occ = found.select(F.format_string("%d:xref:%04d", "page_id", "ordinal").alias("occurrence_id"), "source", F.col("href").alias("target"), F.when(F.substring("href", 1, 1) == "/", "document").otherwise("unresolved").alias("kind"))
    edges = graph.aggregate_edges(occ)
    return edges.select("edge_id", "source", "kind", "target", "multiplicity", F.array_join("evidence", ",").alias("evidence"))


def xref_nodes(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = references.links(pages).join(pages.select("page_id", references.host(F.col("url")).alias("source")), "page_id")
    edges = found.select("source", F.col("href").alias("target"), F.lit("document").alias("kind")).distinct()
    return graph.node_roles(edges).select("node", F.array_join("roles", ",").alias("roles"))


def clause_segments(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    e = d.select("doc_id", F.posexplode(text.segments(F.coalesce("text", F.lit("")))).alias("i", "s"))
    return e.select("doc_id", (F.col("i") + 1).cast("long").alias("ordinal"), F.format_string("%d:clause:%04d", "doc_id", F.col("i") + 1).alias("unit_id"), F.char_length("s").cast("long").alias("n_chars"), text.sha_upper(F.col("s")).alias("text_sha256"))


def context_window(spark, sf_dir):
    """Sixty code points on either side of the first full stop of each document."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("p", F.locate(".", F.col("text"))).where("p > 0")
    w = text.context_window(F.col("text"), F.col("p") - 1, F.col("p"), 60)
    return d.select("doc_id", w.alias("w")).select("doc_id", F.col("w.text").alias("context"), F.col("w.start").cast("long").alias("ref_start"), F.col("w.end").cast("long").alias("ref_end"))


def span_partition_check(spark, sf_dir):
    """Lines of documents as spans (each with its line feed): how many, whether they abut, and where they end."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = d.select("doc_id", F.explode(text.positions(F.col("text"), r"[^\n]*\n|[^\n]+$")).alias("s")).select("doc_id", "s.start", "s.end")
    bad = validate.partition_gaps(spans, "doc_id", d.select("doc_id", F.char_length("text").alias("length")))
    n = spans.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spans"), F.max("end").cast("long").alias("n_chars"))
    problems = bad.groupBy(F.col("key").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("p"))
    return n.join(problems, "doc_id", "left").select("doc_id", "n_spans", "n_chars", F.coalesce("p", F.lit(0)).cast("long").alias("n_violations"))


def neighbour_context(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("key", F.concat_ws(":", F.col("turn").cast("string"), "role"))
    out = windows.neighbours(c, "conv_id", ["turn"], "key")
    return out.select("conv_id", "turn", F.array_join("before", ",").alias("before"), F.array_join("after", ",").alias("after"))


def content_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.sha_upper(F.coalesce("text", F.lit(""))).alias("sha256"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))


def dup_ids(spark, sf_dir):
    """Texts that stand in more than one document, with the ids that share them."""
    d = table(spark, sf_dir, "documents").select("doc_id", text.sha_upper(F.coalesce("text", F.lit(""))).alias("sha256"))
    g = d.groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    return g.where("n > 1").select("sha256", "n", "first_id", "last_id")


def coverage_gaps(spark, sf_dir):
    """Documents without labels, and labels without a document, by full outer cover."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return validate.exact_cover(d, lab, "doc_id", "labels").select("code", "key")


def exact_cover(spark, sf_dir):
    d, s = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return validate.exact_cover(d.select(F.col("o_orderkey").alias("orderkey")), s.select(F.col("l_orderkey").alias("orderkey")), "orderkey", "orders").select("code", "key")


def physical_census(spark, sf_dir):
    """Start tags by host and kind, comments and scripts left out, zeros kept."""
    p = table(spark, sf_dir, "pages")
    masked = F.regexp_replace(F.regexp_replace("html", "(?s)<!--.*?-->", ""), "(?is)(<script[^>]*>).*?(</script>)", "$1$2")
    e = p.select(references.host(F.col("url")).alias("host"), F.explode(F.regexp_extract_all(masked, F.lit(r"<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))).alias("tag")).select("host", F.lower("tag").alias("tag"))
    return validate.zero_filled(e, "tag", list(CENSUS), ["host"]).select("host", *(F.col(k).alias(f"n_{k}") for k in CENSUS))


CENSUS = ("a", "p", "li", "b", "br", "h1", "table", "tr", "img")


def lexer_census(spark, sf_dir):
    """The stateful lexer's count of the same elements over all pages, beside that of its nodes."""
    p = table(spark, sf_dir, "pages")
    return validate.zero_filled(html.census_table(p, "page_id", "html"), "tag", list(CENSUS), ["page_id"]).select("page_id", *(F.col(k).alias(f"n_{k}") for k in CENSUS))


def html_nodes(spark, sf_dir):
    """Flat document trees of all pages: counts by kind and the depth of the deepest node."""
    n = html.node_table(table(spark, sf_dir, "pages"), "page_id", "html")
    depth = F.size(F.split("path", "/")) - 1
    return n.groupBy("page_id").agg(*(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in html.NODE_KINDS), F.max(depth).alias("depth"))


def html_clauses(spark, sf_dir):
    n = html.node_table(table(spark, sf_dir, "pages"), "page_id", "html")
    return clauses.clauses(n, "page_id")


def visible_text(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    v = text.visible_text(F.col("html"))
    return p.select("page_id", F.char_length(v).cast("long").alias("n_chars"), text.sha_upper(v).alias("sha256"))


def kind_rollup(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.rollup("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


def ancestor_chain(spark, sf_dir):
    """Ancestors of page paths, nearest first."""
    p = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1)
    up = graph.ancestors(F.filter(F.split(path, "/"), lambda s: s != ""), "/")
    return p.select("page_id", F.posexplode(up).alias("i", "ancestor")).select("page_id", (F.col("i") + 1).cast("long").alias("step"), "ancestor")


def normalized_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.sha_upper(text.normalize_token(F.coalesce("text", F.lit("")))).alias("token_sha256"))


def sentence_units(spark, sf_dir):
    """Sentence spans with all guards: their number and covered characters by document."""
    d = table(spark, sf_dir, "documents")
    s = d.select("doc_id", text.sentence_spans(F.coalesce("text", F.lit(""))).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"])).alias("covered"))


QUERIES = {f.__name__: f for f in (xref_occurrences, xref_edges, xref_nodes, clause_segments, context_window, span_partition_check, neighbour_context, content_hash, dup_ids, coverage_gaps, exact_cover, physical_census, lexer_census, html_nodes, html_clauses, visible_text, kind_rollup, ancestor_chain, normalized_tokens, sentence_units)}

_HOST = r"regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
_CENSUS_COLUMNS = ", ".join(f"count(*) FILTER (WHERE tag = '{k}') AS n_{k}" for k in CENSUS)
_BARE = r"regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)(<script[^>]*>).*?(</script>)', '\1\2', 'g')"
_VISIBLE = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))"""

ORACLES = {
    "xref_occurrences": f"WITH {_LINKS} SELECT page_id, format('{{}}:xref:{{:04d}}', page_id, ordinal) AS occurrence_id, href, label, start_at, end_at FROM refs",
    "xref_edges": f"""
        WITH {_LINKS}, e AS (SELECT {_HOST} AS source, href AS target, CASE WHEN href[1] = '/' THEN 'document' ELSE 'unresolved' END AS kind, format('{{}}:xref:{{:04d}}', page_id, ordinal) AS id FROM refs)
        SELECT 'edge:' || upper(sha256('{{' || chr(10) || '  "source_node_id": "' || source || '",' || chr(10) || '  "target_kind": "' || kind || '",' || chr(10) || '  "target_node_id": "' || replace(replace(target, '\\', '\\\\'), '"', '\\"') || '"' || chr(10) || '}}' || chr(10))) AS edge_id,
               source, kind, target, count(*) AS multiplicity, array_to_string(list_sort(list(id)), ',') AS evidence
        FROM e GROUP BY source, kind, target
    """.replace("\\\\", "\\"),
    "xref_nodes": f"""
        WITH {_LINKS}, e AS (SELECT {_HOST} AS source, href AS target FROM refs), u AS (SELECT source AS node, 1 AS s, 0 AS t FROM e UNION ALL SELECT target, 0, 1 FROM e)
        SELECT node, CASE WHEN max(s) = 1 AND max(t) = 1 THEN 'source,target' WHEN max(s) = 1 THEN 'source' ELSE 'target' END AS roles FROM u GROUP BY node
    """,
    "clause_segments": r"""
        WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(coalesce(text, ''), '[.!?;]+\s+'), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents),
        e AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, l FROM s)
        SELECT doc_id, i AS ordinal, format('{}:clause:{:04d}', doc_id, i) AS unit_id, CAST(length(l[i]) AS BIGINT) AS n_chars, upper(sha256(l[i])) AS text_sha256 FROM e
    """,
    "context_window": r"""
        WITH d AS (SELECT doc_id, text, strpos(text, '.') AS p FROM documents WHERE strpos(text, '.') > 0),
        w AS (SELECT *, greatest(0, p - 61) AS l FROM d), r AS (SELECT *, substr(text, l + 1, p + 60 - l) AS raw FROM w),
        t AS (SELECT *, length(raw) - length(regexp_replace(raw, '^\s+', '')) AS lead FROM r)
        SELECT doc_id, regexp_replace(regexp_replace(raw, '^\s+', ''), '\s+$', '') AS context, CAST(p - 1 - l - lead AS BIGINT) AS ref_start, CAST(p - l - lead AS BIGINT) AS ref_end FROM t
    """,
    "span_partition_check": r"""
        SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\n]*\n|[^\n]+$')) AS BIGINT) AS n_spans, CAST(length(text) AS BIGINT) AS n_chars, CAST(0 AS BIGINT) AS n_violations
        FROM documents WHERE coalesce(text, '') <> ''
    """,
    "neighbour_context": """
        WITH c AS (SELECT *, turn || ':' || role AS k FROM conversations)
        SELECT conv_id, turn, concat_ws(',', lag(k, 2) OVER w, lag(k, 1) OVER w) AS before, concat_ws(',', lead(k, 1) OVER w, lead(k, 2) OVER w) AS after
        FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
    """,
    "content_hash": "SELECT doc_id, upper(sha256(coalesce(text, ''))) AS sha256, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes FROM documents",
    "dup_ids": "SELECT upper(sha256(coalesce(text, ''))) AS sha256, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "coverage_gaps": """
        SELECT CASE WHEN l.doc_id IS NULL THEN 'labels.missing' ELSE 'labels.extra' END AS code, CAST(coalesce(d.doc_id, l.doc_id) AS VARCHAR) AS key
        FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL
    """,
    "exact_cover": """
        SELECT CASE WHEN l_orderkey IS NULL THEN 'orders.missing' ELSE 'orders.extra' END AS code, CAST(coalesce(o_orderkey, l_orderkey) AS VARCHAR) AS key
        FROM (SELECT DISTINCT o_orderkey FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey WHERE o_orderkey IS NULL OR l_orderkey IS NULL
    """,
    "physical_census": f"WITH t AS (SELECT {_HOST} AS host, lower(unnest(regexp_extract_all({_BARE}, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages) SELECT host, {_CENSUS_COLUMNS} FROM t GROUP BY host",
    "lexer_census": f"WITH t AS (SELECT page_id, lower(unnest(regexp_extract_all({_BARE}, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages) SELECT page_id, {_CENSUS_COLUMNS} FROM t GROUP BY page_id",
    "visible_text": f"WITH v AS (SELECT page_id, {_VISIBLE} AS v FROM pages) SELECT page_id, CAST(length(v) AS BIGINT) AS n_chars, upper(sha256(v)) AS sha256 FROM v",
    "kind_rollup": "SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY ROLLUP (source, lang)",
    "ancestor_chain": r"""
        WITH RECURSIVE p AS (SELECT page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/'), lambda s: s <> '') AS s FROM pages),
        u AS (SELECT page_id, 1 AS step, s[1:len(s) - 1] AS s FROM p WHERE len(s) > 1 UNION ALL SELECT page_id, step + 1, s[1:len(s) - 1] FROM u WHERE len(s) > 1)
        SELECT page_id, CAST(step AS BIGINT) AS step, array_to_string(s, '/') AS ancestor FROM u
    """,
    "normalized_tokens": r"""
        SELECT doc_id, upper(sha256(trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '^source_(condition|requirement|preference|prohibition)_', ''), '^(predicate|action):', ''), '[^a-z0-9]+', '_', 'g'), '_'))) AS token_sha256 FROM documents
    """,
}
