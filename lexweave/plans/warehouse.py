"""Queries over the relational tables that exercise rule, graph, window and validation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions.numeric import multiplied, numerical_term_column
from lexweave.functions.text import normalize_token
from lexweave.operators import graph, rules, validate, windows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_as_rules(spark, sf_dir) -> DataFrame:
    """Parts in the shape of rules: words of the name are conditions, the type's is an exclusion for one brand."""
    p = table(spark, sf_dir, "part")
    empty = F.array().cast("array<string>")
    return p.select(
        F.col("p_partkey").alias("pos"),
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("rule_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("source_chapter"),
        F.lit("").alias("source_url"),
        F.col("p_type").alias("rule_type"),
        F.lit("").alias("source_quote"),
        F.split("p_name", " ").alias("applies_if"),
        F.when(F.col("p_brand") == "Brand#13", F.array(F.lower("p_type"))).otherwise(empty).alias("unless"),
        F.array("p_name").alias("then"),
        empty.alias("prefer"),
        empty.alias("depends_on"),
    )


def rule_stats(spark, sf_dir):
    return rules.stats(parts_as_rules(spark, sf_dir))


def rule_stats_zero(spark, sf_dir):
    """Events by user and kind over a fixed domain, zeros kept."""
    e = table(spark, sf_dir, "events")
    return validate.zero_filled(e, "event_type", list(EVENT_KINDS), ["user_id"])


EVENT_KINDS = ("signup", "purchase", "error", "view", "click", "refund")


def rule_get(spark, sf_dir):
    return rules.get(parts_as_rules(spark, sf_dir), "P-7").select("rule_id", "title", "source_chapter", "rule_type")


def rule_search(spark, sf_dir):
    """The first fifty rules of a type whose text holds a word (a top-k report)."""
    found = rules.search(parts_as_rules(spark, sf_dir), "Widget", rule_type="PROMO", limit=50)
    return found.select("pos", "rule_id", "title")


FACTS = ("predicate: small widget", "cold", "economy")


def fact_activation(spark, sf_dir):
    e = rules.evaluate(parts_as_rules(spark, sf_dir), list(FACTS))
    return e.select("rule_id", "status", "condition_score", F.array_join("matched_conditions", ",").alias("matched"), F.array_join("blocked_by", ",").alias("blocked_by"))


def fact_ranking(spark, sf_dir):
    top = rules.ranked(rules.evaluate(parts_as_rules(spark, sf_dir), list(FACTS)), 25)
    return top.select(F.col("rank").cast("long").alias("rank"), "rule_id", "condition_score")


def fact_join(spark, sf_dir):
    """Theta join of conditions with market segments by symmetric containment, counted."""
    words = parts_as_rules(spark, sf_dir).select(F.explode("applies_if").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).select(normalize_token(F.col("w")).alias("token"), "n")
    facts = table(spark, sf_dir, "events").select("event_type").distinct().select(normalize_token(F.concat(F.lit("small "), F.col("event_type"))).alias("fact"))
    return rules.fact_join(words, facts).groupBy("fact").agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("n").alias("n_conditions"))


def entity_edges(spark, sf_dir) -> DataFrame:
    """A typed entity graph: orders to customers, customers to nations, nations to regions."""
    node = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    o = table(spark, sf_dir, "orders").select(node("order", "o_orderkey").alias("source"), node("customer", "o_custkey").alias("target"))
    c = table(spark, sf_dir, "customer").select(node("customer", "c_custkey").alias("source"), node("nation", "c_nationkey").alias("target"))
    n = table(spark, sf_dir, "nation").select(node("nation", "n_nationkey").alias("source"), node("region", "n_regionkey").alias("target"))
    li = table(spark, sf_dir, "lineitem").select(node("order", "l_orderkey").alias("source"), node("supplier", "l_suppkey").alias("target")).distinct()
    s = table(spark, sf_dir, "supplier").select(node("supplier", "s_suppkey").alias("source"), node("nation", "s_nationkey").alias("target"))
    return o.unionByName(c).unionByName(n).unionByName(li).unionByName(s)


def khop_deps(spark, sf_dir):
    """All entities within three steps of the urgent orders."""
    seeds = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("node"))
    return graph.khop(entity_edges(spark, sf_dir), seeds, 3).select("node", F.col("depth").cast("long").alias("depth"))


def khop_reverse(spark, sf_dir):
    """Everything that depends on a region within two steps."""
    seeds = spark.createDataFrame([("region:1",)], "node string")
    return graph.khop(entity_edges(spark, sf_dir), seeds, 2, reverse=True).select("node", F.col("depth").cast("long").alias("depth"))


def components(spark, sf_dir):
    """Components of customers and the part of their account range that they share: nations linked by equal segments."""
    c = table(spark, sf_dir, "customer")
    cust = F.col("c_custkey") * 2
    group = (F.floor(F.abs("c_acctbal") / 10).cast("long") * 2) + 1
    return graph.components(c.select(cust.alias("a"), group.alias("b"))).select("node", "root")


def asof_cue(spark, sf_dir):
    """For each event the user's last signup before it."""
    e = table(spark, sf_dir, "events")
    out = windows.previous_where(e, "user_id", ["ts", "event_id"], F.col("event_id"), F.col("event_type") == "signup", "last_signup")
    return out.select("event_id", F.coalesce("last_signup", F.lit(-1)).alias("last_signup"))


def style_runs(spark, sf_dir):
    """Runs of equal event types of each user."""
    e = windows.islands(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type")
    return e.groupBy("user_id", "island", "event_type").agg(F.count(F.lit(1)).alias("length"), F.min("event_id").alias("low_id")).select("user_id", "island", "event_type", "length", "low_id")


def span_ends(spark, sf_dir):
    """Half-open intervals of a user's event numbers: each ends where the next begins."""
    out = windows.span_ends(table(spark, sf_dir, "events"), "user_id", "event_id", F.lit(-1).cast("long"))
    return out.select("event_id", "user_id", F.col("end").alias("until"))


def packets(spark, sf_dir):
    """Orders of a customer by date, runs of equal status cut to parts of at most four."""
    o = windows.packets(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus", 4)
    return o.select("o_orderkey", F.col("part").cast("long").alias("part"), F.col("place").cast("long").alias("place"), "packet_id")


def ordinals(spark, sf_dir):
    li = windows.ordinals(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"], "line")
    return li.groupBy("l_orderkey").agg(F.max("ordinal").cast("long").alias("n"), F.max("ordinal_id").alias("last_id"))


def lex_rank(spark, sf_dir):
    """Of each customer the order with the least vector (line quantities, then priority), first id on ties."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.col("l_quantity").cast("int"))).alias("v"))
    o = table(spark, sf_dir, "orders").join(li, "o_orderkey").select("o_custkey", F.col("o_orderkey").alias("pos"), "v", "o_orderpriority")
    return windows.best(o, "o_custkey", "v", "o_orderpriority").select("o_custkey", F.col("pos").alias("o_orderkey"), F.array_join(F.transform("v", lambda x: x.cast("string")), ",").alias("vector"))


def typed_ref_check(spark, sf_dir):
    """Line items' references to parts, suppliers and orders that hit no object, or several; order keys are also read as parts."""
    li = table(spark, sf_dir, "lineitem")
    refs = li.select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("ref_id")) for k, c in (("part", "l_partkey"), ("supplier", "l_suppkey"), ("order", "l_orderkey"), ("part", "l_orderkey"))))).alias("x")).select("x.*").distinct()
    objects = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("object_id"))
    objects = objects.unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("object_id"))).unionByName(table(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("object_id")))
    return validate.reference_targets(refs, objects).select("code", "key")


REGIONS = [("front", 1, 8), ("body", 9, 30), ("tables", 31, 42), ("index", 43, 49)]


def page_region(spark, sf_dir):
    return windows.region(table(spark, sf_dir, "part"), "p_size", REGIONS).groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_key"))


def numeric_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey") % 1000
    return p.select("p_partkey", numerical_term_column(n.cast("int")).alias("term"))


def multiplicity_prefix(spark, sf_dir):
    """Parts of an order grouped by name, with multiplying prefixes and sorted locants, joined in alphabetical order."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.regexp_replace("p_name", " ", "").alias("name")), "l_partkey")
    g = li.groupBy("l_orderkey", "name").agg(F.array_sort(F.collect_list("l_linenumber")).alias("locants"))
    one = F.concat(F.array_join(F.transform("locants", lambda x: x.cast("string")), ","), F.lit("-"), multiplied(F.col("name"), F.size("locants")))
    return g.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", one.alias("t")))), lambda x: x["t"]), "-").alias("prefixes"))


def symbol_merge(spark, sf_dir):
    """Parts as symbols by name: those whose redeclarations differ."""
    from lexweave.operators.ir import merge_symbols

    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("symbol_id"), F.col("p_partkey").alias("pos"), F.concat_ws("|", "p_brand", "p_type").alias("body"))
    return merge_symbols(p)


def exception_precedence(spark, sf_dir):
    """Lines of an order as exceptions: by quantity (specificity), then line, then part."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("target"), F.col("l_quantity").cast("int").alias("specificity"), F.col("l_linenumber").alias("source_order"), F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("exception_id"))
    r = windows.precedence(li, "target").where("rank = 1")
    return r.select(F.col("target").alias("l_orderkey"), F.col("specificity").cast("long").alias("specificity"), F.col("source_order").cast("long").alias("source_order"), F.col("exception_id.l_partkey").alias("l_partkey"))


def stage_chain(spark, sf_dir):
    o = windows.chain(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey")
    return o.select("o_orderkey", F.col("ordinal").cast("long").alias("ordinal"), F.coalesce("next", F.lit(-1)).alias("next_stage_id"))


def multiset_difference(spark, sf_dir):
    """Shipping dates' weekdays that returned and other lines have in different numbers, as multisets."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", F.dayofweek("l_shipdate").cast("long").alias("day"), F.col("l_linenumber").cast("long").alias("line"))
    a, b = (li.where(F.col("l_returnflag") == f).select("day", "line") for f in "RA")
    return a.exceptAll(b).groupBy("day", "line").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct("l_partkey", "l_suppkey").alias("n_pairs"), F.count(F.lit(1)).alias("n"))


def correction_events(spark, sf_dir):
    """Order dates written two ways as notice headers and read back."""
    from lexweave.operators.corrections import event_date

    o = table(spark, sf_dir, "orders")
    written = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d.M.yyyy")).otherwise(F.date_format("o_orderdate", "d MMMM yyyy"))
    return o.select("o_orderkey", event_date(written).cast("string").alias("event_date"))


def test_scores(spark, sf_dir):
    """Cases passed and failed by group: an order passes if it is final and not urgent."""
    o = table(spark, sf_dir, "orders")
    passed = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
    return o.groupBy("o_orderpriority").agg(F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"))


QUERIES = {f.__name__: f for f in (rule_stats, rule_stats_zero, rule_get, rule_search, fact_activation, fact_ranking, fact_join, khop_deps, khop_reverse, components, asof_cue, style_runs, span_ends, packets, ordinals, lex_rank, typed_ref_check, page_region, numeric_terms, multiplicity_prefix, symbol_merge, exception_precedence, stage_chain, multiset_difference, distinct_counts, correction_events, test_scores)}

_TOKEN = r"trim(regexp_replace(regexp_replace(lower({}), '^(predicate|action):', ''), '[^a-z0-9]+', '_', 'g'), '_')"
_ACTIVE = f"""
    f AS (SELECT {_TOKEN.format("unnest(['predicate: small widget', 'cold', 'economy'])")} AS f),
    r AS (SELECT p_partkey AS pos, 'P-' || p_partkey AS rule_id, p_brand AS chapter, string_split(p_name, ' ') AS a, CASE WHEN p_brand = 'Brand#13' THEN [lower(p_type)] ELSE CAST([] AS VARCHAR[]) END AS u FROM part),
    c AS (SELECT DISTINCT w, EXISTS (SELECT 1 FROM f WHERE contains({_TOKEN.format("w")}, f) OR contains(f, {_TOKEN.format("w")})) AS hit FROM (SELECT unnest(a) AS w FROM r UNION ALL SELECT unnest(u) FROM r)),
    h AS (SELECT list(w) AS hits FROM c WHERE hit),
    s AS (SELECT r.*, list_filter(a, lambda x: list_contains(hits, x)) AS m, list_filter(u, lambda x: list_contains(hits, x)) AS b FROM r, h)
"""
_TERM = """
    (SELECT CASE WHEN n BETWEEN 1 AND 11 THEN ['mono','di','tri','tetra','penta','hexa','hepta','octa','nona','deca','undeca'][n]
      WHEN n BETWEEN 12 AND 999 THEN
        ['','hen','do','tri','tetra','penta','hexa','hepta','octa','nona'][n % 10 + 1]
        || CASE WHEN (n // 10) % 10 = 2 THEN CASE WHEN n % 10 IN (0, 1) THEN 'icosa' ELSE 'cosa' END
           ELSE ['','deca','','triaconta','tetraconta','pentaconta','hexaconta','heptaconta','octaconta','nonaconta'][(n // 10) % 10 + 1] END
        || ['','hecta','dicta','tricta','tetracta','pentacta','hexacta','heptacta','octacta','nonacta'][n // 100 + 1] END)
"""
_EDGES = """
    e AS (SELECT 'order:' || o_orderkey AS s, 'customer:' || o_custkey AS t FROM orders UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
          UNION SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation UNION SELECT 'order:' || l_orderkey, 'supplier:' || l_suppkey FROM lineitem
          UNION SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey FROM supplier)
"""

ORACLES = {
    "rule_stats": "SELECT 'chapter' AS facet, p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'rule_type', p_type, count(*) FROM part GROUP BY 2",
    "rule_stats_zero": "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in EVENT_KINDS) + " FROM events GROUP BY user_id",
    "rule_get": "SELECT 'P-' || p_partkey AS rule_id, p_name AS title, p_brand AS source_chapter, p_type AS rule_type FROM part WHERE p_partkey = 7",
    "rule_search": "SELECT p_partkey AS pos, 'P-' || p_partkey AS rule_id, p_name AS title FROM part WHERE p_type = 'PROMO' AND contains(lower(p_name), 'widget') ORDER BY p_partkey LIMIT 50",
    "fact_activation": f"""WITH {_ACTIVE} SELECT rule_id, CASE WHEN len(b) > 0 THEN 'blocked' WHEN len(a) = 0 OR len(m) > 0 THEN 'activated' ELSE 'inactive' END AS status,
        CAST(len(m) AS BIGINT) AS condition_score, array_to_string(m, ',') AS matched, array_to_string(b, ',') AS blocked_by FROM s""",
    "fact_ranking": f"""WITH {_ACTIVE} SELECT row_number() OVER (ORDER BY len(m) DESC, chapter, rule_id, pos) AS rank, rule_id, CAST(len(m) AS BIGINT) AS condition_score
        FROM s WHERE len(b) = 0 AND len(m) > 0 ORDER BY 1 LIMIT 25""",
    "fact_join": f"""WITH w AS (SELECT {_TOKEN.format("w")} AS token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY w), f AS (SELECT DISTINCT {_TOKEN.format("'small ' || event_type")} AS fact FROM events)
        SELECT fact, count(*) AS n_tokens, CAST(sum(n) AS BIGINT) AS n_conditions FROM w JOIN f ON contains(token, fact) OR contains(fact, token) GROUP BY fact""",
    "khop_deps": f"""WITH RECURSIVE {_EDGES}, w AS (SELECT 'order:' || o_orderkey AS node, 0 AS depth FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION SELECT e.t, depth + 1 FROM w JOIN e ON e.s = w.node WHERE depth < 3) SELECT node, CAST(min(depth) AS BIGINT) AS depth FROM w GROUP BY node""",
    "khop_reverse": f"""WITH RECURSIVE {_EDGES}, w AS (SELECT 'region:1' AS node, 0 AS depth UNION SELECT e.s, depth + 1 FROM w JOIN e ON e.t = w.node WHERE depth < 2)
        SELECT node, CAST(min(depth) AS BIGINT) AS depth FROM w GROUP BY node""",
    "components": """WITH p AS (SELECT c_custkey * 2 AS a, CAST(floor(abs(c_acctbal) / 10) AS BIGINT) * 2 + 1 AS b FROM customer), g AS (SELECT b, least(min(a), b) AS root FROM p GROUP BY b)
        SELECT a AS node, root FROM p JOIN g USING (b) UNION SELECT b, root FROM g""",
    "asof_cue": """SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS last_signup FROM events""",
    "style_runs": """WITH a AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        b AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM a)
        SELECT user_id, CAST(island AS BIGINT) AS island, event_type, count(*) AS length, min(event_id) AS low_id FROM b GROUP BY ALL""",
    "span_ends": "SELECT event_id, user_id, coalesce(lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id), -1) AS until FROM events",
    "packets": """WITH a AS (SELECT *, CASE WHEN o_orderstatus IS NOT DISTINCT FROM lag(o_orderstatus) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
        b AS (SELECT *, sum(c) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS run FROM a),
        d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, run ORDER BY o_orderdate, o_orderkey) - 1 AS k FROM b),
        f AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY run, k // 4) AS part FROM d)
        SELECT o_orderkey, part, k % 4 AS place, format('{}-part-{:03d}', o_orderstatus, part) AS packet_id FROM f""",
    "ordinals": "SELECT l_orderkey, count(*) AS n, format('{}:line:{:04d}', l_orderkey, count(*)) AS last_id FROM lineitem GROUP BY l_orderkey",
    "lex_rank": """WITH v AS (SELECT l_orderkey, list_sort(list(CAST(l_quantity AS INTEGER))) AS v FROM lineitem GROUP BY 1), o AS (SELECT o_custkey, o_orderkey, v, o_orderpriority FROM orders JOIN v ON l_orderkey = o_orderkey),
        r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY v, o_orderpriority, o_orderkey) AS k FROM o) SELECT o_custkey, o_orderkey, array_to_string(v, ',') AS vector FROM r WHERE k = 1""",
    "typed_ref_check": """WITH r AS (SELECT DISTINCT 'part' AS kind, l_partkey AS id FROM lineitem UNION SELECT 'supplier', l_suppkey FROM lineitem UNION SELECT 'order', l_orderkey FROM lineitem UNION SELECT 'part', l_orderkey FROM lineitem),
        o AS (SELECT 'part' AS kind, p_partkey AS id FROM part UNION ALL SELECT 'supplier', s_suppkey FROM supplier UNION ALL SELECT 'order', o_orderkey FROM orders), n AS (SELECT kind, id, count(*) AS n FROM o GROUP BY ALL)
        SELECT CASE WHEN n IS NULL THEN 'ref.unresolved' ELSE 'ref.ambiguous' END AS code, r.kind || ':' || r.id AS key FROM r LEFT JOIN n USING (kind, id) WHERE coalesce(n, 0) <> 1""",
    "page_region": """SELECT CASE WHEN p_size BETWEEN 1 AND 8 THEN 'front' WHEN p_size BETWEEN 9 AND 30 THEN 'body' WHEN p_size BETWEEN 31 AND 42 THEN 'tables' WHEN p_size BETWEEN 43 AND 49 THEN 'index' END AS region,
        count(*) AS n, min(p_partkey) AS first_key FROM part GROUP BY 1""",
    "numeric_terms": f"SELECT p_partkey, {_TERM} AS term FROM (SELECT p_partkey, CAST(p_partkey % 1000 AS INTEGER) AS n FROM part)",
    "multiplicity_prefix": f"""WITH g AS (SELECT l_orderkey, replace(p_name, ' ', '') AS name, list_sort(list(l_linenumber)) AS l, CAST(count(*) AS INTEGER) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
        SELECT l_orderkey, string_agg(array_to_string(l, ',') || '-' || CASE WHEN n = 1 THEN '' ELSE {_TERM} END || name, '-' ORDER BY name) AS prefixes FROM g GROUP BY 1""",
    "symbol_merge": "SELECT p_name AS symbol_id, arg_min(p_brand || '|' || p_type, p_partkey) AS body, min(p_partkey) AS pos, count(DISTINCT p_brand || '|' || p_type) > 1 AS conflict FROM part GROUP BY 1",
    "exception_precedence": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS INTEGER) DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS k FROM lineitem)
        SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS specificity, CAST(l_linenumber AS BIGINT) AS source_order, l_partkey FROM r WHERE k = 1""",
    "stage_chain": "SELECT o_orderkey, row_number() OVER w AS ordinal, coalesce(lead(o_orderkey) OVER w, -1) AS next_stage_id FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)",
    "multiset_difference": """WITH t AS (SELECT l_returnflag AS f, CAST(dayofweek(l_shipdate) + 1 AS BIGINT) AS day, CAST(l_linenumber AS BIGINT) AS line FROM lineitem)
        SELECT day, line, count(*) AS n FROM (SELECT day, line FROM t WHERE f = 'R' EXCEPT ALL SELECT day, line FROM t WHERE f = 'A') GROUP BY ALL""",
    "distinct_counts": "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT (l_partkey, l_suppkey)) AS n_pairs, count(*) AS n FROM lineitem GROUP BY 1",
    "correction_events": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS event_date FROM orders",
    "test_scores": """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') AS passed,
        count(*) FILTER (WHERE NOT (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT')) AS failed FROM orders GROUP BY 1""",
}
