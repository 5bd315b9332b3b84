from pyspark.sql import functions as F

from lexweave.functions import numeric, text
from lexweave.operators import clauses, corrections, graph, ir, packets, references, rules, validate, windows


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: [(x is None, x) for x in r])


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_numerical_terms(spark):
    assert [numeric.numerical_term(n) for n in (1, 2, 10, 11, 14, 20, 21, 22, 111, 486)] == ["mono", "di", "deca", "undeca", "tetradeca", "icosa", "henicosa", "docosa", "hendecahecta", "hexaoctacontatetracta"]
    got = spark.range(0, 1001).select("id", numeric.numerical_term_column(F.col("id")).alias("t")).collect()
    assert all(r.t == (numeric.numerical_term(r.id) if 1 <= r.id <= 999 else None) for r in got)
    assert (numeric.parent_root(1), numeric.parent_root(20), numeric.derived_prefix(2), numeric.derived_prefix(4)) == ("meth", "icos", "bis", "tetrakis")


def test_normalize_token(spark):
    assert one(spark, "source_condition_Predicate: Ring  Size!", text.normalize_token) == "ring_size"
    assert one(spark, "predicate: Ring", text.normalize_token) == "ring"
    assert one(spark, "--", text.normalize_token) == ""


def test_positions_and_context(spark):
    s = "é P-1 and P-22.1, then P-3"
    got = one(spark, s, lambda c: text.positions(c, r"P-[0-9.]*[0-9]"))
    assert [(r.start, r.end, r.text) for r in got] == [(2, 5, "P-1"), (10, 16, "P-22.1"), (23, 26, "P-3")]
    w = one(spark, s, lambda c: text.context_window(c, F.lit(10), F.lit(16), 5))
    assert (w.text, w.text[w.start : w.end]) == ("and P-22.1, the", "P-22.1")


def test_clean_and_masks(spark):
    assert one(spark, "a  b\x91c\n\n\n\nd ", text.clean) == "a b‘c\n\nd"
    assert one(spark, "x<!-- a\nb -->y", text.mask_comments) == "x" + " " * 6 + "\n" + " " * 5 + "y"
    assert one(spark, '<p>A &amp; B<script>x</script><br>c</p>', text.visible_text) == "A & B c"
    assert one(spark, "<a HREF='q' x>", lambda c: text.attribute(c, "href")) == "q"
    assert one(spark, "&eacute;&#x41;&nope;", text.unescape_html4) == "éA&nope;"
    assert one(spark, "p-31.1(a)", text.canonical_rule_id) == "P-31.1(a)"
    assert one(spark, "b/c.html#X", lambda c: text.resolve_url(F.lit("http://h/a/d.html"), c)).asDict() == {"url": "http://h/a/b/c.html", "file": "c.html", "fragment": "X"}


def test_sentences():
    s = "See P-31.1 (cf. Fig. 2), i.e. both; then go. New sentence! E.g. this one"
    spans = text.sentence_spans_of(s)
    assert [s[a:b] for a, b in spans] == ["See P-31.1 (cf. Fig. 2), i.e. both;", "then go.", "New sentence!", "E.g. this one"]
    assert "".join(s[a:b] for a, b in spans).replace(" ", "") == s.replace(" ", "")


EDGES = [(0, "A", "B"), (1, "B", "C"), (2, "C", "D"), (3, "D", "E"), (4, "A", "C"), (5, "A", "B")]


def test_dependency_walks(spark):
    e = spark.createDataFrame(EDGES, "pos long, source string, target string")
    assert rows(graph.dependencies(e, "A", 3), "source", "target") == [("A", "B"), ("A", "C"), ("B", "C"), ("C", "D"), ("D", "E")]
    # a depth-first walk spends its depth on A-B-C-D and never returns to C
    assert rows(graph.dependencies(e, "A", 3, mode="dfs"), "pos", "source", "target") == [(0, "A", "B"), (1, "B", "C"), (2, "C", "D"), (3, "A", "C")]
    assert rows(graph.dependencies(e, "C", 1, reverse=True), "source", "target") == [("A", "C"), ("B", "C")]
    assert rows(graph.dependencies(e, "A", 0), "source") == []
    assert rows(graph.khop(e, spark.createDataFrame([("A",)], "node string"), 2)) == [("A", 0), ("B", 1), ("C", 1), ("D", 2)]


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (9, 8), (5, 5), (None, 4), (30, 3), (40, 30)], "a long, b long")
    assert rows(graph.components(e), "node", "root") == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7), (30, 1), (40, 1)]
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert rows(graph.components(path).agg(F.count("node"), F.max("root"))) == [(301, 0)]
    assert graph.components(e.limit(0)).count() == 0


def test_parents(spark):
    r = spark.createDataFrame([("P-1", "c"), ("P-1.2", "c"), ("P-1.2.3", "c"), ("P-9.1.1", "d")], "rule_id string, chapter string")
    assert rows(graph.parent_rules(r)) == [("P-1", "chapter:c"), ("P-1.2", "P-1"), ("P-1.2.3", "P-1.2"), ("P-9.1.1", "chapter:d")]


def test_edges_and_audit(spark):
    occ = spark.createDataFrame([("o2", "A", "B", "rule"), ("o1", "A", "B", "rule"), ("o3", "A", "d", "document")], "occurrence_id string, source string, target string, kind string")
    edges = graph.aggregate_edges(occ)
    nodes = graph.node_roles(edges)
    assert rows(edges, "source", "target", "multiplicity", "evidence") == [("A", "B", 2, ["o1", "o2"]), ("A", "d", 1, ["o3"])]
    assert rows(nodes, "node", "roles") == [("A", ["source"]), ("B", ["target"]), ("d", ["target"])]
    assert validate.passed(graph.audit(edges, nodes, occ))
    bad = edges.withColumn("target", F.when(F.col("target") == "d", "x").otherwise(F.col("target")))
    assert {r.code for r in graph.audit(bad, nodes, occ).collect()} == {"edge.endpoint", "edge.identity"}
    assert {r.code for r in graph.audit(edges, nodes, occ.limit(2)).collect()} == {"evidence.extra"}


RULES = [
    (0, "P-1", "First", "c1", "general", {"applies_if": ["ring present"], "unless": None, "then": ["number"]}, None, ["P-9"], {"parent": ["P-0"], "tables": ["T1"]}),
    (1, "P-2", "Second", "c1", "special", None, ["chain"], None, None),
    (2, "P-3", "Third", "c2", "general", {"applies_if": ["acid"], "unless": ["ring"], "then": []}, None, [], None),
    (3, "P-1", "First again", "c2", "general", {"applies_if": ["", "ring", "acid"], "unless": [], "then": []}, None, [], None),
]


def make_rules(spark):
    return rules.normalize_rules(spark.createDataFrame(RULES, "pos long, rule_id string, title string, source_chapter string, rule_type string, logic struct<applies_if:array<string>,unless:array<string>,then:array<string>>, prefer array<string>, depends_on array<string>, dependency_context struct<parent:array<string>,tables:array<string>>"))


def test_rules(spark):
    r = make_rules(spark)
    assert r.where("pos = 0").first().depends_on == ["P-0", "P-9", "T1"]
    assert rows(rules.get(r, "P-1"), "pos") == [(0,), (3,)]
    assert rows(rules.search(r, "RING!"), "pos") == [(0,), (3,)]
    assert rows(rules.search(r, limit=0), "pos") == [(0,)]
    assert rows(rules.search(r, chapter="c2", rule_type="general"), "pos") == [(2,), (3,)]
    assert rows(rules.stats(r)) == [("chapter", "c1", 2), ("chapter", "c2", 2), ("rule_type", "general", 3), ("rule_type", "special", 1)]
    e = rules.evaluate(r, ["ring", "acid group"])
    assert rows(e, "pos", "status", "condition_score") == [(0, "activated", 1), (1, "activated", 0), (2, "blocked", 1), (3, "activated", 2)]
    assert [(x.rule_id, x.pos) for x in rules.ranked(e, 2).orderBy("rank").collect()] == [("P-1", 3), ("P-1", 0)]
    assert rows(rules.evaluate(r, []), "status") == [("activated",), ("inactive",), ("inactive",), ("inactive",)]


def test_windows(spark):
    d = spark.createDataFrame([("k", i, v) for i, v in enumerate("aabbba")], "o string, i int, v string")
    assert rows(windows.runs(d, "o", "i", "v"), "v", "first", "last", "length") == [("a", 0, 1, 2), ("a", 5, 5, 1), ("b", 2, 4, 3)]
    assert [r.packet_id for r in windows.packets(d, "o", ["i"], "v", 2).orderBy("i").collect()] == ["a-part-001", "a-part-001", "b-part-001", "b-part-001", "b-part-002", "a-part-002"]
    assert [r.p for r in windows.previous_where(d, "o", ["i"], F.col("i"), F.col("v") == "b", "p").orderBy("i").collect()] == [None, None, None, 2, 3, 4]
    n = windows.neighbours(d, "o", ["i"], "i").where("i = 1").first()
    assert (n.before, n.after) == ([0], [2, 3])
    b = spark.createDataFrame([("m", 1, [2, 3]), ("m", 2, [2]), ("m", 3, [2])], "o string, pos int, v array<int>")
    assert rows(windows.best(b, "o", "v"), "pos") == [(2,)]


def test_validation(spark):
    spans = spark.createDataFrame([("a", 0, 3), ("a", 3, 5), ("b", 0, 2), ("b", 3, 4)], "o string, start int, end int")
    length = spark.createDataFrame([("a", 5), ("b", 5), ("c", 0), ("d", 1)], "o string, length int")
    assert rows(validate.partition_gaps(spans, "o", length), "key") == [("b",), ("b",), ("d",)]
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {("cover.missing", "1"), ("cover.extra", "3")} <= set(rows(validate.exact_cover(a, b, "k"), "code", "key"))
    refs = spark.createDataFrame([("rule", "x"), ("rule", "y"), ("table", "x"), ("external", "z")], "kind string, ref_id string")
    objects = spark.createDataFrame([("rule", "x"), ("rule", "y"), ("rule", "y")], "kind string, object_id string")
    assert rows(validate.reference_targets(refs, objects), "code", "key") == [("ref.ambiguous", "rule:y"), ("ref.unresolved", "table:x")]
    gate = validate.Gate()
    gate.add("none", lambda: validate.none(spark))
    gate.add("dup", lambda: validate.duplicates(objects, "kind", "object_id"))
    assert rows(gate.report(spark)) == [("dup", False, 1), ("none", True, 0)]


def test_corrections(spark):
    page = "Intro\nP-31.1, Page 4 [corrected 1.2.2024; modified 3 March 2024]\n<span style='color:blue'>for</span> old text<br>read new text\nP-2 [added 5 May 2023]\nSee P-9.1 instead.\ndelete this section\n"
    n = corrections.notices(spark.createDataFrame([("p", page)], "page string, text string"))
    assert rows(corrections.events(n), "event", F.col("event_date").cast("string")) == [("added", "2023-05-05"), ("corrected", "2024-02-01"), ("modified", "2024-03-03")]
    assert rows(corrections.operations(n).where("overlay_id like '%1'"), "kind", "before_text", "after_text") == [("replacement", "old text", "new text")]
    second = corrections.operations(n).where("overlay_id like '%2'")
    assert [(r.kind, r.before_text or r.instruction_text) for r in second.orderBy("ordinal").collect()] == [("instruction", "See P-9.1 instead."), ("deletion", "this section")]
    assert ("rule", "P-31.1") in rows(corrections.selectors(n), "kind", "value") and ("page", "4") in rows(corrections.selectors(n), "kind", "value")
    assert rows(corrections.references(n), "rule_id", "relation") == [("P-9.1", "see")]


PAGE = (
    '<h2><a name="P-1">P-1</a> Héad</h2>\r\n<p>See P-2.1 and <a href="b.html#P-3">P-3</a>.</p>\r\n<!-- <a name="P-8">P-8</a> P-9 -->'
    "\r\n<p><a name=\"P-2\">P-2</a> text <a href='c.html'>label only</a> <a href=x.html>open<p>next</p>\r\n<hr>P-7 foot</body>"
)


def test_sections_and_occurrences(spark):
    raw = spark.createDataFrame([("d", bytearray(PAGE.encode()))], "document_id string, raw binary")
    s = references.sections(raw).orderBy("ordinal").collect()
    assert [r.rule_id for r in s] == ["P-1", "P-2"]
    data = PAGE.encode()
    assert data[s[0].start_byte : s[0].end_byte].startswith(b"<h2>") and data[s[1].end_byte :].startswith(b"<hr>")
    f = spark.createDataFrame([(r.rule_id, data[r.start_byte : r.end_byte].decode()) for r in s], "rule_id string, html string")
    got = rows(references.occurrences(f), "rule_id", "kind", "text", "cited", "href")
    assert got == [("P-1", "href", "P-3", "P-3", "b.html#P-3"), ("P-1", "text", "P-2.1", "P-2.1", None), ("P-2", "href", "label only", None, "c.html"), ("P-2", "href", "open", None, "x.html")]


def test_resolution(spark):
    occ = spark.createDataFrame([("1", "R", "http://h/a.html", "b.html#x", "P-3"), ("2", "R", "http://h/a.html", "b.html", None), ("3", "R", "http://h/a.html", None, "P-2"), ("4", "R", "http://h/a.html", None, "P-3.99"), ("5", "R", "http://h/a.html", None, "P-77")], "occurrence_id string, rule_id string, base_url string, href string, cited string")
    frags = spark.createDataFrame([("B", "P-3", "X"), ("B", "P-4", "x"), ("A", "P-2", "y")], "document_id string, rule_id string, anchor string")
    docs = spark.createDataFrame([("A", "a.html", "P-2"), ("B", "B.html", "P-3")], "document_id string, file string, major string")
    r = references.resolve(occ, frags, docs)
    assert rows(r, "occurrence_id", "resolution_basis", F.coalesce("target_rule", F.lit("")), F.coalesce("target_document", F.lit(""))) == [("1", "href_anchor", "P-3", "B"), ("2", "href_document", "", "B"), ("3", "reference_text", "P-2", "A"), ("4", "inferred_document", "", "B"), ("5", "unresolved", "", "")]
    over = spark.createDataFrame([("5", "alias", "P-2")], "occurrence_id string, resolution_kind string, resolved_rule_id string")
    assert validate.passed(references.overlay_violations(r, over))
    assert ("5", "rule", "P-2") in rows(references.project(r, over), "occurrence_id", "kind", "target")


def test_clauses(spark):
    n = spark.createDataFrame([("r", 0, "heading", "P-1 Title"), ("r", 1, "paragraph", "One. Two; three."), ("r", 2, "image", "")], "rule_id string, ordinal int, kind string, text string")
    u = clauses.clauses(n)
    assert [(r.unit_id, r.unit_kind, r.text) for r in u.orderBy("ordinal").collect()] == [("r:clause:0001", "heading_text", "P-1 Title"), ("r:clause:0002", "sentence", "One."), ("r:clause:0003", "sentence", "Two;"), ("r:clause:0004", "sentence", "three."), ("r:clause:0005", "image_payload", "")]
    assert validate.passed(clauses.uncovered(n, u))
    assert not validate.passed(clauses.uncovered(n, u.where("ordinal <> 3")))
    assert one(spark, "(iv)", clauses.list_family) == "lower_roman" and one(spark, "Note 2: x", clauses.cue) == "note"


def test_packets(spark):
    r = spark.createDataFrame([("c", i, f"P-{1 + i // 5}.{i}", "ch") for i in range(12)], "corpus string, pos int, rule_id string, chapter string")
    a = packets.assign(r, size=3)
    assert validate.passed(packets.violations(a, r, 3))
    assert rows(packets.manifest(a), "packet_id", "n_rules")[:2] == [("P-1-part-001", 3), ("P-1-part-002", 2)]
    e = spark.createDataFrame([("P-1.0", "P-3.11")], "source string, target string")
    c = packets.context(a, e)
    assert ("P-1-part-001", "P-3.11", ["outgoing"]) in rows(c) and ("P-1-part-001", "P-1.3", ["neighbour"]) in rows(c)


CHUNK = '{"rules":[{"id":"r1","clause_ids":["c1"],"body":{"ref":{"kind":"table","id":"t1"}}},{"id":"r2","links":[{"ref":{"kind":"rule","id":"gone"}}]}],"tables":[{"id":"t1","clause_ids":["c9"]}]}'


def test_ir(spark):
    flat = ir.flatten(spark.createDataFrame([("k", CHUNK)], "chunk_id string, json string"))
    assert rows(ir.objects(flat), "kind", "object_id", "path") == [("rule", "r1", "/rules/0"), ("rule", "r2", "/rules/1"), ("table", "t1", "/tables/0")]
    found = ir.check(flat, spark.createDataFrame([("c1",)], "clause_id string"))
    assert rows(found, "code", "key") == [("clause.unknown", "c9"), ("ref.unresolved", "rule:gone")]
    m = ir.metrics(flat).where("chunk_id is null").first()
    assert (m["rule"], m["table"], m["refs"]) == (2, 1, 2)
    assert ir.resolve_pointer({"a/b": [{"~": 5}]}, ir.pointer(["a/b", 0, "~"])) == 5
    x = spark.createDataFrame([("e1", "t", 1, 1, 2), ("e2", "t", 2, 2, 1)], "exception_id string, target string, specificity int, source_order int, ordinal int")
    assert validate.passed(ir.exception_order(x))
    assert not validate.passed(ir.exception_order(x.withColumn("ordinal", 3 - F.col("ordinal"))))
