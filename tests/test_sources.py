import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lexweave import catalog, cli
from lexweave.functions import html
from lexweave.operators import validate
from lexweave.sources import canonical, files
from lexweave.streaming.incremental import run_incrementally


def codes(df):
    return sorted(r.code for r in df.collect())


def test_canonical_json(spark, tmp_path):
    good = canonical.dumps({"b": [1, None], "a": "é"})
    for name, body in {"good": good, "order": '{"b": 1, "a": 2}', "twice": '{"a": 1, "a": 2}', "nan": '{"a": NaN}'}.items():
        (tmp_path / f"{name}.json").write_text(body, encoding="utf-8")
    got = {r.path.rpartition("/")[2]: r.problem for r in canonical.read_strict(spark, str(tmp_path)).collect()}
    assert got["good.json"] is None and got["order.json"] == "not canonical"
    assert got["twice.json"].startswith("invalid") and got["nan.json"].startswith("invalid")
    with pytest.raises(ValueError):
        canonical.dumps(float("nan"))


def test_store(spark, tmp_path):
    n = spark.createDataFrame([("d1", 0, "a"), ("d1", 1, "b"), ("d2", 0, "c")], "document_id string, pos int, text string")
    path = str(tmp_path / "s")
    m = canonical.write_store(n, path)
    assert sorted((r.document_id, r.rows) for r in m.collect()) == [("d1", 2), ("d2", 1)]
    assert validate.passed(canonical.verify_store(spark, path))
    assert canonical.read_store(spark, path, ["d2"]).count() == 1
    n.withColumn("text", F.upper("text")).where("document_id = 'd1'").write.mode("overwrite").partitionBy("document_id").parquet(f"{path}/nodes")
    assert codes(canonical.verify_store(spark, path)) == ["shard.digest", "shard.missing"]


def test_source_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.html").write_bytes(b"abc")
    spec = [{"filename": "a.html", "url": "u", "sha256": hashlib.sha256(b"abc").hexdigest(), "byte_length": 3}, {"filename": "b.html", "url": "u", "sha256": "00", "byte_length": 0}]
    (tmp_path / "spec.json").write_text(json.dumps(spec))
    s = files.specs(spark, str(tmp_path / "spec.json"))
    assert codes(files.spec_violations(s)) == ["spec.digest", "spec.size"]
    assert codes(files.verify(s, files.digests(spark, str(tmp_path / "in")))) == ["file.missing"]
    (tmp_path / "in/a.html").write_bytes(b"abcd")
    assert codes(files.verify(s, files.digests(spark, str(tmp_path / "in")))) == ["file.digest", "file.length", "file.missing"]
    out = str(tmp_path / "out")
    assert files.commit(spark.range(3), out) == "written" and spark.read.parquet(out).count() == 3
    with pytest.raises(validate.ValidationError):
        files.commit(spark.range(1), out, files.spec_violations(s))


def test_lexer_and_nodes(spark):
    text = '<p title="a > b">x<!-- <td> --><table><tr><td>1<td>2</table><script>"</p>"</script><img src=y>'
    kinds = [(t.kind, t.name) for t in html.lex(text)]
    assert ("tag", "table") in kinds and ("comment", "") in kinds
    assert "".join(text[t.start : t.end] for t in html.lex(text)) == text
    assert [n for n, _, _ in html.census(text)].count("td") == 2
    tree = [(n[3], n[2], n[7]) for n in html.nodes(text)]
    assert tree[0] == ("paragraph", "/0", "x") and [t for k, _, t in tree if k == "table_cell"] == ["1", "2"]
    seen, origin = html.visible("<p>A&amp;B</p>  <b>c</b>")
    assert seen == "A&B c" and len(origin) == len(seen)
    assert html.attributes("<a href='x' href=y z>")["href"][0] == "x"


def test_incremental(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    run_incrementally(stream, lambda d: d.groupBy().sum("id"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first()[0] == 10


def test_cli(capsys):
    assert cli.main(["CCO"]) == 0 and '"ethanol"' in capsys.readouterr().out
    assert cli.main(["name", "CC.O"]) == 1
    assert cli.main(["queries"]) == 0 and "xref_edges" in capsys.readouterr().out


def test_cli_tables(spark, tmp_path, capsys):
    corpus = [{"rule_id": "P-1", "title": "one", "source_chapter": "c", "rule_type": "t", "applies_if": ["ring"], "depends_on": ["P-2"]}, {"rule_id": "P-2", "title": "two", "source_chapter": "c", "rule_type": "t", "unless": ["ring"], "depends_on": ["P-3"]}]
    (tmp_path / "r.json").write_text(json.dumps(corpus))
    path = str(tmp_path / "r.json")
    for args, word in ((["stats"], '"n":2'), (["search", "--query", "two"], "P-2"), (["get", "--id", "P-1"], "one"), (["deps", "--id", "P-1", "--depth", "2"], "P-3"), (["eval", "--fact", "a ring"], '"condition_score":1')):
        assert cli.main(["rules", args[0], path, *args[1:]]) == 0
        assert word in capsys.readouterr().out
    spark.createDataFrame([("d", 0, "a")], "document_id string, pos int, text string").write.parquet(str(tmp_path / "n"))
    assert cli.main(["store", "generate", str(tmp_path / "s"), "--nodes", str(tmp_path / "n")]) == 0
    assert cli.main(["store", "generate", str(tmp_path / "s")]) == 2
    (tmp_path / "spec.json").write_text(json.dumps([{"filename": "gone.html", "url": "u", "sha256": "0" * 64, "byte_length": 1}]))
    (tmp_path / "files").mkdir()
    (tmp_path / "files/x").write_text("x")
    assert cli.main(["sources", str(tmp_path / "spec.json"), str(tmp_path / "files")]) == 1 and "file.missing" in capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no tables here")
    c = duckdb.connect()
    for f in folder.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = catalog.QUERIES[name](spark, str(folder))
    want = c.execute(catalog.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(key(r) for r in got.select(*names).collect()) == sorted(key(r) for r in want.fetchall())
