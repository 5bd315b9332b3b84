import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from lexweave.llm import chat, pii, queries

KIND = "conv_id long, turn long, role string, text string"
NASTY = ["", "plain", "<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "<|", "\\", "\n\n<|im_end|>\n", "é🧬", "a\\nb", None]


def conversations(seed=0, n=40):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant", "system", "assistant", "we<|ird\nro\\nle", None]), rng.choice(NASTY)) for c in range(n) for t in range(rng.randrange(1, 8))]


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c)
        loss = "".join(x for _, r, x in own if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        out[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back(spark):
    rows = conversations() + [(1000, None, "user", "x"), (1000, 3, "assistant", "y"), (1000, 3, "assistant", "y"), (1001, 0, "user", "only"), (1002, 0, "assistant", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], KIND + ", example int")
    ex = chat.examples(chat.turns(df))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(ex).collect()}
    assert got == brute(rows)
    for r in ex.collect():
        assert r.formatted.count(chat.START) == r.n_turns == r.formatted.count(chat.END)
        assert r.formatted[r.loss_end :] == chat.END + "\n"
    n_assistant = sum(r[2] == "assistant" for r in rows)
    assert n_assistant <= ex.count() <= n_assistant + len(got)
    assert chat.digests(chat.examples(chat.turns(df.limit(0)))).count() == 0


def test_prefix_expansion(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", "a2"), (1, 4, "user", "tail")], KIND)
    ex = chat.examples(chat.turns(df)).orderBy("example").collect()
    assert [(r.n_turns, r.formatted[r.loss_start : r.loss_end], r.last) for r in ex] == [(2, "a1", False), (4, "a2", False), (5, "", True)]
    assert ex[1].formatted.startswith(ex[0].formatted)


def test_long_conversation(spark):
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"turn {i} <|im_start|>") for i in range(600)]
    got = chat.digests(chat.examples(chat.turns(spark.createDataFrame(rows, KIND)))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == brute(rows)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and brute_luhn(re.sub(r"\D", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15),
}


def brute_luhn(s):
    return sum(sum(divmod(int(ch) * (1 + i % 2), 10)) for i, ch in enumerate(reversed(s))) % 10 == 0


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(BASE.values()) for m in re.finditer(p, text) if ok(m.group())]
    return sorted(found)


CASES = [
    None, "", "no data", "mail a.b@c.de and x_y@z-1.co.uk. done", "a@b.c_d@e.f", "aa@bb@cc.dd", "a@b.c@d.e", "@x.y", "1.2.3.4 and 256.1.1.1 and 0255.0.0.01 and 1.2.3.4.5.6.7.8", "1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111 1111  1111 1111", "card 5500005555555559x", "+1 (921) 555-8394", "+49 30 12345678 9", "+1+1 234 567 8901", "+12345", "é🧬 a@b.cd 1.1.1.1",
    "0" * 50 + ".0.0.1", "9" * 3000, "a" * 5000 + "@" + "b" * 5000, "+" + "1 " * 4000, "1.1.1.1.", "x@y.z" * 300,
]


def test_base_spans(spark):
    rng = random.Random(3)
    parts = ["a@b.cd", " ", "1.2.3.4", "+1 234 567 8901", "4111111111111111", "-", ".", "@", "9", "x", "é", "5500-0055-5555-5559", "\n", "_"]
    texts = CASES + ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.spans(df)
    got = {r.doc_id: [(s["start"], s["kind"], s["end"]) for s in r.base] for r in found.collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_spans(t or ""), t
    for r in found.collect():
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}


def test_method_adds_spans_and_masks(spark):
    loose = ["write to jane [at] example [dot] com today", "contact me: joe (at) mail (dot) org", "call my phone 555-123-4567 now", "tel: (030) 1234 5678 please"]
    decoys = ["order id 123 456 7890 of the invoice", "we met at noon.Then we left", "version 10 . 2 . 3 . 4 of the table"]
    df = spark.createDataFrame(list(enumerate(loose * 30 + decoys * 60)), "doc_id long, text string")
    found = pii.spans(df)
    rows = {r.text: r for r in found.withColumn("masked", pii.mask(found["text"], "spans")).collect()}
    assert "<EMAIL>" in rows[loose[0]].masked and "jane" not in rows[loose[0]].masked
    assert sum(bool(rows[t].spans) for t in loose) >= 3
    assert not any(rows[t].spans for t in decoys)


def test_masks(spark):
    df = spark.createDataFrame([(1, "é a@b.cd, +1 234 567 8901; end"), (2, None), (3, "clean")], "doc_id long, text string")
    found = pii.spans(df)
    got = {r.doc_id: r.m for r in found.select("doc_id", pii.mask(found["text"], "spans").alias("m")).collect()}
    assert got == {1: "é <EMAIL>, <PHONE>; end", 2: None, 3: "clean"}
    assert pii.spans(df.limit(0)).count() == 0


def test_reliabilities_are_recovered():
    rng = random.Random(1)
    counts = {}
    rates = ((0.95, 0.05), (0.9, 0.2), (0.8, 0.3), (0.5, 0.02), (0.05, 0.4))
    for _ in range(20000):
        true = rng.random() < 0.3
        v = tuple(int(rng.random() < (p if true else q)) for p, q in rates)
        x = (int(true), *([0] * (len(pii.FEATURES) - 1)))
        counts[(3, v, x, False)] = counts.get((3, v, x, False), 0) + 1
    prior, rate = pii.estimate(counts)[3]
    assert abs(prior - 0.3) < 0.05 and all(abs(a - p) < 0.07 and abs(b - q) < 0.07 for (a, b), (p, q) in zip(rate, rates, strict=True))
    bias, w = pii.classifier(counts)[3]
    assert bias < 0 < w[0] and bias + w[0] > 0  # the classifier's own feature stands for what the votes agree on


def test_numbers_that_run_together_are_found(spark):
    """A phone number that runs into a card number fails as one match; the method finds both, and leaves decoys alone."""
    base = ["call +1 (921) 555-8394 or so", "pay with 4111111111111111 there", "from a.b@c.de to 10.1.2.3 now"]
    fused = "my +1 (921) 555-8394 4111111111111111 here"
    decoys = ["order id 4111111111111112 there", "number 1234567 89 12 here", "serial 111122223333444455556666 there", "at 12:30 noon.Then"]
    df = spark.createDataFrame(list(enumerate(base * 40 + [fused] * 3 + decoys * 10)), "doc_id long, text string").withColumn("_rough", F.lit("own")).withColumn("kind", F.lit(1))
    got = pii.spans(df)
    assert "_rough" in got.columns
    rows = {r.text: r for r in got.collect()}
    assert rows[fused].base == [] and [tuple(x) for x in rows[fused].spans] == [(3, 3, 20), (21, 2, 37)]
    assert not any(rows[t].spans for t in decoys)
    assert all([tuple(x) for x in rows[t].spans] == [tuple(x) for x in rows[t].base] for t in base)


def test_query_digest(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op8_pii(spark, str(tmp_path)).collect():
        want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(CASES[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no tables here")
    c = duckdb.connect()
    for f in folder.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = queries.QUERIES[name](spark, str(folder))
    want = c.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(map(str, got.select(*names).collect())) == sorted(f"Row({', '.join(f'{n}={v!r}' for n, v in zip(names, r, strict=True))})" for r in want.fetchall())
