import random
import re

import corpus_pipeline as P
from lexweave.llm import langid, toxicity
from lexweave.llm.queries import remainder
from test_similar import brute, edited
from test_text_models import WORDS

EMAIL = "jo.hn@mail7.example.com"


def tables(spark, folder):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(260):
        lang = rng.choice(list(WORDS))
        words = [f"{rng.choice(WORDS[lang].split())}{rng.choice(['', 'er', 'a', 'ion'])}" for _ in range(rng.randrange(30, 120))]
        if i % 6 == 0:
            words += ["scummy", "idiotic"]
        if i % 10 == 1:
            words.insert(5, EMAIL)
        if i > 40 and i % 9 == 2:
            words = edited(rng, docs[rng.randrange(40)][1].split(), 0.001)
        if i > 40 and i % 9 == 3:
            words = docs[rng.randrange(40)][1].split()
        docs.append((i, " ".join(words), lang, f"src{i % 3}", 0))
        labels.append((i, 1, int("idiotic" in words)))
    docs += [(900, None, "aa", None, None), (901, "", None, "s", 0), (902, "12 34", "bb", "s", 5), (903, "the house " * 5000, "aa", "s", 50000)]
    docs = [(i, t, la, s, len(t) if t is not None else None) for i, t, la, s, _ in docs]
    docs = [(*r, r[0] * 2, "own", 0.5) for r in docs]
    kind = "doc_id long, text string, lang string, source string, n_chars long, spans long, base string, score double"  # names that operators use too
    spark.createDataFrame(docs, kind).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_every_stage_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    docs = tables(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    kept = sorted(docs, key=lambda r: r[0])
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, now, folder)
        if name == "toxicity":
            m = toxicity.train(now, labels.where(remainder("doc_id", 3) != 1))
            kept = [r for r in kept if m.score(r[1]) < toxicity.THRESHOLD]
            assert not any("idiotic" in (r[1] or "") for r in kept if r[0] % 6 == 0)
        elif name == "language":
            m = langid.train(now.where(remainder("doc_id", 4) != 2))
            kept = [r for r in kept if not m.classify(r[1])[2]]
            assert {r[0] for r in kept}.isdisjoint({900, 901, 902}) and 903 in {r[0] for r in kept}
        elif name == "simhash":
            root, _ = brute([r[1] for r in kept])
            kept = [r for i, r in enumerate(kept) if root[i] == i]
        elif name == "pii":
            masked = [(r[0], re.sub(re.escape(EMAIL), "<EMAIL>", r[1]), *r[2:4]) for r in kept]
            kept = [(*r, len(r[1]), r[0] * 2, "own", 0.5) for r in masked]
            assert any("<EMAIL>" in r[1] for r in kept)
        if k < len(P.STAGES) - 1:
            assert out.columns == now.columns
            assert rows(out) == kept, name
            out.write.parquet(f"{folder}/{k}")
            now = spark.read.parquet(f"{folder}/{k}")
        else:
            assert {r.doc_id for r in out.collect()} == {r[0] for r in kept}
    whole = P.run(spark, folder)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in whole.collect()) == sorted((r.doc_id, r.start, r.ids_crc32) for r in out.collect())


def test_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path / "full"))
    for t in ("documents", "labels"):
        spark.read.parquet(str(tmp_path / f"full/{t}.parquet")).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
