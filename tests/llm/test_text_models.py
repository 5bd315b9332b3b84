import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lexweave.llm import langid, queries, toxicity

WORDS = {"aa": "the of and to in house river stone walks", "bb": "der die und zu haus fluss stein geht nicht", "cc": "el la de que casa piedra anda rio pero"}


def corpus(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randrange(5, 60))), lang))
    return out


def test_language_of_held_out_texts(spark):
    df = spark.createDataFrame(corpus(600), "doc_id long, text string, lang string")
    model = langid.train(df.where("doc_id % 4 <> 2"), bound=100)
    held = df.where("doc_id % 4 = 2")
    got = held.withColumn("p", langid.classify_column(held, model)).agg(F.avg((F.col("p.lang_pred") == F.col("lang")).cast("int")), F.avg(F.col("p.rejected").cast("int"))).first()
    assert got[0] > 0.99 and got[1] == 0
    assert len(model.centroids) == 3 * langid.CENTROIDS


def test_language_edge_cases(spark):
    df = spark.createDataFrame(corpus(300), "doc_id long, text string, lang string")
    model = langid.train(df, bound=100)
    odd = spark.createDataFrame([(None,), ("",), ("123 !?",), ("日本語のテキスト" * 200,), ("the house " * 40000,)], "text string")
    got = [r.p for r in odd.select(langid.classify_column(odd, model).alias("p")).collect()]
    assert [g.lang_pred for g in got[:3]] == ["und"] * 3 and all(g.rejected for g in got[:3])
    assert got[3].lang_pred in WORDS and got[3].rejected
    assert got[4].lang_pred == "aa" and not got[4].rejected and 0 <= got[4].score <= 1
    empty = langid.train(df.limit(0))
    assert odd.limit(3).select(langid.classify_column(odd, empty).alias("p")).first().p.lang_pred == "und"


def test_rejection_of_unlearned_languages_and_junk(spark):
    rng = random.Random(7)
    df = spark.createDataFrame([(i, (t + " ") * 8, la) for i, t, la in corpus(600)], "doc_id long, text string, lang string")
    model = langid.train(df, bound=100)
    assert (model.floor > 0).all()  # every band of every language has one, the short ones too
    strange = ["Это предложение написано на русском языке", "这是一个用中文写的句子", "tämä on suomenkielinen lause", "xqzj kvwq zzxj qqkv", "".join(rng.choices("qxzjkvwy", k=300))]
    assert all(model.classify(t)[2] for t in strange) and all(model.classify(t * 20)[2] for t in strange)
    clean = ["the house", "der fluss und das haus", "el rio de la casa", "the river of the house and the stone in the house " * 3]
    assert not any(model.classify(t)[2] for t in clean) and [model.classify(t)[0] for t in clean] == ["aa", "bb", "cc", "aa"]


def test_language_against_brute_force(spark):
    """The score is the largest cosine of TF-IDF vectors, made here of strings and dictionaries."""
    model = langid.train(spark.createDataFrame(corpus(300), "doc_id long, text string, lang string"), bound=50)
    for text in ("The river, of 2 houses!", "nicht Haus", "Ein é x", "a"):
        words = "".join(ch if ch.isalpha() else " " for ch in text.lower()).split()
        grams = Counter(g for w in words for p in [f" {w} "] for k in range(1, len(p) - 1) for g in (p[k], p[k - 1 : k + 1] + "|", p[k - 1 : k + 2] + "||"))
        slots = {}
        for g, n in grams.items():  # one text of this gram alone shows its slot
            a, b, c = (ord(x) if x != " " else 0 for x in (g.rstrip("|") + "   ")[:3])
            k, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
            raw = {0: a, 1: a * 0x110000 + b + (1 << 42), 2: (a * 0x110000 + b) * 0x200000 + c + (1 << 63)}[g.count("|")] * k & mask
            raw = (raw ^ raw >> 29) * 0xBF58476D1CE4E5B9 & mask
            slots[raw >> 51] = slots.get(raw >> 51, 0) + n
        v = {s: math.log1p(n) * float(model.idf[s]) for s, n in slots.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        cos = [sum(x * float(c[s]) for s, x in v.items()) / size for c in model.centroids]
        lang, score, _ = model.classify(text)
        assert abs(score - max(cos)) < 1e-5 and lang == model.languages[model.of[cos.index(max(cos))]]


def test_toxicity_score_against_brute_force(spark):
    d, lab = frames(spark, 400, 5)
    model = toxicity.train(d, lab)
    assert model.pairs >= 400  # every labelled text has counterfactuals, with or without a group term in it
    weight = dict(zip(model.ids.tolist(), model.weights.tolist(), strict=True))
    for text in ("the idiotic house, the HOUSE", "wretch", "", "muslims of the river"):
        words = re.findall(r"[^\W\d_]+", text.lower())
        found = Counter(f for w in words for f in toxicity.word_features(w))
        total = 1 + sum(found.values())
        z = model.bias + sum(math.log1p(n * 3000 / total) * weight.get(f, 0.0) for f, n in found.items())
        assert abs(model.score(text) - 1 / (1 + math.exp(-z))) < 1e-9


def test_registered_queries(spark, tmp_path):
    d, lab = frames(spark, 200, 6)
    langs = F.element_at(F.array(F.lit("aa"), F.lit("bb")), (F.col("doc_id") % 2 + 1).cast("int"))
    docs = d.unionByName(spark.createDataFrame([(1000, None), (1001, ""), (1002, "same text here"), (1003, "same text here")], "doc_id long, text string")).withColumn("lang", langs).withColumn("source", F.lit("s")).withColumn("n_chars", F.char_length("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    lab.withColumn("quality", F.lit(1)).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None)], "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    run = lambda name: queries.QUERIES[name](spark, str(tmp_path))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in run("op1_embedding_dedup").collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True)}
    got = {r.doc_id: r for r in run("op2_simhash_dedup").collect()}
    assert got[1000].fingerprint == "0" * 16 == got[1001].fingerprint and got[1001].component_id == 1000 and got[1003].component_id == 1002
    crc = lambda i, n: zlib.crc32(str(i).encode()) % n
    got = {r.doc_id: r for r in run("op3_language_id").collect()}
    assert all(r.held_out == (crc(i, 4) == 2) and 0 <= r.score <= 1 for i, r in got.items()) and got[1000].lang_pred == got[1001].lang_pred == "und" and got[3].lang_pred in ("aa", "bb")
    got = {r.doc_id: r for r in run("op4_toxicity").collect()}
    assert all(r.held_out == (crc(i, 3) == 1) and r.predicted == int(r.score >= 0.7) for i, r in got.items()) and len(got) == 204
    got = run("op6_packing").where("doc_id = 1001").first()
    assert (got.start, got.length, got.doc_tokens, got.ids_crc32) == (0, 1, 1, zlib.crc32(bytes(4)))
    got = run("op7_sentencepiece")
    assert got.count() == 204 and got.where("not round_trip").count() == 0
    got = {r.doc_id: r for r in run("op9_fingerprints").collect()}
    assert got[1002].fingerprint == got[1003].fingerprint and got[1002].near_next == 1.0 and got[1000].n_chars == 0
    got = {r.doc_id: r for r in run("op10_token_counts").collect()}
    assert got[1001].n_tokens == 0 and got[1002].n_chars == 14 and got[1002].n_tokens > 0


def labelled(n, seed, bias=0.0):
    """Toxic texts hold insults; group terms stand in both, but with ``bias`` more often in toxic ones."""
    rng = random.Random(seed)
    filler = WORDS["aa"].split() + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = rng.choices(filler, k=rng.randrange(20, 80))
        if toxic:
            words += rng.choices(["idiotic", "wretch", "scummy"], k=1)
        if rng.random() < (0.1 + bias if toxic else 0.1):
            words.append(rng.choice(["muslims", "women", "immigrants"]))
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, n, seed, bias=0.0):
    d, lab = labelled(n, seed, bias)
    return spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, toxic int")


def test_toxicity_on_held_out_texts(spark):
    d, lab = frames(spark, 1500, 2)
    model = toxicity.train(d, lab.where("doc_id % 3 <> 1"))
    got = d.where("doc_id % 3 = 1").withColumn("s", toxicity.score_column(d, model)).join(lab, "doc_id")
    r = got.agg(F.avg(F.when(F.col("toxic") == 1, (F.col("s") >= 0.7).cast("int"))), F.avg(F.when(F.col("toxic") == 0, (F.col("s") >= 0.7).cast("int")))).first()
    assert r[0] > 0.95 and r[1] < 0.02


def test_counterfactuals_spare_neutral_mentions(spark):
    d, lab = frames(spark, 1500, 3, bias=0.75)
    neutral = ["the house of muslims and the river", "women walks to the stone house", "immigrants in the house and the river"]
    plain, fair = (toxicity.train(d, lab, penalty=p) for p in (0.0, 20.0))
    without = [toxicity.Model.score(fair, t.replace("muslims", "people").replace("women", "people").replace("immigrants", "people")) for t in neutral]
    assert sum(fair.score(t) for t in neutral) < sum(plain.score(t) for t in neutral)
    spread = lambda m: max(m.score(f"the {g} of the river") for g in ("muslims", "women", "immigrants", "jews")) - min(m.score(f"the {g} of the river") for g in ("muslims", "women", "immigrants", "jews"))
    assert spread(fair) < 0.5 * spread(plain) and all(0 <= x <= 1 for x in without)


def test_swapping():
    assert toxicity.swapped("nothing here") == []
    out = toxicity.swapped("The women met.")
    assert len(out) == 2 and all("women" not in t and t.startswith("The ") for t in out)


def test_toxicity_edge_cases(spark):
    d, lab = frames(spark, 300, 4)
    odd = d.limit(0).unionByName(spark.createDataFrame([(1, None), (2, ""), (3, "x" * 100000), (None, "idiotic"), (5, "!!")], "doc_id long, text string"))
    model = toxicity.train(d, lab)
    got = [r.s for r in odd.select(toxicity.score_column(odd, model).alias("s")).collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1]
    for some in (lab.limit(0), lab.where("toxic = 0"), lab.withColumn("toxic", F.lit(None).cast("int"))):
        m = toxicity.train(d, some)
        assert 0 <= m.score("idiotic") < 0.7
    twice = toxicity.train(d, lab.unionByName(lab))
    assert abs(twice.score("the idiotic house") - model.score("the idiotic house")) < 1e-9


def test_remainder(spark):
    import zlib

    got = spark.range(50).select("id", queries.remainder("id", 4).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 4 for r in got)


def test_long_words_count_to_their_end():
    run = "".join(chr(0x4E00 + k) for k in range(60))
    assert set(toxicity.word_features(run)) != set(toxicity.word_features(run[:40] + "xyz" + run[43:]))
    assert set(toxicity.word_features("idiot")) & set(toxicity.word_features("a" * 30 + "idiot"))
    assert toxicity.zlib.crc32(run[40:44].encode()) % toxicity.SPACE in toxicity.word_features(run)
