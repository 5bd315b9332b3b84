import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexweave.llm import fingerprint, packing, sentencepiece_viterbi, token_counts, tokenizer

pytest.importorskip("public_tokenizers")
ALPHABET = ["a", " ", "\n", "'", "re", "'s", " 12", "é", "  ", "\n\n", "  x", "word", "!!", "ß", "\t", "日本", "🧬", "<|endoftext|>", "▁", " "]
ODD = ["", " ", "  a  b ", "ﬁ１é\n\t\x00x", "日本語" * 5, "a" * 500, " " * 300 + "x", "<s></s><unk><0x41>", "Straße ÜBER ñandú", "▁a ▁ b", "def f(x):\n        return x"]


def texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(120))) for _ in range(n)] + ODD


def library_ids(text):
    from tokenizers import Tokenizer

    t = library_ids.__dict__.setdefault("t", Tokenizer.from_file(tokenizer.default_path()))
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


def test_byte_bpe_equals_the_library():
    for t in texts(400):
        assert tokenizer.encode(tokenizer.default_path(), t) == library_ids(t)


def test_pieces_equal_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_viterbi.default_path())
    m = sentencepiece_viterbi.model(sentencepiece_viterbi.default_path())
    rng = random.Random(2)
    some = texts(300) + ["".join(rng.choices(list(m.ids), k=rng.randrange(1, 12))) for _ in range(1000)]
    got = m.encode(some)
    assert got == [sp.encode(t) for t in some]
    assert [m.decode(x) for x in got] == [t.replace("▁", " ") for t in some]


def test_piece_columns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, *ODD])], "decoded_id int, text string")
    got = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(df)).orderBy("decoded_id").collect()
    assert [r.decoded for r in got] == [(r.text or "").replace("▁", " ") for r in got]
    assert got[0].ids == [] and sentencepiece_viterbi.encode(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=200), st.lists(st.tuples(st.integers(-3, 400), st.integers(0, 60), st.lists(st.sampled_from(ALPHABET), max_size=20)), max_size=5))
def test_counts_follow_edits(start, edits):
    path = tokenizer.default_path()
    t = token_counts.TokenTree("".join(start), path)
    for at, length, new in edits:
        t.edit(at, at + length, "".join(new))
        assert t.count == len(library_ids(t.text))
        assert sum(c for c, _ in t.runs()) == len(t.text)


def test_inner_sums_are_spliced():
    rng, path = random.Random(3), tokenizer.default_path()
    t = token_counts.TokenTree(" ".join(f"word{rng.randrange(999)}" for _ in range(60000)), path)
    assert len(t.chars) >= 3
    for _ in range(30):
        t.summed, t.reencoded = 0, 0
        at = rng.randrange(len(t.text))
        t.edit(at, at + rng.choice([0, 3, 2000]), rng.choice(["", "xy z", "many words in here " * 200]))
        assert t.summed < 60 and t.reencoded < 10000  # of over 3,700 leaves and 230 nodes
        for k in range(1, len(t.chars)):
            ends = [0, *np.cumsum(t.kids[k]).tolist()]
            assert ends[-1] == len(t.chars[k - 1]) and all(0 < x <= 2 * token_counts.FAN for x in t.kids[k])
            assert t.tokens[k] == [sum(t.tokens[k - 1][a:b]) for a, b in zip(ends, ends[1:])]
            assert t.chars[k] == [sum(t.chars[k - 1][a:b]) for a, b in zip(ends, ends[1:])]
    assert t.count == len(library_ids(t.text)) and len(t.chars[-1]) == 1


def test_very_long_runs(spark):
    """White space and words beyond what the engines' matchers or a table of prefixes could take."""
    path = tokenizer.default_path()
    odd = [" " * 2_000_000 + "x", "\n" * 1_000_000 + "a", "a" * 1_000_000, "ab\n" * 500_000 + "\n\n  c"]
    for t in odd:
        assert tokenizer.encode(path, t) == library_ids(t)
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").withColumn("edits", F.array(F.struct(F.lit(5).alias("start"), F.lit(7).alias("end"), F.lit("q").alias("text"))))
    want = {i: len(library_ids(t)) for i, t in enumerate(odd)}
    assert {r.doc_id: r.n for r in packing.pack(df).groupBy("doc_id").agg((F.sum("length") - 1).alias("n")).collect()} == want
    edited = {r.doc_id: r.n for r in token_counts.apply_edits(token_counts.build(df)).select("doc_id", F.col("edited.n_tokens").alias("n")).collect()}
    assert edited == {i: len(library_ids(t[:5] + "q" + t[7:])) for i, t in enumerate(odd)}
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=sentencepiece_viterbi.default_path())
    word = "".join(random.Random(5).choices("abcXYZ0189+/é日", k=300_000))
    got = sentencepiece_viterbi.encode(spark.createDataFrame([(word,)], "text string")).first().ids
    assert got == sp.encode(word)


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    monkeypatch.setattr(tokenizer, "PIECE", 40)
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b1", " ", "\n", "\n\n", "  ", "é", "日本", "1", "!", "\t", "'s", "\r\n", "_"]) for _ in range(300))
        assert len(tokenizer.pieces(t)) > 1 and "".join(tokenizer.pieces(t)) == t
        assert [i for p in tokenizer.pieces(t) for i in library_ids(p)] == library_ids(t)


def test_count_columns(spark):
    rows = [(i, t, [(1, 3, "XY"), (0, None, "new ")]) for i, t in enumerate(ODD)] + [(98, None, None), (99, "word " * 20000, [(50000, 50001, "q")])]
    df = spark.createDataFrame(rows, "id int, text string, edits array<struct<start:int,end:int,text:string>>")
    got = token_counts.apply_edits(token_counts.build(df)).withColumn("n", token_counts.count()).collect()
    for r in got:
        assert r.n == len(library_ids(r.text or "")) and r.edited.n_tokens == len(library_ids(r.edited.text))
        s = r.text or ""
        for start, end, new in r.edits or []:
            end = start if end is None else end
            start, end = min(start, len(s)), min(end, len(s))
            s = s[:start] + new + s[end:]
        assert r.edited.text == s
    assert next(r for r in got if r.id == 99).edited.reencoded < 2000


def test_packing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["word", "other", "längeres"], k=rng.choice([0, 3, 50, 400, 3000])))) for i in range(120)] + [(7, None), (7, "again"), (None, "no id"), (500, "w " * 60000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash"))
    got = packing.pack(df, with_ids=True).collect()
    ids = sorted(zlib.crc32(np.array([*library_ids(t or ""), 0], "<u4").tobytes()) for _, t in rows)
    whole = {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    single = {k: v for k, v in whole.items() if [s for s, _ in v].count(0) == 1}
    for (_, n), parts in single.items():
        joined = [x for _, p in sorted(parts, key=lambda x: x[0]) for x in p]
        assert len(joined) == n and zlib.crc32(np.array(joined, "<u4").tobytes()) in ids
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= packing.WINDOW
    assert sum(r.length for r in got) == sum(len(library_ids(t or "")) + 1 for _, t in rows)
    seqs = packing.sequences(packing.pack(df, with_ids=True)).collect()
    assert all(len(s.input_ids) == (s.n_used if s.n_used.bit_count() == 1 else packing.WINDOW) for s in seqs)
    assert packing.pack(df.limit(0)).count() == 0


def brute_best_fit(lengths, window):
    open_, out = [], []
    for n in lengths:
        fits = [w for w in open_ if w[0] >= n]
        if fits:
            w = min(fits, key=lambda w: w[0])
        else:
            w = [window]
            open_.append(w)
        out.append(w[0])
        w[0] -= n
    return out, len(open_)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_takes_the_tightest_window(lengths):
    lengths.sort(reverse=True)
    fit = packing.BestFit(64)
    before = [64 - fit.place(n)[1] for n in lengths]
    want, opened = brute_best_fit(lengths, 64)
    assert before == want and fit.count == opened


def test_fingerprint_is_a_multiset_hash():
    a, b, c = "first line here", "second line of text", "third, another one"
    fp = lambda *x: fingerprint.pack(fingerprint.vector("\n".join(x)))
    assert fp(a, b, c) == fp(c, a, b) and fp(a, a) != fp(a) and fp(a, b) != fp(a, c)
    assert fingerprint.insert(fp(a, b), c) == fp(b, c, a) and fingerprint.delete(fp(a, b, c), b) == fp(c, a)
    assert fp() == fingerprint.pack(fingerprint.vector(None)) == fingerprint.delete(fp(a), a)
    assert fingerprint.likeness(fp(a), fp(a)) == 1.0 and fingerprint.likeness(fp(), fp()) == 1.0 and fingerprint.likeness(fp(), fp(a)) == 0.0
    long = [f"line {i} with words w{i} v{i * 7} u{i * 3}" for i in range(400)]
    half = long[:200] + [f"other {i} things x{i} y{i * 5}" for i in range(200)]
    assert 0.3 < fingerprint.likeness(fp(*long), fp(*half)) < 0.7


def test_compare_edited(spark):
    import hashlib

    rng = random.Random(8)
    rows = [(3 * i, "\n".join(" ".join(rng.choices(["alpha", "beta", "Größe", "🧬"], k=6)) for _ in range(rng.randrange(6)))) for i in range(60)] + [(4, None), (5, "x"), (6, "longer text " * 3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprint.compare_edited(df).collect()}
    ordered = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    ids = [i for i, _ in ordered]
    for k, (i, t) in enumerate(ordered):
        if ids.count(i) > 1:
            continue
        t, n = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].fingerprint == fingerprint.pack(fingerprint.vector(t)).hex() and got[i].edited_fingerprint == fingerprint.pack(fingerprint.vector(e)).hex()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    one = fingerprint.compare_edited(spark.createDataFrame([(1, "ab")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint.compare_edited(df.limit(0)).count() == 0
    tied = fingerprint.compare_edited(spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "n"), (None, None)], "doc_id long, text string"))
    assert tied.count() == 5
