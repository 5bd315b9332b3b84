import random

from lexweave.llm import simhash_similar as S


def brute(texts, width=5, similarity=0.8):
    """Components, and the pairs that link."""
    def grams(t):
        w = [x.encode().lower() for x in (t or "").split()]
        return {b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)} or ({b" ".join(w)} if w else set())

    linked = []
    sets, root = [grams(t) for t in texts], list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(sets)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if either == 0 or both >= similarity * either:
                linked.append((i, j))
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], linked


def edited(rng, words, share):
    words = list(words)
    for _ in range(max(1, round(len(words) * share))):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def corpus():
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    texts = []
    for _ in range(40):  # pairs with few edits, and pairs with too many
        base = fresh(rng.randrange(60, 400))
        texts += [" ".join(base), " ".join(edited(rng, base, 0.012)).upper().replace("NEW", "new"), " ".join(edited(rng, base, 0.2))]
    base = fresh(300)  # a crowd in which all are alike, and one in which only neighbours are
    texts += [" ".join(edited(rng, base, 0.004)) for _ in range(150)]
    walk = fresh(300)
    for _ in range(150):
        walk = edited(rng, walk, 0.01)
        texts.append(" ".join(walk))
    return texts + ["", None, " \n", "one", "One ", "two words", "a b c d e", "A B  c d e"]


def run(spark, texts):
    return {r.doc_id: r.component_id for r in S.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}


def test_groups_equal_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n int")
    got = {r.doc_id: r.component_id for r in S.similar_groups(df).collect()}
    want, _ = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    kept = S.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len(set(want))


def test_small_blocks_find_the_same_without_the_tables(spark, monkeypatch):
    """Crowds in many blocks of every kind: buckets dealt to pairs, groups with parts of their own, few columns at once."""
    for name, value in (("LARGE", 7), ("BLOCK", 8), ("BLOCK_SHINGLES", 3000), ("COLUMNS", 50), ("OFTEN", 3), ("NAMED", 40), ("FEW", 0), ("FEWEST", 5)):
        monkeypatch.setattr(S, name, value)
    monkeypatch.setattr(S, "tables", lambda n: [[0, 0, 0, 0]])  # one bucket with all, led by one document: the rest finds them
    texts = corpus()
    want, _ = brute(texts)
    got = run(spark, texts)
    assert [got[i] for i in range(len(texts))] == want


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "x y"), (None, "a b c d e f"), (3, "x y"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id) for r in S.similar_groups(df).where("component_id is not null").collect()) == [(0, 1), (1, 1), (1, 1), (3, 1)]
    assert S.similar_groups(df.limit(0)).count() == 0 and S.keep_one(df.limit(0)).count() == 0


def test_masks_and_index():
    m = S.tables(1000)
    assert len(m) == len(S.tables(10**10)) == 7 * S.BLOCKS and all(8 <= sum(x.bit_count() for x in a) <= 28 for a in m)
    for at in range(0, len(m), 7):  # two positions of a block are left out together by one of its masks
        held = [sum(x << 64 * k for k, x in enumerate(a)) for a in m[at : at + 7]]
        places = [p for p in range(S.WIDE) if any(h >> p & 1 for h in held)]
        assert all(any(not (h >> p & 1 or h >> q & 1) for h in held) for p in places for q in places)
    assert S.jaccard("a b c d e f", "a b c d e f") == 1 and S.jaccard("", None) == 1 and S.jaccard("", "a") == 0
    assert S.jaccard("a b c d e f", "A B C D E g") == 1 / 3
    long = "w " * 200000
    assert len(S.shingles(long)) == 1


def planted(rng, shared, n, similarity):
    """Two texts of ``n`` five-word shingles each, of which about as many are common as the index asks for; a shared start."""
    base = shared + [f"u{rng.randrange(10**9)}" for _ in range(n + 4 - len(shared))]
    both = -(-2 * n * similarity // (1 + similarity))  # the least number in common
    other = base[: int(both) + 4] + [f"v{rng.randrange(10**9)}" for _ in range(n - int(both))]
    return " ".join(base), " ".join(other)


def test_pairs_at_the_very_similarity_are_found(spark):
    """Pairs at 0.80 to 0.85: alone, in crowds that share a third to two thirds of their words, and a long text's copy."""
    rng = random.Random(8)
    texts = [t for k in range(300) for t in planted(rng, [], rng.randrange(5, 200), (0.8, 0.82, 0.85)[k % 3])]
    for shared, pairs in ((50, 60), (100, 60), (40, 200)):
        passage = [f"s{shared}_{k}" for k in range(shared)]
        texts += [t for k in range(pairs) for t in planted(rng, passage, 150, (0.8, 0.82)[k % 2])]
    assert all(S.jaccard(a, b) >= 0.8 for a, b in zip(texts[::2], texts[1::2], strict=True))
    long = [f"w{rng.randrange(10**6)}" for _ in range(300000)]
    texts += [" ".join(long), " ".join(long[:-100]), " ".join(long[: len(long) // 2])]
    got = run(spark, texts)
    assert all(got[2 * k] == got[2 * k + 1] == 2 * k for k in range(len(texts) // 2)) and got[len(texts) - 1] == len(texts) - 1
