import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lexweave.llm import embed_dedup, simhash


def brute_fingerprint(text, width=3):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(n, linked):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


TEXTS = ["", None, "  \t", "one", "One", "two words", "a b c", "A  b\nc", "x " * 50, "y " * 49 + "z", "Ünï code ÀÉ text here", "É é", "the same line of text " * 30, "the same line of text " * 30 + "and"]


def test_fingerprint_is_the_definition():
    for t in TEXTS:
        assert simhash.fingerprint(t) == brute_fingerprint(t)
    long = " ".join(str(i % 977) for i in range(3 * simhash.BLOCK))
    assert simhash.fingerprint(long) == brute_fingerprint(long)


def test_masks_cover_every_pair_within_the_radius():
    for radius in (0, 1, 2):
        m = simhash.masks(radius)
        assert len(m) == 2 ** (radius + 1) - 1
        if radius == 2:
            assert all(any(not x & (1 << i | 1 << j) for x in m) for i in range(64) for j in range(64))
        elif radius == 1:
            assert all(any(not x & (1 << i) for x in m) for i in range(64))


def links_brute(fps, radius):
    return [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius]


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for base in list(fps)[:10]:
        fps |= {base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(6)}
    centre = rng.getrandbits(64)  # a crowd in one bucket, larger than what is compared pair by pair
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(300)}
    fps = sorted(fps)
    prints = spark.createDataFrame([(i, simhash.signed(f)) for i, f in enumerate(fps)], "id long, fp long")
    for radius in (0, 1, 2):
        got = brute_components(len(fps), [(r.a, r.b) for r in simhash.links(prints, radius).collect()])
        assert got == brute_components(len(fps), links_brute(fps, radius)), radius


def test_groups_of_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "one", "x"), (None, "one", "y")], "doc_id long, text string, fingerprint string")
    got = simhash.near_groups(df).collect()
    assert len(got) == len(TEXTS) + 2
    fps = [brute_fingerprint(t) for t in TEXTS]
    want = brute_components(len(fps), links_brute(fps, 2))
    for r in got:
        if r.doc_id is not None:
            assert (int(r.fingerprint, 16), r.component_id) == (fps[r.doc_id], want[r.doc_id])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {want[i] for i in range(len(fps))} | {None}
    assert simhash.near_groups(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def brute_links(vectors, cosine):
    good = [i for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(vectors[i], float) / np.abs(vectors[i]).max() for i in good}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    return [(i, j) for i in good for j in good if j < i and len(vectors[i]) == len(vectors[j]) and unit[i] @ unit[j] >= cosine]


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 64))
    near = [b + rng.normal(size=64) * s for b in base[:40] for s in (0.05, 0.15, 0.25, 0.33)]
    crowd = [base[0] + rng.normal(size=64) * 0.1 for _ in range(700)]  # more than two blocks in every bucket
    vectors = [list(map(float, v)) for v in [*base, *near, *crowd, *base[:5]]]
    vectors += [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], [1e-200] * 64, [1e200] * 64]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int, n_links string")
    got = {r.vec_id: r for r in embed_dedup.near_groups(df).collect()}
    linked = brute_links(vectors, 0.95)
    degree = np.zeros(len(vectors), int)
    for i, j in linked:
        degree[i] += 1
        degree[j] += 1
    found = np.array([got[i].n_links for i in range(len(vectors))])
    assert (found <= degree).all() and found.sum() >= 0.99 * degree.sum()
    want = brute_components(len(vectors), linked)
    assert np.mean([got[i].component_id == want[i] for i in range(len(vectors))]) > 0.99
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_embeddings_edge_cases(spark):
    kind = "vec_id long, embedding array<float>"
    assert embed_dedup.near_groups(spark.createDataFrame([], kind)).count() == 0
    df = spark.createDataFrame([(4, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (7, None)], kind)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_groups(df).collect())
    assert got == [(-1, 0, None, None), (2, 2, 2, True), (2, 2, 2, True), (4, 2, 2, False), (7, 0, 7, True)]


def test_sketches_lose_no_pair_at_the_cosine():
    rng = np.random.default_rng(8)
    for d in (2, 3, 64, 300):
        a = rng.normal(size=(4000, d))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=(4000, d))
        b -= (a * b).sum(1, keepdims=True) * a
        b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        far = np.bitwise_count(embed_dedup.sketches(a) ^ embed_dedup.sketches(b)).sum(1)
        assert far.max() <= embed_dedup.reach(0.95) < 64
    assert embed_dedup.reach(1.0) == 0 and embed_dedup.reach(-1.0) == embed_dedup.SKETCH
    assert [embed_dedup.width(k, 64) for k in (1, 2, 3, 5, 9)] == [np.dtype(t) for t in ("u1", "u2", "u4", "u8", "u8")]


def test_sifting_is_its_definition():
    rng = np.random.default_rng(9)
    n, tables, probes = 400, 3, 2
    words = rng.integers(0, 8, (n, 2)).astype(np.uint64)
    keys = rng.integers(0, 4, (n, tables, probes)).astype(np.uint8)
    group = np.sort(rng.integers(0, 25, n))
    table, bucket, cross = (rng.integers(0, top, 25)[group] for top in (tables, 4, 2))
    side, cross = rng.integers(0, 2, n), cross == 1

    def first(i, j):
        shared = [(t, int(k)) for t in range(tables) for k in sorted(set(keys[i, t]) & set(keys[j, t]))]
        return shared and shared[0] == (table[i], bucket[i])

    def near(i, j):
        return group[i] == group[j] and i != j and (side[i] != side[j] or not cross[i]) and sum(int(a ^ b).bit_count() for a, b in zip(words[i], words[j], strict=True)) <= 1

    want = [any(near(i, j) and first(i, j) for j in range(n)) for i in range(n)]
    assert 0 < sum(want) < n
    assert embed_dedup.near_by_sketch(words, keys, group, side, cross, table, bucket, 1).tolist() == want


def test_groups_of_rows_stay_whole():
    values = np.sort(np.random.default_rng(4).integers(0, 60, 1000))
    values[300:600] = 20  # spans several batches
    values.sort()
    table = pa.table({"k": values, "i": np.arange(1000)})
    parts = list(embed_dedup.groups(iter(table.to_batches(max_chunksize=37)), ["k"]))
    assert pa.concat_tables(parts).column("i").to_pylist() == list(range(1000))
    seen = [set(p.column("k").to_pylist()) for p in parts]
    assert all(not a & b for i, a in enumerate(seen) for b in seen[:i]) and len(parts) > 5
    assert list(embed_dedup.groups(iter([]), ["k"])) == []


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = embed_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(embed_dedup.hadamard(y), x)


def test_extra_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, "a b c d", "q", 5), (2, "a b c d", "q", 6)], "doc_id long, text string, component_id string, root int")
    assert [r.component_id for r in simhash.near_groups(df).collect()] == [1, 1]
    assert simhash.keep_one(df).select(F.col("root")).collect()[0].root == 5
