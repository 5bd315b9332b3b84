"""SimHash near-dedup at a similarity: documents whose word-shingle sets have a Jaccard index of at least 0.8.

Texts that share four fifths of their five-word shingles differ in about a seventh of their SimHash bits, far beyond any
radius that covering tables can guarantee. So links are found in two steps, both verified by the exact index of the
shingle sets, and no link is lost:

1. *Covering tables.* Fingerprints of ``WIDE`` bits; ``BLOCKS`` random blocks of bit positions, each with the seven
   covering masks of radius two, so that two fingerprints within two bits in a block meet for certain. Every member of
   a bucket is a candidate with the bucket's least document: one edge, whatever the bucket's size, and the same leader
   in most tables. What is verified makes groups; nearly all near copies are in one by now.
2. *The rest.* For a Jaccard index no covering code exists, but a prefix does it: of each document the first shingles in
   one order for all, rare ones first, are keys, and two documents at the similarity have one of these in common. Only
   buckets that hold several groups of step 1 are looked at. Pairs of different groups within ``FARTHEST`` bits join
   these to clusters, and in a cluster all pairs of different groups are counted, in blocks of shingle hashes dealt to
   as many tasks; a block with members of one group only has nothing to count and goes nowhere.

So a crowd of near copies costs an edge or two for each member, and quadratic work is left only for documents that are
similar enough to be candidates and yet in no group: it runs in bounded blocks. No link is false.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import components, text_batches
from lexweave.llm.simhash import SEED, signed
from lexweave.plans import lineage
from lexweave.plans.lineage import Scratch

WIDTH, SIMILARITY, WIDE, WORDS64 = 5, 0.8, 256, 4
#: Blocks of bit positions, seven tables each, whatever the number of documents.
BLOCKS = 4
#: Members of a block of shingle sets that one task counts against another, and the shingles they may have.
BLOCK, BLOCK_SHINGLES = 256, 1 << 21
#: Rows of a few numbers each that may be broadcast (about 10 MB); beyond, they are joined by a shuffle.
FEW = 200_000
PART = 1 << 15
#: A shingle in so many documents' prefixes comes late in their order, and so many of them are known to every worker (8 MB).
#: They are counted so many times, as a shingle that comes late lets others in.
OFTEN, NAMED, COUNTED = 32, 1 << 19, 2
#: Documents with one prefix shingle that one task compares by their fingerprints; more are dealt to pairs of blocks.
LARGE = 1024
#: Rows of small buckets compared in one step.
FEWEST = 256
#: Bits beyond which a pair isn't looked at: expected are 39 of 256 at 0.8 and 48 for the least sets (four and five
#: shingles); this is ten and seven standard deviations more.
FARTHEST = 92
#: Shingles of a block counted at once.
COLUMNS = 4096
_BITS = np.uint64(0xBF58476D1CE4E5B9)
PRINT = [f"f{k}" for k in range(WORDS64)]


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles' hashes, ascending; a text of fewer words is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = len(words) - width + 1
    return np.unique(np.fromiter((digest(join(s), SEED) for s in zip(*(words[i : i + n] for i in range(width)), strict=True)), np.uint64, n))


def wide_print(h: np.ndarray) -> list[int]:
    """Words of majority bits over shingle hashes."""
    out = []
    for k in range(WORDS64):
        if k:
            h = (h ^ (h >> np.uint64(31))) * _BITS
            h = h ^ (h >> np.uint64(29))
        ones = np.zeros(64, np.int64)
        for at in range(0, len(h), PART):
            ones += np.unpackbits(h[at : at + PART].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]))
    return out


def jaccard(a: str | None, b: str | None, width: int = WIDTH) -> float:
    """Of the shingle sets; 1 for two texts without words."""
    x, y = shingles(a, width), shingles(b, width)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def tables(n: int) -> list[list[int]]:
    """Masks (words of 64 bits) for ``n`` fingerprints: seven for each block. A key has at least log2(n) + 4 bits, so
    unrelated texts seldom meet, rounded up to a multiple of four, so that masks stay the same while a corpus grows by
    up to sixteen times; their number never changes."""
    bits = max(16, 4 * math.ceil((math.log2(max(n, 2)) + 4) / 4))
    size = min(WIDE, round(bits * 7 / 4))
    rng, out = np.random.default_rng(23), []
    for _ in range(BLOCKS):
        place = rng.permutation(WIDE)[:size].tolist()
        for v in range(1, 8):
            kept = [b for i, b in enumerate(place) if ((1 + i % 7) & v).bit_count() % 2]
            out.append([sum(1 << b - 64 * k for b in kept if b // 64 == k) for k in range(WORDS64)])
    return out


def prefix(h: np.ndarray, often: tuple[np.ndarray, np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """The first of a document's shingles in one order for all documents, rare ones first: as many as it can't do without.

    Two sets at the similarity share at least that part of either one. So the first ``n - ceil(similarity * n) + 1``
    of both have a shingle in common.
    """
    keys, counts = often
    many = len(h) - math.ceil(similarity * len(h) - 1e-9) + 1
    if not len(h) or not len(keys):
        return h[:many]
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return h[np.lexsort((h, np.where(keys[at] == h, counts[at], 0)))[:many]]


def frequent(df: DataFrame, text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) of shingles in the prefixes of at least ``OFTEN`` rows, and their counts; of more than ``NAMED``
    the most frequent. They only give the order of ``prefix``: any order finds the same links, a good one finds them in
    small buckets. A shingle that no prefix holds needs no place in the order, so only prefixes are counted, in the order
    known so far."""
    spark, known = df.sparkSession, (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    for _ in range(COUNTED):
        order = spark.sparkContext.broadcast(known)

        def make(batches: Iterator[pa.RecordBatch], order=order) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [prefix(shingles(t, width), order.value, similarity) for t in b.column(0).to_pylist()]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

        scratch = Scratch(spark)
        often = scratch.cut(texts.mapInArrow(make, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= OFTEN))
        least, total = OFTEN, 0
        for size, n in sorted(((r["size"], r["n"]) for r in often.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
            total += n
            if total > NAMED:
                least = size + 1
                break
        t = often.where(F.col("size") >= least).toArrow()
        scratch.clear()
        h = np.concatenate([known[0], t.column("h").to_numpy().view(np.uint64)])
        size = np.concatenate([known[1], t.column("size").to_numpy()])
        by = np.lexsort((-size, h))
        first = np.r_[True, h[by][1:] != h[by][:-1]] if len(h) else np.zeros(0, bool)
        by = by[first]
        if len(by) > NAMED:
            by = np.sort(by[np.argsort(-size[by], kind="stable")[:NAMED]])
            by = by[np.argsort(h[by], kind="stable")]
        known = h[by], size[by]
    return known


def _bits(f: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, given as rows of words."""
    return np.bitwise_count(f ^ g).sum(-1, dtype=np.int32)


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def _columns(t: pa.Table | pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], together: int = 0) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, each whole; neighbouring runs of up to ``together`` rows in all come as one."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b]).combine_chunks()
        changes = np.zeros(len(t) - 1, bool)
        for k in keys:
            c = t.column(k).to_numpy()
            changes |= c[1:] != c[:-1]
        bounds = [0, *(np.flatnonzero(changes) + 1).tolist()]
        at, last = 0, 0
        for x in bounds[1:]:
            if last > at and x - at > together:
                yield t.slice(at, last - at)
                at = last
            last = x
        if last > at:
            yield t.slice(at, last - at)
        held = t.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Union-find over the numbers given; ``join`` says whether two were apart."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)
        return a != b


def spanning(sets: list[np.ndarray], group: np.ndarray, part: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of groups with a link between two members; as many as connect what all links of this block connect. Every
    pair of different groups is counted, within one part or between two."""
    n = np.array([len(h) for h in sets])
    _, of, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), n)
    shared = times > 1
    column = np.cumsum(shared) - 1
    row, of = row[shared[of]], column[of[shared[of]]]
    by = np.argsort(of, kind="stable")
    row, of = row[by], of[by]
    both = np.zeros((len(sets), len(sets)))
    for at in range(0, int(shared.sum()), COLUMNS):
        x, y = np.searchsorted(of, [at, at + COLUMNS])
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[x:y], of[x:y] - at] = 1
        both += has @ has.T
    good = (both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9) & (group[:, None] != group[None, :])
    if len(set(part.tolist())) > 1:
        good &= part[:, None] != part[None, :]
    forest, out = _Forest(), []
    for k, j in zip(*(x.tolist() for x in np.nonzero(np.tril(good, -1))), strict=True):
        a, b = int(group[j]), int(group[k])
        if forest.join(a, b):
            out.append((a, b))
    return out


def connected(group: np.ndarray, n: np.ndarray, f: np.ndarray, side: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of groups that connect what may be similar in a bucket: members within ``FARTHEST`` bits and of sizes that
    allow it; between the sides only, if there are two. Every pair of groups not yet connected is looked at."""
    forest, out, cross = _Forest(), [], side[0] != side[-1]
    names, of = np.unique(group, return_inverse=True)
    label = np.arange(len(names))  # of each group: the least group it is connected with here
    for k in range(len(group) - 1, 0, -1):
        other = label[of[:k]] != label[of[k]]
        if cross:
            other &= side[:k] != side[k]
        at = np.flatnonzero(other)
        if len(at):
            at = at[np.minimum(n[at], n[k]) >= similarity * np.maximum(n[at], n[k]) - 1e-9]
            at = at[_bits(f[at], f[k]) <= FARTHEST]
        for g in np.unique(label[of[at]]).tolist():
            a, b = int(names[g]), int(names[label[of[k]]])
            if forest.join(a, b):
                out.append((a, b))
            low, high = sorted((g, int(label[of[k]])))
            label[label == high] = low
    return out


def together(keys: list[np.ndarray], group: np.ndarray, n: np.ndarray, f: np.ndarray, side: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """As ``connected``, for several small buckets (runs of equal keys) at once: every two rows of a bucket are looked at."""
    out = []
    for off in range(1, len(group)):
        same = np.ones(len(group) - off, bool)
        for k in keys:
            same &= k[off:] == k[:-off]
        if not same.any():
            break
        a = np.flatnonzero(same & (group[off:] != group[:-off]))
        b = a + off
        split = (keys[1][a] == keys[2][a]) | (side[a] != side[b])
        fits = split & (np.minimum(n[a], n[b]) >= similarity * np.maximum(n[a], n[b]) - 1e-9)
        a, b = a[fits], b[fits]
        near = _bits(f[a], f[b]) <= FARTHEST
        out += zip(group[a[near]].tolist(), group[b[near]].tolist(), strict=True)
    return out


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each row of ``df``: the id and ``component_id``, the least id reachable over links.

    Case (A-Z) and white space don't count. Null texts and texts without words are alike and link with each other.
    Rows with a null id are linked by nothing but equal words. Repeated ids are one document with several texts; other
    columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    text_batches(spark)
    scratch = Scratch(spark)
    cut = scratch.cut
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    often = spark.sparkContext.broadcast(frequent(texts, "text", width, similarity))

    def side(t: DataFrame) -> DataFrame:
        """A written table as the side of a join: broadcast only if it is small."""
        return t if t.count() > FEW else F.broadcast(t)

    longs = ["c1", "c2", *PRINT]

    @F.arrow_udf(f"struct<{','.join(f'{c}:bigint' for c in longs)},n:int,first:array<bigint>>")
    def scan(texts: pa.Array) -> pa.Array:
        rows, sizes, firsts = [], [], []
        for t in texts.to_pylist():
            content = xxhash.xxh3_128_intdigest(b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split()))
            h = shingles(t, width)
            rows.append((content & (1 << 64) - 1, content >> 64, *wide_print(h)))
            sizes.append(len(h))
            firsts.append(prefix(h, often.value, similarity).view(np.int64))
        flat = np.array(rows, np.uint64).reshape(-1, len(longs)).view(np.int64)
        first = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32()), pa.array(np.concatenate(firsts) if firsts else np.zeros(0, np.int64)))
        return pa.StructArray.from_arrays([*(pa.array(flat[:, k]) for k in range(len(longs))), pa.array(sizes, pa.int32()), first], names=[*longs, "n", "first"])

    scanned, path = lineage.cut(texts.select("id", scan(F.col("text")).alias("x")).select("id", "x.*"))
    own = cut(scanned.select("id", "c1", "c2"))
    # equal words move once, with their prefix: nothing below joins prefixes to anything that isn't small
    whole = cut(scanned.groupBy("c1", "c2").agg(F.min("id").alias("id"), F.first("n").alias("n"), *(F.first(f).alias(f) for f in (*PRINT, "first"))))
    lineage.drop(spark, path)
    classes = whole.drop("first")
    named = classes.where("id is not null and n > 0")
    prints = side(named.select("id", "n", *PRINT))

    def near(edges: DataFrame) -> DataFrame:
        """Candidates within ``FARTHEST`` bits and of sizes that allow the similarity."""
        for end in ("a", "b"):
            edges = edges.join(prints.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), *(F.col(f).alias(f"{f}_{end}") for f in PRINT)), end)
        bits = sum((F.bit_count(F.col(f"{f}_a").bitwiseXOR(F.col(f"{f}_b"))) for f in PRINT), F.lit(0))
        return edges.where((bits <= FARTHEST) & (F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-9)).select("a", "b").distinct()

    @F.arrow_udf("binary")
    def set_of(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(t, width).tobytes() for t in texts.to_pylist()], pa.binary())

    def sets(ids: DataFrame) -> DataFrame:
        """``id``, ``h``: the shingle sets of some documents; texts are read again, and only the chosen ones' sets move."""
        found = texts.join(side(ids), "id", "left_semi")
        return found.select("id", set_of(F.col("text")).alias("h"))

    @F.arrow_udf("boolean")
    def similar(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(x, y, strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
        return pa.array(out, pa.bool_())

    # 1. the covering tables: every member with its bucket's least one
    masks = F.array(*(F.struct(F.lit(t).alias("t"), *(F.lit(signed(m)).alias(f) for f, m in zip(PRINT, mask, strict=True))) for t, mask in enumerate(tables(named.count()))))
    dealt = named.withColumn("x", F.explode(masks)).select("id", F.xxhash64("x.t", *(F.col(f).bitwiseAND(F.col(f"x.{f}")) for f in PRINT)).alias("key"))
    met = cut(dealt.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("_")).where("b < _").select("key", "b"))
    star = cut(dealt.join(side(met), "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct())
    star = cut(near(star))
    of = cut(sets(cut(star.select(F.explode(F.array("a", "b")).alias("id")).distinct())))
    true = star.join(of.select(F.col("id").alias("a"), F.col("h").alias("x")), "a").join(of.select(F.col("id").alias("b"), F.col("h").alias("y")), "b")
    found = cut(true.where(similar("x", "y")).select("a", "b"))
    groups = cut(components(found))
    rooted = cut(named.join(side(groups), named["id"] == groups["node"], "left").select("id", F.coalesce("root", "id").alias("group"), "n", "c1", "c2", *PRINT))

    # 2. prefix shingles: candidates between groups; a document in no group is one by itself
    dealt = whole.where("id is not null and n > 0").select("id", F.explode("first").alias("key"))
    grouped = dealt.join(side(groups), dealt["id"] == groups["node"], "left").select("key", F.coalesce("root", "id").alias("group"))
    mixed = cut(grouped.groupBy("key").agg(F.min("group").alias("_"), F.max("group").alias("_more"), F.count(F.lit(1)).alias("m")).where("_ < _more").select("key", F.ceil(F.col("m") / LARGE).cast("int").alias("m")))
    light = dealt.join(side(mixed), "key").join(side(rooted.select("id", "group", "n", *PRINT)), "id")
    light = light.withColumn("part", F.pmod(F.xxhash64("group", "id"), F.col("m")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    light = light.select("key", "group", "n", *PRINT, "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    light = light.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "part", "group")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()  # what this task has connected needs no second edge
        for t in _groups(batches, ("key", "lo", "hi"), FEWEST):
            group, n, part, *f = _columns(t, "group", "n", "part", *PRINT)
            f = np.stack(f, 1).view(np.uint64)
            if len(group) > FEWEST:
                got = connected(group, n, f, part, similarity)
            else:
                got = together(_columns(t, "key", "lo", "hi"), group, n, f, part, similarity)
            new = [p for p in got if forest.join(*p)]
            if new:
                yield _pairs(*np.array(new, np.int64).T)

    clusters = components(cut(light.mapInArrow(meet, "a long, b long").distinct()))
    members = cut(clusters.join(rooted, clusters["node"] == rooted["group"]).select("id", "group", F.col("root").alias("cluster"), "n"))
    # parts of a cluster: a group with more than a block of members has parts of its own, the others share parts
    size = members.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    m = lambda k, s: F.greatest(F.ceil(k / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    size = size.withColumn("pure", F.when(m(F.col("k"), F.col("s")) > 1, F.col("group")))
    plan = cut(size.groupBy("cluster", "pure").agg(m(F.sum("k"), F.sum("s")).alias("m")))
    parts = plan.select("cluster", "pure", F.posexplode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part", "_")).drop("_")
    p, q = (parts.select("cluster", F.col("pure").alias(f"{e}_pure"), F.col("part").alias(f"{e}_part")) for e in "pq")
    block = F.struct(F.coalesce("p_pure", F.lit(-(1 << 63))), "p_part"), F.struct(F.coalesce("q_pure", F.lit(-(1 << 63))), "q_part")
    pairs = p.join(q, "cluster").where((block[0] <= block[1]) & ~F.coalesce(F.col("p_pure") == F.col("q_pure"), F.lit(False)))
    pairs = cut(pairs.withColumn("task", F.xxhash64("cluster", "p_pure", "p_part", "q_pure", "q_part")))
    sides = pairs.select("cluster", F.col("p_pure").alias("pure"), F.col("p_part").alias("part"), "task").unionByName(pairs.where(block[0] != block[1]).select("cluster", F.col("q_pure").alias("pure"), F.col("q_part").alias("part"), "task"))
    placed = members.join(side(cut(size.select("cluster", "group", "pure"))), ["cluster", "group"])
    placed = placed.join(side(plan), (placed["cluster"] == plan["cluster"]) & placed["pure"].eqNullSafe(plan["pure"])).select("id", "group", placed["cluster"], placed["pure"], F.pmod(F.xxhash64("id", placed["cluster"]), F.col("m")).cast("int").alias("part"))
    of = sets(cut(placed.select("id").distinct()))
    placed = placed.join(of, "id").withColumn("own", F.xxhash64("pure", "part"))
    sides = side(cut(sides))
    placed = placed.join(sides, (placed["cluster"] == sides["cluster"]) & (placed["part"] == sides["part"]) & placed["pure"].eqNullSafe(sides["pure"])).select("task", "own", "group", "h")
    placed = placed.repartition("task").sortWithinPartitions("task", "own", "group")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, ("task",)):
            group, own = _columns(t, "group", "own")
            got = spanning([np.frombuffer(h.as_buffer(), np.uint64) for c in t.column("h").chunks for h in c], group, own, similarity)
            if got:
                yield _pairs(*np.array(got, np.int64).T)

    final = components(found.unionByName(cut(placed.mapInArrow(check, "a long, b long"))))
    known = cut(classes.join(final, classes["id"] == final["node"], "left").select("c1", "c2", F.coalesce("root", "id").alias("component_id")))
    return scratch.result(own.select("id", "c1", "c2").join(known, ["c1", "c2"]).select(F.col("id").alias(id_col), "component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` with all their columns, but one (the least id) of each group of similar documents.

    Rows with a null id are kept, as nothing names them.
    """
    groups = similar_groups(df, id_col, text_col, width, similarity)
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    if gone.count() <= FEW:
        gone = F.broadcast(gone)
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")
