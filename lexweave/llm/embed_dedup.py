"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe, verified pairs.

Exact copies of a vector become one class first. A class's unit vector is rotated pseudo-randomly (three rounds of
random signs and a fast Hadamard transform); its hash is the signed axis nearest to it, and ``k`` such hashes make
a bucket of one table. A vector is filed under its own bucket and under its next most likely ones, so that two
vectors meet if any of their probes agree.

What goes through the buckets is not the vector but a sketch (``SKETCH`` signs of Gaussian projections) and its list of
buckets, each number as narrow as it can be. A bucket's task keeps a member if another one is near enough by
sketch and shares no earlier bucket with it; only for these the vector is fetched, once for each bucket where it is kept.
There members are compared by cosine in double precision. Signs of two vectors at the cosine asked for differ at more
places than ``reach`` allows with a chance of at most ``LOST``; nothing is accepted by its sketch.

A pair is counted once: in the first of the buckets that its two vectors share, which both know, as each carries its
list of buckets. So neither a distinct over pairs nor a list of pairs is needed: tasks return, for each
vector, how many it links with and one edge to the least vector it is connected with in that block. Buckets of more
than ``BLOCK`` members are dealt to pairs of blocks, all of which are compared, by as many tasks: no cap, no
sample, and no group larger than two blocks in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import components, cut, drop

COSINE = 0.95
#: Signs in a sketch, and the chance that two vectors at the cosine asked for are too far apart by theirs.
SKETCH = 128
LOST = 1e-7
TABLES = 10
PROBES = 3
BLOCK = 256
#: Buckets with more than a block of members that may be broadcast; beyond, they are joined by a shuffle.
FEW = 20_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the rows of ``x`` (their length a power of two), orthonormal."""
    n, w = x.shape
    h = 1
    while h < w:
        x = x.reshape(n, w // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, w)
        h *= 2
    return x / math.sqrt(w)


def hashes(x: np.ndarray, k: int, tables: int = TABLES, probes: int = PROBES, seed: int = 11) -> np.ndarray:
    """Bucket numbers (row, table, probe) of unit vectors; probe 0 is the vector's own bucket."""
    n, d = x.shape
    w = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, w))
    padded[:, :d] = x
    out = np.zeros((n, tables, probes), np.int64)
    rng = np.random.default_rng(seed)
    rows = np.arange(n)
    for t in range(tables):
        firsts, seconds, losses = [], [], []
        for _ in range(k):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], w))
            size = np.abs(y)
            a = np.argmax(size, 1)
            top = size[rows, a].copy()
            size[rows, a] = -1
            b = np.argmax(size, 1)
            firsts.append(2 * a + (y[rows, a] < 0))
            seconds.append(2 * b + (y[rows, b] < 0))
            losses.append(top - size[rows, b])
        own = np.zeros(n, np.int64)
        for f in firsts:
            own = own * (2 * w) + f
        out[:, t, 0] = own
        # the next most likely buckets change the one hash whose two largest axes are nearest to each other
        order = np.argsort(np.array(losses), axis=0, kind="stable")
        for p in range(1, probes):
            j = order[(p - 1) % k]
            alt = np.zeros(n, np.int64)
            for i in range(k):
                alt = alt * (2 * w) + np.where((j == i) & (p <= k), seconds[i], firsts[i])
            out[:, t, p] = alt
    return out


def shape(n: int, d: int) -> tuple[int, int, int]:
    """For ``n`` vectors of ``d`` numbers: hashes a bucket, tables, probes. Buckets are about as many as a quarter of
    the vectors, so that unrelated vectors seldom meet at any size; tables make up for the chance a longer hash costs."""
    w = max(2, 1 << (d - 1).bit_length())
    k = max(1, math.ceil(math.log(max(n, 2) / 4) / math.log(2 * w))) if n > 8 else 1
    return k, TABLES + 8 * max(0, k - 2), k + 1


def width(k: int, d: int) -> np.dtype:
    """The narrowest numbers that hold the buckets of ``k`` hashes of vectors of ``d`` numbers."""
    w = max(2, 1 << (d - 1).bit_length())
    return np.min_scalar_type(min((2 * w) ** k - 1, np.iinfo(np.int64).max))


def sketches(x: np.ndarray, seed: int = 23) -> np.ndarray:
    """Signs of ``SKETCH`` Gaussian projections of the rows of ``x``, as rows of 64-bit words."""
    axes = np.random.default_rng(seed).standard_normal((x.shape[1], SKETCH))
    return np.packbits(x @ axes >= 0, axis=1).view(np.uint64)


def reach(cosine: float) -> int:
    """The most signs that may differ: more do with a chance of at most ``LOST`` for vectors at this cosine."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    below = 0.0
    for r in range(SKETCH):
        below += math.comb(SKETCH, r) * p**r * (1 - p) ** (SKETCH - r)
        if 1 - below <= LOST:
            return r
    return SKETCH


def usable(column: str):
    """Whether a vector takes part: not null or empty, no null or non-finite component, not all zero."""
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def _first_shared(a: np.ndarray, b: np.ndarray, table: int, bucket: int | np.ndarray) -> np.ndarray:
    """For pairs of bucket lists (pair, table, probe): whether ``bucket`` of ``table`` is the first that both hold."""
    first = np.arange(len(a))
    for t in range(table):
        first = first[~(a[first, t, :, None] == b[first, t, None, :]).any((1, 2))]
    own, bucket = a[first, table].astype(np.int64), np.broadcast_to(bucket, len(a))[first]
    low = np.where((own[:, :, None] == b[first, table, None, :]).any(2), own, np.iinfo(np.int64).max).min(1)
    good = np.zeros(len(a), bool)
    good[first] = low == bucket
    return good


def near_by_sketch(words: np.ndarray, keys: np.ndarray, group: np.ndarray, side: np.ndarray, cross: np.ndarray, table: np.ndarray, bucket: np.ndarray, most: int) -> np.ndarray:
    """Which rows have another one of their group at most ``most`` signs away that they share no earlier bucket with.

    Groups are runs of rows; where ``cross`` is set, only rows of different sides are compared.
    """
    n = len(group)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    end = np.repeat(starts + sizes, sizes)
    kept = np.zeros(n, bool)
    at, step = np.arange(n), 0
    while True:  # each row with the next one, the one after, and so on, while its group lasts
        step += 1
        at = at[at + step < end[at]]
        if not len(at):
            return kept
        other = at + step
        i = at[(~kept[at] | ~kept[other]) & (~cross[at] | (side[at] != side[other]))]
        i = i[np.bitwise_count(words[i] ^ words[i + step]).sum(1, dtype=np.int64) <= most]
        for t in np.unique(table[i]):
            own = i[table[i] == t]
            own = own[_first_shared(keys[own], keys[own + step], int(t), bucket[own])]
            kept[own] = kept[own + step] = True


def groups(batches: Iterator[pa.RecordBatch], order: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``order`` in tables that break no group; a group is held until its end is seen."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        t = pa.Table.from_batches(held)
        last = np.ones(len(t), bool)
        for c in order:
            values = t.column(c).to_numpy()
            last &= values == values[-1] if len(values) else True
        done = len(t) - int(last.sum())
        if done:
            yield t.slice(0, done)
            held = t.slice(done).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _bytes(column: pa.ChunkedArray, kind: np.dtype | type, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), kind).reshape(-1, *shape)


def compare(x: np.ndarray, keys: np.ndarray, weight: np.ndarray, side: np.ndarray, cross: bool, table: int, bucket: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links within a block or, if ``cross``, between its two sides: per member the weight it links with (pairs
    that met in an earlier bucket left out) and the least member it is connected with here."""
    n = len(x)
    gained, root = np.zeros(n, np.int64), np.arange(n)
    for lo in range(0, n, BLOCK):
        s = x[lo : lo + BLOCK] @ x.T
        i, j = np.nonzero(s >= cosine)
        i += lo
        good = (i < j) & ((side[i] != side[j]) if cross else True)
        i, j = i[good], j[good]
        for at in range(0, len(i), 1 << 14):
            a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            new = _first_shared(keys[a], keys[b], table, bucket)
            np.add.at(gained, a[new], weight[b[new]])
            np.add.at(gained, b[new], weight[a[new]])
        while len(i):  # the least label spreads over the pairs until nothing changes
            low = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            root = root[root]
            if (root == before).all():
                break
    while True:  # rows of later slices may have lowered earlier ones
        new = root[root]
        if (new == root).all():
            return gained, root
        root = new


def near_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row for each row of ``df``: the id, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other rows at a cosine of at least ``cosine`` that were found; ``component_id`` is the least id
    reachable over links; ``kept`` says whether it is the row's own. Vectors that are null, empty, zero or hold
    null or non-finite numbers link with nothing, nor do rows with a null id, nor vectors of different lengths.
    Repeated rows count as rows. Other columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    own, _ = cut(rows.withColumn("ok", usable("v") & F.col("id").isNotNull()).withColumn("v", F.when(F.col("ok"), F.col("v"))))
    classes, classes_path = cut(own.where("ok").groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("members")))
    n = classes.count()
    shapes = {r["d"]: shape(n, r["d"]) for r in classes.select(F.size("v").alias("d")).distinct().collect()}  # as many as vector lengths

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, members, vectors = b.column("rep").to_numpy(), b.column("members").to_numpy(), b.column("v")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.values.to_numpy(zero_copy_only=False)
            starts = vectors.offsets.to_numpy()[:-1]
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                x = np.stack([flat[starts[i] : starts[i] + d] for i in at])
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                k, tables, probes = shapes[int(d)]
                keys = hashes(x, k, tables, probes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rep[at]),
                        pa.array(members[at]),
                        pa.array(np.full(len(at), d, np.int32)),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables * probes, dtype=np.int32)), pa.array(keys.ravel())),
                        pa.array([r.tobytes() for r in keys.astype(width(k, int(d)))], pa.binary()),
                        pa.array([r.tobytes() for r in sketches(x)], pa.binary()),
                    ],
                    names=["rep", "members", "d", "x", "keys", "packed", "sketch"],
                )

    filed, filed_path = cut(classes.mapInArrow(file, "rep long, members long, d int, x binary, keys array<long>, packed binary, sketch binary"))
    probes = F.lit(1)
    for d, (_, _, p) in shapes.items():
        probes = F.when(F.col("d") == d, F.lit(p)).otherwise(probes)
    spread = lambda *more: filed.select("d", *more, F.posexplode("keys").alias("at", "key")).withColumn("t", F.floor(F.col("at") / probes).cast("int")).drop("at")
    heavy, heavy_path = cut(spread().groupBy("d", "t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).withColumn("m", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n"))
    small = heavy if heavy.count() > FEW else F.broadcast(heavy)
    dealt = spread("rep", "packed", "sketch").join(small, ["d", "t", "key"], "left").withColumn("m", F.coalesce("m", F.lit(1)))
    side = F.pmod(F.xxhash64("rep", "t", "key"), F.col("m")).cast("int")
    dealt = dealt.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    dealt = dealt.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")).drop("m", "other")
    order = ["d", "t", "key", "lo", "hi"]
    deal = lambda rows: rows.repartition(*order).sortWithinPartitions(*order, "side", "rep")
    most = reach(cosine)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in groups(batches, order):
            ds = whole.column("d").to_numpy()
            for d in np.unique(ds):
                t = whole.filter(pa.array(ds == d))
                k, tables, probes = shapes[int(d)]
                cols = np.stack([t.column(c).to_numpy() for c in order], 1)
                group = np.cumsum(np.r_[False, (cols[1:] != cols[:-1]).any(1)])
                words, keys = _bytes(t.column("sketch"), np.uint64, SKETCH // 64), _bytes(t.column("packed"), width(k, int(d)), tables, probes)
                kept = near_by_sketch(words, keys, group, t.column("side").to_numpy(), cols[:, 3] != cols[:, 4], cols[:, 1], cols[:, 2], most)
                if kept.any():
                    yield from t.select([*order, "side", "rep"]).filter(pa.array(kept)).combine_chunks().to_batches()

    sifted, sifted_path = cut(deal(dealt).mapInArrow(sift, "d int, t int, key long, lo int, hi int, side int, rep long"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, order):
            cols = np.stack([t.column(c).to_numpy() for c in order], 1)
            bounds = [0, *(np.flatnonzero((cols[1:] != cols[:-1]).any(1)) + 1).tolist(), len(cols)]
            rep, members, sides = t.column("rep").to_numpy(), t.column("members").to_numpy(), t.column("side").to_numpy()
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                if b - a < 2:
                    continue
                d, table, bucket = (int(v) for v in cols[a, :3])
                k, tables, probes = shapes[d]
                x = _bytes(t.column("x").slice(a, b - a), np.float64, d)
                keys = _bytes(t.column("packed").slice(a, b - a), width(k, d), tables, probes)
                gained, root = compare(x, keys, members[a:b], sides[a:b], bool(cols[a, 3] != cols[a, 4]), table, bucket, cosine)
                hit = np.flatnonzero((gained > 0) | (root != np.arange(b - a)))
                if len(hit):
                    out.append((rep[a:b][hit], gained[hit], rep[a:b][root[hit]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["rep", "links", "root"])

    fetched = deal(sifted.join(filed.select("rep", "members", "x", "packed"), "rep"))
    found, found_path = cut(fetched.mapInArrow(link, "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known, _ = cut(
        classes.join(links, "rep", "left").join(roots, classes["rep"] == roots["node"], "left").select("v", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    for path in (classes_path, filed_path, heavy_path, sifted_path, found_path):
        drop(spark, path)
    # vectors that link with nothing have no value to be joined by: they don't meet in one task
    out = own.where("ok").join(known, "v").select("id", "n_links", "component_id").unionByName(own.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
