"""SimHash near-dedup by covering locality-sensitive hashing.

A text's 64-bit fingerprint is the bitwise majority of the XXH64 hashes of its word shingles.
For radius r, every bit position i gets a nonzero vector m(i) of r+1 bits; table v (a nonzero
vector of r+1 bits) keeps the bits whose m(i) has odd inner product with v. Any r positions span
at most r dimensions, so some v is orthogonal to all of them: every pair within the radius agrees
on all bits that this table keeps, and meets there. That is a guarantee, not a probability.

Buckets of up to ``SMALL`` distinct fingerprints are compared pair by pair. Larger ones are not
capped: at radius 2 each member is dealt to the fingerprints at most one kept-out bit away, and two
members are within two bits exactly when they share such a neighbour. A star per neighbour gives the
same components in linear work, spread over all tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import components, cut, text_batches

SEED = 42
SMALL = 24
#: Shingles hashed at once: bounds the memory that a very long text takes.
BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = 3) -> int:
    """The unsigned 64-bit fingerprint; 0 for null texts and texts without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + width - 1]
        k = max(1, len(part) - width + 1)
        if len(part) < width:
            shingles = [join(part)]
        else:
            shingles = map(join, zip(*(part[i : i + k] for i in range(width)), strict=True))
        h = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, k)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: str, width: int = 3):
    """A Column with the fingerprint of ``text`` as a signed long."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return of(F.col(text))


def masks(radius: int = 2) -> list[int]:
    """The covering masks, one for each nonzero vector of radius + 1 bits, as unsigned 64-bit numbers."""
    vectors = range(1, 1 << (radius + 1))
    given = [1 + i % len(vectors) for i in range(64)]
    return [sum(1 << i for i in range(64) if (given[i] & v).bit_count() % 2) for v in vectors]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs ``a``, ``b`` of ids whose components are those of "at most ``radius`` bits differ".

    ``prints`` has distinct fingerprints ``fp`` (long) with an ``id`` (long) each.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius is 0, 1 or 2")
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(signed(m)).alias("mask")) for t, m in enumerate(masks(radius))))
    dealt = prints.select("id", "fp", F.explode(tables).alias("x")).select(
        "id", "fp", F.col("x.t").alias("t"), F.col("x.mask").alias("mask"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key")
    )
    sizes, _ = cut(dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met, _ = cut(dealt.join(sizes, ["t", "key"]))
    few = met.where(F.col("n") <= SMALL)
    group = few.groupBy("t", "key").agg(F.collect_list(F.struct("id", "fp")).alias("g"))
    pairs = (
        group.select(F.explode("g").alias("x"), "g")
        .select("x", F.explode(F.filter("g", lambda y: (y["id"] < F.col("x.id")) & (F.bit_count(y["fp"].bitwiseXOR(F.col("x.fp"))) <= radius))).alias("y"))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    )
    many = met.where(F.col("n") > SMALL)
    # radius 2: a shared neighbour one bit away; radius 1: equal but for one cleared position; 0: equal, so no two
    flips = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(signed(1 << i) if i >= 0 else 0).alias("bit")) for i in range(-1, 64)))
    free = F.filter(flips, lambda x: x["bit"].bitwiseAND(F.col("mask")) == 0)
    z, slot = (F.col("fp").bitwiseXOR(F.col("x.bit")), F.lit(-1)) if radius == 2 else (F.col("fp").bitwiseAND(F.bitwise_not(F.col("x.bit"))), F.col("x.i"))
    near = many.select("id", "fp", "t", F.explode(free).alias("x")).select("id", "t", slot.alias("slot"), z.alias("z"))
    least = near.groupBy("t", "slot", "z").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = near.join(least, ["t", "slot", "z"]).where("id <> b").select(F.col("id").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """One row for each row of ``df``: the id, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the least id reachable over links of at most ``radius`` differing bits. Null and
    empty texts have fingerprint zero and link like any other. Rows with a null id keep their fingerprint
    and link by it; ids may repeat. Other columns of ``df`` are ignored; an empty table gives no rows.
    """
    text_batches(df.sparkSession)
    own, _ = cut(df.select(F.col(id_col).cast("long").alias("id"), fingerprint_column(text_col, width).alias("fp")))
    prints = own.groupBy("fp").agg(F.min("id").alias("id"))
    prints, _ = cut(prints)
    roots = components(links(prints.where("id is not null"), radius))
    rooted = prints.join(roots, prints["id"] == roots["node"], "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return own.join(rooted, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``df`` with all their columns, but one (the least id) of each near-duplicate group.

    Rows with a null id are kept: nothing names them. Rows that repeat the kept id stay as they are.
    """
    groups = near_groups(df, id_col, text_col, width, radius)
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")
