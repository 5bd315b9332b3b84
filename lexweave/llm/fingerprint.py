"""Order-independent document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a line, white space at both ends removed, not empty) hashes to a wide vector; a document's
fingerprint is the sum of its paragraphs' vectors, each lane modulo a power of two. So the order of
paragraphs doesn't matter, and a paragraph is inserted or deleted by adding or subtracting its vector.

The vector has two parts. ``EXACT`` lanes modulo 2**64 are the paragraph's own hash, expanded: equality of
two sums means equal multisets but for hash collisions. ``SKETCH`` lanes modulo 2**16 hold the paragraph's
three-word shingles, each adding plus or minus one to one lane: the squared length of a difference of two
sums estimates how many shingles differ, which gives a likeness between 0 and 1 from fingerprints alone.
Texts that are equal but for white space around lines and empty lines have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import text_batches

EXACT, SKETCH = 8, 512
_LANES = np.arange(1, EXACT + 1, dtype=np.uint64)
BLOCK = 1 << 16


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The sums over all paragraphs of ``text`` (null: empty): exact lanes (uint64) and sketch lanes (uint16)."""
    digest = xxhash.xxh64_intdigest
    sketch = np.zeros(SKETCH, np.int64)
    lines = [s for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if (s := x.strip())]
    words: list[bytes] = []
    ends: list[int] = []

    def flush() -> None:
        w = np.fromiter(map(digest, words), np.uint64, len(words))
        own = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
        h = w * np.uint64(0x9E3779B97F4A7C15)
        for step, odd in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
            same = own[step:] == own[:-step] if len(w) > step else np.zeros(0, bool)
            h[: len(same)] += np.where(same, w[step:] * np.uint64(odd), np.uint64(0))
        # a shingle starts at each word that two more of its line follow; a shorter line is one shingle
        left = np.asarray(ends)[own] - np.arange(len(w))
        first = np.r_[True, own[1:] != own[:-1]]
        h = _mix(h[(left >= 3) | first])
        sketch[:] += np.bincount((h & np.uint64(SKETCH - 1)).astype(np.int64), weights=((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1, minlength=SKETCH).astype(np.int64)
        words.clear()
        ends.clear()

    own_hashes = np.fromiter((digest(x, 7) for x in lines), np.uint64, len(lines))
    exact = _mix(own_hashes[:, None] * _LANES + _LANES).sum(0, dtype=np.uint64)
    for line in lines:
        words += line.split()
        ends.append(len(words))
        if len(words) >= BLOCK:
            flush()
    if words:
        flush()
    return exact, (sketch % 65536).astype(np.uint16)


def pack(v: tuple[np.ndarray, np.ndarray]) -> bytes:
    return v[0].astype("<u8").tobytes() + v[1].astype("<u2").tobytes()


def unpack(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b, "<u8", EXACT).copy(), np.frombuffer(b, "<u2", SKETCH, EXACT * 8).copy()


def insert(fingerprint: bytes, paragraph: str) -> bytes:
    """The fingerprint of the document with ``paragraph`` added anywhere."""
    (a, b), (c, d) = unpack(fingerprint), vector(paragraph)
    return pack((a + c, b + d))


def delete(fingerprint: bytes, paragraph: str) -> bytes:
    """The fingerprint of the document without one occurrence of ``paragraph``."""
    (a, b), (c, d) = unpack(fingerprint), vector(paragraph)
    return pack((a - c, b - d))


def likeness(x: bytes, y: bytes) -> float:
    """Estimated share of shingles in common, as multisets: 1 for equal fingerprints, about 0 for unrelated texts."""
    if x == y:
        return 1.0
    (_, a), (_, b) = unpack(x), unpack(y)
    length = lambda v: float((v.view(np.int16).astype(np.float64) ** 2).sum())
    total = length(a) + length(b)
    return min(1.0, max(0.0, 1.0 - length(a - b) / total)) if total else 0.0


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with a binary column ``out``; equal texts have equal fingerprints, null is the empty text's (all zero)."""
    text_batches(df.sparkSession)
    return df.withColumn(out, _column()(F.col(text_col)))


def _column():
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([pack(vector(t)) for t in texts.to_pylist()], pa.binary())

    return of


def with_next(df: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """Columns ``part``, ``id``, ``text``, ``twin``: the rows dealt to ranges of ids, in order, each range ended
    by a copy (``twin``) of the first row after it, so that every row's successor lies in its own task.

    The range bounds are ids from the data, by one approximate-quantile pass over the id column; the text
    moves once. The successor of the last row is the first. Null ids come first; among equal ids the text
    decides. Rows are sorted by (part, twin, id, text).
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(text_col).alias("text"))
    s = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n).alias("q"), F.min("id").alias("low")).first()
    low, bounds = s["low"], sorted({b for b in s["q"] or [] if b > s["low"]})
    at = F.lit(0)
    if bounds:
        at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("id")))
    last = len(bounds)
    edge = F.col("id").isin(bounds) if bounds else F.lit(False)
    copies = F.array_compact(
        F.array(
            F.struct(at.alias("part"), F.lit(False).alias("twin")),
            F.when(edge, F.struct((at - 1).alias("part"), F.lit(True).alias("twin"))),
            F.when(F.col("id") == F.lit(low), F.struct(F.lit(last).alias("part"), F.lit(True).alias("twin"))),
        )
    )
    dealt = rows.select("id", "text", F.explode(copies).alias("x")).select("x.part", "x.twin", "id", "text")
    return dealt.repartitionById(last + 1, F.col("part")).sortWithinPartitions("part", "twin", "id", "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``following`` (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint against that of its edited text and of the next document (see ``edited``, ``with_next``).

    Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex strings),
    ``near_edited``, ``near_next``. Null texts count as empty; a table of one row is its own successor.
    """
    import hashlib

    text_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            for part, twin, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                if held and held[0] == part:
                    if held[1]:  # of several rows with the twin's id the first is the successor
                        continue
                    mine, own, doc, _ = held[2:]
                    nxt = pack(vector(text))
                    new = edited(doc, text)
                    efp = pack(vector(new))
                    out.append((None if mine == -(1 << 63) else mine, len(doc), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), efp.hex(), likeness(own, efp), likeness(own, nxt)))
                    held = (part, twin, i, nxt, text, None)
                else:
                    held = (part, twin, i, pack(vector(text)), text, None)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(df, id_col, text_col).mapInArrow(run, schema)


def hex_column(c: str) -> Column:
    return F.lower(F.hex(c))
