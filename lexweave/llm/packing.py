"""Packing documents into fixed windows: best-fit decreasing with a segment tree.

A document's ids end with the id 0. Whole windows are cut from the front of a document first, each a sequence
of its own; what is left (shorter than a window) is placed in decreasing length into the open window with the
least sufficient room. A segment tree over remaining capacities 0..window finds that window in O(log window).

Rests are dealt to groups of about ``GROUP`` by a hash of the row's number, and each group is packed alone, so
no task sees more than a bounded number of lengths; a group's last windows are all the padding that dealing
adds. Only lengths move: ids stay with their pieces until a sequence is wanted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import cut, text_batches
from lexweave.llm.tokenizer import default_path, encode

WINDOW = 1024
END = 0
#: Rests that one task packs.
GROUP = 4_096


class BestFit:
    """Open windows by remaining capacity; ``place`` returns the window's number and the offset in it."""

    def __init__(self, window: int):
        self.window = window
        self.size = 1 << window.bit_length()
        self.tree = bytearray(2 * self.size)  # 1: some open window has a capacity in the node's range
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.count = 0

    def _set(self, capacity: int, there: int) -> None:
        i, tree = capacity + self.size, self.tree
        tree[i] = there
        while i > 1:
            i >>= 1
            now = tree[2 * i] | tree[2 * i + 1]
            if tree[i] == now:
                break
            tree[i] = now

    def _tightest(self, need: int) -> int:
        """The least capacity of at least ``need`` that some open window has, or -1."""
        i, tree = need + self.size, self.tree
        if tree[i]:
            return need
        while i > 1:
            if not i & 1 and tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1

    def place(self, length: int) -> tuple[int, int]:
        capacity = self._tightest(length)
        if capacity < 0:
            number, offset = self.count, 0
            self.count += 1
            capacity = self.window
        else:
            number = self.open[capacity].pop()
            offset = self.window - capacity
            if not self.open[capacity]:
                self._set(capacity, 0)
        rest = capacity - length
        if rest:
            if not self.open[rest]:
                self._set(rest, 1)
            self.open[rest].append(number)
        return number, offset


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Every document's ids cut into whole windows and a rest.

    Columns: the id, ``start``, ``length``, ``ids`` (array<int>; left out without ``with_ids``), ``ids_crc32``
    (of little-endian unsigned 32-bit ids), ``doc_tokens``. Null text counts as empty (one id, the end).
    """
    text_batches(df.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, starts, lengths, ids, crcs, totals = [], [], [], [], [], []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                whole = np.array([*encode(path, text or ""), END], "<u4")
                for at in range(0, len(whole), window):
                    part = whole[at : at + window]
                    docs.append(doc)
                    starts.append(at)
                    lengths.append(len(part))
                    crcs.append(zlib.crc32(part.tobytes()))
                    totals.append(len(whole))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            columns = [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(totals, pa.int64())]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Offsets of a sequence leave no gap from 0 on. Repeated rows and rows with a null id are packed like others;
    an empty table gives no rows; other columns are ignored. The pieces are written to the shared folder first,
    as their texts are encoded once and their groups counted.
    """
    made, _ = cut(pieces(df, id_col, text_col, path, window, with_ids))
    rest = made.where(F.col("length") < window)
    n_rest = rest.count()
    groups = max(1, -(-n_rest // GROUP))
    whole = made.where(F.col("length") == window).select("*", (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))

    def group(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", id_col, "start"], ascending=[False, True, True], kind="stable")
        fit = BestFit(window)
        placed = [fit.place(n) for n in pdf["length"].tolist()]
        return pdf.drop(columns="_group").assign(sequence_id=[(k[0] << 32) + a for a, _ in placed], offset=[b for _, b in placed])

    schema = made.schema.add("sequence_id", "long").add("offset", "long")
    packed = rest.withColumn("_group", key).groupBy("_group").applyInPandas(group, schema)
    return whole.unionByName(packed)


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = END) -> DataFrame:
    """The token sequences of ``pack(..., with_ids=True)``: ``sequence_id``, ``input_ids``, ``n_used``, ``doc_spans``.

    A sequence is padded to ``window``, unless its length is a power of two. A window holds at most ``window``
    pieces, so each group is small.
    """
    g = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    used = F.flatten(F.transform("p", lambda x: x["ids"]))
    short = F.when(F.bit_count(F.size(used)) == 1, 0).otherwise(F.lit(window) - F.size(used))
    return g.select(
        "sequence_id",
        F.concat(used, F.array_repeat(F.lit(pad), short)).alias("input_ids"),
        F.size(used).alias("n_used"),
        F.transform("p", lambda x: F.struct(x["offset"], x["length"])).alias("doc_spans"),
    )
