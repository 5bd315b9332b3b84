"""Edit-aware token counts: a segment tree of pre-token runs per document.

A leaf is a run of about ``LEAF`` pre-tokens that doesn't end in white space; a node has up to twice ``FAN`` children and
keeps the characters and tokens below it. The row holds the whole tree, level by level, inner sums included. An edit re-reads pre-tokens from the last leaf edge that it can't have moved (the splitting
pattern looks at most two characters past a pre-token; ``CONTEXT`` is more) up to the first old leaf edge that
the new splitting meets again. Only those leaves are re-encoded; they are spliced in,
and only the nodes above them are dealt and summed again, level by level up to the root.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import text_batches
from lexweave.llm.tokenizer import PATTERN, default_path, encode

LEAF = 32
CONTEXT = 4
FAN = 16
#: Levels from the leaves (no children) to the root.
TREE = "struct<kids:array<array<int>>,chars:array<array<bigint>>,tokens:array<array<bigint>>>"
_LISTS = {"kids": pa.list_(pa.list_(pa.int32())), "chars": pa.list_(pa.list_(pa.int64())), "tokens": pa.list_(pa.list_(pa.int64()))}
_ARROW = pa.struct(list(_LISTS.items()))


@lru_cache(1)
def _split() -> regex.Pattern:
    return regex.compile(PATTERN)


def leaves(text: str, path: str, start: int = 0) -> list[tuple[int, int]]:
    """(characters, tokens) of the runs of ``text`` from ``start`` on."""
    out, parts = [], _split().findall(text, start)
    at, n = 0, len(parts)
    while at < n:
        end = min(n, at + LEAF)
        while end < n and parts[end - 1].isspace():
            end += 1
        run = "".join(parts[at:end])
        out.append((len(run), len(encode(path, run))))
        at = end
    return out


class TokenTree:
    """A text, and the tree over its leaves; ``row`` is what a column holds."""

    def __init__(self, text: str, path: str, row: dict | None = None):
        self.text, self.path, self.reencoded, self.summed = text, path, 0, 0
        self.kids: list[list[int]] = [[]]
        self.chars: list[list[int]] = [[]]
        self.tokens: list[list[int]] = [[]]
        if row is not None and row["chars"]:
            self.kids, self.chars, self.tokens = ([list(x) for x in row[c]] for c in _LISTS)
        else:
            self._splice(0, 0, 0, leaves(text, path))

    @property
    def row(self) -> dict:
        return {"kids": self.kids, "chars": self.chars, "tokens": self.tokens}

    @property
    def count(self) -> int:
        return sum(self.tokens[-1])

    def runs(self) -> list[tuple[int, int]]:
        return list(zip(self.chars[0], self.tokens[0], strict=True))

    def _splice(self, level: int, first: int, last: int, new: list[tuple[int, int]], kids: list[int] | None = None) -> None:
        """Put ``new`` (characters, tokens) in place of the nodes ``first`` to ``last`` of a level, and mend those above."""
        self.kids[level][first:last] = kids or []
        self.chars[level][first:last] = [c for c, _ in new]
        self.tokens[level][first:last] = [t for _, t in new]
        if level + 1 == len(self.chars):
            if len(self.chars[level]) > 1:
                for x in (self.kids, self.chars, self.tokens):
                    x.append([])
                self._splice(level + 1, 0, 0, *self._dealt(level, 0, len(self.chars[level])))
            return
        above, a, at = self.kids[level + 1], 0, 0
        while a + 1 < len(above) and at + above[a] <= first:
            at += above[a]
            a += 1
        b, end = a, at  # nodes a to b above hold what was replaced
        while b < len(above) and (end < last or b == a):
            end += above[b]
            b += 1
        size = end - at + len(new) - (last - first)
        if size < FAN // 2 and b < len(above):  # too few for a node of their own
            size += above[b]
            b += 1
        sums, sizes = self._dealt(level, at, size)
        self._splice(level + 1, a, b, sums, sizes)
        while len(self.chars) > 1 and len(self.chars[-2]) < 2:
            for x in (self.kids, self.chars, self.tokens):
                x.pop()

    def _dealt(self, level: int, at: int, size: int) -> tuple[list[tuple[int, int]], list[int]]:
        """Sums and sizes of new nodes over ``size`` nodes of a level."""
        sizes = [size] if 0 < size <= 2 * FAN else [min(FAN, size - k) for k in range(0, size, FAN)]
        sums = []
        for n in sizes:
            sums.append((sum(self.chars[level][at : at + n]), sum(self.tokens[level][at : at + n])))
            at += n
            self.summed += 1
        return sums, sizes

    def _leaf(self, position: int) -> tuple[int, int]:
        """The leaf that holds ``position`` (the last one beyond the end), and where it starts."""
        i, end, base = 0, len(self.chars[-1]), 0  # the node, and where its siblings end
        for level in range(len(self.chars) - 1, -1, -1):
            chars = self.chars[level]
            while i + 1 < end and position - base >= chars[i]:
                base += chars[i]
                i += 1
            if level:
                start = sum(self.kids[level][:i])
                i, end = start, start + self.kids[level][i]
        return i, base

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace characters ``start``..``end`` by ``new``; offsets beyond the text are drawn in. Returns the new count."""
        n = len(self.text)
        start = min(max(start, 0), n)
        end = min(max(end, start), n)
        moved = len(new) - (end - start)
        first, base = self._leaf(max(0, start - CONTEXT))
        self.text = self.text[:start] + new + self.text[end:]
        leaf, edge = first, base  # the old leaf whose start is at ``edge`` in the old text
        used, chars = len(self.chars[0]), self.chars[0]
        while leaf < used and edge < end:
            edge += chars[leaf]
            leaf += 1
        at, parts, met = base, [], False
        for m in _split().finditer(self.text, base):
            parts.append(m.group())
            at = m.end()
            while leaf < used and edge + moved < at:
                edge += chars[leaf]
                leaf += 1
            if edge + moved == at and edge >= end and not parts[-1].isspace():
                met = True
                break
        if not met:
            leaf = used
        self.reencoded += at - base
        runs = []
        for k in range(0, len(parts), LEAF):
            runs.append(parts[k : k + LEAF])
        fixed: list[list[str]] = []
        for r in runs:  # a run ends in white space only at the text's end
            if fixed and fixed[-1][-1].isspace():
                fixed[-1].extend(r)
            else:
                fixed.append(list(r))
        got = [(len(s), len(encode(self.path, s))) for s in ("".join(r) for r in fixed)]
        self._splice(0, first, leaf, got)
        return self.count


def build(df: DataFrame, text_col: str = "text", out: str = "tree", path: str | None = None) -> DataFrame:
    """``df`` with ``out``, the tree; ``count(out)`` is the document's token count.

    Null and empty texts have no leaves and count 0.
    """
    text_batches(df.sparkSession)
    path = path or default_path()

    @F.arrow_udf(TREE)
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([TokenTree(t or "", path).row for t in texts.to_pylist()], _ARROW)

    return df.withColumn(out, of(F.col(text_col).cast("string")))


def count(tree: str = "tree"):
    """The number of tokens in a tree column, as a Column."""
    return F.aggregate(F.element_at(F.col(tree)["tokens"], -1), F.lit(0).cast("long"), lambda a, x: a + x)


def apply_edits(df: DataFrame, edits_col: str = "edits", text_col: str = "text", tree_col: str = "tree", out: str = "edited", path: str | None = None) -> DataFrame:
    """``df`` with ``out``: the text and tree after ``edits_col`` (array<struct<start,end,text>> in order, code points
    of the text as it then is), and ``reencoded``, the characters that were encoded again. Null edits: none."""
    text_batches(df.sparkSession)
    path = path or default_path()

    @F.arrow_udf(f"struct<text:string,tree:{TREE},n_tokens:bigint,reencoded:bigint>")
    def of(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
        rows = []
        for text, t, todo in zip(texts.to_pylist(), trees.to_pylist(), edits.to_pylist(), strict=True):
            own = TokenTree(text or "", path, t)
            for e in todo or []:
                a, b, new = e.values()
                own.edit(a or 0, a or 0 if b is None else b, new or "")
            rows.append({"text": own.text, "tree": own.row, "n_tokens": own.count, "reencoded": own.reencoded})
        return pa.array(rows, pa.struct([("text", pa.string()), ("tree", _ARROW), ("n_tokens", pa.int64()), ("reencoded", pa.int64())]))

    return df.withColumn(out, of(F.col(text_col).cast("string"), F.col(tree_col), F.col(edits_col)))
