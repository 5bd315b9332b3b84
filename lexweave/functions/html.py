"""Stateful HTML scans: lexing, element census, reference occurrences, document nodes.

They work on one text each and are run by Arrow functions over batches; places are offsets of the text given, so
on a one-character-a-byte view they are byte offsets.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that begin a new line of text, and elements without content.
BLOCK = frozenset("address article aside blockquote body br caption center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset(("script", "style"))


@dataclass(frozen=True)
class Token:
    kind: str  # tag, text, comment, declaration
    start: int
    end: int
    name: str = ""
    closing: bool = False
    self_closing: bool = False


def lex(text: str, quotes: bool = True) -> Iterator[Token]:
    """Tokens that cover ``text`` without a gap. With ``quotes`` a ``>`` inside a quoted value doesn't end a tag;
    without, a tag ends at the first one. The content of scripts and styles is text."""
    at, n, lower = 0, len(text), text.lower()
    while at < n:
        lt = text.find("<", at)
        while lt >= 0 and not (lt + 1 < n and (text[lt + 1].isalpha() or text[lt + 1] in "/!?")):
            lt = text.find("<", lt + 1)
        if lt < 0:
            yield Token("text", at, n)
            return
        if lt > at:
            yield Token("text", at, lt)
        if text.startswith("<!--", lt):
            end = text.find("-->", lt + 4)
            end = n if end < 0 else end + 3
            yield Token("comment", lt, end)
        elif text[lt + 1] in "!?":
            end = text.find(">", lt)
            end = n if end < 0 else end + 1
            yield Token("declaration", lt, end)
        else:
            end = _tag_end(text, lt, quotes)
            m = re.match(r"</?\s*([A-Za-z][A-Za-z0-9:-]*)", text[lt:end])
            name = m[1].lower() if m else ""
            closing = text[lt + 1] == "/"
            yield Token("tag", lt, end, name, closing, text[lt:end].endswith("/>") or name in VOID)
            if name in RAW and not closing:
                stop = lower.find(f"</{name}", end)
                stop = n if stop < 0 else stop
                if stop > end:
                    yield Token("text", end, stop, name)
                end = stop
        at = end


def _tag_end(text: str, at: int, quotes: bool) -> int:
    quote, n = "", len(text)
    for i in range(at + 1, n):
        ch = text[i]
        if quote:
            quote = "" if ch == quote else quote
        elif quotes and ch in "\"'" and text[at:i].rstrip().endswith("="):
            quote = ch
        elif ch == ">":
            return i + 1
    return n


_ATTRIBUTE = re.compile(r"""([A-Za-z_:][\w:.-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def attributes(tag: str) -> dict[str, tuple[str, int, int]]:
    """Attributes of a start tag: name to (value, start, end of the value in ``tag``); the first of a name counts."""
    out: dict[str, tuple[str, int, int]] = {}
    m0 = re.match(r"<\s*[A-Za-z][A-Za-z0-9:-]*", tag)
    for m in _ATTRIBUTE.finditer(tag, m0.end() if m0 else 0):
        g = next((k for k in (2, 3, 4) if m[k] is not None), None)
        out.setdefault(m[1].lower(), (m[g], m.start(g), m.end(g)) if g else ("", m.end(), m.end()))
    return out


def visible(text: str) -> tuple[str, list[int]]:
    """What a reader sees, white space folded and stripped, and for each character where it comes from."""
    chars: list[str] = []
    origin: list[int] = []

    def put(ch: str, at: int) -> None:
        if ch.isspace():
            if not chars or chars[-1] == " ":
                return
            ch = " "
        chars.append(ch)
        origin.append(at)

    for t in lex(text):
        if t.kind == "tag" and t.name in BLOCK:
            put(" ", t.start)
        elif t.kind == "text" and t.name not in RAW:
            at = t.start
            for m in re.finditer(r"&(?:#[xX]?[0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);?|.", text[t.start : t.end], re.S):
                for ch in html.unescape(m.group()) if m.group()[0] == "&" else m.group():
                    put(ch, at + m.start())
    while chars and chars[-1] == " ":
        chars.pop()
        origin.pop()
    return "".join(chars), origin


def reference_scan(text: str, own: str, rule_id: str) -> Iterator[tuple[str, str, str, str | None, int, int]]:
    """References of a fragment: (kind, text, cited id, href, start, end).

    Ids in text count once the fragment's own heading has passed; inside a link they are of kind href. A link whose text
    cites nothing is a reference by itself, unless it has no target. Block tags end an open link.
    """
    pattern = re.compile(rf"\b{rule_id}\b", re.I)
    href: str | None = None
    opened, cited_in_link, heading = 0, False, True
    label: list[tuple[str, int, int]] = []

    def close(end: int) -> Iterator[tuple]:
        nonlocal href
        if href is not None and not cited_in_link and href:
            words = re.sub(r"\s+", " ", html.unescape("".join(x for x, _, _ in label))).strip()
            m = pattern.search(href)
            yield "href", words, (m.group().upper() if m else None), href, opened, end
        href = None

    for t in lex(text):
        if t.kind == "tag":
            if t.name == "a" and not t.closing:
                yield from close(t.start)
                value = attributes(text[t.start : t.end]).get("href")
                if value:
                    href, opened, cited_in_link, label = html.unescape(value[0]), t.start, False, []
            elif (t.name == "a" and t.closing) or t.name in BLOCK:
                yield from close(t.end if t.name == "a" else t.start)
        elif t.kind == "text" and t.name not in RAW:
            if href is not None:
                label.append((text[t.start : t.end], t.start, t.end))
            for m in pattern.finditer(text, t.start, t.end):
                cited = m.group().upper()
                if heading and cited == own.upper():
                    heading = False
                    continue
                heading = False
                if href is not None:
                    cited_in_link = True
                yield ("href" if href is not None else "text"), m.group(), cited, href, m.start(), m.end()
    yield from close(len(text))


def census(text: str) -> list[tuple[str, int, int]]:
    """Physical elements (name, start, end of the start tag) outside comments and scripts, unclosed ones too."""
    return [(t.name, t.start, t.end) for t in lex(text, quotes=False) if t.kind == "tag" and not t.closing and t.name]


#: Node kinds of document trees.
NODE_KINDS = ("heading", "paragraph", "list", "list_item", "table", "table_row", "table_cell", "image", "line_break", "link", "note", "prose")
_KIND = {**{f"h{i}": "heading" for i in range(1, 7)}, "p": "paragraph", "ul": "list", "ol": "list", "li": "list_item", "table": "table", "tr": "table_row", "td": "table_cell", "th": "table_cell", "img": "image", "a": "link", "blockquote": "note"}
#: Start tags that end an open element of the kinds given.
_CLOSES = {"p": ("p",), "li": ("p", "li"), "tr": ("p", "td", "th", "tr"), "td": ("p", "td", "th"), "th": ("p", "td", "th"), "table": ("p",), "ul": ("p",), "ol": ("p",), **{f"h{i}": ("p",) for i in range(1, 7)}, "div": ("p",), "article": ("p",), "footer": ("p",), "nav": ("p",)}


def nodes(text: str) -> list[tuple[int, int | None, str, str, str, int, int, str]]:
    """A flat document tree in pre-order: (ordinal, parent ordinal, path, kind, tag, start, end, own text).

    Elements without an end tag end where a tag implies it, at their parent's end, or at the end of the text.
    """
    out: list[list] = []
    stack: list[tuple[str, int | None]] = []
    children: dict[int | None, int] = {}

    def parent() -> int | None:
        return next((i for _, i in reversed(stack) if i is not None), None)

    def shut(name: str, at: int) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                for _, i in stack[k:]:
                    if i is not None:
                        out[i][6] = at
                del stack[k:]
                return

    for t in lex(text):
        if t.kind == "text" and t.name not in RAW:
            words = re.sub(r"\s+", " ", html.unescape(text[t.start : t.end]))
            p = parent()
            if p is not None:
                out[p][7] += words
            elif words.strip():
                k = children[None] = children.get(None, 0) + 1
                out.append([len(out), None, f"/{k - 1}", "prose", "", t.start, t.end, words.strip()])
        elif t.kind == "tag" and t.closing:
            shut(t.name, t.end)
        elif t.kind == "tag":
            for name in _CLOSES.get(t.name, ()):
                limit = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in ("table", "ul", "ol") and t.name in ("tr", "td", "th", "li", "p")), -1)
                if any(s == name for s, _ in stack[limit + 1 :]):
                    shut(name, t.start)
            if t.name in _KIND:
                p = parent()
                k = children[p] = children.get(p, 0) + 1
                i = len(out)
                out.append([i, p, f"{out[p][2] if p is not None else ''}/{k - 1}", _KIND[t.name], t.name, t.start, t.end if t.self_closing else len(text), ""])
                if not t.self_closing:
                    stack.append((t.name, i))
            elif not t.self_closing:
                stack.append((t.name, None))
    for r in out:
        r[7] = r[7].strip()
    return [tuple(r) for r in out]


def _rows(df: DataFrame, id_col: str, text_col: str, scan, fields: str) -> DataFrame:
    schema = f"`{id_col}` {dict(df.dtypes)[id_col]}, {fields}"
    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *r) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for r in scan(t or "")]
            cols = zip(*rows, strict=True) if rows else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], names=arrow.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def token_table(df: DataFrame, id_col: str, text_col: str, quotes: bool = True) -> DataFrame:
    """All tokens: ``kind``, ``start``, ``end``, ``tag``, ``closing``, ``self_closing``."""
    return _rows(df, id_col, text_col, lambda t: ((x.kind, x.start, x.end, x.name, x.closing, x.self_closing) for x in lex(t, quotes)), "kind string, start int, end int, tag string, closing boolean, self_closing boolean")


def census_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All physical elements: ``tag``, ``start``, ``end``."""
    return _rows(df, id_col, text_col, census, "tag string, start int, end int")


def node_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Flat document trees: ``ordinal``, ``parent``, ``path``, ``kind``, ``tag``, ``start``, ``end``, ``text``."""
    return _rows(df, id_col, text_col, nodes, "ordinal int, parent int, path string, kind string, tag string, start int, end int, text string")


def visible_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Visible text: ``visible`` and ``origin``, the place each of its characters comes from."""
    return _rows(df, id_col, text_col, lambda t: [visible(t)], "visible string, origin array<int>")
