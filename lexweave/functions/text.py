"""Text functions as Columns: normalisation, cleaning, positions, windows, digests, offsets, URLs.

Offsets are code points unless a name says bytes. Patterns that must behave like Unicode-aware ones carry ``(?U)``.
"""

from __future__ import annotations

import html
import re
import unicodedata
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,text:string>>"

#: Prefixes that a rule token loses.
SOURCE_PREFIX = r"^source_(?:condition|requirement|preference|prohibition)_"
TYPED_PREFIX = r"^(?:predicate|action):"


def normalize_token(c: Column) -> Column:
    """Lower case, one source prefix and one typed prefix dropped, other characters than a-z0-9 folded to ``_``."""
    x = F.regexp_replace(F.regexp_replace(F.lower(c), SOURCE_PREFIX, ""), TYPED_PREFIX, "")
    return F.btrim(F.regexp_replace(x, "[^a-z0-9]+", "_"), F.lit("_"))


def strip(c: Column) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\u001c-\u001f]+|[\s\u001c-\u001f]+$", "")


_CP1252 = {0x80 + i: b for i, b in enumerate(bytes([0x80 + i]).decode("cp1252", "ignore") for i in range(32))}


def repair_controls(c: Column) -> Column:
    """C1 control characters that stand for Windows-1252 punctuation, repaired."""
    pairs = [(chr(k), v) for k, v in _CP1252.items() if v]
    return F.translate(c, "".join(k for k, _ in pairs), "".join(v for _, v in pairs))


def clean(c: Column, both_sides: bool = False) -> Column:
    """Repair controls, no-break spaces to spaces, fold horizontal white space, at most one empty line, strip.

    ``both_sides`` drops spaces before a line end too (the web variant); otherwise only after it.
    """
    x = F.regexp_replace(F.translate(repair_controls(c), "\u00a0", " "), r"[\t\x0B\f ]+", " ")
    x = F.regexp_replace(x, r" *\n *" if both_sides else r"\n ", "\n")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def compact(c: Column) -> Column:
    """All white space folded to single spaces, stripped."""
    return strip(F.regexp_replace(F.translate(c, "\u00a0", " "), r"(?U)\s+", " "))


def has_controls(c: Column) -> Column:
    return c.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]")


#: What UTF-8 read as Windows-1252 looks like.
MOJIBAKE = ("Ã", "Â", "â€", "ï»¿", "�")


def has_mojibake(c: Column) -> Column:
    out = F.lit(False)
    for m in MOJIBAKE:
        out = out | F.contains(c, F.lit(m))
    return out


def markers(c: Column, pattern: str) -> Column:
    """Distinct matches of ``pattern``, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))))


def positions(c: Column, pattern: str) -> Column:
    """All matches with places, array<struct<start,end,text>>: what lies between matches gives their offsets."""
    found, between = F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.split(c, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["b"])
        end = start + F.char_length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(x["m"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(one))).alias("spans"))

    return F.aggregate(F.arrays_zip(between.alias("b"), found.alias("m")), zero, step)["spans"]


def byte_view(raw: Column) -> Column:
    """Bytes as a string of one character a byte, so that offsets in it are byte offsets."""
    return F.decode(raw, "ISO-8859-1")


def span_text(c: Column, start: Column, end: Column) -> Column:
    return F.substring(c, start + 1, end - start)


def context_window(c: Column, start: Column, end: Column, radius: int = 120) -> Column:
    """The text around a span, stripped, with the span's place in it: struct<text,start,end>."""
    left = F.greatest(F.lit(0), start - radius)
    raw = F.substring(c, left + 1, end + radius - left)
    lead = F.char_length(raw) - F.char_length(F.regexp_replace(raw, r"(?U)^\s+", ""))
    return F.struct(strip(raw).alias("text"), (start - left - lead).alias("start"), (end - left - lead).alias("end"))


def sha_upper(c: Column) -> Column:
    return F.upper(F.sha2(c.cast("binary"), 256))


def line_number(c: Column, at: Column) -> Column:
    """The line (from 1) that offset ``at`` stands in."""
    before = F.substring(c, F.lit(1), at)
    return F.char_length(before) - F.char_length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def byte_offset(c: Column, at: Column) -> Column:
    return F.octet_length(F.substring(c, F.lit(1), at))


def line_start(c: Column, at: Column) -> Column:
    """The offset at which the line of ``at`` begins."""
    before = F.substring(c, F.lit(1), at)
    return F.char_length(before) - F.char_length(F.substring_index(before, "\n", -1))


def canonical_rule_id(c: Column) -> Column:
    """Upper case, but for a suffix in parentheses."""
    head = F.substring_index(c, "(", 1)
    return F.concat(F.upper(head), F.substring(c, F.char_length(head) + 1, F.char_length(c)))


def strip_comments(c: Column) -> Column:
    return F.regexp_replace(c, "(?s)<!--.*?-->", "")


def mask_comments(c: Column) -> Column:
    """Comments blanked, line ends and all offsets kept."""
    parts = F.split(c, "(?s)<!--.*?-->", -1)
    held = F.transform(F.regexp_extract_all(c, F.lit("(?s)<!--.*?-->"), F.lit(0)), lambda m: F.regexp_replace(m, r"[^\r\n]", " "))
    return F.array_join(F.flatten(F.transform(F.arrays_zip(parts.alias("p"), held.alias("h")), lambda x: F.array_compact(F.array(x["p"], x["h"])))), "")


def visible_text(c: Column) -> Column:
    """Text a reader sees: no comments, scripts or styles, tags as spaces, white space folded."""
    x = F.regexp_replace(strip_comments(c), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    return compact(unescape_basic(F.regexp_replace(x, r"(?s)<[^>]*>", " ")))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag, in double, single or no quotes; null without it."""
    head = rf"(?i)(?:^|[\s\"'/]){name}\s*=\s*"
    double, single, bare = (F.regexp_extract(tag, head + p, 1) for p in ('"([^"]*)"', "'([^']*)'", r"([^\s\"'>]+)"))
    return F.when(tag.rlike(head + '"'), double).when(tag.rlike(head + "'"), single).when(tag.rlike(head + r"[^\s\"'>]"), bare)


def unescape_basic(c: Column) -> Column:
    """The five markup entities and the no-break space; ``unescape`` knows all."""
    for name, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(ch))
    return c


def _texts(f):
    return lambda a: pa.array([None if x is None else f(x) for x in a.to_pylist()], pa.string())


def unescape(c: Column) -> Column:
    """All HTML5 entities; numeric references to C1 controls as browsers read them."""

    @F.arrow_udf("string")
    def of(a: pa.Array) -> pa.Array:
        return _texts(html.unescape)(a)

    return of(c)


def unescape_html4(c: Column) -> Column:
    """Named entities of HTML 4 and numeric ones only; unknown names stay as they are."""

    @F.arrow_udf("string")
    def of(a: pa.Array) -> pa.Array:
        from html.entities import name2codepoint

        def one(m: re.Match) -> str:
            if m[1]:
                code = int(m[1][1:], 16) if m[1][0] in "xX" else int(m[1])
                return _CP1252.get(code) or (chr(code) if 0 < code < 0x110000 else m[0])
            return chr(name2codepoint[m[2]]) if m[2] in name2codepoint else m[0]

        return _texts(lambda x: re.sub(r"&(?:#([xX][0-9a-fA-F]+|[0-9]+)|([A-Za-z][A-Za-z0-9]*));", one, x))(a)

    return of(c)


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base``: struct<url,file,fragment>; ``file`` is the last path segment, lower case."""

    @F.arrow_udf("string")
    def of(bases: pa.Array, hrefs: pa.Array) -> pa.Array:
        return pa.array([None if b is None or h is None else urljoin(b, h) for b, h in zip(bases.to_pylist(), hrefs.to_pylist(), strict=True)], pa.string())

    url = of(base, href)
    plain = F.substring_index(url, "#", 1)
    return F.struct(
        plain.alias("url"),
        F.lower(F.substring_index(F.substring_index(plain, "?", 1), "/", -1)).alias("file"),
        F.when(F.contains(url, F.lit("#")), F.substring(url, F.char_length(plain) + 2, F.char_length(url))).alias("fragment"),
    )


#: Abbreviations after which a full stop ends no sentence.
ABBREVIATIONS = ("e.g", "i.e", "etc", "cf", "vs", "fig", "figs", "no", "nos", "ref", "refs", "eq", "ed", "eds", "vol", "pp", "p", "al", "dr", "mr", "mrs", "prof", "st", "viz", "approx", "resp")


def sentence_spans_of(text: str) -> list[tuple[int, int]]:
    """Spans of sentences: ends at . ! ? ; with closing punctuation, unless an abbreviation, a number, a single letter
    or a lower-case continuation says otherwise. Spans are stripped and cover every visible character once."""
    spans, start, i, n = [], 0, 0, len(text)
    while i < n:
        ch = text[i]
        if ch in ".!?;":
            end = i + 1
            while end < n and (text[end] in ".!?;" or text[end] in "\"')]}" or unicodedata.category(text[end]) in ("Pf", "Pe")):
                end += 1
            rest = text[end:].lstrip() if end < n else ""
            cut = end >= n or text[end].isspace()
            if cut and ch == "." and rest:
                word = re.search(r"[\w.]*$", text[start:i])[0].lower().rstrip(".")
                if word in ABBREVIATIONS or (len(word) == 1 and word.isalpha()) or rest[0].islower():
                    cut = False
            if cut:
                spans.append((start, end))
                start = end
            i = end
            continue
        i += 1
    spans.append((start, n))
    out = []
    for a, b in spans:
        piece = text[a:b]
        lead = len(piece) - len(piece.lstrip())
        body = piece.strip()
        if body:
            out.append((a + lead, a + lead + len(body)))
    return out


def sentence_spans(c: Column) -> Column:
    """``sentence_spans_of`` as array<struct<start,end>>; null for null."""

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def of(a: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([None if x is None else [{"start": s, "end": e} for s, e in sentence_spans_of(x)] for x in a.to_pylist()], kind)

    return of(c)


def segments(c: Column) -> Column:
    """Sentence-like segments by pattern alone, stripped, none empty: the form that plain SQL can say as well."""
    return F.filter(F.transform(F.split(c, r"[.!?;]+\s+", -1), lambda s: F.btrim(s)), lambda s: s != "")
