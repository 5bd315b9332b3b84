"""Byte-level BPE token ids of a public tokenizer file, as the ``tokenizers`` library gives them.

The vocabulary file names the library's tokenizer. Texts of Latin script take a faster engine built from
the same file (its vocabulary as merge ranks); the two agree there, which the tests check. Other texts go
to the library itself, because the engines' Unicode tables may be of different versions. So do texts with a run of over
``RUN`` characters of white space, on which the faster engine's matcher recurses, and a long text goes there in pieces:
a line feed in front of a letter or digit is a pre-token of its own, so cutting before it changes no id.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

#: The file's own splitting pattern (a fixed value of this public vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ‐-‧‰-⁞₠-₿]*")


#: White space in one run that the faster engine gets, and characters of a text that the library gets at once.
RUN, PIECE = 10_000, 1 << 20
_LONG_RUN = re.compile(rf"\s{{{RUN}}}")
_BREAK = re.compile(r"\n(?=[^\W_])")


@lru_cache(4)
def _library(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


@lru_cache(4)
def _ranks(path: str):
    import tiktoken

    # the byte-level alphabet of this kind of file: printable bytes stand for themselves, others from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ranks = {bytes(char[c] for c in token): i for token, i in model["vocab"].items() if all(c in char for c in token) and not token.startswith("<|")}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> list[str]:
    """``text`` cut in front of line feeds into pieces of about ``PIECE`` characters, where that changes no pre-token."""
    if len(text) <= PIECE:
        return [text]
    out, at = [], 0
    while len(text) - at > PIECE:
        m = _BREAK.search(text, at + PIECE)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


def encode(path: str, text: str) -> list[int]:
    """The ids of ``text``, no special tokens added."""
    if _PLAIN.fullmatch(text) and not _LONG_RUN.search(text):
        return _ranks(path).encode_ordinary(text)
    library = _library(path)
    return [i for p in pieces(text) for i in library.encode(p, add_special_tokens=False).ids]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
