"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text is marked (a word mark in front, every space a mark) and cut into words, each a run of marks and what
follows it. The distinct words of a batch are sorted, which puts them in the order of a depth-first walk of
their trie; the forward table of a word is kept up to the prefix it shares with the next one.

The model is a BPE model: its ids are those of greedy merging, not of the largest sum of scores, so a plain
sum-of-scores Viterbi would give other ids than the library. The forward pass therefore scores a step by
whether it may follow: for every prefix the last piece of its encoding is the one piece that ends there and is
compatible with the last piece of the prefix before it (merging both texts gives back just these two). There
is exactly one, so the table keeps one back pointer a position and the path read from the end is exact.
Characters that no piece has become bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import text_batches

MARK = "▁"
#: Characters of the words remembered by one worker, and of the longest word worth it; a full memory is emptied, results
#: don't depend on it.
REMEMBER, WORTH = 12_000_000, 200


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str) -> list[str]:
    """The words of a marked text, each without its first mark and with further leading marks as spaces."""
    if MARK in text:
        text = text.replace(MARK, " ")
    words = text.split(" ")
    if "  " not in text and words[0] and words[-1]:
        return words
    out, lead = [], 0
    for w in words[:-1]:
        if w:
            out.append(" " * lead + w)
            lead = 0
        else:
            lead += 1
    out.append(" " * lead + words[-1])
    return out


class Pieces:
    """The pieces of a model file and the shared-prefix encoder over them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.text = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.byte = [-1] * len(self.text)
        self.of_byte = [0] * 256
        self.ids: dict[str, int] = {}
        for i, p in enumerate(self.text):
            if sp.is_byte(i):
                self.byte[i] = int(p[3:5], 16)
                self.of_byte[self.byte[i]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[p] = i
        self.skip = {i for i in range(len(self.text)) if sp.is_control(i)}
        self.score = [sp.get_score(i) for i in range(len(self.text))]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses words")
        # the order in which merging makes pieces (characters: -1), and the two parts that each is made of
        by_score = sorted((i for p, i in self.ids.items() if len(p) > 1), key=lambda i: -self.score[i])
        self.rank = {self.text[i]: r for r, i in enumerate(by_score)}
        self.parts: dict[str, tuple[str, str]] = {}
        for p in self.rank:
            steps = self.merge(p, 2)
            if len(steps) == 2:
                self.parts[p] = (steps[0], steps[1])
        # forward automaton over pieces that merging reaches: state -> character -> state, and the piece that ends there
        self.step: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for p in [*self.parts, *(c for c in self.ids if len(c) == 1)]:
            at = 0
            for ch in p:
                if ch not in self.step[at]:
                    self.step[at][ch] = len(self.step)
                    self.step.append({})
                    self.ends.append(None)
                if ch == MARK:
                    self.step[at][" "] = self.step[at][ch]
                at = self.step[at][ch]
            self.ends[at] = p
        self.fits: dict[str, dict[str, bool]] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0
        self.code = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.plain = np.array([b < 0 and i not in self.skip for i, b in enumerate(self.byte)])

    def merge(self, text: str, until: int = 1) -> list[str]:
        """Greedy merging of the best pair, leftmost first, down to ``until`` parts: only ever applied to one piece."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.rank.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or k < best):
                    best, at = k, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts if len(parts) < 2 or until == 1 or parts[0] + parts[1] in self.rank else list(text)[:1]

    def follows(self, a: str, b: str) -> bool:
        """Whether merging the two texts gives back just these pieces: their merges are undone, the latest first, and
        at no stage may the parts that touch have been merged before."""
        rank, parts = self.rank, self.parts
        limit = len(rank) + 1
        while True:
            both = rank.get(a + b)
            if both is not None and both < limit:
                return False
            x, y = rank.get(a, -1) if a in parts else -1, rank.get(b, -1) if b in parts else -1
            if x > y:
                limit, a = x, parts[a][1]
            elif y >= 0:
                limit, b = y + 1, parts[b][0]
            else:
                return True

    def learn(self, words: set[str]) -> None:
        """Encode and remember ``words``, in trie order."""
        new = sorted(words)
        step, ends, fits, follows, known, code, root = self.step, self.ends, self.fits, self.follows, self.words, self.code, self.step[0]
        # for each prefix of the marked word: the last piece of its encoding, where that starts, and the pieces under way
        # (start, state); the mark in front is common to all words
        before, last, back, under = "", ["", MARK], [0, 0], [[], [(0, root[MARK])]]
        for word in new:
            shared = 1
            for x, y in zip(word, before, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], back[shared + 1 :], under[shared + 1 :]
            end = shared
            for ch in word[shared - 1 :]:
                ahead, found, at = [], None, end
                for start, state in under[end]:
                    to = step[state].get(ch)
                    if to is not None:
                        ahead.append((start, to))
                        if found is None:
                            piece = ends[to]
                            if piece is not None:
                                if start:
                                    row = fits.get(last[start])
                                    if row is None:
                                        row = fits[last[start]] = {}
                                    fit = row.get(piece)
                                    if fit is None:
                                        fit = row[piece] = follows(last[start], piece)
                                    if not fit:
                                        continue
                                found, at = piece, start
                to = root.get(ch)
                if to is not None:
                    ahead.append((end, to))
                if found is None:  # the character alone; a space stands for a mark
                    found = ch if ch != " " else MARK
                last.append(found)
                back.append(at)
                under.append(ahead)
                end += 1
            ids = []
            while end:  # read from the end
                own = code.get(last[end])
                if own is None:
                    own = b"".join(self.of_byte[b].to_bytes(4, "little") for b in last[end].encode("utf-8", "surrogatepass"))
                ids.append(own)
                end = back[end]
            known[word] = b"".join(reversed(ids))
            before = word

    def encode_packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        cut = [words_of(t) if t else [] for t in texts]
        known = self.words
        got = [list(map(known.get, words)) for words in cut]
        open_ = [(g, words, [i for i, x in enumerate(g) if x is None]) for words, g in zip(cut, got, strict=True) if None in g]
        missing = {words[i] for _, words, at in open_ for i in at}
        self.held += sum(map(len, missing))
        if self.held > REMEMBER:
            known.clear()
            got = [list(map(known.get, words)) for words in cut]
            open_ = [(g, words, range(len(words))) for words, g in zip(cut, got, strict=True) if words]
            missing = {w for words in cut for w in words}
            self.held = sum(map(len, missing))
        self.learn(missing)
        for g, words, at in open_:
            for i in at:
                g[i] = known[words[i]]
        for w in missing:
            if len(w) > WORTH:
                self.held -= len(w)
                del known[w]
        return list(map(b"".join, got))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(x, "<i4").tolist() for x in self.encode_packed(texts)]

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ``ids``: bytes join to characters, marks become spaces, the first mark goes."""
        text, byte = self.text, self.byte
        ids = np.asarray(ids, np.int64)
        plain, ids = self.plain[ids].all(), ids.tolist()
        if plain:
            return "".join([text[i] for i in ids]).replace(MARK, " ").removeprefix(" ")
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if byte[i] >= 0:
                held.append(byte[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i not in self.skip:
                out.append(text[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ").removeprefix(" ")


@lru_cache(2)
def model(path: str) -> Pieces:
    return Pieces(path)


def encode(df: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with ``out``, an array<int> of ids; null and empty texts give an empty array."""
    text_batches(df.sparkSession)
    path = path or default_path()

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        got = model(path).encode_packed(texts.to_pylist())
        offsets = np.cumsum([0, *(len(x) // 4 for x in got)], dtype=np.int32)
        flat = np.frombuffer(b"".join(got), "<i4")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return df.withColumn(out, of(F.col(text_col).cast("string")))


def decode(df: DataFrame, ids_col: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with ``out``, the text of ``ids_col`` (a null array: null). A word mark that stood in the original text
    comes back as a space, as with the library; everything else comes back as it was."""
    text_batches(df.sparkSession)
    path = path or default_path()

    @F.arrow_udf("string")
    def of(ids: pa.Array) -> pa.Array:
        m = model(path)
        flat, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        some = ids.is_valid().to_pylist()
        return pa.array([m.decode(flat[at[k] : at[k + 1]]) if some[k] else None for k in range(len(ids))], pa.string())

    return df.withColumn(out, of(F.col(ids_col)))
