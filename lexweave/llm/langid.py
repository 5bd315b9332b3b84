"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed letter n-grams (1 to 3 letters inside words, word edges
marked; term frequencies damped by a logarithm). Each language has several centroids, found by spherical k-means
over a bounded sample of its labelled texts. The nearest centroid by cosine names the language. A text is
rejected if it lies too far from its centroid for its length. For each language and band of lengths the least cosine
allowed lies half-way between those of nearly all its own training texts and of nearly all training texts of other
languages, and at most at ``NEAR`` of its own; every band is learned, the short ones from excerpts of the training texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import bounded_sample, text_batches

SPACE = 1 << 13
BOUND = 400
CENTROIDS = 4
UNKNOWN = "und"
#: Shares of own training texts below, and of other languages' above, which a floor leaves out; its most, as a share of the former.
OUTLYING, FOREIGN, NEAR = 0.002, 0.99, 0.85
#: Numbers of letters at which a new band of lengths begins.
BANDS = (0, 8, 16, 32, 64, 128, 256, 512)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> tuple[np.ndarray, int]:
    """Counts of the hashed n-grams of a whole text, and its number of letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    n = int(letter.sum())
    if not n:
        return np.zeros(SPACE, np.int64), 0
    kept = np.where(letter, points, 0).astype(np.uint64)
    kept = np.concatenate([np.zeros(1, np.uint64), kept[letter | np.r_[True, letter[:-1]]], np.zeros(1, np.uint64)])
    a, b, c = kept[:-2], kept[1:-1], kept[2:]
    inner = b > 0
    k = np.uint64(0x9E3779B97F4A7C15)
    one = b[inner] * k
    two = (a[inner] * np.uint64(0x110000) + b[inner] + np.uint64(1 << 42)) * k
    three = ((a[inner] * np.uint64(0x110000) + b[inner]) * np.uint64(0x200000) + c[inner] + np.uint64(1 << 63)) * k
    h = np.concatenate([one, two, three])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.bincount((h >> np.uint64(64 - 13)).astype(np.int64), minlength=SPACE), n


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (number, SPACE), each of length 1
    of: np.ndarray  # the language of each centroid
    floor: np.ndarray  # (language, band): the least cosine that isn't rejected

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """The language, the cosine (0 to 1) to its nearest centroid, and whether the text is rejected."""
        got, n = counts(text)
        if not n or not self.languages:
            return UNKNOWN, 0.0, True
        cos = nearest(got, self)
        best = int(np.argmax(cos))
        lang = int(self.of[best])
        score = float(min(1.0, max(0.0, cos[best])))
        return self.languages[lang], score, score < self.floor[lang, band(n)]


def band(n: int) -> int:
    return int(np.searchsorted(BANDS, n, side="right")) - 1


def weigh(got: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(got)
    v = np.log1p(got[at]) * idf[at]
    return at, v / max(float(np.sqrt(v @ v)), 1e-12)


def nearest(got: np.ndarray, m: Model) -> np.ndarray:
    at, v = weigh(got, m.idf)
    return m.centroids[:, at] @ v


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out starting points (each the farthest from those before)."""
    start = [int(np.argmax(x @ x.mean(0)))]
    for _ in range(1, min(k, len(x))):
        start.append(int(np.argmin((x @ x[start].T).max(1))))
    c = x[start]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        new = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
    return c


def excerpts(text: str, key: int = 0) -> list[str]:
    """For each band of lengths a part of ``text`` with so many letters, if it has as many; words stay whole at the start."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    upto, out = np.cumsum(letter), []
    for b, low in enumerate(BANDS):
        high = BANDS[b + 1] if b + 1 < len(BANDS) else 2 * low
        size = max(2, low) + (key * 7 + b) % max(1, high - max(2, low))
        spare = int(upto[-1]) - size if len(upto) else -1
        if spare < 0:
            continue
        starts = np.flatnonzero(letter & ~np.r_[False, letter[:-1]] & (upto <= spare + 1))
        at = int(starts[(key * 31 + b) % len(starts)])
        end = int(np.searchsorted(upto, upto[at] - 1 + size)) + 1
        out.append(text[at:end])
    return out


def fit(rows: list[tuple[str, np.ndarray, np.ndarray, int, bool]], k: int = CENTROIDS) -> Model:
    """Fit on (language, ids of n-grams, their counts, number of letters, whether it is an excerpt); excerpts are used
    for the floors only."""
    rows = [r for r in rows if r[3]]
    whole = [r for r in rows if not r[4]]
    languages = sorted({r[0] for r in whole})
    df = np.zeros(SPACE)
    for _, ids, *_ in whole:
        df[ids] += 1
    idf = (np.log((1 + len(whole)) / (1 + df)) + 1).astype(np.float32)
    lists, of = [], []
    for j, lang in enumerate(languages):
        own = [r for r in whole if r[0] == lang]
        x = np.zeros((len(own), SPACE), np.float32)
        for i, (_, ids, n, *_) in enumerate(own):
            v = np.log1p(n) * idf[ids]
            x[i, ids] = v / max(float(np.sqrt(v @ v)), 1e-12)
        c = _kmeans(x, k)
        lists.append(c)
        of += [j] * len(c)
    centroids = np.concatenate(lists) if lists else np.zeros((0, SPACE), np.float32)
    m = Model(languages, idf, centroids, np.array(of, int), np.zeros((len(languages), len(BANDS))))
    if languages:
        got = np.zeros((len(rows), len(languages)))  # to each language's nearest centroid
        for i, (_, ids, n, *_) in enumerate(rows):
            v = np.log1p(n) * idf[ids]
            cos = centroids[:, ids] @ (v / max(float(np.sqrt(v @ v)), 1e-12))
            got[i] = [cos[m.of == j].max() for j in range(len(languages))]
        size, lang = np.array([band(r[3]) for r in rows]), np.array([languages.index(r[0]) for r in rows])
        for j in range(len(languages)):
            for b in range(len(BANDS)):
                here = size == b
                if not (here & (lang == j)).sum() >= 20:  # few examples: the neighbouring bands', too
                    here = np.abs(size - b) <= 2
                own, other = got[here & (lang == j), j], got[here & (lang != j), j]
                if len(own):
                    low = float(np.quantile(own, OUTLYING))
                    foreign = float(np.quantile(other, FOREIGN)) if len(other) else 0.0
                    m.floor[j, b] = min(NEAR * low, (low + foreign) / 2)
    return m


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bound: int = BOUND, k: int = CENTROIDS) -> Model:
    """Fit on about ``bound`` texts of each language (a small domain) of ``df``; rows with a null language or text
    are ignored. The executors count n-grams; the driver gets the counts of the bounded sample only."""
    text_batches(df.sparkSession)
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    pick = bounded_sample(rows, "_lang", "_id", bound)

    def make(batches):
        for b in batches:
            out = []
            for text, lang in zip(b.column("_text").to_pylist(), b.column("_lang").to_pylist(), strict=True):
                for k, part in enumerate([text, *excerpts(text, len(text))]):
                    got, n = counts(part)
                    at = np.flatnonzero(got)
                    out.append((lang, at.astype(np.int32), got[at].astype(np.int32), n, k > 0))
            if out:
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), ints, ints, pa.int64(), pa.bool_()), strict=True)], names=["lang", "ids", "n", "letters", "part"])

    table = pick.select("_text", "_lang").mapInArrow(make, "lang string, ids array<int>, n array<int>, letters long, part boolean").toArrow()
    found = []
    for b in table.to_batches():
        for lang, ids, n, letters, part in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
            found.append((lang, ids.values.to_numpy(), n.values.to_numpy(), letters, part))
    found.sort(key=lambda r: (r[0], r[4], r[3], r[1].tobytes(), r[2].tobytes()))
    return fit(found, k)


def classify_column(df: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A struct Column: ``lang_pred`` (``und`` for null texts and texts without a letter), ``score``, ``rejected``."""
    text_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)  # centroids of a fixed width: a few for each language

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def of(texts: pa.Array) -> pa.Array:
        m = held.value
        a, b, c = zip(*(m.classify(t) for t in texts.to_pylist()), strict=True) if len(texts) else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.float64()), pa.array(c, pa.bool_())], names=["lang_pred", "score", "rejected"])

    return of(F.col(text_col).cast("string"))
