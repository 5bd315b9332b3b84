"""Personal data by weak supervision, with DataFrame functions only.

Base spans come from fixed patterns and checks (``base_spans``) and always stay. The method adds spans. Its candidates are
the base spans, matches of the base patterns that fail their checks, numbers inside these that pass them (a phone number
that runs into a card number fails as one match), and looser shapes (spelled-out e-mail addresses, grouped numbers
without a plus sign, addresses of four parts with spaces, cards with other separators). Labelers vote on
all of them: the check, regexes on the shape, gazetteers (domain endings, country and area codes, issuer prefixes), context
words around a candidate for and against it. The vote patterns are counted together with the candidates' own features
(length, characters, groups, neighbours); expectation-maximisation over the votes estimates each labeler's reliability
and the prior of each kind, and a logistic span classifier over the features is trained on the posteriors. It is
applied as a SQL expression; candidates with a probability of at least ``THRESHOLD`` become spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
CONTEXT = 40
#: Weight of the classifier's prior, as a share of what was counted.
PRIOR = 0.1

#: Base patterns, written so that a failed start never makes the engine read a run of characters twice.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Looser candidates, by kind.
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}+(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}\x20?\.\x20[0-9]{1,3}\x20?\.\x20?[0-9]{1,3}\x20?\.\x20?[0-9]{1,3}(?![0-9])",
    "card": r"(?<![0-9./-])(?:[0-9]{4}(?:[./][0-9]{4}){3}|[0-9]{4}(?:[\x20-]?[0-9]{4}){3})(?![0-9./-])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[\x20.-]?|00[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])",
}

#: Context words and gazetteers of the labelers (lower case).
NEAR = {
    "email": r"\b(?:e-?mail|mail|contact|write|reach|correo|courriel|kontakt|schreib)",
    "ip": r"\b(?:ip|host|server|address|addr|adresse|direcci)",
    "card": r"\b(?:card|visa|mastercard|amex|credit|tarjeta|carte|karte|kreditkarte)",
    "phone": r"\b(?:phone|tel|call|mobile|fax|whatsapp|tel[eé]fono|t[eé]l[eé]phone|telefon|anruf|llam)",
}
AGAINST = r"\b(?:version|isbn|issn|token|hash|sha|order|invoice|section|page|chapter|figure|table|line|id)\b"
SHAPE = {"email": r"(?i)(?:@|\[at\]|\(at\)|\[dot\]|\(dot\)|\x20dot\x20)", "ip": r"^[1-9]", "card": r"^[3-6]", "phone": r"(?:\(|^\+|^00|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$)"}
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|it|nl|eu|us)$",
    "ip": r"^(?:10|127|172|192|8|1|169)\b",
    "card": r"^(?:4[0-9]{3}|5[1-5][0-9]{2}|3[47][0-9]{2}|6011|65[0-9]{2})",
    "phone": r"^(?:(?:00|\+)(?:1|33|34|44|49)\b|\(?(?:2[0-9]{2}|3[0-9]{2}|4[0-9]{2}|5[0-9]{2}|6[0-9]{2}|7[0-9]{2}|8[0-9]{2}|9[0-9]{2}|0[1-9])\)?)",
}
LABELERS = ("check", "shape", "gazetteer", "near", "against")
#: What the classifier sees of a candidate.
FEATURES = ("valid", "digits10", "digits14", "digits20", "letters", "space", "dash", "dot", "plus", "bracket", "one_digit", "glued", "near", "against")

SPAN = "struct<start:int,end:int,text:string>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end,text>>, in code points, the end exclusive.

    What lies between the matches gives their places: one split, one extraction, one fold.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["b"])
        end = start + F.char_length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(x["m"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(one))).alias("spans"))

    return F.aggregate(F.arrays_zip(between.alias("b"), found.alias("m")), zero, step)["spans"]


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of ``s`` pass the Luhn check."""
    each = F.transform(F.split(F.reverse(digits(s)), ""), lambda d, i: (d.try_cast("int") * (1 + i % 2)))
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def _checks(kind: str, s: Column) -> Column:
    n = F.char_length(digits(s))
    if kind == "ip":
        value = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(s, r"\."), lambda p: (F.char_length(value(p)) <= 3) & (F.concat(F.lit("0"), F.left(value(p), F.lit(3))).try_cast("int") <= 255))
    if kind == "card":
        return n.between(14, 19) & F.when(n.between(14, 19), luhn(s)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


#: Cheap tests that a text may hold a kind at all.
_MAY = {"email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), "phone": lambda t: F.contains(t, F.lit("+"))}
_MAY_LOOSE = {"email": lambda t: t.rlike(r"(?i)[\x20\[(]at[\x20\])]"), "ip": lambda t: t.rlike(r"[0-9]\x20?\.\x20[0-9]"), "card": lambda t: t.rlike(r"[0-9]{4}[./\x20-]?[0-9]{4}"), "phone": lambda t: t.rlike(r"[0-9]\)?[\x20.-][0-9]{3}")}


_PATTERN = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def _found(text: Column, kind: str) -> Column:
    return F.when(_MAY[kind](text), matches(text, _PATTERN[kind])).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column, kind: str) -> Column:
    """The base spans of one kind: matches of its pattern that pass its checks, no retries for those that fail."""
    return F.filter(_found(text, kind), lambda s: _checks(kind, s["text"]))


NAMED = "struct<kind:int,start:int,end:int,text:string,valid:boolean>"


def _valid(kind: str, s: Column) -> Column:
    """Whether a looser candidate passes its kind's check; an e-mail address should end in letters."""
    return s.rlike("[A-Za-z]{2}$") if kind == "email" else F.coalesce(_checks(kind, F.replace(s, F.lit(" "), F.lit("")) if kind == "ip" else s), F.lit(False))


def _named(spans: Column, kind: int, valid) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), valid(s).alias("valid")))


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``loose``: arrays of struct<kind,start,end,text,valid> over the whole text (null: empty).

    ``loose`` are the candidates that are no base spans: looser shapes and numbers inside failed matches, those first that
    pass their kind's check (``valid``), and failed matches that are long enough to be one (eight digits, or four
    parts). None overlaps a base span or another one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    # one pass: per kind all matches of its pattern, and the looser ones
    raw = F.struct(*(_found(text, k).alias(k) for k in KINDS), *(F.when(_MAY_LOOSE[k](text), matches(text, LOOSE[k])).otherwise(none).alias(f"{k}_loose") for k in KINDS))

    def parts(r: Column) -> Column:
        passed = [F.filter(r[k], lambda s: _checks(k, s["text"])) for k in KINDS]  # noqa: B023
        failed = [F.filter(r[k], lambda s: ~_checks(k, s["text"]) & ((F.char_length(digits(s["text"])) >= 8) | F.lit(k == "ip"))) for k in KINDS]  # noqa: B023
        inner = F.concat(*(_named(r[f"{k}_loose"], i, lambda s: _valid(k, s["text"])) for i, k in enumerate(KINDS)))  # noqa: B023
        good = F.concat(*(_named(x, i, lambda s: F.lit(True)) for i, x in enumerate(passed)))
        poor = F.concat(*(_named(x, i, lambda s: F.lit(False)) for i, x in enumerate(failed)))
        return F.struct(good.alias("base"), F.concat(inner, poor).alias("rough"))

    def first(spans: Column, taken: Column) -> Column:
        """Of ``spans`` that overlap none of ``taken``, those that don't overlap each other, by (start, kind, end)."""
        free = F.filter(spans, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        ordered = F.array_sort(F.transform(free, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "kind", "end", "text", "valid")))))
        back = lambda s: F.struct(*(s[c].alias(c) for c in ("kind", "start", "end", "text", "valid")))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{NAMED}>").alias("s"))
        return F.aggregate(ordered, zero, lambda a, s: F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["s"], F.array(back(s))).alias("s"))).otherwise(a))["s"]

    def apart(x: Column) -> Column:
        return F.struct(x["base"].alias("base"), first(F.filter(x["rough"], lambda s: s["valid"]), x["base"]).alias("good"), x["rough"].alias("rough"))

    def rest(x: Column) -> Column:
        return F.struct(x["base"].alias("base"), F.concat(x["good"], first(F.filter(x["rough"], lambda s: ~s["valid"]), F.concat(x["base"], x["good"]))).alias("loose"))

    steps = F.transform(F.transform(F.transform(F.array(raw), parts), apart), rest)[0]
    return df.withColumn("base", steps).withColumn("loose", F.col("base.loose")).withColumn("base", F.col("base.base"))


def _by_kind(span: Column, patterns: dict[str, str], s: Column) -> Column:
    out = F.lit(False)
    for i, k in enumerate(KINDS):
        out = F.when(span["kind"] == i, s.rlike(patterns[k])).otherwise(out)
    return out


def _around(text: Column, span: Column) -> Column:
    before = F.substring(text, F.greatest(F.lit(1), span["start"] + 1 - CONTEXT), F.least(F.lit(CONTEXT), span["start"]))
    return F.lower(F.concat(before, F.lit(" | "), F.substring(text, span["end"] + 1, F.lit(CONTEXT))))


def seen(text: Column, span: Column) -> Column:
    """``votes``, the labelers' on a candidate (1 for, 0 silent; ``against``: 1 speaks against), and ``features``, what the
    classifier sees of it (in the order of ``FEATURES``): both as bits of a number, the first the highest."""
    beside = F.concat(F.substring(text, F.greatest(F.lit(1), span["start"]), F.least(F.lit(1), span["start"])), F.lit(" "), F.substring(text, span["end"] + 1, F.lit(1)))
    known = F.struct(span["kind"].alias("kind"), span["valid"].alias("valid"), span["text"].alias("s"), digits(span["text"]).alias("d"), _around(text, span).alias("around"), beside.alias("beside"))

    def judged(z: Column) -> Column:
        return F.struct(z["valid"].alias("valid"), z["s"].alias("s"), z["d"].alias("d"), F.char_length(z["d"]).alias("n"), _by_kind(z, SHAPE, z["s"]).alias("shape"), _by_kind(z, GAZETTEER, z["s"]).alias("gazetteer"), _by_kind(z, NEAR, z["around"]).alias("near"), z["around"].rlike(AGAINST).alias("against"), z["beside"].rlike(r"[A-Za-z0-9_=#/]").alias("glued"))

    def bits(*flags: Column) -> Column:
        return sum((F.shiftleft(x.cast("int"), len(flags) - 1 - k) for k, x in enumerate(flags)), F.lit(0))

    def told(z: Column) -> Column:
        n, s = z["n"], z["s"]
        own = (z["valid"], n.between(10, 13), n.between(14, 19), n > 19, s.rlike("[A-Za-z]"), s.contains(" "), s.contains("-"), s.contains("."), s.startswith("+"), s.rlike(r"[(\[]"), z["d"].rlike(r"^(.)\1*$"), z["glued"], z["near"], z["against"])
        return F.struct(bits(*(z[c] for c in ("valid", *LABELERS[1:]))).alias("votes"), bits(*own).alias("features"))

    return F.transform(F.transform(F.array(known), judged), told)[0]


#: How often (kind, votes, features, whether it is a base span) occurs.
Counts = dict[tuple[int, tuple[int, ...], tuple[int, ...], bool], int]


def estimate(counts: Counts, rounds: int = 60) -> dict[int, tuple[float, list[tuple[float, float]]]]:
    """Expectation-maximisation over counted vote patterns: for each kind its prior and, for each labeler, how
    often it votes on true and on false candidates. Base spans are known to be true, the others' truth is estimated. The
    counts are as many as patterns, whatever the corpus."""
    out = {}
    for kind in range(len(KINDS)):
        own: dict[tuple[tuple[int, ...], bool], int] = {}
        for (k, v, _, base), n in counts.items():
            if k == kind:
                own[v, base] = own.get((v, base), 0) + n
        prior, rate = 0.3, [(0.8, 0.02), (0.7, 0.2), (0.7, 0.3), (0.6, 0.05), (0.05, 0.3)]
        total = sum(own.values())
        for _ in range(rounds if total else 0):
            post = {(v, base): 1.0 if base else _posterior(v, prior, rate) for v, base in own}
            true = sum(n * post[v] for v, n in own.items())
            prior = min(0.95, max(0.02, (true + 1) / (total + 4)))
            new = []
            for j, (p, q) in enumerate(rate):
                a = (sum(n * post[v] for v, n in own.items() if v[0][j]) + 8 * p) / (true + 8)
                b = (sum(n * (1 - post[v]) for v, n in own.items() if v[0][j]) + 8 * q) / (total - true + 8)
                # a labeler is never taken to mean its opposite
                new.append((min(a, b), max(a, b)) if LABELERS[j] == "against" else (max(a, b), min(a, b)))
            rate = [(min(0.98, max(0.02, a)), min(0.98, max(0.02, b))) for a, b in new]
        out[kind] = prior, rate
    return out


def _posterior(v: tuple[int, ...], prior: float, rate: list[tuple[float, float]]) -> float:
    a, b = prior, 1 - prior
    for x, (p, q) in zip(v, rate, strict=True):
        a, b = a * (p if x else 1 - p), b * (q if x else 1 - q)
    return a / (a + b)


def classifier(counts: Counts, steps: int = 600) -> dict[int, tuple[float, list[float]]]:
    """A logistic span classifier for each kind, (bias, weight of each feature), trained on the posteriors."""
    out = {}
    for kind, (prior, rate) in estimate(counts).items():
        own: dict[tuple[int, ...], list[float]] = {}
        for (k, v, x, base), n in counts.items():
            if k == kind:
                at = own.setdefault(x, [0.0, 0.0])
                at[0] += n
                at[1] += n * (1.0 if base else _posterior(v, prior, rate))
        for x, (n, true) in list(own.items()):  # the prior: alike but for the check is false, with words against it doubtful
            for twin, share in (((0, *x[1:]), 0.0), ((*x[:-1], 1), 0.3)):
                if twin != x:
                    at = own.setdefault(twin, [0.0, 0.0])
                    at[0] += PRIOR * n
                    at[1] += PRIOR * true * share
        total, bias, w = sum(n for n, _ in own.values()), -2.0, [0.0] * len(FEATURES)
        for _ in range(steps if own else 0):
            gb, g = 0.0, [1e-4 * x for x in w]
            for x, (n, true) in own.items():
                z = bias + sum(b for a, b in zip(x, w, strict=True) if a)
                # patterns weigh by the root of their number, so that rare ones count
                e = (1 / (1 + math.exp(-z)) - true / n) * math.sqrt(n / total) / len(own) ** 0.5
                gb += e
                g = [a + e * b for a, b in zip(g, x, strict=True)]
            bias -= gb
            w = [a - b for a, b in zip(w, g, strict=True)]
        out[kind] = bias, w
    return out


def train(found: DataFrame, text_col: str = "text") -> dict[int, tuple[float, list[float]]]:
    """Count the patterns of votes and features of all candidates of ``find()`` and fit. Counts reach the driver, as many
    as patterns that occur, whatever the corpus."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    every = F.concat(*(F.transform(c, mark) for c, mark in (("base", lambda s: F.struct(s.alias("s"), F.lit(True).alias("b"))), ("loose", lambda s: F.struct(s.alias("s"), F.lit(False).alias("b"))))))
    x = found.where((F.size("base") > 0) | (F.size("loose") > 0)).select(text.alias("t"), F.explode(every).alias("c"))
    rows = x.select(F.col("c.s.kind").alias("kind"), seen(F.col("t"), F.col("c.s")).alias("x"), "c.b").groupBy("kind", "x.votes", "x.features", "b").agg(F.count(F.lit(1)).alias("n")).collect()
    bits = lambda c, n: tuple(c >> n - 1 - k & 1 for k in range(n))
    return classifier({(r["kind"], bits(r["votes"], len(LABELERS)), bits(r["features"], len(FEATURES)), r["b"]): r["n"] for r in rows})


def probability(text: Column, span: Column, model: dict[int, tuple[float, list[float]]]) -> Column:
    """That a candidate is personal data, by the classifier."""
    weights = F.array(*(F.array(F.lit(float(bias)), *(F.lit(float(a)) for a in w)) for _, (bias, w) in sorted(model.items())))
    w, x = F.element_at(weights, span["kind"] + 1), seen(text, span)["features"]

    def total(z: Column) -> Column:
        part = lambda j: F.element_at(z["w"], j + 2) * F.shiftright(z["x"], len(FEATURES) - 1 - j).bitwiseAND(1)
        return 1 / (1 + F.exp(-(F.element_at(z["w"], 1) + sum((part(j) for j in range(len(FEATURES))), F.lit(0.0)))))

    return F.transform(F.array(F.struct(w.alias("w"), x.alias("x"))), total)[0]


def spans(df: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``base`` and ``spans``: arrays of struct<start,kind,end> by start, then kind (its number in ``KINDS``).

    ``spans`` has all base spans and the accepted candidates. Null and empty texts have none. Columns of ``df`` with
    these names, or named ``loose``, are replaced.
    """
    found = find(df, text_col)
    model = train(found, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    more = F.filter("loose", lambda s: probability(text, s, model) >= threshold)
    return found.withColumn("spans", F.array_sort(bare(F.concat(F.col("base"), more)))).withColumn("base", F.array_sort(bare(F.col("base")))).drop("loose")


def listed(spans_col: str) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(text: Column, spans_col: str) -> Column:
    """``text`` with every span (of those that overlap, the first) replaced by ``<EMAIL>`` and the like."""
    marks = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    t = F.coalesce(text.cast("string"), F.lit(""))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        F.col(spans_col),
        zero,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.element_at(marks, s["kind"] + 1)).alias("out")),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
    )
    whole = F.concat(done["out"], F.substring(t, done["at"] + 1, F.char_length(t)))
    return F.when(F.size(spans_col) > 0, whole).otherwise(text)
