"""Numerical terms and multiplying prefixes of systematic names, for Python and as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The terms of units, tens and hundreds.
UNITS = ("", "hen", "do", "tri", "tetra", "penta", "hexa", "hepta", "octa", "nona")
TENS = ("", "deca", "cosa", "triaconta", "tetraconta", "pentaconta", "hexaconta", "heptaconta", "octaconta", "nonaconta")
HUNDREDS = ("", "hecta", "dicta", "tricta", "tetracta", "pentacta", "hexacta", "heptacta", "octacta", "nonacta")
SMALL = ("", "mono", "di", "tri", "tetra", "penta", "hexa", "hepta", "octa", "nona", "deca", "undeca")
#: Stems of parent chains.
STEMS = ("", "meth", "eth", "prop", "but", "pent", "hex", "hept", "oct", "non", "dec", "undec")


def numerical_term(n: int) -> str:
    """The term for 1 to 999: smallest places first; the twenty loses its i after a vowel."""
    if not 1 <= n <= 999:
        raise ValueError("numerical terms run from 1 to 999")
    if n < len(SMALL):
        return SMALL[n]
    hundred, ten, unit = n // 100, n // 10 % 10, n % 10
    out = UNITS[unit]
    if ten == 2:
        out += "icosa" if not out or out[-1] not in "aeiou" else "cosa"
    else:
        out += TENS[ten]
    return out + HUNDREDS[hundred]


def parent_root(n: int) -> str:
    """The stem of a chain of ``n`` carbons, without the final a."""
    return STEMS[n] if n < len(STEMS) else numerical_term(n).removesuffix("a")


def multiplicative_prefix(n: int) -> str:
    """di, tri ...; empty for one."""
    return "" if n == 1 else numerical_term(n)


def derived_prefix(n: int) -> str:
    """bis, tris, tetrakis ... for names that already hold a number or locant."""
    return "" if n == 1 else {2: "bis", 3: "tris"}.get(n) or numerical_term(n) + "kis"


def numerical_term_column(n: Column) -> Column:
    """``numerical_term`` as a Column; null outside 1 to 999."""
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), i + 1)
    safe = F.when(n.between(1, 999), n).otherwise(1).cast("int")
    unit, ten, hundred = safe % 10, (safe / 10).cast("int") % 10, (safe / 100).cast("int")
    first = pick(UNITS, unit)
    tens = F.when(ten == 2, F.when(F.substring(first, -1, 1).isin(*"aeiou"), "cosa").otherwise("icosa")).otherwise(pick(TENS, ten))
    out = F.when(safe < len(SMALL), pick(SMALL, F.least(safe, F.lit(len(SMALL) - 1)))).otherwise(F.concat(first, tens, pick(HUNDREDS, hundred)))
    return F.when(n.between(1, 999), out)


def multiplied(name: Column, n: Column) -> Column:
    """A name with its multiplying prefix."""
    return F.concat(F.when(n == 1, F.lit("")).otherwise(numerical_term_column(n)), name)


def halide_class_name(name: str) -> str:
    """The class name of a halo prefix: fluoro to fluoride, and so on."""
    return name.removesuffix("o") + "ide"
