"""Scalar helpers shared by the jobs; every one returns a Column."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers ---------------------------------------------------------------

def money(c) -> Column:
    return _c(c).cast("decimal(18,2)")


def exposure(c) -> Column:
    """Exact six-decimal amount, wide enough for a product of any stored amount and rate."""
    return _c(c).cast("decimal(28,6)")


def rate(numerator, denominator) -> Column:
    """True ratio with four decimals; NULL when the denominator is zero or NULL."""
    return quotient(numerator, denominator).cast("decimal(18,4)")


def quotient(numerator, denominator) -> Column:
    return _c(numerator) / F.nullif(_c(denominator), F.lit(0))


def whole_ratio(numerator, denominator, exact: bool = False) -> Column:
    """Ratio of two counts.

    The business marts divide whole numbers, so the quotient is truncated to
    0 or 1; ``exact=True`` gives the true ratio instead.
    """
    if exact:
        return rate(_c(numerator).cast("decimal(18,0)"), _c(denominator).cast("decimal(18,0)"))
    n, d = _c(numerator).cast("long"), F.nullif(_c(denominator).cast("long"), F.lit(0))
    return F.call_function("div", n, d).cast("decimal(18,4)")


def positive_part(amount) -> Column:
    """``amount`` when above zero, else 0 (NULL counts as 0)."""
    return F.when(_c(amount) > 0, _c(amount)).otherwise(F.lit(0))


# --- text ------------------------------------------------------------------

def normalize_code(c) -> Column:
    """Trimmed upper-case code; blank becomes NULL."""
    return F.nullif(F.upper(F.trim(_c(c))), F.lit(""))


@cache
def accents() -> tuple[str, str]:
    """Every letter that decomposes into one base letter and combining marks, and that base letter."""
    marked, plain = [], []
    for code in range(0xC0, 0x2000):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and all(unicodedata.combining(m) for m in marks) and base.isalpha():
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


def fold(c) -> Column:
    """Key for accent- and case-insensitive equality.

    Combining marks go and accented letters become their base letter, however
    the accent is written.  A folded key is a plain string, so it hashes,
    shuffles and broadcasts like any other join key.
    """
    upper = F.upper(F.trim(_c(c)))
    return F.when(upper.rlike(r"[^\x00-\x7F]"), F.translate(F.regexp_replace(upper, r"\p{Mn}+", ""), *accents())).otherwise(upper)


def code_lookup(c, words: Mapping[str, str]) -> Column:
    """Map a localized domain word to its code; unknown words give NULL."""
    pairs = [F.lit(x) for kv in words.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), fold(c))


def label(c, labels: Mapping[str, str]) -> Column:
    """Replace a code by its label; codes without one pass through."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(c)), _c(c))


def join_text(*parts) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over ``|``-joined attribute text; NULL attributes are skipped."""
    return F.unhex(F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256))


# --- dates -----------------------------------------------------------------

def month_of(c) -> Column:
    return F.trunc(_c(c), "MM")


def date_key(c) -> Column:
    """Whole number ``yyyymmdd``."""
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_index(c) -> Column:
    c = _c(c)
    return F.year(c) * 12 + F.month(c)


def calendar_months_between(start, end) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (not elapsed months)."""
    return month_index(end) - month_index(start)


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``."""
    trunc = lambda c: F.date_trunc("MINUTE", _c(c)).cast("timestamp_ntz")
    return F.timestamp_diff("MINUTE", trunc(start), trunc(end))
