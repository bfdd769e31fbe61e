"""Typing of localized text (Brazilian number, date and flag formats).

Text that does not parse becomes NULL; rejecting the row is the validator's
decision, not the parser's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.functions.scalar import _c, code_lookup, fold, month_of, normalize_code

# Accepted shapes.
NUMBER = r"^[+-]?\d*\.?\d*$"
THOUSANDS_DOT = r"\.[^.]{3}$"
DAY_FIRST = r"^\d{1,2}/\d{1,2}/\d{4}( \d{1,2}:\d{2}(:\d{2})?)?$"
ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2})?)?$"
MONTH_SLASH, MONTH_DASH = r"^\d{2}/\d{4}$", r"^\d{4}-\d{2}$"
FIRST_YEAR, LAST_YEAR = 2000, 2100


def parse_decimal(c, type_: str = "decimal(18,4)") -> Column:
    """``R$ 1.234,56`` -> 1234.56.

    A comma is the decimal mark.  Without one, a final dot followed by exactly
    three characters groups thousands (``18.040`` -> 18040, ``1.5`` -> 1.5).
    Exponents are no numbers here.
    """
    digits = F.regexp_replace(F.trim(_c(c)), r"R\$|[% ]", "")
    without_dots = F.replace(digits, F.lit("."), F.lit(""))
    plain = (
        F.when(F.contains(digits, F.lit(",")), F.replace(without_dots, F.lit(","), F.lit(".")))
        .when(digits.rlike(THOUSANDS_DOT), without_dots)
        .otherwise(digits)
    )
    parsed = F.when(plain.rlike(NUMBER), plain).try_cast("decimal(18,4)")
    if type_ == "decimal(18,4)":
        return parsed
    return parsed.try_cast(type_)


def parse_percent(c) -> Column:
    """``14,5%`` -> 0.1450; values of at most 1 are taken as fractions already."""
    value = parse_decimal(c)
    return F.when(value > 1, value / 100).otherwise(value).try_cast("decimal(9,4)")


def _moment(text: Column) -> Column:
    """Timestamp from day-first or ISO text; wrong shapes and dates are NULL."""
    part = F.split(text, r"[-/ T:]")
    number = lambda i: F.try_element_at(part, F.lit(i + 1)).try_cast("int")
    year, day = (
        F.when(text.rlike(DAY_FIRST), number(2)).when(text.rlike(ISO), number(0)),
        F.when(text.rlike(DAY_FIRST), number(0)).when(text.rlike(ISO), number(2)),
    )
    clock = [F.coalesce(number(i), F.lit(0)) for i in (3, 4, 5)]
    return F.try_make_timestamp_ntz(year, number(1), day, *clock)


def parse_timestamp(c) -> Column:
    """Day-first or ISO text, with an optional time, at second precision."""
    return _moment(F.trim(_c(c)))


def parse_date(c) -> Column:
    """Day-first or ISO date; a time part is dropped; ``31/02/2024`` is NULL."""
    return _moment(F.trim(_c(c))).cast("date")


def parse_month(c) -> Column:
    """``01/2025``, ``2025-01`` or any date -> first day of the month."""
    text = F.trim(_c(c))
    number = F.substring(text, 1, 2).try_cast("int")
    year = F.substring(text, 4, 4).try_cast("int")
    slash = (
        text.rlike(MONTH_SLASH)
        & number.between(1, 12)
        & year.between(FIRST_YEAR, LAST_YEAR)
    )
    return (
        F.when(slash, F.make_date(year, number, F.lit(1)))
        .when(text.rlike(MONTH_DASH), parse_date(F.concat(text, F.lit("-01"))))
        .otherwise(month_of(parse_date(text)))
    )


def parse_flag(c) -> Column:
    """Yes/no text by its first letter (S, Y, T, 1 / N, F, 0)."""
    text = fold(c)
    initial = F.left(text, F.lit(1))
    return (
        F.when(initial.isin("S", "Y", "T") | (text == "1"), F.lit(True))
        .when(initial.isin("N", "F") | (text == "0"), F.lit(False))
    )


def parse_entry_type(c) -> Column:
    """Debit or reversal by the first letter."""
    initial = F.left(F.upper(F.trim(_c(c))), F.lit(1))
    return F.when(initial == "D", F.lit("DEBIT")).when(initial.isin("E", "R"), F.lit("REVERSAL"))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


PARSERS = {
    "code": normalize_code,
    "text": blank_to_null,
    "percent": parse_percent,
    "date": parse_date,
    "month": parse_month,
    "timestamp": parse_timestamp,
    "flag": parse_flag,
    "entry_type": parse_entry_type,
}


def parse_localized(df: DataFrame, spec: Mapping[str, object], keep=()) -> DataFrame:
    """Type a whole raw table in one projection.

    ``spec`` maps output column -> kind, or (kind, input column).  A kind is a
    parser name, a numeric type such as ``decimal(18,2)`` or ``int``, or a
    mapping of domain words to codes.
    """
    columns = [F.col(k) for k in keep]
    for name, entry in spec.items():
        kind, source = entry if isinstance(entry, tuple) else (entry, name)
        if isinstance(kind, Mapping):
            value = code_lookup(source, kind)
        elif kind in PARSERS:
            value = PARSERS[kind](source)
        else:
            value = parse_decimal(source, kind)
        columns.append(value.alias(name))
    return df.select(*columns)
