"""Scoring rules as native column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import UNICODE, WHITESPACE

# Release-year bands (inclusive) and their points; any other year scores 0.
YEAR_BANDS: tuple[tuple[int, int, int], ...] = (
    (2000, 2005, 5),
    (2006, 2010, 10),
    (2011, 2015, 15),
    (2016, 2021, 20),
)
# The success percentage runs from 60 to 95 (77.5, the middle, when a segment is constant).
SUCCESS_LOW = 60.0
SUCCESS_HIGH = 95.0
SUCCESS_DIGITS = 2

# Python's int(text): optional surrounding whitespace, a sign, ASCII digits with single
# underscores between them.
_INT_TEXT = UNICODE + "^" + WHITESPACE + "*([+-]?[0-9](?:_?[0-9])*)" + WHITESPACE + "*$"


@cache
def _other_digits() -> tuple[str, str]:
    """The decimal digits beyond ASCII and the ASCII digits of their values, from Python's character database."""
    digits = [chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def parse_year(year: Column) -> Column:
    """``int(year)`` for text; null where Python would raise or the value overflows a bigint.

    Decimal digits of any script count as Python reads them.
    """
    ascii_digits = F.translate(year.cast("string"), *_other_digits())
    digits = F.regexp_replace(F.regexp_extract(ascii_digits, _INT_TEXT, 1), "_", "")
    return F.when(digits != "", digits).try_cast("bigint")


def year_points(year: Column, bands: Sequence[tuple[int, int, int]] = YEAR_BANDS) -> Column:
    """Points for a release year: the band's points, 0 outside every band or when unparseable."""
    value = parse_year(year)
    out = None
    for lo, hi, pts in bands:
        cond = value.between(lo, hi)
        out = F.when(cond, F.lit(pts)) if out is None else out.when(cond, F.lit(pts))
    if out is None:
        return F.lit(0)
    return out.otherwise(F.lit(0)).cast("int")


def weighted_sum(terms: Column, weights: Column) -> Column:
    """Sum of ``weights[t]`` over every element ``t`` of ``terms``; a missing term or map adds 0."""
    return F.aggregate(
        terms,
        F.lit(0),
        lambda acc, t: acc + F.coalesce(weights[t], F.lit(0)),
    ).cast("int")


def success(total: Column, lo: Column, hi: Column,
            target: tuple[float, float] = (SUCCESS_LOW, SUCCESS_HIGH),
            digits: int = SUCCESS_DIGITS) -> Column:
    """Min-max scale ``total`` from ``[lo, hi]`` into the ``target`` range, rounded half-up.

    A constant range (``lo == hi``) gives the middle of the target for every row. The
    arithmetic is double precision in the order ``low + (t - lo) / (hi - lo) * span``.
    """
    low, high = target
    constant = (low + high) / 2
    scaled = F.lit(low) + F.try_divide(total - lo, hi - lo) * F.lit(high - low)
    return F.when(lo == hi, F.lit(constant)).otherwise(F.round(scaled, digits))
