"""Value codes, half-open bands and label texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode(value: Column, offset: float, scale: float) -> Column:
    """Code 1..65535 of a value, 0 for no data."""
    code = F.least(F.greatest(F.rint((value - offset) / scale) + 1, F.lit(1.0)), F.lit(65535.0))
    return F.when(value.isNull() | F.isnan(value), F.lit(0)).otherwise(code.cast("int"))


def decode(code: Column, offset: float, scale: float) -> Column:
    return F.when(code > 0, offset + (code - 1) * scale)


def cell(place: Column, size: int, cells: int) -> Column:
    """Cell along an axis whose bounds are round(k * size / cells), halves to even."""
    bounds = [round(k * size / cells) for k in range(1, cells)]
    return sum(((place >= b).cast("int") for b in bounds), F.lit(0))


def float_cell(place: Column, size: float, cells: int) -> Column:
    """Cell along an axis with half-open real bounds; null outside."""
    return F.when((place >= 0) & (place < size), F.floor(place * cells / size))


def degree_label(text: Column, limit: int) -> Column:
    """Signed degrees from a text such as 118°W; a leading 4 of a 3-digit number over the limit was a 1."""
    digits = F.regexp_extract(text, r"(\d{2,3})[^0-9A-Za-z]*([NWESnwes])", 1)
    side = F.upper(F.regexp_extract(text, r"(\d{2,3})[^0-9A-Za-z]*([NWESnwes])", 2))
    n = F.when(digits != "", digits).cast("int")
    n = F.when((n > limit) & (F.length(digits) == 3) & digits.startswith("4"), n - 300).otherwise(n)
    return F.when(n <= limit, F.when(side.isin("W", "S"), -n).otherwise(n))
