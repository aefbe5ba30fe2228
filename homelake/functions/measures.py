"""Numbers: area, price per square metre, widths and counts.

For each field, ``*_text`` reduces the raw text to the characters of the number and the
value function parses it. A value of null means the text was not acceptable, and the
``*_error`` function then says why. Unknown is -1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, contains_any, float_error, is_empty, strip, to_number

# Messages and unit words.
AREA_REQUIRED = "Area is required"
NEGOTIABLE = ["thỏa thuận", "thoa thuan"]
BILLION = "tỷ"
MILLION = "triệu"
MILLION_PER_M2 = "triệu/m²"


def _drop(text: Column, *words: str) -> Column:
    for word in words:
        text = F.replace(text, F.lit(word), F.lit(""))
    return text


def _decimal_point(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def area_text(area: Column | str) -> Column:
    """A point groups thousands and a comma marks decimals, so ``50.5`` reads as 505."""
    return _decimal_point(_drop(strip(_drop(strip(F.lower(_col(area))), "m²", "m2")), "."))


def area_m2(text: Column | str) -> Column:
    return F.round(to_number(strip(text)), 2)


def area_error(area: Column | str, text: Column | str, value: Column | str) -> Column:
    return F.when(is_empty(area), AREA_REQUIRED).when(_col(value).isNull(), float_error(text))


def price_text(price: Column | str) -> Column:
    return _decimal_point(strip(F.lower(_col(price))))


def price_number(text: Column | str) -> Column:
    """The first run of digits and points; empty if there is none."""
    return F.regexp_extract(_col(text), r"[0-9.]+", 0)


def million_per_m2(
    price: Column | str, text: Column | str, number: Column | str, area: Column | str
) -> Column:
    text, area = _col(text), _col(area)
    amount = to_number(number)
    return (
        F.when(is_empty(price) | area.isNull() | (area <= 0) | contains_any(text, NEGOTIABLE), F.lit(-1.0))
        .when(F.contains(text, F.lit(BILLION)), F.round(amount * 1000 / area, 2))
        .when(F.contains(text, F.lit(MILLION_PER_M2)), F.round(amount, 2))
        .when(F.contains(text, F.lit(MILLION)), F.round(amount / area, 2))
    )


def price_error(price: Column | str, number: Column | str, value: Column | str) -> Column:
    number = _col(number)
    unusable = F.concat(F.lit("Price '"), _col(price), F.lit("' không phù hợp"))
    return F.when(
        _col(value).isNull(),
        F.when((number != "") & to_number(number).isNull(), float_error(number)).otherwise(unusable),
    )


def facade_text(facade: Column | str) -> Column:
    """Only a lower-case ``m`` is taken as the unit."""
    return strip(_drop(_decimal_point(_col(facade)), "m"))


def way_in_text(way_in: Column | str) -> Column:
    return strip(_decimal_point(_drop(F.lower(_col(way_in)), '"', "'", "m")))


def width(raw: Column | str, text: Column | str) -> Column:
    return F.when(is_empty(raw), F.lit(-1.0)).otherwise(F.round(to_number(text), 2))


def width_error(text: Column | str, value: Column | str) -> Column:
    return F.when(_col(value).isNull(), float_error(text))


def count_field(raw: Column | str) -> Column:
    """First run of digits as an int; null if there is none or it does not fit."""
    raw = _col(raw)
    digits = F.regexp_extract(raw, "[0-9]+", 0)
    return F.when(is_empty(raw), F.lit(-1)).when(digits != "", digits.try_cast("int"))


def count_error(raw: Column | str, value: Column | str) -> Column:
    return F.when(
        _col(value).isNull(), F.concat(F.lit("Error cleaning number field '"), _col(raw), F.lit("'"))
    )
