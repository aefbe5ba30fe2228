"""Address splitting: comma-separated parts, read from the right.

Call the functions in two steps so that the title-cased parts are computed once:

    rows.withColumn("parts", address_parts("address"))
        .withColumns(address_fields("parts"))
        .withColumn("error", address_error("address", "parts", "city", "district"))
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UNKNOWN, _col, is_blank, strip, title_case

# Messages stored with rejected rows.
REQUIRED = "Address is required"
INVALID_FORMAT = "Invalid address format"
CITY_HAS_DIGIT = "Tỉnh/Thành phố không được chứa số."
CITY_HAS_DISTRICT = "Quận không được chứa trong tỉnh/thành phố"
DISTRICT_HAS_WARD = "Phường không được chứa trong quận/huyện"

# Words taken out of the city and district parts.
CITY_WORDS = ["thành phố", "tỉnh", "tp"]
DISTRICT_WORDS = ["Quận", "Huyện", "Q", "H"]

_DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"
_DISTRICT_PREFIX = r"^(Quận|Huyện|Q\.|H\.|Q(?=[\s0-9])|H(?=\s))[\s.]*"


def address_parts(address: Column | str) -> Column:
    """Title-cased parts, not yet stripped. A comma is uncased, so casing first is the same."""
    return F.split(title_case(address), ",")


def _part(parts: Column | str, from_right: int) -> Column:
    array = _col(parts)
    return strip(F.get(array, F.size(array) - from_right))


def _without(text: Column, words: list[str]) -> Column:
    for word in words:
        text = F.replace(text, F.lit(word), F.lit(""))
    return text


def city_text(parts: Column | str) -> Column:
    array = _col(parts)
    last = F.get(array, F.size(array) - 1)
    lowered = F.lower(F.replace(last, F.lit("."), F.lit("")))
    return title_case(strip(_without(lowered, CITY_WORDS)))


def district_text(parts: Column | str, mode: str = "reference") -> Column:
    """``reference`` drops every listed word and every capital Q and H, wherever they are.

    ``anchored`` drops only a leading district word, and so keeps names such as Hoàng Mai.
    """
    if mode == "anchored":
        return title_case(strip(F.regexp_replace(_part(parts, 2), _DISTRICT_PREFIX, "")))
    if mode != "reference":
        raise ValueError(f"unknown district mode: {mode}")
    array = _col(parts)
    return title_case(strip(_without(F.get(array, F.size(array) - 2), DISTRICT_WORDS)))


def known(text: Column | str) -> Column:
    text = _col(text)
    return F.when(text == "", UNKNOWN).otherwise(text)


def address_fields(parts: Column | str, city: Column | str, district: Column | str) -> dict[str, Column]:
    """The five address columns; meaningful only where ``address_error`` is null."""
    array = _col(parts)
    n = F.size(array)
    first, second = strip(F.get(array, F.lit(0))), strip(F.get(array, F.lit(1)))
    street_first = (n == 4) & F.contains(F.lower(first), F.lit("đường"))
    return {
        "specific_area": F.when((n == 5) | ((n == 4) & ~street_first), first).otherwise(UNKNOWN),
        "hamlet_neighborhood": F.when(n == 5, second).when(street_first, first).otherwise(UNKNOWN),
        "ward_commune": _part(parts, 3),
        "district": known(district),
        "province_city": known(city),
    }


def address_error(
    address: Column | str, parts: Column | str, city: Column | str, district: Column | str
) -> Column:
    n = F.size(_col(parts))
    return (
        F.when(is_blank(address), REQUIRED)
        .when((n < 3) | (n > 5), INVALID_FORMAT)
        .when(F.get(_col(parts), n - 1).rlike(_DIGIT), CITY_HAS_DIGIT)
        .when(F.contains(_col(city), F.lit("Quận")), CITY_HAS_DISTRICT)
        .when(F.contains(_col(district), F.lit("Phường")), DISTRICT_HAS_WARD)
    )
