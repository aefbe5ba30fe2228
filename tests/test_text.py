import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from homelake.functions import text
from homelake.functions.labels import PREPARATION, PREPARATION_KEYWORDS, STAGE_KEYWORDS, STAGE_OTHER, status_stage
from homelake.functions.text import contains_any, first_rule

PROBES = [
    "quận 1a", "o'neil p.11", "hà-nội", "đường hòa", unicodedata.normalize("NFD", "đường hòa ở"), "straße",
    "ßa ßb", "(vinhomes) golden", "\xa0  x y 　", "\x1cab\x1f", "\x85a b", "5tỷ m²a", "ALL CAPS", "中a b",
    "", "   ", "a\tb\n\nc", "ªb ªC", "İstanbul", "Å K", "lô a1-2b/c", "x--y", "ǆabc",
]


def test_title_case_is_unicode_title(values):
    assert values(text.title_case("x"), PROBES) == [p.title() for p in PROBES]


def test_strip_takes_unicode_space(values):
    assert values(text.strip("x"), PROBES) == [p.strip() for p in PROBES]


def test_squeeze(values):
    assert values(text.squeeze("x"), PROBES) == [" ".join(p.split()) for p in PROBES]


def test_plain_ascii(values):
    def expected(value):
        base = "".join(c for c in unicodedata.normalize("NFD", value) if unicodedata.category(c) != "Mn")
        base = base.replace("Đ", "D").replace("đ", "d").lower()
        return " ".join("".join(c if c.isascii() and (c.isalnum() or c in "/ ") else " " for c in base).split())

    assert values(text.plain_ascii("x"), PROBES) == [expected(p) for p in PROBES]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("5", 5.0), ("5.", 5.0), (".5", 0.5), ("+5", 5.0), ("-2.5", -2.5), ("1e3", 1000.0), ("1d", None), ("1f", None),
        ("1_0", None), ("nan", None), ("inf", None), (".", None), ("1.2.3", None), ("", None), ("0x1p3", None),
    ],
)
def test_to_number(values, given, expected):
    assert values(text.to_number("x"), [given]) == [expected]


def test_float_error_is_quoted_like_a_literal(values):
    probes = ["abc", "a'b", 'a"b', "a'b\"c", "a\\b", "a\nb", "\xa01", ""]
    found = values(text.quoted_message(text.float_error("x")), probes)
    assert found == [f"could not convert string to float: {p!r}" for p in probes]


def test_first_rule_is_the_first_that_has_a_word_anywhere(values):
    """The order of rules decides, not that of the words in the text, and words may overlap."""
    rng = random.Random(1)
    rules = [("x", ["ab", "c.d"]), ("y", ["b a", "zz", "abc"]), ("z", ["a", "(q)"]), ("x2", ["dd"])]
    texts = ["".join(rng.choices(["a", "b", " ", "c.d", "cxd", "zz", "z", "(q)", "q", "dd", "d", "\n"], k=rng.randint(0, 8))) for _ in range(300)]
    want = [next((label for label, words in rules if any(w in t for w in words)), None) for t in texts]
    assert set(want) == {"x", "y", "z", "x2", None}
    assert values(first_rule(F.col("x"), rules), texts) == want
    assert values(contains_any(F.col("x"), ["c.d", "(q)"]), texts) == ["c.d" in t or "(q)" in t for t in texts]


def test_stages_by_rule(values):
    rules = [(PREPARATION, PREPARATION_KEYWORDS), *STAGE_KEYWORDS]
    rng = random.Random(2)
    words = [w for _, own in rules for w in own]
    texts = [" ".join(rng.choices([*words, "quy 4", "du an"], k=rng.randint(1, 3))) for _ in range(400)]
    want = [next((label for label, own in rules if any(w in t for w in own)), STAGE_OTHER) for t in texts]
    assert values(status_stage(F.col("x")), texts) == want
