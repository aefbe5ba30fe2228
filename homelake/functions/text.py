"""Text helpers shared by the cleaners.

All of them are built-in expressions, so they stay inside generated code. They
follow Unicode rules where Spark's shorter built-ins do not: ``trim`` strips
U+0020 only, and ``initcap`` starts words after spaces only.
"""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word for unknown, and the message for text that is no number.
UNKNOWN = "Không xác định"
FLOAT_ERROR = "could not convert string to float: "

# Every code point that Unicode treats as white space, plus the four ASCII separators.
SPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
# Browsers trim a slightly different set.
BROWSER_SPACE = "".join(c for c in SPACE if not 0x1C <= ord(c) <= 0x1F and c != "\x85") + "\ufeff"

_CASED = r"\p{LC}\p{javaLowerCase}\p{javaUpperCase}"
# A word start that is not after a space; initcap finds those itself.
_WORD_START = rf"([^ {_CASED}])([{_CASED}])"
# A noncharacter, never used in interchanged text, followed by initcap's word separator.
_BREAK = "\ufdd1 "

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c: Column | str) -> Column:
    """Null or zero-length. A blank string is not empty."""
    return F.coalesce(F.length(_col(c)), F.lit(0)) == 0


def strip(c: Column | str, chars: str = SPACE) -> Column:
    return F.btrim(_col(c), F.lit(chars))


def is_blank(c: Column | str) -> Column:
    return is_empty(strip(c))


def squeeze(c: Column | str) -> Column:
    """Strip, and turn every inner run of white space into one space."""
    return F.trim(F.regexp_replace(_col(c), f"[{SPACE}]+", " "))


def title_case(c: Column | str) -> Column:
    """Upper-case each cased letter that follows an uncased character; lower-case the rest."""
    marked = F.regexp_replace(_col(c), _WORD_START, f"$1{_BREAK}$2")
    return F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))


def _fold_table() -> tuple[str, str]:
    """Letters with their unaccented lower-case forms, then combining marks with none."""
    letters, bases, marks = ["Đ", "đ"], ["d", "d"], []
    for code in range(ord("A"), ord("Z") + 1):
        letters.append(chr(code))
        bases.append(chr(code).lower())
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
        elif unicodedata.decomposition(char):
            decomposed = unicodedata.normalize("NFD", char)
            base = "".join(part for part in decomposed if unicodedata.category(part) != "Mn")
            if base != char and len(base) == 1 and base.isascii() and base.isalnum():
                letters.append(char)
                bases.append(base.lower())
    return "".join(letters + marks), "".join(bases)


_FOLD_FROM, _FOLD_TO = _fold_table()


def plain_ascii(c: Column | str) -> Column:
    """Accents off, lower case, anything but ``a-z 0-9 /`` becomes a single space."""
    folded = F.translate(_col(c), _FOLD_FROM, _FOLD_TO)
    return F.trim(F.regexp_replace(folded, "[^a-z0-9/]+", " "))


def contains_any(c: Column | str, words: list[str]) -> Column:
    """If any of the words is in the text; all are looked for in one pass."""
    return _col(c).rlike("|".join(re.escape(w) for w in words))


def first_rule(c: Column | str, rules: list[tuple[str, list[str]]]) -> Column:
    """The label of the first rule that has a word in the text; null without one.

    One pattern finds the word that decides, and a table gives its label, so that the generated code
    does not grow with the number of rules.
    """
    labels: dict[str, str] = {}
    for label, words in rules:
        for word in words:
            labels.setdefault(word, label)
    # Each alternative looks for the words of one rule anywhere in the text.
    places = "|".join(f".*?(?<r{n}>{'|'.join(re.escape(w) for w in words)})" for n, (_, words) in enumerate(rules))
    found = F.regexp_replace(_col(c), rf"(?s)\A(?:{places}).*\z", "".join(f"${{r{n}}}" for n in range(len(rules))))
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(table, found)


def to_number(c: Column | str) -> Column:
    """Decimal text, already stripped, to double; null unless the whole text is a number."""
    text = _col(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def float_error(c: Column | str) -> Column:
    """Message for text that is not a number; ``quoted_message`` puts in the quotes."""
    return F.concat(F.lit(FLOAT_ERROR), _col(c))


def _python_literal(text: Column) -> Column:
    for raw, escaped in [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\xa0", "\\xa0")]:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    only_single = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    mark = F.when(only_single, '"').otherwise("'")
    return F.concat(mark, F.when(only_single, text).otherwise(F.replace(text, F.lit("'"), F.lit("\\'"))), mark)


def quoted_message(message: Column | str) -> Column:
    """The message, with the text of a ``float_error`` written as a Python literal.

    A step of its own, applied to the one message that is reported. Few messages need it: the function
    given to transform is interpreted, and so stays out of the generated code of all rows.
    """
    message = _col(message)
    text = F.substring(message, len(FLOAT_ERROR) + 1, 2**31 - 1)
    quoted = F.concat(F.lit(FLOAT_ERROR), F.get(F.transform(F.array(text), _python_literal), F.lit(0)))
    return F.when(message.startswith(FLOAT_ERROR), quoted).otherwise(message)
