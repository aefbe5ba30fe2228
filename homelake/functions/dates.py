"""Post dates as ISO text, and timestamp parsing. Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, strip

_TIME = r"([01][0-9]|2[0-3])(?::([0-5][0-9])(?::([0-5][0-9])(?:[.,]([0-9]+))?)?)?"
_OFFSET = r"([+-])([01][0-9]|2[0-3])(?::?([0-5][0-9])(?::?([0-5][0-9]))?)?"
_ISO = rf"^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})(?:[\s\S]{_TIME}(?:{_OFFSET})?)?$"


_USUAL_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3])(:[0-5][0-9]){2}([+-]([01][0-9]|2[0-3]):[0-5][0-9])?$"
_DAY_FIRST = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"


# Steps from the groups of _ISO side by side to a whole time: what is left out is zero, a fraction has
# six digits and goes if they are zero, an offset has seconds only if they are not zero, and zero is plus.
_GROUPS = "$1T$2:$3:$4.$5000000#$6$7:$8:$9"
_STEPS = [
    (r"T(..)::", "T$1:00:"),
    (r":\.", ":00."),
    (r"\.(?:000000\d*|(\d{6})\d*)#", ".$1#"),
    (r"\.#", "#"),
    (r"#(?:::$)?", "#"),
    (r"#(...)::", "#$1:00:"),
    (r"#(......):(?:00)?$", "#$1"),
    (r"#-00:00$", "#+00:00"),
    (r"#", ""),
]


def _real_date(year_first: Column) -> Column:
    """The date as yyyy-MM-dd text, if the calendar has it and its year is 1 or later."""
    return F.when(~year_first.startswith("0000"), year_first.try_cast("date").cast("string"))


def post_text(raw: Column | str) -> Column:
    """Stripped, and Z as an offset: a column of its own, as ``post_date_of`` looks at it several times."""
    return F.replace(strip(raw), F.lit("Z"), F.lit("+00:00"))


def _rebuilt(text: Column) -> Column:
    whole = F.regexp_replace(text, _ISO, _GROUPS)
    for pattern, written in _STEPS:
        whole = F.regexp_replace(whole, pattern, written)
    return whole


def _iso_text(text: Column) -> Column:
    # The steps are many and needed for few texts. The function given to transform is interpreted, so
    # that they stay out of the generated code of all rows.
    whole = F.get(F.transform(F.array(text), _rebuilt), F.lit(0))
    keeps_time = F.contains(text, F.lit("T")) | F.contains(text, F.lit(":"))
    # The usual form needs no rebuilding; the other forms are taken apart.
    usual = text.rlike(_USUAL_ISO) & ~text.endswith("-00:00")
    written = F.when(~keeps_time, F.substring(text, 1, 10)).when(usual, text).otherwise(whole)
    return F.when(text.rlike(_ISO) & _real_date(F.substring(text, 1, 10)).isNotNull(), written)


def post_date_of(text: Column | str) -> Column:
    """``post_date`` of what ``post_text`` gives."""
    text = _col(text)
    iso = F.contains(text, F.lit("-")) | F.contains(text, F.lit("T"))
    # A value that is not d/M/yyyy keeps its slashes, and so is no date.
    year_first = F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")
    return F.when(iso, _iso_text(text)).when(F.contains(text, F.lit("/")), _real_date(year_first))


def post_date(raw: Column | str) -> Column:
    """``d/M/yyyy`` or ISO input to ISO text; ISO input with a time keeps its time and offset."""
    return post_date_of(post_text(raw))


def to_moment(raw: Column | str) -> Column:
    """ISO text, with ``Z`` or an offset, to a timestamp."""
    text = F.replace(_col(raw), F.lit("Z"), F.lit("+00:00"))
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_timestamp(text))
