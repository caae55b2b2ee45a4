"""Timestamps without zone, date keys and calendar parts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace import config

_DAY_MICROS = 86_400_000_000

_DATE = r"\d{4}-\d{2}-\d{2}"

# The text forms that a column of moments may have, and how each is read. One form holds for a whole column.
TIMESTAMP_FORMS: dict[str, str] = {
    "date": rf"^{_DATE}$",
    "minutes": rf"^{_DATE} \d{{2}}:\d{{2}}$",
    "seconds": rf"^{_DATE} \d{{2}}:\d{{2}}:\d{{2}}$",
    "fraction": rf"^{_DATE} \d{{2}}:\d{{2}}:\d{{2}}\.\d{{1,9}}$",
    "t_minutes": rf"^{_DATE}T\d{{2}}:\d{{2}}$",
    "t_seconds": rf"^{_DATE}T\d{{2}}:\d{{2}}:\d{{2}}$",
    "t_fraction": rf"^{_DATE}T\d{{2}}:\d{{2}}:\d{{2}}\.\d{{1,9}}$",
    "slashes": r"^\d{4}/\d{1,2}/\d{1,2}( \d{2}:\d{2}:\d{2})?$",
    "month_first": r"^\d{1,2}/\d{1,2}/\d{4}( \d{2}:\d{2}:\d{2})?$",
}


def form_of(text: str | None) -> str | None:
    """The form of a column whose first value is ``text``; None (any form, value by value) if it has none."""
    return next((name for name, pattern in TIMESTAMP_FORMS.items() if text is not None and re.match(pattern, text)), None)


def parse_timestamp(text: Column, form: str | None = None) -> Column:
    """Text to a timestamp without zone; what is not of the form (by default: of any form) is null.

    Going straight to ``timestamp_ntz`` keeps the session time zone (and its daylight-saving gaps)
    out of the result. Fractions beyond microseconds are cut off.
    """
    text = text.cast("string")
    dashed = F.when(text.contains("/"), F.regexp_replace(
        F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"), r"^(\d{4})/(\d{1,2})/", "$1-$2-"
    )).otherwise(F.substring(text, 1, len("yyyy-MM-dd HH:mm:ss.SSSSSS")))
    pattern = TIMESTAMP_FORMS[form] if form else "|".join(TIMESTAMP_FORMS.values())
    return F.when(text.rlike(pattern), dashed.try_cast("timestamp_ntz"))


def date_key(moment: Column) -> Column:
    """``YYYYMMDD`` integer, -1 where the moment is unknown."""
    number = F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)
    return F.coalesce(number, F.lit(config.UNKNOWN_KEY)).cast("int")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded towards the past (-1 hour is -1 day).

    Integer arithmetic on microseconds, so no midnight counting and no rounding.
    """
    micros = F.timestamp_diff("MICROSECOND", start, end)
    whole = micros - F.pmod(micros, F.lit(_DAY_MICROS))
    return (whole / F.lit(_DAY_MICROS)).cast("int")
