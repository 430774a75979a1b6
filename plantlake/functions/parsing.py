"""Typed values out of free-form text columns, as built-in expressions.

Each parser takes the name of a text column. It returns NULL for text it cannot read and never
raises, also under ANSI mode. The expressions are given to Spark as one SQL text each: curation has
dozens of them, and building each from single column calls takes seconds on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import filterfalse

from pyspark.sql import Column
from pyspark.sql import functions as F

# The timestamp layouts found in the raw text ...
DASH_YMD_TIME = "yyyy-MM-dd HH:mm:ss"
SLASH_YMD_TIME = "yyyy/MM/dd HH:mm:ss"
SLASH_DMY_TIME = "dd/MM/yyyy HH:mm:ss"
DASH_DMY_TIME = "dd-MM-yyyy HH:mm:ss"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss"
ISO_TIME_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DASH_YMD = "yyyy-MM-dd"
SLASH_YMD = "yyyy/MM/dd"
SLASH_DMY = "dd/MM/yyyy"
DASH_DMY = "dd-MM-yyyy"

# ... and which of them each kind of column is read with.
FORMATS_ALL = (
    DASH_YMD_TIME, DASH_YMD, SLASH_YMD_TIME, SLASH_YMD, SLASH_DMY_TIME, SLASH_DMY,
    DASH_DMY_TIME, DASH_DMY, ISO_TIME, ISO_TIME_Z,
)
FORMATS_P10 = FORMATS_ALL
FORMATS_P9 = (
    DASH_YMD_TIME, ISO_TIME, SLASH_YMD_TIME, SLASH_DMY_TIME, DASH_DMY_TIME,
    DASH_YMD, SLASH_YMD, SLASH_DMY, DASH_DMY,
)
FORMATS_P8 = (
    DASH_YMD_TIME, SLASH_YMD_TIME, SLASH_DMY_TIME, DASH_DMY_TIME,
    DASH_YMD, SLASH_YMD, SLASH_DMY, DASH_DMY,
)
FORMATS_P5 = (DASH_YMD_TIME, SLASH_YMD_TIME, SLASH_DMY_TIME, DASH_YMD, SLASH_YMD)
FORMATS_P11_DATE = (
    DASH_YMD_TIME, ISO_TIME, DASH_DMY_TIME, DASH_YMD, SLASH_YMD, SLASH_DMY, DASH_DMY,
)

# Fixed value: all layouts begin with a date of so many characters.
DATE_LENGTH = 10

# The spellings of a boolean, after lower-casing and trimming.
TRUE_WORDS = ("true", "1", "yes", "y", "t")
FALSE_WORDS = ("false", "0", "no", "n", "f")


def _plain(fmt: str) -> str:
    return fmt.replace("'", "")


def _pattern(fmt: str) -> str:
    """A regular expression for the layout: ``dd/MM`` gives ``[0-9]{2}/[0-9]{2}``."""
    return re.sub("y+|M+|d+|H+|m+|s+", lambda run: f"[0-9]{{{len(run[0])}}}", _plain(fmt))


def _patterns(layouts: Iterable[str]) -> str:
    """One regular expression for several layouts; those that begin with the same date share its part."""
    times: dict[str, list[str]] = {}
    for fmt in map(_plain, layouts):
        times.setdefault(_pattern(fmt[:DATE_LENGTH]), []).append(_pattern(fmt[DATE_LENGTH:]))
    return "|".join(f"{day}(?:{'|'.join(rest)})" for day, rest in times.items())


def _year_first(fmt: str) -> bool:
    return fmt.startswith("yyyy")


def _name(column: str) -> str:
    return f"`{column}`"


def parse_timestamp(column: str, formats: Sequence[str] = FORMATS_ALL) -> Column:
    """Timestamp without time zone from text in any one of ``formats``, else NULL.

    Fields have a fixed width, so the positions of digits and separators alone tell which layout a
    value has, and no text fits two of them. Two precompiled patterns sort values into those with
    the year first and those with the day first, and one cast reads the value after its date is put
    in year-month-day order. Trying the layouts in turn raises and catches an exception per miss,
    which costs many times as much.
    """
    text = _name(column)
    # All layouts have the date in characters 1-10 and a time, if any, in 11-19.
    year_first = f"replace(substring({text}, 1, 19), '/', '-')"
    day_first = (
        f"concat(substring({text}, 7, 4), '-', substring({text}, 4, 2), '-',"
        f" substring({text}, 1, 2), substring({text}, 11, 9))"
    )
    cases = []
    for layouts, value in (
        (filter(_year_first, formats), year_first),
        (filterfalse(_year_first, formats), day_first),
    ):
        patterns = _patterns(layouts)
        if patterns:
            cases.append(rf"WHEN {text} RLIKE r'^(?:{patterns})\z' THEN {value}")
    return F.expr(f"try_cast(CASE {' '.join(cases)} END AS timestamp_ntz)")


def parse_date(column: str, formats: Sequence[str] = FORMATS_ALL) -> Column:
    """Date from text that may carry a time of day."""
    return parse_timestamp(column, formats).cast("date")


def _decimal_point(column: str) -> str:
    return f"replace({_name(column)}, ',', '.')"


def parse_decimal(column: str, precision: int = 18, scale: int = 4) -> Column:
    """Decimal from text with a decimal comma or point."""
    return F.expr(f"try_cast({_decimal_point(column)} AS decimal({precision},{scale}))")


def parse_int(column: str) -> Column:
    """Integer from numeric text; decimals are cut off, not rounded."""
    number = f"try_cast({_decimal_point(column)} AS decimal(38,18))"
    return F.expr(f"try_cast({number} AS int)")


def parse_bool(column: str) -> Column:
    word = f"lower(trim({_name(column)}))"
    yes, no = (", ".join(f"'{w}'" for w in words) for words in (TRUE_WORDS, FALSE_WORDS))
    return F.expr(f"CASE WHEN {word} IN ({yes}) THEN true WHEN {word} IN ({no}) THEN false END")


def norm_upper(column: str) -> Column:
    return F.expr(f"upper(trim({_name(column)}))")


def norm_lower(column: str) -> Column:
    return F.expr(f"lower(trim({_name(column)}))")


def as_is(column: str) -> Column:
    return F.col(column)
