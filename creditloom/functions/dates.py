"""Date parsing and age."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = r"^(?:\d{1,2}[/.\-]\d{1,2}[/.\-]\d{4}|\d{4}-\d{1,2}-\d{1,2})(?:[T ][\d:.]+(?:Z|[+\-]\d{2}:?\d{2})?)?$"
_PAIR = r"^(\d{1,2})[/.\-](\d{1,2})[/.\-]"
_END = r"(?=\D|$)"
_FULL_PAIR = rf"{_PAIR}(\d{{4}}){_END}"
_WEEKDAY = r"^(?:[A-Za-z]+,\s*)?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?,?"
_MONTH = r"([A-Za-z]{3})[A-Za-z]*\.?,?"


def _below(limit: int) -> str:
    """Pattern of the two-digit numbers under ``limit``."""
    tens, ones = divmod(limit, 10)
    parts = [f"[0-{tens - 1}]\\d"] if tens else []
    parts += [f"{tens}[0-{ones - 1}]"] if ones else []
    return f"(?:{'|'.join(parts)})" if parts else "(?!)"


def _tidy(value: Column, pivot_year: int) -> Column:
    """Text with one spelling per date style; a chain, so each step is written once.

    Year-first dates become ``y-M-d``, two-digit years become four-digit ones and
    named months become ``Mon-d-y``.
    """
    century, split = pivot_year // 100, (pivot_year + 50) % 100
    early, late = (century, century - 1) if pivot_year % 100 < 50 else (century + 1, century)
    steps = (
        (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})" + _END, "$1-$2-$3"),
        (r"^(\d{4})(\d{2})(\d{2})(?=T|\s|$)", "$1-$2-$3"),
        (f"{_PAIR}({_below(split)}){_END}", f"$1/$2/{early}$3"),
        (rf"{_PAIR}(\d{{2}}){_END}", f"$1/$2/{late}$3"),
        (rf"{_WEEKDAY}{_MONTH}[\s\-]+{_DAY}[\s\-]+(\d{{4}})", "$1-$2-$3"),
        (rf"{_WEEKDAY}{_DAY}[\s\-]+{_MONTH}[\s\-]+(\d{{4}})", "$2-$1-$3"),
        (r"\s*([AaPp][Mm])$", " $1"),
    )
    given = F.trim(value)

    def respelled(text: Column) -> Column:
        return reduce(lambda t, step: F.regexp_replace(t, *step), steps, text)

    # the usual spellings need none of this
    return F.when(given.rlike(_PLAIN), given).otherwise(_apart(given, respelled))


def _apart(text: Column, expression: Callable[[Column], Column]) -> Column:
    """A rare branch as a lambda, which Spark keeps out of whole-stage code.

    Inlined for several columns it makes a method too long for the JIT.
    """
    return F.element_at(F.transform(F.array(text), expression), 1)


def _read(text: Column) -> Column:
    """Tidy text to ``timestamp_ntz``; an offset is dropped, the clock time kept."""
    month_first = F.regexp_replace(text, _FULL_PAIR, "$3-$1-$2")
    day_first = F.regexp_replace(text, _FULL_PAIR, "$3-$2-$1")
    worded = F.when(text.rlike(r"(?i)^[a-z]{3}-|[ap]m$"), _read_words(text))
    # a text that starts with a pair is never cast as it stands, so the others are spared the patterns
    return F.coalesce(
        text.try_cast("timestamp_ntz"), month_first.try_cast("timestamp_ntz"), day_first.try_cast("timestamp_ntz"), worded
    )


def _read_words(text: Column) -> Column:
    """Month names and the 12-hour clock."""

    def by_pattern(date: Column, fmt: str) -> Column:
        return F.try_to_timestamp(date, F.lit(fmt)).cast("timestamp_ntz")

    def read(t: Column) -> Column:
        upper = F.upper(t)
        return F.coalesce(
            by_pattern(F.initcap(t), "MMM-d-y[ H:m[:s]]"),
            by_pattern(F.regexp_replace(upper, _FULL_PAIR, "$3-$1-$2"), "y-M-d h[:m[:s]] a"),
            by_pattern(F.regexp_replace(upper, _FULL_PAIR, "$3-$2-$1"), "y-M-d h[:m[:s]] a"),
        )

    return _apart(text, read)


def _plausible(parsed: Column) -> Column:
    """Null outside the years a nanosecond timestamp holds in full."""
    return F.when(F.year(parsed).between(1678, 2261), parsed)


def parse_mixed(value: Column, *, pivot_year: int = 2025) -> Column:
    """Parse text dates of unknown style to ``timestamp_ntz``; bad text gives null.

    Accepted: ISO (``-``, ``/`` or ``.``, optional time and offset), ``yyyyMMdd``,
    numeric day/month pairs and English month names. A numeric pair is read
    month-first and, when that is no valid date, day-first. A two-digit year falls
    in the hundred years around ``pivot_year``. Years outside 1678..2261 give null.
    """
    return _plausible(_read(_tidy(value, pivot_year)))


def parse_dates(df: DataFrame, columns: Iterable[str], *, pivot_year: int = 2025) -> DataFrame:
    """Parse the named columns that exist; typed columns only lose their zone.

    Three projections: each step's result is used several times by the next one,
    and as a column of its own it is computed once.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    named = [c for c in columns if c in kinds]
    texts = [c for c in named if isinstance(kinds[c], T.StringType)]
    parsed = {c: F.col(c).cast("timestamp_ntz") for c in named if c not in texts}
    parsed |= {c: _read(F.col(c)) for c in texts}
    if texts:
        df = df.withColumns({c: _tidy(F.col(c), pivot_year) for c in texts})
    if parsed:
        df = df.withColumns(parsed)
    return df.withColumns({c: _plausible(F.col(c)) for c in texts}) if texts else df


def age_years(born: Column, on: Column, *, oldest: int = 130) -> Column:
    """Whole days between two dates over 365.25; impossible ages are null."""
    years = F.datediff(on, born) / F.lit(365.25)
    return F.when(years.between(0, oldest), years)
