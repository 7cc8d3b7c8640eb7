"""Scalar rules as Column expressions: no Python runs per row."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import NULL_TOKENS

_DAY_MICROS = 86_400_000_000
_DAY_MILLIS = 86_400_000

_PERIOD_NAME = re.compile(r"^\d{4}(-\d{2}|-?Q[1-4])?$")
_CAMEL_EDGE = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    An optimizer that pushes a filter below a projection repeats the columns
    the filter uses; a parsed payload is too dear for that.
    """
    return F.transform(F.array(value), body)[0]


# -- numbers ------------------------------------------------------------------


def dot_to_null(value: Column | str) -> Column:
    """Observation text to double: "." means missing, other bad text is an error."""
    return F.nullif(_col(value), F.lit(".")).cast("double")


def lenient_number(text: Column | str) -> Column:
    """Text to double; bad text and NaN become null.

    The cast would take a type suffix ("1d", "2.5f"), which is no number here.
    """
    text = _col(text).cast("string")
    number = text.try_cast("double")
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$") & ~F.isnan(number), number)


def null_token_text(text: Column | str) -> Column:
    """Text with the tokens that stand for "no value" turned to null."""
    text = _col(text)
    return F.when(~text.isin(NULL_TOKENS), text)


def null_token_number(text: Column | str) -> Column:
    return lenient_number(null_token_text(text))


def to_decimal6(value: Column | str) -> Column:
    """Decimal(18,6) rounded half to even; NaN, infinities and bad text become null."""
    wide = _col(value).try_cast("decimal(38,18)")
    return F.bround(wide, 6).try_cast("decimal(18,6)")


def to_long(value: Column | str) -> Column:
    """Whole number, cut toward zero; NaN and anything that is no number become null."""
    return _col(value).try_cast("bigint")


def to_bool(value: Column | str) -> Column:
    """Truth of a number or flag; null stays null."""
    return _col(value).cast("boolean")


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 where there is nothing to divide by."""
    return F.coalesce(part * 100.0 / F.nullif(whole, F.lit(0)), F.lit(0.0))


# -- dates --------------------------------------------------------------------


def strict_date(text: Column | str) -> Column:
    """``YYYY-MM-DD`` to date; other text is an error."""
    return F.to_date(_col(text), "yyyy-MM-dd")


def lenient_date(text: Column | str) -> Column:
    """``YYYY-MM-DD`` to date; other text becomes null."""
    text = _col(text)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def quarter_to_date(text: Column | str) -> Column:
    """``YYYYQn`` or ``YYYY-Qn`` to the first day of the quarter."""
    text = _col(text)
    year = F.substring(text, 1, 4).try_cast("int")
    quarter = F.right(text, F.lit(1)).try_cast("int")
    return F.when(text.rlike(r"^\d{4}-?Q[1-4]$"), F.make_date(year, quarter * 3 - 2, F.lit(1)))


def parse_period(text: Column | str) -> Column:
    """Year, month, quarter or day text to its first day; other text becomes null.

    Every row is judged by its own text.
    """
    text = _col(text)
    iso = F.when(text.rlike(r"^\d{4}(-\d{2}){0,2}$"), text.try_cast("date"))
    return F.coalesce(iso, quarter_to_date(text))


def month_start(date: Column | str) -> Column:
    return F.trunc(_col(date), "month")


def ms_to_date(millis: Column | str) -> Column:
    """Epoch milliseconds to the UTC date, whatever the session zone is."""
    return F.date_from_unix_date(F.floor(_col(millis) / F.lit(_DAY_MILLIS)).cast("int"))


def utc_date(ts: Column | str) -> Column:
    """UTC date of a timestamp, whatever the session zone is."""
    return F.date_from_unix_date(F.floor(F.unix_micros(_col(ts)) / F.lit(_DAY_MICROS)).cast("int"))


def as_utc(ts: Column | str) -> Column:
    """A zone-less timestamp read as UTC."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(ts).cast("timestamp_ntz"))
    return local.cast("timestamp")


def days_before(date: Column | str, days: int) -> Column:
    return F.date_sub(_col(date), days)


def day_text(date: Column | str) -> Column:
    return F.date_format(_col(date), "yyyy-MM-dd")


def month_text(date: Column | str) -> Column:
    return F.date_format(_col(date), "yyyy-MM")


# -- names and text -----------------------------------------------------------


def looks_like_period(name: str) -> bool:
    """True for column names that are a year, month or quarter."""
    return bool(_PERIOD_NAME.match(name))


def is_period(text: Column | str) -> Column:
    return _col(text).rlike(_PERIOD_NAME.pattern)


def snake_case(text: Column | str) -> Column:
    """camelCase to snake_case; runs of capitals stay together."""
    return F.lower(F.regexp_replace(_col(text), r"(?<=\p{Ll})(?=\p{Lu})", "_"))


def snake_name(name: str) -> str:
    """``snake_case`` for a column name."""
    return _CAMEL_EDGE.sub("_", name).lower()


def strip_ordinal(label: Column | str) -> Column:
    """Text after the first ". " ("5. adjusted close" gives "adjusted close")."""
    label = _col(label)
    return F.regexp_replace(label, r"^(?s).*?\. ", "")


def series_label(label: Column | str) -> Column:
    """Column name of an adjusted-series label."""
    return F.replace(snake_case(strip_ordinal(label)), F.lit(" "), F.lit("_"))


def first_available(*values: Column | str) -> Column:
    return F.coalesce(*[_col(v) for v in values])


def nested_to_json(value: Column | str) -> Column:
    return F.to_json(_col(value))


def upper_key(key: Column | str) -> Column:
    return F.upper(_col(key))


def characters(text: Column | str) -> Column:
    return F.char_length(_col(text))
