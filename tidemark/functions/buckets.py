"""Calendar buckets and order-aware first/last values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Width name -> (unit understood by trunc, months per bucket; None for days).
WIDTHS: dict[str, tuple[str, int | None]] = {
    "day": ("day", None),
    "month": ("month", 1),
    "quarter": ("quarter", 3),
    "year": ("year", 12),
}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def time_bucket(width: str, date: Column | str) -> Column:
    """First day of the calendar bucket that holds ``date``."""
    unit, months = WIDTHS[width]
    date = _col(date).cast("date")
    return date if months is None else F.trunc(date, unit)


def next_bucket(width: str, bucket: Column | str) -> Column:
    """First day of the bucket after ``bucket``."""
    _, months = WIDTHS[width]
    return F.date_add(_col(bucket), 1) if months is None else F.add_months(_col(bucket), months)


def _order_key(order: tuple[Column | str, ...]) -> Column:
    # A single fixed-width order column keeps the aggregate hash based; a
    # struct (needed only to break ties) makes Spark sort before aggregating.
    return _col(order[0]) if len(order) == 1 else F.struct(*[_col(c) for c in order])


def first_by(value: Column | str, *order: Column | str) -> Column:
    """Value at the smallest order key; a null value at that key stays null."""
    return F.min_by(_col(value), _order_key(order))


def last_by(value: Column | str, *order: Column | str) -> Column:
    """Value at the largest order key; a null value at that key stays null."""
    return F.max_by(_col(value), _order_key(order))
