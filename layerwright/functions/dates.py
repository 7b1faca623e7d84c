"""Date and timestamp expressions. Run dates are parameters, never the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of message texts and of config dates.
MESSAGE_FORMAT = "dd/MM/yyyy HH:mm"
DAY_FORMAT = "yyyy-MM-dd"

# Microseconds from 1970-01-01 to 2000-01-01, the zero point of PostgreSQL timestamps.
PG_EPOCH_MICROS = 946_684_800_000_000


def as_date(value: date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def run_window(col: Column, run_date: date | str, before: int = 0, after: int = 1) -> Column:
    """Half-open window ``[run_date - before, run_date + after)``, in a form sources can push down."""
    start, end = (as_date(run_date) + F.expr(f"INTERVAL {n} DAYS") for n in (-before, after))
    return (col >= start.cast("timestamp_ntz")) & (col < end.cast("timestamp_ntz"))


def day_series(start: Column, as_of: Column) -> Column:
    """Days from ``start`` to ``as_of``; NULL when the start is later or missing."""
    first = F.to_date(start)
    return F.when(first <= as_of, F.sequence(first, as_of, F.expr("INTERVAL 1 DAY")))


def lenient_timestamp(col: Column) -> Column:
    """A text in ISO or date form as timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(col)


def latest(*cols: Column) -> Column:
    """The greatest of several timestamps, leaving out missing ones."""
    return F.greatest(*cols)


def inside_open_interval(col: Column, lower: Column | datetime | None = None,
                         upper: Column | datetime | None = None) -> Column:
    """Strictly between two bounds, each of which may be absent."""
    keep = F.lit(True)
    if lower is not None:
        keep = keep & (col > (lower if isinstance(lower, Column) else F.lit(lower)))
    if upper is not None:
        keep = keep & (col < (upper if isinstance(upper, Column) else F.lit(upper)))
    return keep


def pg_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros + F.lit(PG_EPOCH_MICROS))


def day_or_default(col: Column, default: date | str) -> Column:
    """A ``yyyy-MM-dd`` text as date; the default when missing or empty."""
    return F.coalesce(F.try_to_date(F.nullif(col, F.lit("")), DAY_FORMAT), as_date(default))


def message_time(col: Column) -> Column:
    return F.date_format(col, MESSAGE_FORMAT)


def fixed_days(start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """Two lenient timestamps as ``yyyy-MM-dd`` texts."""
    cols = [c if isinstance(c, Column) else F.lit(c) for c in (start, end)]
    return tuple(F.date_format(lenient_timestamp(c), DAY_FORMAT) for c in cols)
