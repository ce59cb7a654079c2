"""Calendar helpers shared by every operator.

All windows in the reference are relative to ``CURRENT_DATE``; here each
operator takes an explicit ``as_of`` date so results can be repeated.  The
helpers return *literal* columns wherever possible so Catalyst folds them
and the predicate reaches the Parquet / JDBC scan as a pushed filter.
"""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = _dt.date | str | None


def to_date(as_of: DateLike) -> _dt.date:
    """Normalise an ``as_of`` argument; ``None`` means today (UTC)."""
    if as_of is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def ts_literal(value: _dt.date | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (midnight for a date)."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def shift_months(d: _dt.date, months: int) -> _dt.date:
    """Calendar month arithmetic, clipping to the month end (SQL semantics)."""
    idx = d.year * 12 + (d.month - 1) + months
    y, m = divmod(idx, 12)
    last = calendar.monthrange(y, m + 1)[1]
    return _dt.date(y, m + 1, min(d.day, last))


def lookback_start(as_of: DateLike, n: int, unit: str) -> _dt.date:
    """``as_of - INTERVAL 'n unit'`` for unit in days / weeks / months / years."""
    d = to_date(as_of)
    unit = unit.lower().rstrip("s")
    if unit == "day":
        return d - _dt.timedelta(days=n)
    if unit == "week":
        return d - _dt.timedelta(weeks=n)
    if unit == "month":
        return shift_months(d, -n)
    if unit == "year":
        return shift_months(d, -12 * n)
    raise ValueError(f"unknown interval unit {unit!r}")


def since(col: str | Column, as_of: DateLike, n: int, unit: str) -> Column:
    """Predicate ``col >= as_of - INTERVAL 'n unit'`` (no upper bound, as in the reference)."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= ts_literal(lookback_start(as_of, n, unit))


def whole_days(as_of: DateLike, col: str | Column) -> Column:
    """``EXTRACT(DAYS FROM CURRENT_DATE - ts)``: whole elapsed 24-hour days.

    Not ``datediff``: 59 days 14 hours is 59 here, 60 by calendar dates.
    """
    c = F.col(col) if isinstance(col, str) else col
    diff = ts_literal(to_date(as_of)) - c.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), diff).cast("int")


def trunc_ts(unit: str, col: str | Column) -> Column:
    """``DATE_TRUNC(unit, ts)`` kept as TIMESTAMP_NTZ (Spark widens it to TIMESTAMP)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def dow_sunday0(col: str | Column) -> Column:
    """``EXTRACT(DOW ...)``: Sunday = 0 .. Saturday = 6 (Spark's dayofweek is 1-based)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.dayofweek(c) - 1).cast("int")


def is_weekend(col: str | Column) -> Column:
    return dow_sunday0(col).isin(0, 6)


# Season by calendar month, as the reference assigns them
# (month 2 falls to 'Fall' because no branch lists it).
SEASON_MONTHS = [
    ("Holiday Season", (11, 12, 1)),
    ("Summer", (6, 7, 8)),
    ("Spring", (3, 4, 5)),
]
SEASON_DEFAULT = "Fall"


def season(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    m = F.month(c)
    expr = None
    for label, months in SEASON_MONTHS:
        expr = (F.when(m.isin(*months), label) if expr is None
                else expr.when(m.isin(*months), label))
    return expr.otherwise(SEASON_DEFAULT)


def day_type(col: str | Column) -> Column:
    return F.when(is_weekend(col), "Weekend").otherwise("Weekday")
