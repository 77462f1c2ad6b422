"""Date parsing, validity and durations. All follow a given as-of moment, never the clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import as_col, blank, status_like

# --- fixed values -----------------------------------------------------------
REAL_FROM, REAL_BEFORE = "2000-01-01", "2090-01-01"
TIMESTAMP_FORMATS = (
    "dd.MM.yyyy H:mm:ss",
    "dd.MM.yyyy HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)
# ----------------------------------------------------------------------------


def parse_ts(c: str | Column) -> Column:
    """First reading that succeeds: a plain cast, then the known text formats."""
    c = as_col(c)
    text = c.cast("string")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS]
    return F.coalesce(c.try_cast("timestamp"), *tries)


def unparsed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows holding non-blank text that no format reads (lazy twin of the assertion)."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | (~blank(c) & parse_ts(c).isNull())
    return df.filter(bad)


def parse_ts_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Parse the columns; text that does not parse is an error, not an open date."""
    if unparsed(df, cols).take(1):
        raise ValueError(f"unparseable date text in {list(cols)}")
    return df.withColumns({c: parse_ts(c) for c in cols})


def real_date(c: str | Column) -> Column:
    """Holds a date that is not one of the far-past or far-future stand-ins."""
    day = as_col(c).cast("date")
    return F.coalesce(
        (day >= F.lit(REAL_FROM).cast("date")) & (day < F.lit(REAL_BEFORE).cast("date")),
        F.lit(False),
    )


def as_of_day(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def as_of_end(as_of: str) -> Column:
    """Last second of the as-of day."""
    return F.lit(f"{as_of} 23:59:59").cast("timestamp")


def cap_open_end(c: str | Column, as_of: str) -> Column:
    """An end that is missing, in the future or in year 9999 becomes the as-of moment."""
    end = as_col(c).cast("timestamp")
    now = as_of_end(as_of)
    return F.when(end.isNull() | (end > now) | (F.year(end) >= 9999), now).otherwise(end)


def _seconds(c: str | Column) -> Column:
    return as_col(c).cast("timestamp").cast("long")


def duration_days(end: str | Column, start: str | Column) -> Column:
    """Fractional days between two moments."""
    return (_seconds(end) - _seconds(start)) / F.lit(86400.0)


def hours_between(end: str | Column, start: str | Column) -> Column:
    return (_seconds(end) - _seconds(start)) / F.lit(3600.0)


def days_late(actual: str | Column, planned: str | Column) -> Column:
    """Whole calendar days from the planned to the actual date."""
    return F.datediff(as_col(actual).cast("date"), as_col(planned).cast("date"))


def age_anchor(status: str, created: str, started: str) -> Column:
    """Start of ageing: creation while in the backlog, else start, else creation."""
    return F.when(status_like(status, "BACKLOG"), F.col(created)).otherwise(
        F.coalesce(F.col(started), F.col(created))
    )


def interval_inverted(start: str | Column, end: str | Column) -> Column:
    return F.coalesce(as_col(end) < as_col(start), F.lit(False))


DATE_PARTS = ("timestamp", "year", "month", "day", "dayofweek", "quarter")


def expand_datetime(df: DataFrame, cols: Sequence[str], parts: Sequence[str] = DATE_PARTS) -> DataFrame:
    """Replace each date column by numeric parts; Monday is day 0 of the week."""
    reader = {
        "timestamp": _seconds, "year": F.year, "month": F.month, "day": F.dayofmonth,
        "dayofweek": F.weekday, "quarter": F.quarter,
    }
    new = {
        f"{c}__{p}": reader[p](F.col(c).cast("timestamp")).cast("double")
        for c in cols for p in parts
    }
    return df.withColumns(new).drop(*cols)
