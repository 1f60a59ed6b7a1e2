"""Date and time Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(*candidates: Column | str, fmt: str | None = None) -> Column:
    """First candidate that is present, as a timestamp; unparsable text gives null."""
    text = F.coalesce(*[_col(c).cast("string") for c in candidates])
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def week_start(c: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(_col(c), "week")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def second(c: Column | str) -> Column:
    return F.date_trunc("second", _col(c))


def time_of_day(c: Column | str) -> Column:
    return F.date_format(_col(c), "HH:mm:ss")


def date_parts(c: Column | str) -> dict[str, Column]:
    """Calendar parts by name, ready for ``select(*[v.alias(k) ...])``."""
    col = _col(c)
    return {
        "year": F.year(col),
        "month": F.month(col),
        "day": F.dayofmonth(col),
        "hour": F.hour(col),
        "minute": F.minute(col),
        "second": F.second(col),
        "week": F.weekofyear(col),
    }


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Number of full 24-hour days from ``earlier`` to ``later``."""
    seconds = F.unix_timestamp(_col(later).cast("timestamp")) - F.unix_timestamp(_col(earlier).cast("timestamp"))
    return F.floor(seconds / 86400).cast("long")


def from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def to_epoch(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def now_or(value=None) -> Column:
    """The injected moment, or the wall clock when none is given."""
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")


def local_time(ts: Column | str, zone: Column | str) -> Column:
    """UTC moment shown on the clock of the row's own zone; null zone gives null."""
    zone = _col(zone)
    return F.when(zone.isNotNull(), F.from_utc_timestamp(_col(ts).cast("timestamp"), zone))
