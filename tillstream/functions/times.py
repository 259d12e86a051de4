"""Times: epochs and texts with an explicit zone, day borders, ages."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def micros(d: timedelta) -> int:
    """A duration in microseconds, the unit all time comparisons use."""
    return d // timedelta(microseconds=1)


def interval_text(d: timedelta) -> str:
    """A duration as the interval text Spark's ``window`` and ``withWatermark`` take."""
    return f"{micros(d)} microseconds"


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def epoch_ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def text(ts: Column, fmt: str = TEXT_FORMAT) -> Column:
    return F.date_format(ts, fmt)


def text_to_epoch_ms(col: Column, zone: str, fmt: str = TEXT_FORMAT) -> Column:
    """A local date-time text in ``zone`` as epoch milliseconds; null if not parsable."""
    local = F.try_to_timestamp(col, F.lit(fmt))
    return F.unix_millis(F.to_utc_timestamp(local, zone))


def epoch_ms_to_text(ms: Column, zone: str, fmt: str = TEXT_FORMAT) -> Column:
    """Epoch milliseconds as a local date-time text in ``zone``."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), zone), fmt)


def local_day(ts: Column, zone: str) -> Column:
    """The calendar day of an instant in ``zone``."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))


def next_midnight(ts: Column, zone: str) -> Column:
    """The instant of the next local midnight in ``zone``."""
    return F.to_utc_timestamp(F.date_add(local_day(ts, zone), 1).cast("timestamp"), zone)


def event_time(col: Column, fallback: Column, fmt: str = TEXT_FORMAT) -> Column:
    """The parsed event time, or the time the record came in if the text is no time."""
    return F.coalesce(F.try_to_timestamp(col, F.lit(fmt)), fallback.cast("timestamp"))


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years from ``birthday`` to ``as_of``."""
    return F.floor(F.datediff(as_of, birthday) / 365).cast("int")


def create_parts(ts: Column) -> dict[str, Column]:
    """Date, hour and epoch milliseconds derived from a creation time."""
    return {
        "create_date": F.date_format(ts, "yyyy-MM-dd"),
        "create_hour": F.date_format(ts, "HH"),
        "create_ts": F.unix_millis(ts.cast("timestamp")),
    }
