"""Time functions.  Timestamps are UTC instants; factory rules use the local zone explicitly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weighline import settings as S

DAY_MICROS = 86_400_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def floor_micros(us: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``us`` (also before 1970)."""
    return us - F.pmod(us, F.lit(width))


def utc_day(ts: Column) -> Column:
    """Days since 1970 of the UTC date, as a plain integer."""
    us = micros(ts)
    return (floor_micros(us, DAY_MICROS) / F.lit(DAY_MICROS)).cast("int")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds with its fraction."""
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def plus_seconds(ts: Column, seconds: int) -> Column:
    return F.timestamp_micros(micros(ts) + F.lit(int(seconds) * 1_000_000))


def local(ts: Column, zone: str = S.FACTORY_ZONE) -> Column:
    """Wall clock of ``zone``, held in a timestamp that renders as that wall clock."""
    return F.from_utc_timestamp(ts, zone)


def local_date(ts: Column, zone: str = S.FACTORY_ZONE) -> Column:
    return F.to_date(local(ts, zone))


def second_of_day(wall: Column) -> Column:
    return F.pmod(micros(wall), F.lit(DAY_MICROS)) / F.lit(1_000_000.0)


def parse_clock(text: Column, received_at: Column, zone: str = S.FACTORY_ZONE) -> Column:
    """``HH:MM`` on the factory date of ``received_at``; null when the text is not a valid clock time."""
    hour = F.substring_index(text, ":", 1).try_cast("int")
    minute = F.substring_index(text, ":", -1).try_cast("int")
    seconds = F.when(text.rlike(S.CLOCK_PATTERN) & (hour <= 23) & (minute <= 59), hour * 3600 + minute * 60)
    midnight = F.date_trunc("day", local(received_at, zone))
    wall = F.timestamp_micros(micros(midnight) + seconds.cast("bigint") * F.lit(1_000_000))
    return F.to_utc_timestamp(wall, zone)


def parse_instant(value: Column, received_at: Column) -> Column:
    """Trimmed date-time text to UTC (no zone means UTC); null when it cannot be read.

    ISO text is the common case; the other layouts are tried only for text of their shape.  Times without a date get
    the UTC date of arrival.
    """
    rare = (
        F.when(value.rlike(r"^\d{9,19}$"),
               F.timestamp_micros(F.call_function("div", value.try_cast("bigint"), F.lit(1000).cast("bigint"))))
        .when(value.rlike(r"^T?\d{1,2}:"),
              F.concat(F.date_format(received_at, "yyyy-MM-dd "), F.ltrim(value, F.lit("T"))).try_cast("timestamp"))
        .when(value.rlike(r"^\d{8}$"), F.try_to_timestamp(value, F.lit("yyyyMMdd")))
        .when(value.rlike(r"^\d{4}/"), F.try_to_timestamp(value, F.lit("yyyy/MM/dd HH:mm:ss")))
        .when(value.rlike(r"^\d{2}/"), F.try_to_timestamp(value, F.lit("MM/dd/yyyy HH:mm:ss")))
    )
    return F.when(F.substring(value, 5, 1) == "-", value.try_cast("timestamp")).otherwise(rare)


def parse_timestamp(value: Column, received_at: Column, zone: str = S.FACTORY_ZONE) -> Column:
    """Trimmed device time text to UTC.

    Missing text stays null.  ``HH:MM`` is read as factory local time, times without a zone as UTC, long digit runs
    as epoch nanoseconds.  Text that cannot be read falls back to ``received_at``, so results do not depend on when
    the job runs.
    """
    clock_like = (F.length(value) <= 5) & value.contains(":") & ~value.rlike(":.*:")
    return (
        F.when(value.isNull() | value.isin(S.MISSING_TIMESTAMP_TEXT), F.lit(None).cast("timestamp"))
        .when(clock_like, F.coalesce(parse_clock(value, received_at, zone), received_at))
        .otherwise(F.coalesce(parse_instant(value, received_at), received_at))
    )


def jitter(ts: Column, identity: Column, modulus: int = S.JITTER_MODULUS) -> Column:
    """Spread equal device times by the record counter: ``identity mod 10^7`` microseconds."""
    return F.timestamp_micros(micros(ts) + F.pmod(identity, F.lit(modulus)))


def shift_label(ts: Column, zone: str = S.FACTORY_ZONE) -> Column:
    hour = F.hour(local(ts, zone))
    return F.when((hour >= 6) & (hour < 14), "Manana").otherwise("Tarde")


def local_text(ts: Column, fmt: str = "yyyy-MM-dd HH:mm:ss", zone: str = S.FACTORY_ZONE) -> Column:
    return F.date_format(local(ts, zone), fmt)


def from_local_text(text: Column, zone: str = S.FACTORY_ZONE) -> Column:
    """Inverse of :func:`local_text`; unreadable text becomes null."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), zone)


def connection_lag(server_time: Column, event_time: Column, event_clock: str = "utc",
                   zone: str = S.FACTORY_ZONE) -> Column:
    """Seconds between arrival and event, never negative.

    ``event_clock='local'`` is for devices that send their wall clock labelled as UTC.
    """
    if event_clock not in ("utc", "local"):
        raise ValueError("event_clock must be 'utc' or 'local'")
    event = F.to_utc_timestamp(event_time, zone) if event_clock == "local" else event_time
    return F.greatest(seconds_between(server_time, event), F.lit(0.0))
