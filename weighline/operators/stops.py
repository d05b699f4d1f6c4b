"""Line stops: silence of more than ten minutes during the shift.

For the last record ``L`` before a silence the alert falls at ``max(L + 600 s, 06:00 local)``.  It is raised when the
next record of the line has not come by then, the local date has not changed, and the alert falls before lunch (for
records before 15:00) or before the end of the shift (for records from 15:00 on).

A silence of ten minutes cannot lie inside a slice of at most that length, so only the last record of a slice
matters: records reduce to one row per (line, slice) by a map-side-combined aggregate and are never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weighline import settings as S
from weighline.functions import text as tx, times
from weighline.operators.batches import LINE, Segments

_SECOND = 1_000_000


def fire_time(last_us: Column, zone: str = S.FACTORY_ZONE, threshold: int = S.STOP_THRESHOLD_SECONDS) -> Column:
    """Microseconds at which the silence after ``last_us`` is reported."""
    midnight = F.date_trunc("day", times.local(F.timestamp_micros(last_us), zone))
    shift_start = F.to_utc_timestamp(times.plus_seconds(midnight, S.SHIFT_START), zone)
    return F.greatest(last_us + F.lit(threshold * _SECOND), times.micros(shift_start))


def in_watch(last_us: Column, fire_us: Column, zone: str = S.FACTORY_ZONE) -> Column:
    """Whether an alert at ``fire_us`` for a record at ``last_us`` falls into watched time."""
    last, fire = (times.local(F.timestamp_micros(c), zone) for c in (last_us, fire_us))
    morning = times.second_of_day(last) < S.AFTERNOON_START
    limit = F.when(morning, S.LUNCH_START).otherwise(S.SHIFT_END)
    return (F.to_date(last) == F.to_date(fire)) & (times.second_of_day(fire) < limit)


def _tails(seg: Segments, zone: str) -> DataFrame:
    """Last run of every slice with the time of the line's next record on the same local date."""
    if seg.slicing.width_seconds > S.STOP_THRESHOLD_SECONDS:
        raise ValueError("stop detection needs slices of at most ten minutes")
    cols = ["article", "last_us", "day", "key_slice", "key_run"] + (["last_lag"] if "last_lag" in seg.measures else [])
    per_slice = (seg.fragments.groupBy(*LINE, "slice_us")
                 .agg(F.min("first_us").alias("head_us"), F.max_by(F.struct(*cols), "run").alias("t"))
                 .select(*LINE, "slice_us", "head_us", "t.*"))
    local_day = times.local_date(F.timestamp_micros("last_us"), zone)
    w = Window.partitionBy(*LINE, "local_day").orderBy("slice_us")
    return per_slice.withColumn("local_day", local_day).withColumn("next_us", F.lead("head_us").over(w))


def last_lag_seconds(col: Column) -> Column:
    return F.coalesce(col["seconds"], F.lit(0.0))


def _alerts(tails: DataFrame, batches: DataFrame, fire: Column, silence_until: Column, zone: str,
            max_lag: int | None) -> DataFrame:
    rows = tails.withColumn("_fire", fire)
    rows = rows.withColumn("_until", silence_until)
    if max_lag is not None:
        if "last_lag" not in tails.columns:
            raise ValueError("the lag rule needs records with lag_seconds")
        rows = rows.where(last_lag_seconds(F.col("last_lag")) <= max_lag)
    about = batches.select(*LINE, "day", "key_slice", "key_run", "batch_instance_id", "start_time")
    gap = (F.col("_until") - F.col("last_us")) / F.lit(float(_SECOND))
    topic = tx.virtual_topic(F.col("mqtt_topic"), F.col("linea"))
    return (rows.join(about, [*LINE, "day", "key_slice", "key_run"])
            .select("mqtt_topic", topic.alias("topic"), F.lit(S.STOP_TYPE).alias("alert_type"),
                    F.col("article").alias("product"), F.col("linea").alias("origin_line"),
                    F.lit(S.STOP_LINE_TEXT).alias("current_line"), "batch_instance_id",
                    F.col("start_time").alias("prev_start"), F.timestamp_micros("last_us").alias("prev_end"),
                    F.timestamp_micros("_until").alias("curr_start"), gap.alias("gap_seconds"),
                    tx.stop_message(F.col("linea"), F.col("article"), gap).alias("message")))


def detect_stops(seg: Segments, zone: str = S.FACTORY_ZONE, max_lag: int | None = None,
                 closed_only: bool = False) -> DataFrame:
    """One alert per silence in the history.  ``max_lag`` suppresses silences that follow a late delivery.

    ``closed_only`` leaves out the silence after a line's newest record: in a stream it is reported when it ends, and
    by the live check while it lasts.
    """
    fire = fire_time(F.col("last_us"), zone)
    tails = _tails(seg, zone)
    if closed_only:
        newest = tails.groupBy(*LINE).agg(F.max("last_us").alias("_newest"))
        tails = tails.join(newest, LINE).where(F.col("last_us") < F.col("_newest")).drop("_newest")
    tails = tails.where((F.col("next_us").isNull() | (fire < F.col("next_us")))
                                    & in_watch(F.col("last_us"), fire, zone))
    return _alerts(tails, seg.batches, fire, F.col("_fire"), zone, max_lag)


def stops_now(seg: Segments, now: Column, zone: str = S.FACTORY_ZONE, max_lag: int | None = None) -> DataFrame:
    """Lines that are silent at ``now`` and whose silence has been reported; ``gap_seconds`` counts up to ``now``."""
    now_us = times.micros(now)
    seen = (_tails(seg, zone).where(F.col("last_us") <= now_us)
            .groupBy(*LINE).agg(F.max_by(F.struct("last_us", "article", "day", "key_slice", "key_run",
                                                  *(["last_lag"] if "last_lag" in seg.measures else [])),
                                         "slice_us").alias("t"))
            .select(*LINE, "t.*"))
    fire = fire_time(F.col("last_us"), zone)
    silent = seen.where((fire < now_us) & in_watch(F.col("last_us"), fire, zone))
    return _alerts(silent, seg.batches, fire, now_us, zone, max_lag)


def connection_lag(df: DataFrame) -> DataFrame:
    """Largest arrival lag per line (records carry ``lag_seconds``)."""
    return df.groupBy("mqtt_topic", "linea").agg(F.max(F.coalesce("lag_seconds", F.lit(0.0))).alias("max_lag_seconds"))


def with_lag(df: DataFrame, event_clock: str = "utc", zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Add ``lag_seconds`` from ``server_time``."""
    return df.withColumn("lag_seconds",
                         times.connection_lag(F.col("server_time"), F.col("timestamp"), event_clock, zone))
