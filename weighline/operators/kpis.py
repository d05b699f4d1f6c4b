"""Production figures per time window, batch and shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighline import settings as S
from weighline.functions import times
from weighline.functions.numbers import half_up

DIGITS = 4
#: Sums that figures are made of; they add up over parts of a feed.
PARTS_SCHEMA = ("minute timestamp, mqtt_topic string, linea string, units bigint, units_ok bigint, units_rejected bigint, "
                "net_g double, workers_sum bigint")
PARTS = ["units", "units_ok", "units_rejected", "net_g", "workers_sum"]


def _ratio(a: Column, b: Column) -> Column:
    return half_up(F.try_divide(a.cast("double"), b.cast("double")), DIGITS)


def _figures(hours: Column) -> dict[str, Column]:
    kg = F.col("net_g") / 1000
    workers = F.col("workers_sum") / F.col("units")
    return {
        "kg": half_up(kg, DIGITS),
        "quality_ratio": _ratio(F.col("units_ok"), F.col("units")),
        "kg_per_hour": _ratio(kg, hours),
        "packages_per_minute": _ratio(F.col("units"), hours * 60),
        "mean_workers": half_up(workers, DIGITS),
        "kg_person_hour": _ratio(kg / hours, workers),
    }


def _sums(df: DataFrame, *keys) -> DataFrame:
    ok = F.col("quality_status") == "OK"
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("units"), F.count_if(ok).alias("units_ok"),
        F.count_if(F.col("quality_status") == "REJECTED").alias("units_rejected"),
        F.sum(F.when(ok, F.col("clean_net_weight_g")).otherwise(0.0)).alias("net_g"),
        F.sum("active_workers").alias("workers_sum"))


def _window_figures(g: DataFrame) -> DataFrame:
    g = g.withColumn("window_start", F.col("w.start")).withColumn("_end", F.col("w.end"))
    hours = times.seconds_between(F.col("_end"), F.col("window_start")) / 3600
    return g.withColumns(_figures(hours)).select(
        "mqtt_topic", "linea", "window_start", "units", "units_ok", "units_rejected", *_figures(hours))


def _window(time: str, window: str, slide: str | None) -> Column:
    return (F.window(time, window, slide) if slide else F.window(time, window)).alias("w")


def kpi_window(df: DataFrame, window: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Figures per line and time window (tumbling, or sliding when ``slide`` is given)."""
    return _window_figures(_sums(df, _window("timestamp", window, slide), "mqtt_topic", "linea"))


def minute_parts(df: DataFrame) -> DataFrame:
    """Sums per line and minute that can be added up: parts of a feed to its whole, minutes to windows and shifts."""
    minute = F.date_trunc("minute", "timestamp").alias("minute")
    return _sums(df, minute, "mqtt_topic", "linea").withColumn("utc_date", F.to_date("minute"))


def add_parts(parts: DataFrame, *keys) -> DataFrame:
    """One row of sums per key."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in PARTS])


def merge_parts(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The sums of two parts of a feed."""
    return add_parts(stored.unionByName(new), "minute", "mqtt_topic", "linea", "utc_date")


def window_of_parts(parts: DataFrame, window: str = "1 minute", slide: str | None = None) -> DataFrame:
    """:func:`kpi_window` from sums per minute, for windows of whole minutes."""
    return _window_figures(add_parts(parts, _window("minute", window, slide), "mqtt_topic", "linea"))


def shift_of_parts(parts: DataFrame, zone: str = S.FACTORY_ZONE, shift_hours: float = 8.0) -> DataFrame:
    """:func:`kpi_shift` from sums per minute: shifts and dates change at whole minutes."""
    day, shift = times.local_date(F.col("minute"), zone), times.shift_label(F.col("minute"), zone)
    return _shift_figures(add_parts(parts, day.alias("local_date"), shift.alias("shift"), "mqtt_topic", "linea"), shift_hours)


def kpi_batch(batches: DataFrame) -> DataFrame:
    """Figures per production batch over its span (at least one minute)."""
    g = batches.withColumn("units", F.col("packages"))
    span = F.greatest(times.seconds_between(F.col("end_time"), F.col("start_time")), F.lit(60.0))
    hours = span / 3600
    return g.withColumns(_figures(hours)).select(
        "mqtt_topic", "linea", "article", "batch_instance_id", "start_time", "end_time", "units", "units_ok",
        "units_rejected", *_figures(hours))


def kpi_shift(df: DataFrame, zone: str = S.FACTORY_ZONE, shift_hours: float = 8.0) -> DataFrame:
    """Figures per local date, shift and line, per nominal shift length."""
    day = times.local_date(F.col("timestamp"), zone)
    return _shift_figures(_sums(df, day.alias("local_date"), "shift", "mqtt_topic", "linea"), shift_hours)


def _shift_figures(g: DataFrame, shift_hours: float) -> DataFrame:
    hours = F.lit(shift_hours)
    return g.withColumns(_figures(hours)).select(
        "mqtt_topic", "linea", "local_date", "shift", "units", "units_ok", "units_rejected", *_figures(hours))
