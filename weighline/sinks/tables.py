"""Sinks: partitioned archive, hot table, dead letters, daily reports.

Every writer takes an optional ``epoch``.  With it, rows go to the folder of that epoch and replace what an earlier
attempt of the same epoch left there, so replaying a micro-batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weighline import settings as S
from weighline.operators import kpis as kp, outputs as ou, reports as rp
from weighline.sinks.days import DayTable, replace_by

ARCHIVE_KEYS = ["p_topic", "p_line", "p_year", "p_month", "p_day", "p_article", "p_batch"]


def _target(path: str, epoch: int | None) -> str:
    return path if epoch is None else f"{path}/epoch={epoch}"


def _write(df: DataFrame, path: str, fmt: str, partition_by: list[str], epoch: int | None) -> None:
    writer = df.write.format(fmt).mode("append" if epoch is None else "overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(_target(path, epoch))


def write_archive(df: DataFrame, path: str, fmt: str = "csv", zone: str = S.FACTORY_ZONE,
                  epoch: int | None = None) -> None:
    """Cold archive, one folder per (topic, line, date, article, batch).

    Rows are rebalanced by folder before writing: small folders share a task, a folder with a large share of the rows
    is split over several.
    """
    placed = ou.cold_paths(df, zone).drop("folder")
    _write(placed.hint("rebalance", *ARCHIVE_KEYS), path, fmt, ARCHIVE_KEYS, epoch)


def write_hot(hot: DataFrame, path: str, epoch: int | None = None) -> None:
    """Put hot rows into the table by UTC day: a key written again takes the new row (see :mod:`weighline.sinks.days`).

    Only the days of these rows are rewritten, and a day holds one row per (tags, timestamp).  Without ``epoch`` the rows
    become the next one.
    """
    rows = ou.last_write_wins(hot).withColumn("utc_date", F.to_date("timestamp"))
    table = DayTable(hot.sparkSession, path, hot.schema)
    table.merge(table.newest() + 1 if epoch is None else epoch, rows, replace_by([*ou.hot_tags(hot.columns), "timestamp"]))


def read_hot(spark: SparkSession, path: str, day=None, epoch: int | None = None) -> DataFrame:
    """The hot table with one row per (tags, timestamp), or one UTC day of it: that day's folder alone is opened.

    ``epoch``: as it was after that epoch (:func:`weighline.streaming.stream.read_hot` gives the newest committed one).
    """
    table = DayTable(spark, path)
    return table.read(table.newest() if epoch is None else epoch, lambda d: day is None or d == day).drop("utc_date")


def write_kpi_parts(records: DataFrame, path: str, epoch: int | None = None) -> None:
    """Add the records' sums per line and minute to the table by UTC day.

    Only the days of these records are opened; an epoch that is run again adds to what the epoch before it left, so nothing
    is counted twice, and a record may be late by any time.
    """
    table = DayTable(records.sparkSession, path, kp.PARTS_SCHEMA)
    table.merge(table.newest() + 1 if epoch is None else epoch, kp.minute_parts(records), kp.merge_parts)


def read_kpi_parts(spark: SparkSession, path: str, epoch: int | None = None, day=None) -> DataFrame:
    """Sums per line and minute after ``epoch`` (the newest if None), of one UTC day or of all."""
    table = DayTable(spark, path, kp.PARTS_SCHEMA)
    return table.read(table.newest() if epoch is None else epoch, lambda d: day is None or d == day)


def write_dead_letters(letters: DataFrame, path: str, epoch: int | None = None) -> None:
    _write(letters, path, "json", ["reason"], epoch)


def write_daily_report(batches: DataFrame, path: str, zone: str = S.FACTORY_ZONE, epoch: int | None = None) -> None:
    """Report entries as JSON lines under ``topic/year/month/date``, and the headers beside them."""
    entries = (rp.daily_report(batches, zone).drop("path")
               .withColumn("p_topic", F.replace("topic", F.lit("/"), F.lit("_")))
               .withColumn("p_year", F.date_format("date", "yyyy")).withColumn("p_month", F.date_format("date", "MM"))
               .withColumn("p_date", F.date_format("date", "yyyy-MM-dd")))
    keys = ["p_topic", "p_year", "p_month", "p_date"]
    _write(entries.hint("rebalance", *keys), f"{path}/productions", "json", keys, epoch)
    _write(rp.daily_totals(batches, zone), f"{path}/totals", "json", [], epoch)


def write_table(df: DataFrame, path: str, epoch: int | None = None, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    _write(df, path, fmt, partition_by or [], epoch)
