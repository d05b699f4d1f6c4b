"""Daily production report and current line status."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighline import settings as S
from weighline.functions import text as tx, times
from weighline.operators import slices as sl


def daily_report(batches: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Completed productions, one row each, numbered per (topic, date) in closing order.

    A topic-day may complete any number of productions, so the report stays a table: ``position`` orders it, and
    :func:`daily_totals` holds the header (``total_changes``, ``last_update``).  Only batches closed on their own UTC
    day are listed.
    """
    done = batches.where("recorded")
    us = times.micros(F.col("closed_at"))
    rows = done.withColumn("slice_us", sl.slice_of(us)).withColumn("_day", sl.day_of(us))
    ranked = sl.running_rank(rows, ["mqtt_topic", "_day"], ["closed_at", "linea", "start_time", "batch_sequence",
                                                            "article"], "position")
    return ranked.select(
        F.col("mqtt_topic").alias("topic"), F.col("utc_date").alias("date"), "position", "article",
        F.col("linea").alias("device"), F.col("batch_instance_id").alias("batch_id"), "batch_sequence", "reason",
        times.local_text(F.col("start_time"), zone=zone).alias("start_time"),
        times.local_text(F.col("end_time"), zone=zone).alias("end_time"),
        report_path(F.col("mqtt_topic"), F.col("utc_date")).alias("path"))


def report_path(topic, date):
    return F.concat(F.lit("packaging/daily_production/"), tx.topic_folder(topic), F.lit("/"),
                    F.date_format(date, "yyyy/MM"), F.lit("/report_"), F.date_format(date, "yyyy-MM-dd"),
                    F.lit(".json"))


def daily_totals(batches: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Header of the daily report: changes completed and the last record of the topic-day."""
    return (batches.groupBy(F.col("mqtt_topic").alias("topic"), F.col("utc_date").alias("date"))
            .agg(F.count_if(F.col("recorded")).alias("total_changes"), F.max("end_time").alias("_last"),
                 F.count(F.lit(1)).alias("batches_started"))
            .withColumn("last_update", times.local_text(F.col("_last"), zone=zone)).drop("_last"))


def line_status(batches: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Current batch of every line."""
    newest = F.struct("start_time", "batch_sequence", "article", "batch_instance_id", "end_time", "reason", "utc_date")
    return (batches.groupBy("mqtt_topic", "linea").agg(F.max(newest).alias("b"), F.count(F.lit(1)).alias("batches"))
            .select("mqtt_topic", "linea", tx.virtual_topic(F.col("mqtt_topic"), F.col("linea")).alias("topic"),
                    F.col("b.article").alias("article"), F.col("b.batch_instance_id").alias("batch_instance_id"),
                    F.col("b.batch_sequence").alias("batch_sequence"), F.col("b.reason").alias("reason"),
                    F.col("b.start_time").alias("start_time"), F.col("b.end_time").alias("last_seen"),
                    times.local_text(F.col("b.end_time"), zone=zone).alias("last_seen_local"), "batches"))


def article_counters(batches: DataFrame) -> DataFrame:
    """Highest batch number per (topic, article)."""
    return batches.groupBy("mqtt_topic", "article").agg(F.max("batch_sequence").alias("last_sequence"))
