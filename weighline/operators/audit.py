"""Operational figures: throughput per topic and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weighline import settings as S


def throughput(raw: DataFrame, window: str = "1 minute") -> DataFrame:
    """Messages and bytes per topic and minute of arrival."""
    return (raw.groupBy("topic", F.window("received_at", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("payload")).alias("bytes"))
            .select("topic", F.col("w.start").alias("minute"), "messages", "bytes"))


def duration_histogram(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Cumulative duration buckets, count, sum and 95th percentile of ``seconds`` per ``keys``."""
    buckets = [F.count_if(F.col("seconds") <= b).alias("le_" + f"{b:g}".replace(".", "_")) for b in S.DURATION_BUCKETS]
    return runs.groupBy(*keys).agg(
        *buckets, F.count(F.lit(1)).alias("runs"), F.round(F.sum("seconds"), 4).alias("seconds_total"),
        F.percentile_approx("seconds", 0.95, 10_000).alias("p95_seconds"))


#: Size of a quantile sketch: ranks are off by less than one percent.
SKETCH_SIZE = 400


def duration_sketches(runs: DataFrame, keys: list[str], at: str, window: str = "1 minute") -> DataFrame:
    """A mergeable quantile sketch of ``seconds`` per ``keys`` and minute of ``at``: rows to keep, in place of the runs."""
    return (runs.groupBy(*keys, F.window(at, window)["start"].alias("minute"))
            .agg(F.kll_sketch_agg_double(F.col("seconds").cast("double"), F.lit(SKETCH_SIZE)).alias("sketch"), F.count("seconds").alias("runs")))


def sketched_quantile(sketches: DataFrame, keys: list[str], q: float = 0.95, out: str = "p95_seconds") -> DataFrame:
    """The quantile per ``keys`` of any set of sketches, merged."""
    return (sketches.where("runs > 0").groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_all"), F.sum("runs").alias("runs"))
            .select(*keys, "runs", F.kll_sketch_get_quantile_double("_all", F.lit(q)).alias(out)))


def backlog(arrived: DataFrame, processed: DataFrame) -> DataFrame:
    """Messages waiting per topic at the end of every minute in which one arrived or was processed.

    Both inputs are ``topic, at``.  Minutes are summed with map-side combination; the balance runs inside a topic's day and
    starts from the days before, of which there is one row per topic: no window holds a topic's whole history of minutes.
    """
    moves = (arrived.select("topic", "at", F.lit(1).alias("i"), F.lit(0).alias("o"))
             .unionByName(processed.select("topic", "at", F.lit(0).alias("i"), F.lit(1).alias("o"))).where("at IS NOT NULL"))
    minutes = (moves.groupBy("topic", F.date_trunc("minute", "at").alias("minute"))
               .agg(F.sum("i").alias("arrived"), F.sum("o").alias("processed")).withColumn("_day", F.to_date("minute")))
    net = F.col("arrived") - F.col("processed")
    days = minutes.groupBy("topic", "_day").agg(F.sum(net).alias("_net"))
    before = F.coalesce(F.sum("_net").over(Window.partitionBy("topic").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_day = Window.partitionBy("topic", "_day").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return (minutes.withColumn("_so_far", F.sum(net).over(in_day)).join(days.select("topic", "_day", before.alias("_before")), ["topic", "_day"])
            .select("topic", "minute", "arrived", "processed", (F.col("_before") + F.col("_so_far")).alias("waiting")))


def message_counts(audit: DataFrame) -> DataFrame:
    """Messages by topic and status from the run-audit table ``(topic, status, messages)``."""
    return audit.groupBy("topic", "status").agg(F.sum("messages").alias("messages"))


def error_counts(audit: DataFrame) -> DataFrame:
    """Errors by type and component from the run-audit table ``(error_type, component)``."""
    return (audit.where("error_type is not null").groupBy("error_type", "component")
            .agg(F.count(F.lit(1)).alias("errors")))
