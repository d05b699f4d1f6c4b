"""Records already processed, by the counter each topic's devices send."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighline import settings as S
from weighline.operators.slices import sized


def is_new(identity: Column, last_identity: Column, rollover: int = S.ROLLOVER_THRESHOLD) -> Column:
    """Unknown topic, a higher counter, or one so far behind that the counter must have restarted."""
    return (last_identity.isNull() | (identity > last_identity) | (last_identity - identity > rollover))


def mark_new(df: DataFrame, watermark: DataFrame, rollover: int = S.ROLLOVER_THRESHOLD) -> DataFrame:
    """Add ``is_new``.  ``watermark`` has one row per topic (``mqtt_topic, last_identity``)."""
    known = watermark.select("mqtt_topic", F.col("last_identity").alias("_last"))
    return (df.join(sized(known, known.count()), "mqtt_topic", "left")
            .withColumn("is_new", is_new(F.col("identity"), F.col("_last"), rollover)).drop("_last"))


def dedup(df: DataFrame, watermark: DataFrame, rollover: int = S.ROLLOVER_THRESHOLD,
          within_batch: bool = False) -> DataFrame:
    """Drop records at or below the topic's watermark.  Repeats inside the same input are kept unless
    ``within_batch`` is set, which keeps one record per (topic, identity)."""
    out = mark_new(df, watermark, rollover).where("is_new").drop("is_new")
    return out.dropDuplicates(["mqtt_topic", "identity"]) if within_batch else out


def ingest_watermark(df: DataFrame, keys: tuple[str, ...] = ("mqtt_topic",)) -> DataFrame:
    """Per topic: counter, id and time of the latest record, and how many records there were.

    The latest record is the one with the highest (timestamp, identity), so the watermark follows a restarted counter.
    A record without a readable counter (identity 0) counts as the latest only where no other has one.
    """
    entry = F.struct("timestamp", "identity", F.coalesce("record_uuid", F.lit("unknown")).alias("record_uuid"))
    latest = F.coalesce(F.max(F.when(F.col("identity") > 0, entry)), F.max(entry))
    return (df.groupBy(*keys).agg(latest.alias("l"), F.count(F.lit(1)).alias("record_count"))
            .select(*keys, F.col("l.identity").alias("last_identity"), F.col("l.record_uuid").alias("last_uuid"),
                    F.col("l.timestamp").alias("last_timestamp"), "record_count"))


def merge_watermark(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per topic the later entry by (time, counter): late records never move a watermark back."""
    fields = ["last_timestamp", "last_identity", "last_uuid", "record_count"]
    return (old.select("mqtt_topic", *fields).unionByName(new.select("mqtt_topic", *fields)).groupBy("mqtt_topic")
            .agg(F.max(F.struct(*fields)).alias("l")).select("mqtt_topic", *[f"l.{f}" for f in fields]))


def ingest_summary(watermark: DataFrame) -> DataFrame:
    """Number of topics tracked and records in the last run."""
    return watermark.agg(F.count(F.lit(1)).alias("topics_tracked"), F.sum("record_count").alias("records"))
