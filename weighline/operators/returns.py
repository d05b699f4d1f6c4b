"""Returns: an article that starts again after one of its batches was closed on any line of the topic.

For a batch ``n`` opened by a new article, the report names the oldest closed batch ``p`` of the same topic, article and
UTC day that ended before ``n`` started and is still among the last ``cap`` batches closed.

Closed batches are numbered per topic-day in closing order, so "still among the last ``cap``" means a number not below
``c(n) - cap + 1``.  The oldest such batch of the article is the first one at or after that number.  Both sides go into
blocks of that numbering (closings are repeated in the block before when they can be reached from it), which keeps
every group small without pairing batches with each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from weighline import settings as S
from weighline.functions import text as tx, times
from weighline.operators import slices as sl
from weighline.session import materialize

BLOCK = 1000


def _numbered(batches: DataFrame) -> DataFrame:
    """Adds ``close_no`` (number of the closing this batch causes) and ``closed_before`` (closings up to its start)."""
    key = ["mqtt_topic", "day"]
    closes = F.when(F.col("prev.day") == F.col("day"), 1).otherwise(0)
    rows = batches.withColumn("_closes", closes)
    per_slice = rows.groupBy(*key, "bslice").agg(F.sum("_closes").alias("_n"))
    w = Window.partitionBy(*key).orderBy("bslice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select(*key, "bslice", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    strict = Window.partitionBy(*key, "bslice").orderBy("start_us", "linea", "key_slice", "key_run")
    peers = Window.partitionBy(*key, "bslice").orderBy("start_us")
    return (rows.withColumn("_strict", F.sum("_closes").over(strict.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_peers", F.sum("_closes").over(peers))
            .join(before, [*key, "bslice"])
            .withColumn("close_no", F.when(F.col("_closes") == 1, F.col("_strict") + F.col("_before")))
            .withColumn("closed_before", F.col("_peers") + F.col("_before")))


@dataclass(frozen=True)
class Returns:
    """``alerts``, the ``closings`` of this input, and ``closed_counts`` per topic and day including earlier ones."""

    alerts: DataFrame
    closings: DataFrame
    closed_counts: DataFrame


def detect_returns(batches: DataFrame, cap: int = S.HISTORY_CAP, zone: str = S.FACTORY_ZONE,
                   block: int = BLOCK) -> DataFrame:
    """Return alerts of numbered batches (``Segments.batches``)."""
    return find_returns(batches, cap, zone, block).alerts


def find_returns(batches: DataFrame, cap: int = S.HISTORY_CAP, zone: str = S.FACTORY_ZONE, block: int = BLOCK,
                 history: DataFrame | None = None, closed_so_far: DataFrame | None = None) -> Returns:
    """Return alerts with what the next input needs.

    ``history`` (earlier closings of the open days: :func:`closings`) and ``closed_so_far`` (their count per topic and
    day) continue an earlier call.
    """
    block = max(block, cap)
    batches = batches.select("mqtt_topic", "linea", "day", "article", "batch_instance_id", "reason", "start_us",
                             "key_slice", "key_run", "bslice", "prev",
                             F.col("seed_sequence").isNotNull().alias("is_old"))
    rows = _numbered(materialize(batches, "return-input"))
    if closed_so_far is not None:
        rows = (rows.join(closed_so_far.select("mqtt_topic", "day", "closed_count"), ["mqtt_topic", "day"], "left")
                .withColumn("close_no", F.col("close_no") + F.coalesce("closed_count", F.lit(0)))
                .withColumn("closed_before", F.col("closed_before") + F.coalesce("closed_count", F.lit(0)))
                .drop("closed_count"))
    rows = materialize(rows, "closings")

    lowest = F.greatest(F.col("closed_before") - cap + 1, F.lit(1)).cast("bigint")
    probes = rows.where("reason = 'new_article' and not is_old").select(
        "mqtt_topic", "day", "article", lowest.alias("pos"), F.lit(0).alias("kind"),
        "linea", "batch_instance_id", "start_us", F.lit(None).cast(CLOSING_TYPE).alias("closing"))
    closed = own = closings(rows)
    if history is not None:
        closed = closed.unionByName(history)
    homes = F.filter(F.array(F.floor(F.col("close_no") / block),
                             F.when(F.pmod("close_no", F.lit(block)) < cap, F.floor(F.col("close_no") / block) - 1)),
                     lambda b: b.isNotNull())
    stored = closed.select(
        "mqtt_topic", "day", "article", F.col("close_no").alias("pos"), F.lit(1).alias("kind"),
        F.lit(None).cast("string").alias("linea"), F.lit(None).cast("string").alias("batch_instance_id"),
        F.lit(None).cast("bigint").alias("start_us"),
        F.struct("start_us", "end_us", "closed_us", "linea", "close_no").cast(CLOSING_TYPE).alias("closing"),
        F.explode(homes).alias("block"))
    timeline = probes.withColumn("block", F.floor(F.col("pos") / block)).unionByName(stored)
    w = (Window.partitionBy("mqtt_topic", "day", "block", "article").orderBy(F.desc("pos"), F.desc("kind"))
         .rowsBetween(Window.unboundedPreceding, 0))
    # Ordered from high to low numbers: the last closing seen is the first one at or after the probe's position.
    nearest = F.last("closing", True).over(w)
    ended = F.last(F.when(F.col("closing.end_us") < F.col("closing.closed_us"), F.col("closing")), True).over(w)
    found = (timeline.withColumn("_any", nearest).withColumn("_ended", ended).where("kind = 0")
             .withColumn("p", F.when(F.col("_any.closed_us") < F.col("start_us"), F.col("_any"))
                         .when(F.col("_ended.closed_us") <= F.col("start_us"), F.col("_ended")))
             .where("p is not null"))
    gap = (F.col("start_us") - F.col("p.end_us")) / F.lit(1_000_000.0)
    alerts = found.select(
        "mqtt_topic", tx.virtual_topic(F.col("mqtt_topic"), F.col("linea")).alias("topic"),
        F.lit(S.RETURN_TYPE).alias("alert_type"), F.col("article").alias("product"),
        F.col("p.linea").alias("origin_line"), F.col("linea").alias("current_line"), "batch_instance_id",
        F.timestamp_micros("p.start_us").alias("prev_start"), F.timestamp_micros("p.end_us").alias("prev_end"),
        F.timestamp_micros("start_us").alias("curr_start"), gap.alias("gap_seconds"),
        tx.return_message(F.col("article"), F.col("p.linea"), F.timestamp_micros("p.end_us"), gap, zone)
        .alias("message"))
    counts = own.groupBy("mqtt_topic", "day").agg(F.max("close_no").alias("closed_count"))
    return Returns(alerts, own, counts)


CLOSING_TYPE = "struct<start_us: bigint, end_us: bigint, closed_us: bigint, linea: string, close_no: bigint>"


def closings(numbered: DataFrame) -> DataFrame:
    """Closed batches with their closing number."""
    return numbered.where("close_no is not null").select(
        "mqtt_topic", "day", F.col("prev.article").alias("article"), "linea", F.col("prev.start_us").alias("start_us"),
        F.col("prev.end_us").alias("end_us"), F.col("start_us").alias("closed_us"),
        F.col("close_no").cast("bigint").alias("close_no"))
