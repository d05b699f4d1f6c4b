"""Live stop check with timers in the state store.

One state per (topic, line): its last record, and the record after which a silence was last reported.  A new record sets
one timer, at the moment the silence after it would be reported; when the timer expires and no newer record has come, the
silence is reported.  So a tick works on lines that are due and lines with news, however many lines and reports there are,
and a restart finds timers and reports in the checkpoint: each silence is reported once.

The input is the stream of batch versions that :func:`weighline.streaming.stream.run_stream` writes, read from its
``batches`` table; a version written again by a replay has the same last record and changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from weighline import settings as S
from weighline.functions import text as tx, times
from weighline.operators import batches as ba
from weighline.sinks import tables as tb

_SECOND = 1_000_000
_LAST = "us bigint, lag double, article string, batch_instance_id string, start_us bigint"
_NAMES = [f.split()[0] for f in _LAST.split(", ")]
OUT = "mqtt_topic string, linea string, us bigint, article string, batch_instance_id string, start_us bigint, now_us bigint"
NEWEST = "mqtt_topic string, linea string, article string, batch_instance_id string, start_time timestamp, end_time timestamp, last_lag struct<us: bigint, seconds: double>"


def _local(us: int, zone: ZoneInfo) -> dt.datetime:
    return dt.datetime.fromtimestamp(us // _SECOND, zone).replace(microsecond=us % _SECOND)


def _of_day(t: dt.datetime) -> float:
    return t.hour * 3600 + t.minute * 60 + t.second + t.microsecond / _SECOND


def fire_us(last_us: int, zone: ZoneInfo, threshold: int = S.STOP_THRESHOLD_SECONDS) -> int:
    """When the silence after a record is reported: ten minutes after it, at shift start at the earliest."""
    start = _local(last_us, zone).replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(seconds=S.SHIFT_START)
    return max(last_us + threshold * _SECOND, int(start.timestamp()) * _SECOND)


def watched(last_us: int, at_us: int, zone: ZoneInfo) -> bool:
    """Whether a report at ``at_us`` falls into watched time (same local day, before lunch or the end of the shift)."""
    last, at = _local(last_us, zone), _local(at_us, zone)
    return last.date() == at.date() and _of_day(at) < (S.LUNCH_START if _of_day(last) < S.AFTERNOON_START else S.SHIFT_END)


class SilenceWatch(StatefulProcessor):
    """``behind``: seconds by which the feed's clock is behind the wall clock (to watch a recorded feed; 0 in production)."""

    def __init__(self, zone: str, max_lag: int, behind: float = 0.0):
        self.zone, self.max_lag, self.behind = ZoneInfo(zone), max_lag, int(behind * _SECOND)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _LAST)
        self.told = handle.getValueState("told", "us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        best = max(new[_NAMES].itertuples(index=False, name=None), key=lambda r: (r[0], r[4]))
        if not self.last.exists() or best[0] >= int(self.last.get()[0]):
            us = int(best[0])
            self.last.update((us, float(best[1]), best[2], best[3], int(best[4])))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if best[1] <= self.max_lag and watched(us, fire_us(us, self.zone), self.zone):
                # a timer is due when the clock has passed its millisecond
                self.handle.registerTimer((fire_us(us, self.zone) + self.behind) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        us, _, article, batch, start = self.last.get()
        now = timerValues.getCurrentProcessingTimeInMs() * 1000 - self.behind
        told = int(self.told.get()[0]) if self.told.exists() else None
        if told != us and now > fire_us(us, self.zone) and watched(us, now, self.zone):
            self.told.update((us,))
            yield pd.DataFrame({"mqtt_topic": [key[0]], "linea": [key[1]], "us": [us], "article": [article],
                                "batch_instance_id": [batch], "start_us": [start], "now_us": [now]})

    def close(self) -> None:
        pass


def silences(versions: DataFrame, zone: str = S.FACTORY_ZONE, max_lag: int = S.LAG_THRESHOLD_SECONDS, behind: float = 0.0) -> DataFrame:
    """The silences to report (:data:`OUT`) from a stream of batch versions (:data:`NEWEST`)."""
    rows = versions.select(*ba.LINE, times.micros(F.col("end_time")).alias("us"), F.coalesce("last_lag.seconds", F.lit(0.0)).alias("lag"),
                           "article", "batch_instance_id", times.micros(F.col("start_time")).alias("start_us"))
    return rows.groupBy(*ba.LINE).transformWithStateInPandas(
        SilenceWatch(zone, max_lag, behind), outputStructType=OUT, outputMode="Update", timeMode="ProcessingTime")


def stop_alerts(found: DataFrame) -> DataFrame:
    """The alerts of :func:`silences`."""
    gap = (F.col("now_us") - F.col("us")) / F.lit(float(_SECOND))
    return found.select(
        "mqtt_topic", tx.virtual_topic(F.col("mqtt_topic"), F.col("linea")).alias("topic"), F.lit(S.STOP_TYPE).alias("alert_type"),
        F.col("article").alias("product"), F.col("linea").alias("origin_line"), F.lit(S.STOP_LINE_TEXT).alias("current_line"), "batch_instance_id",
        F.timestamp_micros("start_us").alias("prev_start"), F.timestamp_micros("us").alias("prev_end"), F.timestamp_micros("now_us").alias("curr_start"),
        gap.alias("gap_seconds"), tx.stop_message(F.col("linea"), F.col("article"), gap).alias("message"))


def run_watch(spark: SparkSession, root: str, checkpoint: str, seconds: int = S.WATCHDOG_SECONDS, **options) -> StreamingQuery:
    """Watch the lines whose batches lie under ``root``; alerts go to ``root/live_stops``.  Needs the RocksDB state store."""
    versions = spark.readStream.schema(NEWEST).option("recursiveFileLookup", True).parquet(f"{root}/batches")

    def save(found: DataFrame, epoch: int) -> None:
        tb.write_table(stop_alerts(found), f"{root}/live_stops", epoch)

    writer = silences(versions, **options).writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=f"{seconds} seconds").start()
