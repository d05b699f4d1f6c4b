"""The stream: micro-batches with carried state, and the live stop check.

State is a handful of small tables per epoch under ``root/state/epoch=N``.  Epoch N reads the tables of N-1, so a
replay after a lost executor or a restart computes and overwrites the same result.  The state is written last,
then the commit row of the epoch.  The work on a micro-batch is the same distributed plan as in batch mode, so a busy topic is
spread over tasks instead of being held by one stateful task.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from weighline import settings as S
from weighline.functions import text as tx, times
from weighline.operators import batches as ba, kpis as kp, stops as st
from weighline.plans.pipeline import Lookups, State, process, together, write_reports, write_result
from weighline.session import intermediates, remove
from weighline.sinks import snapshot as sn, tables as tb
from weighline.sources import raw as rw

#: Epochs whose state is kept, for replays and restarts.
KEPT_EPOCHS = 10
#: Folder of a state that came from a snapshot; the first epoch begins with it.
IMPORTED = "imported"
STATE_TABLES = ("open_batches", "counters", "history", "closed", "watermark")


def write_state(state: State, root: str, epoch: int) -> None:
    def save(name: str) -> None:
        getattr(state, name).write.mode("overwrite").parquet(f"{root}/state/epoch={epoch}/{name}")

    together(*[lambda n=n: save(n) for n in STATE_TABLES])
    spark = state.watermark.sparkSession
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/epoch={epoch}")
    remove(f"{root}/state/epoch={epoch - KEPT_EPOCHS}")


def read_state(spark: SparkSession, root: str, epoch: int) -> State | None:
    if epoch < 0:
        try:
            return State(*[spark.read.parquet(f"{root}/state/{IMPORTED}/{name}") for name in STATE_TABLES])
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
    return State(*[spark.read.parquet(f"{root}/state/epoch={epoch}/{name}") for name in STATE_TABLES])


def last_epoch(spark: SparkSession, root: str) -> int | None:
    """Newest committed epoch: its commit row is written after its state."""
    try:
        return spark.read.parquet(f"{root}/commits").agg(F.max("epoch")).first()[0]
    except AnalysisException:
        return None


def handler(root: str, lookups: Callable[[SparkSession], Lookups], archive_format: str = "csv",
            **options) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function.  ``lookups`` is called once per epoch, so edited files take effect with the next one."""

    def run(raw: DataFrame, epoch: int) -> None:
        spark = raw.sparkSession
        started = time.monotonic()
        with intermediates(spark):
            state = read_state(spark, root, epoch - 1)
            if options.get("failing") is not None:  # what failed in the epoch before comes first
                raw = waiting(spark, root, epoch - 1).unionByName(raw.select(*rw.RAW_SCHEMA.names))
            result = process(raw, pinned(spark, root, epoch, lookups), state, more_follows=True, **options)
            write_result(result, root, epoch=epoch, archive_format=archive_format)
            write_reports(result, root, epoch, time.monotonic() - started)
            write_state(result.state, root, epoch)

    return run


def pinned(spark: SparkSession, root: str, epoch: int, lookups: Callable[[SparkSession], Lookups]) -> Lookups:
    """The lookups of an epoch: those its first run read, which a replay finds stored.

    The mark that the copy is whole is written last; copies of epochs that can no longer run again are deleted.
    """
    names, folder = [f.name for f in fields(Lookups)], f"{root}/lookups_used/epoch={epoch}"
    try:
        spark.read.schema("id long").parquet(f"{folder}/whole")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        read = lookups(spark)
        together(*[lambda n=n: getattr(read, n).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{n}") for n in names])
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/whole")
        remove(f"{root}/lookups_used/epoch={epoch - KEPT_EPOCHS}")
    return Lookups(*[spark.read.parquet(f"{folder}/{n}") for n in names])


def waiting(spark: SparkSession, root: str, epoch: int) -> DataFrame:
    """Messages that failed in ``epoch``, to be given in again by the next one and by a replay of it alike."""
    empty = spark.createDataFrame([], rw.RAW_SCHEMA)
    try:
        return empty if epoch < 0 else spark.read.schema(rw.RAW_SCHEMA).parquet(f"{root}/retry/epoch={epoch}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty


def run_stream(raw_stream: DataFrame, root: str, checkpoint: str, lookups: Callable[[SparkSession], Lookups],
               available_now: bool = False, seconds: int = S.MICRO_BATCH_SECONDS, **options) -> StreamingQuery:
    """Start the stream.  Input per micro-batch is bounded by the source's own limit; nothing is dropped."""
    writer = (raw_stream.writeStream.foreachBatch(handler(root, lookups, **options))
              .option("checkpointLocation", checkpoint))
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table's rows of committed epochs, with ``epoch``: an epoch that is being written, or died, is not seen."""
    last = last_epoch(spark, root)
    return spark.read.parquet(f"{root}/{table}").where(F.col("epoch") <= (-1 if last is None else last))


def current_batches(spark: SparkSession, root: str) -> DataFrame:
    """Newest version of every batch that committed epochs have written."""
    rows = committed(spark, root, "batches")
    key = ["mqtt_topic", "article", "batch_sequence"]
    rest = [c for c in rows.columns if c not in (*key, "epoch")]
    return (rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "epoch").alias("b")).select(*key, "b.*"))


def read_hot(spark: SparkSession, root: str, day=None) -> DataFrame:
    """The hot table, or one UTC day of it, after the newest committed epoch."""
    return tb.read_hot(spark, f"{root}/hot", day, last_epoch(spark, root))


def kpi_window(spark: SparkSession, root: str, window: str = "1 minute", slide: str | None = None, day=None) -> DataFrame:
    """Figures per line and window of what committed epochs hold; ``day`` (UTC) opens that day alone."""
    return kp.window_of_parts(tb.read_kpi_parts(spark, f"{root}/kpi_parts", last_epoch(spark, root), day), window, slide)


def kpi_shift(spark: SparkSession, root: str, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Figures per local date, shift and line of what committed epochs hold."""
    return kp.shift_of_parts(tb.read_kpi_parts(spark, f"{root}/kpi_parts", last_epoch(spark, root)), zone)


def kpi_batch(spark: SparkSession, root: str) -> DataFrame:
    """Figures per production batch of what committed epochs hold."""
    return kp.kpi_batch(current_batches(spark, root))


# --- snapshot of the state --------------------------------------------------------------------------------------

def export_state(spark: SparkSession, root: str, folder: str, epoch: int | None = None) -> int:
    """Write the state after ``epoch`` (the newest committed one) as JSON lines; returns the epoch."""
    epoch = last_epoch(spark, root) if epoch is None else epoch
    state = read_state(spark, root, epoch)
    if state is None:
        raise ValueError(f"{root} has no committed epoch")
    together(*[lambda n=n: sn.write(getattr(state, n), f"{folder}/{n}") for n in STATE_TABLES])
    return epoch


def import_state(spark: SparkSession, folder: str, root: str) -> None:
    """Let a new stream under ``root`` begin with a snapshot: its first epoch reads this state."""
    state = State(*[sn.read(spark, f"{folder}/{n}") for n in STATE_TABLES])
    together(*[lambda n=n: getattr(state, n).write.mode("overwrite").parquet(f"{root}/state/{IMPORTED}/{n}") for n in STATE_TABLES])


# --- live stop check --------------------------------------------------------------------------------------------

def silent_lines(open_batches: DataFrame, now, zone: str = S.FACTORY_ZONE,
                 max_lag: int = S.LAG_THRESHOLD_SECONDS) -> DataFrame:
    """Lines whose silence should be reported at ``now``."""
    now_us, last = times.micros(now), times.micros(F.col("end_time"))
    fire = st.fire_time(last, zone)
    lag = st.last_lag_seconds(F.col("last_lag")) if "last_lag" in open_batches.columns else F.lit(0.0)
    due = (fire < now_us) & st.in_watch(last, fire, zone) & st.in_watch(last, now_us, zone) & (lag <= max_lag)
    gap = (now_us - last) / F.lit(1_000_000.0)
    return open_batches.where(due).select(
        "mqtt_topic", tx.virtual_topic(F.col("mqtt_topic"), F.col("linea")).alias("topic"),
        F.lit(S.STOP_TYPE).alias("alert_type"), F.col("article").alias("product"),
        F.col("linea").alias("origin_line"), F.lit(S.STOP_LINE_TEXT).alias("current_line"), "batch_instance_id",
        F.col("start_time").alias("prev_start"), F.col("end_time").alias("prev_end"), now.alias("curr_start"),
        gap.alias("gap_seconds"), tx.stop_message(F.col("linea"), F.col("article"), gap).alias("message"))


def watchdog_tick(spark: SparkSession, root: str, now, tick: int, zone: str = S.FACTORY_ZONE) -> int:
    """One live check: report silences that were not reported before (one report per silence).  Returns how many."""
    epoch = last_epoch(spark, root)
    if epoch is None:
        return 0
    due = silent_lines(read_state(spark, root, epoch).open_batches, now, zone)
    path = f"{root}/live_stops"
    earlier = _read_earlier(spark, path, tick)
    if earlier is not None:
        due = due.join(earlier.select("topic", "prev_end"), ["topic", "prev_end"], "left_anti")
    tb.write_table(due, path, tick)
    return spark.read.parquet(f"{path}/epoch={tick}").count()


def _read_earlier(spark: SparkSession, path: str, tick: int) -> DataFrame | None:
    try:
        # A replayed tick must not see its own earlier output.
        return spark.read.parquet(path).where(F.col("epoch") < tick)
    except AnalysisException:
        return None


def run_watchdog(spark: SparkSession, root: str, checkpoint: str, seconds: int = S.WATCHDOG_SECONDS) -> StreamingQuery:
    """Run :func:`watchdog_tick` every ``seconds``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def check(_: DataFrame, tick: int) -> None:
        now = spark.sql("SELECT current_timestamp()").first()[0]
        watchdog_tick(spark, root, F.lit(now), tick)

    return (ticks.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
            .trigger(processingTime=f"{seconds} seconds").start())
