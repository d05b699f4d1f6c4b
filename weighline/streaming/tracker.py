"""Production batches from a stream in any order: state per line, repaired by late records.

:class:`LineTracker` keeps, per (topic, line) in the state store, the records of recent slices and the article runs of
recent days.  New records are added to their slices only; a slice they touch is cut into runs again, and the runs of its
day are joined into batches.  It emits the batches of that day that are new or different, numbered by their place in the
day, and the places that are gone.  So a late record changes just what it changes: it extends a batch, splits it, or adds
one, and what came out before is replaced.  Records of days that are no longer kept are emitted as late.

:func:`handler` puts those into tables by day (:mod:`weighline.sinks.days`), numbers the batches from the first touched
day on, continuing the counts of the days before, and finds the returns of those days.  Rows that changed are listed with
``op`` ``new`` or ``retract``.  For records in order that day is the current one.  A crowded topic is spread over tasks by
line; per-topic work sees batches, not records.

After the same records, in any order and cut into any micro-batches, the batches are those of a batch run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from weighline import settings as S
from weighline.functions import times
from weighline.operators import batches as ba, returns as rt, slices as sl
from weighline.session import intermediates, materialize
from weighline.sinks import tables as tb
from weighline.sinks.days import DayTable
from weighline.streaming.stream import last_epoch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = times.DAY_MICROS
_NUMBERS = ["net_g", "units_ok", "units_rejected", "workers_sum"]
_RECORD = "us array<bigint>, identity array<bigint>, article array<string>, net_g array<double>, units_ok array<bigint>, units_rejected array<bigint>, workers_sum array<bigint>, lag array<double>"
_RUN = "slice_us array<bigint>, article array<string>, first_us array<bigint>, last_us array<bigint>, packages array<bigint>, net_g array<double>, units_ok array<bigint>, units_rejected array<bigint>, workers_sum array<bigint>, lag array<double>"
_RECORD_NAMES, _RUN_NAMES = ([f.split()[0] for f in x.split(", ")] for x in (_RECORD, _RUN))
OUT = ("mqtt_topic string, linea string, op string, day int, n int, key_slice bigint, article string, start_us bigint, end_us bigint, "
       "reason_code int, packages bigint, net_g double, units_ok bigint, units_rejected bigint, workers_sum bigint, lag double, identity bigint")
_OUT_NAMES = [f.split()[0] for f in OUT.split(", ")]
MEASURES = {"packages": "sum", "net_g": "sum", "units_ok": "sum", "units_rejected": "sum", "workers_sum": "sum", "last_lag": "max"}
KEY = [*ba.LINE, "utc_date", "n"]


def records(df: DataFrame) -> DataFrame:
    """What the tracker needs of enriched weighings."""
    rows, _ = ba.prepare(df)
    return rows.select(*ba.LINE, "us", "identity", "article", "slice_us", *_NUMBERS, F.col("last_lag.seconds").alias("lag"))


def _lists(frame: pd.DataFrame, names: list[str]) -> tuple:
    return tuple(frame[c].tolist() for c in names)


def slice_runs(rows: pd.DataFrame) -> pd.DataFrame:
    """The article runs of one slice's records, in order."""
    rows = rows.sort_values(["us", "identity", "article"], kind="stable", ignore_index=True)
    starts = np.flatnonzero((rows["article"] != rows["article"].shift()).to_numpy())
    us = rows["us"].to_numpy()
    lasts = np.append(starts[1:], len(rows)) - 1
    # the lag of a run is that of its last moment; several records of one moment count with the greatest
    at_last = us == np.repeat(us[lasts], np.diff(np.append(starts, len(rows))))
    lag = np.maximum.reduceat(np.where(at_last, rows["lag"].to_numpy(), -np.inf), starts)
    out = {"slice_us": rows["slice_us"].iloc[0], "article": rows["article"].to_numpy()[starts], "first_us": us[starts], "last_us": us[lasts],
           "packages": np.diff(np.append(starts, len(rows)))}
    return pd.DataFrame(out | {c: np.add.reduceat(rows[c].to_numpy(), starts) for c in _NUMBERS} | {"lag": lag})


def day_batches(runs: pd.DataFrame, max_gap_seconds: int, zone: str) -> pd.DataFrame:
    """The batches of one line's day from its runs in order."""
    first, last = runs["first_us"], runs["last_us"]
    date = lambda us: pd.to_datetime(us, unit="us", utc=True).dt.tz_convert(zone).dt.date
    other = runs["article"] != runs["article"].shift()
    silent = (first - last.shift()) > max_gap_seconds * 1_000_000
    moved = pd.Series([False, *(a > b for a, b in zip(date(first)[1:], date(last)[:-1]))])
    code = np.where(other, ba._NEW, np.where(silent | moved, ba._TIMEOUT, 0))
    group = np.cumsum(code > 0)
    starts = np.flatnonzero(code > 0)
    lag = runs["lag"].to_numpy()
    end = last.groupby(group).transform("max")
    lag = pd.Series(np.where(last == end, lag, -np.inf)).groupby(group).max()
    out = runs.groupby(group).agg(key_slice=("slice_us", "first"), article=("article", "first"), start_us=("first_us", "min"),
                                  end_us=("last_us", "max"), packages=("packages", "sum"), **{c: (c, "sum") for c in _NUMBERS})
    return out.assign(reason_code=code[starts], lag=lag, n=np.arange(len(starts))).reset_index(drop=True)


class LineTracker(StatefulProcessor):
    """State of one line.  ``records``: rows of a slice.  ``days``: runs of a UTC day.  ``shown``: what was last emitted of a
    day.  ``floor``: the oldest day still kept."""

    def __init__(self, keep_days: int, max_gap_seconds: int, zone: str):
        self.keep_days, self.max_gap_seconds, self.zone = keep_days, max_gap_seconds, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.records = handle.getMapState("records", "slice_us bigint", _RECORD)
        self.days = handle.getMapState("days", "day int", _RUN)
        self.shown = handle.getMapState("shown", "day int", "mark array<string>")
        self.floor = handle.getValueState("floor", "day int")

    @staticmethod
    def _stored(state, key: int, names: list[str]) -> pd.DataFrame:
        found = state.getValue((key,)) if state.containsKey((key,)) else None
        return pd.DataFrame(dict(zip(names, found if found is not None else [[]] * len(names))))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        new["day"] = new["us"] // DAY
        floor = int(self.floor.get()[0]) if self.floor.exists() else None
        out = []
        if floor is not None:
            late = new[new["day"] < floor]
            if len(late):
                out.append(late.rename(columns={"us": "start_us", "slice_us": "key_slice"}).assign(op="late"))
            new = new[new["day"] >= floor]
        for day, of_day in new.groupby("day"):
            out.append(self._day(int(day), of_day))
        if len(new):
            self._forget(floor, int(new["day"].max()) - self.keep_days)
        for frame in out:
            frame = frame.assign(mqtt_topic=key[0], linea=key[1]).reindex(columns=_OUT_NAMES)
            if len(frame):
                yield frame

    def _day(self, day: int, new: pd.DataFrame) -> pd.DataFrame:
        runs = [self._stored(self.days, day, _RUN_NAMES)]
        runs[0] = runs[0][~runs[0]["slice_us"].isin(new["slice_us"])]
        for slice_us, part in new.groupby("slice_us"):
            held = self._stored(self.records, int(slice_us), _RECORD_NAMES)
            part = part[_RECORD_NAMES] if held.empty else pd.concat([held, part[_RECORD_NAMES]], ignore_index=True)
            self.records.updateValue((int(slice_us),), _lists(part, _RECORD_NAMES))
            runs.append(slice_runs(part.assign(slice_us=int(slice_us))))
        runs = pd.concat([r for r in runs if len(r)], ignore_index=True).sort_values("slice_us", kind="stable", ignore_index=True)
        self.days.updateValue((day,), _lists(runs, _RUN_NAMES))
        batches = day_batches(runs, self.max_gap_seconds, self.zone).assign(day=day, op="set")
        marks = [repr(r) for r in batches[[c for c in _OUT_NAMES[5:-1]]].itertuples(index=False, name=None)]
        before = list(self.shown.getValue((day,))[0]) if self.shown.containsKey((day,)) else []
        self.shown.updateValue((day,), (marks,))
        changed = batches[[n >= len(before) or m != before[n] for n, m in enumerate(marks)]]
        gone = pd.DataFrame({"n": range(len(marks), len(before)), "day": day, "op": "gone"})
        return pd.concat([changed, gone], ignore_index=True) if len(gone) else changed

    def _forget(self, floor: int | None, least: int) -> None:
        if floor is not None and least <= floor:
            return
        self.floor.update((least,))
        for state, day_of in ((self.days, lambda k: k), (self.shown, lambda k: k), (self.records, lambda k: k // DAY)):
            for (k,) in [k for k in state.keys() if day_of(k[0]) < least]:
                state.removeKey((k,))

    def close(self) -> None:
        pass


def track(rows: DataFrame, keep_days: int = 2, max_gap_seconds: int = S.MAX_GAP_SECONDS, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """The changes of line batches (:data:`OUT`) from a stream of :func:`records`."""
    return rows.groupBy(*ba.LINE).transformWithStateInPandas(
        LineTracker(keep_days, max_gap_seconds, zone), outputStructType=OUT, outputMode="Update", timeMode="None")


# --- tables ------------------------------------------------------------------------------------------------------------

_PLAIN = ("mqtt_topic string, linea string, n int, key_slice bigint, article string, start_us bigint, end_us bigint, reason_code int, packages bigint, "
          "net_g double, units_ok bigint, units_rejected bigint, workers_sum bigint, lag double")
_BATCH = ("mqtt_topic string, linea string, article string, batch_instance_id string, batch_sequence bigint, reason string, start_time timestamp, "
          "end_time timestamp, closed_at timestamp, recorded boolean, n int, packages bigint, net_g double, units_ok bigint, units_rejected bigint, "
          "workers_sum bigint, last_lag struct<us: bigint, seconds: double>")
_COUNT = "mqtt_topic string, article string, batches bigint"
_RETURN = ("mqtt_topic string, topic string, alert_type string, product string, origin_line string, current_line string, batch_instance_id string, "
           "prev_start timestamp, prev_end timestamp, curr_start timestamp, gap_seconds double, message string")


def tables(spark: SparkSession, root: str) -> dict[str, DayTable]:
    return {name: DayTable(spark, f"{root}/{name}", shape)
            for name, shape in (("line_batches", _PLAIN), ("counts", _COUNT), ("batches", _BATCH), ("returns", _RETURN))}


def _put(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Line batches after changes: places set or gone replace what was stored there."""
    kept = stored.join(changes.select(*KEY), KEY, "left_anti")
    return kept.unionByName(changes.where("op = 'set'").select(kept.columns))


def numbered(plain: DataFrame, before: DataFrame) -> DataFrame:
    """Line batches with numbers that go on from ``before`` (``mqtt_topic, article, last_sequence``)."""
    rows = plain.select(
        *ba.LINE, F.unix_date("utc_date").alias("day"), "key_slice", F.col("n").alias("key_run"), "article", "start_us", "end_us", "reason_code",
        F.lit(None).cast("bigint").alias("seed_sequence"), "packages", *_NUMBERS, F.struct(F.col("end_us").alias("us"), F.col("lag").alias("seconds")).alias("last_lag"))
    return ba.number(rows, before, S.SLICE_TARGET_ROWS, False).withColumn("n", F.col("key_run").cast("int"))


def handler(root: str, zone: str = S.FACTORY_ZONE, cap: int = S.HISTORY_CAP) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function for :func:`track`: tables under ``root``, then the epoch's commit row."""
    def run(out: DataFrame, epoch: int) -> None:
        spark = out.sparkSession
        at = tables(spark, root)
        with intermediates(spark):
            out = materialize(out, "tracked").withColumn("utc_date", F.date_from_unix_date("day"))
            tb.write_table(out.where("op = 'late'").select(*ba.LINE, F.timestamp_micros("start_us").alias("timestamp"), "identity", "article"), f"{root}/late", epoch)
            touched = at["line_batches"].merge(epoch, out.where("op <> 'late'"), _put)
            first = min(touched, default=None)
            after = lambda d: first is not None and d >= first
            days = sorted({d for name in ("line_batches", "batches") for d in at[name].versions(epoch - (name == "batches")) if after(d)})
            plain = at["line_batches"].read(epoch, after)
            at["counts"].replace(epoch, plain.groupBy("utc_date", "mqtt_topic", "article").agg(F.count(F.lit(1)).alias("batches")), days)
            counters = (at["counts"].read(epoch, lambda d: first is not None and d < first)
                        .groupBy("mqtt_topic", "article").agg(F.sum("batches").alias("last_sequence")))
            now = materialize(numbered(plain, counters), "numbered")
            at["batches"].replace(epoch, now.select(at["batches"].read(-1).columns), days)
            found = rt.find_returns(now, cap, zone).alerts.withColumn("utc_date", F.to_date("curr_start"))
            at["returns"].replace(epoch, found.select(at["returns"].read(-1).columns), days)
            old, new = at["batches"].read(epoch - 1, after), at["batches"].read(epoch, after)
            changes = old.exceptAll(new).withColumn("op", F.lit("retract")).unionByName(new.exceptAll(old).withColumn("op", F.lit("new")))
            tb.write_table(changes, f"{root}/changes", epoch)
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/epoch={epoch}")

    return run


def run_tracker(rows: DataFrame, root: str, checkpoint: str, available_now: bool = False, seconds: int = S.MICRO_BATCH_SECONDS,
                keep_days: int = 2, zone: str = S.FACTORY_ZONE) -> StreamingQuery:
    """Start the tracker on a stream of :func:`records`.  The session needs the RocksDB state store (:data:`ROCKSDB`)."""
    writer = (track(rows, keep_days, zone=zone).writeStream.outputMode("update").foreachBatch(handler(root, zone))
              .option("checkpointLocation", checkpoint))
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def batches(spark: SparkSession, root: str, epoch: int | None = None) -> DataFrame:
    """All batches after the newest committed epoch (or the given one), as a batch run gives them.

    The last batch of a line's day was closed by the line's next day with records, which may have come epochs later.
    """
    epoch = last_epoch(spark, root) if epoch is None else epoch
    rows = tables(spark, root)["batches"].read(-1 if epoch is None else epoch)
    lines = rows.groupBy(*ba.LINE, "utc_date").agg(F.min("start_time").alias("_first"))
    w = Window.partitionBy(*ba.LINE).orderBy("utc_date")  # one row per line and day
    nexts = lines.withColumn("_next", F.lead("_first").over(w)).drop("_first")
    return (rows.join(nexts, [*ba.LINE, "utc_date"]).withColumn("closed_at", F.coalesce("closed_at", "_next"))
            .select(*ba.PUBLIC, *MEASURES))


def found_returns(spark: SparkSession, root: str) -> DataFrame:
    epoch = last_epoch(spark, root)
    return tables(spark, root)["returns"].read(-1 if epoch is None else epoch).drop("utc_date")
