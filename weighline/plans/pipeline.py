"""The whole chain from raw messages to tables, for one input of any size.

Batch jobs call :func:`process` once; the stream calls it per micro-batch with the state of the previous one.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weighline import settings as S
from weighline.operators import (alerts as al, batches as ba, clean as cl, dedup as dd, enrich as en, kpis as kp,
                                 outputs as ou, reports as rp, returns as rt, stops as st)
from weighline.session import intermediates, materialize
from weighline.sinks import tables as tb
from weighline.sources import lookups as lk, raw as rw


@dataclass(frozen=True)
class Lookups:
    """Lookup tables (see :mod:`weighline.sources.lookups`)."""

    workers: DataFrame
    targets: DataFrame
    articles: DataFrame
    contacts: DataFrame

    @staticmethod
    def read(spark: SparkSession, workers, targets, articles, contacts) -> "Lookups":
        """From JSON files or dictionaries."""
        return Lookups(lk.dim_workers(spark, workers), lk.dim_targets(spark, targets),
                       lk.dim_articles(spark, articles), lk.dim_contacts(spark, contacts))

    @staticmethod
    def kept(spark: SparkSession, folder: str, workers, targets, articles, contacts) -> "Lookups":
        """The same, but a missing or unreadable file gives its last good copy, which is stored under ``folder``."""
        return Lookups(*[lk.keep_good(spark, reader, source, f"{folder}/{name}") for reader, source, name in (
            (lk.dim_workers, workers, "workers"), (lk.dim_targets, targets, "targets"),
            (lk.dim_articles, articles, "articles"), (lk.dim_contacts, contacts, "contacts"))])


@dataclass(frozen=True)
class State:
    """What one input hands to the next: a few small tables.

    ``open_batches``: newest batch of every line.  ``counters``: last number per (topic, article).  ``history``: last
    closings of recent topic-days.  ``closed``: closings so far per topic-day.  ``watermark``: last identity per topic.
    """

    open_batches: DataFrame
    counters: DataFrame
    history: DataFrame
    closed: DataFrame
    watermark: DataFrame


@dataclass(frozen=True)
class Result:
    dead_letters: DataFrame
    retry: DataFrame
    rejected: DataFrame
    late: DataFrame
    weighings: DataFrame
    batches: DataFrame
    returns: DataFrame
    stops: DataFrame
    routed: DataFrame
    state: State


def enrich(df: DataFrame, lookups: Lookups, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Business fields and lookups on clean records."""
    out = cl.business_fields(df, zone)
    out = en.enrich_workers(out, lookups.workers)
    out = en.giveaway(en.enrich_targets(out, lookups.targets))
    return st.with_lag(en.map_articles(out, lookups.articles, found_col="article_known"), zone=zone)


def process(raw: DataFrame, lookups: Lookups, state: State | None = None, topic_pattern: str = S.TOPIC_FILTER,
            zone: str = S.FACTORY_ZONE, cap: int = S.HISTORY_CAP, max_lag: int = S.LAG_THRESHOLD_SECONDS,
            target: int = S.SLICE_TARGET_ROWS, more_follows: bool = False, failing: Column | None = None) -> Result:
    """Parse, clean, drop known records, enrich, cut into batches, find returns and stops.

    ``more_follows``: the input is one part of a longer feed, so the silence after a line's newest record is still open
    and is reported by the part that ends it.
    """
    # The raw source is read and parsed once: records, rejected records and dead letters all come from this table, which
    # also feeds segmentation, the joins back and both outputs.
    # The record as it was sent travels along as a struct, for the archive.
    kept = ("raw", "topic", "data", "dead_reason")
    parsed = rw.parse_all(rw.subscribe(raw, topic_pattern)).withColumns(
        {"raw": F.struct(*rw.SENT), "attempts": F.coalesce("attempts", F.lit(0))})
    if failing is not None:
        parsed = parsed.withColumn("message", F.xxhash64("topic", "data", "received_at", "attempts"))
        kept += ("message", "attempts")
    typed = cl.typed(parsed, zone=zone, keep=kept)
    typed = dd.mark_new(typed, state.watermark) if state is not None else typed.withColumn("is_new", F.lit(True))
    alive = F.col("dead_reason").isNull()
    letters, retry = None, raw.where("false").select(*rw.RAW_SCHEMA.names)
    enriched = enrich(typed, lookups, zone)
    if failing is None:
        # the text of what was not read
        everything = materialize(enriched.withColumn("data", F.when(~alive | ~cl.is_valid(), F.col("data"))), "records")
    else:
        enriched = enriched.withColumn("is_new", F.col("is_new") | (F.col("attempts") > 0))
        fails = alive & cl.is_valid() & F.col("is_new") & F.coalesce(failing, F.lit(False))
        enriched = enriched.withColumn("fails", F.coalesce(fails, F.lit(False)))
        everything = materialize(enriched.withColumn("data", F.when(~alive | ~cl.is_valid() | F.col("fails"), F.col("data"))), "records")
        held, everything, letters = hold_back(everything)
        retry = held
    rejected = (everything.where(alive & ~cl.is_valid()).withColumn("reason", cl.rejection())
                .withColumns({"net_weight_text": F.col("raw.net_weight"), "timestamp_text": F.col("raw.timestamp")}))
    rows = everything.where(alive & cl.is_valid() & F.col("is_new")).drop("topic", "data", "dead_reason", "is_new")

    if state is None:
        on_time, late = rows, rows.where("false")
    else:
        on_time, late = ba.split_late(rows, state.open_batches.withColumnRenamed("end_time", "last_time"))

    seg = ba.segment(on_time.select("mqtt_topic", "linea", "timestamp", "identity", "number_refactor",
                                    "clean_net_weight_g", "quality_status", "active_workers", "lag_seconds"),
                     zone=zone, target=target, open_batches=state and state.open_batches,
                     counters=state and state.counters)
    batches = materialize(seg.batches, "numbered")
    seg = ba.Segments(seg.fragments, batches, seg.slicing, seg.measures)
    found = rt.find_returns(batches, cap, zone, history=state and state.history,
                            closed_so_far=state and state.closed)
    stops = st.detect_stops(seg, zone, max_lag, closed_only=more_follows)
    both = materialize(al.all_alerts(found.alerts, stops), "alerts")
    is_return = F.col("alert_type") == S.RETURN_TYPE
    with_ids = materialize(ba.with_batches(on_time, seg), "weighings")  # archive, hot table, reports and figures read it
    return Result(
        dead_letters=rw.letters_of(everything) if letters is None else rw.letters_of(everything).unionByName(letters), retry=retry, rejected=rejected.drop("topic", "dead_reason", "is_new"),
        late=late, weighings=with_ids, batches=batches.select(*ba.PUBLIC, *seg.measures), returns=both.where(is_return),
        stops=both.where(~is_return), routed=al.route_alerts(both, lookups.contacts),
        state=next_state(batches, seg.measures, found, rows, state, cap))


def hold_back(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages to give in again, the rows of all other messages, and dead letters of messages that failed too often.

    Messages with a failing record are few; the joins on their key are left to the optimizer's sizes.
    """
    failed = materialize(rows.where("fails").groupBy("message").agg(
        F.first("topic").alias("topic"), F.max("data").alias("payload"), F.first("received_at").alias("received_at"), F.max("attempts").alias("attempts")), "failed")
    split = rw.retry_split(failed)
    letters = (split.where("action = 'dead_letter'")
               .select(F.col("received_at").alias("timestamp"), "topic", "reason", F.col("payload").alias("data")))
    others = rows.join(failed.select("message"), "message", "left_anti").drop("message", "attempts", "fails")
    return split.where("action = 'retry'").select(*rw.RAW_SCHEMA.names), others, letters


def next_state(batches: DataFrame, measures: dict[str, str], found: rt.Returns, rows: DataFrame,
               state: State | None, cap: int) -> State:
    newest = (batches.where("closed_us is null")
              .select(*ba.LINE, "article", "start_time", "end_time", "reason", "batch_sequence", "batch_instance_id",
                      *measures))
    counters = rp.article_counters(batches)
    watermark = dd.ingest_watermark(rows)  # late rows are older than what the state holds and cannot win below
    closed, history = found.closed_counts, found.closings
    if state is not None:
        kept = state.counters.join(counters.select("mqtt_topic", "article"), ["mqtt_topic", "article"], "left_anti")
        counters = counters.unionByName(kept)
        watermark = dd.merge_watermark(state.watermark, watermark)
        history = history.unionByName(state.history)
        closed = (closed.unionByName(state.closed).groupBy("mqtt_topic", "day")
                  .agg(F.max("closed_count").alias("closed_count")))
    # Only the last ``cap`` closings of the newest two days of a topic can still matter.
    last_day = closed.groupBy("mqtt_topic").agg(F.max("day").alias("_last"))
    recent = lambda df: (df.join(last_day, "mqtt_topic").where(F.col("day") >= F.col("_last") - 1)
                         .drop("_last"))
    w = Window.partitionBy("mqtt_topic", "day").orderBy(F.desc("close_no"))
    history = (recent(history).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cap).drop("_r"))
    return State(newest, counters, history, recent(closed), watermark)


def write_result(result: Result, root: str, zone: str = S.FACTORY_ZONE, epoch: int | None = None,
                 archive_format: str = "csv") -> None:
    """All outputs: archive first, then the hot table, so that a failed archive write leaves the hot table alone.

    The side tables do not depend on that order and are written at the same time.
    """
    cold = result.weighings.unionByName(result.late, allowMissingColumns=True)

    def both_stores() -> None:
        tb.write_archive(ou.archive_rows(cold), f"{root}/archive", archive_format, zone, epoch)
        tb.write_hot(ou.hot_rows(cold), f"{root}/hot", epoch)

    side = {"rejected": result.rejected, "batches": result.batches, "late": result.late, "returns": result.returns,
            "stops": result.stops, "routed_alerts": result.routed, "retry": result.retry}
    together(both_stores, lambda: tb.write_kpi_parts(cold, f"{root}/kpi_parts", epoch), lambda: tb.write_dead_letters(result.dead_letters, f"{root}/dead_letters", epoch),
             *[lambda n=n, d=d: tb.write_table(d, f"{root}/{n}", epoch) for n, d in side.items()])


def together(*jobs: Callable[[], None], threads: int = 4) -> None:
    """Submit independent Spark jobs at the same time; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(threads) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def audit(result: Result, seconds: float) -> DataFrame:
    """Messages by topic and status, with the component and error of those that were not processed."""
    def counted(df: DataFrame, topic: str, status: str, error: str | None, component: str) -> DataFrame:
        kind = F.col(error) if error else F.lit(None).cast("string")
        return (df.groupBy(F.col(topic).alias("topic"), kind.alias("error_type")).agg(F.count(F.lit(1)).alias("messages"))
                .withColumn("status", F.lit(status)).withColumn("component", F.lit(component)))

    return (counted(result.weighings, "mqtt_topic", "ok", None, "pipeline")
            .unionByName(counted(result.late, "mqtt_topic", "late", None, "pipeline"))
            .unionByName(counted(result.rejected, "mqtt_topic", "rejected", "reason", "cleaner"))
            .unionByName(counted(result.dead_letters, "topic", "dead_letter", "reason", "parser"))
            .withColumn("seconds", F.lit(seconds)))


def write_reports(result: Result, root: str, epoch: int, seconds: float, zone: str = S.FACTORY_ZONE) -> None:
    """Daily report of the batches that closed in this run, the archive's manifest, and the run's audit."""
    closed = result.batches.where("recorded")
    archived = ou.archive_rows(result.weighings.unionByName(result.late, allowMissingColumns=True))
    together(lambda: tb.write_daily_report(closed, f"{root}/daily_production", zone, epoch),
             lambda: tb.write_table(ou.archive_manifest(archived), f"{root}/archive_manifest", epoch),
             lambda: tb.write_table(audit(result, seconds), f"{root}/audit", epoch))


def run_batch(raw: DataFrame, lookups: Lookups, root: str, run: int = 0, **options) -> None:
    """Process everything at once and write all tables under ``root``.

    Every table goes to the folder of ``run`` and replaces what an earlier attempt of that run left, so a repeated job
    changes nothing; different inputs under one root need different runs.  Intermediate tables are deleted at the end.
    """
    started = time.monotonic()
    with intermediates(raw.sparkSession):
        result = process(raw, lookups, **options)
        write_result(result, root, epoch=run)
        write_reports(result, root, run, time.monotonic() - started)
        done = result.weighings
        together(lambda: tb.write_table(kp.kpi_window(done, "1 minute"), f"{root}/kpi_minute", run),
                 lambda: tb.write_table(kp.kpi_shift(done), f"{root}/kpi_shift", run),
                 lambda: tb.write_table(kp.kpi_batch(result.batches), f"{root}/kpi_batch", run))
