"""Every operator as a query over the test tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weighline import settings as S
from weighline.functions import numbers, text as tx, times
from weighline.operators import (alerts as al, audit, batches as ba, clean as cl, dedup as dd, enrich as en, kpis,
                                 outputs as ou, reports as rp, returns as rt, stops as st)
from weighline.plans import pipeline as pl
from weighline.session import require_utc
from weighline.sinks import snapshot as sn
from weighline.sources import lookups as lk, raw, telemetry as tm

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        require_utc(spark)
        return plain(fn(spark, sf_dir))
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times and dates as text, so that engines compare alike."""
    kinds = {"timestamp": lambda c: F.col(c).cast("timestamp_ntz"), "date": lambda c: F.col(c).cast("string")}
    return df.select(*[kinds[t](c).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


# --- inputs -----------------------------------------------------------------------------------------------------

def articles(spark):
    return lk.dim_articles(spark, tm.ARTICLES)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighings with article name, headcount, target, business fields and arrival lag."""
    w = tm.weighings(spark, sf_dir)
    w = en.map_articles(w, articles(spark))
    w = cl.business_fields(w)
    w = en.enrich_workers(w, lk.dim_workers(spark, tm.WORKERS))
    return st.with_lag(w)


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what segmentation needs."""
    w = tm.weighings(spark, sf_dir).select("mqtt_topic", "linea", "timestamp", "identity", "article_number")
    return en.map_articles(w, articles(spark))


def segments(spark, sf_dir, **options) -> ba.Segments:
    return ba.segment(mapped(spark, sf_dir), **options)


def parsed(spark, sf_dir) -> DataFrame:
    return raw.parse(raw.subscribe(tm.raw_messages(spark, sf_dir)))


# --- ingest -----------------------------------------------------------------------------------------------------

@query
def ingest_parse(spark, sf_dir):
    """JSON objects and arrays to records in canonical columns."""
    return parsed(spark, sf_dir).select(
        "mqtt_topic", "linea", "identity", "article_name", "article_number", "net_weight",
        F.col("timestamp").alias("time_text"), "record_uuid", "reject_flag", "quality_status", "received_at")


@query
def topic_filter(spark, sf_dir):
    r = raw.subscribe(tm.raw_messages(spark, sf_dir))
    return r.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query
def dead_letters(spark, sf_dir):
    return raw.dead_letters(raw.subscribe(tm.raw_messages(spark, sf_dir)))


@query
def retry_split(spark, sf_dir):
    failed = raw.retry_split(tm.raw_messages(spark, sf_dir))
    return failed.select("event_id", "topic", "attempts", "action", "reason")


@query
def throughput_topic(spark, sf_dir):
    return audit.throughput(tm.raw_messages(spark, sf_dir)).select("topic", "minute", "messages")


@query
def backlog_topic(spark, sf_dir):
    """Every message is taken to be processed up to five minutes after it arrived, by its number; every 50th is not yet."""
    r = tm.raw_messages(spark, sf_dir).select("topic", "event_id", "received_at")
    done = F.timestamp_micros(F.unix_micros("received_at") + F.col("event_id") % 300 * 1_000_000)
    return audit.backlog(r.select("topic", F.col("received_at").alias("at")),
                         r.where("event_id % 50 <> 0").select("topic", done.alias("at")))


# --- cleaning ---------------------------------------------------------------------------------------------------

@query
def alias_coalesce(spark, sf_dir):
    """The value every record got for its aliased columns, chosen row by row."""
    return parsed(spark, sf_dir).select("mqtt_topic", "linea", "article_number", "identity", "net_weight", "record_uuid", "reject_flag",
                                        F.col("timestamp").alias("time_text"))


@query
def clean_weighings(spark, sf_dir):
    return cl.clean(parsed(spark, sf_dir)).select(
        "mqtt_topic", "linea", "identity", "timestamp", "net_weight", "article_name", "article_number",
        "record_uuid", "reject_flag")


@query
def clean_strict(spark, sf_dir):
    """The same without decimal commas: such weights are not numbers."""
    c = cl.typed(parsed(spark, sf_dir), decimal_comma=False)
    return c.select("mqtt_topic", "linea", "identity", "net_weight")


@query
def parse_hhmm(spark, sf_dir):
    """``HH:MM`` texts on the factory date of arrival, including impossible ones."""
    e = tm.events(spark, sf_dir)
    hour, minute = (F.col("event_id") * 7) % 26, (F.col("event_id") * 13) % 62
    text = F.concat(hour, F.lit(":"), F.lpad(minute.cast("string"), 2, "0"))
    return e.select("event_id", text.alias("clock"), times.parse_clock(text, F.col("ts")).alias("parsed"),
                    times.parse_timestamp(text, F.col("ts")).alias("resolved"))


@query
def jitter(spark, sf_dir):
    e = tm.events(spark, sf_dir)
    base = F.date_trunc("minute", "ts")
    ident = F.col("event_id") * 1_234_567
    return e.select("event_id", times.jitter(base, ident).alias("jittered"))


@query
def jitter_quality(spark, sf_dir):
    w = tm.weighings(spark, sf_dir)
    coarse = F.date_trunc("hour", "timestamp")
    w = w.withColumn("timestamp", F.when(F.col("identity") % 9 != 0,
                                         times.jitter(coarse, F.col("identity") % 40)))
    return cl.jitter_quality(w)


@query
def shift_label(spark, sf_dir):
    w = tm.weighings(spark, sf_dir)
    return w.select("identity", "linea", times.shift_label(F.col("timestamp")).alias("shift"))


@query
def display_time(spark, sf_dir):
    e = tm.events(spark, sf_dir).select("event_id", F.timestamp_micros(
        F.unix_micros("ts") + F.col("event_id") * 5_000_000_000).alias("timestamp"))
    return cl.to_display_zone(e).withColumnRenamed("timestamp", "local_time")


@query
def ts_fill(spark, sf_dir):
    """Synthetic times 10 ms apart, ending at the newest event."""
    e = tm.events(spark, sf_dir).select("event_id")
    return cl.synthetic_timestamps(e, F.lit("2024-02-01 00:00:00").cast("timestamp"), "event_id")


@query
def ts_invalid(spark, sf_dir):
    """Unreadable times replaced by a given instant."""
    e = tm.events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 4 == 0, F.lit("bad"))
                                        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"))
    return cl.fill_timestamps(e, F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query
def weight_text(spark, sf_dir):
    e = tm.events(spark, sf_dir)
    text = (F.when(F.col("event_id") % 4 == 0, F.concat(F.format_string("%.2f", "value"), F.lit(" kg")))
            .when(F.col("event_id") % 4 == 1, F.concat(F.replace(F.format_string("%.2f", "value"), F.lit("."),
                                                                 F.lit(",")), F.lit("KG")))
            .when(F.col("event_id") % 4 == 2, F.concat(F.lit("peso: 1 "), F.lpad((F.col("event_id") % 1000)
                                                                                  .cast("string"), 3, "0"),
                                                       F.lit(" g")))
            .otherwise(F.lit("sin peso")))
    return e.select("event_id", F.round(numbers.weight_text_grams(text), 4).alias("grams"))


@query
def business_fields(spark, sf_dir):
    w = tm.weighings(spark, sf_dir)
    w = (w.withColumn("tare_g", F.when(F.col("identity") % 3 == 0, 12.5))
         .withColumn("quality_status", F.when(F.col("identity") % 5 == 0, " warn "))
         .withColumn("active_workers", F.when(F.col("identity") % 4 == 0, F.col("identity") % 7)))
    return cl.business_fields(w).select("identity", F.round("clean_net_weight_g", 4).alias("clean_net_weight_g"),
                                        "tare_g", "quality_status", "shift", "active_workers")


# --- lookups ----------------------------------------------------------------------------------------------------

@query
def enrich_workers(spark, sf_dir):
    w = en.enrich_workers(tm.weighings(spark, sf_dir).withColumn("linea", F.concat(F.lit(" "), "linea", F.lit("\t"))),
                          lk.dim_workers(spark, tm.WORKERS))
    return w.select("identity", "active_workers")


@query
def enrich_targets(spark, sf_dir):
    w = en.enrich_targets(tm.weighings(spark, sf_dir), lk.dim_targets(spark, tm.TARGETS))
    return w.select("identity", "article_number", "article_name", "target_value")


@query
def target_for(spark, sf_dir):
    """Target text of every article code and name that occurs."""
    w = tm.weighings(spark, sf_dir)
    keys = w.select(F.col("article_number").alias("key")).unionByName(w.select(F.col("article_name").alias("key"))).distinct()
    return en.target_for(keys, lk.dim_targets(spark, tm.TARGETS), "key").select("key", "target")


@query
def flat_columns(spark, sf_dir):
    """Whole columns named as devices name them, some with ``values.`` in front, renamed to the canonical names."""
    w = tm.weighings(spark, sf_dir)
    sent = w.select(F.col("identity").alias("values.identity"), F.col("net_weight").alias("values.ActualNetWeightValue"), F.col("article_name").alias("Producto"),
                    F.col("article_number").alias("values.article_number"), F.lit("unused").alias("ItemCode"), "linea")
    return cl.rename_flat_columns(sent).select("identity", "net_weight", "article_name", "article_number", "ItemCode", "linea")


@query
def map_articles(spark, sf_dir):
    w = en.map_articles(tm.weighings(spark, sf_dir), articles(spark))
    return w.select("identity", "article_number", "number_refactor")


@query
def giveaway(spark, sf_dir):
    w = en.enrich_targets(cl.business_fields(tm.weighings(spark, sf_dir)), lk.dim_targets(spark, tm.TARGETS))
    return en.giveaway(w).select("identity", "target_weight_g", F.round("giveaway_g", 4).alias("giveaway_g"),
                                 "quality_mismatch")


def worker_updates(spark, sf_dir):
    """Headcount updates derived from events: who, how many, when."""
    e = tm.events(spark, sf_dir)
    i = F.col("event_id")
    return e.select(
        i.alias("event_id"), F.col("ts").alias("timestamp"),
        F.when(i % 10 == 0, F.lit("bad line!")).when(i % 10 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Linea_02"), F.lpad((F.col("user_id") % 40).cast("string"), 2, "0"))).alias("line_id"),
        F.when(i % 9 == 0, F.lit("many")).when(i % 9 == 1, F.lit("-3"))
        .otherwise((F.floor("value") % 120).cast("string")).alias("workers"))


@query
def worker_updates_valid(spark, sf_dir):
    return en.workers_updates(worker_updates(spark, sf_dir)).select("event_id", "line_id", "accepted", "reason",
                                                                     "new_worker_count")


@query
def workers_latest(spark, sf_dir):
    ok = en.workers_updates(worker_updates(spark, sf_dir)).where("accepted")
    return en.workers_latest(en.worker_log(ok))


@query
def enrich_workers_log(spark, sf_dir):
    """Headcount of records after the accepted changes of the log; updates are given to the lines of the records."""
    updates = worker_updates(spark, sf_dir).withColumn("line_id", F.regexp_replace("line_id", "^Linea_02", "Line_"))
    log = en.worker_log(en.workers_updates(updates).where("accepted"))
    workers = en.with_updates(lk.dim_workers(spark, tm.WORKERS), log)
    return en.enrich_workers(tm.weighings(spark, sf_dir), workers).select("identity", "linea", "active_workers")


# --- dedup ------------------------------------------------------------------------------------------------------

def past_watermark(w: DataFrame) -> DataFrame:
    """Watermark after the first part of the history (records before 2024-01-15)."""
    return dd.ingest_watermark(w.where(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp"))
                               .where("mqtt_topic = 'factory/zone_0'"))


@query
def ingest_watermark(spark, sf_dir):
    return dd.ingest_watermark(tm.weighings(spark, sf_dir))


@query
def dedup_identity(spark, sf_dir):
    w = tm.weighings(spark, sf_dir)
    return dd.dedup(w, past_watermark(w)).select("mqtt_topic", "linea", "identity", "timestamp")


@query
def rollover(spark, sf_dir):
    """Counters that restart every 4000 records, against a watermark of 3500 per topic."""
    w = tm.weighings(spark, sf_dir).withColumn("identity", F.col("identity") % 4000)
    mark = w.groupBy("mqtt_topic").agg(F.lit(3500).cast("bigint").alias("last_identity"))
    return dd.mark_new(w, mark).select("mqtt_topic", "linea", "timestamp", "identity", "is_new")


@query
def watermark_merge(spark, sf_dir):
    """A watermark of the first half, merged with one of late records (and, for one topic, of newer ones)."""
    w = tm.weighings(spark, sf_dir)
    at = lambda day: F.lit(day).cast("timestamp")
    later = (F.col("mqtt_topic") == "factory/zone_1") & (F.col("timestamp") >= at("2024-01-20"))
    return dd.merge_watermark(dd.ingest_watermark(w.where(F.col("timestamp") < at("2024-01-15"))),
                              dd.ingest_watermark(w.where((F.col("timestamp") < at("2024-01-10")) | later)))


@query
def requeue(spark, sf_dir):
    """The next input: every third message failed, the others wait."""
    r = tm.raw_messages(spark, sf_dir)
    failed = F.col("event_id") % 3 == 0
    return raw.requeue(r.where(failed), r.where(~failed)).select("event_id", "topic", "attempts", "retried")


@query
def dedup_within(spark, sf_dir):
    """Optional removal of repeats inside one input: devices that resend every third record."""
    w = tm.weighings(spark, sf_dir)
    again = w.unionByName(w.where("identity % 3 = 0"))
    none = dd.ingest_watermark(w.where("false"))
    return dd.dedup(again, none, within_batch=True).select("mqtt_topic", "linea", "identity", "timestamp")


# --- batches ----------------------------------------------------------------------------------------------------

@query
def batches(spark, sf_dir):
    """Production batches with weight, packages and rejects."""
    seg = ba.segment(enriched(spark, sf_dir).select("mqtt_topic", "linea", "timestamp", "identity", "number_refactor",
                                                    "clean_net_weight_g", "quality_status"))
    return seg.batches.select(*ba.PUBLIC, "packages", F.round(F.col("net_g") / 1000, 4).alias("kg"), "units_rejected")


@query
def batches_lineitem(spark, sf_dir):
    """Batches over a history of years: many short days per line."""
    seg = ba.segment(tm.lineitem_weighings(spark, sf_dir))
    return seg.batches.select("mqtt_topic", "linea", "article", "batch_sequence", "reason", "start_time", "end_time",
                              "closed_at", "recorded", "packages", "units_rejected")


@query
def article_changes(spark, sf_dir):
    return ba.article_changes(mapped(spark, sf_dir))


@query
def weighings_with_batch(spark, sf_dir):
    w = mapped(spark, sf_dir)
    return ba.with_batches(w, ba.segment(w)).select(
        "identity", "mqtt_topic", "linea", "timestamp", "batch_instance_id", "batch_sequence", "batch_start_time")


@query
def recent_batches(spark, sf_dir):
    b = segments(spark, sf_dir).batches
    return ba.recent_batches(b).select("mqtt_topic", "recency", "batch_instance_id", "linea", "start_time", "closed_at")


@query
def daily_report(spark, sf_dir):
    return rp.daily_report(segments(spark, sf_dir).batches)


@query
def daily_totals(spark, sf_dir):
    return rp.daily_totals(segments(spark, sf_dir).batches)


@query
def line_status(spark, sf_dir):
    return rp.line_status(segments(spark, sf_dir).batches)


@query
def article_counters(spark, sf_dir):
    return rp.article_counters(segments(spark, sf_dir).batches)


# --- alerts -----------------------------------------------------------------------------------------------------

@query
def return_alerts(spark, sf_dir):
    return rt.detect_returns(segments(spark, sf_dir).batches)


@query
def return_alerts_cap5(spark, sf_dir):
    """The same with a history of five closings, so that the cap takes effect."""
    return rt.detect_returns(segments(spark, sf_dir).batches, cap=5).select(
        "topic", "batch_instance_id", "origin_line", "prev_end", "curr_start")


@query
def stop_alerts(spark, sf_dir):
    return st.detect_stops(segments(spark, sf_dir))


def segments_with_lag(spark, sf_dir):
    w = st.with_lag(tm.weighings(spark, sf_dir).select("mqtt_topic", "linea", "timestamp", "identity",
                                                       "article_number", "server_time"))
    return ba.segment(en.map_articles(w, articles(spark)))


@query
def stops_with_lag(spark, sf_dir):
    """Stops, leaving out silences after a delivery that came more than 15 minutes late."""
    s = st.detect_stops(segments_with_lag(spark, sf_dir), max_lag=S.LAG_THRESHOLD_SECONDS)
    return s.select("topic", "product", "prev_end", "curr_start", "gap_seconds")


@query
def stops_now(spark, sf_dir):
    """Lines silent at 2024-01-17 11:40 UTC."""
    now = F.lit("2024-01-17 11:40:00").cast("timestamp")
    seg = ba.segment(mapped(spark, sf_dir).where(F.col("timestamp") <= now))
    return st.stops_now(seg, now)


@query
def connection_lag(spark, sf_dir):
    return st.connection_lag(st.with_lag(tm.weighings(spark, sf_dir)))


@query
def connection_lag_local_clock(spark, sf_dir):
    return st.connection_lag(st.with_lag(tm.weighings(spark, sf_dir), event_clock="local"))


@query
def all_alerts(spark, sf_dir):
    seg = segments(spark, sf_dir)
    return al.all_alerts(rt.detect_returns(seg.batches), st.detect_stops(seg)).select(
        "topic", "alert_type", "curr_start", "product", "origin_line", "prev_end", "batch_instance_id")


@query
def alert_text(spark, sf_dir):
    seg = segments(spark, sf_dir)
    return al.describe(st.detect_stops(seg)).select(
        "topic", "batch_instance_id", "prev_end", "subject", "origin_text", "current_text", "prev_start_text",
        "prev_end_text", "curr_start_text", "date_text", "gap_text", "message")


@query
def alert_routing(spark, sf_dir):
    stops = st.detect_stops(segments(spark, sf_dir))
    return al.route_alerts(stops, lk.dim_contacts(spark, tm.CONTACTS)).select(
        "topic", "prev_end", "recipient_name", "recipient_email", "subject")


# --- outputs ----------------------------------------------------------------------------------------------------

def with_everything(spark, sf_dir) -> DataFrame:
    w = en.enrich_targets(enriched(spark, sf_dir), lk.dim_targets(spark, tm.TARGETS))
    return ba.with_batches(w, ba.segment(w.select("mqtt_topic", "linea", "timestamp", "identity", "number_refactor")))


@query
def hot_rows(spark, sf_dir):
    """All columns of the hot table."""
    h = ou.hot_rows(with_everything(spark, sf_dir))
    return h.withColumn("clean_net_weight_g", F.round("clean_net_weight_g", 4))


@query
def hot_upsert(spark, sf_dir):
    """Records resent with another weight and counter: the highest identity of a key stays."""
    w = cl.business_fields(en.map_articles(tm.weighings(spark, sf_dir), articles(spark)))
    hour = w.withColumn("timestamp", F.date_trunc("hour", "timestamp")).withColumn("record_uuid", F.lit("u"))
    keep = ou.last_write_wins(ou.hot_rows(hour))
    return keep.select("mqtt_topic", "linea", "timestamp", "article_number", "article_name", "batch_code",
                       "quality_status", "shift", "identity", "net_weight")


@query
def hot_merge(spark, sf_dir):
    """Writing records with odd counters over a hot table that holds those with even ones, some under the same keys."""
    w = cl.business_fields(en.map_articles(tm.weighings(spark, sf_dir), articles(spark)))
    h = ou.hot_rows(w.withColumn("timestamp", F.date_trunc("hour", "timestamp")))
    cut = F.col("identity") % 2 == 0
    merged = ou.upsert(ou.last_write_wins(h.where(cut)), h.where(~cut))
    return merged.select("mqtt_topic", "linea", "timestamp", "article_number", "article_name", "batch_code", "quality_status",
                         "identity", "net_weight")


def cold_raw(spark, sf_dir):
    return tm.weighings(spark, sf_dir).select(
        "mqtt_topic", "linea", "identity", "timestamp", "article_number", "article_name", "net_weight", "batch_code",
        F.when(F.col("identity") % 10 != 0, F.col("record_uuid")).alias("record_uuid"))


def cold_inputs(spark, sf_dir):
    raw_rows = cold_raw(spark, sf_dir)
    done = with_everything(spark, sf_dir).where("identity % 4 <> 0").withColumn(
        "record_uuid", F.when(F.col("identity") % 10 != 0, F.col("record_uuid")))
    return raw_rows, done


@query
def cold_rows(spark, sf_dir):
    raw_rows, done = cold_inputs(spark, sf_dir)
    return ou.cold_rows(raw_rows, done, articles(spark)).select(
        "identity", "timestamp", "processed_status", F.round("calculated_net_weight", 4).alias("calculated_net_weight"),
        "tare_g", "batch_instance_id", "batch_sequence", "batch_start_time", "number_refactor")


@query
def cold_semi(spark, sf_dir):
    raw_rows = cold_raw(spark, sf_dir)
    kept = raw_rows.where("identity % 4 <> 0")
    return ou.cold_semi(raw_rows, kept).select("mqtt_topic", "identity", "record_uuid")


@query
def pipeline_archive(spark, sf_dir):
    """Raw JSON through the whole chain to archive rows: the record as sent beside what was found out."""
    lookups = pl.Lookups.read(spark, tm.WORKERS, tm.TARGETS, tm.ARTICLES, tm.CONTACTS)
    rows = ou.archive_rows(pl.process(tm.raw_messages(spark, sf_dir), lookups).weighings)
    return rows.select("mqtt_topic", "linea", "identity", "record_uuid", "net_weight", "timestamp_text", "quality_status", "reject_flag",
                       "article_name", "article_number", "timestamp", "processed_status",
                       F.round("calculated_net_weight", 4).alias("calculated_net_weight"), "tare_g", "active_workers",
                       "batch_instance_id", "batch_sequence", "batch_start_time", "number_refactor")


@query
def state_roundtrip(spark, sf_dir):
    """Rows written as JSON lines and read back, over both changes of the clock."""
    e = tm.events(spark, sf_dir)
    at = F.timestamp_micros(F.unix_micros("ts") + F.col("event_id") * F.lit(5_000_000_000))
    rows = e.select("event_id", at.alias("moment"), F.struct("event_type", F.when(F.col("event_id") % 3 != 0, at).alias("seen")).alias("state"))
    lines = sn.encode(rows)
    back = lines.select("line", F.from_json("line", "event_id bigint").getField("event_id").alias("_id")).join(
        sn.decode(lines, rows.schema).withColumnRenamed("event_id", "_back"), F.col("_id") == F.col("_back"))
    return back.select(F.col("_id").alias("event_id"), "line", "moment", F.col("state.event_type").alias("event_type"), F.col("state.seen").alias("seen"))


@query
def cold_paths(spark, sf_dir):
    w = mapped(spark, sf_dir)
    return ou.cold_paths(ba.with_batches(w, ba.segment(w))).select("identity", "folder")


@query
def archive_manifest(spark, sf_dir):
    w = cl.business_fields(en.map_articles(tm.weighings(spark, sf_dir), articles(spark)))
    return ou.archive_manifest(w)


@query
def write_summary(spark, sf_dir):
    w = with_everything(spark, sf_dir)
    lines = w.unionByName(w.where("batch_sequence <= 1").withColumn("mqtt_topic", F.lit("factory/first")))
    return ou.write_summary(ou.hot_rows(lines))


# --- figures ----------------------------------------------------------------------------------------------------

@query
def kpi_minute(spark, sf_dir):
    return kpis.kpi_window(enriched(spark, sf_dir), "1 minute")


@query
def kpi_sliding(spark, sf_dir):
    return kpis.kpi_window(enriched(spark, sf_dir), "2 hours", "1 hour")


@query
def kpi_parts(spark, sf_dir):
    """Half-hours from sums per minute that two parts of the feed, interleaved, were added up to."""
    w = enriched(spark, sf_dir)
    halves = [kpis.minute_parts(w.where(F.col("identity") % 2 == n)) for n in range(2)]
    return kpis.window_of_parts(kpis.merge_parts(*halves), "30 minutes")


@query
def kpi_shift_parts(spark, sf_dir):
    """Shifts from sums per minute."""
    return kpis.shift_of_parts(kpis.minute_parts(enriched(spark, sf_dir)))


@query
def kpi_batch(spark, sf_dir):
    seg = ba.segment(enriched(spark, sf_dir).select("mqtt_topic", "linea", "timestamp", "identity", "number_refactor",
                                                    "clean_net_weight_g", "quality_status", "active_workers"))
    return kpis.kpi_batch(seg.batches)


@query
def kpi_shift(spark, sf_dir):
    return kpis.kpi_shift(enriched(spark, sf_dir))


@query
def ops_metrics(spark, sf_dir):
    """Duration histogram over runs derived from events (``value`` read as tenths of a second)."""
    runs = tm.events(spark, sf_dir).select(F.col("event_type").alias("status"), (F.col("value") / 10).alias("seconds"))
    return audit.duration_histogram(runs, ["status"])


@query
def ops_errors(spark, sf_dir):
    """Rejected inputs by reason, as errors of the component that found them."""
    r = raw.subscribe(tm.raw_messages(spark, sf_dir))
    bad = raw.dead_letters(r).select(F.col("reason").alias("error_type"), F.lit("parser").alias("component"))
    late = cl.rejected(raw.parse(r)).select(F.col("reason").alias("error_type"),
                                                           F.lit("cleaner").alias("component"))
    return audit.error_counts(bad.unionByName(late))
