"""Stream equals batch, replay, and the live stop check."""

import os

import pytest
from pyspark.sql import functions as F

from weighline.operators import kpis as kp
from weighline.plans import pipeline as pl
from weighline.sources import raw as rw, telemetry as tm
from weighline.streaming import stream as sm

SF = os.environ.get("WEIGHLINE_TESTDATA", "/root/testdata") + "/sf0.001"


def lookups(spark):
    return pl.Lookups.read(spark, tm.WORKERS, tm.TARGETS, tm.ARTICLES, tm.CONTACTS)


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Messages in time order, in three files, all readable so that the counter order is the time order."""
    folder = tmp_path_factory.mktemp("feed")
    w = tm.weighings(spark, SF)
    text = F.to_json(F.struct(
        "identity", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "net_weight",
        "article_name", "article_number", "linea", "record_uuid", F.col("reject_flag").alias("Reject"),
        F.date_format("server_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("CreationDateUtc")))
    raw = w.select(F.col("mqtt_topic").alias("topic"), text.alias("payload"), F.col("timestamp").alias("received_at"),
                   F.lit(0).alias("attempts"), "identity")
    cuts = [0, 300, 310, 640, 10 ** 9]
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = raw.where((F.col("identity") >= lo) & (F.col("identity") < hi)).drop("identity")
        rows = [r.asDict() for r in part.collect()]
        path = folder / f"part-{n}.json"
        with open(path, "w") as out:
            for r in rows:
                r["received_at"] = r["received_at"].strftime("%Y-%m-%dT%H:%M:%S.%fZ")
                out.write(__import__("json").dumps(r) + "\n")
        os.utime(path, (1_700_000_000 + n * 100, 1_700_000_000 + n * 100))
    return str(folder)


@pytest.fixture(scope="module")
def streamed(spark, feed, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    raw = rw.stream_raw(spark, feed, max_files=1)
    q = sm.run_stream(raw, root, root + "/checkpoint", lookups, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    print([p["durationMs"].get("addBatch") for p in q.recentProgress])
    return root


@pytest.fixture(scope="module")
def at_once(spark, feed):
    return pl.process(rw.load_raw(spark, feed), lookups(spark))


def same(a, b, cols):
    x, y = a.select(*cols), b.select(*cols)
    assert x.count() == y.count()
    assert x.exceptAll(y).count() == 0


def test_batches_equal(spark, streamed, at_once):
    assert sm.last_epoch(spark, streamed) == 3
    cols = ["mqtt_topic", "linea", "article", "batch_instance_id", "batch_sequence", "reason", "start_time", "end_time",
            "packages", "units_rejected", F.round("net_g", 2)]
    same(sm.current_batches(spark, streamed), at_once.batches, cols)


def test_returns_equal(spark, streamed, at_once):
    cols = ["topic", "product", "origin_line", "batch_instance_id", "prev_start", "prev_end", "curr_start"]
    same(spark.read.parquet(streamed + "/returns"), at_once.returns, cols)
    assert at_once.returns.count() > 10


def test_stops_equal_except_open_ones(spark, streamed, at_once):
    cols = ["topic", "product", "batch_instance_id", "prev_start", "prev_end", "curr_start", "gap_seconds"]
    got, want = spark.read.parquet(streamed + "/stops").select(*cols), at_once.stops.select(*cols)
    assert got.count() > 50
    assert got.exceptAll(want).count() == 0
    newest = at_once.weighings.groupBy(F.concat_ws("/", "mqtt_topic", "linea").alias("topic")).agg(
        F.max("timestamp").alias("prev_end"))
    left = want.exceptAll(got)
    assert left.join(newest, ["topic", "prev_end"], "left_anti").count() == 0


def test_rows_and_hot_table(spark, streamed, at_once):
    hot = sm.read_hot(spark, streamed)
    assert hot.count() == at_once.weighings.count() == 1000
    same(hot, at_once.weighings, ["identity", "batch_instance_id", "batch_sequence"])
    assert spark.read.option("header", True).csv(streamed + "/archive").count() == 1000


def test_hot_table_by_day(spark, streamed, at_once):
    """A day is read from one folder, whichever epochs wrote it; an epoch that is not committed is not seen."""
    from weighline.sinks import tables as tb
    day = at_once.weighings.select(F.to_date("timestamp").alias("d"), "identity").where("identity = 305").first().d
    one = sm.read_hot(spark, streamed, day)
    same(one, at_once.weighings.where(F.to_date("timestamp") == F.lit(day)), ["identity", "batch_instance_id"])
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1
    before = sm.read_hot(spark, streamed).count()
    tb.write_hot(one.limit(1).withColumn("timestamp", F.expr("timestamp + interval 1 microsecond")), streamed + "/hot", 4)
    assert sm.read_hot(spark, streamed).count() == before


def test_failed_messages_come_again(spark, tmp_path):
    """A record without a target fails: its whole message comes first in the next epochs and ends as a dead letter, or is
    processed once when the lookup is mended; a replay changes nothing."""
    root, day = str(tmp_path / "r"), "2024-01-02T10:%02d:00Z"
    text = lambda *rs: "[" + ",".join('{"identity": %d, "timestamp": "%s", "net_weight": 100, "article_number": "%s", "linea": "L"}' % (i, day % i, a) for i, a in rs) + "]"
    raw = lambda *payloads: spark.createDataFrame([("factory/a", p, None, 0) for p in payloads], rw.RAW_SCHEMA)
    known = {"A": "Apple"}
    now = lambda s: pl.Lookups.read(s, tm.WORKERS, tm.TARGETS, {"default": "unmapped", "mappings": known}, tm.CONTACTS)
    run = sm.handler(root, now, failing=F.col("article_number").isin("B", "C") & ~F.col("number_refactor").isin("Berry"))
    done = lambda: sorted(r.identity for r in sm.read_hot(spark, root).collect())
    queue = lambda e: sorted((r.payload[:15], r.attempts) for r in sm.waiting(spark, root, e).collect())
    run(raw(text((1, "A")), text((2, "A"), (3, "B")), text((4, "C")), "{bad"), 0)
    assert done() == [1] and [a for _, a in queue(0)] == [1, 1]
    for _ in range(2):
        run(raw(text((5, "A"))), 1)
        assert done() == [1, 5] and [a for _, a in queue(1)] == [2, 2]
    known["B"] = "Berry"
    for _ in range(2):
        run(raw(text((6, "A"))), 2)
        assert done() == [1, 2, 3, 5, 6] and queue(2) == []
    dead = spark.read.json(root + "/dead_letters").collect()
    assert sorted((r.reason, r.epoch) for r in dead) == [("json_decode_error", 0), ("max_retries_exceeded", 2)]
    assert [r.data for r in dead if r.epoch == 2] == [text((4, "C"))]
    run(raw(text((7, "A"))), 3)
    assert done() == [1, 2, 3, 5, 6, 7] and queue(3) == []


def test_replayed_epoch_changes_nothing(spark, streamed, feed):
    before = sorted(map(str, sm.current_batches(spark, streamed).collect()))
    marks = sorted(map(str, sm.read_state(spark, streamed, 3).watermark.collect()))
    part = rw.load_raw(spark, feed + "/part-3.json")
    sm.handler(streamed, lookups)(part, 3)
    assert sorted(map(str, sm.current_batches(spark, streamed).collect())) == before
    assert sorted(map(str, sm.read_state(spark, streamed, 3).watermark.collect())) == marks
    # A resent file is known to the watermark, so nothing new comes out.
    again = pl.process(part, lookups(spark), sm.read_state(spark, streamed, 3), more_follows=True)
    assert again.weighings.count() == 0 and again.returns.count() == 0 and again.stops.count() == 0


def test_late_rows_go_aside(spark, streamed):
    state = sm.read_state(spark, streamed, 3)
    newest = state.open_batches.orderBy("mqtt_topic", "linea").first()
    text = ('{"identity": 99999999, "timestamp": "2024-01-02T00:00:00Z", "net_weight": 1, "article_number": "A-100", '
            f'"linea": "{newest.linea}"}}')
    raw = spark.createDataFrame([(newest.mqtt_topic, text, newest.end_time, 0)], rw.RAW_SCHEMA)
    r = pl.process(raw, lookups(spark), state)
    assert r.late.count() == 1 and r.weighings.count() == 0


def test_watchdog_reports_each_silence_once(spark, streamed):
    ends = sm.read_state(spark, streamed, 3).open_batches
    day = ends.agg(F.date_format(F.max("end_time"), "yyyy-MM-dd").alias("d")).first().d
    now = F.lit(day + " 17:50:00").cast("timestamp")
    want = sm.silent_lines(ends, now).count()
    first = sm.watchdog_tick(spark, streamed, now, 0)
    assert first == want
    assert sm.watchdog_tick(spark, streamed, F.lit(day + " 17:55:00").cast("timestamp"), 1) + first >= want
    assert spark.read.parquet(streamed + "/live_stops").groupBy("topic", "prev_end").count().where("count > 1").count() == 0
    assert sm.watchdog_tick(spark, streamed, F.lit(day + " 21:00:00").cast("timestamp"), 2) == 0


def test_batch_run_twice_changes_nothing(spark, feed, at_once, tmp_path):
    root = str(tmp_path / "batch")
    tables = ["batches", "kpi_minute", "kpi_batch", "archive_manifest", "rejected"]
    seen = []
    for _ in range(2):
        pl.run_batch(rw.load_raw(spark, feed), lookups(spark), root)
        seen.append({t: sorted(map(str, spark.read.parquet(f"{root}/{t}").collect())) for t in tables})
    assert seen[0] == seen[1] and len(seen[0]["batches"]) == at_once.batches.count()
    report = spark.read.json(f"{root}/daily_production/productions/epoch=0")
    assert report.count() == at_once.batches.where("recorded").count()


def test_stream_reports(spark, streamed, at_once):
    report = spark.read.json(streamed + "/daily_production/productions")
    assert report.count() == at_once.batches.where("recorded").count()
    done = spark.read.parquet(streamed + "/audit").where("status = 'ok'").agg(F.sum("messages")).first()[0]
    assert done == 1000


def test_archive_holds_what_was_sent(spark, streamed, feed, at_once):
    """The record's own texts beside what was found out, one archive row per record."""
    archive = spark.read.option("header", True).csv(streamed + "/archive")
    sent = rw.parse(rw.load_raw(spark, feed)).select("identity", "net_weight", "timestamp", "reject_flag", "record_uuid", "creation_utc_text")
    same(archive.withColumn("timestamp", F.col("timestamp_text")), sent, sent.columns)
    found = at_once.weighings.select(F.col("identity").cast("string"), F.col("quality_status").alias("processed_status"), "batch_instance_id",
                                     F.round("clean_net_weight_g", 2).cast("string").alias("grams"),
                                     F.unix_micros("timestamp").alias("us"))
    got = archive.withColumns({"grams": F.round(F.col("calculated_net_weight").cast("double"), 2).cast("string"),
                               "us": F.unix_micros(F.col("timestamp").cast("timestamp"))})
    same(got, found, found.columns)


def test_figures_of_the_stream(spark, streamed, feed, at_once):
    """Figures of committed epochs equal those of the batch, also after an epoch was run again; a day is read from its folder."""
    def check():
        for got, want in ((sm.kpi_window(spark, streamed), kp.kpi_window(at_once.weighings)),
                          (sm.kpi_window(spark, streamed, "2 hours", "1 hour"), kp.kpi_window(at_once.weighings, "2 hours", "1 hour")),
                          (sm.kpi_shift(spark, streamed), kp.kpi_shift(at_once.weighings))):
            same(got, want, want.columns)
    check()
    same(sm.kpi_batch(spark, streamed).where("units > 1"), kp.kpi_batch(at_once.batches).where("units > 1"),
         ["batch_instance_id", "units", "units_ok", "units_rejected", "mean_workers"])
    sm.handler(streamed, lookups)(rw.load_raw(spark, feed + "/part-3.json"), 3)
    check()
    day = at_once.weighings.select(F.to_date("timestamp").alias("d")).where("d is not null").first().d
    one = sm.tb.read_kpi_parts(spark, streamed + "/kpi_parts", 3, day)
    assert one.count() > 0 and one.where(F.col("utc_date") != F.lit(day)).count() == 0
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1


def test_state_snapshot(spark, streamed, feed, tmp_path):
    """A state written as JSON lines and read by a new stream, whose first epoch continues where the old one ended."""
    import json
    root, folder = str(tmp_path / "new"), str(tmp_path / "snapshot")
    assert sm.export_state(spark, streamed, folder) == 3
    line = spark.read.text(folder + "/open_batches/lines").first().value
    assert json.loads(line)["start_time"][-6:] in ("+01:00", "+02:00")
    sm.import_state(spark, folder, root)
    old, new = sm.read_state(spark, streamed, 3), sm.read_state(spark, root, -1)
    for name in sm.STATE_TABLES:
        a, b = getattr(old, name), getattr(new, name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    sm.handler(root, lookups)(rw.load_raw(spark, feed + "/part-3.json"), 0)
    assert sorted(map(str, sm.read_state(spark, root, 0).open_batches.collect())) == sorted(map(str, old.open_batches.collect()))
    assert sm.tb.DayTable(spark, root + "/hot").versions(0) == {} and sm.kpi_window(spark, root).count() == 0


def test_snapshot_of_odd_rows(spark):
    import datetime as dt
    from weighline.sinks import snapshot as sn
    utc = [dt.datetime(2024, 10, 27, h, 30, 0, us) for h in (0, 1, 2) for us in (0, 1)] + [dt.datetime(2024, 3, 31, h, 59, 59, 999999) for h in (0, 1)] + [None]
    rows = [(i, t, 0.1 * i, None if i % 2 else "a\"\nñ", (t, None) if i % 3 else None, [t, None]) for i, t in enumerate(utc)]
    df = spark.createDataFrame(rows, "n int, t timestamp, d double, s string, x struct<t: timestamp, u: string>, y array<timestamp>")
    for zone in ("Europe/Madrid", "America/St_Johns"):
        lines = sn.encode(df, zone)
        assert sorted(map(str, sn.decode(lines, df.schema).collect())) == sorted(map(str, df.collect()))
    texts = {r.t for r in sn.encode(df).select(F.get_json_object("line", "$.t").alias("t")).collect()}
    assert {"2024-10-27T02:30:00.000000+02:00", "2024-10-27T02:30:00.000000+01:00"} <= texts
    with pytest.raises(Exception):
        sn.decode(spark.createDataFrame([("{broken",)], "line string"), df.schema).collect()
    assert sn.decode(sn.encode(df.limit(0)), df.schema).count() == 0


def test_rejected_keep_their_text(spark):
    payload = '{"identity": 1, "net_weight": "sensor_error", "timestamp": "2024-01-02T00:00:00Z", "linea": "L"}'
    raw = spark.createDataFrame([("factory/a", payload, None, 0), ("factory/a", "{bad", None, 0), ("factory/a", "[]", None, 0)], rw.RAW_SCHEMA)
    r = pl.process(raw, lookups(spark))
    row, = r.rejected.collect()
    assert (row.reason, row.net_weight_text, row.data) == ("bad_weight", "sensor_error", payload)
    assert [(d.reason, d.data) for d in r.dead_letters.collect()] == [("json_decode_error", "{bad")]
    assert r.weighings.count() == 0


def test_replay_uses_the_lookups_of_its_epoch(spark, tmp_path):
    """An edit of a lookup between an epoch's first run and its replay does not change the epoch."""
    root, known = str(tmp_path / "r"), {"A": "Apple"}
    now = lambda s: pl.Lookups.read(s, tm.WORKERS, tm.TARGETS, {"default": "unmapped", "mappings": known}, tm.CONTACTS)
    raw = lambda i: spark.createDataFrame([("factory/a", '{"identity": %d, "timestamp": "2024-01-02T10:%02d:00Z", "net_weight": 1, "article_number": "A", "linea": "L"}' % (i, i), None, 0)], rw.RAW_SCHEMA)
    run = sm.handler(root, now)
    names = lambda: sorted((r.identity, r.number_refactor) for r in sm.read_hot(spark, root).collect())
    run(raw(1), 0)
    known["A"] = "Apricot"
    run(raw(1), 0)
    assert names() == [(1, "Apple")]
    run(raw(2), 1)
    assert names() == [(1, "Apple"), (2, "Apricot")]


def test_lookups_survive_bad_files(spark, tmp_path):
    import json
    paths = {n: tmp_path / f"{n}.json" for n in ("workers", "targets", "articles", "contacts")}
    for (n, path), content in zip(paths.items(), (tm.WORKERS, tm.TARGETS, tm.ARTICLES, tm.CONTACTS)):
        path.write_text(json.dumps(content))
    read = lambda: pl.Lookups.kept(spark, str(tmp_path / "good"), *map(str, paths.values()))
    rows = lambda x: [sorted(map(str, getattr(x, n).collect())) for n in paths]
    good = rows(read())
    for n, path in paths.items():
        path.write_text("{broken") if n != "targets" else path.unlink()
    assert rows(read()) == good
    paths["workers"].write_text('{"Line_09": 2}')
    assert rows(read())[0] != good[0] and rows(read())[1:] == good[1:]
