"""Lookups, dedup, alert routing, hot and cold outputs, audit figures."""

import datetime as dt
import json

from pyspark.sql import functions as F

from weighline.operators import (alerts as al, audit, clean as cl, dedup as dd, enrich as en, outputs as ou)
from weighline.session import materialize, shared_dir
from weighline.sinks import tables as tb
from weighline.sources import lookups as lk

DAY = dt.datetime(2026, 4, 8, 12, 0)


def test_workers(spark, tmp_path):
    path = tmp_path / "workers.json"
    path.write_text(json.dumps({"Line_1": 4}))
    df = spark.createDataFrame([("Line_1",), ("Line_2",), ("Unknown_Line",), ("  Line_1  ",), (None,)], "linea string")
    defaults = lk.dim_workers(spark, {"Line_2": 8, "default": 2})
    for source in (str(path), {"Line_1": 4}):
        got = en.enrich_workers(df, lk.dim_workers(spark, source), defaults).collect()
        assert sorted((str(r.linea), r.active_workers) for r in got) == sorted(
            [("Line_1", 4), ("Line_2", 8), ("Unknown_Line", 2), ("  Line_1  ", 4), ("None", 2)])
    got = en.enrich_workers(df.limit(1), lk.dim_workers(spark, {"Line_1": 99}), defaults, max_workers=10).first()
    assert got.active_workers == 10
    # hot reload: a broken file keeps the last good copy
    good = lk.dim_workers(spark, {"Line_1": 4})
    path.write_text("{broken")
    assert lk.reload(lk.dim_workers, spark, str(path), good).count() == 1
    assert lk.reload(lk.dim_workers, spark, str(tmp_path / "none.json"), good).count() == 1


def test_targets(spark, tmp_path):
    path = tmp_path / "targets.json"
    path.write_text(json.dumps({"100": 55.5, "Alpha Product": 120.0, "Bad Data": "Not a Number", "default": 15.0}))
    targets = lk.dim_targets(spark, str(path))
    df = spark.createDataFrame([("100", "x"), ("999", "Alpha Product"), ("888", "Unknown"), ("Bad Data", "Unknown")],
                               "article_number string, article_name string")
    got = {r.article_number: r.target_value for r in en.enrich_targets(df, targets).collect()}
    assert got == {"100": 55.5, "999": 120.0, "888": 15.0, "Bad Data": 0.0}
    one = en.target_for(spark.createDataFrame([("100",), ("zz",)], "product_key string"), targets)
    assert {r.product_key: float(r.target) for r in one.collect()} == {"100": 55.5, "zz": 15.0}


def test_articles(spark, tmp_path):
    path = tmp_path / "articles.json"
    path.write_text(json.dumps({"description": "d", "default": "NOPE", "mappings": {"A-100": "Alpha Product"}}))
    df = spark.createDataFrame([(" A-100 ",), (" X-999 ",), (None,)], "article_number string")
    got = [r.number_refactor for r in en.map_articles(df, lk.dim_articles(spark, str(path))).collect()]
    assert sorted(got) == ["Alpha Product", "NOPE", "NOPE"]


def test_contacts(spark):
    source = {"default": {"recipients": [{"name": "d", "email": "d@x"}]},
              "topics": {"t/L": {"recipients": [{"name": "a", "email": "a@x"}, {"name": "no"}]},
                         "t": {"email": "old@x"}, "u/M": {"recipients": []}}}
    alerts = spark.createDataFrame([("t", "t/L", "X"), ("t", "t/K", "X"), ("u", "u/M", "X"), ("v", "v/Z", "X")],
                                   "mqtt_topic string, topic string, alert_type string")
    got = sorted((r.topic, r.recipient_email) for r in al.route_alerts(alerts, lk.dim_contacts(spark, source)).collect())
    assert got == [("t/K", "old@x"), ("t/L", "a@x"), ("v/Z", "d@x")]
    assert al.route_alerts(alerts, lk.dim_contacts(spark, {"topics": {}})).count() == 0


def test_dedup_and_watermark(spark):
    df = spark.createDataFrame([("t", i, DAY, "u") for i in (999, 1000, 1001)] + [("new", 1, DAY, None)],
                               "mqtt_topic string, identity bigint, timestamp timestamp, record_uuid string")
    mark = spark.createDataFrame([("t", 1000)], "mqtt_topic string, last_identity bigint")
    assert sorted(r.identity for r in dd.dedup(df, mark).collect()) == [1, 1001]
    far = spark.createDataFrame([("t", 999_999)], "mqtt_topic string, last_identity bigint")
    assert dd.mark_new(df, far, rollover=500_000).where("is_new").count() == 4
    w = dd.ingest_watermark(df)
    assert {r.mqtt_topic: (r.last_identity, r.record_count) for r in w.collect()} == {"t": (1001, 3), "new": (1, 1)}
    assert dd.ingest_summary(w).first().topics_tracked == 2
    merged = dd.merge_watermark(w, dd.ingest_watermark(df.where("identity = 999")))
    assert {r.mqtt_topic: r.last_identity for r in merged.collect()} == {"t": 1001, "new": 1}


def test_watermark_never_moves_back(spark):
    schema = "mqtt_topic string, identity bigint, timestamp timestamp, record_uuid string"
    at = lambda h: DAY.replace(hour=h)
    mark = lambda *rows: dd.ingest_watermark(spark.createDataFrame([("t", *r, None) for r in rows], schema))
    old = mark((5000, at(10)))
    late = dd.merge_watermark(old, mark((10, at(8))))
    assert [r.last_identity for r in late.collect()] == [5000]
    resent = spark.createDataFrame([("t", 4990, at(10), None)], schema)
    assert dd.dedup(resent, late).count() == 0
    restarted = dd.merge_watermark(old, mark((3, at(11))))
    assert [r.last_identity for r in restarted.collect()] == [3]
    # an unreadable counter on the newest record does not reset the watermark, unless there is nothing else
    assert [r.last_identity for r in mark((5000, at(10)), (0, at(11))).collect()] == [5000]
    assert [r.last_identity for r in mark((0, at(11))).collect()] == [0]


def test_hot(spark, tmp_path):
    df = spark.createDataFrame([(2, DAY, 1.5, " rejected ", "L"), (1, DAY, 2.5, "REJECTED", "L"), (3, DAY, None, None, "L")],
                               "identity bigint, timestamp timestamp, net_weight double, quality_status string, linea string")
    hot = ou.hot_rows(df)
    assert [c for c in hot.columns][:3] == ["timestamp", "mqtt_topic", "linea"] and len(hot.columns) == 22
    got = {r.identity: (r.net_weight, r.quality_status, r.mqtt_topic, r.batch_code, r.batch_start_time) for r in hot.collect()}
    assert got == {2: (1.5, "REJECTED", "unknown", "no_batch", "unknown"), 1: (2.5, "REJECTED", "unknown", "no_batch", "unknown"),
                   3: (0.0, "UNKNOWN", "unknown", "no_batch", "unknown")}
    assert sorted(r.identity for r in ou.last_write_wins(hot).collect()) == [2, 3]
    path = str(tmp_path / "hot")
    tb.write_hot(hot, path, epoch=0)
    tb.write_hot(hot.where("identity = 1"), path, epoch=1)
    tb.write_hot(hot.where("identity = 1"), path, epoch=1)
    assert sorted(r.identity for r in tb.read_hot(spark, path).collect()) == [1, 3]


def test_archive_layout(spark, tmp_path):
    df = spark.createDataFrame([("raw/data", "Line_1", DAY, 1, "Alpha_Prod", "B-100", "OK", 0.0, "c/1")],
                               "mqtt_topic string, linea string, timestamp timestamp, identity bigint, article_name string, "
                               "batch_instance_id string, quality_status string, reject_flag double, batch_code string")
    assert ou.cold_paths(df).first().folder == "packaging/raw_data/Line_1/2026/04/08/Alpha_Prod/B-100"
    m = ou.archive_manifest(df).first()
    assert (m.file_name, m.tag_batch, m.tag_quality, m.tag_hardware_reject, m.tag_line, m.column_count) == \
        ("120000_c1_AlphaProd_OK.csv", "c-1", "OK", None, "raw_data", 9)
    bare = df.drop("linea", "article_name", "batch_instance_id", "quality_status", "batch_code")
    assert ou.cold_paths(bare).first().folder == "packaging/raw_data/data/2026/04/08/Unknown_article/UNKNOWN_BATCH"
    assert ou.archive_manifest(bare).first().file_name == "120000_NoBatch_UnknownProd_RAW.csv"
    tb.write_archive(df, str(tmp_path / "a"))
    back = spark.read.option("header", True).csv(str(tmp_path / "a")).first()
    assert (back.p_topic, back.p_batch, back.identity) == ("raw_data", "B-100", "1")


def test_cold_join_never_multiplies(spark):
    raw = spark.createDataFrame([("a", 1, DAY), ("a", 2, DAY), (None, 3, DAY)],
                                "record_uuid string, identity bigint, timestamp timestamp")
    done = spark.createDataFrame([("a", 1, DAY, "OK"), ("a", 9, DAY, "LAST"), (None, 5, DAY, "NULLKEY")],
                                 "record_uuid string, identity bigint, timestamp timestamp, quality_status string")
    got = sorted((r.identity, str(r.processed_status)) for r in ou.cold_rows(raw, done).collect())
    assert got == [(1, "LAST"), (2, "LAST"), (3, "None")]


def test_business_rules(spark):
    df = spark.createDataFrame([(1.0, 12.5, " ok ", None, None, DAY), (2.0, None, None, 1.0, 3, DAY)],
                               "net_weight double, tare_g double, quality_status string, reject_flag double, "
                               "active_workers int, timestamp timestamp")
    got = [(r.clean_net_weight_g, r.quality_status, r.active_workers) for r in cl.business_fields(df).collect()]
    assert got == [(987.5, "OK", 1), (2000.0, "REJECTED", 3)]
    bare = cl.business_fields(df.select("net_weight", "timestamp")).first()
    assert (bare.quality_status, bare.active_workers, bare.tare_g, bare.shift) == ("OK", 1, 0.0, "Tarde")


def test_metrics(spark):
    runs = spark.createDataFrame([("ok", s) for s in (0.05, 0.3, 2.0, 7.0, 20.0)], "status string, seconds double")
    m = audit.duration_histogram(runs, ["status"]).first()
    assert (m.le_0_1, m.le_0_5, m.le_1, m.le_2_5, m.le_5, m.le_10, m.runs, m.p95_seconds) == (1, 2, 2, 3, 3, 4, 5, 20.0)
    log = spark.createDataFrame([("t", "ok", 3), ("t", "ok", 4)], "topic string, status string, messages bigint")
    assert audit.message_counts(log).first().messages == 7


def test_shared_folder(spark):
    df = materialize(spark.range(5), "t")
    assert df.count() == 5 and shared_dir(spark)
