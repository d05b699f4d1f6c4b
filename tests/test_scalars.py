"""Scalar functions, cleaning and ingest on the documented inputs."""

import datetime as dt
import json

from pyspark.sql import functions as F

from weighline.functions import numbers, text as tx, times
from weighline.operators import clean as cl, stops as sp
from weighline.sources import raw as rw

DAY = dt.datetime(2026, 4, 8, 10, 0)


def values(spark, items, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def raw_of(spark, payloads, topic="factory/zone_1/production", at=DAY):
    return spark.createDataFrame([(topic, p if isinstance(p, str) else json.dumps(p), at, 0) for p in payloads],
                                 rw.RAW_SCHEMA)


def test_numbers(spark):
    comma = lambda c: numbers.safe_double(c, decimal_comma=True)
    assert values(spark, ["500,5", "1000,0", "0,75", "sensor_error", None, "1.5d", "nan", "inf", " 7 ", "1,000.5"], comma) == \
        [500.5, 1000.0, 0.75, None, None, None, None, None, 7.0, None]
    assert values(spark, ["0,5", "1.9", "1e3"], numbers.safe_double) == [None, 1.9, 1000.0]
    assert values(spark, ["1.9", "-3", "x", "12345678901"], numbers.safe_bigint) == [1, -3, None, 12345678901]
    assert values(spark, ["1,5 kg", "250 G", "1 250 g", "nothing"], numbers.weight_text_grams) == [1500.0, 250.0, 1250.0, None]


def test_shift_and_zone(spark):
    at = [dt.datetime(2026, 1, 8, h) for h in (7, 14, 5, 13)]
    assert values(spark, at, times.shift_label, "timestamp") == ["Manana", "Tarde", "Manana", "Tarde"]
    assert values(spark, [DAY], times.local_text, "timestamp") == ["2026-04-08 12:00:00"]
    assert values(spark, ["2026-04-08 12:00:00", "bad"], times.from_local_text) == [DAY, None]


def test_device_times(spark):
    at = F.lit(dt.datetime(2026, 4, 8, 23, 30)).cast("timestamp")       # already 9 April in the factory
    parse = lambda c: times.parse_timestamp(c, at)
    got = values(spark, ["10:30", "9:05", "25:99", "10:75", "garbage", "2026-04-08T10:00:00Z", "2026-04-08 10:00:00",
                         "2026-04-08T10:00:00.123456+02:00", "1775642400000000001", "20260408", "2026/04/08 10:00:00",
                         "04/08/2026 10:00:00", "10:30:15", None, "", "NaT"], parse)
    now = dt.datetime(2026, 4, 8, 23, 30)
    assert got == [dt.datetime(2026, 4, 9, 8, 30), dt.datetime(2026, 4, 9, 7, 5), now, now, now, DAY, DAY,
                   dt.datetime(2026, 4, 8, 8, 0, 0, 123456), DAY, dt.datetime(2026, 4, 8), DAY, DAY,
                   dt.datetime(2026, 4, 8, 10, 30, 15), None, None, None]
    # clock changes: the skipped hour is read with the offset before it, the repeated one as its first pass
    for day, want in (("2024-03-31", dt.datetime(2024, 3, 31, 1, 30)), ("2024-10-27", dt.datetime(2024, 10, 27, 0, 30))):
        base = F.lit(f"{day} 12:00:00").cast("timestamp")
        assert values(spark, ["02:30"], lambda c: times.parse_clock(c, base)) == [want]


def test_jitter_and_lag(spark):
    df = spark.createDataFrame([(DAY, 300001), (DAY, -1), (DAY, 10_000_000)], "t timestamp, i bigint")
    got = [r[0] for r in df.select(times.jitter(F.col("t"), F.col("i"))).collect()]
    assert [g - DAY for g in got] == [dt.timedelta(microseconds=v) for v in (300001, 9_999_999, 0)]
    df = spark.createDataFrame([(DAY, DAY + dt.timedelta(seconds=90)), (DAY, DAY - dt.timedelta(seconds=5))],
                               "timestamp timestamp, server_time timestamp")
    assert [r.lag_seconds for r in sp.with_lag(df).collect()] == [90.0, 0.0]
    assert [r.lag_seconds for r in sp.with_lag(df, "local").collect()] == [7290.0, 7195.0]


def test_texts(spark):
    assert values(spark, ["Linea_07", "línea 12", "PARADA x", "Line_B_2", "", None], tx.format_line) == \
        ["LINEA 07", "LINEA 12", "PARADA x", "LINE B 2", "N/A", "N/A"]
    assert values(spark, [3725.5, 59.0], tx.gap_text, "double") == ["1h 2m", "0h 0m"]
    assert values(spark, ["Gamma (Mix)/Ñ", " a-b_c "], tx.safe_article) == ["Gamma MixÑ", "a-b_c"]
    assert values(spark, ["A b/1.2_é"], tx.safe_batch) == ["Ab1.2_é"]
    assert values(spark, [None], tx.display_time, "timestamp") == ["--:--"]
    for pattern, yes, no in (("factory/#", ["factory", "factory/a/b"], ["factoryx", "a/factory"]),
                             ("a/+/c", ["a/b/c"], ["a/b/d/c", "a//c"]), ("#", ["x/y"], [])):
        df = spark.createDataFrame([(t,) for t in yes + no], "topic string")
        assert sorted(r.topic for r in rw.subscribe(df, pattern).collect()) == sorted(yes)


def test_ingest_documented_batch(spark):
    base = dict(article_name="Product_Alpha", article_number="A-1001", batch_code="BATCH-Line_A-001",
                mqtt_topic="factory/zone_1/production")
    rows = [dict(base, id="abc_001", identity=300001, timestamp="10:30", net_weight=1.0045, device_name="Line_A",
                 quality_status="OK", reject_flag=0),
            dict(base, id="abc_002", identity=300002, timestamp="10:30", net_weight=0.5012, device_name="Line_B",
                 quality_status="OK", reject_flag=0),
            dict(base, id="abc_003", identity=300003, timestamp="25:99", net_weight="sensor_error", device_name="Line_A",
                 quality_status="REJECTED", reject_flag=1)]
    recs = rw.parse(raw_of(spark, [json.dumps(rows)]))
    out = cl.clean(recs).orderBy("identity").collect()
    assert [(r.identity, r.linea, r.net_weight, r.record_uuid) for r in out] == \
        [(300001, "Line_A", 1.0045, None), (300002, "Line_B", 0.5012, None)]
    assert 0 < (out[1].timestamp - out[0].timestamp).total_seconds() < 1
    assert [r.reason for r in cl.rejected(recs).collect()] == ["bad_weight"]


def test_ingest_garbage(spark):
    raw = raw_of(spark, ["[]", '[{"invalid_key":123},{"identity":null,"net_weight":""}]', '{"a":', "", "null", "[1,2]",
                         '[{"identity":1},5]', '[null,{"identity":1}]', '{"identity":1} tail', '{"x": "null"}', "5"])
    assert cl.clean(rw.parse(raw)).count() == 0
    assert rw.parse(raw).count() == 3
    bad = {(r.data, r.reason) for r in rw.dead_letters(raw).collect()}
    assert bad == {('{"a":', "json_decode_error"), ("", "json_decode_error"), ("null", "not_an_object"),
                   ("[1,2]", "not_an_object"), ('[{"identity":1},5]', "not_an_object"),
                   ('[null,{"identity":1}]', "not_an_object"), ('{"identity":1} tail', "json_decode_error"),
                   ("5", "not_an_object")}
    data = spark.createDataFrame([("factory/a", bytearray(b"\xff{"), DAY, 0)],
                                 "topic string, payload binary, received_at timestamp, attempts int")
    assert [r.reason for r in rw.dead_letters(data).collect()] == ["encoding_error"]


def test_names_that_differ_only_in_case_or_nesting(spark):
    raw = raw_of(spark, [{"Timestamp": "2026-04-08T10:00:00", "Identity": 5, "ActualNetWeightValue": "0,500",
                          "DeviceName": "L1", "ArticleName": "x"},
                         {"timestamp": "2026-04-08T11:00:00", "identity": 6, "Peso": "1", "linea": "L2", "batch": "b",
                          "Batch": "B"},
                         {"values": {"Fecha": "2026-04-08 12:00:00", "Identity": 7, "Weight": 2}, "values.Source": "L3",
                          "Producto": 'say "values.": x'}], topic="factory/q")
    got = {r.identity: r for r in cl.typed(rw.parse(raw)).collect()}
    assert (got[5].net_weight, got[5].linea, got[5].mqtt_topic) == (0.5, "L1", "factory/q")
    assert (got[6].net_weight, got[6].linea, got[6].batch_code) == (1.0, "L2", "B")
    assert (got[7].net_weight, got[7].linea, got[7].article_name) == (2.0, "L3", 'say "values.": x')
    assert [got[k].timestamp - dt.timedelta(microseconds=k) for k in (5, 6, 7)] == \
        [DAY, DAY + dt.timedelta(hours=1), DAY + dt.timedelta(hours=2)]
    assert {r.identity: r.net_weight for r in cl.typed(rw.parse(raw), decimal_comma=False).collect()}[5] is None


def test_whole_column_rename(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["values.Peso", "Weight", "identity", "Identity2"])
    assert cl.rename_flat_columns(df).columns == ["net_weight", "Weight", "identity", "Identity2"]


def test_fill_and_synthetic(spark):
    df = spark.createDataFrame([(1, "2026-04-08 10:00:00"), (2, "no")], "i int, timestamp string")
    now = F.lit(DAY + dt.timedelta(hours=3)).cast("timestamp")
    assert [r.timestamp for r in cl.fill_timestamps(df, now).orderBy("i").collect()] == [DAY, DAY + dt.timedelta(hours=3)]
    made = cl.synthetic_timestamps(spark.range(100).withColumnRenamed("id", "i"), now, "i").orderBy("i").collect()
    end = DAY + dt.timedelta(hours=3)
    assert [r.timestamp for r in made] == [end - dt.timedelta(milliseconds=10 * (99 - i)) for i in range(100)]


def test_requeue(spark):
    raw = raw_of(spark, [{"identity": n} for n in range(3)]).withColumn("attempts", F.element_at(
        F.array(F.lit(1), F.lit(2), F.lit(0)), F.get_json_object("payload", "$.identity").cast("int") + 1))
    split = {r.attempts: (r.action, r.reason) for r in rw.retry_split(raw).collect()}
    assert split == {2: ("retry", None), 3: ("dead_letter", "max_retries_exceeded"), 1: ("retry", None)}
    q = rw.requeue(raw, raw_of(spark, [{"identity": 9}])).collect()
    assert sorted((r.retried, r.attempts) for r in q) == [(False, 0), (True, 1), (True, 2)]
