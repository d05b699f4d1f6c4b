"""Quantile sketches, backlog at its edges, and the parser's plan."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from weighline.operators import audit
from weighline.sources import raw as rw


def test_sketches_merge_within_their_error(spark):
    rng = np.random.default_rng(3)
    seconds = np.concatenate([rng.exponential(2.0, 20_000), rng.uniform(50, 60, 2_000)])
    base = dt.datetime(2024, 1, 1)
    rows = [("ok" if i % 3 else "late", base + dt.timedelta(seconds=i % 1200), float(x)) for i, x in enumerate(seconds)] + [("none", base, None)]
    runs = spark.createDataFrame(rows, "status string, at timestamp, seconds double").repartition(7)
    kept = audit.duration_sketches(runs, ["status"], "at")
    assert kept.where("status = 'ok'").count() == 20
    for keys in (["status"], []):
        for q in (0.5, 0.95):
            for r in audit.sketched_quantile(kept, keys, q).collect():
                every = np.sort([s for t, _, s in rows if s is not None and (not keys or t == r.status)])
                assert r.runs == len(every)
                assert abs(np.searchsorted(every, r.p95_seconds, side="right") / len(every) - q) < 0.01


def test_backlog(spark):
    at = lambda d, h, m, s=0: dt.datetime(2024, 1, d, h, m, s)
    arrived = spark.createDataFrame([("a", at(1, 23, 59)), ("a", at(1, 23, 59, 30)), ("a", at(3, 0, 0)), ("b", at(1, 5, 0)), ("b", None)], "topic string, at timestamp")
    done = spark.createDataFrame([("a", at(2, 0, 1)), ("a", at(3, 0, 0, 59)), ("b", at(1, 5, 0, 1))], "topic string, at timestamp")
    got = sorted((r.topic, r.minute.day, r.arrived, r.processed, r.waiting) for r in audit.backlog(arrived, done).collect())
    assert got == [("a", 1, 2, 0, 2), ("a", 2, 0, 1, 1), ("a", 3, 1, 1, 1), ("b", 1, 1, 1, 0)]
    assert audit.backlog(arrived.limit(0), done.limit(0)).count() == 0


def test_payload_is_parsed_once(spark):
    raw = spark.createDataFrame([("t", '[{"identity": 1}, {"linea": "x"}]', None, 0), ("t", "{'identity': 1}", None, 0), ("t", "[]", None, 0)], rw.RAW_SCHEMA)
    for df in (rw.parse_all(raw), rw.parse(raw).where("identity IS NOT NULL"), rw.dead_letters(raw)):
        # the optimized plan only: text of the other stages would count again
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [(r.identity, r.linea) for r in rw.parse(raw).collect()] == [("1", None), (None, "x")]
    assert [(r.reason, r.data) for r in rw.dead_letters(raw).collect()] == [("json_decode_error", "{'identity': 1}")]
