"""The live stop check with timers."""

import datetime as dt
import random
import time
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from weighline import settings as S
from weighline.operators import stops as st
from weighline.streaming import tracker as tk, watch as wt

ZONE = ZoneInfo(S.FACTORY_ZONE)


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, tk.ROCKSDB)
    yield
    spark.conf.unset(key)


def test_rules_equal_the_batch_rules(spark):
    rng = random.Random(1)
    base = [int(dt.datetime(2024, m, d, tzinfo=dt.timezone.utc).timestamp()) for m, d in ((3, 30), (3, 31), (10, 26), (10, 27), (7, 1))]
    rows = [(rng.choice(base) * 10 ** 6 + rng.randrange(2 * 86_400 * 10 ** 6), rng.choice([rng.randrange(8 * 3600 * 10 ** 6), 600 * 10 ** 6])) for _ in range(500)]
    df = spark.createDataFrame([(a, a + b) for a, b in rows], "last bigint, at bigint")
    for r in df.select("*", st.fire_time(F.col("last")).alias("fire"), st.in_watch(F.col("last"), F.col("at")).alias("watch")).collect():
        assert wt.fire_us(r.last, ZONE) == r.fire, r
        assert wt.watched(r.last, r.at, ZONE) == r.watch, r


def versions(spark, rows, path):
    shape = spark.createDataFrame(rows, "mqtt_topic string, linea string, article string, batch_instance_id string, start_time timestamp, end_time timestamp, seconds double")
    (shape.withColumn("last_lag", F.struct(F.unix_micros("end_time").alias("us"), "seconds")).drop("seconds")
     .coalesce(1).write.mode("overwrite").parquet(path))


def watch(spark, root, behind, want):
    """Start the query, wait until it has told what is wanted (80 seconds at most) and run two more ticks, stop it."""
    q = wt.run_watch(spark, root, root + "/check", seconds=1, behind=behind)
    end, more = time.time() + 80, None
    while time.time() < end and q.exception() is None and (more is None or len(q.recentProgress) < more):
        more = more or (len(q.recentProgress) + 2 if q.recentProgress and told(spark, root) == want else None)
        time.sleep(0.5)
    assert q.exception() is None and told(spark, root) == want
    q.stop()


def told(spark, root):
    try:
        return sorted((r.origin_line, r.prev_end.strftime("%H:%M:%S")) for r in spark.read.parquet(root + "/live_stops").collect())
    except Exception as missing:
        assert "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER" in str(missing), missing
        return []


def test_each_silence_once_across_restarts(spark, tmp_path):
    root = str(tmp_path)
    utc = lambda h, m, s=0, d=2: dt.datetime(2024, 7, d, h, m, s, tzinfo=dt.timezone.utc)
    at = lambda when: time.time() - when.timestamp()  # noqa: E731  (how far the feed's clock is behind)
    versions(spark, [("t", "A", "x", "x_1", utc(8, 0), utc(9, 0), 0.0), ("t", "B", "y", "y_1", utc(8, 0), utc(9, 8), 0.0),
                     ("t", "C", "z", "z_1", utc(8, 0), utc(9, 0), 2000.0), ("u", "D", "w", "w_1", utc(1, 0), utc(1, 5), 0.0)], f"{root}/batches/epoch=0")
    # at 09:12: A and D (since before the shift) are reported, B is not silent for long enough, C had a late delivery
    want = [("A", "09:00:00"), ("D", "01:05:00")]
    watch(spark, root, at(utc(9, 12)), want)
    watch(spark, root, at(utc(9, 12)), want)  # a restart tells nothing again
    # A comes back and goes silent again; the version of epoch 0 is written once more by a replay
    versions(spark, [("t", "A", "x", "x_1", utc(8, 0), utc(9, 14), 0.0)], f"{root}/batches/epoch=1")
    versions(spark, [("t", "A", "x", "x_1", utc(8, 0), utc(9, 0), 0.0)], f"{root}/batches/epoch=2")
    watch(spark, root, at(utc(9, 30)), [("A", "09:00:00"), ("A", "09:14:00"), ("D", "01:05:00")])
