"""Segmentation, returns and stops against brute force, including crowded lines, minutes and copies."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from weighline.operators import batches as ba, returns as rt, stops as sp

SCHEMA = "mqtt_topic string, linea string, timestamp timestamp, identity bigint, number_refactor string"
T0 = dt.datetime(2024, 3, 30, 5, 0)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def scattered(seed, n=400, lines=3, articles=3, span=2.6 * 86400):
    r = random.Random(seed)
    rows, t = [], 0.0
    for i in range(n):
        t += r.choice([0, 0.5, 20, 400, 700, 3700, r.random() * span / n * 4])
        rows.append((f"factory/z{r.randrange(2)}", f"Line_{r.randrange(lines)}", T0 + dt.timedelta(seconds=round(t, 6)), i,
                     f"A{r.randrange(articles)}"))
    return rows


def crowded(seed, n=900):
    """One line-minute holds most rows, with equal times, copies and several articles."""
    r = random.Random(seed)
    rows = scattered(seed, 120)
    base = T0 + dt.timedelta(hours=8)
    for i in range(n):
        t = base + dt.timedelta(microseconds=r.choice([0, 1, 7, 10_000, 10_001, 900_000, 2_000_000, r.randrange(60_000_000)]))
        rows.append(("factory/z0", "Line_0", t, 10_000 + r.randrange(40), f"A{r.randrange(3) if r.random() < .3 else 0}"))
    rows += [("factory/z0", "Line_0", base, 10_005, "A1")] * 300
    return rows


def got_batches(seg):
    return sorted((r.mqtt_topic, r.linea, r.article, r.batch_sequence, r.start_time, r.end_time, r.reason, r.packages,
                   str(r.closed_at)) for r in seg.batches.collect())


def want_batches(rows):
    return sorted((b["topic"], b["line"], b["article"], b["seq"], b["start"], b["end"], b["reason"], b["n"],
                   str(b["closed"])) for b in brute.batches(rows))


@pytest.mark.parametrize("make,seed,target", [(scattered, 1, 10 ** 6), (scattered, 2, 1), (crowded, 3, 10 ** 6),
                                              (crowded, 4, 50), (crowded, 5, 1)])
def test_against_brute_force(spark, make, seed, target):
    rows = make(seed)
    df = frame(spark, rows)
    seg = ba.segment(df, target=target)
    assert got_batches(seg) == want_batches(rows)
    if target == 50:
        assert len(seg.slicing.levels) >= 2        # the crowded minute was cut more than once
    # every record finds the batch brute force puts it in
    tagged = ba.with_batches(df, seg)
    assert tagged.count() == len(rows) and tagged.where("batch_instance_id is null").count() == 0
    per = {(r.mqtt_topic, r.batch_instance_id): r.n for r in
           tagged.groupBy("mqtt_topic", "batch_instance_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {(b["topic"], f'{b["article"]}_{b["seq"]:04d}'): b["n"] for b in brute.batches(rows)}


def test_sparse_history_is_dealt_once(spark, monkeypatch):
    """Few records a minute: no table of pieces or runs is made; a day above the target takes the way by minutes."""
    names, write = [], ba.materialize
    monkeypatch.setattr(ba, "materialize", lambda df, name: names.append(name) or write(df, name))
    rows = scattered(12, 300)
    for target in (10 ** 6, 10):
        names.clear()
        df = frame(spark, rows)
        seg = ba.segment(df, target=target)
        assert names == ["batches"] if target == 10 ** 6 else "full-days" in names
        assert got_batches(seg) == want_batches(rows)
        tagged = ba.with_batches(df, seg)
        assert tagged.count() == len(rows) and tagged.where("batch_instance_id is null").count() == 0


def test_shuffled_paths_give_the_same(spark, monkeypatch):
    """With the broadcast limit at zero every lookup of slices goes through a (salted) shuffle."""
    from weighline.operators import slices as sl
    monkeypatch.setattr(sl.only, "__defaults__", (64, -1))
    monkeypatch.setattr(sl.sized, "__defaults__", (-1,))
    rows = crowded(11)
    df = frame(spark, rows)
    for target in (50, 10 ** 6):
        seg = ba.segment(df, target=target)
        assert got_batches(seg) == want_batches(rows)
        assert ba.with_batches(df, seg).where("batch_instance_id is null").count() == 0


@pytest.mark.parametrize("cap,block,seed", [(50, 1000, 1), (5, 5, 2), (3, 7, 6), (1, 1, 7)])
def test_returns(spark, cap, block, seed):
    rows = scattered(seed, 500, lines=4)
    bs = brute.batches(rows)
    alerts = rt.detect_returns(ba.segment(frame(spark, rows)).batches, cap=cap, block=block)
    got = sorted((r.mqtt_topic, r.current_line, r["product"], int(r.batch_instance_id.split("_")[1]), r.origin_line,
                  r.prev_start, r.prev_end) for r in alerts.collect())
    want = sorted(brute.returns(bs, cap))
    assert got == want and (want or cap == 1)


@pytest.mark.parametrize("seed", [1, 8])
def test_stops(spark, seed):
    # 2024-03-31 is the day the clocks go forward
    rows = scattered(seed, 300)
    got = sorted((r.mqtt_topic, r.origin_line, r.prev_end, r.curr_start)
                 for r in sp.detect_stops(ba.segment(frame(spark, rows))).collect())
    assert got == sorted(brute.stops(rows)) and got


def test_article_change_and_cross_line_return(spark):
    day = dt.datetime(2026, 4, 8, 10)
    at = lambda m: day + dt.timedelta(minutes=m)
    rows = [("t", "Line_A", at(0), 1, "A"), ("t", "Line_A", at(10), 2, "B"), ("t", "Line_B", at(20), 3, "A")]
    seg = ba.segment(frame(spark, rows))
    assert [r.reason for r in seg.batches.collect()] == ["new_article"] * 3
    alert = rt.detect_returns(seg.batches).collect()
    assert [(a.origin_line, a.current_line, a["product"], a.gap_seconds) for a in alert] == [("Line_A", "Line_B", "A", 1200.0)]
    assert alert[0].message == "GLOBAL RETURN: A — previously on Line_A (ended 12:00:00, gap 0.3h)"
    same = [("t", "L", at(m), m, "A") for m in range(5)] + [("t", "M", at(m), m, "A") for m in range(5)]
    assert ba.segment(frame(spark, same)).batches.count() == 2


def test_changes_and_missing_values(spark):
    rows = [(None, None, T0, 1, None), (None, None, T0 + dt.timedelta(seconds=5), 2, None), ("t", "L", None, 3, "A")]
    b = ba.segment(frame(spark, rows)).batches.collect()
    assert [(r.mqtt_topic, r.linea, r.article, r.packages) for r in b] == [("unknown", "unknown", "unknown", 2)]
    rows = scattered(9, 200)
    changes = ba.article_changes(frame(spark, rows)).count()
    n, last = 0, {}
    for topic, line, t, i, art in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        n += last.get((topic, line)) != art
        last[topic, line] = art
    assert changes == n


def test_lag_rule_and_now(spark):
    day = dt.datetime(2026, 4, 8, 9, 0)
    df = (frame(spark, [("t", "L", day, 1, "A"), ("t", "M", day, 1, "A")])
          .withColumn("lag_seconds", F.when(F.col("linea") == "L", 2000.0).otherwise(0.0)))
    seg = ba.segment(df)
    now = lambda h, m: F.lit(dt.datetime(2026, 4, 8, h, m)).cast("timestamp")
    assert [r.origin_line for r in sp.stops_now(seg, now(9, 15), max_lag=900).collect()] == ["M"]
    assert sorted(r.origin_line for r in sp.stops_now(seg, now(9, 15)).collect()) == ["L", "M"]
    assert sp.stops_now(seg, now(9, 9)).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 200_000), st.integers(0, 2)), min_size=1, max_size=60))
def test_invariants(spark, items):
    rows = [("t", f"L{line}", T0 + dt.timedelta(seconds=s), i, f"A{a}") for i, (line, s, a) in enumerate(items)]
    seg = ba.segment(frame(spark, rows), target=5)
    bs = seg.batches.collect()
    assert sum(b.packages for b in bs) == len(rows)
    assert len({(b.mqtt_topic, b.article, b.batch_sequence) for b in bs}) == len(bs)
    assert got_batches(seg) == want_batches(rows)


def test_alternating_minute_is_linear(spark):
    """100,000 records of one minute, every one with another article than the one before."""
    n = 100_000
    df = spark.range(n).selectExpr(
        "'t' AS mqtt_topic", "'L' AS linea", "timestamp_micros(1700000040000000 + id * 500) AS timestamp", "id AS identity",
        "concat('A', id % 2) AS number_refactor")
    out = ba.with_batches(df, ba.segment(df))
    got = out.selectExpr("count(*) AS n", "count(DISTINCT batch_instance_id) AS ids", "count_if(batch_start_time = timestamp) AS own",
                         "count_if(batch_sequence = identity div 2 + 1) AS numbered").first()
    assert tuple(got) == (n, n, n, n)
