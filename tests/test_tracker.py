"""The stateful tracker: any cut and any order of the feed end with the batches of a batch run."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from weighline.operators import batches as ba, returns as rt
from weighline.sinks.days import KEPT_EPOCHS, DayTable, replace_by
from weighline.streaming import tracker as tk

COLUMNS = ["mqtt_topic", "linea", "article", "batch_instance_id", "batch_sequence", "reason", "start_time", "end_time", "closed_at", "recorded",
           "utc_date", "packages", "net_g", "units_ok", "units_rejected", "workers_sum", "last_lag"]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("mqtt_topic", T.StringType()), ("linea", T.StringType()), ("timestamp", T.TimestampType()), ("identity", T.LongType()),
    ("number_refactor", T.StringType()), ("clean_net_weight_g", T.DoubleType()), ("quality_status", T.StringType()),
    ("active_workers", T.LongType()), ("lag_seconds", T.DoubleType()))])


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, tk.ROCKSDB)
    yield
    spark.conf.unset(key)


def made_rows(seed, n=600, lines=4):
    """Three days of records: article changes, crowded minutes, silences, and local days that change between UTC days."""
    rng = random.Random(seed)
    at = {line: dt.datetime(2024, 3, 29, 20, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=rng.randrange(900)) for line in range(lines)}
    article, out = dict.fromkeys(at, "a"), []
    for i in range(n):
        line = 0 if rng.random() < 0.4 else rng.randrange(lines)
        at[line] += dt.timedelta(seconds=rng.choice([0, 1, 5, 20, 61, 700, 3600, 3601, 5000]) if rng.random() < 0.9 else 9000)
        if rng.random() < 0.25:
            article[line] = rng.choice("abcd")
        out.append((rng.choice(["t/1"]) if line else "t/2", f"L{line}", at[line], i + 1, article[line] if rng.random() < 0.98 else None,
                    float(rng.randrange(900)), rng.choice(["OK", "OK", "REJECTED"]), rng.randrange(4), float(rng.randrange(50))))
    return out


def fed(spark, rows, cuts, folder):
    os.makedirs(folder, exist_ok=True)
    edges = [0, *sorted(cuts), len(rows)]
    for k, (a, e) in enumerate(zip(edges, edges[1:])):
        path = f"{folder}/part-{k:03d}.parquet"
        if a < e and not os.path.exists(path):
            spark.createDataFrame(rows[a:e], SCHEMA).toPandas().astype({"timestamp": "datetime64[us]"}).to_parquet(path, index=False)
            os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def run(spark, folder, root, **options):
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    q = tk.run_tracker(tk.records(raw), root, root + "/checkpoint", available_now=True, **options)
    q.awaitTermination()
    assert q.exception() is None


def as_set(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def wanted(spark, rows):
    seg = ba.segment(spark.createDataFrame(rows, SCHEMA))
    return as_set(seg.batches.select(*ba.PUBLIC, *seg.measures)), rt.detect_returns(seg.batches)


def test_stream_batches(spark, tmp_path):
    """In order, in uneven cuts, with a restart in between."""
    rows = made_rows(1, n=400)
    rows.sort(key=lambda r: (r[2], r[3]))
    root, feed = str(tmp_path / "root"), str(tmp_path / "feed")
    fed(spark, rows[:350], [1, 200], feed)
    run(spark, feed, root)
    half, _ = wanted(spark, rows[:350])
    assert as_set(tk.batches(spark, root)) == half
    fed(spark, rows, [1, 200, 350], feed)
    run(spark, feed, root)
    batches, returns = wanted(spark, rows)
    assert as_set(tk.batches(spark, root)) == batches
    got = tk.found_returns(spark, root)
    assert returns.count() > 3 and sorted(map(str, got.select(*returns.columns).collect())) == sorted(map(str, returns.collect()))


def test_late_rows(spark, tmp_path):
    """Shuffled: records come late, split batches, reopen days, and shift the numbers after them."""
    rows = made_rows(2, n=300)
    random.Random(5).shuffle(rows)
    root, feed = str(tmp_path / "root"), str(tmp_path / "feed")
    fed(spark, rows, [100, 200], feed)
    run(spark, feed, root, keep_days=30)
    batches, returns = wanted(spark, rows)
    assert as_set(tk.batches(spark, root)) == batches
    assert sorted(map(str, tk.found_returns(spark, root).select(*returns.columns).collect())) == sorted(map(str, returns.collect()))
    assert spark.read.parquet(root + "/late").count() == 0
    # what is listed as changed leads from epoch to epoch
    changes = spark.read.parquet(root + "/changes")
    assert changes.where("op = 'retract'").count() > 0
    last = tk.last_epoch(spark, root)
    held = changes.groupBy(*[c for c in changes.columns if c not in ("op", "epoch")]).agg(F.sum(F.when(F.col("op") == "new", 1).otherwise(-1)).alias("k"))
    assert held.where("k not in (0, 1)").count() == 0
    assert held.where("k = 1").count() == tk.tables(spark, root)["batches"].read(last).count()


def test_too_late_rows_go_aside(spark, tmp_path):
    rows = made_rows(3, n=200)
    rows.sort(key=lambda r: (r[2], r[3]))
    last = rows[-1]
    early = (last[0], last[1], last[2] - dt.timedelta(days=30), 10_000, "a", 1.0, "OK", 1, 0.0)
    root, feed = str(tmp_path / "root"), str(tmp_path / "feed")
    fed(spark, [*rows, early], [len(rows)], feed)
    run(spark, feed, root, keep_days=4)
    late = spark.read.parquet(root + "/late").collect()
    assert [(r.linea, r.identity) for r in late] == [(last[1], 10_000)]
    assert as_set(tk.batches(spark, root)) == wanted(spark, rows)[0]


def test_epoch_run_again(spark, tmp_path):
    """The tables of an epoch that is run again, or that died before its commit, are the same afterwards."""
    rows = made_rows(4, n=120)
    rows.sort(key=lambda r: (r[2], r[3]))
    root, feed = str(tmp_path / "root"), str(tmp_path / "feed")
    fed(spark, rows, [60], feed)
    run(spark, feed, root)
    before = as_set(tk.batches(spark, root))
    out = spark.createDataFrame([("t/1", "L9", "set", 19811, 0, 0, "a", 0, 1, 1, 1, 1.0, 1, 0, 1, 0.0, None)], tk.OUT)
    tables = tk.tables(spark, root)
    tables["line_batches"].merge(2, out.withColumn("utc_date", F.date_from_unix_date("day")), tk._put)  # died here
    assert tk.last_epoch(spark, root) == 1 and as_set(tk.batches(spark, root)) == before
    for _ in range(2):
        tk.handler(root)(out.where("false"), 2)
        assert tk.last_epoch(spark, root) == 2 and as_set(tk.batches(spark, root)) == before


def test_day_table(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "t"), "k long, v long")
    put = replace_by(["k", "utc_date"])
    rows = lambda *x: spark.createDataFrame([(k, v, dt.date(2024, 1, d)) for k, v, d in x], "k long, v long, utc_date date")
    seen = lambda e, *a: sorted(((r.k, r.v, r.utc_date.day) for r in table.read(e, *a).collect()), key=str)
    assert seen(-1) == [] and table.merge(0, rows(), put) == [] and seen(0) == []
    table.merge(1, rows((1, 1, 1), (None, 2, 1), (1, 3, 2)), put)
    for _ in range(2):
        table.merge(2, rows((None, 5, 1)), put)
        assert seen(2) == [(1, 1, 1), (1, 3, 2), (None, 5, 1)]
    assert seen(1, lambda d: d.day == 2) == [(1, 3, 2)]
    for epoch in range(3, 4 + KEPT_EPOCHS):
        table.merge(epoch, rows((7, epoch, 3)), put)
    assert table.versions(1) == {} and table.versions(3 + KEPT_EPOCHS)[dt.date(2024, 1, 2)] == 1
    assert len(os.listdir(tmp_path / "t" / "utc_date=2024-01-03")) <= KEPT_EPOCHS + 1
    assert os.listdir(tmp_path / "t" / "utc_date=2024-01-01") == ["epoch=2"]
    assert len([f for f in table.read(3 + KEPT_EPOCHS, lambda d: d.day == 3).inputFiles()]) == 1
    table.replace(4 + KEPT_EPOCHS, rows().where("false"), [dt.date(2024, 1, 3)])
    assert [d.day for d in table.versions(4 + KEPT_EPOCHS)] == [1, 2]
