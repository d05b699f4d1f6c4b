"""Headline queries, timed.  Prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).  Every query is planned and
executed in full (``noop`` sink), once to warm up on the smallest tables and once for the clock.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weighline.plans.pipeline import Lookups, process  # noqa: E402
from weighline.plans.queries import REGISTRY  # noqa: E402
from weighline.operators import outputs as ou  # noqa: E402
from weighline.session import build_session  # noqa: E402
from weighline.sources import telemetry as tm  # noqa: E402

HEADLINE = ["ingest_parse", "clean_weighings", "dead_letters", "dedup_identity", "enrich_targets", "batches", "batches_lineitem",
            "weighings_with_batch", "return_alerts", "stop_alerts", "daily_report", "kpi_minute", "kpi_shift",
            "kpi_batch", "hot_rows", "hot_upsert", "cold_rows", "archive_manifest", "alert_routing", "write_summary"]


def pipeline(spark, sf_dir: str) -> None:
    """Raw JSON to hot rows, batches, alerts and dead letters."""
    result = process(tm.raw_messages(spark, sf_dir).drop("event_id"),
                     Lookups.read(spark, tm.WORKERS, tm.TARGETS, tm.ARTICLES, tm.CONTACTS))
    for df in (ou.hot_rows(result.weighings), result.batches, result.routed, result.dead_letters):
        run(df)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("weighline-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    jobs = {name: (lambda d, q=REGISTRY[name]: run(q(spark, d))) for name in HEADLINE}
    jobs["pipeline"] = lambda d: pipeline(spark, d)
    if os.path.isdir(small):
        for name in ("clean_weighings", "batches", "stop_alerts", "hot_rows"):
            jobs[name](small)
    seconds = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job(sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)
    records = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "weighline_headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "records": records,
        "pipeline_records_per_sec": round(records / seconds["pipeline"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
