"""Production-line weighing telemetry on Spark: the public functions."""

from weighline.operators.alerts import route_alerts
from weighline.operators.batches import assign_batches, segment, with_batches
from weighline.operators.clean import clean
from weighline.operators.dedup import dedup
from weighline.operators.kpis import kpi_batch, kpi_shift, kpi_window
from weighline.operators.returns import detect_returns
from weighline.operators.stops import detect_stops, stops_now
from weighline.plans.pipeline import Lookups, enrich, process, run_batch
from weighline.session import build_session
from weighline.sinks.tables import write_archive as archive
from weighline.sources.raw import load_raw, parse, stream_raw
from weighline.streaming.stream import run_stream, run_watchdog

__all__ = ["Lookups", "archive", "assign_batches", "build_session", "clean", "dedup", "detect_returns", "detect_stops",
           "enrich", "kpi_batch", "kpi_shift", "kpi_window", "load_raw", "parse", "process", "route_alerts", "run_batch",
           "run_stream", "run_watchdog", "segment", "stops_now", "stream_raw", "with_batches"]
