"""Cleaning: typed columns, time normalisation, validity and business fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighline import settings as S
from weighline.functions import numbers, times
from weighline.functions.text import clean_text


def typed(records: DataFrame, decimal_comma: bool = True, zone: str = S.FACTORY_ZONE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical text columns to typed columns; nothing is dropped yet.

    ``decimal_comma=False`` treats ``0,500`` as a bad number.  ``keep`` names further columns to carry along.
    """
    server = F.coalesce("creation_utc_text", "server_time_text")
    trimmed = records.withColumns({
        "linea": F.coalesce(clean_text(F.col("linea")), F.lit("unknown")),
        "_time": clean_text(F.col("timestamp")), "_server": clean_text(server),
        "_identity": F.coalesce(numbers.safe_bigint(F.col("identity")), F.lit(0).cast("bigint"))})
    parsed = trimmed.withColumn("_at", times.parse_timestamp(F.col("_time"), F.col("received_at"), zone))
    return parsed.select(
        "mqtt_topic", "linea", F.col("_identity").alias("identity"),
        times.jitter(F.col("_at"), F.col("_identity")).alias("timestamp"),
        numbers.safe_double(F.col("net_weight"), decimal_comma).alias("net_weight"),
        numbers.safe_double(F.col("printed_weight"), decimal_comma).alias("printed_weight"),
        "article_name", "article_number", "batch_code", "operator_id", "record_uuid", "quality_status",
        F.coalesce(numbers.safe_double(F.col("tare_g")), F.lit(0.0)).alias("tare_g"),
        numbers.safe_double(F.col("reject_flag")).alias("reject_flag"),
        numbers.safe_bigint(F.col("active_workers")).cast("int").alias("active_workers"),
        times.parse_instant(F.col("_server"), F.col("received_at")).alias("server_time"),
        "received_at", *keep,
    )


def is_valid() -> Column:
    """A record counts only with a time and a numeric weight; weights are not range-checked."""
    return F.col("timestamp").isNotNull() & F.col("net_weight").isNotNull()


def clean(records: DataFrame, decimal_comma: bool = True, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Valid typed records."""
    return typed(records, decimal_comma, zone).where(is_valid())


def rejection() -> Column:
    """Why a record is not valid."""
    return F.when(F.col("timestamp").isNull(), "missing_timestamp").otherwise("bad_weight")


def rejected(records: DataFrame, decimal_comma: bool = True, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Records :func:`clean` leaves out, with the reason; they are kept for the archive."""
    return (typed(records, decimal_comma, zone).where(~is_valid())
            .withColumn("reason", rejection()))


def business_fields(df: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Grams, quality status, shift and headcount default."""
    have = set(df.columns)
    tare = F.coalesce("tare_g", F.lit(0.0)) if "tare_g" in have else F.lit(0.0)
    reject = F.coalesce(F.col("reject_flag").cast("double"), F.lit(0.0)) if "reject_flag" in have else F.lit(0.0)
    status = F.when(reject != 0, "REJECTED").otherwise("OK")
    if "quality_status" in have:
        status = F.coalesce(F.upper(clean_text(F.col("quality_status"))), status)
    workers = (F.coalesce(F.col("active_workers").cast("int"), F.lit(1)) if "active_workers" in have else F.lit(1))
    return (df.withColumn("clean_net_weight_g", F.col("net_weight") * 1000.0 - tare)
            .withColumn("tare_g", tare)
            .withColumn("reject_flag", reject)
            .withColumn("quality_status", status)
            .withColumn("shift", times.shift_label(F.col("timestamp"), zone))
            .withColumn("active_workers", workers))


def fill_timestamps(df: DataFrame, as_of: Column, col_name: str = "timestamp") -> DataFrame:
    """Unreadable times become ``as_of`` (a parameter, never the wall clock)."""
    column = F.col(col_name)
    parsed = column if dict(df.dtypes)[col_name].startswith("timestamp") else column.try_cast("timestamp")
    return df.withColumn(col_name, F.coalesce(parsed, as_of))


def synthetic_timestamps(df: DataFrame, as_of: Column, order: str, step_ms: int = 10,
                         col_name: str = "timestamp") -> DataFrame:
    """Times for records without any: ``step_ms`` apart in the order of ``order``, ending at ``as_of``.

    The position from the end is a running count over slices of ``order`` values, so no task sees the whole table.
    """
    from weighline.operators.slices import ordered_positions
    ranked = ordered_positions(df, order, "_pos", "_total")
    back = (F.col("_total") - F.col("_pos")) * F.lit(step_ms * 1000)
    return (ranked.withColumn(col_name, F.timestamp_micros(F.unix_micros(as_of) - back.cast("bigint")))
            .drop("_pos", "_total"))


def to_display_zone(df: DataFrame, col_name: str = "timestamp", zone: str = S.FACTORY_ZONE) -> DataFrame:
    """UTC instants to wall clock times without zone."""
    return df.withColumn(col_name, times.local(F.col(col_name), zone).cast("timestamp_ntz"))


def jitter_quality(df: DataFrame) -> DataFrame:
    """Per topic: rows, distinct times, remaining equal times, missing times and the time range."""
    per_time = df.groupBy("mqtt_topic", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    seen = F.col("timestamp").isNotNull()
    return per_time.groupBy("mqtt_topic").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(seen, 1).otherwise(0)).alias("unique_times"),
        (F.sum(F.when(seen, F.col("n")).otherwise(0)) - F.sum(F.when(seen, 1).otherwise(0))).alias("equal_times"),
        F.sum(F.when(seen, 0).otherwise(F.col("n"))).alias("missing_times"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )


def rename_flat_columns(df: DataFrame) -> DataFrame:
    """Remove ``values.`` from column names and rename source columns to canonical ones (whole-column form).

    A canonical name that is present wins; otherwise the first present alias is used.
    """
    df = df.toDF(*[c.replace("values.", "") for c in df.columns])
    present, names = set(df.columns), {}
    for name, aliases in S.ALIASES.items():
        found = next((a for a in aliases if a in present), None)
        if name not in present and found:
            names[found] = name
    return df.withColumnsRenamed(names)
