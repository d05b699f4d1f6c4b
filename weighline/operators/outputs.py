"""Rows of the hot table and of the cold archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weighline import settings as S
from weighline.functions import numbers, text as tx, times
from weighline.session import materialize

#: Tasks that records without uuid are dealt over, where others are joined by it.
KEYLESS_SHARES = 1024

_FILL = {"mqtt_topic": "unknown", "batch_code": "no_batch", "linea": "unknown", "batch_instance_id": "unknown"}


def hot_rows(df: DataFrame) -> DataFrame:
    """Ordered, typed columns of the hot table.

    Tags are text without nulls, numeric fields have no nulls, integer fields are truncated, the batch start is ISO
    text.  ``target_value`` and ``server_time`` follow the fixed column list.  Records without identity are left out.
    """
    have = set(df.columns)
    kinds = dict(df.dtypes)

    def number(name: str) -> Column:
        col = F.col(name)
        value = numbers.safe_double(col) if kinds[name] == "string" else col.cast("double")
        value = F.when(F.isnan(value), None).otherwise(value)
        if name == "identity":
            return col.cast("bigint") if kinds[name] in ("bigint", "int") else value.cast("bigint")
        value = F.coalesce(value, F.lit(0.0))
        return value.cast("bigint") if name in S.HOT_INTEGER else value

    def column(name: str) -> Column:
        if name == "batch_start_time":
            if name not in have:
                return F.lit("unknown").alias(name)
            return F.coalesce(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit("unknown")).alias(name)
        if name in S.HOT_NUMERIC:
            return (number(name) if name in have else F.lit(0).cast("bigint" if name in S.HOT_INTEGER else "double")
                    ).alias(name)
        if name in S.HOT_TAGS:
            absent = _FILL.get(name, "unknown")
            value = F.coalesce(F.col(name).cast("string"), F.lit("unknown")) if name in have else F.lit(absent)
            if name in ("quality_status", "shift"):
                value = F.upper(tx.clean_text(value))
            return value.alias(name)
        return (F.col(name) if name in have else F.lit(None).cast("string")).alias(name)

    extra = [c for c in ("target_value", "server_time") if c in have]
    out = df.select(*[column(c) for c in S.HOT_COLUMNS + extra])
    return out.where(F.col("identity").isNotNull())


def hot_tags(columns: list[str]) -> list[str]:
    return [c for c in S.HOT_TAGS if c in columns]


def last_write_wins(hot: DataFrame) -> DataFrame:
    """One row per (tags, timestamp): that of the highest identity, ties by the full row.

    The rank filter is pushed below the shuffle, so repeated copies of a key collapse where they are read.
    """
    key = hot_tags(hot.columns) + ["timestamp"]
    rest = [F.desc(c) for c in sorted(hot.columns) if c not in key and c != "identity"]
    w = Window.partitionBy(*key).orderBy(F.desc("identity"), *rest)
    return hot.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(current: DataFrame, changes: DataFrame) -> DataFrame:
    """The hot table after writing ``changes``: keys written again take the new row."""
    key = hot_tags(changes.columns) + ["timestamp"]
    new = last_write_wins(changes)
    return new.unionByName(current.join(new.select(*key), key, "left_anti"))


def record_key(df: DataFrame) -> Column:
    """The record's uuid, or a key made of topic, identity and time for devices that send none."""
    made = F.concat_ws("|", F.col("mqtt_topic"), F.col("identity").cast("string"),
                       F.unix_micros("timestamp").cast("string"))
    return F.coalesce(F.col("record_uuid"), made) if "record_uuid" in df.columns else made


def _first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def cold_rows(raw: DataFrame, processed: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """Raw records with what processing found out: status, weight, tare, time and batch.

    Joined on ``record_uuid`` by plain equality; of repeated uuids the processed record with the highest identity is
    used, so no raw record is multiplied.  Raw records that were not processed keep nulls and their own time.
    """
    from weighline.operators.enrich import map_articles
    want = {"quality_status": "processed_status", "clean_net_weight_g": "calculated_net_weight", "tare_g": "tare_g",
            "timestamp": "processed_time", "batch_instance_id": "batch_instance_id",
            "batch_sequence": "batch_sequence", "batch_start_time": "batch_start_time"}
    have = {k: v for k, v in want.items() if k in processed.columns}
    one = _first_per_key(processed.where("record_uuid is not null"), "record_uuid",
                         [F.desc("identity"), F.desc("timestamp")])
    right = one.select("record_uuid", F.lit(0).alias("_spread"), *[F.col(k).alias(v) for k, v in have.items()])
    left = raw.drop(*[v for v in have.values() if v in raw.columns])
    # records without uuid match nothing; they are dealt over the tasks instead of meeting under one null key
    spread = F.when(F.col("record_uuid").isNull(), F.pmod(F.xxhash64("identity", "timestamp"), F.lit(KEYLESS_SHARES))).otherwise(0)
    out = left.withColumn("_spread", spread.cast("int")).join(right, ["record_uuid", "_spread"], "left").drop("_spread")
    if "processed_time" in out.columns:
        out = out.withColumn("timestamp", F.coalesce("processed_time", "timestamp")).drop("processed_time")
    return out if articles is None else map_articles(out, articles, unknown=S.UNKNOWN_REF)


def archive_rows(df: DataFrame) -> DataFrame:
    """Archive rows of processed records that carry the record as it was sent (``raw``: :data:`weighline.sources.raw.SENT`).

    The sent texts keep their canonical names; beside them stand what was found out: time, status, weight, tare, headcount,
    batch and article name.  The record travels with its result, so no key is needed and no row can be multiplied.
    """
    sent = [f.name for f in df.schema["raw"].dataType.fields]
    found = {"timestamp": F.col("timestamp"), "processed_status": F.col("quality_status"),
             "calculated_net_weight": F.col("clean_net_weight_g"), "tare_g": F.col("tare_g"),
             "active_workers": F.col("active_workers"),
             "number_refactor": F.when(F.col("article_known"), F.col("number_refactor")).otherwise(S.UNKNOWN_REF),
             **{n: F.col(n) for n in ("batch_instance_id", "batch_sequence", "batch_start_time")}}
    named = {"timestamp": "timestamp_text", "tare_g": "tare_text", "active_workers": "workers_text"}
    return df.select(*[F.col(f"raw.{n}").alias(named.get(n, n)) for n in sent], *[c.alias(n) for n, c in found.items()])


def cold_semi(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """Raw records whose key survived cleaning and dedup."""
    return (raw.withColumn("_key", record_key(raw))
            .join(kept.select(record_key(kept).alias("_key")), "_key", "left_semi").drop("_key"))


def cold_paths(df: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Archive folder of every record: topic, line, local date, article and batch."""
    have = set(df.columns)

    def first(names: list[str], default: str) -> Column:
        found = [tx.clean_text(F.col(n)) for n in names if n in have]
        return F.coalesce(*found, F.lit(default))

    topic = tx.topic_folder(F.col("mqtt_topic"))
    line = (F.coalesce(tx.clean_text(F.col("linea")), tx.last_segment(F.col("mqtt_topic")), F.lit("Unknown_Line"))
            if "linea" in have else F.coalesce(tx.last_segment(F.col("mqtt_topic")), F.lit("Unknown_Line")))
    article = tx.safe_article(first(["number_refactor", "article_name"], "Unknown_article"))
    batch = F.col("batch_instance_id").cast("string") if "batch_instance_id" in have else F.lit(None).cast("string")
    safe = F.coalesce(F.nullif(tx.safe_batch(batch), F.lit("")), F.lit("UNKNOWN_BATCH"))
    day = times.local(F.col("timestamp"), zone)
    out = (df.withColumn("p_topic", topic).withColumn("p_line", line)
           .withColumn("p_year", F.date_format(day, "yyyy")).withColumn("p_month", F.date_format(day, "MM"))
           .withColumn("p_day", F.date_format(day, "dd")).withColumn("p_article", article)
           .withColumn("p_batch", safe))
    return out.withColumn("folder", F.concat_ws("/", F.lit("packaging"), "p_topic", "p_line", "p_year", "p_month",
                                                "p_day", "p_article", "p_batch"))


def archive_manifest(df: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """One row per archive folder: rows, columns, file name parts and tags."""
    have = set(df.columns)
    placed = cold_paths(df, zone)
    first = F.min(F.struct("timestamp", "identity",
                           (F.col("batch_code") if "batch_code" in have else F.lit(None).cast("string")).alias("b"),
                           (F.col("article_name") if "article_name" in have else F.lit(None).cast("string"))
                           .alias("a"), F.col("mqtt_topic").alias("t")))
    status = next((c for c in ("processed_status", "quality_status") if c in have), None)
    rejected = (F.bool_or(F.coalesce(F.col(status) == "REJECTED", F.lit(False)))
                if status else F.lit(None).cast("boolean"))
    flag = numbers.safe_double(F.col("reject_flag").cast("string")) if "reject_flag" in have else None
    hardware = F.bool_or(F.coalesce(flag == 1, F.lit(False))) if flag is not None else F.lit(False)
    g = placed.groupBy("folder").agg(first.alias("f"), F.count(F.lit(1)).alias("row_count"),
                                     F.max("timestamp").alias("last_time"), rejected.alias("rejected"),
                                     hardware.alias("hardware_reject"))
    status = F.when(F.col("rejected").isNull(), "RAW").when(F.col("rejected"), "WARNING").otherwise("OK")
    batch = F.regexp_replace(F.coalesce("f.b", F.lit("NoBatch")), "[^a-zA-Z0-9_-]", "")
    product = F.substring(F.regexp_replace(F.coalesce("f.a", F.lit("UnknownProd")), "[^a-zA-Z0-9]", ""), 1, 20)
    clock = F.date_format("last_time", "HHmmss")
    return g.select(
        "folder", "row_count", F.lit(len(df.columns)).alias("column_count"),
        F.concat(clock, F.lit("_"), batch, F.lit("_"), product, F.lit("_"), status, F.lit(".csv")).alias("file_name"),
        F.substring(F.replace(F.coalesce("f.b", F.lit("Unknown")), F.lit("/"), F.lit("-")), 1, 128).alias("tag_batch"),
        F.when(F.col("rejected"), "WARNING").otherwise("OK").alias("tag_quality"),
        F.when(F.col("hardware_reject"), "TRUE").alias("tag_hardware_reject"),
        tx.topic_folder(F.col("f.t")).alias("tag_line"))


def write_summary(hot: DataFrame, names_up_to: int = 3) -> DataFrame:
    """Per topic: rows, rejects, line names, batches (names up to ``names_up_to``, else their number), identity range.

    The hot rows are read once, into one row per (topic, line, batch); names are collected from distinct lines and from
    at most ``names_up_to`` batches per topic.
    """
    parts = materialize(hot.groupBy("mqtt_topic", "linea", "batch_instance_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality_status") == "REJECTED").alias("r"),
        F.min("identity").alias("low"), F.max("identity").alias("high")), "summary")
    base = parts.groupBy("mqtt_topic").agg(
        F.sum("n").alias("records"), F.sum("r").alias("rejects"), F.min("low").alias("min_identity"),
        F.max("high").alias("max_identity"))
    names = lambda col: F.array_join(F.array_sort(F.collect_list(col)), ",")
    lines = parts.select("mqtt_topic", "linea").distinct().groupBy("mqtt_topic").agg(names("linea").alias("lines"))
    distinct = parts.select("mqtt_topic", "batch_instance_id").distinct()
    w = Window.partitionBy("mqtt_topic").orderBy("batch_instance_id")
    few = (distinct.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= names_up_to)
           .groupBy("mqtt_topic").agg(names("batch_instance_id").alias("_names")))
    total = distinct.groupBy("mqtt_topic").agg(F.count(F.lit(1)).alias("batch_count"))
    text = F.when(F.col("batch_count") > names_up_to,
                  F.concat(F.col("batch_count").cast("string"), F.lit(" batches"))).otherwise(F.col("_names"))
    return (base.join(lines, "mqtt_topic").join(total, "mqtt_topic").join(few, "mqtt_topic")
            .withColumn("batches", text).drop("_names"))
