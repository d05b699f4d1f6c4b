"""Weighing records derived from the generic test tables (see FIXTURES.md section 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ARTICLES = {"description": "codes to names", "default": "UNKNOWN_PRODUCT",
            "mappings": {"A-100": "Alpha Mix", "A-101": "Beta Mix", "A-102": "Gamma (Mix)", "A-103": "Delta/Mix"}}
TARGETS = {"A-100": 55.5, "A-101": "Not a Number", "view": 120.0, "click": 80.25, "default": 15.0}
WORKERS = {"Line_00": 4, "Line_01": 8, "Line_02": 250, "Line_03": "x"}
CONTACTS = {
    "default": {"recipients": [{"name": "Duty", "email": "duty@plant.example"}]},
    "topics": {
        "factory/zone_0/Line_00": {"recipients": [{"name": "Ana", "email": "ana@plant.example"},
                                                  {"name": "Luis", "email": "luis@plant.example"}]},
        "factory/zone_0/Line_02": {"recipients": [{"name": "Nobody", "email": ""}]},
        "factory/zone_1": {"email": "zone1@plant.example", "name": "Zone"},
    },
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with ``ts`` as a UTC instant."""
    return (spark.read.parquet(f"{sf_dir}/events.parquet")
            .withColumn("ts", F.col("ts").cast("timestamp")))


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def weighings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records: the columns every line sends."""
    e = events(spark, sf_dir)
    return e.select(
        F.col("event_id").alias("identity"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("factory/zone_"), F.col("user_id") % 2).alias("mqtt_topic"),
        F.concat(F.lit("Line_"), F.lpad((F.col("user_id") % 6).cast("string"), 2, "0")).alias("linea"),
        F.concat(F.lit("A-10"), F.floor(F.col("event_id") / 50) % 5).alias("article_number"),
        F.col("event_type").alias("article_name"),
        F.col("value").alias("net_weight"),
        F.when(_k() % 10 == 0, 1).otherwise(0).alias("reject_flag"),
        F.concat(F.lit("uuid-"), F.col("event_id")).alias("record_uuid"),
        F.concat(F.lit("B/"), F.floor(F.col("event_id") / 500)).alias("batch_code"),
        F.timestamp_micros(F.unix_micros("ts") + (_k() * 20).cast("bigint") * F.lit(1_000_000)).alias("server_time"),
    )


def lineitem_weighings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A longer history (years, twelve lines) from the lineitem table, already with article names."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    identity = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    at = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + (identity % 86400) * F.lit(1_000_000)
    return li.select(
        identity.alias("identity"), F.timestamp_micros(at).alias("timestamp"),
        F.concat(F.lit("factory/zone_"), F.col("l_suppkey") % 2).alias("mqtt_topic"),
        F.concat(F.lit("Line_"), F.floor(F.col("l_suppkey") / 2) % 6).alias("linea"),
        F.concat(F.lit("P-"), F.col("l_partkey") % 3).alias("number_refactor"),
        (F.col("l_quantity") / 100 * 1000).alias("clean_net_weight_g"),
        F.when(F.col("l_returnflag") == "R", "REJECTED").otherwise("OK").alias("quality_status"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON text in the shapes devices send them, including broken ones.

    ``event_id`` decides the shape: every 20th is truncated, another 20th is not an object, the rest use canonical
    names, device names with decimal commas, or a nested ``values`` object; every 7th object is sent as an array.
    """
    e = events(spark, sf_dir)
    i = F.col("event_id")
    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    line = F.concat(F.lit("Line_"), F.lpad((F.col("user_id") % 6).cast("string"), 2, "0"))
    art = F.concat(F.lit("A-10"), F.floor(i / 50) % 5)
    kind = F.col("event_type")
    w = F.col("value").cast("decimal(12,2)").cast("string")
    t = (F.when(i % 11 == 0, F.lit("25:99"))
         .when(i % 5 == 0, F.date_format("ts", "HH:mm"))
         .when(i % 5 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    canonical = text('{"identity": ', i, ', "timestamp": "', t, '", "net_weight": ',
                     F.when(i % 17 == 0, F.lit('"sensor_error"')).otherwise(w), ', "article_name": "', kind,
                     '", "article_number": "', art, '", "linea": "', line,
                     '", "quality_status": " ok ", "mqtt_topic": "factory/own"}')
    device = text('{"Identity": "', i, '", "Timestamp": "', t, '", "ActualNetWeightValue": "',
                  F.replace(w, F.lit("."), F.lit(",")), '", "ArticleName": "', kind, '", "ArticleNumber": "', art,
                  '", "DeviceName": "', line, '", "Reject": ', _k() % 2, ', "Id": "uuid-', i, '"}')
    nested = text('{"values": {"Identity": ', i, ', "Fecha": "', t, '", "Peso": "', w, '"}, "values.Producto": "', kind,
                  '", "ItemCode": "', art, '", "Source": "', line, '"}')
    obj = F.when(i % 3 == 0, canonical).when(i % 3 == 1, device).otherwise(nested)
    payload = (F.when(i % 20 == 3, F.expr("substring('{\"identity\": 12345, \"net', 1, 5 + cast(event_id % 10 as int))"))
               .when(i % 20 == 8, F.lit("[1,2]"))
               .when(i % 7 == 0, F.concat(F.lit("["), obj, F.lit(", "), obj, F.lit("]")))
               .otherwise(obj))
    return e.select(
        F.when(i % 13 == 0, F.lit("office/hvac")).when(i % 13 == 1, F.lit("factory"))
        .otherwise(F.concat(F.lit("factory/zone_"), F.col("user_id") % 2)).alias("topic"),
        payload.alias("payload"),
        F.timestamp_micros(F.unix_micros("ts") + F.lit(5_000_000)).alias("received_at"),
        (i % 4).cast("int").alias("attempts"),
        i.alias("event_id"),
    )
