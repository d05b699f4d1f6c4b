"""Small lookup tables read from their JSON files, or given as plain dictionaries."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from weighline import settings as S


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def _read(col, schema: str):
    """The parsed document; a text that is no such document fails the query instead of reading as nothing."""
    parsed = F.from_json(col, schema)
    bad = F.try_parse_json(col).isNull() | parsed.isNull()
    return F.when(~bad, parsed).otherwise(F.raise_error(F.lit("a lookup file is not a JSON document of the expected form")))


def _entries(df: DataFrame, json_col, key: str, value: str) -> DataFrame:
    return (df.select(F.explode(F.map_entries(_read(json_col, "map<string,string>"))).alias("e"))
            .select(F.btrim("e.key").alias(key), F.col("e.value").alias(value))
            .dropDuplicates([key]))


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of text literals, built without Python workers."""
    items = [F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*items)))


def dim_workers(spark: SparkSession, source) -> DataFrame:
    """``line_id, workers`` from a JSON file ``{line: count}`` or a dictionary."""
    if isinstance(source, dict):
        rows = [(str(k).strip(), None if v is None else str(v)) for k, v in source.items()]
        return literal_rows(spark, rows, ["line_id", "workers"])
    return _entries(_text(spark, source), F.col("value"), "line_id", "workers")


def dim_targets(spark: SparkSession, source) -> DataFrame:
    """``product_key, target`` (text; the ``default`` entry stays a row)."""
    if isinstance(source, dict):
        rows = [(str(k).strip(), None if v is None else str(v)) for k, v in source.items()]
        return literal_rows(spark, rows, ["product_key", "target"])
    return _entries(_text(spark, source), F.col("value"), "product_key", "target")


def dim_articles(spark: SparkSession, source) -> DataFrame:
    """``article_code, mapped_name``; the configured default is the row whose code is null."""
    if isinstance(source, dict):
        rows = [(k, v) for k, v in source.get("mappings", {}).items()]
        rows.append((None, source.get("default", "UNKNOWN")))
        return literal_rows(spark, rows, ["article_code", "mapped_name"])
    doc = _text(spark, source).select(
        _read(F.col("value"), "default string, mappings map<string,string>").alias("d"))
    codes = (doc.select(F.explode(F.map_entries("d.mappings")).alias("e"))
             .select(F.col("e.key").alias("article_code"), F.col("e.value").alias("mapped_name")))
    default = doc.select(F.lit(None).cast("string").alias("article_code"),
                         F.coalesce("d.default", F.lit("UNKNOWN")).alias("mapped_name"))
    return codes.unionByName(default)


_CONFIG = "recipients array<struct<name: string, email: string>>, email string, name string"


def dim_contacts(spark: SparkSession, source) -> DataFrame:
    """``contact_topic, recipient_name, recipient_email``; the default contact has a null topic.

    A topic whose recipients all lack an address keeps one row without address, so it does not fall back.
    """
    if isinstance(source, dict):
        doc = literal_rows(spark, [(json.dumps(source),)], ["value"])
    else:
        doc = _text(spark, source)
    d = doc.select(_read(F.col("value"), f"default struct<{_struct(_CONFIG)}>, "
                                         f"topics map<string, struct<{_struct(_CONFIG)}>>").alias("d"))
    topics = (d.select(F.explode(F.map_entries("d.topics")).alias("e"))
              .select(F.col("e.key").alias("contact_topic"), F.col("e.value").alias("c")))
    default = d.where("d.default is not null").select(F.lit(None).cast("string").alias("contact_topic"),
                                                      F.col("d.default").alias("c"))
    legacy = F.when(F.col("c.email").isNotNull(),
                    F.array(F.struct(F.col("c.name").alias("name"), F.col("c.email").alias("email"))))
    people = F.when(F.size(F.coalesce("c.recipients", F.array())) > 0, F.col("c.recipients")).otherwise(legacy)
    return (topics.unionByName(default)
            .select("contact_topic", F.explode_outer(people).alias("r"))
            .select("contact_topic", F.col("r.name").alias("recipient_name"),
                    F.col("r.email").alias("recipient_email")))


def _struct(ddl: str) -> str:
    """``a string, b int`` to the ``a: string, b: int`` form used inside ``struct<>``."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = ddl[start:i].strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            start = i + 1
    return ", ".join(out)


def reload(reader, spark: SparkSession, source, last_good: DataFrame | None) -> DataFrame:
    """Read a lookup again; keep the last good copy when the file is missing or unreadable."""
    try:
        fresh = reader(spark, source)
        fresh.count()  # a broken file fails here, not in the middle of a run
        return fresh
    except Exception:
        if last_good is None:
            raise
        return last_good


def _content(df: DataFrame) -> tuple:
    """Number of rows and an order-free digest of them."""
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())


def keep_good(spark: SparkSession, reader, source, path: str) -> DataFrame:
    """The lookup, or its newest copy under ``path`` when it cannot be read; a changed lookup is stored there.

    Copies are appended with a number, so a reader of an older copy is never disturbed and a restart finds the newest.
    """
    try:
        stored = spark.read.parquet(path)
        newest = stored.agg(F.max("copy")).first()[0]
        last = stored.where(F.col("copy") == newest).drop("copy")
    except AnalysisException:
        newest, last = -1, None
    fresh = reload(reader, spark, source, last)
    if fresh is last:
        return last
    if last is None or _content(fresh) != _content(last):
        fresh.withColumn("copy", F.lit(newest + 1)).coalesce(1).write.mode("append").parquet(path)
    return fresh


def default_workers(spark: SparkSession) -> DataFrame:
    return dim_workers(spark, S.DEFAULT_WORKERS)
