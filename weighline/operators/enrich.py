"""Lookups: headcount, target weight and article names.

Each lookup is counted and broadcast only while small; a larger one joins by shuffle with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weighline import settings as S
from weighline.functions import numbers
from weighline.functions.text import clean_text
from weighline.operators.slices import sized
from weighline.sources.lookups import default_workers


def _one(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key, so that a repeated key cannot multiply records."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def _sized_lookup(df: DataFrame, key: str, value: str, default: Column):
    """The lookup reduced to one row per key, its number of rows and its default entry, counted in one job."""
    rows, entry = df.agg(F.count(F.lit(1)), F.max(F.when(default, F.col(value)))).first()
    return _one(df, key, value), rows, entry


def enrich_workers(df: DataFrame, workers: DataFrame, defaults: DataFrame | None = None,
                   max_workers: int = S.MAX_WORKERS_PER_LINE) -> DataFrame:
    """``active_workers`` by line: configured, else the line's default, else the general default, else 1."""
    spark = df.sparkSession
    if defaults is None:
        defaults = default_workers(spark)
    is_default = F.col("line_id") == "default"
    conf, n_conf, _ = _sized_lookup(workers, "line_id", "workers", is_default)
    base, n_base, general = _sized_lookup(defaults, "line_id", "workers", is_default)
    general = general or "1"
    conf = conf.withColumnsRenamed({"line_id": "_k", "workers": "_conf"})
    base = base.withColumnsRenamed({"line_id": "_k", "workers": "_base"})
    found = (df.withColumn("_k", clean_text(F.col("linea")))
             .join(sized(conf, n_conf), "_k", "left").join(sized(base, n_base), "_k", "left"))
    text = F.coalesce("_conf", "_base", F.lit(general))
    count = F.coalesce(numbers.safe_bigint(text), F.lit(1).cast("bigint"))
    return (found.withColumn("active_workers", F.least(count, F.lit(max_workers)).cast("int"))
            .drop("_k", "_conf", "_base"))


def enrich_targets(df: DataFrame, targets: DataFrame) -> DataFrame:
    """``target_value`` by article number, else article name, else the default entry, else 0.

    An entry that is found but is not a number counts as 0.
    """
    by, rows, general = _sized_lookup(targets, "product_key", "target", F.col("product_key") == "default")
    general = numbers_or_zero(general)
    number = by.withColumnsRenamed({"product_key": "_n", "target": "_by_number"})
    name = by.withColumnsRenamed({"product_key": "_a", "target": "_by_name"})
    found = (df.withColumn("_n", clean_text(F.col("article_number"))).withColumn("_a", clean_text(F.col("article_name")))
             .join(sized(number, rows), "_n", "left").join(sized(name, rows), "_a", "left"))
    text = F.coalesce("_by_number", "_by_name")
    value = F.when(text.isNull(), F.lit(general)).otherwise(F.coalesce(numbers.safe_double(text), F.lit(0.0)))
    return found.withColumn("target_value", value).drop("_n", "_a", "_by_number", "_by_name")


def numbers_or_zero(text: str | None) -> float:
    try:
        return float(text) if text is not None else 0.0
    except ValueError:
        return 0.0


def target_for(keys: DataFrame, targets: DataFrame, key: str = "product_key") -> DataFrame:
    """Target text of single products: the entry, else the default entry, else 0."""
    by, rows, general = _sized_lookup(targets, "product_key", "target", F.col("product_key") == "default")
    by = by.withColumnsRenamed({"product_key": "_t"})
    return (keys.withColumn("_t", clean_text(F.col(key))).join(sized(by, rows), "_t", "left")
            .withColumn("target", F.coalesce("target", F.lit(general or "0.0"))).drop("_t"))


def map_articles(df: DataFrame, articles: DataFrame, target_col: str = "number_refactor",
                 unknown: str | None = None, found_col: str | None = None) -> DataFrame:
    """Article name of the trimmed article code; unmapped codes get the configured default, or ``unknown``.

    ``found_col`` names a column that tells whether the code was mapped.
    """
    codes, rows, default = _sized_lookup(articles, "article_code", "mapped_name", F.col("article_code").isNull())
    codes = codes.withColumnsRenamed({"article_code": "_c", "mapped_name": "_mapped"})
    fallback = unknown or default or S.UNKNOWN_ARTICLE
    found = df.withColumn("_c", clean_text(F.col("article_number"))).join(sized(codes, rows), "_c", "left")
    if found_col:
        found = found.withColumn(found_col, F.col("_mapped").isNotNull())
    return (found.withColumn(target_col, F.coalesce("_mapped", F.lit(fallback))).drop("_c", "_mapped"))


def giveaway(df: DataFrame) -> DataFrame:
    """``target_weight_g`` and ``giveaway_g`` from the target lookup, and whether status and reject flag disagree."""
    mismatch = (F.col("quality_status") == "OK") != (F.coalesce("reject_flag", F.lit(0.0)) == 0)
    return (df.withColumn("target_weight_g", F.col("target_value"))
            .withColumn("giveaway_g", F.col("clean_net_weight_g") - F.col("target_value"))
            .withColumn("quality_mismatch", mismatch.cast("int")))


def workers_updates(updates: DataFrame, max_workers: int = S.MAX_WORKERS_PER_LINE) -> DataFrame:
    """Headcount updates ``(line_id, workers)`` (text) with ``accepted`` and the reason of a refusal."""
    count = numbers.safe_double(F.col("workers"))
    whole = count.try_cast("bigint")
    reason = (F.when(F.col("line_id").isNull() | F.col("workers").isNull(), "missing_field")
              .when(~F.col("line_id").rlike(S.LINE_ID_PATTERN), "bad_line_id")
              .when(whole.isNull() | (whole != count), "bad_number")
              .when(~whole.between(0, max_workers), "out_of_range"))
    return (updates.withColumn("reason", reason).withColumn("accepted", reason.isNull())
            .withColumn("new_worker_count", F.when(F.col("accepted"), whole.cast("int"))))


def with_updates(workers: DataFrame, log: DataFrame) -> DataFrame:
    """The headcount table after the changes of the log: a line's newest change takes the place of its entry."""
    newest = workers_latest(log).select("line_id", F.col("workers").cast("string").alias("workers"))
    both = (workers.select("line_id", "workers", F.lit(0).alias("_by")).unionByName(newest.withColumn("_by", F.lit(1))))
    return both.groupBy("line_id").agg(F.max_by("workers", "_by").alias("workers"))


def worker_log(accepted: DataFrame) -> DataFrame:
    """Rows of the change log: ``timestamp, line_id, new_worker_count, event``."""
    return accepted.select("timestamp", "line_id", "new_worker_count", F.lit("WORKER_UPDATE").alias("event"))


def workers_latest(log: DataFrame) -> DataFrame:
    """Current headcount per line from the change log; of simultaneous entries the higher count stays."""
    return (log.groupBy("line_id").agg(F.max(F.struct("timestamp", "new_worker_count")).alias("l"),
                                       F.count(F.lit(1)).alias("changes"))
            .select("line_id", F.col("l.new_worker_count").alias("workers"),
                    F.col("l.timestamp").alias("changed_at"), "changes"))
