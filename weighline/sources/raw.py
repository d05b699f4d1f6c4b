"""Raw messages: file and stream scans, topic subscription, JSON parsing and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weighline import settings as S
from weighline.functions import text as tx

RAW_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("attempts", T.IntegerType()),
])


def _source_names() -> list[str]:
    """Every field name a device may send, each once."""
    names = [n for canonical, aliases in S.ALIASES.items() for n in [canonical, *aliases]] + S.PLAIN_COLUMNS
    return list(dict.fromkeys(names))


NAMES = _source_names()
_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in NAMES])
_RECORDS = T.ArrayType(T.StructType([*_FIELDS.fields, T.StructField("values", _FIELDS)]))


#: Columns of :func:`parse_all` that hold a record as it was sent: text under canonical names.
SENT = ["mqtt_topic", *["server_time_text" if n == "serverTime" else n for n in S.ALIASES], "quality_status", "tare_g", "creation_utc_text"]


def load_raw(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed messages ``(topic, payload, received_at, attempts)`` as a batch scan with a fixed schema."""
    return spark.read.format(fmt).schema(RAW_SCHEMA).load(path)


def stream_raw(spark: SparkSession, path: str, fmt: str = "json", max_files: int = 100) -> DataFrame:
    """The same feed as a file stream; ``max_files`` bounds a micro-batch without dropping anything."""
    return (spark.readStream.format(fmt).schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files).load(path))


def topic_matches(topic: Column, pattern: str = S.TOPIC_FILTER) -> Column:
    if pattern.endswith("/#") and "+" not in pattern and pattern.count("#") == 1:
        base = pattern[:-2]
        return (topic == base) | topic.startswith(base + "/")
    return topic.rlike(tx.topic_regex(pattern))


def subscribe(raw: DataFrame, pattern: str = S.TOPIC_FILTER) -> DataFrame:
    return raw.where(topic_matches(F.col("topic"), pattern))


def _body() -> Column:
    return F.col("payload").cast("string")


def _wrapped() -> Column:
    """The payload as a JSON array: a lone object gets brackets."""
    trimmed = F.btrim(_body(), F.lit(" \t\r\n"))
    return F.when(trimmed.startswith("[") | (trimmed == ""), trimmed).otherwise(F.concat(F.lit("["), trimmed, F.lit("]")))


#: Names and strings need double quotes, as in every JSON standard.
_JSON = {"allowSingleQuotes": "false"}


def _objects(shape: T.DataType | str) -> Column:
    """The payload's objects, or null when it is not JSON or holds anything but objects.

    ``values.`` is removed from dotted key names first.
    """
    text = _wrapped()
    plain = F.when(text.contains('"values.'), F.regexp_replace(text, r'(?<!\\)"values\.([^"]*)"(\s*:)', '"$1"$2'))
    return F.from_json(F.coalesce(plain, text), shape, _JSON)


def _read(raw: DataFrame, shape: T.DataType | str) -> DataFrame:
    """Every message with its text, its objects (``_records``) and why it is unusable (``dead_reason``).

    The objects come out of a generator of one row, so that filters and later columns use them as a column instead of
    each parsing the payload again.
    """
    parsed = raw.select("topic", "received_at", "attempts", "payload",
                        F.inline_outer(F.array(F.struct(_objects(shape).alias("_records")))))
    return parsed.select("topic", "received_at", "attempts", _body().alias("data"), rejection(F.col("_records")).alias("dead_reason"), "_records")


def rejection(records: Column) -> Column:
    """Why a payload is unusable; null for one whose ``records`` were read."""
    body = _body()
    bad_text = body.isNull() | ~F.is_valid_utf8(body)
    usable = records.isNotNull() & ~(body.contains("null") & F.exists(records, lambda r: r.isNull()))
    bad_json = F.try_parse_json(body).isNull() | F.try_parse_json(_wrapped()).isNull()
    return (F.when(bad_text, "encoding_error").when(F.coalesce(usable, F.lit(False)), F.lit(None).cast("string"))
            .when(bad_json, "json_decode_error").otherwise("not_an_object"))


def parse_all(raw: DataFrame) -> DataFrame:
    """One row per record in canonical text columns, and one row with ``dead_reason`` per unusable payload.

    The payload is read once; ``data`` is its text.  Names are chosen row by row: the canonical name first, then its
    aliases in order, then the same inside a nested ``values`` object.  Columns are addressed by position because devices
    use names that differ only in case.
    """
    ahead = ["topic", "received_at", "attempts", "data", "dead_reason"]
    # an empty list is a usable payload without records
    read = _read(raw, _RECORDS).where(F.col("dead_reason").isNotNull() | (F.size("_records") > 0))
    flat = read.select(*ahead, F.inline_outer(F.when(F.col("dead_reason").isNull(), F.col("_records"))))
    top = [f"f{i}" for i in range(len(NAMES))]
    inner = [f"v{i}" for i in range(len(NAMES))]
    flat = flat.toDF(*ahead, *top, "nested")
    both = flat.select("*", F.inline_outer(F.array("nested"))).toDF(*flat.columns, *inner)

    def pick(names: list[str]) -> Column:
        at = [NAMES.index(n) for n in names]
        return F.coalesce(*[F.col(top[i]) for i in at], *[F.col(inner[i]) for i in at])

    out = []
    for name, aliases in S.ALIASES.items():
        names = list(dict.fromkeys([name, *aliases]))
        if name == "linea":
            names = list(dict.fromkeys(["DeviceName", "linea", "device_name", *names, "device_id"]))
        out.append(pick(names).alias("server_time_text" if name == "serverTime" else name))
    return both.select(
        "topic", F.coalesce(pick(["mqtt_topic"]), F.col("topic")).alias("mqtt_topic"), "received_at", "attempts", "data",
        "dead_reason", *out, pick(["quality_status"]).alias("quality_status"), pick(["tare_g"]).alias("tare_g"),
        pick(["CreationDateUtc"]).alias("creation_utc_text"))


def parse(raw: DataFrame) -> DataFrame:
    """The records of :func:`parse_all`.  Unusable payloads go to :func:`dead_letters`."""
    return parse_all(raw).where("dead_reason IS NULL").drop("topic", "data", "dead_reason")


def letters_of(parsed: DataFrame) -> DataFrame:
    """The dead letters among rows of :func:`parse_all`: ``timestamp, topic, reason, data``."""
    return (parsed.where("dead_reason IS NOT NULL")
            .select(F.col("received_at").alias("timestamp"), "topic", F.col("dead_reason").alias("reason"), "data"))


def dead_letters(raw: DataFrame) -> DataFrame:
    """Rejected payloads: ``timestamp, topic, reason, data``.  Only the shape matters here, so one field is enough to read."""
    return letters_of(_read(raw, "array<struct<identity: string>>"))


def retry_split(failed: DataFrame, max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """Failed messages with one more attempt and their ``action``: ``retry`` or ``dead_letter``."""
    attempts = F.coalesce("attempts", F.lit(0)) + 1
    return (failed.withColumn("attempts", attempts.cast("int"))
            .withColumn("action", F.when(F.col("attempts") < max_retries, "retry").otherwise("dead_letter"))
            .withColumn("reason", F.when(F.col("action") == "dead_letter", "max_retries_exceeded")))


def requeue(failed: DataFrame, waiting: DataFrame, max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """The next input: messages to retry followed by those still waiting (``retried`` tells them apart)."""
    again = retry_split(failed, max_retries).where("action = 'retry'").drop("action", "reason")
    return (again.withColumn("retried", F.lit(True))
            .unionByName(waiting.withColumn("retried", F.lit(False))))
