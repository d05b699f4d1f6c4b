"""Tables as portable JSON lines, with times a person in the factory can read.

Times are local, to the microsecond, with their offset from UTC, so that both hours of the night when clocks go back stay
apart: ``2024-10-27T02:30:00.000000+02:00`` and ``...+01:00``.  Nulls are written.  Reading gives the same rows and types;
a line that is no object of these columns, or holds a time that cannot be read, is an error instead of an empty state.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weighline import settings as S
from weighline.functions import times

_SCHEMA = "table_schema"


def offset_text(ts: Column, zone: str = S.FACTORY_ZONE) -> Column:
    """Local time with its offset from UTC."""
    local = times.local(ts, zone)
    minutes = F.floor((times.micros(local) - times.micros(ts)) / F.lit(60_000_000))
    size = F.abs(minutes)
    clock = F.format_string("%02d:%02d", F.floor(size / 60), size % 60)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.when(minutes < 0, "-").otherwise("+"), clock)


def from_offset_text(text: Column) -> Column:
    """Inverse of :func:`offset_text`."""
    return text.cast("timestamp")


def _written(col: Column, kind: T.DataType, zone: str) -> Column:
    if isinstance(kind, T.TimestampType):
        return offset_text(col, zone)
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[_written(col[f.name], f.dataType, zone).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _written(x, kind.elementType, zone))
    return col


def _read(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return from_offset_text(col)
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[_read(col[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _read(x, kind.elementType))
    return col


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.TimestampType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return kind


def encode(df: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """One JSON object per row, in the column ``line``."""
    cols = [_written(F.col(f.name), f.dataType, zone).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("line"))


def decode(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of :func:`encode`."""
    row = F.from_json("line", _as_text(schema), {"mode": "FAILFAST"})
    return lines.select(row.alias("r")).select(*[_read(F.col("r")[f.name], f.dataType).alias(f.name) for f in schema.fields])


def write(df: DataFrame, folder: str, zone: str = S.FACTORY_ZONE) -> None:
    """``folder/lines`` holds the rows, ``folder/table_schema`` their types, written last."""
    encode(df, zone).write.mode("overwrite").text(f"{folder}/lines")
    schema = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    schema.coalesce(1).write.mode("overwrite").text(f"{folder}/{_SCHEMA}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{folder}/{_SCHEMA}").first()[0]))
    return decode(spark.read.text(f"{folder}/lines").withColumnRenamed("value", "line"), schema)
