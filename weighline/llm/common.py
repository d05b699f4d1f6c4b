"""Helpers shared by the training-data operators: inputs, scratch tables, Arrow batches, sizes."""

from __future__ import annotations

import hashlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weighline.session import materialize, shared_dir

#: Rows of one Arrow batch handed to Python; texts may be long, so few.
BATCH_ROWS = 500


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    """The text; null reads as empty."""
    return F.coalesce(F.col(col), F.lit(""))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application; Spark copies it to them from the driver."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str,
              rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with batches of few rows, so that a task's memory does not follow the longest partition.  More ``rows``
    for small ones only; Spark reads the number when the frame is run, so run it before another is made."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(fn, schema)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def rebatch(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` or a little more, for small rows that are worked on in bulk."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    return materialize(df, f"llm-{name}")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place."""
    return f"{shared_dir(spark)}/weighline/llm-{name}-{uuid.uuid4().hex}"


def partitions_for(spark: SparkSession, amount: float, per_partition: float) -> int:
    """Partitions so that each holds about ``per_partition``, and no fewer than the session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, int(-(-amount // per_partition)))


def one_each(marked: DataFrame, found: DataFrame, same: Column, key: list[str], columns: list[str]) -> DataFrame:
    """Rows of ``marked`` that ``found`` names, one for each ``key``.  The join has already brought a key's rows together,
    so the second step needs no further shuffle."""
    return marked.join(found, same, "left_semi").dropDuplicates(key).select(*columns)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (xor-shift and multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
