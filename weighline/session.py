"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_default: str | None = None
_run: ContextVar[str] = ContextVar("run", default="kept")


def build_session(app_name: str = "weighline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on.  ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Local-time rules are written for a UTC session; refuse to give wrong answers under any other zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"weighline needs spark.sql.session.timeZone=UTC, found {zone!r}")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local masters that name none."""
    global _local_default
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_default is None:
        _local_default = tempfile.mkdtemp(prefix="weighline-")
    return _local_default


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return a scan of it.

    Used where a small derived table feeds several branches: the expensive shuffle below it runs once, the lineage
    is cut, and lost executors re-read files instead of recomputing the scan.
    """
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark)}/weighline/{_run.get()}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """What :func:`materialize` writes inside goes to a folder of its own, which is deleted at the end."""
    run = f"run-{uuid.uuid4().hex}"
    token = _run.set(run)
    try:
        yield
    finally:
        _run.reset(token)
        remove(f"{shared_dir(spark)}/weighline/{run}")


def remove(path: str) -> bool:
    """Delete a folder of a store that pyarrow reaches; elsewhere the store's own retention rule has to."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs
    local = path.removeprefix("file:") if path.startswith("file:") else path
    try:
        store, place = ((fs.LocalFileSystem(), os.path.normpath(local)) if "://" not in local else fs.FileSystem.from_uri(path))
        store.delete_dir(place)
    except (OSError, ArrowInvalid, ArrowNotImplementedError):
        return False
    return True
