"""Tables kept by UTC day: an epoch rewrites the days it touches and nothing else.

A day's rows lie in ``path/utc_date=D/epoch=N``, where N is the epoch that last changed the day.  ``path/_days/epoch=N``
names, after epoch N, the newest version of every day: one row per day.  A reader opens that list and then only the
folders of the days it wants, so the cost of reading a day does not depend on how many epochs there were.  Folders are
never changed in place: an epoch that is run again writes the same folders again, a reader of an earlier epoch still
finds its own, and an epoch that died half-way is in no list.  Versions that no kept epoch needs are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from weighline.session import materialize, remove

#: Epochs that can still be read or run again.
KEPT_EPOCHS = 10
_LIST = "utc_date date, version long"


class DayTable:
    """See the module.  Rows carry ``utc_date``; ``schema`` is that of the table without it (read from the files if None)."""

    def __init__(self, spark: SparkSession, path: str, schema=None):
        self.spark, self.path, self.schema = spark, path, schema

    def epochs(self) -> list[int]:
        """The epochs whose lists are kept, oldest first."""
        try:
            return sorted(r["epoch"] for r in self.spark.read.schema(_LIST + ", epoch long").parquet(f"{self.path}/_days").select("epoch").distinct().collect())
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def newest(self, below: int | None = None) -> int:
        """The newest epoch (before ``below``); -1 if there is none."""
        return max((e for e in self.epochs() if below is None or e < below), default=-1)

    def versions(self, epoch: int) -> dict:
        """Newest version of every day after ``epoch``; one entry per day."""
        if epoch < 0:
            return {}
        try:
            return {r["utc_date"]: r["version"] for r in self.spark.read.schema(_LIST).parquet(f"{self.path}/_days/epoch={epoch}").collect()}
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}

    def folder(self, day, version: int) -> str:
        return f"{self.path}/utc_date={day}/epoch={version}"

    def read(self, epoch: int, wanted: Callable[[object], bool] = lambda day: True) -> DataFrame:
        """The table after ``epoch``, of the days for which ``wanted`` holds."""
        return self._open({d: v for d, v in self.versions(epoch).items() if wanted(d)})

    def _open(self, versions: dict) -> DataFrame:
        paths = [self.folder(d, v) for d, v in sorted(versions.items())]
        if self.schema is None:
            if not paths:
                raise ValueError(f"{self.path} holds no rows of these days")
            return self.spark.read.option("basePath", self.path).parquet(*paths).drop("epoch")
        shape = self.spark.createDataFrame([], self.schema).withColumn("utc_date", F.lit(None).cast("date"))
        if not paths:
            return shape
        return self.spark.read.schema(shape.schema).option("basePath", self.path).parquet(*paths).select(shape.columns)

    def merge(self, epoch: int, changes: DataFrame, put: Callable[[DataFrame, DataFrame], DataFrame]) -> list:
        """Make version ``epoch`` of every day that ``changes`` touches: ``put(stored rows of those days, changes)``.

        Other days stay as the epoch before left them.  Returns the touched days.
        """
        changes = materialize(changes, "day-changes")
        days = [r["utc_date"] for r in changes.select("utc_date").distinct().collect()]
        known = self.versions(self.newest(epoch))
        if days:
            self._save(epoch, put(self._open({d: known[d] for d in days if d in known}), changes))
        self._list(epoch, known, days)
        return days

    def replace(self, epoch: int, rows: DataFrame, days: list) -> None:
        """Make version ``epoch`` of these days: ``rows`` are all they hold.  A day without rows is no longer listed."""
        if days:
            self._save(epoch, rows.where(F.col("utc_date").isin(days)))
        self._list(epoch, self.versions(self.newest(epoch)), days)

    def _save(self, epoch: int, rows: DataFrame) -> None:
        (rows.withColumn("epoch", F.lit(epoch).cast("long")).hint("rebalance", "utc_date").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("utc_date", "epoch").parquet(self.path))

    def _list(self, epoch: int, known: dict, days: list) -> None:
        now = {d: v for d, v in known.items() if d not in days} | {d: epoch for d in days if self._has(self.folder(d, epoch))}
        (self.spark.createDataFrame(sorted(now.items()), _LIST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_days/epoch={epoch}"))
        self._forget()

    def _has(self, path: str) -> bool:
        try:
            self.spark.read.schema("epoch long").parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def _forget(self) -> None:
        """Delete the lists beyond the kept ones, and the versions that the next list after them replaced."""
        epochs = self.epochs()
        for epoch, after in list(zip(epochs, epochs[1:]))[:-KEPT_EPOCHS]:
            following = self.versions(after)
            for day, version in self.versions(epoch).items():
                if following.get(day) != version:
                    remove(self.folder(day, version))
            remove(f"{self.path}/_days/epoch={epoch}")


def replace_by(key: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge in which changed rows take the place of stored ones with the same key (nulls equal nulls)."""
    def merge(stored: DataFrame, changes: DataFrame) -> DataFrame:
        new = changes.select(*[F.col(k).alias(f"_{k}") for k in key])
        same = None
        for k in key:
            one = F.col(k).eqNullSafe(F.col(f"_{k}"))
            same = one if same is None else same & one
        return changes.unionByName(stored.join(new, same, "left_anti"))

    return merge
