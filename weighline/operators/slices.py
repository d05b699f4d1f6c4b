"""Ordered computations over long histories without giving one key to one task.

A line's (or topic's) records are cut into short time slices.  Work inside a slice is an ordinary window; what has to
cross a slice border travels in a small table with one row per non-empty slice.  Slices start as fixed widths
(one minute) and only those holding more than ``target`` rows are cut finer, down to a microsecond, so one hot key
or one hot minute still spreads over many tasks.  The windows over slice tables are partitioned by day, and days are
linked in a second, even smaller table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from weighline import settings as S
from weighline.functions.times import DAY_MICROS, floor_micros
from weighline.session import materialize

FINER_MICROS = (1_000_000, 10_000, 100, 1)


def slice_of(us: Column, width_seconds: int = S.SLICE_SECONDS) -> Column:
    if 86_400 % width_seconds or width_seconds > 900:
        raise ValueError("slice width must divide a day and be at most 900 seconds")
    return floor_micros(us, width_seconds * 1_000_000)


def day_of(us: Column) -> Column:
    return (floor_micros(us, DAY_MICROS) / F.lit(DAY_MICROS)).cast("int")


def sized(df: DataFrame, rows: int, limit: int = S.BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a side whose counted rows stay below ``limit``; otherwise a shuffled join."""
    return F.broadcast(df) if rows <= limit else df


def only(rows: DataFrame, keep: DataFrame, key: list[str], n_keep: int, skewed: bool, salt_col: str,
         salts: int = 64, limit: int = S.BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is in ``keep``.

    A counted, small ``keep`` is broadcast.  Otherwise both sides are shuffled; when some key is known to hold very many
    rows, they are spread over ``salts`` parts of it and ``keep`` is repeated for each.
    """
    if n_keep <= limit:
        return rows.join(F.broadcast(keep), key, "left_semi")
    if not skewed:
        return rows.join(keep, key, "left_semi")
    salted = keep.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return (rows.withColumn("_salt", F.pmod(F.col(salt_col), F.lit(salts)))
            .join(salted, [*key, "_salt"], "left_semi").drop("_salt"))


@dataclass(frozen=True)
class Level:
    """Slices that were too full at one step, and the width they are cut to."""

    width: int
    hot: DataFrame
    rows: int


@dataclass(frozen=True)
class Slicing:
    keys: tuple[str, ...]
    width_seconds: int = S.SLICE_SECONDS
    levels: list[Level] = field(default_factory=list)

    def apply(self, df: DataFrame, us: Column, name: str = "slice_us") -> DataFrame:
        """Add the slice of every row, following each refinement."""
        out = df.withColumn(name, slice_of(us, self.width_seconds))
        for level in self.levels:
            out = _cut(out, level, list(self.keys), us, name)
        return out

    def renamed(self, names: dict[str, str], slice_name: str) -> "Slicing":
        """The same slicing for a table whose key columns have other names."""
        names = {**names, "slice_us": slice_name}
        return Slicing(tuple(names.get(k, k) for k in self.keys), self.width_seconds,
                       [Level(v.width, v.hot.withColumnsRenamed(names), v.rows) for v in self.levels])


def _cut(df: DataFrame, level: Level, keys: list[str], us: Column, name: str) -> DataFrame:
    marked = sized(level.hot.withColumn("_hot", F.lit(True)), level.rows)
    return (df.join(marked, [*keys, name], "left")
            .withColumn(name, F.when(F.col("_hot"), floor_micros(us, level.width)).otherwise(F.col(name)))
            .drop("_hot"))


def refine(df: DataFrame, keys: list[str], us_col: str, name: str = "slice_us",
           width_seconds: int = S.SLICE_SECONDS, target: int = S.SLICE_TARGET_ROWS) -> tuple[DataFrame, Slicing]:
    """Slice ``df`` and cut every slice above ``target`` rows finer, until none is (or a microsecond is reached).

    Each step is one map-side-combined count; with no full slice it stops after the first.
    """
    us = F.col(us_col)
    slicing = Slicing(tuple(keys), width_seconds)
    out = slicing.apply(df, us, name)
    for width in FINER_MICROS:
        if width >= width_seconds * 1_000_000:
            continue
        hot = (out.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > target).select(*keys, name))
        if hot.isEmpty():
            break
        hot = materialize(hot, "hot-slices")
        level = Level(width, hot, hot.count())
        slicing.levels.append(level)
        out = _cut(out, level, keys, us, name)
    return out, slicing


def link_slices(ends: DataFrame, keys: list[str], tail: list[str], head: list[str],
                name: str = "slice_us") -> DataFrame:
    """Add ``prev`` (struct of ``tail``) and ``next`` (struct of ``head``) of the neighbouring non-empty slices.

    ``ends`` has one row per (keys, slice).  Windows see one key-day of slices, then one key's days.
    """
    ends = ends.withColumn("_sday", day_of(F.col(name)))
    w = Window.partitionBy(*keys, "_sday").orderBy(name)
    near = (ends.withColumn("prev", F.lag(F.struct(*tail)).over(w))
            .withColumn("next", F.lead(F.struct(*head)).over(w)))
    days = ends.groupBy(*keys, "_sday").agg(
        F.max_by(F.struct(*tail), name).alias("_tail"), F.min_by(F.struct(*head), name).alias("_head"))
    wd = Window.partitionBy(*keys).orderBy("_sday")
    days = days.select(*keys, "_sday", F.lag("_tail").over(wd).alias("_prev"), F.lead("_head").over(wd).alias("_next"))
    return (near.join(days, [*keys, "_sday"])
            .withColumn("prev", F.coalesce("prev", "_prev"))
            .withColumn("next", F.coalesce("next", "_next"))
            .drop("_sday", "_prev", "_next"))


def prefix_sums(counts: DataFrame, keys: list[str], amount: str, out: str, name: str = "slice_us") -> DataFrame:
    """Add the total of ``amount`` over all earlier slices of the same key."""
    counts = counts.withColumn("_sday", day_of(F.col(name)))
    before = (Window.unboundedPreceding, -1)
    w = Window.partitionBy(*keys, "_sday").orderBy(name).rowsBetween(*before)
    wd = Window.partitionBy(*keys).orderBy("_sday").rowsBetween(*before)
    days = (counts.groupBy(*keys, "_sday").agg(F.sum(amount).alias("_in_day"))
            .select(*keys, "_sday", F.coalesce(F.sum("_in_day").over(wd), F.lit(0)).alias("_sdays")))
    return (counts.withColumn("_slices", F.coalesce(F.sum(amount).over(w), F.lit(0)))
            .join(days, [*keys, "_sday"])
            .withColumn(out, F.col("_slices") + F.col("_sdays"))
            .drop("_sday", "_slices", "_sdays"))


def running_rank(df: DataFrame, keys: list[str], order: list[str], out: str, name: str = "slice_us") -> DataFrame:
    """``row_number`` per key over the whole history, for rows that already carry their slice."""
    w = Window.partitionBy(*keys, name).orderBy(*order)
    counts = df.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n"))
    offsets = prefix_sums(counts, keys, "_n", "_before", name).select(*keys, name, "_before")
    return (df.withColumn("_rn", F.row_number().over(w)).join(offsets, [*keys, name])
            .withColumn(out, (F.col("_rn") + F.col("_before")).cast("bigint")).drop("_rn", "_before"))


def ordered_positions(df: DataFrame, order: str, pos: str, total: str) -> DataFrame:
    """Global 1-based position in the order of one column, plus the row count.

    Rows are range-partitioned and sorted; a row's place is its place in the partition plus the sizes of the earlier
    partitions.  The offsets table has one row per partition.
    """
    sorted_rows = (df.withColumn("_tie", F.monotonically_increasing_id())
                   .repartitionByRange(order, "_tie").sortWithinPartitions(order, "_tie").drop("_tie")
                   .withColumn("_id", F.monotonically_increasing_id()))
    rows = materialize(sorted_rows, "ordered")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part")
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(pos, place + F.col("_before") + 1).drop("_part", "_id", "_before"))
