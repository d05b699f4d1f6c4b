"""Production batches: runs of one article on one line.

Rule, per (topic, line) in the order (timestamp, identity): a record opens a batch with reason ``new_article`` when it
is the first of its UTC day or its article differs from the record before; with reason ``timeout`` when the silence
before it exceeds an hour or the factory date moved on; otherwise it continues the open batch.

How it scales: where minutes hold many records, one aggregate with map-side combine reduces them to pieces (line, minute).
A minute that saw one article is already a finished run, so its records are never shuffled or sorted.  Only minutes with
several articles go through a window over their records.  Runs are then joined up across minutes on the small run table.

Where minutes hold few records, as in a history of years, nothing can be combined and every step would move about as many
rows as there are records.  There the records are dealt once, by line and day, and a batch never crosses a day: runs,
batches and their sums come from that one sort.  Days above ``target`` records take the first way in any case.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from weighline import settings as S
from weighline.functions import times
from weighline.functions.text import safe_batch
from weighline.operators import slices as sl
from weighline.session import materialize, require_utc

LINE = ["mqtt_topic", "linea"]
_NEW, _TIMEOUT = 1, 2


@dataclass(frozen=True)
class Fragments:
    """Result of :func:`fragment`."""

    runs: DataFrame
    slicing: sl.Slicing
    measures: dict[str, str]


@dataclass(frozen=True)
class Segments:
    """Result of :func:`segment`.

    ``fragments``: runs inside one slice, each with the key of its batch (``made``: they, or what makes them when they
    are first asked for).  ``batches``: numbered batches.  ``slicing``: how records map to slices.  ``measures``: names
    of the summed columns.
    """

    made: DataFrame | Callable[[], DataFrame]
    batches: DataFrame
    slicing: sl.Slicing
    measures: dict[str, str]

    @cached_property
    def fragments(self) -> DataFrame:
        return self.made() if callable(self.made) else self.made


def _measures(df: DataFrame) -> dict[str, tuple[str, Column]]:
    have = set(df.columns)
    out = {"packages": ("sum", F.lit(1).cast("bigint"))}
    if {"clean_net_weight_g", "quality_status"} <= have:
        ok = F.col("quality_status") == "OK"
        out["net_g"] = ("sum", F.when(ok, F.col("clean_net_weight_g")).otherwise(0.0))
        out["units_ok"] = ("sum", F.when(ok, 1).otherwise(0).cast("bigint"))
        out["units_rejected"] = ("sum", F.when(F.col("quality_status") == "REJECTED", 1).otherwise(0).cast("bigint"))
    if "active_workers" in have:
        out["workers_sum"] = ("sum", F.col("active_workers").cast("bigint"))
    if "lag_seconds" in have:
        # The lag of the last record is the greatest pair (time, lag).
        out["last_lag"] = ("max", F.struct(times.micros(F.col("timestamp")).alias("us"),
                                           F.coalesce(F.col("lag_seconds"), F.lit(0.0)).alias("seconds")))
    return out


def _combine(measures: dict[str, str]) -> list[Column]:
    return [getattr(F, how)(name).alias(name) for name, how in measures.items()]


def _runs(points: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Article runs inside each slice."""
    w = Window.partitionBy(*LINE, "slice_us").orderBy("us", "identity", "article")
    before = F.lag("article").over(w)
    starts = F.when(before.isNull() | (before != F.col("article")), 1).otherwise(0)
    return (points.withColumn("_starts", starts)
            .withColumn("run", F.sum("_starts").over(w).cast("int"))
            .groupBy(*LINE, "slice_us", "run", "article")
            .agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"),
                 F.min(F.when(F.col("_starts") == 1, F.col("identity"))).alias("start_identity"),
                 *_combine(measures)))


def prepare(df: DataFrame, article_col: str = "number_refactor", width_seconds: int = S.SLICE_SECONDS) -> tuple[DataFrame, dict[str, str]]:
    """What segmentation needs of every record, and how its measures are combined."""
    specs = _measures(df)
    rows = df.where(F.col("timestamp").isNotNull()).select(
        F.coalesce("mqtt_topic", F.lit("unknown")).alias("mqtt_topic"),
        F.coalesce("linea", F.lit("unknown")).alias("linea"),
        times.micros(F.col("timestamp")).alias("us"),
        F.coalesce(F.col("identity"), F.lit(0)).cast("bigint").alias("identity"),
        F.coalesce(F.col(article_col).cast("string"), F.lit("unknown")).alias("article"),
        *[expr.alias(name) for name, (_, expr) in specs.items()],
    )
    rows = rows.withColumn("slice_us", sl.slice_of(F.col("us"), width_seconds))
    return rows, {name: how for name, (how, _) in specs.items()}


def fragment(df: DataFrame, article_col: str = "number_refactor", width_seconds: int = S.SLICE_SECONDS,
             target: int = S.SLICE_TARGET_ROWS) -> "Fragments":
    """Article runs per (line, slice): ``run`` counts them inside the slice."""
    rows, measures = prepare(df, article_col, width_seconds)
    return _fragment(rows, measures, width_seconds, target)


def _fragment(rows: DataFrame, measures: dict[str, str], width_seconds: int, target: int) -> "Fragments":
    key = [*LINE, "slice_us"]
    pieces = (rows.groupBy(*key)
              .agg(F.min("article").alias("article"), F.max("article").alias("_last"), F.min("us").alias("first_us"),
                   F.max("us").alias("last_us"), *_combine(measures)))
    # The sizes that decide the next steps are counted while the pieces are written.
    sizes, is_several, n_rows = Observation(), F.col("article") < F.col("_last"), F.col("packages")
    pieces = materialize(pieces.observe(
        sizes, F.count_if(is_several).alias("several"),
        F.count_if(is_several & (n_rows > target)).alias("hot"),
        F.count_if(n_rows > target).alias("big")), "pieces")
    counted = sizes.get
    n_several, n_hot = counted["several"], counted["hot"]
    several = pieces.where(is_several).select(*key, n_rows.alias("_rows"))

    runs = (pieces.where(~is_several).drop("_last")
            .withColumn("run", F.lit(1)).withColumn("start_identity", F.lit(None).cast("bigint")))
    slicing = sl.Slicing(tuple(LINE), width_seconds)
    if n_several:
        usual = several.where(F.col("_rows") <= target).select(*key)
        rows_in = sl.only(rows, usual, key, n_several - n_hot, counted["big"] > 0, "us")
        runs = runs.unionByName(_runs(rows_in, measures))
    if n_hot:
        # Crowded minutes with several articles: equal records collapse first, then the minute is cut finer.
        crowded = several.where(F.col("_rows") > target).select(*key)
        points = materialize(
            sl.only(rows, crowded, key, n_hot, True, "us")
            .groupBy(*LINE, "us", "identity", "article").agg(*_combine(measures)), "points")
        points, slicing = sl.refine(points, LINE, "us", width_seconds=width_seconds, target=target)
        runs = runs.unionByName(_runs(points, measures))
    runs = runs.withColumn("day", sl.day_of(F.col("slice_us")))
    return Fragments(materialize(runs, "runs") if n_several else runs, slicing, measures)


def _chain(runs: DataFrame, max_gap_seconds: int, zone: str) -> DataFrame:
    """Join runs across slices of a day: adds ``is_start``, ``reason_code`` and the batch key."""
    ends = runs.groupBy(*LINE, "day", "slice_us").agg(
        F.max("run").alias("n_runs"), F.min("first_us").alias("head_us"), F.max("last_us").alias("tail_us"),
        F.min_by("article", "run").alias("head_article"), F.max_by("article", "run").alias("tail_article"))
    w = Window.partitionBy(*LINE, "day").orderBy("slice_us")
    prev_us, prev_article = F.lag("tail_us").over(w), F.lag("tail_article").over(w)
    moved_on = (times.local_date(F.timestamp_micros("head_us"), zone)
                > times.local_date(F.timestamp_micros("_prev_us"), zone))
    head_code = (F.when(F.col("_prev_us").isNull() | (F.col("_prev_article") != F.col("head_article")), _NEW)
                 .when((F.col("head_us") - F.col("_prev_us") > max_gap_seconds * 1_000_000) | moved_on, _TIMEOUT))
    last_start = (F.when(F.col("n_runs") > 1, F.struct("slice_us", F.col("n_runs").alias("run")))
                  .when(F.col("head_code").isNotNull(), F.struct("slice_us", F.lit(1).alias("run"))))
    ends = (ends.withColumn("_prev_us", prev_us).withColumn("_prev_article", prev_article)
            .withColumn("head_code", head_code).withColumn("_last_start", last_start)
            .withColumn("carry", F.last("_last_start", True)
                        .over(w.rowsBetween(Window.unboundedPreceding, -1))))
    links = ends.select(*LINE, "day", "slice_us", "n_runs", "head_code", "carry")
    starts = (F.col("run") > 1) | F.col("head_code").isNotNull()
    own = F.struct("slice_us", "run")
    return (runs.join(links, [*LINE, "day", "slice_us"])
            .withColumn("is_start", starts)
            .withColumn("reason_code", F.when(F.col("run") > 1, _NEW).otherwise(F.col("head_code")))
            .withColumn("_key", F.when(starts, own).otherwise(F.col("carry")))
            .withColumn("key_slice", F.col("_key.slice_us")).withColumn("key_run", F.col("_key.run"))
            .withColumn("is_tail", F.col("run") == F.col("n_runs"))
            .drop("_key", "carry", "head_code", "n_runs"))


#: Records for each (line, minute, article) from which combining them first moves less than dealing them once.
DENSE = 4


def _sparse(rows: DataFrame, target: int) -> tuple[bool, DataFrame, int]:
    """Whether minutes hold few records; the (line, day) with more than ``target`` records, and how many these are."""
    days = (rows.groupBy(*LINE, sl.day_of(F.col("slice_us")).alias("day"))
            .agg(F.count(F.lit(1)).alias("_n"), F.approx_count_distinct(F.struct("slice_us", "article"), 0.2).alias("_pieces")))
    found = days.agg(F.sum("_n"), F.sum("_pieces"), F.count_if(F.col("_n") > target)).first()
    return (found[0] or 0) < DENSE * (found[1] or 0), days.where(F.col("_n") > target).select(*LINE, "day"), found[2]


def _dealt(rows: DataFrame, max_gap_seconds: int, zone: str) -> DataFrame:
    """Records with the run of their slice and the key of their batch, dealt and sorted once by line and day."""
    w = Window.partitionBy(*LINE, "day").orderBy("slice_us", "us", "identity", "article")
    in_slice = Window.partitionBy(*LINE, "day", "slice_us").orderBy("us", "identity", "article")
    so_far = (Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_prev_us": F.lag("us").over(w), "_prev_slice": F.lag("slice_us").over(w), "_prev": F.lag("article").over(w)})
    moved_on = times.local_date(F.timestamp_micros("us"), zone) > times.local_date(F.timestamp_micros("_prev_us"), zone)
    other = F.col("_prev_us").isNull() | (F.col("_prev") != F.col("article"))
    return (rows.withColumn("reason_code", F.when(other, _NEW).when((F.col("us") - F.col("_prev_us") > max_gap_seconds * 1_000_000) | moved_on, _TIMEOUT))
            .withColumn("_starts", F.when(other | (F.col("_prev_slice") != F.col("slice_us")), 1).otherwise(0))
            .withColumn("run", F.sum("_starts").over(in_slice.rowsBetween(*so_far)).cast("int"))
            .withColumn("_key", F.last(F.when(F.col("reason_code").isNotNull(), F.struct("slice_us", "run")), True).over(w.rowsBetween(*so_far)))
            .withColumns({"key_slice": F.col("_key.slice_us"), "key_run": F.col("_key.run")})
            .drop("_prev_us", "_prev_slice", "_prev", "_key"))


def _dealt_runs(dealt: DataFrame, measures: dict[str, str]) -> DataFrame:
    """The runs of dealt records, as :func:`_chain` gives them."""
    last_run = F.max("run").over(Window.partitionBy(*LINE, "day", "slice_us"))
    return (dealt.groupBy(*LINE, "day", "slice_us", "run", "article", "key_slice", "key_run")
            .agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"),
                 F.min(F.when(F.col("_starts") == 1, F.col("identity"))).alias("start_identity"),
                 F.max("reason_code").alias("reason_code"), *_combine(measures))
            .withColumns({"is_start": F.col("reason_code").isNotNull(), "is_tail": F.col("run") == last_run}))


def segment(df: DataFrame, article_col: str = "number_refactor", max_gap_seconds: int = S.MAX_GAP_SECONDS,
            zone: str = S.FACTORY_ZONE, width_seconds: int = S.SLICE_SECONDS, target: int = S.SLICE_TARGET_ROWS,
            open_batches: DataFrame | None = None, counters: DataFrame | None = None) -> Segments:
    """Cut the records of every line into production batches.

    ``open_batches`` and ``counters`` continue an earlier call (streaming): the open batch of each line is treated as
    a run before the first slice of its day, and numbering goes on from the counters.
    """
    require_utc(df.sparkSession)
    rows, measures = prepare(df, article_col, width_seconds)
    none = {"seed_sequence": F.lit(None).cast("bigint"), "seed_reason": F.lit(None).cast("int")}
    sparse, full, n_full = _sparse(rows, target) if open_batches is None else (False, None, 0)
    chained, plain, slicing = None, None, sl.Slicing(tuple(LINE), width_seconds)
    if sparse:
        rows = rows.withColumn("day", sl.day_of(F.col("slice_us")))
        if n_full:
            full = materialize(full, "full-days")
        usual = rows.join(sl.sized(full, n_full), [*LINE, "day"], "left_anti") if n_full else rows
        dealt = _dealt(usual, max_gap_seconds, zone)
        plain = _grouped(dealt.select("*", F.col("us").alias("first_us"), F.col("us").alias("last_us"), F.col("reason_code").isNotNull().alias("is_start"))
                         .withColumns(none), measures)
        rows = rows.join(sl.sized(full, n_full), [*LINE, "day"], "left_semi").drop("day") if n_full else None
    if rows is not None:
        frag = _fragment(rows, measures, width_seconds, target)
        runs, slicing = frag.runs, frag.slicing
        runs = (runs.withColumns(none) if open_batches is None
                else runs.unionByName(_seed_runs(open_batches, measures), allowMissingColumns=True))
        chained = _chain(runs, max_gap_seconds, zone)
        plain = _grouped(chained, measures) if plain is None else plain.unionByName(_grouped(chained, measures))
    plain = materialize(plain, "batches")

    def made() -> DataFrame:
        runs = _dealt_runs(dealt, measures).withColumns(none)
        return materialize(runs if chained is None else runs.unionByName(chained), "runs")

    return Segments(made if sparse else chained, number(plain, counters, target, open_batches is not None), slicing, measures)


def _grouped(chained: DataFrame, measures: dict[str, str]) -> DataFrame:
    return (chained.groupBy(*LINE, "day", "key_slice", "key_run", "article")
            .agg(F.min("first_us").alias("start_us"), F.max("last_us").alias("end_us"),
                 F.coalesce(F.max("seed_reason"), F.max(F.when(F.col("is_start"), F.col("reason_code"))))
                 .alias("reason_code"),
                 F.max("seed_sequence").alias("seed_sequence"), *_combine(measures)))


def _seed_runs(open_batches: DataFrame, measures: dict[str, str]) -> DataFrame:
    end = times.micros(F.col("end_time"))
    day = sl.day_of(end)
    return open_batches.select(
        *LINE, "article", times.micros(F.col("start_time")).alias("first_us"), end.alias("last_us"),
        *[F.col(m) for m in measures if m in open_batches.columns],
        F.lit(1).alias("run"), F.lit(None).cast("bigint").alias("start_identity"), day.alias("day"),
        (day.cast("bigint") * F.lit(times.DAY_MICROS) - 1).alias("slice_us"),
        F.col("batch_sequence").alias("seed_sequence"),
        F.when(F.col("reason") == "timeout", _TIMEOUT).otherwise(_NEW).alias("seed_reason"))


def number(plain: DataFrame, counters: DataFrame | None, target: int, with_seeds: bool) -> DataFrame:
    """Closing times, neighbours on the line, and the running number per (topic, article)."""
    per_day = plain.groupBy("mqtt_topic", sl.day_of(F.col("start_us")).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    if per_day.where(F.col("_n") > target).isEmpty():
        # days serve as slices: what has to cross a border is one row for each of them
        rows = plain.withColumn("bslice", times.floor_micros(F.col("start_us"), times.DAY_MICROS))
    else:
        rows, _ = sl.refine(plain, ["mqtt_topic"], "start_us", "bslice", target=target)
    order = ["start_us", "key_slice", "key_run"]
    about = ["start_us", "end_us", "article", "day", "key_slice", "key_run"]
    w = Window.partitionBy(*LINE, "bslice").orderBy(*order)
    ends = rows.groupBy(*LINE, "bslice").agg(
        F.max_by(F.struct(*about), F.struct(*order)).alias("tail"), F.min("start_us").alias("head"))
    ends = sl.link_slices(ends, LINE, ["tail"], ["head"], "bslice")
    near = (rows.withColumn("_prev", F.lag(F.struct(*about)).over(w))
            .withColumn("_next", F.lead("start_us").over(w))
            .join(ends.select(*LINE, "bslice", "prev", "next"), [*LINE, "bslice"])
            .withColumn("prev", F.coalesce("_prev", "prev.tail"))
            .withColumn("closed_us", F.coalesce("_next", "next.head"))
            .drop("_prev", "_next", "next"))

    new = F.col("seed_sequence").isNull()
    old = near.where(~new).withColumn("batch_sequence", F.col("seed_sequence"))
    fresh = near.where(new) if with_seeds else near
    ranked = sl.running_rank(fresh, ["mqtt_topic", "article"],
                             ["start_us", "linea", "key_slice", "key_run"], "batch_sequence", "bslice")
    if counters is not None:
        ranked = (ranked.join(counters.select("mqtt_topic", "article", F.col("last_sequence").alias("_last")),
                              ["mqtt_topic", "article"], "left")
                  .withColumn("batch_sequence", F.col("batch_sequence") + F.coalesce("_last", F.lit(0)))
                  .drop("_last"))
    if with_seeds:
        ranked = ranked.unionByName(old)
    same_day = F.col("closed_us").isNotNull() & (sl.day_of(F.col("closed_us")) == F.col("day"))
    return (ranked.withColumn("batch_instance_id", batch_id(F.col("article"), F.col("batch_sequence")))
            .withColumn("reason", F.when(F.col("reason_code") == _TIMEOUT, "timeout").otherwise("new_article"))
            .withColumn("start_time", F.timestamp_micros("start_us"))
            .withColumn("end_time", F.timestamp_micros("end_us"))
            .withColumn("closed_at", F.timestamp_micros("closed_us"))
            .withColumn("recorded", F.coalesce(same_day, F.lit(False)))
            .withColumn("utc_date", F.date_from_unix_date("day"))
            .drop("reason_code"))


def batch_id(article: Column, sequence: Column) -> Column:
    return safe_batch(F.format_string("%s_%04d", article, sequence))


def assign_batches(df: DataFrame, **options) -> DataFrame:
    """One row per production batch."""
    seg = segment(df, **options)
    return seg.batches.select(*PUBLIC, *seg.measures)


PUBLIC = ["mqtt_topic", "linea", "article", "batch_instance_id", "batch_sequence", "reason", "start_time", "end_time",
          "closed_at", "recorded", "utc_date"]


def with_batches(df: DataFrame, seg: Segments, article_col: str = "number_refactor") -> DataFrame:
    """Records with ``batch_instance_id``, ``batch_sequence`` and ``batch_start_time``.

    A slice with one run gives its batch to all its records by an equi-join (which the optimizer may broadcast or split
    when skewed).  Only records of slices with several runs are sorted, together with the runs' first moments, and take
    the last run that began before them: linear in records and runs, however often the article changes.
    """
    ids = seg.batches.select(*LINE, "day", "key_slice", "key_run", F.col("batch_instance_id").alias("_id"),
                             F.col("batch_sequence").alias("_seq"), F.col("start_time").alias("_start"))
    names = {"mqtt_topic": "_topic", "linea": "_line"}
    at = F.struct("_id", "_seq", "_start")
    cuts = (seg.fragments.join(ids, [*LINE, "day", "key_slice", "key_run"])
            .select(F.col("mqtt_topic").alias("_topic"), F.col("linea").alias("_line"), F.col("slice_us").alias("_slice"),
                    F.col("first_us").alias("_us"), F.col("start_identity").alias("_i"), F.col("article").alias("_a"),
                    at.alias("_at")))
    key = ["_topic", "_line", "_slice"]
    lone = cuts.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_only"))
    keyed = (df.withColumn("_topic", F.coalesce("mqtt_topic", F.lit("unknown")))
             .withColumn("_line", F.coalesce("linea", F.lit("unknown")))
             .withColumn("_us", times.micros(F.col("timestamp"))))
    keyed = (seg.slicing.renamed(names, "_slice").apply(keyed, F.col("_us"), "_slice").join(lone, key, "left"))
    several = F.coalesce(F.col("_n") > 1, F.lit(False))
    plain = keyed.where(~several).withColumn("_cut", F.col("_only"))
    many = (keyed.where(several)
            .withColumn("_i", F.coalesce(F.col("identity"), F.lit(0)).cast("bigint"))
            .withColumn("_a", F.coalesce(F.col(article_col).cast("string"), F.lit("unknown")))
            .withColumn("_record", F.lit(1)))
    starts = cuts.join(lone.where("_n > 1").select(*key), key, "left_semi").withColumn("_record", F.lit(0))
    # A run begins with its first record, so its start sorts just before that record.
    order = Window.partitionBy(*key).orderBy("_us", "_i", "_a", "_record").rowsBetween(Window.unboundedPreceding, 0)
    many = (many.unionByName(starts, allowMissingColumns=True)
            .withColumn("_cut", F.last("_at", ignorenulls=True).over(order)).where("_record = 1"))
    return (plain.unionByName(many.select(*plain.columns))
            .withColumn("batch_instance_id", F.col("_cut._id"))
            .withColumn("batch_sequence", F.col("_cut._seq"))
            .withColumn("batch_start_time", F.col("_cut._start"))
            .drop("_topic", "_line", "_us", "_slice", "_n", "_only", "_cut"))


def article_changes(df: DataFrame, article_col: str = "number_refactor", **options) -> DataFrame:
    """Every change of article on a line: when, from what, to what (the first record counts as a change)."""
    runs = fragment(df, article_col, **options).runs
    ends = runs.groupBy(*LINE, "slice_us").agg(F.max_by("article", "run").alias("tail_article"),
                                               F.min("first_us").alias("head_us"))
    ends = sl.link_slices(ends, LINE, ["tail_article"], ["head_us"])
    w = Window.partitionBy(*LINE, "slice_us").orderBy("run")
    return (runs.withColumn("_in", F.lag("article").over(w))
            .join(ends.select(*LINE, "slice_us", "prev"), [*LINE, "slice_us"])
            .withColumn("previous_article", F.coalesce("_in", "prev.tail_article"))
            .where(F.col("previous_article").isNull() | (F.col("previous_article") != F.col("article")))
            .select(*LINE, F.timestamp_micros("first_us").alias("changed_at"), "previous_article", "article"))


def recent_batches(batches: DataFrame, k: int = S.HISTORY_CAP) -> DataFrame:
    """The ``k`` batches closed last per topic, newest first.  The rank filter is applied before the shuffle."""
    w = Window.partitionBy("mqtt_topic").orderBy(F.desc("closed_at"), F.desc("linea"), F.desc("start_time"),
                                                 F.desc("batch_instance_id"))
    return (batches.where("closed_at is not null").withColumn("recency", F.row_number().over(w))
            .where(F.col("recency") <= k))


def split_late(df: DataFrame, newest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records in time, and those older than the newest time already processed on their line.

    ``newest`` has one row per line (``last_time``).
    """
    seen = newest.select(*LINE, "last_time")
    marked = df.join(sl.sized(seen, seen.count()), LINE, "left")
    late = F.coalesce(F.col("timestamp") < F.col("last_time"), F.lit(False))
    return marked.where(~late).drop("last_time"), marked.where(late).drop("last_time")
