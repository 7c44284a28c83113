"""Labelled segments: counts, durations, consistency across views, frames inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions.names import label_abbreviation, parse_segment_name, segment_name
from viewloom.schemas import VIEWS


def labels(annotations: DataFrame) -> DataFrame:
    """(file, label): one row for each label of each trick."""
    tricks = annotations.select("file", F.explode("tricks").alias("t"))
    return tricks.select("file", F.explode("t.labels").alias("label"))


def label_counts(annotations: DataFrame) -> DataFrame:
    return labels(annotations).groupBy("label").agg(F.count("*").alias("n"))


def label_counts_by_file(annotations: DataFrame) -> DataFrame:
    return labels(annotations).groupBy("file", "label").agg(F.count("*").alias("n"))


def combine_splits(train: DataFrame, valid: DataFrame) -> DataFrame:
    """All rows of both, with the split they came from."""
    return train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))


def shared_subtasks(valid: DataFrame, train: DataFrame) -> DataFrame:
    """Validation segments of subtasks that training has too."""
    return valid.join(train.select("subtask").distinct(), "subtask", "left_semi")


def segment_durations(train: DataFrame, valid: DataFrame) -> DataFrame:
    """(split, subtask, start_s, end_s, duration_s): one row for each segment of either split."""
    both = combine_splits(train, valid)
    return both.select("split", "subtask", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"))


def subtask_durations(train: DataFrame, valid: DataFrame) -> DataFrame:
    """Count, least, mean and greatest duration of each split's segments by subtask."""
    return duration_summary(segment_durations(train, valid))


def duration_summary(durations: DataFrame) -> DataFrame:
    """Count, least, mean and greatest ``duration_s`` by split and subtask."""
    both = durations.withColumn("d", F.col("duration_s").cast("decimal(18,6)"))
    g = both.groupBy("split", "subtask").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.sum("d").alias("total"), F.max("d").alias("hi"))
    mean = F.round(F.col("total").cast("double") / F.col("n"), 6)
    return g.select("split", "subtask", "n", F.col("lo").cast("double").alias("min_s"), mean.alias("mean_s"), F.col("hi").cast("double").alias("max_s"))


def view_groups(segments: DataFrame, name: str = "path") -> DataFrame:
    """Clips (participant, task, subtask, raw times) with their views, the least and the greatest frame count, and the counts by view.

    A view that stands twice counts once, with its greatest frame count.
    """
    key = ["participant", "task", "subtask", "times"]
    # equal names are merged before they are parsed
    named = segments.groupBy(name).agg(F.max("frame_count").alias("frame_count"))
    parsed = named.withColumn("p", parse_segment_name(name)).where("p is not null").select("p.*", "frame_count")
    per_view = parsed.groupBy(*key, "view").agg(F.max("frame_count").alias("frame_count"))
    return per_view.groupBy(*key).agg(
        F.count("*").alias("views"), F.min("frame_count").alias("lo"), F.max("frame_count").alias("hi"), F.array_sort(F.collect_list(F.struct("view", "frame_count"))).alias("by_view")
    )


def frame_count_consistency(segments: DataFrame, name: str = "path") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``view_groups`` with equal counts, with unequal ones, and of single views; the counts as a map by view."""
    g = view_groups(segments, name).withColumn("by_view", F.map_from_entries("by_view"))
    equal = F.col("lo") == F.col("hi")
    return g.where((F.col("views") > 1) & equal), g.where((F.col("views") > 1) & ~equal), g.where("views = 1")


def segments_per_view(annotations: DataFrame, views: list[str] | None = None, root: str = "segments") -> DataFrame:
    """Each labelled trick once for every view, with its clip's name and output path (``root``/subtask/name), by which clips that exist are found.

    Participant and task come from the video's URL.
    """
    who = F.regexp_extract("video_url", r"(p\d+)_CAM", 1)
    task = F.regexp_extract("video_url", r"CAM_AV_P_(\w+)\.mp4", 1)
    tricks = annotations.select(who.alias("participant"), task.alias("task"), F.explode("tricks").alias("t")).select(
        "participant", "task", F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"), F.col("t.labels")[0].alias("label")
    )
    # the views are a handful of literals: no join is needed
    spread = tricks.withColumn("abbreviation", label_abbreviation("label")).withColumn("view", F.explode(F.array(*map(F.lit, views or VIEWS))))
    named = spread.where("abbreviation is not null").withColumn("name", segment_name("participant", "view", "task", "abbreviation", "start_s", "end_s"))
    return named.withColumn("path", F.concat_ws("/", F.lit(root), "abbreviation", "name"))


def interval_cover(first: Column, last: Column, short: int = 4) -> Column:
    """Array of (level, at): the buckets from ``first`` to ``last`` one by one (level 0) if they are ``short`` or fewer, else dyadic runs of 2**level buckets, two a level at most."""
    end = last + 1
    levels = F.sequence(F.lit(0), F.ceil(F.log2((end - first).cast("double"))).cast("int"))

    def of(k: Column) -> Column:
        width = F.pow(F.lit(2.0), k).cast("long")
        lo, hi = F.ceil(first / width).cast("long"), F.floor(end / width).cast("long")
        open_ = lo < hi
        left, right = F.when(open_ & (F.pmod(lo, F.lit(2)) == 1), lo), F.when(open_ & (F.pmod(hi, F.lit(2)) == 1), hi - 1)
        return F.transform(F.filter(F.array(left, right), lambda x: x.isNotNull()), lambda x: F.struct(k.alias("level"), x.alias("at")))

    plain = F.transform(F.sequence(first, last), lambda x: F.struct(F.lit(0).alias("level"), x.alias("at")))
    return F.when(end - first <= short, plain).otherwise(F.flatten(F.transform(levels, of)))


def assign_segments(frames: DataFrame, segments: DataFrame, keys: list[str], time: str = "media_t", bucket_s: float = 16.0, levels: list[int] | None = None) -> DataFrame:
    """Every frame inside [start_s, end_s) of a segment of its keys.

    Both sides are keyed by time as well, so a key with many segments and frames is many keys: a segment by the dyadic intervals that cover its buckets, some tens for one of hours, and a
    frame by its interval at each of the ``levels`` that segments have (None: looked up first; level 0 alone where no segment is long).
    """
    cut = lambda c: F.floor(c / bucket_s).cast("long")
    # a segment ends before end_s: its last bucket is that of the time just below
    last = F.greatest(cut(F.col("start_s")), F.ceil(F.col("end_s") / bucket_s).cast("long") - 1)
    right = segments.where("start_s < end_s").withColumn("_cover", F.explode(interval_cover(cut(F.col("start_s")), last)))
    right = right.withColumns({"_level": F.col("_cover.level"), "_bucket": F.col("_cover.at")}).drop("_cover")
    if levels is None:
        levels = sorted(r[0] for r in right.select("_level").distinct().collect())  # 64 numbers at most
    left = frames.withColumn("_level", F.explode(F.array(*(F.lit(k) for k in levels or [0]))))
    left = left.withColumn("_bucket", F.expr(f"floor({time} / {bucket_s}D)").cast("long")).withColumn("_bucket", F.expr("shiftright(_bucket, _level)"))
    inside = (F.col(time) >= F.col("start_s")) & (F.col(time) < F.col("end_s"))
    return left.join(right, [*keys, "_level", "_bucket"]).where(inside).drop("_level", "_bucket")
