"""Catalogues of recordings: quality reports, work lists and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions.order import numbered, running_sum
from viewloom.schemas import VIEWS

CAMERA = ["participant", "view"]


def camera_integrity(videos: DataFrame) -> DataFrame:
    """Per camera: numbers of distinct fps and durations, the single value of each, or ``review``.  ``videos`` has duration_s."""
    g = videos.groupBy(*CAMERA).agg(
        F.count("*").alias("videos"),
        F.count_distinct("fps").alias("fps_values"),
        F.count_distinct("duration_s").alias("duration_values"),
        F.min("fps").alias("low_fps"),
        F.min("duration_s").alias("low_duration"),
    )
    single = (F.col("fps_values") == 1) & (F.col("duration_values") == 1)
    return g.select(
        *CAMERA, "videos", "fps_values", "duration_values", F.when(F.col("fps_values") == 1, F.col("low_fps")).alias("fps"),
        F.when(F.col("duration_values") == 1, F.col("low_duration")).alias("duration_s"), F.when(single, "single").otherwise("review").alias("status"),
    )


def compare_cameras(videos: DataFrame, first: str = "CAM_LL", second: str = "CAM_LR") -> DataFrame:
    """Per participant with both cameras: fps differs, duration differs, both, none, or review."""
    cameras = camera_integrity(videos.where(F.col("view").isin(first, second)))
    # one shuffle on the participant holds both sides
    side = lambda v, c: F.max(F.when(F.col("view") == v, F.col(c)))
    g = cameras.groupBy("participant").agg(
        *(side(v, c).alias(f"{c}_{i}") for i, v in ((1, first), (2, second)) for c in ("fps", "duration_s", "status")), F.count_distinct("view").alias("sides")
    )
    fps, duration = F.col("fps_1") != F.col("fps_2"), F.col("duration_s_1") != F.col("duration_s_2")
    outcome = (
        F.when((F.col("status_1") == "review") | (F.col("status_2") == "review"), "review")
        .when(fps & duration, "both")
        .when(fps, "fps")
        .when(duration, "duration")
        .otherwise("none")
    )
    return g.where("sides = 2").select("participant", outcome.alias("outcome"))


def video_count_status(videos: DataFrame, expected: int = 10) -> DataFrame:
    n = F.col("videos")
    status = F.when(n < expected, f"<{expected}").when(n > expected, f">{expected}").otherwise("ok")
    return videos.groupBy(*CAMERA).agg(F.count("*").alias("videos")).withColumn("status", status)


def presence_rollup(files: DataFrame, token: str, name: str = "file") -> DataFrame:
    """Files whose name holds the token: per view and participant, per participant, and in all (``level`` 0, 1, 3)."""
    hit = F.col(name).contains(token).cast("long")
    return files.rollup("participant", "view").agg(F.sum(hit).alias("files"), F.grouping_id().cast("int").alias("level"))


def distinct_labels(files: DataFrame, label: str = "video", exts: tuple[str, ...] = (".mp4",)) -> DataFrame:
    """Names, without extension, that have a video at least."""
    stem = F.regexp_replace(label, r"\.[^.]+$", "")
    ends = F.lit(False)
    for e in exts:
        ends |= F.lower(label).endswith(e)
    return files.where(ends).select(stem.alias("label")).distinct()


def corrupt_segments(segments: DataFrame, min_bytes: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Files below the size floor, and their number by view, views without any shown with 0."""
    bad = segments.where(F.col("bytes") < min_bytes)
    spark = segments.sparkSession
    views = spark.createDataFrame([(v,) for v in VIEWS], "view string")
    counts = views.join(bad.groupBy("view").agg(F.count("*").alias("n")), "view", "left").select("view", F.coalesce("n", F.lit(0)).alias("corrupt"))
    return bad, counts


def pending(files: DataFrame, processed: DataFrame, key: str = "file") -> DataFrame:
    """Files not processed yet."""
    return files.join(processed.select(key).distinct(), key, "left_anti")


def fps_conflicts(videos: DataFrame, most_videos: int = 10) -> DataFrame:
    """Rows of a camera, in the order of their videos, from the one that shows a second fps on; cameras with more videos left out."""
    camera = Window.partitionBy(*CAMERA)
    running = camera.orderBy("video").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = videos.withColumns({"_n": F.count("*").over(camera), "_low": F.min("fps").over(running), "_high": F.max("fps").over(running)})
    return seen.where((F.col("_n") <= most_videos) & (F.col("_low") < F.col("_high"))).drop("_n", "_low", "_high")


def running_presence(files: DataFrame, token: str, name: str = "file") -> DataFrame:
    """Files with the token by participant and view, and their running number in that order.

    Counted per camera first; cameras are then summed in ranges of the order, and the ranges' sums added.
    """
    per = files.groupBy(*CAMERA).agg(F.sum(F.col(name).contains(token).cast("long")).alias("files"))
    return running_sum(per, CAMERA, "files", "running")


def batch_groups(ids: DataFrame, size: int, key: str = "participant") -> DataFrame:
    """Distinct ids in order, cut into groups of ``size`` named first_to_last; one row a group."""
    placed = numbered(ids.select(key).distinct(), [key], "_at").withColumn("group", F.floor(F.col("_at") / size).cast("long"))
    g = placed.groupBy("group").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("members"))
    return g.withColumn("name", F.concat_ws("_to_", "first", "last"))


def batch_plan(segments: DataFrame, views: int = 5, batch: int = 100) -> DataFrame:
    """Files and batches of each subtask; both divisions are whole."""
    g = segments.groupBy("subtask").agg(F.count("*").alias("files"))
    per_view = F.floor(F.col("files") / views).cast("long")
    return g.select("subtask", "files", per_view.alias("per_view"), F.floor((per_view + batch - 1) / batch).cast("long").alias("batches"))


def catalog_sorted(videos: DataFrame, within: bool = False) -> DataFrame:
    """In participant, view, video order: of the whole, or inside each partition."""
    order = ["participant", "view", "video"]
    return videos.repartition("participant").sortWithinPartitions(*order) if within else videos.orderBy(*order)


def merge_manifest(old: DataFrame, new: DataFrame, key: str = "file", at: str = "at") -> DataFrame:
    """One row a key, the latest; of equal times the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    values = [c for c in old.columns if c != key]
    latest = both.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(at, "_new", *[c for c in values if c != at])).alias("_v"))
    return latest.select(key, "_v.*")
