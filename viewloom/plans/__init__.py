"""The three main workloads, end to end."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions.arrays import is_present
from viewloom.operators.annotations import duration_summary, segment_durations, segments_per_view, shared_subtasks, view_groups
from viewloom.operators.catalog import corrupt_segments
from viewloom.operators.stereo import join_stereo_frames, projection_matrices, triangulate
from viewloom.operators.sync import harmonize_fps, match_length, pair_views, sync_frames
from viewloom.schemas import PARTS, SEGMENT_KEYS


def consistency_statistics(segments: DataFrame) -> DataFrame:
    """Clips by subtask: with equal counts across views, with unequal ones, and in a single view."""
    several, equal = F.col("views") > 1, F.col("lo") == F.col("hi")
    kinds = {"equal": several & equal, "unequal": several & ~equal, "single": F.col("views") == 1}
    return view_groups(segments).groupBy("subtask").agg(*(F.count_if(c).alias(k) for k, c in kinds.items()))


def synchronised(frames: DataFrame, left: str = "CAM_LL", right: str = "CAM_LR", tolerance_ms: int | None = None, videos: DataFrame | None = None, keys: tuple[str, ...] = ("participant",)) -> DataFrame:
    """Frame pairs of two views, after both are cut to the shorter length of their group (``keys``: participant, and video where frames have it).

    With ``videos`` (the keys, view, video, fps, frame_count) only videos that both views have are paired (``pair_views``), frames are first brought to the pair's lower rate, and the tolerance
    of each pair is, without one given, one frame at that rate.
    """
    group, tolerance = list(keys), tolerance_ms
    both = frames.where(F.col("view").isin(left, right))
    if videos is not None:
        rated = videos.where(F.col("view").isin(left, right) & (F.col("fps") > 0))
        pairs, _ = pair_views(rated, left, [right])
        width = F.lit(1000.0) / F.min(F.least("ref_fps", "fps"))
        both = both.join(pairs.groupBy(*group).agg(width.alias("_tolerance")), group)
        both = harmonize_fps(both, rated.select(*group, "view", "fps").distinct(), group, [*group, "view"]).drop("frame_idx").withColumnRenamed("new_idx", "frame_idx")
        tolerance = "_tolerance" if tolerance_ms is None else tolerance_ms
    if tolerance is None:
        raise ValueError("without videos and their rates, tolerance_ms must be given")
    trimmed, _ = match_length(both, group, [*group, "view"])
    side = lambda v: trimmed.where(F.col("view") == v)
    return sync_frames(side(left), side(right), group, tolerance)


def frame_ms(videos: DataFrame) -> int:
    """The length of a frame at the lowest rate, in whole milliseconds: how far apart the frames of two cameras may be."""
    least = videos.where("fps > 0").agg(F.min("fps")).first()[0]
    if least is None:
        raise ValueError("no video has a rate")
    return math.ceil(1000 / least)


def segmented_statistics(annotations: DataFrame, existing: DataFrame, valid: DataFrame) -> dict[str, DataFrame]:
    """Label exports to statistics: labels spread over all views as clips, joined with the clip files that exist.

    ``existing``: (path, bytes, frame_count) of the clip files of the first split; ``valid``: (subtask, start_s, end_s) of the other split's clips.
    Returns ``missing`` (clips still to be cut, with their output path), ``corrupt`` (files that are too small, by view), ``consistency`` (by subtask) and
    ``durations`` (one row a segment of both splits) with their ``summary``.
    """
    clips = segments_per_view(annotations).dropDuplicates(["name"])
    files = existing.select(F.substring_index("path", "/", -1).alias("name"), "bytes", "frame_count")
    have = clips.join(files, "name")
    train = have.select(F.col("abbreviation").alias("subtask"), "start_s", "end_s", "bytes")
    durations = segment_durations(train.select("subtask", "start_s", "end_s"), shared_subtasks(valid, train).select("subtask", "start_s", "end_s"))
    return {
        "missing": clips.join(files.select("name").distinct(), "name", "left_anti"),
        "corrupt": corrupt_segments(have)[1],
        "consistency": consistency_statistics(have.select(F.col("name").alias("path"), "frame_count")),
        "durations": durations,
        "summary": duration_summary(durations),
    }


def reconstructed(landmarks: DataFrame, calibration: DataFrame, parts: list[str] | None = None, left: str = "CAM_LL", right: str = "CAM_LR") -> DataFrame:
    """3D points of every frame that both views and their calibration cover."""
    parts = parts or PARTS
    seen = landmarks.withColumns({p: F.when(is_present(F.col(p)), F.col(p)) for p in parts})
    stereo = join_stereo_frames(seen, projection_matrices(calibration), left, right, parts=parts)
    return triangulate(stereo, ["participant", "pair", *(c for c in SEGMENT_KEYS if c in landmarks.columns), "frame_idx"], parts)


__all__ = ["consistency_statistics", "frame_ms", "reconstructed", "segmented_statistics", "synchronised"]
