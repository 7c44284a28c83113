"""Column functions over landmark arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zeros(n: int, width: int) -> Column:
    return F.array_repeat(F.array_repeat(F.lit(0.0), width), n)


def fix_width(boxes: Column, n: int, width: int = 4) -> tuple[Column, Column]:
    """Padded with zero boxes or cut to n; and whether boxes were cut off."""
    own = F.coalesce(boxes, F.array().cast("array<array<double>>"))
    return F.slice(F.concat(own, zeros(n, width)), 1, n), F.size(own) > n


def is_present(points: Column) -> Column:
    """Is there a point other than (0, 0)?"""
    return F.coalesce(F.exists(points, lambda p: F.exists(p, lambda v: v != 0)), F.lit(False))


def with_presence(frames: DataFrame, sizes: dict[str, int], width: int = 2) -> DataFrame:
    """Zero-filled parts, ``<part>_present`` for each, and face_presence as 0 or 1."""
    out = {}
    for part, n in sizes.items():
        out[f"{part}_present"] = is_present(F.col(part))
        out[part] = F.coalesce(part, zeros(n, width))
    if "face" in sizes:
        out["face_presence"] = is_present(F.col("face")).cast("int")
    return frames.withColumns(out)


def assign_hands(detections: DataFrame, keys: list[str]) -> DataFrame:
    """From (keys, det_idx, side, points): ``left_hand`` of the last detection that says Left, ``right_hand`` of the last other."""
    left = F.col("side") == "Left"
    return detections.groupBy(*keys).agg(
        F.max_by(F.when(left, F.col("points")), F.when(left, F.col("det_idx"))).alias("left_hand"),
        F.max_by(F.when(~left, F.col("points")), F.when(~left, F.col("det_idx"))).alias("right_hand"),
    )


def flatten_points(points: Column) -> Column:
    return F.flatten(points)


def landmarks_long(frames: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """(keys, part, point, values): one row per point, absent parts left out.  553 points a frame: only when asked for."""
    stacked = F.array(*(F.struct(F.lit(p).alias("part"), F.col(p).alias("points")) for p in parts))
    one = frames.select(*keys, F.inline(stacked))
    return one.select(*keys, "part", F.posexplode("points").alias("point", "values"))


def landmarks_wide(points: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """The inverse of ``landmarks_long``; parts without points are null."""

    def part(p: str) -> Column:
        own = F.array_sort(F.collect_list(F.when(F.col("part") == p, F.struct("point", "values"))))
        return F.nullif(F.transform(own, lambda s: s["values"]), F.array().cast("array<array<double>>")).alias(p)

    return points.groupBy(*keys).agg(*(part(p) for p in parts))


# Mesh points used for the head's pose, forehead points and irises.
HEAD_POINTS = [33, 263, 1, 61, 291, 199]
FOREHEAD, IRISES = 10, (468, 473)


def head_reference_points(face: Column, width: int, height: int, at: list[int] | None = None) -> Column:
    """The chosen mesh points, scaled to pixels; null entries where the mesh is shorter."""
    chosen = HEAD_POINTS + [FOREHEAD, *IRISES] if at is None else at
    scaled = lambda i: F.array(F.get(face, F.lit(i))[0] * width, F.get(face, F.lit(i))[1] * height)
    return F.array(*(F.struct(F.lit(i).alias("mesh"), scaled(i).alias("pixel")) for i in chosen))


def frame_record(frames: DataFrame, columns: list[str]) -> DataFrame:
    """A frame's columns as one JSON text, ``record``."""
    return frames.withColumn("record", F.to_json(F.struct(*columns)))


def read_record(text: Column, schema) -> Column:
    return F.from_json(text, schema)
