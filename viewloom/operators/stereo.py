"""Stereo views: calibration tables, joined landmarks, disparity, depth and 3D points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.schemas import PAIRS, PARTS, POINTS_3D, SEGMENT_KEYS

_BROADCAST = 64 << 20


def small(df: DataFrame, most: int = _BROADCAST) -> DataFrame:
    """Marked for broadcast if the optimizer's own estimate of its size is below ``most`` bytes; as it is otherwise."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(size.toString() if hasattr(size, "toString") else size) <= most else df


def projection_matrices(calibration: DataFrame) -> DataFrame:
    """P1 = K1 [I | 0] and P2 = K2 [R | T], twelve entries each, row by row."""
    k1, k2, r, t = (F.col(c) for c in ("left_mtx", "right_mtx", "R", "T"))
    first = [k1[3 * i + j] if j < 3 else F.lit(0.0) for i in range(3) for j in range(4)]

    def entry(i: int, j: int) -> Column:
        other = [r[3 * m + j] if j < 3 else t[m] for m in range(3)]
        return k2[3 * i] * other[0] + k2[3 * i + 1] * other[1] + k2[3 * i + 2] * other[2]

    second = [entry(i, j) for i in range(3) for j in range(4)]
    return calibration.withColumns({"P1": F.array(*first), "P2": F.array(*second)})


def pair_name(left: str, right: str) -> str:
    """The name of two cameras' calibration: CAM_LL and CAM_LR are LL_LR."""
    return f"{left.removeprefix('CAM_')}_{right.removeprefix('CAM_')}"


def join_stereo_frames(landmarks: DataFrame, calibration: DataFrame, left: str = "CAM_LL", right: str = "CAM_LR", keys: list[str] | None = None, parts: list[str] | None = None) -> DataFrame:
    """Left and right landmarks of one frame with the participant's calibration of these two cameras; frames without one are dropped.

    A frame is known by its participant, its segment (``SEGMENT_KEYS``, or ``segment`` of a table laid out by ``write_landmark_table``, where the landmarks have them) and its index.
    Frames without a detection on either side and parts not asked for don't reach the shuffle.
    """
    of_segment, parts = [c for c in SEGMENT_KEYS if c in landmarks.columns], parts or PARTS
    laid = keys is None and "segment" in landmarks.columns
    keys = keys or ["participant", *(["segment"] if laid else of_segment), "frame_idx"]
    calibration = calibration.where(F.col("pair") == pair_name(left, right))
    some = F.greatest(*(F.col(p).isNotNull().cast("int") for p in parts)) == 1 if len(parts) > 1 else F.col(parts[0]).isNotNull()
    more = {"left": of_segment if laid else []}
    side = lambda v, s: landmarks.where((F.col("view") == v) & some).select(*keys, *more.get(s, []), *(F.col(p).alias(f"{s}_{p}") for p in parts))
    return side(left, "left").join(side(right, "right"), keys).join(small(calibration), "participant")


def triangulate(stereo: DataFrame, keys: list[str], parts: list[str] | None = None) -> DataFrame:
    """3D points of every part by the direct linear transform from P1 and P2; null where a side is absent, null points where w is 0 or a point is null or has no two numbers.

    All work is on the flat buffers of Arrow batches, in pieces of ``SOLVED`` points, so no Python object is made for a point.  The right side's points beyond the left's
    number, and the reverse, are left out.
    """
    parts = parts or PARTS
    chosen = stereo.select(*keys, "P1", "P2", *(f"{s}_{p}" for p in parts for s in ("left", "right")))
    schema = T.StructType([*(chosen.schema[k] for k in keys), *(T.StructField(p, POINTS_3D) for p in parts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1, p2 = (_numbers(batch.column(c), 12) for c in ("P1", "P2"))
            points = [_solved(p1, p2, batch.column(f"left_{p}"), batch.column(f"right_{p}")) for p in parts]
            yield pa.record_batch([*(batch.column(k) for k in keys), *points], names=schema.names)

    return chosen.mapInArrow(run, schema)


#: So many points are solved at once: 16 numbers each for the system, and 16 for its decomposition.
SOLVED = 1 << 16


def _numbers(column: pa.Array, n: int) -> np.ndarray:
    """Lists of doubles as rows of ``n``; NaN for what isn't there."""
    length = np.minimum(_lengths(column), n)
    row = np.repeat(np.arange(len(column)), length)
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out = np.full((len(column), n), np.nan)
    out[row, place] = _doubles(column.values)[_starts(column)[row] + place]
    return out


def _lengths(column: pa.Array) -> np.ndarray:
    """The length of each list, 0 for null."""
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _starts(column: pa.Array) -> np.ndarray:
    """Where each list begins in ``column.values``."""
    return column.offsets.to_numpy()[: len(column)].astype(np.int64)


def _doubles(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(float)


def _solved(p1: np.ndarray, p2: np.ndarray, left: pa.Array, right: pa.Array) -> pa.Array:
    """Lists of points (x, y, z) of frames with matrices ``p1`` and ``p2`` from lists of [x, y] of both sides."""
    absent = pc.or_(pc.is_null(left), pc.is_null(right)).to_numpy(zero_copy_only=False)
    n = np.where(absent, 0, np.minimum(_lengths(left), _lengths(right)))
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.empty((begin[-1], 3))
    sides = [(_starts(c), _starts(c.values), _lengths(c.values), _doubles(c.values.values)) for c in (left, right)]
    for first in range(0, int(begin[-1]), SOLVED):
        at = np.arange(first, min(first + SOLVED, int(begin[-1])))
        row = np.searchsorted(begin, at, "right") - 1
        system = np.empty((len(at), 4, 4))
        for k, (outer, inner, width, values) in enumerate(sides):
            point = outer[row] + at - begin[row]
            fine = width[point] >= 2
            spot = np.where(fine, inner[point], 0)
            xy = [np.where(fine, values[spot + j], np.nan) if len(values) > 1 else np.full(len(at), np.nan) for j in (0, 1)]
            m = (p1, p2)[k][row].reshape(-1, 3, 4)
            for j in (0, 1):
                system[:, 2 * k + j] = xy[j][:, None] * m[:, 2] - m[:, j]
        bad = ~np.isfinite(system).all((1, 2))
        system[bad] = 0
        x = np.linalg.svd(system)[2][:, -1]
        with np.errstate(divide="ignore", invalid="ignore"):
            out[at] = x[:, :3] / x[:, 3:]
        out[at[bad]] = np.nan
    gone = pa.array(~np.isfinite(out).all(1))
    points = pa.StructArray.from_arrays([pa.array(out[:, j]) for j in range(3)], names=["x", "y", "z"], mask=gone)
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), points, mask=pa.array(absent))


def disparity(left: Column, right: Column, reverse: bool = False) -> Column:
    """x of the left less x of the right, for each point (``reverse``: the other way)."""
    return F.zip_with(left, right, lambda a, b: b[0] - a[0] if reverse else a[0] - b[0])


def depth(disparities: Column, focal: Column, base: Column, guard: float = 1e-5) -> Column:
    """f B / d for each point; a disparity of 0 counts as ``guard``."""
    return F.transform(disparities, lambda d: focal * base / F.when(d == 0, guard).otherwise(d))


def back_project(points: Column, depths: Column, focal: Column, cx: Column, cy: Column) -> Column:
    return F.zip_with(points, depths, lambda p, z: F.struct(((p[0] - cx) * z / focal).alias("x"), ((p[1] - cy) * z / focal).alias("y"), z.alias("z")))


def to_world(points: Column, r: Column, t: Column) -> Column:
    """R p + T for each point."""
    row = lambda p, i: r[3 * i] * p["x"] + r[3 * i + 1] * p["y"] + r[3 * i + 2] * p["z"] + t[i]
    return F.transform(points, lambda p: F.struct(row(p, 0).alias("x"), row(p, 1).alias("y"), row(p, 2).alias("z")))


def baseline(t: Column) -> Column:
    return F.sqrt(F.aggregate(t, F.lit(0.0), lambda a, v: a + v * v))


def gaze_vector(left_iris: list[Column], right_iris: list[Column], forehead: list[Column], rotation: list[Column]) -> Column:
    """Unit gaze of both eyes, averaged and rotated by the head's rotation vector; null where an eye lies on its centre."""
    norm = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    apart = norm([a - b for a, b in zip(left_iris, right_iris, strict=True)])
    centres = [[forehead[0] + s * apart / 2.0, forehead[1], forehead[2]] for s in (-1.0, 1.0)]
    eyes = []
    for iris, centre in zip((left_iris, right_iris), centres, strict=True):
        v = [a - b for a, b in zip(iris, centre, strict=True)]
        length = F.nullif(norm(v), F.lit(0.0))
        eyes.append([x / length for x in v])
    mean = [(a + b) / 2.0 for a, b in zip(*eyes, strict=True)]
    angle = norm(rotation)
    safe = F.nullif(angle, F.lit(0.0))
    k = [F.coalesce(r / safe, F.lit(0.0)) for r in rotation]
    c, s = F.cos(angle), F.sin(angle)
    cross = [k[1] * mean[2] - k[2] * mean[1], k[2] * mean[0] - k[0] * mean[2], k[0] * mean[1] - k[1] * mean[0]]
    dot = k[0] * mean[0] + k[1] * mean[1] + k[2] * mean[2]
    turned = [m * c + x * s + kk * dot * (1.0 - c) for m, x, kk in zip(mean, cross, k, strict=True)]
    return F.struct(*(v.alias(n) for v, n in zip(turned, "xyz", strict=True)))


def calibration_error_report(calibration: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Stereo error of each participant number from first to last, ``N/A`` without one; and mean and greatest of those there are."""
    wanted = calibration.sparkSession.range(first, last + 1).select(F.format_string("p%02d", "id").alias("participant"))
    report = wanted.join(calibration.select("participant", "retval"), "participant", "left")
    text = report.select("participant", F.coalesce(F.col("retval").cast("string"), F.lit("N/A")).alias("error"))
    return text, report.agg(F.count("retval").alias("present"), F.avg("retval").alias("mean_error"), F.max("retval").alias("max_error"))


def calibration_errors_by_pair(calibration: DataFrame, first: int, last: int, pairs: list[str]) -> DataFrame:
    """(participant, pair, file, error): the stereo error of every pair of each participant number from first to last with the name of its file, ``N/A`` without one."""
    who = F.format_string("p%02d", "id")
    wanted = calibration.sparkSession.range(first, last + 1).select(who.alias("participant"), F.explode(F.array(*map(F.lit, pairs))).alias("pair"))
    found = wanted.join(calibration.select("participant", "pair", "retval"), ["participant", "pair"], "left")
    return found.select("participant", "pair", F.concat_ws("_", "participant", "pair", F.lit("stereo.npz")).alias("file"), F.coalesce(F.col("retval").cast("string"), F.lit("N/A")).alias("error"))


#: Corners of both sides, some 50 bytes each, that a task of ``stereo_correspondences`` joins.
CORNERS = 2_000_000


def stereo_correspondences(observations: DataFrame, step: float = 1.0, columns: int = 7) -> DataFrame:
    """Frame pairs in which both sides saw the same corner ids in the same order, with each corner's board point.

    Corners are counted first, and both sides are dealt to as many tasks as these ask for, so the part of the join that a task sorts stays of one size.
    """
    keys = ["participant", "pair", "frame_idx"]
    corners = observations.agg(F.sum(F.greatest(F.size("ids"), F.lit(0)) + 1)).first()[0] or 0
    tasks = max(int(observations.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-corners // CORNERS))
    side = lambda s: observations.where(F.col("side") == s).select(*keys, F.col("ids").alias(f"{s}_ids"), F.col("corners").alias(f"{s}_corners"))
    dealt = lambda s: side(s).repartition(tasks, f"{s}_ids", *keys)  # noqa: E731  by the ids too, which are keys of the join
    both = dealt("left").join(dealt("right"), keys).where(F.col("left_ids") == F.col("right_ids"))
    board = F.transform("left_ids", lambda i: F.array((i % columns) * step, F.floor(i / columns) * step))
    return both.select(*keys, F.col("left_ids").alias("ids"), "left_corners", "right_corners", board.alias("board"))


def calibration_shape_check(calibration: DataFrame) -> DataFrame:
    """Do both cameras' parameters have the same shapes?  Both shapes, and the smaller number of views."""
    shape = lambda s: F.concat_ws("x", F.size(f"{s}_mtx"), F.size(f"{s}_dist"))
    return calibration.select(
        "participant", "pair", (shape("left") == shape("right")).alias("same"), shape("left").alias("left_shape"), shape("right").alias("right_shape"), F.least("left_count", "right_count").alias("views")
    )


def calibration_assets(videos: DataFrame, calibrated: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per participant and camera pair: which of both videos and both intrinsics are there, and are all four.

    ``videos`` and ``calibrated`` have (participant, view).  One aggregation makes each participant's set of views; pairs are literals.
    """
    seen = videos.select("participant", "view", F.lit("video").alias("kind")).unionByName(calibrated.select("participant", "view", F.lit("calibration").alias("kind")))
    per = seen.groupBy("participant").agg(*(F.collect_set(F.when(F.col("kind") == k, F.col("view"))).alias(k) for k in ("video", "calibration")))
    every = F.array(*(F.struct(F.lit(a).alias("left"), F.lit(b).alias("right")) for a, b in pairs or PAIRS))
    rows = per.select("participant", "video", "calibration", F.inline(every))
    has = {f"{s}_{k}": F.array_contains(k, F.col(s)) for s in ("left", "right") for k in ("video", "calibration")}
    complete = F.lit(True)
    for c in has.values():
        complete &= c
    return rows.select("participant", "left", "right", *(c.alias(n) for n, c in has.items()), complete.alias("complete"))


def select_calibration_frames(observations: DataFrame, n: int, min_corners: int, limit: int, stream: list[str]) -> tuple[DataFrame, DataFrame]:
    """Every n-th frame with more than ``min_corners`` corners, the first ``limit`` of each stream; and the other n-th frames."""
    nth = observations.where(F.col("frame_idx") % n == 0).withColumn("enough", F.size("ids") > min_corners)
    order = Window.partitionBy(*stream, "enough").orderBy("frame_idx")
    ranked = nth.withColumn("rank", F.row_number().over(order))
    chosen = F.col("enough") & (F.col("rank") <= limit)
    return ranked.where(chosen).drop("enough"), ranked.where(~chosen).drop("enough", "rank")


def stereo_readiness(observations: DataFrame, min_frames: int, min_corners: int = 15) -> DataFrame:
    """Per pair: frames in which both sides saw the same ids, at least ``min_corners`` of them, and whether these are enough."""
    both = stereo_correspondences(observations)
    seen = observations.select("participant", "pair").distinct()
    g = both.groupBy("participant", "pair").agg(F.count_if(F.size("ids") >= min_corners).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return seen.join(g, ["participant", "pair"], "left").select("participant", "pair", n.alias("frames"), (n >= min_frames).alias("ready"))
