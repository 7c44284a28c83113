"""Column functions over frames, sizes, points and angles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_duration(videos: DataFrame) -> DataFrame:
    """Frames over fps; 0 where fps is 0."""
    return videos.withColumn("duration_s", F.when(F.col("fps") != 0, F.col("frame_count") / F.nullif(F.col("fps"), F.lit(0.0))).otherwise(0.0))


def frame_time(frames: DataFrame, fps: Column | float = 30.0) -> DataFrame:
    fps = fps if isinstance(fps, Column) else F.lit(float(fps))
    return frames.withColumn("timestamp_s", F.when(fps != 0, F.col("frame_idx") / F.nullif(fps, F.lit(0.0))))


def to_pixel(points: Column, width: int, height: int) -> Column:
    """Normalised [x, y] points as truncated pixel integers."""
    return F.transform(points, lambda p: F.array((p[0] * width).cast("int"), (p[1] * height).cast("int")))


def normalize_gaze(x: Column, y: Column, width: int, height: int) -> tuple[Column, Column]:
    return x / float(width), y / float(height)


def scale_size(width: Column, height: Column, percent: Column | float) -> tuple[Column, Column]:
    p = percent if isinstance(percent, Column) else F.lit(float(percent))
    return (width * p / 100.0).cast("int"), (height * p / 100.0).cast("int")


def scale_intrinsics(mtx: Column, old: tuple[float, float], new: tuple[float, float]) -> Column:
    """diag(sx, sy, 1) times a row-major 3 x 3 matrix."""
    sx, sy = new[0] / old[0], new[1] / old[1]
    return F.transform(mtx, lambda v, i: F.when(i < 3, v * sx).when(i < 6, v * sy).otherwise(v))


def project_homogeneous(points: Column, mtx: Column) -> Column:
    """K [x, y, 1], divided by its third entry, for every point."""

    def one(p: Column) -> Column:
        row = lambda r: mtx[3 * r] * p[0] + mtx[3 * r + 1] * p[1] + mtx[3 * r + 2]
        w = F.nullif(row(2), F.lit(0.0))
        return F.array(row(0) / w, row(1) / w)

    return F.transform(points, one)


def look_direction(x: Column, y: Column) -> Column:
    """Nine-way label of head angles; the thresholds are not symmetric, and their order decides."""
    return (
        F.when((x < -1) & (y < -1), "Looking Down-Left")
        .when((x < -2) & (y > 2), "Looking Down-Right")
        .when((x > 1) & (y < -1), "Looking Upper-Left")
        .when((x > 1) & (y > 1), "Looking Upper-Right")
        .when(y < -1, "Looking Left")
        .when(y > 1, "Looking Right")
        .when(x < -1, "Looking Down")
        .when(x > 1, "Looking Up")
        .otherwise("Forward")
    )


def irregular(frames: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Streams whose frames aren't numbered 0, 1, 2 ... each once.

    Indices are gathered as bits of 64-bit words, one word for 64 neighbours, which tasks combine before the shuffle; the bits set are the distinct indices.
    """
    word = frames.groupBy(*keys, F.floor(F.col(index) / 64).alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({index}, 64) as int))")).alias("_bits"), F.count("*").alias("_n"), F.min(index).alias("_lo"), F.max(index).alias("_hi")
    )
    count = word.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum(F.bit_count("_bits")).alias("_d"), F.max("_hi").alias("_last"), F.min("_lo").alias("_first"), F.count("_word").alias("_words"), F.count("*").alias("_all"))
    regular = (F.col("_n") == F.col("_last") + 1) & (F.col("_n") == F.col("_d")) & (F.col("_first") == 0) & (F.col("_words") == F.col("_all"))
    return count.where(~F.coalesce(regular, F.lit(False))).select(*keys)


def renumbered(frames: DataFrame, kept: DataFrame, keys: list[str], index: str, name: str, number: Column, gaps: bool | None = None) -> DataFrame:
    """``kept`` frames with their place (``name``) among the kept ones of their stream: ``number`` where the stream's ``frames`` have no gap, by order elsewhere."""
    if gaps is False:
        return kept.withColumn(name, number.cast("long"))
    odd = irregular(frames, keys, index)
    if gaps is None and not odd.limit(1).count():
        return kept.withColumn(name, number.cast("long"))
    order = Window.partitionBy(*keys).orderBy(index)
    even = kept.join(odd, keys, "left_anti").withColumn(name, number.cast("long"))
    return even.unionByName(kept.join(odd, keys, "left_semi").withColumn(name, (F.row_number().over(order) - 1).cast("long")))


def sample_every_n(frames: DataFrame, n: int, keys: list[str], index: str = "frame_idx", gaps: bool | None = None) -> DataFrame:
    """Every n-th frame, renumbered as ``sample_idx`` and named after its stream.

    Where a stream's frames are numbered 0, 1, 2 ... without a gap, the new number is the old one divided by n, and no frame is shuffled; ``gaps`` (None: counted first) says that some aren't,
    and their frames alone are put in order.
    """
    kept = frames.where(F.col(index) % n == 0)
    kept = renumbered(frames, kept, keys, index, "sample_idx", F.floor(F.col(index) / n), gaps)
    return kept.withColumn("image", F.concat(F.concat_ws("_", *keys), F.format_string("_%04d", "sample_idx")))
