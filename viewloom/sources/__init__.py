"""Readers and writers of the recordings' files."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.schemas import ANNOTATION, CALIBRATION, DOUBLES, EXTENSION_VIDEO, SEGMENT_KEYS, TASK_PLAN


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``, or the context's checkpoint folder; a local one only where neither is set and the session is a local one."""
    root, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not root and context._jsc.sc().getCheckpointDir().isDefined():
        root = context._jsc.sc().getCheckpointDir().get()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: tables between steps need a folder that all executors share")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "viewloom-checkpoints")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def read_catalog(spark: SparkSession, root: str, exts: tuple[str, ...] = EXTENSION_VIDEO) -> DataFrame:
    """(path, length, modified) of all files below a folder with one of the extensions; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ends = F.lit(False)
    for e in exts:
        ends |= F.lower("path").endswith(e)
    return files.where(ends).select("path", "length", F.col("modificationTime").alias("modified"))


def read_annotations(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """Label exports (arrays of videos with their tricks) with their source file; and the records of another structure, kept aside."""
    from pyspark.sql import types as T

    schema = T.StructType([*ANNOTATION.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(schema).option("multiLine", True).json(glob).withColumn("file", F.col("_metadata.file_name"))
    good = F.col("video_url").isNotNull() & F.col("tricks").isNotNull()
    return rows.where(good).select("file", "video_url", "tricks"), rows.where(~good)


def read_task_plan(spark: SparkSession, path: str) -> DataFrame:
    """A JSON map of participants to their tasks in order, as (participant, position, task); positions start at 1."""
    text = spark.read.text(path, wholetext=True)
    plan = text.select(F.explode(F.from_json("value", TASK_PLAN)).alias("participant", "tasks"))
    return plan.select("participant", F.posexplode("tasks").alias("position", "task")).withColumn("position", F.col("position") + 1)


def unpivot_task_plan(wide: DataFrame, key: str = "participant", prefix: str = "Task_") -> DataFrame:
    """Columns Task_1, Task_2, ... as (participant, position, task); empty ones left out."""
    columns = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.unpivot([key], columns, "slot", "task")
    return long.select(key, F.substring_index("slot", "_", -1).cast("int").alias("position"), "task").where("task is not null and task <> ''")


def check_widths(frames: DataFrame, sizes: dict[str, int], width: int = 2) -> tuple[DataFrame, DataFrame]:
    """Frames whose parts are null or of their size and width, and the others."""
    fine = F.lit(True)
    for part, n in sizes.items():
        fine &= F.col(part).isNull() | ((F.size(part) == n) & F.forall(part, lambda p: F.size(p) == width))
    return frames.where(fine), frames.where(~fine)


def read_landmarks(spark: SparkSession, path: str, sizes: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Per-frame part arrays from Parquet; and the rows of another width, kept aside."""
    return check_widths(spark.read.parquet(path), sizes)


def _of_width(frames: DataFrame, sizes: dict[str, int], width: int) -> DataFrame:
    """The frames; a part of another size or with a point of another width ends the job with an error."""
    for part, n in sizes.items():
        bad = F.col(part).isNotNull() & ((F.size(part) != n) | ~F.forall(part, lambda p: F.coalesce(F.size(p) == width, F.lit(False))))
        frames = frames.withColumn(part, F.when(bad, F.raise_error(F.lit(f"{part} is not of {n} points of {width}"))).otherwise(F.col(part)))
    return frames


def write_landmarks(frames: DataFrame, path: str, sizes: dict[str, int], width: int = 2) -> None:
    """Write frames; a part of another size or width ends the job with an error."""
    _of_width(frames, sizes, width).write.mode("overwrite").parquet(path)


def segment_key() -> Column:
    """A segment as one text, task-subtask-start_end, as in its file's name; equal where all parts are equal."""
    second = lambda c: (F.col(c) + F.lit(0.0)).cast("string")  # noqa: E731  no -0.0
    return F.concat("task", F.lit("-"), "subtask", F.lit("-"), second("start_s"), F.lit("_"), second("end_s"))


def write_landmark_table(frames: DataFrame, name: str, path: str, sizes: dict[str, int], buckets: int, width: int = 2) -> DataFrame:
    """Write frames as the table ``name`` in ``path``, bucketed and sorted by participant, segment and frame, and read it.

    Segments are one column more, ``segment``, as doubles can't be keys of buckets.  Both views of a frame are in buckets of one number, so their join (``join_stereo_frames``) needs no
    exchange; the frame among the keys spreads a long segment over all buckets.
    """
    laid = _of_width(frames, sizes, width)
    if set(SEGMENT_KEYS) <= set(frames.columns):
        laid = laid.withColumn("segment", segment_key())
    by = ["participant", *(c for c in ("segment",) if c in laid.columns), "frame_idx"]
    laid = laid.repartition(buckets, *by)
    laid.write.mode("overwrite").format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return frames.sparkSession.table(name)


def read_calibrations(spark: SparkSession, glob: str) -> DataFrame:
    """npz calibration files ``participant_pair.npz`` as one row each with all their fields; arrays are flattened row by row, fields that a file lacks are null."""
    return decode_calibrations(spark.read.format("binaryFile").load(glob).select("path", "content"))


def npz_arrays(content: bytes, headers: dict) -> dict:
    """The arrays of an npz file by name, without pickled objects; ``headers`` holds what is known of array headers, most of a small array's time, from file to file."""
    import numpy as np
    from numpy.lib import format as npy

    out = {}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in z.namelist():
            raw = z.read(name)
            if raw[:7] != b"\x93NUMPY\x01":  # another version
                out[name.removesuffix(".npy")] = npy.read_array(io.BytesIO(raw), allow_pickle=False)
                continue
            size = 10 + int.from_bytes(raw[8:10], "little")
            if raw[:size] not in headers:
                head = io.BytesIO(raw[:size])
                npy.read_magic(head)
                headers[raw[:size]] = npy.read_array_header_1_0(head)
            shape, by_column, kind = headers[raw[:size]]
            if kind.hasobject:
                raise ValueError(f"{name} holds pickled objects")
            out[name.removesuffix(".npy")] = np.frombuffer(raw, kind, offset=size).reshape(shape, order="F" if by_column else "C")
    return out


def decode_calibrations(files: DataFrame) -> DataFrame:
    """``CALIBRATION`` rows of npz files (path, content)."""
    arrays = [f.name for f in CALIBRATION if f.dataType == DOUBLES]

    def decode(batches: Iterator) -> Iterator:
        import pandas as pd

        headers: dict = {}
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                z = npz_arrays(content, headers)
                stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                who, _, pair = stem.partition("_")
                row = {"participant": who, "pair": pair.removesuffix("_stereo"), "retval": float(z["retval"]) if "retval" in z else None}
                row |= {c: int(z[c]) if c in z else None for c in ("left_count", "right_count")}
                rows.append(row | {c: z[c].astype(float).ravel().tolist() if c in z else None for c in arrays})
            yield pd.DataFrame(rows, columns=CALIBRATION.names).astype({c: "Int64" for c in ("left_count", "right_count")})

    return files.mapInPandas(decode, CALIBRATION)


def write_by_view_subtask(rows: DataFrame, path: str, most_per_file: int = 100_000) -> None:
    """Laid out as view=../subtask=..; each group in as many files of about equal size as its number of rows asks for, each written by one task.

    The rows of every group are counted first; that table, a row a group, tells each row into how many files its group goes.
    """
    counts = rows.groupBy("view", "subtask").agg(F.ceil(F.count("*") / most_per_file).alias("_files"))
    counts = counts.select(F.col("view").alias("_view"), F.col("subtask").alias("_subtask"), "_files")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.agg(F.max("_files")).first()[0] or 1)
    same = F.col("view").eqNullSafe(F.col("_view")) & F.col("subtask").eqNullSafe(F.col("_subtask"))
    placed = rows.withColumn("_at", F.monotonically_increasing_id()).join(counts, same)
    # a group's files are next to each other, so no two of them meet in one task
    task = F.pmod(F.hash("view", "subtask") + F.pmod("_at", "_files"), F.lit(tasks)).cast("int")
    spread = placed.repartitionById(tasks, task).select(rows.columns)
    spread.write.option("maxRecordsPerFile", 2 * most_per_file).partitionBy("view", "subtask").mode("overwrite").parquet(path)


def append_new_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The distinct new rows that are not among the existing ones; nulls equal nulls."""
    left, right = new.distinct().alias("n"), existing.distinct().alias("e")
    same = F.lit(True)
    for c in new.columns:
        same &= F.col(f"n.{c}").eqNullSafe(F.col(f"e.{c}"))
    return left.join(right, same, "left_anti")


def write_report(rows: DataFrame, path: str, fmt: str = "csv") -> None:
    """CSV with a header (nested columns as JSON text), or JSON."""
    if fmt == "csv":
        nested = {c: F.to_json(c) for c, k in rows.dtypes if k.startswith(("map", "struct", "array"))}
        rows.withColumns(nested).write.mode("overwrite").option("header", True).csv(path)
    else:
        rows.write.mode("overwrite").format(fmt).save(path)
