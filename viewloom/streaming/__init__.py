"""Structured Streaming forms: incremental features, a live label feed, two live views paired in time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from viewloom.functions.frames import look_direction

#: Frames of a live view that a task packs at once, and those in one pack at most.
PACKED_AT_ONCE, PACKED = 200_000, 4_096
#: Rows of a whole feed that one part of a query's state is meant for.
STATE_ROWS = 100_000


@contextmanager
def state_parts(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries that are first started inside hold their state in as many parts as the ``rows`` of their feed ask for, one a core at least: each batch commits all parts, empty ones too."""
    name = "spark.sql.shuffle.partitions"
    held = spark.conf.get(name)
    spark.conf.set(name, str(max(spark.sparkContext.defaultParallelism, -(-rows // STATE_ROWS))))
    try:
        yield
    finally:
        spark.conf.set(name, held)


def incremental_features(
    spark: SparkSession, source: str, schema, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, per_run: int = 100, manifest: str | None = None
) -> StreamingQuery:
    """Process the files that are new since the last run, ``per_run`` at a time, and write the results with their ``file``, its whole path.

    Files are known by their paths, so equal names in different folders are different files.  A batch owns the folders ``run=<query's id>/batch=<its number>`` of the sink and of the
    ``manifest`` (``sink`` + "_manifest"), which lists the files done, and overwrites them: a batch that is repeated after a failure, also one between the two writes, leaves each row once,
    and reads neither.  The files of runs under other checkpoints are left out; their manifests are looked up when a run begins, and read only where there are any.
    ``work`` has to keep the column ``file``.
    """
    manifest = manifest or sink.rstrip("/") + "_manifest"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_run).option("recursiveFileLookup", True).parquet(source).withColumn("file", F.col("_metadata.file_path"))
    others: dict[str, DataFrame | None] = {}

    def done_elsewhere(session: SparkSession, run: str) -> DataFrame | None:
        """Files that runs under other checkpoints have done before this one began; None where there are none."""
        if run not in others:
            try:
                listed = session.read.schema("file string, run string, batch long").parquet(manifest).where(F.col("run") != run)
                others[run] = listed.select("file") if listed.limit(1).count() else None
            except AnalysisException as e:  # the first run finds nothing
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                others[run] = None
        return others[run]

    def write(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        run = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        listed = batch.select("file").distinct()
        done = done_elsewhere(own, run)
        if done is not None:
            listed = listed.join(done, "file", "left_anti")
            batch = batch.join(F.broadcast(listed), "file", "left_semi")  # at most ``per_run`` paths
        out = work(batch)
        if "file" not in out.columns:
            raise ValueError("work has to keep the column file")
        out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/run={run}/batch={number}")
        listed.write.mode("overwrite").parquet(f"{manifest.rstrip('/')}/run={run}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def labelled(angles: DataFrame) -> DataFrame:
    return angles.withColumn("label", look_direction(F.col("x"), F.col("y")))


def live_look_direction(angles: DataFrame, watermark: str = "10 seconds", window: str = "1 second") -> DataFrame:
    """Frames of each label in every tumbling window of event time ``ts``; the same on a batch and on a stream."""
    frames = labelled(angles)
    if frames.isStreaming:
        frames = frames.withWatermark("ts", watermark)
    g = frames.groupBy(F.window("ts", window), "label").agg(F.count("*").alias("frames"))
    return g.select(F.col("window.start").alias("start"), "label", "frames")


def live_rate(frames: DataFrame, watermark: str = "10 seconds", seconds: int = 1) -> DataFrame:
    """Frames a second in every tumbling window of ``seconds`` of event time ``ts``; the same on a batch and on a stream."""
    if frames.isStreaming:
        frames = frames.withWatermark("ts", watermark)
    g = frames.groupBy(F.window("ts", f"{seconds} seconds")).agg(F.count("*").alias("frames"))
    return g.select(F.col("window.start").alias("start"), "frames", (F.col("frames") / float(seconds)).alias("fps"))


def _width(spark: SparkSession, tolerance: str) -> int:
    """Microseconds that no interval of ``tolerance`` exceeds; months and days are of several lengths, so those get a quarter more."""
    micros = spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + interval {tolerance}) AS m").first()["m"]
    return max(micros if micros < 86_400_000_000 else micros + micros // 4, 1)


def _packs(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Frames (``keys``, ``_bucket``, ``idx``, ``ts``) of equal keys and bucket in one row of each batch: ``frames``, an array of (idx, ts), and ``at``, the last of the bucket's times.

    Rows are split beyond ``PACKED`` frames, and a task holds ``PACKED_AT_ONCE`` frames and one Arrow batch at most.
    """
    place = [*keys, "_bucket"]
    kind = frames.schema
    out = T.StructType([*(kind[c] for c in place), T.StructField("at", T.TimestampType()), T.StructField("frames", T.ArrayType(T.StructType([kind["idx"], kind["ts"]])))])
    at_once, most = PACKED_AT_ONCE, PACKED

    def packed(held: list):
        import pyarrow as pa

        groups = pa.Table.from_batches(held).group_by(place, use_threads=False).aggregate([("idx", "list"), ("ts", "list"), ("ts", "max")]).combine_chunks()
        idx, ts = (groups[f"{c}_list"].chunk(0) for c in ("idx", "ts"))
        size = np.diff(idx.offsets.to_numpy())
        rows = -(-size // most)
        of = np.repeat(np.arange(len(size)), rows)
        start = np.repeat(np.cumsum(size) - size, rows) + most * (np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows))
        both = pa.StructArray.from_arrays([idx.flatten(), ts.flatten()], names=["idx", "ts"])
        lists = pa.ListArray.from_arrays(pa.array([*start, size.sum()], pa.int32()), both)
        taken = groups.take(pa.array(of))
        return pa.table([*(taken[c] for c in place), taken["ts_max"], lists], names=out.names).to_batches()

    def pack(batches: Iterator) -> Iterator:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= at_once:
                yield from packed(held)
                held, n = [], 0
        if held:
            yield from packed(held)

    return frames.repartition(*place).mapInArrow(pack, out)


def stream_sync(left: DataFrame, right: DataFrame, keys: list[str], tolerance: str, watermark: str = "1 minute") -> DataFrame:
    """All pairs of two live views at most ``tolerance`` apart in event time ``ts``; both watermarks bound the state.

    Frames meet in buckets of time as wide as the tolerance, the right side in its own and both neighbours, so a frame is compared with those of three tolerances, never with a key's whole stream.
    Between two streams it is packs that meet, a row for a batch's frames of one bucket: an entry of the state costs as much as many frames in it.  A frame that comes after the watermark
    is dropped unless its pack has one that doesn't.  Pairs of packs are opened after the join; their times carry no watermark.
    """
    width = _width(left.sparkSession, tolerance)
    bucket = lambda ts: F.expr(f"cast(unix_micros({ts}) - pmod(unix_micros({ts}), {width}L) as bigint)")
    buckets = lambda own: F.explode(F.array(*(own + F.lit(n) for n in (-width, 0, width))))
    same = F.col("_l_bucket") == F.col("_r_bucket")
    for k in keys:
        same &= F.col(f"l_{k}") == F.col(f"r_{k}")
    near = F.expr(f"r_ts between l_ts - interval {tolerance} and l_ts + interval {tolerance}")
    pair = [*(F.col(f"l_{k}").alias(k) for k in keys), "l_idx", "r_idx", "l_ts", "r_ts"]
    if left.isStreaming and right.isStreaming:

        def side(frames: DataFrame, s: str) -> DataFrame:
            own = frames.select(*keys, F.col("frame_idx").alias("idx"), "ts").where(" and ".join(f"`{c}` is not null" for c in [*keys, "ts"]))
            packs = _packs(own.withColumn("_bucket", bucket("ts")), keys)
            return packs.select(*(F.col(k).alias(f"{s}_{k}") for k in keys), F.col("_bucket").alias(f"_{s}_bucket"), F.col("at").alias(f"_{s}_at"), F.col("frames").alias(f"_{s}")).withWatermark(f"_{s}_at", watermark)

        a, b = side(left, "l"), side(right, "r")
        b = b.withColumn("_r_bucket", buckets(F.col("_r_bucket")))
        # no pack has times more than a width apart, nor a pair; so this holds for all packs with a pair, and tells Spark which are of no use any more
        close = F.expr(f"_r_at between _l_at - interval {2 * width} microseconds and _l_at + interval {2 * width} microseconds")
        opened = a.join(b, same & close).select(*(f"l_{k}" for k in keys), F.inline("_l").alias("l_idx", "l_ts"), "_r")
        ends = (F.expr(f"l_ts {sign} interval {tolerance}").alias(c) for sign, c in (("-", "_from"), ("+", "_to")))  # once a frame, not once a pair
        opened = opened.select(*(f"l_{k}" for k in keys), "l_idx", "l_ts", *ends, "_r").select("*", F.inline("_r").alias("r_idx", "r_ts"))
        return opened.where("r_ts between _from and _to").select(*pair)
    a = left.select(*(F.col(k).alias(f"l_{k}") for k in keys), F.col("frame_idx").alias("l_idx"), F.col("ts").alias("l_ts"))
    b = right.select(*(F.col(k).alias(f"r_{k}") for k in keys), F.col("frame_idx").alias("r_idx"), F.col("ts").alias("r_ts"))
    if a.isStreaming:
        a, b = a.withWatermark("l_ts", watermark), b.withWatermark("r_ts", watermark)
    a, b = a.withColumn("_l_bucket", bucket("l_ts")), b.withColumn("_r_bucket", buckets(bucket("r_ts")))
    return a.join(b, near & same).select(*pair)
