"""Frames of two live views paired with their nearest ones, by state and event-time timers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from viewloom.operators.sync import sync_frames

#: The state store that holds lists and timers; a session's setting that a query reads when it starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Frames in one entry of the state.
PACKED = 10_000
_PAIR = ("l_idx", "r_idx", "l_t", "r_t", "dt")


def nearest(t: np.ndarray, idx: np.ndarray, others_t: np.ndarray, others_idx: np.ndarray) -> np.ndarray:
    """For each frame the place of the nearest other one, -1 without any; ties go to the earlier one, then to the smaller index.

    ``others_t`` ascend, and so do ``others_idx`` among equal times.
    """
    if not len(others_t):
        return np.full(len(t), -1)
    after = np.searchsorted(others_t, t, "right")
    before = others_t[np.maximum(after - 1, 0)]
    follows = others_t[np.minimum(after, len(others_t) - 1)]
    use_next = (after == 0) | ((after < len(others_t)) & (follows - t < t - before))
    return np.searchsorted(others_t, np.where(use_next, follows, before), "left")


def settled_pairs(frames: np.ndarray, tolerance: int, since: int, until: int) -> np.ndarray:
    """Rows (l_idx, r_idx, l_t, r_t, dt) of mutually nearest frames whose later one is after ``since`` and at ``until`` at the latest.

    ``frames``: rows (side, idx, t).
    """
    sides = [frames[frames[:, 0] == s] for s in (0, 1)]
    sides = [x[np.lexsort((x[:, 1], x[:, 2]))] for x in sides]
    (l_idx, l_t), (r_idx, r_t) = ((x[:, 1], x[:, 2]) for x in sides)
    to_right, to_left = nearest(l_t, l_idx, r_t, r_idx), nearest(r_t, r_idx, l_t, l_idx)
    own = np.flatnonzero(to_right >= 0)
    own = own[to_left[to_right[own]] == own] if len(own) else own
    other = to_right[own]
    dt, later = np.abs(l_t[own] - r_t[other]), np.maximum(l_t[own], r_t[other])
    fine = (dt <= tolerance) & (later > since) & (later <= until)
    own, other = own[fine], other[fine]
    return np.column_stack([l_idx[own], r_idx[other], l_t[own], r_t[other], dt[fine]])


class NearestPairs(StatefulProcessor):
    """One key's frames of both sides that are still needed.

    No frame at or before the watermark comes any more, so a frame's nearest is known once the watermark is a tolerance past it, and a pair once that holds for its later frame.  Frames of
    the last three tolerances before the watermark stay: those that wait, those that these may pair with, and those that these would rather pair with.
    """

    def __init__(self, keys: list[str], tolerance: int, columns: list[str]):
        self.keys, self.tolerance, self.columns = keys, tolerance, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.frames = handle.getListState("frames", "rows binary")  # a batch's (side, idx, t) in one entry, as an entry costs as much as thousands of rows in it
        self.out_until = handle.getValueState("out_until", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
        first = None
        for batch in rows:
            if not len(batch):
                continue
            self.frames.appendValue((batch[["side", "frame_idx", "t_ms"]].to_numpy(np.int64).tobytes(),))
            least = int(batch["t_ms"].min())
            first = least if first is None else min(first, least)
        if first is not None:
            self.handle.registerTimer(first + self.tolerance)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
        import pandas as pd

        watermark = int(timerValues.getCurrentWatermarkInMs())
        held = np.frombuffer(b"".join(rows for (rows,) in self.frames.get()), np.int64).reshape(-1, 3)
        since = self.out_until.get()[0] if self.out_until.exists() else np.iinfo(np.int64).min
        until = watermark - self.tolerance
        pairs = settled_pairs(held, self.tolerance, since, until)
        stay = held[held[:, 2] > watermark - 3 * self.tolerance]
        if len(stay):
            self.frames.put([(stay[i : i + PACKED].tobytes(),) for i in range(0, len(stay), PACKED)])
            self.out_until.update((max(since, until),))
            waiting = stay[stay[:, 2] > until, 2]
            self.handle.registerTimer(int(waiting.min() + self.tolerance if len(waiting) else stay[:, 2].max() + 3 * self.tolerance))
        else:
            self.frames.clear()
            self.out_until.clear()
        if len(pairs):
            out = dict(zip(_PAIR, pairs.T, strict=True))
            yield pd.DataFrame({**{k: [v] * len(pairs) for k, v in zip(self.keys, key, strict=True)}, **out})[self.columns]


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """While queries are started inside, the session names the store that ``stream_sync_nearest`` needs."""
    name, store = STATE_STORE
    held = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        spark.conf.set(name, held)


def stream_sync_nearest(left: DataFrame, right: DataFrame, keys: list[str], tolerance_ms: int, watermark: str = "1 minute") -> DataFrame:
    """Pairs of frames (``frame_idx``, ``t_ms`` since the epoch) of two live views that are each other's nearest, at most ``tolerance_ms`` apart; ties go to the earlier frame.

    Gives the rows of ``sync_frames``, to which it turns for batches; a stream gives a pair out once both sides' watermarks have passed its later frame by the tolerance, and drops frames
    that come after the watermark.  A key's state holds the frames of three tolerances and of the watermark's delay.  The query that runs it is started
    inside ``state_store``.
    """
    if not (left.isStreaming or right.isStreaming):
        return sync_frames(left, right, keys, tolerance_ms)

    def side(frames: DataFrame, number: int) -> DataFrame:
        own = frames.select(*keys, F.lit(number).alias("side"), F.col("frame_idx").cast("long").alias("frame_idx"), F.col("t_ms").cast("long").alias("t_ms"), F.timestamp_millis("t_ms").alias("_event"))
        own = own.where("t_ms is not null and frame_idx is not null")
        return own.withWatermark("_event", watermark)

    both = side(left, 0).unionByName(side(right, 1))
    out = T.StructType([*(both.schema[k] for k in keys), *(T.StructField(c, T.LongType()) for c in _PAIR)])
    work = NearestPairs(keys, tolerance_ms, out.names)
    return both.groupBy(*keys).transformWithStateInPandas(work, out, "Append", "EventTime")
