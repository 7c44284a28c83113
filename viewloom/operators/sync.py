"""Bringing cameras together: pairs of videos, common rate and length, frames paired in time."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.frames import renumbered


def pair_views(videos: DataFrame, reference: str, targets: list[str]) -> tuple[DataFrame, DataFrame]:
    """Each reference video with the one of the same name of every target view; and the targets that are missing."""
    ref = videos.where(F.col("view") == reference).select("participant", "video", F.col("fps").alias("ref_fps"), F.col("frame_count").alias("ref_frames"))
    expected = ref.withColumn("view", F.explode(F.array(*map(F.lit, targets))))
    own = videos.where(F.col("view").isin(targets)).select("participant", "view", "video", "fps", "frame_count")
    key = ["participant", "view", "video"]
    return expected.join(own, key), expected.join(own.select(*key), key, "left_anti").select(*key)


def _counts(frames: DataFrame, stream: list[str]) -> DataFrame:
    """One row a stream: its length.  Partial sums make this shuffle small, whatever the number of frames."""
    return frames.groupBy(*stream).agg((F.max("frame_idx") + 1).alias("frames"))


def harmonize_fps(frames: DataFrame, videos: DataFrame, group: list[str], stream: list[str], gaps: bool | None = None) -> DataFrame:
    """Keep frames at the group's lowest fps: those with idx % (fps / target) < 1, renumbered as ``new_idx``.

    The rate is decided on the table of videos and joined to frames.  The remainder of doubles is exact, so just one frame is kept in each step of fps / target, and the step's number is the
    new index; frames of streams with gaps (``gaps``, None: counted first) are put in order for it.
    """
    rates = videos.select(*stream, "fps").where("fps > 0")
    least = rates.groupBy(*group).agg(F.min("fps").alias("target_fps"))
    decided = rates.join(least, group).select(*stream, (F.col("fps") / F.col("target_fps")).alias("ratio"), "target_fps")
    kept = frames.join(decided, stream).where(F.col("frame_idx") % F.col("ratio") < 1)
    step = F.round((F.col("frame_idx") - F.col("frame_idx") % F.col("ratio")) / F.col("ratio"))
    return renumbered(frames, kept, stream, "frame_idx", "new_idx", step, gaps).drop("ratio")


def match_length(frames: DataFrame, group: list[str], stream: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first frames of every member, as many as the shortest of its group has; and by how much each was trimmed."""
    n = _counts(frames, stream)
    least = n.groupBy(*group).agg(F.min("frames").alias("keep"))
    report = n.join(least, group).withColumn("trimmed", F.col("frames") - F.col("keep"))
    return frames.join(report.select(*stream, "keep"), stream).where(F.col("frame_idx") < F.col("keep")).drop("keep"), report


def drop_leading(frames: DataFrame, group: list[str], stream: list[str]) -> DataFrame:
    """Without the surplus at the front of the longer members, renumbered from 0."""
    n = _counts(frames, stream)
    least = n.groupBy(*group).agg(F.min("frames").alias("keep"))
    surplus = n.join(least, group).select(*stream, (F.col("frames") - F.col("keep")).alias("surplus"))
    kept = frames.join(surplus, stream).where(F.col("frame_idx") >= F.col("surplus"))
    return kept.withColumn("frame_idx", F.col("frame_idx") - F.col("surplus")).drop("surplus")


def time_candidates(left: DataFrame, right: DataFrame, keys: list[str], tolerance_ms: float | str) -> DataFrame:
    """Frames of both sides at most ``tolerance_ms`` apart (a number, or the name of both sides' column that has one for each key): equal buckets of that width, the right side in its own
    and both neighbours."""
    width = F.col(tolerance_ms) if isinstance(tolerance_ms, str) else F.lit(tolerance_ms)
    bucket = F.floor(F.col("t_ms") / width).cast("long")
    a = left.select(*keys, F.col("frame_idx").alias("l_idx"), F.col("t_ms").alias("l_t"), bucket.alias("_b"), width.alias("_width"))
    b = right.select(*keys, F.col("frame_idx").alias("r_idx"), F.col("t_ms").alias("r_t"), bucket.alias("_own"))
    b = b.withColumn("_b", F.explode(F.array(F.col("_own") - 1, F.col("_own"), F.col("_own") + 1))).drop("_own")
    near = a.join(b, [*keys, "_b"]).withColumn("dt", F.abs(F.col("l_t") - F.col("r_t")))
    return near.where(F.col("dt") <= F.col("_width")).drop("_b", "_width")


def sync_frames(left: DataFrame, right: DataFrame, keys: list[str], tolerance_ms: float | str) -> DataFrame:
    """Pairs of frames that are each other's nearest within the tolerance (as in ``time_candidates``); ties go to the earlier frame.

    Candidates are made once.  One aggregation, which combines before the shuffle, finds the nearest of the frames of both sides; pairs that were found
    from either side are left by a second, of two rows a frame.
    """
    near = time_candidates(left, right, keys, tolerance_ms)
    own = lambda s, o: F.struct(F.lit(s).alias("side"), F.col(f"{s}_idx").alias("idx"), F.struct("dt", F.col(f"{o}_t").alias("other_t"), F.col(f"{o}_idx").alias("other"), F.col(f"{s}_t").alias("t")).alias("best"))
    ends = near.select(*keys, F.inline(F.array(own("l", "r"), own("r", "l"))))
    best = ends.groupBy(*keys, "side", "idx").agg(F.min("best").alias("b"))
    from_left = F.col("side") == "l"
    pick = lambda a, b: F.when(from_left, F.col(a)).otherwise(F.col(b))
    pair = best.select(*keys, pick("idx", "b.other").alias("l_idx"), pick("b.other", "idx").alias("r_idx"), pick("b.t", "b.other_t").alias("l_t"), pick("b.other_t", "b.t").alias("r_t"), F.col("b.dt").alias("dt"))
    return pair.groupBy(*keys, "l_idx", "r_idx").agg(*(F.min(c).alias(c) for c in ("l_t", "r_t", "dt")), F.count("*").alias("_n")).where("_n = 2").drop("_n")


def sync_frames_sequential(left: DataFrame, right: DataFrame, keys: list[str], tolerance_ms: int) -> DataFrame:
    """The rule of ``sync_frames_greedy`` with each stream in one task; of use where streams are many and short."""
    both, out = _merged(left, right, keys)

    def pair(batches: Iterator) -> Iterator:
        import pandas as pd

        stream, waiting, side = None, deque(), 0
        for batch in batches:
            rows = []
            for *own, idx, t, s in zip(*(batch[c].tolist() for c in [*keys, "idx", "t_ms", "side"]), strict=True):
                if own != stream:
                    stream = own
                    waiting.clear()
                side, found = _meet(waiting, side, s, idx, t, tolerance_ms)
                if found:
                    rows.append((*own, *found))
            yield pd.DataFrame(rows, columns=out.names)

    return both.repartition(*keys).sortWithinPartitions(*keys, "t_ms", "side", "idx").mapInPandas(pair, out)


def _merged(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, T.StructType]:
    a = left.select(*keys, F.col("frame_idx").alias("idx"), "t_ms", F.lit(0).alias("side"))
    b = right.select(*keys, F.col("frame_idx").alias("idx"), "t_ms", F.lit(1).alias("side"))
    return a.unionByName(b), T.StructType([*(a.schema[k] for k in keys), *(T.StructField(c, T.LongType()) for c in ("l_idx", "r_idx", "l_t", "r_t", "dt"))])


def _meet(waiting: deque, side: int, s: int, idx: int, t: int, tolerance_ms: int) -> tuple[int, tuple | None]:
    """The next frame in time: it waits behind those of its own side, or takes the first waiting one of the other side that is near enough.  Gives the side that waits, and the pair."""
    if s != side:
        while waiting and t - waiting[0][1] > tolerance_ms:
            waiting.popleft()
        if waiting:
            other, u = waiting.popleft()
            return side, (*((other, idx, u, t) if s else (idx, other, t, u)), t - u)
    waiting.append((idx, t))
    return s, None


def sync_frames_greedy(left: DataFrame, right: DataFrame, keys: list[str], tolerance_ms: int, chunk_ms: int | None = None) -> DataFrame:
    """The sequential pairing: both sides in time order, each frame used once, the side that is behind moves on.

    Streams are cut into chunks of time (``chunk_ms``, the tolerance at least).  What a chunk has to know of the frames before it is which side waits and how many of its last frames do, all
    within the tolerance: a few states.  Each chunk is run from every one of them, which gives the states that it can leave behind; these are chained, a row a chunk; then each chunk is
    run once more from its true state and gives its pairs.  So no task holds a stream's frames.
    """
    chunk_ms = max(chunk_ms or max(600_000, 4 * tolerance_ms), tolerance_ms, 1)
    both, out = _merged(left, right, keys)
    chunk = F.floor(F.col("t_ms") / chunk_ms).cast("long")
    own = both.withColumns({"chunk": chunk, "ahead": F.lit(False)})
    # frames that may still wait when the next chunk begins
    ahead = both.where(F.col("t_ms") >= (chunk + 1) * chunk_ms - tolerance_ms).withColumns({"chunk": chunk + 1, "ahead": F.lit(True)})
    place = [*keys, "chunk"]
    frames = own.unionByName(ahead).select(*place, "t_ms", "side", "idx", "ahead")
    state = T.StructType([*(both.schema[k] for k in keys), T.StructField("chunk", T.LongType()), *(T.StructField(c, T.IntegerType()) for c in ("side", "n", "to_side", "to_n"))])
    n_keys = len(place)

    def chunks(batches: Iterator) -> Iterator[tuple[tuple, list[list], list, tuple]]:
        """Of each chunk its keys, the frames of either side that may wait, its own frames in time order, and what else its rows hold."""
        key, held, now, rest = None, [[], []], [], ()
        for batch in batches:
            for row in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
                if row[:n_keys] != key:
                    if now:
                        yield key, held, now, rest
                    key, held, now, rest = row[:n_keys], [[], []], [], row[n_keys + 4 :]
                t, side, idx, before = row[n_keys : n_keys + 4]
                if before:
                    held[side].append((idx, t))
                else:
                    now.append((side, idx, t))
        if now:
            yield key, held, now, rest

    def in_turn(rows: list[tuple], names: list[str], least: int = 4096) -> Iterator:
        """The rows as one frame and none left, once there are ``least``."""
        import pandas as pd

        if len(rows) >= least:
            yield pd.DataFrame(rows, columns=names)
            rows.clear()

    def states(batches: Iterator) -> Iterator:
        rows: list[tuple] = []
        for key, held, now, _ in chunks(batches):
            floor, passed = (key[-1] + 1) * chunk_ms - tolerance_ms, {}  # after so many frames, in such a state: the state that is left behind
            for s, n in [(0, 0), *((s, n) for s in (0, 1) for n in range(1, len(held[s]) + 1))]:
                side, waiting, seen, left_behind = s, deque(held[s][-n:] if n else []), [], None
                for i, (fs, idx, t) in enumerate(now):
                    side, _ = _meet(waiting, side, fs, idx, t, tolerance_ms)
                    at = (i, side, len(waiting), waiting[0] if waiting else None)
                    if at in passed:
                        left_behind = passed[at]
                        break
                    seen.append(at)
                if left_behind is None:
                    still = sum(t >= floor for _, t in waiting)
                    left_behind = (side if still else 0, still)
                passed |= dict.fromkeys(seen, left_behind)
                rows.append((*key, s, n, *left_behind))
            yield from in_turn(rows, state.names)
        yield from in_turn(rows, state.names, 1)

    def chain(batches: Iterator) -> Iterator:
        rows: list[tuple] = []
        last, now, following = None, (0, 0), (0, 0)
        for batch in batches:
            for *key, s, n, to_s, to_n in zip(*(batch[c].tolist() for c in state.names), strict=True):
                if key != last:
                    follows = last is not None and key[:-1] == last[:-1] and key[-1] == last[-1] + 1
                    now, last = following if follows else (0, 0), key
                if (s, n) == now:
                    following = (to_s, to_n)
                    rows.append((*key, s, n, to_s, to_n))
            yield from in_turn(rows, state.names)
        yield from in_turn(rows, state.names, 1)

    def replay(batches: Iterator) -> Iterator:
        rows: list[tuple] = []
        for key, held, now, (s, n) in chunks(batches):
            side, waiting = s, deque(held[s][-n:] if n else [])
            for fs, idx, t in now:
                side, found = _meet(waiting, side, fs, idx, t, tolerance_ms)
                if found:
                    rows.append((*key[:-1], *found))
            yield from in_turn(rows, out.names)
        yield from in_turn(rows, out.names, 1)

    order = [*place, "t_ms", "side", "idx"]
    every = frames.repartition(*place).sortWithinPartitions(*order).mapInPandas(states, state)
    true = every.repartition(*keys).sortWithinPartitions(*place, "side", "n").mapInPandas(chain, state)
    begun = true.select(*place, F.col("side").alias("_side"), F.col("n").alias("_n"))
    placed = frames.join(begun, place).select(*frames.columns, "_side", "_n")
    return placed.repartition(*place).sortWithinPartitions(*order).mapInPandas(replay, out)
