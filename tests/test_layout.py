"""Tables laid out for their joins, files by measured sizes, order without one task, time covers, incremental batches."""

from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from viewloom import fixtures, plans, sources, streaming
from viewloom.functions import frames, order
from viewloom.operators import annotations, stereo, sync


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_stereo_join_of_bucketed_tables_has_no_exchange(spark, sf_dir, tmp_path, no_broadcast):
    lm, sizes = fixtures.stereo_landmarks(spark, sf_dir), {p: b - a for p, (a, b) in fixtures.SPAN.items()}
    laid = sources.write_landmark_table(lm, "laid_landmarks", str(tmp_path / "laid"), sizes, 3)
    try:
        matrices = stereo.projection_matrices(fixtures.calibration(spark, sf_dir))
        plain, joined = stereo.join_stereo_frames(lm, matrices), stereo.join_stereo_frames(laid, matrices)
        assert "Exchange hashpartitioning" in plan_of(plain) and "SortMergeJoin" in plan_of(joined)
        assert "Exchange hashpartitioning" not in plan_of(joined)
        assert sorted(map(str, joined.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
        assert joined.count() > 0
    finally:
        spark.sql("DROP TABLE laid_landmarks")


def test_inner_widths_are_checked(spark, tmp_path):
    for k, bad in enumerate(([[1.0]], [None], [[1.0, 2.0, 3.0]])):
        df = spark.createDataFrame([(1, bad)], "f int, face array<array<double>>")
        with pytest.raises(PySparkException):
            sources.write_landmarks(df, str(tmp_path / str(k)), {"face": 1})
    sources.write_landmarks(spark.createDataFrame([(1, [[1.0, 2.0, 3.0]]), (2, None)], "f int, face array<array<double>>"), str(tmp_path / "fine"), {"face": 1}, width=3)


def test_groups_are_written_by_their_sizes(spark, tmp_path):
    sizes = {("CAM_LL", "HPS"): 4820, ("CAM_LL", "RPCS"): 35, ("CAM_AV", "HPS"): 1500, (None, "RPS"): 7}
    rows = [(*g, 1.0) for g, n in sizes.items() for _ in range(n)]  # equal rows, which no hash tells apart
    spark.createDataFrame(rows, "view string, subtask string, x double").repartition(5).write.parquet(str(tmp_path / "in"))
    sources.write_by_view_subtask(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"), most_per_file=1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)
    files = back.groupBy("view", "subtask", F.col("_metadata.file_path")).count().collect()
    by_group = {}
    for r in files:
        by_group.setdefault((r["view"], r["subtask"]), []).append(r["count"])
    assert {g: len(n) for g, n in by_group.items()} == {("CAM_LL", "HPS"): 5, ("CAM_LL", "RPCS"): 1, ("CAM_AV", "HPS"): 2, (None, "RPS"): 1}
    assert all(max(n) <= 2 * min(n) for n in by_group.values())


def test_order_without_one_task(spark):
    rng = np.random.default_rng(5)
    rows = [(f"k{v:03d}", int(v) % 7) for v in rng.permutation(400)]
    df = spark.createDataFrame([*rows, (None, 3)], "k string, n long").repartition(6)
    want = sorted([*rows, (None, 3)], key=lambda r: (r[0] is not None, r[0] or ""))
    placed = order.numbered(df, ["k"], "at")
    assert [r["k"] for r in sorted(placed.collect(), key=lambda r: r["at"])] == [k for k, _ in want]
    total, sums = 0, {}
    for k, n in want:
        total += n
        sums[k] = total
    summed = order.running_sum(df, ["k"], "n", "up_to")
    assert {r["k"]: r["up_to"] for r in summed.collect()} == sums
    assert "SinglePartition" not in plan_of(summed) and "SinglePartition" not in plan_of(placed)
    assert order.numbered(df.limit(0), ["k"], "at").count() == 0


def test_gaps_are_found_by_words_of_bits(spark):
    streams = {
        "fine": range(200), "one": [0], "gap": [0, 1, 3], "twice": [0, 1, 1], "late": [1, 2, 3], "long gap": [*range(64), *range(65, 129)], "repeat for gap": [0, 2, 2], "negative": [-1, 0, 1], "null": [0, None],
    }
    df = spark.createDataFrame([(k, i) for k, v in streams.items() for i in v], "s string, i long")
    found = frames.irregular(df, ["s"], "i")
    assert {r["s"] for r in found.collect()} == set(streams) - {"fine", "one"}
    plan = plan_of(found)
    assert "hashpartitioning(s" in plan and not any("hashpartitioning(s" in x and ", i#" in x for x in plan.splitlines())


def test_long_segments_are_tens_of_rows(spark):
    rng = np.random.default_rng(6)
    clips = [("p", j, float(s), float(s + d)) for j, (s, d) in enumerate(zip(rng.uniform(-40_000, 40_000, 40), rng.uniform(0, 30_000, 40), strict=True))] + [("p", 90, 16.0, 32.0), ("p", 91, 0.0, 1e-9), ("p", 92, 5.0, 5.0), ("p", 93, -48.0, 64.0)]
    rows = [("p", i, float(t)) for i, t in enumerate([*rng.uniform(-45_000, 70_000, 300), 0.0, 16.0, 32.0, -16.0])]
    segments = spark.createDataFrame(clips, "k string, j long, start_s double, end_s double")
    df = spark.createDataFrame(rows, "k string, i long, media_t double")
    got = annotations.assign_segments(df, segments, ["k"]).select("i", "j").collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for _, i, t in rows for _, j, a, b in clips if a <= t < b)
    cover = segments.where("end_s > start_s").select(F.size(annotations.interval_cover(F.floor(F.col("start_s") / 16), F.ceil(F.col("end_s") / 16) - 1)).alias("n"), ((F.col("end_s") - F.col("start_s")) / 16).alias("buckets"))
    assert all(r["n"] <= max(4, 2 * np.log2(r["buckets"] + 2) + 2) for r in cover.collect()) and cover.agg(F.max("buckets")).first()[0] > 1000


@pytest.mark.parametrize(("tolerance", "chunk"), [(9, 9), (9, 40), (30, 100), (0, 5), (200, 250)])
def test_greedy_in_chunks_is_the_sequential_rule(spark, tolerance, chunk):
    rng = np.random.default_rng(7)
    make = lambda n, most: [(k, i, int(t)) for k in "pqr" for i, t in enumerate(np.sort(rng.integers(0, most, n)))]
    left, right = make(90, 900) + [("s", i, i * 400) for i in range(5)], make(70, 900) + [("s", i, i * 400 + 3) for i in range(5)] + [("only right", 0, 5)]
    df = lambda rows: spark.createDataFrame(rows, "participant string, frame_idx long, t_ms long").repartition(3)
    args = df(left), df(right), ["participant"], tolerance
    got, want = sync.sync_frames_greedy(*args, chunk_ms=chunk), sync.sync_frames_sequential(*args)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    tasks = Counter(r["chunk"] for r in df(left).select(F.floor(F.col("t_ms") / chunk).alias("chunk")).collect())
    assert max(tasks.values()) < len(left)


def test_each_pair_of_videos_has_its_own_tolerance(spark):
    """A 30 fps video anywhere must not let frames of a 60 fps pair 30 ms apart match."""
    rows = [("fast", v, "a.mp4", i, i * 100 + off) for v, off in (("CAM_LL", 0), ("CAM_LR", 30)) for i in range(5)]
    rows += [("slow", v, "a.mp4", i, i * 100 + off) for v, off in (("CAM_LL", 0), ("CAM_LR", 30)) for i in range(5)]
    f = spark.createDataFrame(rows, "participant string, view string, video string, frame_idx long, t_ms long")
    videos = spark.createDataFrame([(p, v, "a.mp4", fps, 5) for p, fps in (("fast", 60.0), ("slow", 30.0)) for v in ("CAM_LL", "CAM_LR")], "participant string, view string, video string, fps double, frame_count long")
    got = plans.synchronised(f, videos=videos, keys=("participant", "video")).collect()
    assert {r["participant"] for r in got} == {"slow"} and len(got) == 5
    assert plans.synchronised(f, tolerance_ms=34, videos=videos, keys=("participant", "video")).count() == 10


def test_a_batch_that_is_repeated_leaves_each_row_once(spark, tmp_path, monkeypatch):
    src, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.range(30).repartition(3).write.parquet(src)
    schema, write, fails = spark.range(1).schema, DataFrameWriter.parquet, [True]
    run = lambda: streaming.incremental_features(spark, src, schema, lambda b: b, sink, state, per_run=1).awaitTermination()

    def breaks(self, path, *more, **options):
        if "_manifest" in path and fails:
            fails.pop()
            raise OSError("between the two writes")
        write(self, path, *more, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", breaks)
    with pytest.raises(Exception, match="between the two writes"):
        run()
    first = spark.read.parquet(sink).count()
    assert 0 < first < 30 and not fails
    run()
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == list(range(30))
    assert spark.read.parquet(f"{sink}_manifest").select("file").distinct().count() == spark.read.parquet(src).select("_metadata.file_path").distinct().count()


def test_plans_of_later_batches_do_not_grow(spark, tmp_path):
    src, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.range(12).repartition(12).write.parquet(src)
    plans_seen = []

    def work(batch):
        plans_seen.append((len(batch._jdf.queryExecution().logical().toString()), "Join" in batch._jdf.queryExecution().logical().toString()))
        return batch

    streaming.incremental_features(spark, src, spark.range(1).schema, work, sink, state, per_run=1).awaitTermination()
    assert len(plans_seen) >= 8 and not any(j for _, j in plans_seen) and plans_seen[-1][0] <= plans_seen[0][0] + 100
