"""Live views paired by state: the rows of the batch form, a bounded state, late rows."""

import numpy as np
import pytest

from viewloom import streaming
from viewloom.operators.sync import sync_frames
from viewloom.streaming import nearest

SCHEMA = "participant string, frame_idx long, t_ms long"
TOLERANCE = 20


def made(step, n, seed):
    jitter = np.random.default_rng(seed).integers(0, 9, (2, n))
    return [(k, i, 1_000_000 + i * step + int(jitter[j, i])) for j, k in enumerate("pq") for i in range(n)]


def feed(spark, path, rows, parts, late=()):
    """A file for each slice of time, read one at a time."""
    lo, hi = min(r[2] for r in rows), max(r[2] for r in rows) + 1
    for k in range(parts):
        a, b = (lo + (hi - lo) * x // parts for x in (k, k + 1))
        spark.createDataFrame([r for r in rows if a <= r[2] < b] or [("none", 0, a)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        for k, old in [x for x in late if x[0] == k]:
            spark.createDataFrame([old], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("last", 0, hi + 1_000_000)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, left, right, folder, delay):
    pairs = nearest.stream_sync_nearest(left, right, ["participant"], TOLERANCE, f"{delay} milliseconds")
    with nearest.state_store(spark):
        job = pairs.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).format("parquet").option("path", f"{folder}/out").start()
        job.awaitTermination()
    rows = spark.read.schema(pairs.schema).parquet(f"{folder}/out").where("participant in ('p', 'q')")
    return sorted(map(tuple, rows.collect())), [p["stateOperators"][0] for p in job.recentProgress if p["stateOperators"]]


def test_stream_equals_batch_with_a_bounded_state(spark, tmp_path):
    left, right = made(33, 400, 1), made(41, 320, 2)
    late = [(5, ("p", 9_999, 1_000_100)), (5, ("q", 9_998, 1_000_050))]
    before = spark.conf.get(nearest.STATE_STORE[0])
    got, states = run(spark, feed(spark, str(tmp_path / "l"), left, 8, late), feed(spark, str(tmp_path / "r"), right, 8), tmp_path, 50)
    want = sync_frames(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["participant"], TOLERANCE)
    assert got == sorted(map(tuple, want.select("participant", "l_idx", "r_idx", "l_t", "r_t", "dt").collect())) and len(got) > 300
    assert spark.conf.get(nearest.STATE_STORE[0]) == before
    assert sum(s["numRowsDroppedByWatermark"] for s in states) >= 2
    held = [s["numRowsTotal"] for s in states]
    assert max(held) < 0.45 * (len(left) + len(right))  # a slice is an eighth; the other side's slice waits beside it


def test_settled_pairs_are_those_of_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = rng.integers(0, 12)
        f = np.column_stack([rng.integers(0, 2, n), np.arange(n), rng.integers(0, 30, n)]).reshape(-1, 3)
        got = {tuple(r) for r in nearest.settled_pairs(f, 6, -1, 20).tolist()}
        ls, rs = ([(int(i), int(t)) for s, i, t in f if s == k] for k in (0, 1))
        best = lambda x, others: min(((abs(x[1] - o[1]), o[1], o[0]) for o in others), default=None)
        want = set()
        for left in ls:
            d = best(left, rs)
            if d and d[0] <= 6 and best((d[2], d[1]), ls)[2] == left[0] and -1 < max(left[1], d[1]) <= 20:
                want.add((left[0], d[2], left[1], d[1], d[0]))
        assert got == want


@pytest.mark.parametrize("rows", [[], [("p", 0, 5), ("p", 1, 5), ("p", 2, None)]])
def test_batches_take_the_batch_form(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest.stream_sync_nearest(df, df, ["participant"], 3)
    assert got.count() == min(len(rows), 1)


def test_all_pairs_meet_in_buckets_of_time(spark):
    """A frame is compared with those near it in time, not with its key's whole stream."""
    rows = [(k, i, int(t)) for k in "pq" for i, t in enumerate(np.random.default_rng(ord(k)).integers(-90_000, 90_000, 80))] + [("p", 900, None)]
    side = lambda keep: spark.createDataFrame([r for r in rows if r[1] % 2 == keep or r[2] is None], SCHEMA).selectExpr("participant", "frame_idx", "timestamp_millis(t_ms) AS ts")
    got = streaming.stream_sync(side(0), side(1), ["participant"], "7 seconds")
    near = sorted((a[0], a[1], b[1]) for a in rows for b in rows if None not in (a[2], b[2]) and a[0] == b[0] and a[1] % 2 == 0 and b[1] % 2 and abs(a[2] - b[2]) <= 7000)
    assert sorted(tuple(r)[:3] for r in got.collect()) == near and near
    assert "(_l_bucket" in got._jdf.queryExecution().optimizedPlan().toString()
    for t in ("0 seconds", "1 day", "2 months"):
        width = streaming._width(spark, t)
        assert width >= {"0 seconds": 1, "1 day": 90_000_000_000, "2 months": 62 * 86_400_000_000}[t]


def test_a_stream_meets_in_buckets_of_time_too(spark, tmp_path):
    spark.createDataFrame([("p", 1, 5)], SCHEMA).selectExpr("participant", "frame_idx", "timestamp_millis(t_ms) AS ts").write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema("participant string, frame_idx long, ts timestamp").parquet(f"{tmp_path}/in")
    got = streaming.stream_sync(live, live, ["participant"], "7 seconds", "1 minute")
    assert got.isStreaming and "(_l_bucket" in got._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("most, at_once", [(4096, 200_000), (3, 40)])
def test_packs_of_a_stream_give_the_pairs_of_the_batch(spark, tmp_path, monkeypatch, most, at_once):
    """The state's entries are a batch's buckets, not frames, and go once the watermark is past them."""
    monkeypatch.setattr(streaming, "PACKED", most)
    monkeypatch.setattr(streaming, "PACKED_AT_ONCE", at_once)
    with_ts = lambda df: df.selectExpr("participant", "frame_idx", "timestamp_millis(t_ms) AS ts")
    left, right = made(33, 400, 3), made(41, 320, 4)
    left += [("p", 10_000 + i, 1_003_000 + i % 7) for i in range(100)]  # a crowded moment
    sides = [with_ts(feed(spark, f"{tmp_path}/{s}", rows, 6)) for s, rows in (("l", left), ("r", right))]
    pairs = streaming.stream_sync(*sides, ["participant"], "500 milliseconds", "100 milliseconds")
    job = pairs.writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).format("parquet").option("path", f"{tmp_path}/out").start()
    job.awaitTermination()
    got = sorted(map(tuple, spark.read.schema(pairs.schema).parquet(f"{tmp_path}/out").where("participant in ('p', 'q')").collect()))
    batch = [with_ts(spark.createDataFrame(rows, SCHEMA)) for rows in (left, right)]
    want = sorted(map(tuple, streaming.stream_sync(*batch, ["participant"], "500 milliseconds").collect()))
    assert got == want and len(got) > 10_000
    held = [p["stateOperators"][0]["numRowsTotal"] for p in job.recentProgress if p["stateOperators"]]
    if most == 4096:
        assert max(held) < 0.25 * (len(left) + 3 * len(right)) and held[-1] < 20


def test_frames_without_time_or_key_are_in_no_pair(spark, tmp_path):
    rows = [("p", 1, 5), ("p", 2, None), (None, 3, 5), ("q", None, 5)]
    spark.createDataFrame(rows, SCHEMA).selectExpr("participant", "frame_idx", "timestamp_millis(t_ms) AS ts").write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema("participant string, frame_idx long, ts timestamp").parquet(f"{tmp_path}/in")
    job = streaming.stream_sync(live, live, ["participant"], "1 day").writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
    job.format("parquet").option("path", f"{tmp_path}/out").start().awaitTermination()
    got = spark.read.schema("participant string, l_idx long, r_idx long").parquet(f"{tmp_path}/out").collect()
    assert sorted(map(tuple, got)) == [("p", 1, 1), ("q", None, None)]


def test_state_parts_follow_the_feed_not_the_session(spark, tmp_path):
    name = "spark.sql.shuffle.partitions"
    held = spark.conf.get(name)
    spark.createDataFrame([("p", 1, 5)], SCHEMA).selectExpr("participant", "frame_idx", "timestamp_millis(t_ms) AS ts").write.parquet(f"{tmp_path}/in")
    live = spark.readStream.schema("participant string, frame_idx long, ts timestamp").parquet(f"{tmp_path}/in")
    with streaming.state_parts(spark, 7 * streaming.STATE_ROWS):
        assert spark.conf.get(name) == "7"
        job = streaming.live_rate(live).writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).format("noop").start()
        job.awaitTermination()
    assert spark.conf.get(name) == held
    assert job.recentProgress[0]["stateOperators"][0]["numStateStoreInstances"] == 7
