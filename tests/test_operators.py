import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from viewloom import fixtures, plans, queries
from viewloom.functions import frames
from viewloom.operators import annotations, catalog, planning, stereo, sync


def frame_rows(spark, spec):
    rows = [(p, v, i, int(i * step)) for p, v, n, step in spec for i in range(n)]
    return spark.createDataFrame(rows, "participant string, view string, frame_idx long, t_ms long")


def test_consistency_counts_a_repeated_view_once(spark):
    n = "p01-{}-TOWER_HO-RPS-1.0_2.0.mp4"
    rows = [(n.format("CAM_LL"), 100), (n.format("CAM_LL"), 102), (n.format("CAM_LR"), 102), ("bad.mp4", 1), ("p02-CAM_LL-TOWER_HO-RPS-1.0_2.0.mp4", 5)]
    same, unequal, single = annotations.frame_count_consistency(spark.createDataFrame(rows, "path string, frame_count long"))
    assert (same.count(), unequal.count(), single.count()) == (1, 0, 1)
    assert same.first()["by_view"] == {"CAM_LL": 102, "CAM_LR": 102}


def test_assign_segments_matches_plain_range_join(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([("p", i, float(t)) for i, t in enumerate(rng.integers(0, 400, 200) / 4)], "k string, i long, media_t double")
    clips = [("p", j, float(s), float(s + d)) for j, (s, d) in enumerate(zip(rng.integers(0, 400, 40) / 4, rng.integers(0, 200, 40) / 4, strict=True))] + [("p", 99, 5.0, 5.0)]
    clips = spark.createDataFrame(clips, "k string, j long, start_s double, end_s double")
    got = annotations.assign_segments(rows, clips, ["k"]).select("i", "j").collect()
    plain = rows.join(clips, "k").where("media_t >= start_s and media_t < end_s").select("i", "j").collect()
    assert sorted(got) == sorted(plain) and len(got) == len(set(got))


def test_all_clips_get_their_frames(spark, sf_dir):
    own = lambda df: sorted((r["event_id"], r["participant"], r["subtask"], r["start_s"], r["end_s"]) for r in df.collect())
    clips = {tuple(r) for r in fixtures.segments(spark, sf_dir).select("participant", "subtask", "start_s", "end_s").collect()}
    of = {}
    for c in clips:
        of.setdefault(c[0], []).append(c)
    seen = fixtures.frames(spark, sf_dir).select("event_id", "participant", "media_t").collect()
    want = sorted((r["event_id"], *c) for r in seen for c in of.get(r["participant"], []) if c[2] <= r["media_t"] < c[3])
    got = own(queries.queries()["j3_assign_segments"](spark, sf_dir))
    assert got == want and len({g[2] for g in got}) > 3


def test_all_videos_of_a_camera_are_checked(spark, sf_dir):
    whole = queries.queries()["a5_camera_integrity"](spark, sf_dir)
    assert sum(r["videos"] for r in whole.collect()) == fixtures.videos(spark, sf_dir).count()


def test_cameras_of_one_value(spark):
    rows = [(p, v, f"{k}.mp4", fps, d) for p, v, fps, d in (("p1", "CAM_LL", 50.0, 10.0), ("p1", "CAM_LR", 50.0, 10.0), ("p2", "CAM_LL", 50.0, 10.0), ("p2", "CAM_LR", 25.0, 10.0)) for k in range(3)]
    df = spark.createDataFrame([*rows, ("p3", "CAM_LL", "0.mp4", 50.0, 10.0), ("p3", "CAM_LL", "1.mp4", 50.0, 11.0), ("p3", "CAM_LR", "0.mp4", 50.0, 10.0)], "participant string, view string, video string, fps double, duration_s double")
    status = {(r["participant"], r["view"]): (r["videos"], r["status"]) for r in catalog.camera_integrity(df).collect()}
    assert status["p1", "CAM_LL"] == (3, "single") and status["p3", "CAM_LL"] == (2, "review")
    assert {r["participant"]: r["outcome"] for r in catalog.compare_cameras(df).select("participant", "outcome").collect()} == {"p1": "none", "p2": "fps", "p3": "review"}


def test_sync_is_one_to_one_and_near(spark):
    left, right = frame_rows(spark, [("p", "L", 50, 33)]), frame_rows(spark, [("p", "R", 40, 41)])
    got = sync.sync_frames(left, right, ["participant"], 20).collect()
    assert got and all(r["dt"] <= 20 for r in got)
    assert len({r["l_idx"] for r in got}) == len({r["r_idx"] for r in got}) == len(got)


def test_greedy_sync_uses_a_frame_once(spark):
    left, right = frame_rows(spark, [("p", "L", 50, 33)]), frame_rows(spark, [("p", "R", 40, 41)])
    got = sync.sync_frames_greedy(left, right, ["participant"], 20).collect()
    assert got and all(r["dt"] <= 20 for r in got)
    assert len({r["l_idx"] for r in got}) == len({r["r_idx"] for r in got}) == len(got)


def test_greedy_sync_is_the_sequential_rule(spark):
    rng = np.random.default_rng(3)
    make = lambda n: [(k, i, int(t)) for k in "pq" for i, t in enumerate(np.sort(rng.integers(0, 900, n)))]
    left, right = make(60), make(45)

    def plain(k, tolerance):
        a, b = ([(i, t) for p, i, t in rows if p == k] for rows in (left, right))
        i = j = 0
        while i < len(a) and j < len(b):
            d = a[i][1] - b[j][1]
            if abs(d) <= tolerance:
                yield k, a[i][0], b[j][0]
                i, j = i + 1, j + 1
            elif d < 0:
                i += 1
            else:
                j += 1

    df = lambda rows: spark.createDataFrame(rows, "participant string, frame_idx long, t_ms long").repartition(3)
    got = sync.sync_frames_greedy(df(left), df(right), ["participant"], 9).select("participant", "l_idx", "r_idx").collect()
    assert sorted(map(tuple, got)) == sorted([*plain("p", 9), *plain("q", 9)])


def test_renumbering_needs_no_order_without_gaps(spark):
    f = frame_rows(spark, [("p", "A", 200, 20), ("p", "B", 120, 33)])
    rates = spark.createDataFrame([("p", "A", 50.0), ("p", "B", 30.0)], "participant string, view string, fps double")
    stream = ["participant", "view"]
    gaps = f.where("view = 'B' or frame_idx % 7 <> 3")
    for rows in (f, gaps):
        got = sync.harmonize_fps(rows, rates, ["participant"], stream)
        order = Window.partitionBy(*stream).orderBy("frame_idx")
        assert got.withColumn("want", F.row_number().over(order) - 1).where("new_idx <> want").count() == 0
        third = frames.sample_every_n(rows, 3, stream)
        assert third.withColumn("want", F.row_number().over(order) - 1).where("sample_idx <> want").count() == 0
    assert "Window" not in sync.harmonize_fps(f, rates, ["participant"], stream)._jdf.queryExecution().toString()


def test_synchronised_workload_pairs_by_name_and_rate(spark):
    rows = [("p", v, name, i, int(i * step)) for v, step in (("CAM_LL", 20), ("CAM_LR", 33)) for name, n in (("a.mp4", 100), ("b.mp4", 50)) for i in range(n) if (v, name) != ("CAM_LR", "b.mp4")]
    f = spark.createDataFrame(rows, "participant string, view string, video string, frame_idx long, t_ms long")
    videos = spark.createDataFrame([("p", "CAM_LL", "a.mp4", 50.0, 100), ("p", "CAM_LL", "b.mp4", 50.0, 50), ("p", "CAM_LR", "a.mp4", 30.0, 100)], "participant string, view string, video string, fps double, frame_count long")
    got = plans.synchronised(f, videos=videos, keys=("participant", "video")).collect()
    assert {r["video"] for r in got} == {"a.mp4"} and max(r["dt"] for r in got) <= 34 and len(got) > 40
    assert plans.frame_ms(videos) == 34


def test_fifty_to_thirty_keeps_thirty(spark):
    f = frame_rows(spark, [("p", "A", 50, 20), ("p", "B", 30, 33)])
    rates = spark.createDataFrame([("p", "A", 50.0), ("p", "B", 30.0)], "participant string, view string, fps double")
    got = sync.harmonize_fps(f, rates, ["participant"], ["participant", "view"])
    assert {r["view"]: r["n"] for r in got.groupBy("view").agg(F.count("*").alias("n")).collect()} == {"A": 30, "B": 30}
    assert sorted(r["new_idx"] for r in got.where("view = 'A'").collect()) == list(range(30))


def test_lengths_are_equal_after_matching(spark):
    f = frame_rows(spark, [("p", "A", 9, 1), ("p", "B", 5, 1), ("q", "A", 3, 1)])
    for got in (sync.match_length(f, ["participant"], ["participant", "view"])[0], sync.drop_leading(f, ["participant"], ["participant", "view"])):
        n = {(r["participant"], r["view"]): (r["n"], r["lo"]) for r in got.groupBy("participant", "view").agg(F.count("*").alias("n"), F.min("frame_idx").alias("lo")).collect()}
        assert n == {("p", "A"): (5, 0), ("p", "B"): (5, 0), ("q", "A"): (3, 0)}


def test_triangulation_recovers_points(spark):
    rng = np.random.default_rng(0)
    k = np.array([[900.0, 0, 480], [0, 900, 270], [0, 0, 1]])
    r = np.array([[0.8, 0, 0.6], [0, 1, 0], [-0.6, 0, 0.8]])
    t = np.array([-0.1, 0, 0])
    x = rng.uniform(-1, 1, (5, 3)) + [0, 0, 5]
    see = lambda p: (p @ k.T)[:, :2] / (p @ k.T)[:, 2:]
    left, right = see(x).tolist(), see(x @ r.T + t).tolist()
    cal = spark.createDataFrame([("p", "LL_LR", k.ravel().tolist(), k.ravel().tolist(), r.ravel().tolist(), t.tolist())], "participant string, pair string, left_mtx array<double>, right_mtx array<double>, R array<double>, T array<double>")
    lm = spark.createDataFrame([("p", "CAM_LL", 0, left), ("p", "CAM_LR", 0, right), ("p", "CAM_LL", 1, left), ("q", "CAM_LL", 0, left), ("q", "CAM_LR", 0, right), ("p", "CAM_LR", 1, None)], "participant string, view string, frame_idx long, face array<array<double>>")
    joined = stereo.join_stereo_frames(lm, stereo.projection_matrices(cal), parts=["face"])
    got = stereo.triangulate(joined, ["participant", "frame_idx"], ["face"]).collect()
    assert len(got) == 1
    assert np.allclose([[p["x"], p["y"], p["z"]] for p in got[0]["face"]], x, atol=1e-6)


def test_stereo_keeps_pairs_and_segments_apart(spark):
    eye, zero = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0], [-1.0, 0.0, 0.0]
    cal = spark.createDataFrame([("p", "LL_LR", eye, eye, eye, zero), ("p", "UL_UR", eye, eye, eye, [-5.0, 0.0, 0.0])], "participant string, pair string, left_mtx array<double>, right_mtx array<double>, R array<double>, T array<double>")
    see = lambda z, base: ([[0.5, 0.25]], [[0.5 - base / z, 0.25]])
    rows = []
    for views, base in ((("CAM_LL", "CAM_LR"), 1.0), (("CAM_UL", "CAM_UR"), 5.0)):
        for k, z in ((0, 4.0), (1, 8.0)):
            rows += [("p", v, "TOWER_HO", f"S{k}", float(k), k + 1.0, 0, pts) for v, pts in zip(views, see(z, base), strict=True)]
    lm = spark.createDataFrame(rows, "participant string, view string, task string, subtask string, start_s double, end_s double, frame_idx long, face array<array<double>>")
    for pair in (("CAM_LL", "CAM_LR"), ("CAM_UL", "CAM_UR")):
        got = {r["subtask"]: r["face"][0]["z"] for r in plans.reconstructed(lm, cal, ["face"], *pair).collect()}
        assert got.keys() == {"S0", "S1"} and np.allclose([got["S0"], got["S1"]], [4, 8])


def test_zero_disparity_is_guarded(spark):
    d = spark.range(1).select(stereo.depth(F.array(F.lit(0.0), F.lit(2.0)), F.lit(10.0), F.lit(1.0)).alias("z")).first()["z"]
    assert d == [10.0 / 1e-5, 5.0]


def test_gaze_without_rotation_and_on_centre(spark):
    lit = lambda *v: [F.lit(float(x)) for x in v]
    df = spark.range(1)
    g = df.select(stereo.gaze_vector(lit(-1, 0, 1), lit(1, 0, 1), lit(0, 0, 0), lit(0, 0, 0)).alias("g")).first()["g"]
    assert np.allclose(list(g), [0, 0, 1])
    assert df.select(stereo.gaze_vector(lit(-1, 0, 0), lit(1, 0, 0), lit(0, 0, 0), lit(0, 0, 0)).alias("g")).first()["g"]["x"] is None


def test_append_twice_adds_nothing(spark):
    from viewloom.sources import append_new_rows

    old = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("a", None), ("c", 2), ("c", 2)], "k string, v int")
    added = append_new_rows(old, new)
    assert [tuple(r) for r in added.collect()] == [("c", 2)]
    assert append_new_rows(old.unionByName(added), new).count() == 0


def test_batches_and_plan(spark):
    ids = spark.createDataFrame([(f"p{i:02d}",) for i in range(1, 13)], "participant string")
    assert [r["name"] for r in catalog.batch_groups(ids, 5).orderBy("group").collect()] == ["p01_to_p05", "p06_to_p10", "p11_to_p12"]
    files = spark.createDataFrame([("HPS",)] * 4820 + [("RPCS",)] * 35, "subtask string")
    assert {r["subtask"]: (r["per_view"], r["batches"]) for r in catalog.batch_plan(files).collect()} == {"HPS": (964, 10), "RPCS": (7, 1)}


def test_corrupt_floor_is_exclusive(spark):
    df = spark.createDataFrame([("CAM_LL", 100_000), ("CAM_LL", 99_999)], "view string, bytes long")
    bad, counts = catalog.corrupt_segments(df)
    assert bad.count() == 1 and {r["view"]: r["corrupt"] for r in counts.collect()}["CAM_AV"] == 0


def test_random_plans_are_stable_and_keep_existing(spark):
    who = spark.createDataFrame([("p01",), ("p02",)], "participant string")
    have = spark.createDataFrame([("p01",)], "participant string")
    got = planning.randomize_tasks(who, have, 3).orderBy("position").collect()
    assert {r["participant"] for r in got} == {"p02"} and got[0]["task"] == "CALIBRATION" and len({r["task"] for r in got}) == 5
    assert got == planning.randomize_tasks(who, have, 3).orderBy("position").collect()


def test_empty_inputs(spark):
    f = frame_rows(spark, []) if False else spark.createDataFrame([], "participant string, view string, frame_idx long, t_ms long")
    assert sync.sync_frames(f, f, ["participant"], 10).count() == 0
    assert sync.match_length(f, ["participant"], ["participant", "view"])[0].count() == 0
    assert catalog.video_count_status(spark.createDataFrame([], "participant string, view string")).count() == 0


def test_correspondences_are_dealt_to_tasks_by_their_corners(spark, monkeypatch):
    rows = [("p01", "LL_LR", s, f, [0, 1], [[0.0, float(f)], [1.0, 0.0]]) for f in range(40) for s in ("left", "right")]
    df = spark.createDataFrame(rows, "participant string, pair string, side string, frame_idx long, ids array<int>, corners array<array<double>>")
    monkeypatch.setattr(stereo, "CORNERS", 20)
    got = stereo.stereo_correspondences(df)
    assert got.rdd.getNumPartitions() == 12 and got.count() == 40
    assert stereo.stereo_correspondences(df.limit(0)).count() == 0
