from pyspark.sql import functions as F

from viewloom.functions import arrays, frames, names


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, v if hasattr(v, "_jc") else F.lit(v))
    return df.select(column.alias("out")).first()["out"]


def test_segment_name(spark):
    p = one(spark, names.parse_segment_name("n"), n="RPS/p03-CAM_AV-TOWER_HO-RPS-16.711147873569484_19.998175458310627.mp4")
    assert (p["participant"], p["view"], p["task"], p["subtask"], p["start_s"], p["ext"]) == ("p03", "CAM_AV", "TOWER_HO", "RPS", 16.711147873569484, "mp4")
    assert one(spark, names.parse_segment_name("n"), n="p03-CAM_AV.mp4") is None
    assert one(spark, names.parse_segment_name("n"), n=F.lit(None).cast("string")) is None


def test_segment_times(spark):
    t = one(spark, names.segment_times("n"), n="a/SUB-16.5_19.25.h5")
    assert (t["subtask"], t["duration"]) == ("SUB", 2.75)
    assert one(spark, names.segment_times("n"), n="SUB-16_19.h5") is None


def test_labels_and_paths(spark):
    assert one(spark, names.label_abbreviation("n"), n="Human Pickup and Stack  (HPS)") == "HPS"
    assert one(spark, names.label_abbreviation("n"), n="no parentheses") is None
    assert one(spark, names.canonical_path("n"), n="/data/p100/x/CAM_LL/y.mp4") == "p100/CAM_LL/y.mp4"


def test_select_files(spark):
    rows = [("p08", "CAM_LL", "GX1.MP4"), ("p100", "CAM_LL", "GX2.mp4"), ("p09", "CAM_LL", "Calib.mp4"), ("p09", "CAM_AV", "GX3.mp4"), (None, "CAM_LL", "GX4.mp4")]
    df = spark.createDataFrame(rows, "participant string, view string, file string")
    got = names.select_files(df, ["CAM_LL"], None, (".mp4",), (8, 100)).collect()
    assert sorted(r["file"] for r in got) == ["GX1.MP4", "GX2.mp4"]


def test_duration_of_zero_fps(spark):
    df = spark.createDataFrame([(0.0, 10), (30.0, 45)], "fps double, frame_count long")
    assert [r["duration_s"] for r in frames.with_duration(df).orderBy("fps").collect()] == [0.0, 1.5]


def test_pixels_truncate(spark):
    pts = F.array(F.array(F.lit(0.999), F.lit(-0.0019)))
    assert one(spark, frames.to_pixel(F.col("p"), 1000, 1000), p=pts) == [[999, -1]]


def test_look_direction(spark):
    say = lambda x, y: one(spark, frames.look_direction(F.col("x"), F.col("y")), x=float(x), y=float(y))
    assert say(-1.5, -2) == "Looking Down-Left"
    assert say(-1.5, 3) == "Looking Right"  # the down-right thresholds are wider
    assert say(-2.5, 3) == "Looking Down-Right"
    assert say(1, 1) == "Forward"


def test_projection_guard(spark):
    mtx = F.array(*map(F.lit, [1.0, 0, 0, 0, 1.0, 0, 0, 0, 0.0]))
    assert one(spark, frames.project_homogeneous(F.col("p"), F.col("k")), p=F.array(F.array(F.lit(1.0), F.lit(2.0))), k=mtx) == [[None, None]]


def test_fix_width(spark):
    for n, cut in ((0, False), (36, False), (37, True)):
        boxes = F.array_repeat(F.array(*[F.lit(1.0)] * 4), n)
        fixed, over = arrays.fix_width(F.col("b"), 36)
        got = one(spark, F.struct(fixed.alias("f"), over.alias("o")), b=boxes)
        assert len(got["f"]) == 36 and got["o"] is cut
        assert sum(p[0] for p in got["f"]) == min(n, 36)


def test_presence(spark):
    df = spark.createDataFrame([(1, [[0.0, 0.0]]), (2, None), (3, [[0.0, 1.0]])], "i int, face array<array<double>>")
    got = arrays.with_presence(df, {"face": 2}).orderBy("i").collect()
    assert [r["face_presence"] for r in got] == [0, 0, 1]
    assert got[1]["face"] == [[0.0, 0.0], [0.0, 0.0]]


def test_assign_hands(spark):
    rows = [(1, 0, "Left", 1.0), (1, 1, "Left", 2.0), (1, 2, "Right", 3.0), (2, 0, "Unknown", 4.0)]
    got = arrays.assign_hands(spark.createDataFrame(rows, "f int, det_idx int, side string, points double"), ["f"]).orderBy("f").collect()
    assert [(r["left_hand"], r["right_hand"]) for r in got] == [(2.0, 3.0), (None, 4.0)]


def test_long_and_wide_are_inverse(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]], None), (2, None, [[5.0, 6.0]])], "f int, face array<array<double>>, pose array<array<double>>")
    back = arrays.landmarks_wide(arrays.landmarks_long(df, ["f"], ["face", "pose"]), ["f"], ["face", "pose"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_record_round_trip(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0]])], "f int, face array<array<double>>")
    text = arrays.frame_record(df, ["f", "face"])
    assert text.select(arrays.read_record(F.col("record"), df.schema).alias("r")).select("r.*").collect() == df.collect()
