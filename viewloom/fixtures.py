"""Recordings-shaped views over the star-schema, event, vector and conversation tables; each as a DataFrame and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.schemas import FAMILIES, PAIRS, PARTS, SUBTASKS, TASKS, VIEWS


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def participant(n: Column) -> Column:
    return F.format_string("p%02d", n.cast("long"))


def pick(names: list[str], at: Column) -> Column:
    """names[at] for a 0-based column."""
    return F.element_at(F.array(*map(F.lit, names)), (at + 1).cast("int"))


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in names) + "]"


def _div(a: Column | str, b: int) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    return F.floor(a / b).cast("long")


SPAN = {"face": (0, 16), "left_hand": (16, 20), "right_hand": (20, 24), "pose": (24, 32)}


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, participant, view, ts, t_ms, frame_idx, media_t, x, k) from events."""
    from pyspark.sql import Window

    e = read(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp_ntz")
    ms = (
        F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000
        + F.hour(ts) * 3_600_000
        + F.minute(ts) * 60_000
        + F.floor(F.extract(F.lit("SECOND"), ts) * 1000)
    ).cast("long")
    view = F.create_map(*[F.lit(x) for kv in zip(("view", "click", "purchase", "signup", "error"), VIEWS, strict=True) for x in kv])[F.col("event_type")]
    out = e.select(
        "event_id",
        participant(F.col("user_id") % 70 + 1).alias("participant"),
        view.alias("view"),
        ts.alias("ts"),
        ms.alias("t_ms"),
        ((F.col("event_id") % 440) / 4.0).alias("media_t"),
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "user_id",
    )
    order = Window.partitionBy("participant", "view").orderBy("ts", "event_id")
    return out.withColumn("frame_idx", (F.row_number().over(order) - 1).cast("long"))


def video_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, participant, view, video, frame_idx, t_ms) from events: frames of CAM_LL at 50 and of CAM_LR at 30 fps, a little off their times."""
    from pyspark.sql import Window

    f = frames(spark, sf_dir).where("view in ('CAM_LL', 'CAM_LR')").select("event_id", "participant", "view", F.concat(pick(TASKS, F.col("event_id") % 3), F.lit(".mp4")).alias("video"))
    order = Window.partitionBy("participant", "view", "video").orderBy("event_id")
    f = f.withColumn("frame_idx", (F.row_number().over(order) - 1).cast("long"))
    step = F.when(F.col("view") == "CAM_LL", 20.0).otherwise(33.0)
    return f.withColumn("t_ms", (F.col("frame_idx") * step).cast("long") + F.col("event_id") % 5)


def video_list(frames_: DataFrame) -> DataFrame:
    """(participant, view, video, fps, frame_count) of ``video_frames``."""
    n = frames_.groupBy("participant", "view", "video").agg(F.count("*").alias("frame_count"))
    return n.withColumn("fps", F.when(F.col("view") == "CAM_LL", 50.0).otherwise(30.0))


def rate(view: Column, number: Column) -> Column:
    """Rates of 30, 50 and 60 fps, by the participant's number, so that all pairs of them occur."""
    return F.when(view == "CAM_LL", pick_double([50.0, 60.0, 30.0], number % 3)).otherwise(pick_double([30.0, 50.0, 60.0], _div(number, 3) % 3))


def pick_double(values: list[float], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))


def rated_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, participant, view, video, frame_idx, t_ms, fps): as ``video_frames``, with rates that differ from participant to participant."""
    f = video_frames(spark, sf_dir).drop("t_ms")
    f = f.withColumn("fps", rate(F.col("view"), F.substring("participant", 2, 9).cast("long")))
    return f.withColumn("t_ms", F.floor(F.col("frame_idx") * 1000.0 / F.col("fps")).cast("long") + F.col("event_id") % 40)


def rated_list(frames_: DataFrame) -> DataFrame:
    """(participant, view, video, fps, frame_count) of ``rated_frames``."""
    return frames_.groupBy("participant", "view", "video", "fps").agg(F.count("*").alias("frame_count"))


def clip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, bytes, frame_count) of the clips of ``annotations`` that have been cut, three of four."""
    from viewloom.operators.annotations import segments_per_view

    clips = segments_per_view(annotations(spark, sf_dir)).dropDuplicates(["name"])
    turn = F.floor(F.col("start_s") / 2).cast("long") + F.array_position(F.array(*map(F.lit, VIEWS)), F.col("view"))
    return clips.where(turn % 4 != 0).select("path", (99_000 + F.floor("start_s").cast("long") * 500).alias("bytes"), (100 + turn % 3).alias("frame_count"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per clip and view from lineitem, with the clip's file name."""
    li = read(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    start = (key % 400) / 4.0
    out = li.select(
        participant(key % 70 + 1).alias("participant"),
        pick(VIEWS, F.col("l_linenumber") % 5).alias("view"),
        pick(TASKS, key % 9).alias("task"),
        pick(SUBTASKS, key % 34).alias("subtask"),
        start.alias("start_s"),
        (start + (key % 40 + 1) / 4.0).alias("end_s"),
        (100 + F.col("l_quantity").cast("long") % 3).alias("frame_count"),
        (F.col("l_extendedprice") * 3).cast("long").alias("bytes"),
    )
    from viewloom.functions.names import segment_name

    return out.withColumn("path", segment_name("participant", "view", "task", "subtask", "start_s", "end_s"))


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(participant, view, video, fps, frame_count) from orders."""
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.where("o_custkey % 10 <> 0").select(
        participant(_div(key, 45) + 1).alias("participant"),
        pick(VIEWS, key % 5).alias("view"),
        F.concat(pick(TASKS, _div(key, 5) % 9), F.lit(".mp4")).alias("video"),
        F.when(F.substring("o_orderpriority", 1, 1).isin("4", "5"), 60.0).otherwise(30.0).alias("fps"),
        (300 + F.col("o_totalprice").cast("long") % 600).alias("frame_count"),
    )


LABELS = ["Human Pickup and Stack (HPS)", "Robot Pickup and Stack (RPS)", "Structural Integration"]


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, file, video_url, tricks) from conversations, a trick for each turn."""
    c = read(spark, sf_dir, "conversations")
    label = F.when(F.col("role") == "user", LABELS[0]).when(F.col("role") == "assistant", LABELS[1]).otherwise(LABELS[2])
    trick = F.struct((2.0 * F.col("turn")).alias("start"), (2.0 * F.col("turn") + 1.5).alias("end"), F.array(label).alias("labels"))
    file = pick(TASKS, F.col("conv_id") % 9)
    who = participant(F.col("conv_id") % 70 + 1)
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list(trick)).alias("tricks")).select(
        F.col("conv_id").alias("item"), F.concat(file, F.lit(".json")).alias("file"), F.concat(F.lit("/x-"), who, F.lit("_CAM_AV_P_"), file, F.lit(".mp4")).alias("video_url"), "tricks"
    )


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per frame and view from embeddings: four arrays of [x, y], and whether there was a detection."""
    e = read(spark, sf_dir, "embeddings")
    frame = _div("vec_id", 2)
    value = lambda i: (F.element_at("embedding", i + 1).cast("double") + 1.0) / 2.0
    part = {
        p: F.when(F.col("label") != 0, F.transform(F.sequence(F.lit(a), F.lit(b - 1)), lambda i: F.array(value(2 * i), value(2 * i + 1)))).alias(p)
        for p, (a, b) in SPAN.items()
    }
    return e.select(
        participant(frame % 10 + 1).alias("participant"), F.when(F.col("vec_id") % 2 == 0, "CAM_LL").otherwise("CAM_LR").alias("view"), frame.alias("frame_idx"), *part.values()
    )


#: Camera pairs of the stereo fixtures.
STEREO_PAIRS = [("CAM_LL", "CAM_LR"), ("CAM_UL", "CAM_UR")]


def stereo_landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``landmarks``, of two camera pairs and two segments a participant, whose frames are numbered from 0 each."""
    e = read(spark, sf_dir, "embeddings")
    group = _div("vec_id", 4)
    segment = _div(group, 10) % 2
    value = lambda i: (F.element_at("embedding", i + 1).cast("double") + 1.0) / 2.0
    part = {
        p: F.when(F.col("label") != 0, F.transform(F.sequence(F.lit(a), F.lit(b - 1)), lambda i: F.array(value(2 * i), value(2 * i + 1)))).alias(p)
        for p, (a, b) in SPAN.items()
    }
    return e.select(
        participant(group % 10 + 1).alias("participant"), pick([v for p in STEREO_PAIRS for v in p], F.col("vec_id") % 4).alias("view"), pick(TASKS, segment).alias("task"),
        pick(SUBTASKS, segment + 8).alias("subtask"), (segment * 2.5).alias("start_s"), (segment * 2.5 + 2.0).alias("end_s"), _div(group, 20).alias("frame_idx"), *part.values(),
    )


def known_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landmarks of both cameras of both pairs that are the images of known points, as ``fx_known`` has them: for each calibration, two segments of three frames of four points."""
    from viewloom.operators.stereo import projection_matrices

    c = projection_matrices(calibration(spark, sf_dir)).select("participant", "pair", "number", "P1", "P2", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("at"))
    x = lambda j: ((F.col("number") + F.col("at") + j) % 9 - 4) / 8.0
    y = lambda j: ((F.col("number") + 2 * F.col("at") + 3 * j) % 7 - 3) / 8.0
    z = lambda j: 4.0 + ((F.col("at") + j) % 5) / 4.0

    def image(p: str, j: int) -> Column:
        row = lambda r: sum((F.col(p)[4 * r + k] * v for k, v in enumerate((x(j), y(j), z(j)))), F.col(p)[4 * r + 3])
        return F.array(row(0) / row(2), row(1) / row(2))

    sides = F.inline(F.array(*(F.struct(F.lit(s).alias("side"), F.array(*(image(p, j) for j in range(4))).alias("face")) for s, p in ((0, "P1"), (1, "P2")))))
    rows = c.select("participant", "pair", "at", sides)
    views = F.create_map(*[F.lit(v) for pair in STEREO_PAIRS for s in (0, 1) for v in (f"{pair[0][4:]}_{pair[1][4:]}{s}", pair[s])])
    segment = _div("at", 3)
    return rows.select(
        "participant", views[F.concat("pair", F.col("side").cast("string"))].alias("view"), pick(TASKS, segment).alias("task"), pick(SUBTASKS, segment + 8).alias("subtask"), (segment * 2.5).alias("start_s"),
        (segment * 2.5 + 2.0).alias("end_s"), (F.col("at") % 3).cast("long").alias("frame_idx"), "face",
    )


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stereo calibrations of two camera pairs from supplier; every seventh participant has none."""
    s = read(spark, sf_dir, "supplier").where("s_suppkey > 0 and s_suppkey % 7 <> 0").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    i = ((F.col("s_suppkey") + 7 * F.col("k")) % 50).cast("double")
    t = i / 100.0
    c, n = (1.0 - t * t) / (1.0 + t * t), 2.0 * t / (1.0 + t * t)
    zero, one = F.lit(0.0), F.lit(1.0)
    f = 900.0 + 10.0 * i
    mtx = F.array(f, zero, F.lit(480.0), zero, f, F.lit(270.0), zero, zero, one)
    key = F.col("s_suppkey")
    dist = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    return s.select(
        participant(key).alias("participant"),
        pick(["LL_LR", "UL_UR"], F.col("k")).alias("pair"),
        key.alias("number"),
        (i / 8.0).alias("retval"),
        mtx.alias("left_mtx"),
        mtx.alias("right_mtx"),
        dist(4 + key % 2).alias("left_dist"),
        dist(4 + _div(key, 2) % 2).alias("right_dist"),
        F.array(c, zero, n, zero, one, zero, -n, zero, c).alias("R"),
        F.array(-0.1 - 0.01 * i, zero, zero).alias("T"),
        (10 + key % 3).alias("left_count"),
        (10 + _div(key, 3) % 3).alias("right_count"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board corners seen by either side of a camera pair, from orders."""
    o = read(spark, sf_dir, "orders")
    key, n = F.col("o_orderkey"), F.col("o_custkey") % 10 + 10
    ids = F.sequence(F.lit(0), (n - 1).cast("int"))
    pair = pick(["_".join(x[4:] for x in p) for p in PAIRS], _div(key, 2) % 8)
    shift = (F.col("o_custkey") % 7).cast("double")
    return o.select(
        participant(_div(key, 1600) % 70 + 1).alias("participant"),
        pair.alias("pair"),
        F.when(key % 2 == 0, "left").otherwise("right").alias("side"),
        _div(key, 16).alias("frame_idx"),
        ids.alias("ids"),
        F.transform(ids, lambda i: F.array(10.0 * i + shift, 5.0 * i)).alias("corners"),
    )


def plan_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(participant, Task_1 .. Task_5) from customer: calibration first, then the families from a turning start."""
    c = read(spark, sf_dir, "customer")
    return c.select(
        participant(F.col("c_custkey") + 1).alias("participant"),
        F.lit("CALIBRATION").alias("Task_1"),
        *(pick(FAMILIES, (F.col("c_custkey") + j) % 4).alias(f"Task_{j + 2}") for j in range(4)),
    )


def camera_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(participant, view, file, bytes) from orders: unnamed camera files."""
    o = read(spark, sf_dir, "orders")
    stem = F.when(F.col("o_custkey") % 13 == 0, "calib_").otherwise("GX")
    return o.select(
        participant(F.col("o_custkey") % 1500 + 1).alias("participant"),
        pick(VIEWS, F.col("o_custkey") % 3).alias("view"),
        F.concat(stem, F.format_string("%08d", "o_orderkey"), F.lit(".MP4")).alias("file"),
        F.col("o_totalprice").cast("long").alias("bytes"),
    )


def angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frame_id, ts, x, y) head angles from events."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("frame_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        ((F.col("event_id") % 13 - 6) / 2.0).alias("x"),
        ((F.col("user_id") % 11 - 5) / 2.0).alias("y"),
    )


# The same views for DuckDB.
SQL = {
    "fx_frames": f"""SELECT event_id, printf('p%02d', user_id % 70 + 1) AS participant,
  {_list(VIEWS)}[CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END] AS view,
  ts, epoch_us(ts) // 1000 AS t_ms, (event_id % 440) / 4.0::DOUBLE AS media_t, value AS x, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id,
  row_number() OVER (PARTITION BY user_id % 70, event_type ORDER BY ts, event_id) - 1 AS frame_idx FROM events""",
    "fx_segments": f"""SELECT *, participant || '-' || view || '-' || task || '-' || subtask || '-' || CAST(start_s AS VARCHAR) || '_' || CAST(end_s AS VARCHAR) || '.mp4' AS path
  FROM (SELECT printf('p%02d', l_orderkey % 70 + 1) AS participant, {_list(VIEWS)}[l_linenumber % 5 + 1] AS view, {_list(TASKS)}[l_orderkey % 9 + 1] AS task,
  {_list(SUBTASKS)}[l_orderkey % 34 + 1] AS subtask, (l_orderkey % 400) / 4.0::DOUBLE AS start_s, (l_orderkey % 400) / 4.0::DOUBLE + (l_orderkey % 40 + 1) / 4.0::DOUBLE AS end_s,
  100 + CAST(trunc(l_quantity) AS BIGINT) % 3 AS frame_count, CAST(trunc(l_extendedprice * 3) AS BIGINT) AS bytes FROM lineitem)""",
    "fx_videos": f"""SELECT printf('p%02d', o_orderkey // 45 + 1) AS participant, {_list(VIEWS)}[o_orderkey % 5 + 1] AS view, {_list(TASKS)}[(o_orderkey // 5) % 9 + 1] || '.mp4' AS video,
  CASE WHEN left(o_orderpriority, 1) IN ('4', '5') THEN 60.0::DOUBLE ELSE 30.0::DOUBLE END AS fps, 300 + CAST(trunc(o_totalprice) AS BIGINT) % 600 AS frame_count
  FROM orders WHERE o_custkey % 10 <> 0""",
    "fx_tricks": f"""SELECT conv_id AS item, {_list(TASKS)}[conv_id % 9 + 1] || '.json' AS file, '/x-' || printf('p%02d', conv_id % 70 + 1) || '_CAM_AV_P_' || {_list(TASKS)}[conv_id % 9 + 1] || '.mp4' AS video_url,
  2.0::DOUBLE * turn AS start_s, 2.0::DOUBLE * turn + 1.5::DOUBLE AS end_s,
  CASE role WHEN 'user' THEN '{LABELS[0]}' WHEN 'assistant' THEN '{LABELS[1]}' ELSE '{LABELS[2]}' END AS label FROM conversations""",
    "fx_points": f"""SELECT printf('p%02d', (vec_id // 2) % 10 + 1) AS participant, CASE WHEN vec_id % 2 = 0 THEN 'CAM_LL' ELSE 'CAM_LR' END AS view, vec_id // 2 AS frame_idx,
  CASE WHEN i < 16 THEN 'face' WHEN i < 20 THEN 'left_hand' WHEN i < 24 THEN 'right_hand' ELSE 'pose' END AS part,
  CASE WHEN i < 16 THEN i WHEN i < 20 THEN i - 16 WHEN i < 24 THEN i - 20 ELSE i - 24 END AS point, label <> 0 AS present,
  (CAST(embedding[2 * i + 1] AS DOUBLE) + 1.0::DOUBLE) / 2.0::DOUBLE AS x, (CAST(embedding[2 * i + 2] AS DOUBLE) + 1.0::DOUBLE) / 2.0::DOUBLE AS y
  FROM embeddings, range(32) AS r(i)""",
    "fx_video_frames": f"""SELECT *, CAST(frame_idx * CASE view WHEN 'CAM_LL' THEN 20 ELSE 33 END AS BIGINT) + event_id % 5 AS t_ms, CASE view WHEN 'CAM_LL' THEN 50.0::DOUBLE ELSE 30.0::DOUBLE END AS fps FROM (SELECT *, row_number() OVER (PARTITION BY participant, view, video ORDER BY event_id) - 1 AS frame_idx
  FROM (SELECT event_id, participant, view, {_list(TASKS)}[event_id % 3 + 1] || '.mp4' AS video FROM fx_frames WHERE view IN ('CAM_LL', 'CAM_LR')))""",
    "fx_rated": """SELECT *, CAST(floor(frame_idx * 1000.0::DOUBLE / fps) AS BIGINT) + event_id % 40 AS t_ms FROM (SELECT event_id, participant, view, video, frame_idx,
  CASE WHEN view = 'CAM_LL' THEN [50.0::DOUBLE, 60.0::DOUBLE, 30.0::DOUBLE][CAST(substr(participant, 2) AS BIGINT) % 3 + 1]
  ELSE [30.0::DOUBLE, 50.0::DOUBLE, 60.0::DOUBLE][(CAST(substr(participant, 2) AS BIGINT) // 3) % 3 + 1] END AS fps FROM fx_video_frames)""",
    "fx_clips": rf"""SELECT *, participant || '-' || view || '-' || task || '-' || abbreviation || '-' || CAST(start_s AS VARCHAR) || '_' || CAST(end_s AS VARCHAR) || '.mp4' AS name FROM (SELECT DISTINCT regexp_extract(video_url, '(p\d+)_CAM', 1) AS participant,
  regexp_extract(video_url, 'CAM_AV_P_(\w+)\.mp4', 1) AS task, view, start_s, end_s, nullif(regexp_extract(label, '\((.*?)\)', 1), '') AS abbreviation, start_s // 2 + v AS turn FROM fx_tricks, (VALUES ('CAM_AV', 1), ('CAM_LL', 2), ('CAM_LR', 3), ('CAM_UL', 4), ('CAM_UR', 5)) x(view, v)) WHERE abbreviation IS NOT NULL""",
    "fx_stereo": f"""SELECT printf('p%02d', (vec_id // 4) % 10 + 1) AS participant, {_list([v for p in STEREO_PAIRS for v in p])}[vec_id % 4 + 1] AS view, {_list(TASKS)}[(vec_id // 40) % 2 + 1] AS task,
  {_list(SUBTASKS)}[(vec_id // 40) % 2 + 9] AS subtask, ((vec_id // 40) % 2) * 2.5::DOUBLE AS start_s, ((vec_id // 40) % 2) * 2.5::DOUBLE + 2.0::DOUBLE AS end_s, vec_id // 80 AS frame_idx,
  CASE WHEN i < 16 THEN 'face' WHEN i < 20 THEN 'left_hand' WHEN i < 24 THEN 'right_hand' ELSE 'pose' END AS part,
  CASE WHEN i < 16 THEN i WHEN i < 20 THEN i - 16 WHEN i < 24 THEN i - 20 ELSE i - 24 END AS point, label <> 0 AS present,
  (CAST(embedding[2 * i + 1] AS DOUBLE) + 1.0::DOUBLE) / 2.0::DOUBLE AS x, (CAST(embedding[2 * i + 2] AS DOUBLE) + 1.0::DOUBLE) / 2.0::DOUBLE AS y
  FROM embeddings, range(32) AS r(i)""",
    "fx_known": f"""SELECT participant, pair, {_list(TASKS)}[a // 3 + 1] AS task, {_list(SUBTASKS)}[a // 3 + 9] AS subtask, a // 3 * 2.5::DOUBLE AS start_s, a % 3 AS frame_idx, j AS point,
  ((number + a + j) % 9 - 4) / 8.0::DOUBLE AS x, ((number + 2 * a + 3 * j) % 7 - 3) / 8.0::DOUBLE AS y, 4.0::DOUBLE + ((a + j) % 5) / 4.0::DOUBLE AS z FROM fx_calibration, range(6) q(a), range(4) r(j)""",
    "fx_calibration": """SELECT printf('p%02d', s_suppkey) AS participant, CASE k WHEN 0 THEN 'LL_LR' ELSE 'UL_UR' END AS pair, s_suppkey AS number, i / 8.0::DOUBLE AS retval, 900.0::DOUBLE + 10.0::DOUBLE * i AS f, 480.0::DOUBLE AS cx, 270.0::DOUBLE AS cy,
  (1.0::DOUBLE - t * t) / (1.0::DOUBLE + t * t) AS c, 2.0::DOUBLE * t / (1.0::DOUBLE + t * t) AS s, -0.1::DOUBLE - 0.01::DOUBLE * i AS tx, 4 + s_suppkey % 2 AS left_dist, 4 + (s_suppkey // 2) % 2 AS right_dist,
  10 + s_suppkey % 3 AS left_count, 10 + (s_suppkey // 3) % 3 AS right_count
  FROM (SELECT s_suppkey, k, CAST((s_suppkey + 7 * k) % 50 AS DOUBLE) AS i, CAST((s_suppkey + 7 * k) % 50 AS DOUBLE) / 100.0::DOUBLE AS t FROM supplier, range(2) r(k) WHERE s_suppkey > 0 AND s_suppkey % 7 <> 0)""",
    "fx_observations": f"""SELECT printf('p%02d', (o_orderkey // 1600) % 70 + 1) AS participant, {_list(["_".join(x[4:] for x in p) for p in PAIRS])}[(o_orderkey // 2) % 8 + 1] AS pair,
  CASE WHEN o_orderkey % 2 = 0 THEN 'left' ELSE 'right' END AS side, o_orderkey // 16 AS frame_idx, o_custkey % 10 + 10 AS n, CAST(o_custkey % 7 AS DOUBLE) AS shift FROM orders""",
    "fx_plan": f"""SELECT printf('p%02d', c_custkey + 1) AS participant, j + 1 AS position, CASE WHEN j = 0 THEN 'CALIBRATION' ELSE {_list(FAMILIES)}[(c_custkey + j - 1) % 4 + 1] END AS task
  FROM customer, range(5) AS r(j)""",
    "fx_files": f"""SELECT printf('p%02d', o_custkey % 1500 + 1) AS participant, {_list(VIEWS)}[(o_custkey % 3) + 1] AS view,
  CASE WHEN o_custkey % 13 = 0 THEN 'calib_' ELSE 'GX' END || printf('%08d', o_orderkey) || '.MP4' AS file, CAST(trunc(o_totalprice) AS BIGINT) AS bytes FROM orders""",
    "fx_angles": """SELECT event_id AS frame_id, ts, (event_id % 13 - 6) / 2.0::DOUBLE AS x, (user_id % 11 - 5) / 2.0::DOUBLE AS y FROM events""",
}


def sql(body: str, *views: str) -> str:
    """``body`` with the named views before it."""
    head = ", ".join(f"{v} AS ({SQL[v]})" for v in views)
    if not head:
        return body
    return f"WITH {head}, {body.strip()[5:]}" if body.strip().upper().startswith("WITH ") else f"WITH {head} {body}"


__all__ = ["LABELS", "PARTS", "SPAN", "SQL", "STEREO_PAIRS", "sql"]
