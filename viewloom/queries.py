"""The library's registered queries, each with its SQL for DuckDB where SQL can say it."""

from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom import fixtures as fx
from viewloom import plans, sources, streaming
from viewloom.functions import arrays, frames, names
from viewloom.operators import annotations as ann
from viewloom.operators import catalog, planning, stereo, sync
from viewloom.schemas import PAIRS, PARTS, VIEWS
from viewloom.streaming import nearest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(body: str | None = None, *views: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if body:
            _SQL[f.__name__] = fx.sql(body, *views)
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g2_triangulate(spark, sf_dir)


# --- sources and sinks


@query()
def s1_read_catalog(spark, sf_dir):
    c = sources.read_catalog(spark, sf_dir, (".parquet",))
    return c.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


@query("SELECT video_url, start_s, end_s, label FROM fx_tricks", "fx_tricks")
def s2_read_annotations(spark, sf_dir):
    """Label exports, written as JSON arrays of a few hundred videos each, and read."""
    records = fx.annotations(spark, sf_dir).groupBy(F.floor(F.col("item") / 256).alias("part")).agg(F.to_json(F.collect_list(F.struct("video_url", "tricks"))).alias("value"))
    path = sources.shared_folder(spark)
    records.write.partitionBy("part").text(path)
    good, _ = sources.read_annotations(spark, f"{path}/*/*.txt")
    rows = good.select("video_url", F.explode("tricks").alias("t"))
    return rows.select("video_url", F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"), F.explode("t.labels").alias("label"))


@query("SELECT participant, position, task FROM fx_plan", "fx_plan")
def s3_read_task_plan(spark, sf_dir):
    """Plans as JSON maps from participants to tasks, a few hundred participants each, written and read."""
    long = sources.unpivot_task_plan(fx.plan_wide(spark, sf_dir)).groupBy("participant").agg(F.array_sort(F.collect_list(F.struct("position", "task"))).alias("t"))
    number = F.floor(F.substring("participant", 2, 12).cast("long") / 256)
    maps = long.groupBy(number.alias("part")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("participant", "t.task")))).alias("value"))
    path = sources.shared_folder(spark)
    maps.write.partitionBy("part").text(path)
    return sources.read_task_plan(spark, f"{path}/*/*.txt")


@query(
    "SELECT participant, pair, retval, f AS f, cx, cy, c, s, tx, left_dist, right_dist, left_count, right_count, f AS p1, 4 * f AS q FROM fx_calibration",
    "fx_calibration",
)
def s5_decode_calibrations(spark, sf_dir):
    """Calibrations as npz files with all their fields, packed and read again."""
    c = fx.calibration(spark, sf_dir).withColumns({"P1": F.col("left_mtx"), "Q": F.transform("left_mtx", lambda x: 4.0 * x), "E": F.col("R"), "F": F.col("R"), "R1": F.col("R"), "R2": F.col("R"), "P2": F.col("right_mtx")})
    arrays_ = ["left_mtx", "right_mtx", "left_dist", "right_dist", "R", "T", "E", "F", "R1", "R2", "P1", "P2", "Q"]
    chosen = c.select("participant", "pair", "retval", "left_count", "right_count", *arrays_)

    def packed(batches):
        import io

        import numpy as np
        import pandas as pd

        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                out = io.BytesIO()
                np.savez(out, **{k: np.asarray(r[k], float) for k in arrays_}, retval=r["retval"], left_count=r["left_count"], right_count=r["right_count"])
                rows.append((f"x/{r['participant']}_{r['pair']}.npz", out.getvalue()))
            yield pd.DataFrame(rows, columns=["path", "content"])

    # a row is milliseconds of work, so the few files of a small table are dealt to all tasks
    spread = chosen.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "participant", "pair")
    got = sources.decode_calibrations(spread.mapInPandas(packed, "path string, content binary"))
    value = {"f": "left_mtx[0]", "cx": "right_mtx[2]", "cy": "right_mtx[5]", "c": "R[0]", "s": "R1[2]", "tx": "T[0]", "left_dist": "cast(size(left_dist) as bigint)", "right_dist": "cast(size(right_dist) as bigint)", "left_count": "left_count", "right_count": "right_count", "p1": "P1[0]", "q": "Q[0]"}
    return got.select("participant", "pair", "retval", *(F.expr(e).alias(k) for k, e in value.items()))


@query("SELECT participant, position, task FROM fx_plan", "fx_plan")
def s3_unpivot_task_plan(spark, sf_dir):
    return sources.unpivot_task_plan(fx.plan_wide(spark, sf_dir)).select("participant", F.col("position").cast("long").alias("position"), "task")


_SIZES = {p: b - a for p, (a, b) in fx.SPAN.items()}


@query("SELECT participant, view, frame_idx, part, point, x, y FROM fx_points WHERE present", "fx_points")
def s4_landmarks_round_trip(spark, sf_dir):
    path = sources.shared_folder(spark)
    sources.write_landmarks(fx.landmarks(spark, sf_dir), path, _SIZES)
    good, _ = sources.read_landmarks(spark, path, _SIZES)
    return _long(good)


@query("SELECT view, subtask, count(*) AS n, sum(bytes)::BIGINT AS bytes FROM fx_segments GROUP BY ALL", "fx_segments")
def s6_write_by_view_subtask(spark, sf_dir):
    path = sources.shared_folder(spark)
    sources.write_by_view_subtask(fx.segments(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("view", "subtask").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


_NEW = "SELECT participant, view, video, CAST(fps AS BIGINT) AS fps, frame_count FROM fx_videos"


@query(f"SELECT DISTINCT * FROM ({_NEW}) n WHERE NOT (n.frame_count % 3 = 0)", "fx_videos")
def s7_append_new_rows(spark, sf_dir):
    v = fx.videos(spark, sf_dir).withColumn("fps", F.col("fps").cast("long"))
    return sources.append_new_rows(v.where("frame_count % 3 = 0"), v)


@query("SELECT label, count(*) AS n FROM fx_tricks GROUP BY label", "fx_tricks")
def s8_write_report(spark, sf_dir):
    path = sources.shared_folder(spark)
    sources.write_report(ann.label_counts(fx.annotations(spark, sf_dir)), path)
    return spark.read.option("header", True).schema("label string, n long").csv(path)


# --- names, filters and scalar functions

_PARSE = r"'^([^-/]+)-([^-/]+)-([^-/]+)-([^-/]+)-(\d+(?:\.\d+)?)_(\d+(?:\.\d+)?)\.(\w+)$'"


@query(
    f"""SELECT path, regexp_extract(path, {_PARSE}, 1) AS participant, regexp_extract(path, {_PARSE}, 2) AS view, regexp_extract(path, {_PARSE}, 3) AS task,
  regexp_extract(path, {_PARSE}, 4) AS subtask, CAST(regexp_extract(path, {_PARSE}, 5) AS DOUBLE) AS start_s, CAST(regexp_extract(path, {_PARSE}, 6) AS DOUBLE) AS end_s FROM fx_segments""",
    "fx_segments",
)
def p1_parse_segment_name(spark, sf_dir):
    s = fx.segments(spark, sf_dir).select("path", names.parse_segment_name("path").alias("p"))
    return s.select("path", "p.participant", "p.view", "p.task", "p.subtask", "p.start_s", "p.end_s")


@query("""SELECT page_id, array_to_string([x FOR x IN string_split(url || '/p01/CAM_LL/a.mp4', '/') IF starts_with(x, 'p') OR starts_with(x, 'CAM_') OR ends_with(x, '.mp4')], '/') AS path FROM pages""")
def p2_canonical_path(spark, sf_dir):
    return fx.read(spark, sf_dir, "pages").select("page_id", names.canonical_path(F.concat("url", F.lit("/p01/CAM_LL/a.mp4"))).alias("path"))


@query(
    r"""SELECT subtask, start_s, end_s, end_s - start_s AS duration, count(*) AS n FROM (SELECT *, subtask || '-' || CAST(start_s AS VARCHAR) || '_' || CAST(end_s AS VARCHAR) || CASE WHEN frame_count = 100 THEN '.txt' ELSE '.h5' END AS f FROM fx_segments)
  WHERE ends_with(f, '.h5') GROUP BY ALL""",
    "fx_segments",
)
def p3_segment_times(spark, sf_dir):
    ext = F.when(F.col("frame_count") == 100, ".txt").otherwise(".h5")
    name = F.concat("subtask", F.lit("-"), F.col("start_s").cast("string"), F.lit("_"), F.col("end_s").cast("string"), ext)
    t = fx.segments(spark, sf_dir).select(names.segment_times(name).alias("t")).where("t is not null").select("t.*")
    return t.groupBy("subtask", "start_s", "end_s", "duration").agg(F.count("*").alias("n"))


@query(r"SELECT file, label, nullif(regexp_extract(label, '\((.*?)\)', 1), '') AS abbreviation, count(*) AS n FROM fx_tricks GROUP BY ALL", "fx_tricks")
def p4_label_abbreviation(spark, sf_dir):
    rows = ann.labels(fx.annotations(spark, sf_dir)).withColumn("abbreviation", names.label_abbreviation("label"))
    return rows.groupBy("file", "label", "abbreviation").agg(F.count("*").alias("n"))


@query("SELECT path, count(*) AS n FROM fx_segments GROUP BY path", "fx_segments")
def p5_segment_name(spark, sf_dir):
    return fx.segments(spark, sf_dir).groupBy("path").agg(F.count("*").alias("n"))


@query(
    """SELECT participant, view, file, bytes FROM fx_files WHERE view IN ('CAM_AV', 'CAM_LR') AND starts_with(file, 'GX') AND ends_with(lower(file), '.mp4') AND CAST(substr(participant, 2) AS INTEGER) BETWEEN 8 AND 60""",
    "fx_files",
)
def p6_select_files(spark, sf_dir):
    return names.select_files(fx.camera_files(spark, sf_dir), ["CAM_AV", "CAM_LR"], "GX", (".mp4",), (8, 60))


_DURATION = "(SELECT *, CASE WHEN fps <> 0 THEN frame_count / fps ELSE 0.0::DOUBLE END AS duration_s FROM (SELECT participant, view, video, CASE WHEN frame_count % 50 = 0 THEN 0.0::DOUBLE ELSE fps END AS fps, frame_count FROM fx_videos))"


@query(f"SELECT participant, view, video, fps, frame_count, duration_s FROM {_DURATION}", "fx_videos")
def p7_with_duration(spark, sf_dir):
    v = fx.videos(spark, sf_dir).withColumn("fps", F.when(F.col("frame_count") % 50 == 0, 0.0).otherwise(F.col("fps")))
    return frames.with_duration(v)


@query("SELECT event_id, frame_idx, frame_idx / 30.0::DOUBLE AS timestamp_s FROM fx_frames", "fx_frames")
def p8_frame_time(spark, sf_dir):
    return frames.frame_time(fx.frames(spark, sf_dir).select("event_id", "frame_idx"))


@query("SELECT participant, view, frame_idx, point, CAST(trunc(x * 960) AS INTEGER) AS px, CAST(trunc(y * 540) AS INTEGER) AS py FROM fx_points WHERE present AND part = 'face'", "fx_points")
def p9_to_pixel(spark, sf_dir):
    lm = fx.landmarks(spark, sf_dir).select("participant", "view", "frame_idx", F.posexplode(frames.to_pixel(F.col("face"), 960, 540)).alias("point", "p"))
    return lm.select("participant", "view", "frame_idx", "point", F.col("p")[0].alias("px"), F.col("p")[1].alias("py"))


@query("SELECT event_id, x / 960.0::DOUBLE AS gx, k / 540.0::DOUBLE AS gy FROM fx_frames", "fx_frames")
def p10_normalize_gaze(spark, sf_dir):
    gx, gy = frames.normalize_gaze(F.col("x"), F.col("k"), 960, 540)
    return fx.frames(spark, sf_dir).select("event_id", gx.alias("gx"), gy.alias("gy"))


@query("SELECT p_partkey, CAST(trunc((p_size * 40) * 30.0::DOUBLE / 100.0::DOUBLE) AS INTEGER) AS width, CAST(trunc((p_size * 30) * 30.0::DOUBLE / 100.0::DOUBLE) AS INTEGER) AS height FROM part")
def p11_scale_size(spark, sf_dir):
    w, h = frames.scale_size(F.col("p_size") * 40, F.col("p_size") * 30, 30.0)
    return fx.read(spark, sf_dir, "part").select("p_partkey", w.alias("width"), h.alias("height"))


@query("SELECT participant, f * 0.5::DOUBLE AS fx, cx * 0.5::DOUBLE AS cx, f * 0.25::DOUBLE AS fy, cy * 0.25::DOUBLE AS cy FROM fx_calibration", "fx_calibration")
def p12_scale_intrinsics(spark, sf_dir):
    k = frames.scale_intrinsics(F.col("left_mtx"), (1920.0, 1080.0), (960.0, 270.0))
    return fx.calibration(spark, sf_dir).select("participant", k.alias("k")).select("participant", F.expr("k[0]").alias("fx"), F.expr("k[2]").alias("cx"), F.expr("k[4]").alias("fy"), F.expr("k[5]").alias("cy"))


@query(
    """SELECT p.participant, frame_idx, view, point, round(f * x + 0.0::DOUBLE * y + cx, 9) AS u, round(0.0::DOUBLE * x + f * y + cy, 9) AS v FROM fx_points p JOIN fx_calibration c USING (participant) WHERE present AND part = 'pose'""",
    "fx_points",
    "fx_calibration",
)
def p13_project_homogeneous(spark, sf_dir):
    lm = fx.landmarks(spark, sf_dir).where("pose is not null").join(stereo.small(fx.calibration(spark, sf_dir)), "participant")
    p = lm.select("participant", "frame_idx", "view", F.posexplode(frames.project_homogeneous(F.col("pose"), F.col("left_mtx"))).alias("point", "p"))
    return p.select("participant", "frame_idx", "view", "point", F.round(F.col("p")[0], 9).alias("u"), F.round(F.col("p")[1], 9).alias("v"))


_LOOK = """CASE WHEN x < -1 AND y < -1 THEN 'Looking Down-Left' WHEN x < -2 AND y > 2 THEN 'Looking Down-Right' WHEN x > 1 AND y < -1 THEN 'Looking Upper-Left' WHEN x > 1 AND y > 1 THEN 'Looking Upper-Right'
  WHEN y < -1 THEN 'Looking Left' WHEN y > 1 THEN 'Looking Right' WHEN x < -1 THEN 'Looking Down' WHEN x > 1 THEN 'Looking Up' ELSE 'Forward' END"""


@query(f"SELECT frame_id, x, y, {_LOOK} AS label FROM fx_angles", "fx_angles")
def p14_look_direction(spark, sf_dir):
    return streaming.labelled(fx.angles(spark, sf_dir)).select("frame_id", "x", "y", "label")


@query(
    """SELECT event_id, frame_idx, frame_idx // 5 AS sample_idx, participant || '_' || view || '_' || printf('%04d', frame_idx // 5) AS image FROM fx_frames WHERE frame_idx % 5 = 0""",
    "fx_frames",
)
def p15_sample_every_n(spark, sf_dir):
    return frames.sample_every_n(fx.frames(spark, sf_dir).select("event_id", "participant", "view", "frame_idx"), 5, ["participant", "view"]).select("event_id", "frame_idx", "sample_idx", "image")


_VARIANTS = "(VALUES ('BIAH', 0, 'BIAH_BS'), ('BIAH', 1, 'BIAH_RB'), ('BIAH', 2, 'BIAH_BV'), ('BRIDGE', 0, 'BRIDGE_AS'), ('BRIDGE', 1, 'BRIDGE_BV'), ('STAIRWAY', 0, 'STAIRWAY_AP'), ('STAIRWAY', 1, 'STAIRWAY_MS'), ('TOWER', 0, 'TOWER_MS'), ('TOWER', 1, 'TOWER_HO')) v(family, n, name)"
_EXPANDED = f"SELECT participant, row_number() OVER (PARTITION BY participant ORDER BY position, n) AS position, coalesce(name, task) AS task FROM fx_plan LEFT JOIN {_VARIANTS} ON family = task"


def _plan(spark, sf_dir):
    return planning.expand_task_variants(sources.unpivot_task_plan(fx.plan_wide(spark, sf_dir)))


@query(_EXPANDED, "fx_plan")
def p16_expand_task_variants(spark, sf_dir):
    return _plan(spark, sf_dir)


# --- joins


@query(
    """SELECT r.participant, t.view, r.video, r.fps AS ref_fps, r.frame_count AS ref_frames, t.fps, t.frame_count FROM fx_videos r JOIN fx_videos t ON t.participant = r.participant AND t.video = r.video
  WHERE r.view = 'CAM_AV' AND t.view IN ('CAM_LL', 'CAM_LR', 'CAM_UL', 'CAM_UR')""",
    "fx_videos",
)
def j1_pair_views(spark, sf_dir):
    return sync.pair_views(fx.videos(spark, sf_dir), "CAM_AV", VIEWS[1:])[0]


@query(
    """SELECT r.participant, v.view, r.video FROM fx_videos r, (VALUES ('CAM_LL'), ('CAM_LR'), ('CAM_UL'), ('CAM_UR')) v(view) WHERE r.view = 'CAM_AV'
  AND NOT EXISTS (SELECT 1 FROM fx_videos t WHERE t.participant = r.participant AND t.video = r.video AND t.view = v.view)""",
    "fx_videos",
)
def j1_missing_views(spark, sf_dir):
    return sync.pair_views(fx.videos(spark, sf_dir), "CAM_AV", VIEWS[1:])[1]


_STEREO = """SELECT l.participant, l.subtask, l.start_s, l.frame_idx, l.part, l.point, l.x AS lx, l.y AS ly, r.x AS rx, r.y AS ry, c.* EXCLUDE (participant) FROM fx_stereo l
  JOIN fx_stereo r USING (participant, task, subtask, start_s, end_s, frame_idx, part, point)
  JOIN fx_calibration c ON c.participant = l.participant AND c.pair = replace(l.view, 'CAM_', '') || '_' || replace(r.view, 'CAM_', '') WHERE l.present AND r.present"""
_FRAME = ["participant", "pair", "subtask", "start_s", "frame_idx"]


def _stereo(spark, sf_dir, parts=None, lm=None):
    lm, matrices = lm or fx.stereo_landmarks(spark, sf_dir), stereo.projection_matrices(fx.calibration(spark, sf_dir))
    first, *others = (stereo.join_stereo_frames(lm, matrices, *pair, parts=parts) for pair in fx.STEREO_PAIRS)
    return functools.reduce(DataFrame.unionByName, others, first)


@query(f"SELECT participant, pair, subtask, start_s, frame_idx, part, point, lx, ly, rx, ry, retval FROM ({_STEREO})", "fx_stereo", "fx_calibration")
def j2_join_stereo_frames(spark, sf_dir):
    return _stereo_points(_stereo(spark, sf_dir))


def _stereo_points(j: DataFrame) -> DataFrame:
    stacked = F.array(*(F.struct(F.lit(p).alias("part"), F.arrays_zip(F.col(f"left_{p}").alias("l"), F.col(f"right_{p}").alias("r")).alias("pts")) for p in PARTS))
    rows = j.select(*_FRAME, "retval", F.inline(stacked)).select(*_FRAME, "retval", "part", F.posexplode("pts").alias("point", "p"))
    return rows.select(*_FRAME, "part", "point", F.expr("p.l[0]").alias("lx"), F.expr("p.l[1]").alias("ly"), F.expr("p.r[0]").alias("rx"), F.expr("p.r[1]").alias("ry"), "retval")


@query(f"SELECT participant, pair, subtask, start_s, frame_idx, part, point, lx, ly, rx, ry, retval FROM ({_STEREO})", "fx_stereo", "fx_calibration")
def j2_join_stereo_bucketed(spark, sf_dir):
    """The same rows from landmarks that lie bucketed by participant, segment and frame, whose sides are joined where they lie."""
    name, path, joined = f"landmarks_{uuid.uuid4().hex}", sources.shared_folder(spark), sources.shared_folder(spark)
    lm = sources.write_landmark_table(fx.stereo_landmarks(spark, sf_dir), name, path, _SIZES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = _stereo_points(_stereo(spark, sf_dir, lm=lm))
    rows.write.parquet(joined)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(rows.schema).parquet(joined)


@query("SELECT event_id, f.participant, subtask, media_t, start_s, end_s FROM fx_frames f JOIN (SELECT DISTINCT participant, subtask, start_s, end_s FROM fx_segments) s ON s.participant = f.participant AND media_t >= start_s AND media_t < end_s", "fx_frames", "fx_segments")
def j3_assign_segments(spark, sf_dir):
    clips = fx.segments(spark, sf_dir).select("participant", "subtask", "start_s", "end_s").distinct()
    return ann.assign_segments(fx.frames(spark, sf_dir).select("event_id", "participant", "media_t"), clips, ["participant"]).select("event_id", "participant", "subtask", "media_t", "start_s", "end_s")


_TOLERANCE = 3_600_000
_NEAR = f"""SELECT l.participant, l.frame_idx AS l_idx, r.frame_idx AS r_idx, l.t_ms AS l_t, r.t_ms AS r_t, abs(l.t_ms - r.t_ms) AS dt FROM fx_frames l JOIN fx_frames r ON l.participant = r.participant
  AND abs(l.t_ms - r.t_ms) <= {_TOLERANCE} WHERE l.view = 'CAM_LL' AND r.view = 'CAM_LR'"""


def _sides(spark, sf_dir):
    f = fx.frames(spark, sf_dir).select("participant", "view", "frame_idx", "t_ms", "ts")
    return f.where("view = 'CAM_LL'"), f.where("view = 'CAM_LR'")


_MUTUAL = f"""WITH near AS ({_NEAR}), ranked AS (SELECT *, row_number() OVER (PARTITION BY participant, l_idx ORDER BY dt, r_t, r_idx) AS a, row_number() OVER (PARTITION BY participant, r_idx ORDER BY dt, l_t, l_idx) AS b FROM near)
  SELECT participant, l_idx, r_idx, l_t, r_t, dt FROM ranked WHERE a = 1 AND b = 1"""


@query(_MUTUAL, "fx_frames")
def j4_sync_frames(spark, sf_dir):
    return sync.sync_frames(*_sides(spark, sf_dir), ["participant"], _TOLERANCE)


@query()
def j4_sync_frames_greedy(spark, sf_dir):
    return sync.sync_frames_greedy(*_sides(spark, sf_dir), ["participant"], _TOLERANCE)


@query(
    r"""WITH t AS (SELECT regexp_extract(video_url, '(p\d+)_CAM', 1) AS participant, regexp_extract(video_url, 'CAM_AV_P_(\w+)\.mp4', 1) AS task, start_s, end_s, label, nullif(regexp_extract(label, '\((.*?)\)', 1), '') AS abbreviation FROM fx_tricks)
  SELECT *, 'segments/' || abbreviation || '/' || name AS path FROM (SELECT participant, task, view, abbreviation, start_s, end_s, participant || '-' || view || '-' || task || '-' || abbreviation || '-' || CAST(start_s AS VARCHAR) || '_' || CAST(end_s AS VARCHAR) || '.mp4' AS name
  FROM t, (VALUES ('CAM_AV'), ('CAM_LL'), ('CAM_LR'), ('CAM_UL'), ('CAM_UR')) v(view) WHERE abbreviation IS NOT NULL)""",
    "fx_tricks",
)
def j5_segments_per_view(spark, sf_dir):
    return ann.segments_per_view(fx.annotations(spark, sf_dir)).select("participant", "task", "view", "abbreviation", "start_s", "end_s", "name", "path")


@query(
    f"""WITH plan AS ({_EXPANDED}), n AS (SELECT participant, view, file, row_number() OVER (PARTITION BY participant, view ORDER BY file) + 1 AS position FROM fx_files WHERE starts_with(file, 'GX') AND ends_with(lower(file), '.mp4'))
  SELECT participant, view, file, task || '.mp4' AS new_name FROM n JOIN plan USING (participant, position)""",
    "fx_plan",
    "fx_files",
)
def j6_rename_plan(spark, sf_dir):
    return planning.rename_plan(fx.camera_files(spark, sf_dir), _plan(spark, sf_dir))


@query("SELECT participant, view, file, bytes FROM fx_files WHERE file NOT IN (SELECT file FROM fx_files WHERE bytes % 3 = 0)", "fx_files")
def j7_pending(spark, sf_dir):
    files = fx.camera_files(spark, sf_dir)
    return catalog.pending(files, files.where("bytes % 3 = 0")).select("participant", "view", "file", "bytes")


@query("SELECT printf('p%02d', i) AS participant, coalesce(CAST(retval AS VARCHAR), 'N/A') AS error FROM range(1, 71) r(i) LEFT JOIN fx_calibration c ON c.participant = printf('p%02d', i)", "fx_calibration")
def j8_calibration_error_report(spark, sf_dir):
    return stereo.calibration_error_report(fx.calibration(spark, sf_dir), 1, 70)[0]


_PAIR_NAMES = [stereo.pair_name(*p) for p in fx.STEREO_PAIRS]


@query(
    """SELECT participant, pair, participant || '_' || pair || '_stereo.npz' AS file, coalesce(CAST(retval AS VARCHAR), 'N/A') AS error
  FROM (SELECT printf('p%02d', i) AS participant, p AS pair FROM range(1, 71) r(i), (VALUES ('LL_LR'), ('UL_UR')) v(p)) LEFT JOIN fx_calibration USING (participant, pair)""",
    "fx_calibration",
)
def j8_calibration_errors_by_pair(spark, sf_dir):
    return stereo.calibration_errors_by_pair(fx.calibration(spark, sf_dir), 1, 70, _PAIR_NAMES)


@query("SELECT count(retval) AS present, avg(retval) AS mean_error, max(retval) AS max_error FROM fx_calibration WHERE number BETWEEN 1 AND 70", "fx_calibration")
def j8_calibration_error_summary(spark, sf_dir):
    return stereo.calibration_error_report(fx.calibration(spark, sf_dir), 1, 70)[1]


@query(
    """SELECT l.participant, l.pair, l.frame_idx, i AS corner, 10.0::DOUBLE * i + l.shift AS lx, 10.0::DOUBLE * i + r.shift AS rx, (i % 7) * 1.0::DOUBLE AS bx, (i // 7) * 1.0::DOUBLE AS by_ FROM fx_observations l JOIN fx_observations r USING (participant, pair, frame_idx, n), range(20) g(i)
  WHERE l.side = 'left' AND r.side = 'right' AND i < n""",
    "fx_observations",
)
def j9_stereo_correspondences(spark, sf_dir):
    c = stereo.stereo_correspondences(fx.observations(spark, sf_dir))
    rows = c.select("participant", "pair", "frame_idx", F.inline(F.arrays_zip("ids", "left_corners", "right_corners", "board")))
    return rows.select("participant", "pair", "frame_idx", F.col("ids").alias("corner"), F.expr("left_corners[0]").alias("lx"), F.expr("right_corners[0]").alias("rx"), F.expr("board[0]").alias("bx"), F.expr("board[1]").alias("by_"))


@query(
    "SELECT participant, pair, left_dist = right_dist AS same, '9x' || left_dist AS left_shape, '9x' || right_dist AS right_shape, least(left_count, right_count) AS views FROM fx_calibration",
    "fx_calibration",
)
def j10_calibration_shape_check(spark, sf_dir):
    return stereo.calibration_shape_check(fx.calibration(spark, sf_dir))


_TRAIN, _VALID = "frame_count < 102 AND subtask <> 'CG' AND subtask <> 'THP'", "frame_count = 102"
_CLIP = "participant, subtask, start_s, end_s, bytes"


def _splits(spark, sf_dir):
    s = fx.segments(spark, sf_dir)
    return s.where(_TRAIN).select(*_CLIP.split(", ")), s.where(_VALID).select(*_CLIP.split(", "))


@query(f"SELECT {_CLIP} FROM fx_segments WHERE {_VALID} AND subtask IN (SELECT subtask FROM fx_segments WHERE {_TRAIN})", "fx_segments")
def j11_shared_subtasks(spark, sf_dir):
    train, valid = _splits(spark, sf_dir)
    return ann.shared_subtasks(valid, train).select(*_CLIP.split(", "))


_PAIR_ROWS = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in PAIRS) + ") q(l, r)"


@query(
    f"""WITH v AS (SELECT DISTINCT participant, view FROM fx_videos), c AS (SELECT DISTINCT participant, view FROM fx_files), p AS (SELECT participant FROM v UNION SELECT participant FROM c),
  x AS (SELECT participant, l, r, (participant, l) IN (SELECT (participant, view) FROM v) AS left_video, (participant, l) IN (SELECT (participant, view) FROM c) AS left_calibration,
  (participant, r) IN (SELECT (participant, view) FROM v) AS right_video, (participant, r) IN (SELECT (participant, view) FROM c) AS right_calibration FROM p, {_PAIR_ROWS})
  SELECT participant, l AS "left", r AS "right", left_video, left_calibration, right_video, right_calibration, left_video AND left_calibration AND right_video AND right_calibration AS complete FROM x""",
    "fx_videos",
    "fx_files",
)
def j12_calibration_assets(spark, sf_dir):
    return stereo.calibration_assets(fx.videos(spark, sf_dir), fx.camera_files(spark, sf_dir))


# --- aggregations


@query("SELECT label, count(*) AS n FROM fx_tricks GROUP BY label", "fx_tricks")
def a1_label_counts(spark, sf_dir):
    return ann.label_counts(fx.annotations(spark, sf_dir))


@query("SELECT file, label, count(*) AS n FROM fx_tricks GROUP BY file, label", "fx_tricks")
def a2_label_counts_by_file(spark, sf_dir):
    return ann.label_counts_by_file(fx.annotations(spark, sf_dir))


@query(
    f"""WITH b AS (SELECT 'train' AS split, * FROM fx_segments WHERE {_TRAIN} UNION ALL SELECT 'valid', * FROM fx_segments WHERE {_VALID})
  SELECT split, subtask, count(*) AS n, min(end_s - start_s) AS min_s, round(sum(end_s - start_s) / count(*), 6) AS mean_s, max(end_s - start_s) AS max_s FROM b GROUP BY ALL""",
    "fx_segments",
)
def a3_subtask_durations(spark, sf_dir):
    return ann.subtask_durations(*_splits(spark, sf_dir))


@query(
    f"""SELECT 'train' AS split, subtask, start_s, end_s, end_s - start_s AS duration_s FROM fx_segments WHERE {_TRAIN} UNION ALL SELECT 'valid', subtask, start_s, end_s, end_s - start_s FROM fx_segments WHERE {_VALID}""",
    "fx_segments",
)
def a3_segment_durations(spark, sf_dir):
    return ann.segment_durations(*_splits(spark, sf_dir)).select("split", "subtask", "start_s", "end_s", "duration_s")


_GROUPS = """WITH v AS (SELECT participant, task, subtask, CAST(start_s AS VARCHAR) || '_' || CAST(end_s AS VARCHAR) AS times, view, max(frame_count) AS frame_count FROM fx_segments GROUP BY ALL),
  g AS (SELECT participant, task, subtask, times, count(*) AS views, min(frame_count) AS lo, max(frame_count) AS hi, string_agg(view || '=' || frame_count, ',' ORDER BY view) AS by_view FROM v GROUP BY ALL)"""


def _by_view(df: DataFrame) -> DataFrame:
    text = F.array_join(F.transform(F.array_sort(F.map_entries("by_view")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return df.select("participant", "task", "subtask", "times", "views", text.alias("by_view"))


@query(f"{_GROUPS} SELECT participant, task, subtask, times, views, by_view FROM g WHERE views > 1 AND lo <> hi", "fx_segments")
def a4_frame_count_discrepancies(spark, sf_dir):
    return _by_view(ann.frame_count_consistency(fx.segments(spark, sf_dir))[1])


@query(f"{_GROUPS} SELECT participant, task, subtask, times, views, by_view FROM g WHERE views > 1 AND lo = hi", "fx_segments")
def a4_frame_count_same(spark, sf_dir):
    return _by_view(ann.frame_count_consistency(fx.segments(spark, sf_dir))[0])


@query(f"{_GROUPS} SELECT participant, task, subtask, times, views, by_view FROM g WHERE views = 1", "fx_segments")
def a4_single_views(spark, sf_dir):
    return _by_view(ann.frame_count_consistency(fx.segments(spark, sf_dir))[2])


_CAMERA = """SELECT participant, view, count(*) AS videos, count(DISTINCT fps) AS fps_values, count(DISTINCT duration_s) AS duration_values, CASE WHEN count(DISTINCT fps) = 1 THEN min(fps) END AS fps,
  CASE WHEN count(DISTINCT duration_s) = 1 THEN min(duration_s) END AS duration_s, CASE WHEN count(DISTINCT fps) = 1 AND count(DISTINCT duration_s) = 1 THEN 'single' ELSE 'review' END AS status
  FROM (SELECT *, CASE WHEN fps <> 0 THEN frame_count / fps ELSE 0.0::DOUBLE END AS duration_s FROM fx_videos) GROUP BY participant, view"""


@query(_CAMERA, "fx_videos")
def a5_camera_integrity(spark, sf_dir):
    return catalog.camera_integrity(frames.with_duration(fx.videos(spark, sf_dir)))


@query(
    f"""WITH c AS ({_CAMERA}) SELECT a.participant, CASE WHEN a.status = 'review' OR b.status = 'review' THEN 'review' WHEN a.fps <> b.fps AND a.duration_s <> b.duration_s THEN 'both' WHEN a.fps <> b.fps THEN 'fps'
  WHEN a.duration_s <> b.duration_s THEN 'duration' ELSE 'none' END AS outcome FROM c a JOIN c b USING (participant) WHERE a.view = 'CAM_LL' AND b.view = 'CAM_LR'""",
    "fx_videos",
)
def a6_compare_cameras(spark, sf_dir):
    return catalog.compare_cameras(frames.with_duration(fx.videos(spark, sf_dir)))


@query("SELECT participant, view, count(*) AS videos, CASE WHEN count(*) < 8 THEN '<8' WHEN count(*) > 8 THEN '>8' ELSE 'ok' END AS status FROM fx_videos GROUP BY ALL", "fx_videos")
def a7_video_count_status(spark, sf_dir):
    return catalog.video_count_status(fx.videos(spark, sf_dir), 8)


@query(
    "SELECT participant, view, sum(CASE WHEN contains(file, 'calib') THEN 1 ELSE 0 END)::BIGINT AS files, grouping(participant, view)::INTEGER AS level FROM fx_files GROUP BY ROLLUP (participant, view)",
    "fx_files",
)
def a8_presence_rollup(spark, sf_dir):
    return catalog.presence_rollup(fx.camera_files(spark, sf_dir), "calib")


@query("SELECT DISTINCT replace(video, '.mp4', '') AS label FROM fx_videos", "fx_videos")
def a9_distinct_labels(spark, sf_dir):
    return catalog.distinct_labels(fx.videos(spark, sf_dir))


@query("SELECT view, sum(CASE WHEN bytes < 100000 THEN 1 ELSE 0 END)::BIGINT AS corrupt FROM fx_segments GROUP BY view", "fx_segments")
def a10_corrupt_segments(spark, sf_dir):
    return catalog.corrupt_segments(fx.segments(spark, sf_dir))[1]


@query(
    """WITH b AS (SELECT l.participant, l.pair, count(*) FILTER (n >= 15) AS k FROM fx_observations l JOIN fx_observations r USING (participant, pair, frame_idx, n) WHERE l.side = 'left' AND r.side = 'right' GROUP BY ALL)
  SELECT participant, pair, coalesce(k, 0) AS frames, coalesce(k, 0) >= 5 AS ready FROM (SELECT DISTINCT participant, pair FROM fx_observations) LEFT JOIN b USING (participant, pair)""",
    "fx_observations",
)
def a11_stereo_readiness(spark, sf_dir):
    return stereo.stereo_readiness(fx.observations(spark, sf_dir), 5)


# --- windows, sorts, limits


@query(
    """WITH w AS (SELECT *, count(*) OVER (PARTITION BY participant, view) AS n, min(fps) OVER o AS lo, max(fps) OVER o AS hi FROM fx_videos WINDOW o AS (PARTITION BY participant, view ORDER BY video ROWS UNBOUNDED PRECEDING))
  SELECT participant, view, video, fps, frame_count FROM w WHERE n <= 10 AND lo < hi""",
    "fx_videos",
)
def w1_fps_conflicts(spark, sf_dir):
    return catalog.fps_conflicts(fx.videos(spark, sf_dir))


# rates of the streams of fx_frames: 50 fps of CAM_LL and CAM_LR, 30 of CAM_AV, 25 of the others
_RATES = "SELECT DISTINCT participant, view, CASE WHEN view IN ('CAM_LL', 'CAM_LR') THEN 50.0::DOUBLE WHEN view = 'CAM_AV' THEN 30.0::DOUBLE ELSE 60.0::DOUBLE END AS fps FROM fx_frames"


@query(
    f"""WITH r AS ({_RATES}), t AS (SELECT participant, min(fps) AS target_fps FROM r GROUP BY participant), k AS (SELECT f.event_id, f.participant, f.view, f.frame_idx, target_fps FROM fx_frames f JOIN r USING (participant, view) JOIN t USING (participant)
  WHERE f.frame_idx % (fps / target_fps) < 1) SELECT event_id, frame_idx, target_fps, row_number() OVER (PARTITION BY participant, view ORDER BY frame_idx) - 1 AS new_idx FROM k""",
    "fx_frames",
)
def w2_harmonize_fps(spark, sf_dir):
    f = fx.frames(spark, sf_dir).select("event_id", "participant", "view", "frame_idx")
    rate = F.when(F.col("view").isin("CAM_LL", "CAM_LR"), 50.0).when(F.col("view") == "CAM_AV", 30.0).otherwise(60.0)
    rates = f.select("participant", "view").distinct().withColumn("fps", rate)
    return sync.harmonize_fps(f, rates, ["participant"], ["participant", "view"]).select("event_id", "frame_idx", "target_fps", "new_idx")


_LENGTHS = "n AS (SELECT participant, view, max(frame_idx) + 1 AS frames FROM fx_frames GROUP BY ALL), m AS (SELECT *, min(frames) OVER (PARTITION BY participant) AS keep FROM n)"


@query(f"WITH {_LENGTHS} SELECT event_id, participant, view, frame_idx FROM fx_frames JOIN m USING (participant, view) WHERE frame_idx < keep", "fx_frames")
def w3_match_length(spark, sf_dir):
    f = fx.frames(spark, sf_dir).select("event_id", "participant", "view", "frame_idx")
    return sync.match_length(f, ["participant"], ["participant", "view"])[0].select("event_id", "participant", "view", "frame_idx")


@query(f"WITH {_LENGTHS} SELECT participant, view, frames, keep, frames - keep AS trimmed FROM m", "fx_frames")
def w3_trim_report(spark, sf_dir):
    f = fx.frames(spark, sf_dir).select("event_id", "participant", "view", "frame_idx")
    return sync.match_length(f, ["participant"], ["participant", "view"])[1].select("participant", "view", "frames", "keep", "trimmed")


@query(f"WITH {_LENGTHS} SELECT event_id, participant, view, frame_idx - (frames - keep) AS frame_idx FROM fx_frames JOIN m USING (participant, view) WHERE frame_idx >= frames - keep", "fx_frames")
def w4_drop_leading(spark, sf_dir):
    f = fx.frames(spark, sf_dir).select("event_id", "participant", "view", "frame_idx")
    return sync.drop_leading(f, ["participant"], ["participant", "view"]).select("event_id", "participant", "view", "frame_idx")


_NTH = "SELECT *, row_number() OVER (PARTITION BY participant, pair, side, n > 14 ORDER BY frame_idx) AS k FROM fx_observations WHERE frame_idx % 3 = 0"


@query(f"SELECT participant, pair, side, frame_idx, n AS corners, k AS rank FROM ({_NTH}) WHERE n > 14 AND k <= 10", "fx_observations")
def w5_select_calibration_frames(spark, sf_dir):
    chosen, _ = stereo.select_calibration_frames(fx.observations(spark, sf_dir), 3, 14, 10, ["participant", "pair", "side"])
    return chosen.select("participant", "pair", "side", "frame_idx", F.size("ids").cast("long").alias("corners"), F.col("rank").cast("long").alias("rank"))


@query(f"SELECT participant, pair, side, count(*) AS rejected FROM ({_NTH}) WHERE NOT (n > 14 AND k <= 10) GROUP BY ALL", "fx_observations")
def w5_rejected_frames(spark, sf_dir):
    _, rejected = stereo.select_calibration_frames(fx.observations(spark, sf_dir), 3, 14, 10, ["participant", "pair", "side"])
    return rejected.groupBy("participant", "pair", "side").agg(F.count("*").alias("rejected"))


@query(
    """WITH c AS (SELECT participant, view, sum(CASE WHEN contains(file, 'calib') THEN 1 ELSE 0 END)::BIGINT AS files FROM fx_files GROUP BY ALL) SELECT participant, view, files, (sum(files) OVER (ORDER BY participant, view))::BIGINT AS running FROM c""",
    "fx_files",
)
def w6_running_presence(spark, sf_dir):
    return catalog.running_presence(fx.camera_files(spark, sf_dir), "calib")


@query(
    """WITH n AS (SELECT participant, (row_number() OVER (ORDER BY participant) - 1) // 10 AS g FROM (SELECT DISTINCT participant FROM fx_files)) SELECT g AS "group", min(participant) AS first, max(participant) AS last, count(*) AS members, min(participant) || '_to_' || max(participant) AS name FROM n GROUP BY g""",
    "fx_files",
)
def w7_batch_groups(spark, sf_dir):
    return catalog.batch_groups(fx.camera_files(spark, sf_dir), 10)


@query("SELECT subtask, count(*) AS files, count(*) // 5 AS per_view, (count(*) // 5 + 99) // 100 AS batches FROM fx_segments GROUP BY subtask", "fx_segments")
def w8_batch_plan(spark, sf_dir):
    return catalog.batch_plan(fx.segments(spark, sf_dir))


@query("SELECT participant, view, video, fps, frame_count FROM fx_videos ORDER BY participant, view, video", "fx_videos")
def w9_catalog_sorted(spark, sf_dir):
    return catalog.catalog_sorted(fx.videos(spark, sf_dir))


@query(
    """WITH p AS (SELECT DISTINCT participant FROM fx_plan WHERE participant NOT IN (SELECT participant FROM fx_videos)), r AS (SELECT participant, f, row_number() OVER (PARTITION BY participant ORDER BY md5('7,' || participant || ',' || f)) + 1 AS position
  FROM p, (VALUES ('BIAH'), ('BRIDGE'), ('STAIRWAY'), ('TOWER')) x(f)) SELECT participant, position, f AS task FROM r UNION ALL SELECT participant, 1, 'CALIBRATION' FROM p""",
    "fx_plan",
    "fx_videos",
)
def w10_randomize_tasks(spark, sf_dir):
    return planning.randomize_tasks(fx.plan_wide(spark, sf_dir), fx.videos(spark, sf_dir), 7)


# --- set operations


@query(f"SELECT {_CLIP}, 'train' AS split FROM fx_segments WHERE {_TRAIN} UNION ALL SELECT {_CLIP}, 'valid' FROM fx_segments WHERE {_VALID}", "fx_segments")
def u1_combine_splits(spark, sf_dir):
    return ann.combine_splits(*_splits(spark, sf_dir))


@query(
    """WITH b AS (SELECT path AS file, bytes AS "at", frame_count AS done, 0 AS fresh FROM fx_segments WHERE frame_count < 102 UNION ALL SELECT path, bytes, frame_count, 1 FROM fx_segments WHERE frame_count = 102)
  SELECT file, "at", done FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY "at" DESC, fresh DESC, done DESC) AS k FROM b) WHERE k = 1""",
    "fx_segments",
)
def u2_merge_manifest(spark, sf_dir):
    s = fx.segments(spark, sf_dir).select(F.col("path").alias("file"), F.col("bytes").alias("at"), F.col("frame_count").alias("done"))
    return catalog.merge_manifest(s.where("done < 102"), s.where("done = 102"))


# --- arrays and geometry


def _long(lm: DataFrame) -> DataFrame:
    rows = arrays.landmarks_long(lm, ["participant", "view", "frame_idx"], PARTS)
    return rows.select("participant", "view", "frame_idx", "part", "point", F.col("values")[0].alias("x"), F.col("values")[1].alias("y"))


@query(
    """SELECT participant, view, frame_idx, i AS box, CASE WHEN i < 8 AND present THEN x ELSE 0.0::DOUBLE END AS x, false AS cut FROM range(36) g(i), (SELECT DISTINCT participant, view, frame_idx, present FROM fx_points) f LEFT JOIN
  (SELECT participant AS p2, view AS v2, frame_idx AS f2, point, x FROM fx_points WHERE part = 'pose') ON p2 = participant AND v2 = view AND f2 = frame_idx AND point = i""",
    "fx_points",
)
def r1_fix_width(spark, sf_dir):
    fixed, cut = arrays.fix_width(F.col("pose"), 36, 2)
    lm = fx.landmarks(spark, sf_dir).select("participant", "view", "frame_idx", cut.alias("cut"), F.posexplode(fixed).alias("box", "p"))
    return lm.select("participant", "view", "frame_idx", F.col("box").cast("long").alias("box"), F.col("p")[0].alias("x"), "cut")


@query("SELECT participant, view, frame_idx, bool_and(present) AS face_present, bool_and(present)::INTEGER AS face_presence, sum(CASE WHEN present THEN 1 ELSE 0 END)::BIGINT AS filled FROM fx_points GROUP BY ALL", "fx_points")
def r2_with_presence(spark, sf_dir):
    lm = arrays.with_presence(fx.landmarks(spark, sf_dir), _SIZES)
    some = lambda p: F.size(F.filter(p, lambda v: (v[0] != 0) | (v[1] != 0)))
    filled = some("face") + some("left_hand") + some("right_hand") + some("pose")
    return lm.select("participant", "view", "frame_idx", "face_present", "face_presence", filled.cast("long").alias("filled"))


@query(
    """WITH h AS (SELECT participant, frame_idx, event_id, x, CASE WHEN k % 3 = 0 THEN 'Left' WHEN k % 3 = 1 THEN 'Right' ELSE 'Unknown' END AS side FROM fx_frames WHERE view = 'CAM_AV')
  SELECT participant, frame_idx // 4 AS frame, max_by(x, event_id) FILTER (side = 'Left') AS left_hand, max_by(x, event_id) FILTER (side <> 'Left') AS right_hand FROM h GROUP BY ALL""",
    "fx_frames",
)
def r3_assign_hands(spark, sf_dir):
    f = fx.frames(spark, sf_dir).where("view = 'CAM_AV'")
    side = F.when(F.col("k") % 3 == 0, "Left").when(F.col("k") % 3 == 1, "Right").otherwise("Unknown")
    d = f.select("participant", F.expr("frame_idx div 4").alias("frame"), F.col("event_id").alias("det_idx"), side.alias("side"), F.col("x").alias("points"))
    return arrays.assign_hands(d, ["participant", "frame"])


@query("SELECT participant, view, frame_idx, 2 * point + c AS at, CASE WHEN c = 0 THEN x ELSE y END AS v FROM fx_points, range(2) g(c) WHERE present AND part = 'left_hand'", "fx_points")
def r4_flatten_points(spark, sf_dir):
    lm = fx.landmarks(spark, sf_dir).select("participant", "view", "frame_idx", F.posexplode(arrays.flatten_points(F.col("left_hand"))).alias("at", "v"))
    return lm.withColumn("at", F.col("at").cast("long"))


@query("SELECT participant, view, frame_idx, part, point, x, y FROM fx_points WHERE present", "fx_points")
def r5_landmarks_long(spark, sf_dir):
    return _long(fx.landmarks(spark, sf_dir))


@query("SELECT participant, view, frame_idx, part, point, x, y FROM fx_points WHERE present", "fx_points")
def r5_landmarks_wide(spark, sf_dir):
    keys = ["participant", "view", "frame_idx"]
    return _long(arrays.landmarks_wide(arrays.landmarks_long(fx.landmarks(spark, sf_dir), keys, PARTS), keys, PARTS))


@query("SELECT participant, view, frame_idx, point AS mesh, x * 960 AS px, y * 540 AS py FROM fx_points WHERE present AND part = 'face' AND point IN (1, 6, 10)", "fx_points")
def r6_head_reference_points(spark, sf_dir):
    at = arrays.head_reference_points(F.col("face"), 960, 540, [1, 6, 10])
    lm = fx.landmarks(spark, sf_dir).where("face is not null").select("participant", "view", "frame_idx", F.inline(at))
    return lm.select("participant", "view", "frame_idx", F.col("mesh").cast("long").alias("mesh"), F.col("pixel")[0].alias("px"), F.col("pixel")[1].alias("py"))


@query("SELECT participant, view, frame_idx, part, point, x, y FROM fx_points WHERE present", "fx_points")
def r7_frame_record(spark, sf_dir):
    lm = fx.landmarks(spark, sf_dir)
    text = arrays.frame_record(lm, ["participant", "view", "frame_idx", *PARTS]).select("record")
    schema = lm.select("participant", "view", "frame_idx", *PARTS).schema
    return _long(text.select(arrays.read_record(F.col("record"), schema).alias("r")).select("r.*"))


@query(
    """SELECT participant, f AS a11, cx AS a13, f * c + 0.0::DOUBLE * 0.0::DOUBLE + cx * (-s) AS b11, f * s + 0.0::DOUBLE * 0.0::DOUBLE + cx * c AS b13, f * tx + 0.0::DOUBLE * 0.0::DOUBLE + cx * 0.0::DOUBLE AS b14 FROM fx_calibration""",
    "fx_calibration",
)
def g1_projection_matrices(spark, sf_dir):
    c = stereo.projection_matrices(fx.calibration(spark, sf_dir))
    return c.select("participant", F.expr("P1[0]").alias("a11"), F.expr("P1[2]").alias("a13"), F.expr("P2[0]").alias("b11"), F.expr("P2[2]").alias("b13"), F.expr("P2[3]").alias("b14"))


@query()
def g2_triangulate(spark, sf_dir):
    lm, c = fx.stereo_landmarks(spark, sf_dir), fx.calibration(spark, sf_dir)
    first, *others = (plans.reconstructed(lm, c, None, *pair) for pair in fx.STEREO_PAIRS)
    return functools.reduce(DataFrame.unionByName, others, first)


@query("SELECT participant, pair, task, subtask, start_s, frame_idx, point, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM fx_known", "fx_calibration", "fx_known")
def g2_triangulate_known(spark, sf_dir):
    """Points whose images are made with the projection matrices come out of them again; rounded, as the images are doubles."""
    lm, c = fx.known_points(spark, sf_dir), fx.calibration(spark, sf_dir)
    first, *others = (plans.reconstructed(lm, c, ["face"], *pair) for pair in fx.STEREO_PAIRS)
    rows = functools.reduce(DataFrame.unionByName, others, first).select("participant", "pair", "task", "subtask", "start_s", "frame_idx", F.posexplode("face").alias("point", "p"))
    return rows.select("participant", "pair", "task", "subtask", "start_s", "frame_idx", "point", *((F.round(f"p.{a}", 6) + 0.0).alias(a) for a in "xyz"))


def _focal():
    return F.col("left_mtx")[0], F.col("left_mtx")[2], F.col("left_mtx")[5]


def _with_depth(spark, sf_dir):
    j = _stereo(spark, sf_dir, ["pose"]).withColumn("d", stereo.disparity(F.col("left_pose"), F.col("right_pose")))
    return j.withColumn("z", stereo.depth(F.col("d"), _focal()[0], F.abs(F.col("T")[0])))


@query(f"SELECT participant, pair, subtask, start_s, frame_idx, point, lx - rx AS disparity FROM ({_STEREO}) WHERE part = 'pose'", "fx_stereo", "fx_calibration")
def g3_disparity(spark, sf_dir):
    return _with_depth(spark, sf_dir).select(*_FRAME, F.posexplode("d").alias("point", "disparity"))


_Z = "f * abs(tx) / CASE WHEN lx - rx = 0 THEN 1e-5::DOUBLE ELSE lx - rx END"


@query(f"SELECT participant, pair, subtask, start_s, frame_idx, point, {_Z} AS depth FROM ({_STEREO}) WHERE part = 'pose'", "fx_stereo", "fx_calibration")
def g4_depth(spark, sf_dir):
    return _with_depth(spark, sf_dir).select(*_FRAME, F.posexplode("z").alias("point", "depth"))


_XYZ = f"SELECT participant, pair, subtask, start_s, frame_idx, point, (lx - cx) * ({_Z}) / f AS px, (ly - cy) * ({_Z}) / f AS py, {_Z} AS pz, c, s, tx FROM ({_STEREO}) WHERE part = 'pose'"


def _xyz(spark, sf_dir):
    return _with_depth(spark, sf_dir).withColumn("xyz", stereo.back_project(F.col("left_pose"), F.col("z"), *_focal()))


@query(f"SELECT participant, pair, subtask, start_s, frame_idx, point, px AS x, py AS y, pz AS z FROM ({_XYZ})", "fx_stereo", "fx_calibration")
def g5_back_project(spark, sf_dir):
    return _xyz(spark, sf_dir).select(*_FRAME, F.posexplode("xyz").alias("point", "p")).select(*_FRAME, "point", "p.*")


@query(
    f"""SELECT participant, pair, subtask, start_s, frame_idx, point, c * px + 0.0::DOUBLE * py + s * pz + tx AS x, 0.0::DOUBLE * px + 1.0::DOUBLE * py + 0.0::DOUBLE * pz + 0.0::DOUBLE AS y, (-s) * px + 0.0::DOUBLE * py + c * pz + 0.0::DOUBLE AS z FROM ({_XYZ})""",
    "fx_stereo",
    "fx_calibration",
)
def g6_to_world(spark, sf_dir):
    w = _xyz(spark, sf_dir).withColumn("w", stereo.to_world(F.col("xyz"), F.col("R"), F.col("T")))
    return w.select(*_FRAME, F.posexplode("w").alias("point", "p")).select(*_FRAME, "point", "p.*")


@query("SELECT participant, round(sqrt(tx * tx), 9) AS baseline FROM fx_calibration", "fx_calibration")
def g7_baseline(spark, sf_dir):
    return fx.calibration(spark, sf_dir).select("participant", F.round(stereo.baseline(F.col("T")), 9).alias("baseline"))


@query(
    """WITH p AS (SELECT participant, view, frame_idx, max(x) FILTER (point = 0) AS ax, max(y) FILTER (point = 0) AS ay, max(x) FILTER (point = 1) AS bx, max(y) FILTER (point = 1) AS by_, max(x) FILTER (point = 2) AS fx, max(y) FILTER (point = 2) AS fy FROM fx_points WHERE present AND part = 'face' GROUP BY ALL),
  q AS (SELECT *, sqrt((ax - bx) * (ax - bx) + (ay - by_) * (ay - by_)) AS d FROM p), e AS (SELECT *, ax - (fx - d / 2) AS ux, ay - fy AS uy, bx - (fx + d / 2) AS vx, by_ - fy AS vy FROM q),
  m AS (SELECT *, (ux / sqrt(ux * ux + uy * uy) + vx / sqrt(vx * vx + vy * vy)) / 2 AS mx, (uy / sqrt(ux * ux + uy * uy) + vy / sqrt(vx * vx + vy * vy)) / 2 AS my FROM e)
  SELECT participant, view, frame_idx, round(mx * cos(0.5::DOUBLE), 8) AS gx, round(my, 8) AS gy, round(-(mx * sin(0.5::DOUBLE)), 8) AS gz FROM m""",
    "fx_points",
)
def g8_gaze_vector(spark, sf_dir):
    point = lambda i: [F.col("face")[i][0], F.col("face")[i][1], F.lit(0.0)]
    gaze = stereo.gaze_vector(point(0), point(1), point(2), [F.lit(0.0), F.lit(0.5), F.lit(0.0)])
    lm = fx.landmarks(spark, sf_dir).where("face is not null").select("participant", "view", "frame_idx", gaze.alias("g"))
    return lm.select("participant", "view", "frame_idx", *(F.round(f"g.{c}", 8).alias(f"g{c}") for c in "xyz"))


# --- streams


def _stream_of(spark: SparkSession, rows: DataFrame, last: DataFrame | None = None) -> tuple[DataFrame, int]:
    """A file stream over rows written to the shared folder, in four batches or fewer, with those of ``last`` in the latest file; and the number of rows."""
    path = sources.shared_folder(spark)
    rows.write.parquet(path)
    held = spark.read.schema(rows.schema).parquet(path)
    n, files = held.count(), len(held.inputFiles())
    if last is not None:
        time.sleep(1.1)  # files are read in the order of their times, which are whole seconds in some stores
        last.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(4, -(-files // 4))).parquet(path), n


@query("SELECT participant, view, count(*) AS n, sum(bytes)::BIGINT AS bytes FROM fx_segments GROUP BY ALL", "fx_segments")
def t1_incremental_features(spark, sf_dir):
    s = fx.segments(spark, sf_dir).select("participant", "view", "bytes")
    path, sink, state = (sources.shared_folder(spark) for _ in range(3))
    s.write.parquet(path)
    for _ in range(2):  # the second run finds nothing to do
        streaming.incremental_features(spark, path, s.schema, lambda b: b, sink, state).awaitTermination()
    return spark.read.parquet(sink).groupBy("participant", "view").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


_LIVE = f"SELECT epoch_ms(time_bucket(INTERVAL '1 minute', ts)) AS start_ms, {_LOOK} AS label, count(*) AS frames FROM fx_angles GROUP BY ALL"


def _start(df: DataFrame) -> DataFrame:
    return df.select(F.unix_millis("start").alias("start_ms"), "label", "frames")


def _utc(ts: str):
    """A timestamp without zone as the instant that it names in UTC, whatever the session's zone."""
    return F.to_timestamp_ltz(F.concat(F.col(ts).cast("string"), F.lit("+00:00")))


@query(_LIVE, "fx_angles")
def t2_live_look_direction(spark, sf_dir):
    a = fx.angles(spark, sf_dir).withColumn("ts", _utc("ts"))
    return _start(streaming.live_look_direction(a, window="1 minute"))


@query(_LIVE, "fx_angles")
def t2_live_look_direction_stream(spark, sf_dir):
    sink, state = sources.shared_folder(spark), sources.shared_folder(spark)
    # files come in no order of time here, so the watermark waits for 40 days; windows that it closes are appended once, the last ones by a row that comes 80 days later
    end = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts")).select(F.lit(-1).cast("long").alias("frame_id"), (_utc("max(ts)") + F.expr("interval 80 days")).alias("ts"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    angles, n = _stream_of(spark, fx.angles(spark, sf_dir).withColumn("ts", _utc("ts")), end)
    out = streaming.live_look_direction(angles, "40 days", "1 minute")
    with streaming.state_parts(spark, n):
        job = out.writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True)
        job.format("parquet").option("path", sink).start().awaitTermination()
    return _start(spark.read.schema("start timestamp, label string, frames long").parquet(sink))


@query("SELECT epoch_ms(time_bucket(INTERVAL '1 minute', ts)) AS start_ms, count(*) AS frames, count(*) / 60.0::DOUBLE AS fps FROM fx_angles GROUP BY ALL", "fx_angles")
def t2_live_rate(spark, sf_dir):
    rate = streaming.live_rate(fx.angles(spark, sf_dir).withColumn("ts", _utc("ts")), seconds=60)
    return rate.select(F.unix_millis("start").alias("start_ms"), "frames", "fps")


_PAIRED = "SELECT l.participant, l.frame_idx AS l_idx, r.frame_idx AS r_idx FROM fx_frames l JOIN fx_frames r ON l.participant = r.participant AND r.ts BETWEEN l.ts - INTERVAL '1 hour' AND l.ts + INTERVAL '1 hour' WHERE l.view = 'CAM_LL' AND r.view = 'CAM_LR'"


def _live(frames: DataFrame) -> DataFrame:
    """The fixture's events are of 30 days and its files in no order of time, so the watermark of this query waits for them all."""
    sides = (frames.where(F.col("view") == v).select("participant", "frame_idx", "ts") for v in ("CAM_LL", "CAM_LR"))
    return streaming.stream_sync(*sides, ["participant"], "1 hour", "40 days").select("participant", "l_idx", "r_idx")


def _two_views(spark, sf_dir) -> DataFrame:
    return fx.frames(spark, sf_dir).where("view in ('CAM_LL', 'CAM_LR')").select("participant", "view", "frame_idx", _utc("ts").alias("ts"))


@query(_PAIRED, "fx_frames")
def t3_stream_sync(spark, sf_dir):
    return _live(_two_views(spark, sf_dir))


@query(_PAIRED, "fx_frames")
def t3_stream_sync_stream(spark, sf_dir):
    sink, state = sources.shared_folder(spark), sources.shared_folder(spark)
    frames, n = _stream_of(spark, _two_views(spark, sf_dir))
    with streaming.state_parts(spark, n):
        job = _live(frames).writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        job.format("parquet").option("path", sink).start().awaitTermination()
    return spark.read.schema("participant string, l_idx long, r_idx long").parquet(sink)


def _feed(spark: SparkSession, rows: DataFrame, at: str, slices: int, last: DataFrame) -> str:
    """A folder of files for a stream, written in ``slices`` groups one after the other in order of ``at``, and ``last`` after them."""
    whole, path = sources.shared_folder(spark), sources.shared_folder(spark)
    rows.write.parquet(whole)
    held = spark.read.schema(rows.schema).parquet(whole)
    lo, hi = held.agg(F.min(at), F.max(at)).first()
    for k in range(slices if lo is not None else 0):
        number = F.least(F.floor((F.col(at) - lo) * slices / max(hi - lo, 1)), F.lit(slices - 1))
        held.where(number == k).write.mode("append").parquet(path)
        time.sleep(1.1)  # as in _stream_of
    last.coalesce(1).write.mode("append").parquet(path)
    return path


@query(_MUTUAL, "fx_frames")
def t3_nearest_stream(spark, sf_dir):
    """Frames of two views arrive in four parts, each of a quarter of the time; a part's files come in no order of time, so the watermark waits for as long."""
    f = fx.frames(spark, sf_dir).where("view in ('CAM_LL', 'CAM_LR')").select("participant", "view", "frame_idx", "t_ms")
    lo, hi, n = f.agg(F.coalesce(F.min("t_ms"), F.lit(0)), F.coalesce(F.max("t_ms"), F.lit(0)), F.count("*")).first()
    wait = (hi - lo) // 4 + 1000
    end = spark.createDataFrame([("last", v, 0, hi + 4 * (wait + _TOLERANCE)) for v in ("CAM_LL", "CAM_LR")], f.schema)  # closes what is open
    path = _feed(spark, f, "t_ms", 4, end)
    view = lambda v: spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 16).parquet(path).where(F.col("view") == v)
    pairs = nearest.stream_sync_nearest(view("CAM_LL"), view("CAM_LR"), ["participant"], _TOLERANCE, f"{wait} milliseconds").where("participant <> 'last'")
    sink, state = sources.shared_folder(spark), sources.shared_folder(spark)
    with nearest.state_store(spark), streaming.state_parts(spark, n):
        job = pairs.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        job.format("parquet").option("path", sink).start().awaitTermination()
    return spark.read.schema(pairs.schema).parquet(sink)


# --- workloads


@query(
    f"{_GROUPS} SELECT subtask, count(*) FILTER (views > 1 AND lo = hi) AS equal, count(*) FILTER (views > 1 AND lo <> hi) AS unequal, count(*) FILTER (views = 1) AS single FROM g GROUP BY subtask",
    "fx_segments",
)
def workload_consistency_statistics(spark, sf_dir):
    return plans.consistency_statistics(fx.segments(spark, sf_dir))


@query(
    f"""WITH both_ AS (SELECT * FROM fx_frames WHERE view IN ('CAM_LL', 'CAM_LR')), n AS (SELECT participant, view, max(frame_idx) + 1 AS frames FROM both_ GROUP BY ALL), m AS (SELECT *, min(frames) OVER (PARTITION BY participant) AS keep FROM n),
  t AS (SELECT b.* FROM both_ b JOIN m USING (participant, view) WHERE frame_idx < keep), near AS ({_NEAR.replace("fx_frames", "t")}),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY participant, l_idx ORDER BY dt, r_t, r_idx) AS a, row_number() OVER (PARTITION BY participant, r_idx ORDER BY dt, l_t, l_idx) AS b FROM near)
  SELECT participant, l_idx, r_idx, l_t, r_t, dt FROM ranked WHERE a = 1 AND b = 1""",
    "fx_frames",
)
def workload_synchronised(spark, sf_dir):
    return plans.synchronised(fx.frames(spark, sf_dir), tolerance_ms=_TOLERANCE)


@query(
    """WITH vids AS (SELECT participant, video FROM fx_video_frames GROUP BY ALL HAVING count(DISTINCT view) = 2), kept AS (SELECT f.*, row_number() OVER (PARTITION BY participant, view, video ORDER BY frame_idx) - 1 AS i FROM fx_video_frames f JOIN vids USING (participant, video)
  WHERE frame_idx % (fps / 30.0::DOUBLE) < 1), n AS (SELECT participant, view, video, max(i) + 1 AS frames FROM kept GROUP BY ALL), m AS (SELECT *, min(frames) OVER (PARTITION BY participant, video) AS keep FROM n), t AS (SELECT k.* FROM kept k JOIN m USING (participant, view, video) WHERE i < keep),
  near AS (SELECT l.participant, l.video, l.i AS l_idx, r.i AS r_idx, l.t_ms AS l_t, r.t_ms AS r_t, abs(l.t_ms - r.t_ms) AS dt FROM t l JOIN t r ON l.participant = r.participant AND l.video = r.video AND abs(l.t_ms - r.t_ms) <= 34 WHERE l.view = 'CAM_LL' AND r.view = 'CAM_LR'),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY participant, video, l_idx ORDER BY dt, r_t, r_idx) AS a, row_number() OVER (PARTITION BY participant, video, r_idx ORDER BY dt, l_t, l_idx) AS b FROM near)
  SELECT participant, video, l_idx, r_idx, l_t, r_t, dt FROM ranked WHERE a = 1 AND b = 1""",
    "fx_frames",
    "fx_video_frames",
)
def workload_paired_synchronised(spark, sf_dir):
    """Videos paired by name, brought to the pair's lower rate, cut to the shorter length and paired frame by frame, a frame's length apart at most."""
    f = fx.video_frames(spark, sf_dir)
    videos = fx.video_list(f)
    return plans.synchronised(f, tolerance_ms=plans.frame_ms(videos), videos=videos, keys=("participant", "video"))


@query(
    """WITH v AS (SELECT participant, video, min(fps) AS fps FROM fx_rated GROUP BY ALL HAVING count(DISTINCT view) = 2),
  kept AS (SELECT f.*, v.fps AS least, row_number() OVER (PARTITION BY participant, view, video ORDER BY frame_idx) - 1 AS i FROM fx_rated f JOIN v USING (participant, video) WHERE frame_idx % (f.fps / v.fps) < 1),
  m AS (SELECT participant, video, min(frames) AS keep FROM (SELECT participant, view, video, max(i) + 1 AS frames FROM kept GROUP BY ALL) GROUP BY ALL), t AS (SELECT k.* FROM kept k JOIN m USING (participant, video) WHERE i < keep),
  near AS (SELECT l.participant, l.video, l.i AS l_idx, r.i AS r_idx, l.t_ms AS l_t, r.t_ms AS r_t, abs(l.t_ms - r.t_ms) AS dt FROM t l JOIN t r ON l.participant = r.participant AND l.video = r.video
    AND abs(l.t_ms - r.t_ms) <= 1000.0::DOUBLE / l.least WHERE l.view = 'CAM_LL' AND r.view = 'CAM_LR'),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY participant, video, l_idx ORDER BY dt, r_t, r_idx) AS a, row_number() OVER (PARTITION BY participant, video, r_idx ORDER BY dt, l_t, l_idx) AS b FROM near)
  SELECT participant, video, l_idx, r_idx, l_t, r_t, dt FROM ranked WHERE a = 1 AND b = 1""",
    "fx_frames",
    "fx_video_frames",
    "fx_rated",
)
def workload_rated_synchronised(spark, sf_dir):
    """As before, of videos with 30, 50 and 60 frames a second: frames of a pair are apart by one of its own frames at most."""
    f = fx.rated_frames(spark, sf_dir)
    return plans.synchronised(f, videos=fx.rated_list(f), keys=("participant", "video"))


_HAVE = """have AS (SELECT *, 99000 + CAST(floor(start_s) AS BIGINT) * 500 AS bytes, 100 + CAST(turn AS BIGINT) % 3 AS frame_count FROM fx_clips WHERE CAST(turn AS BIGINT) % 4 <> 0)"""


def _segmented(spark, sf_dir, what: str) -> DataFrame:
    valid = fx.segments(spark, sf_dir).where(_VALID).select("subtask", "start_s", "end_s")
    return plans.segmented_statistics(fx.annotations(spark, sf_dir), fx.clip_files(spark, sf_dir), valid)[what]


@query("SELECT 'segments/' || abbreviation || '/' || name AS path FROM fx_clips WHERE CAST(turn AS BIGINT) % 4 = 0", "fx_tricks", "fx_clips")
def workload_segments_missing(spark, sf_dir):
    """Label exports spread over views: the clips that are still to be cut."""
    return _segmented(spark, sf_dir, "missing").select("path")


@query(f"WITH {_HAVE} SELECT v.view, count(name) AS corrupt FROM (VALUES ('CAM_AV'), ('CAM_LL'), ('CAM_LR'), ('CAM_UL'), ('CAM_UR')) v(view) LEFT JOIN have ON have.view = v.view AND bytes < 100000 GROUP BY v.view", "fx_tricks", "fx_clips")
def workload_segments_corrupt(spark, sf_dir):
    return _segmented(spark, sf_dir, "corrupt")


@query(
    f"""WITH {_HAVE}, g AS (SELECT participant, task, abbreviation, start_s, end_s, count(*) AS views, min(frame_count) AS lo, max(frame_count) AS hi FROM have GROUP BY ALL)
  SELECT abbreviation AS subtask, count(*) FILTER (views > 1 AND lo = hi) AS equal, count(*) FILTER (views > 1 AND lo <> hi) AS unequal, count(*) FILTER (views = 1) AS single FROM g GROUP BY ALL""",
    "fx_tricks",
    "fx_clips",
)
def workload_segments_consistency(spark, sf_dir):
    return _segmented(spark, sf_dir, "consistency")


@query(
    f"""WITH {_HAVE}, b AS (SELECT 'train' AS split, abbreviation AS subtask, start_s, end_s FROM have UNION ALL SELECT 'valid', subtask, start_s, end_s FROM fx_segments WHERE {_VALID} AND subtask IN (SELECT abbreviation FROM have))
  SELECT split, subtask, count(*) AS n, min(end_s - start_s) AS min_s, round(sum(end_s - start_s) / count(*), 6) AS mean_s, max(end_s - start_s) AS max_s FROM b GROUP BY ALL""",
    "fx_tricks",
    "fx_clips",
    "fx_segments",
)
def workload_segments_durations(spark, sf_dir):
    return _segmented(spark, sf_dir, "summary")
