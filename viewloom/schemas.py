"""Column types of the library's tables, and the domain's constants."""

from __future__ import annotations

from pyspark.sql import types as T

# Camera views, tasks, camera pairs, action codes and task families of the recordings.
VIEWS = ["CAM_AV", "CAM_LL", "CAM_LR", "CAM_UL", "CAM_UR"]
TASKS = ["BIAH_BS", "BIAH_BV", "STAIRWAY_AP", "STAIRWAY_MS", "TOWER_HO", "TOWER_MS", "BRIDGE_AS", "BRIDGE_BV", "BIAH_RB"]
PAIRS = [
    ("CAM_LL", "CAM_LR"),
    ("CAM_UL", "CAM_UR"),
    ("CAM_UR", "CAM_UL"),
    ("CAM_UL", "CAM_LL"),
    ("CAM_AV", "CAM_LL"),
    ("CAM_AV", "CAM_LR"),
    ("CAM_AV", "CAM_UL"),
    ("CAM_AV", "CAM_UR"),
]
SUBTASKS = [
    "CG", "CS", "FO", "HBNS", "HBPP", "HBPS", "HCP", "HCS", "HEC", "HGOT", "HHO", "HNS", "HPCS", "HPH", "HPP", "HPS", "HPT",
    "HSA", "RBNS", "RBPP", "RBPS", "RCG", "RCS", "REC", "RHO", "RNS", "RPCS", "RPH", "RPP", "RPS", "RPT", "RSA", "STP", "THP",
]
FAMILIES = ["BIAH", "BRIDGE", "STAIRWAY", "TOWER"]
VARIANTS = {"BIAH": ["BS", "RB", "BV"], "BRIDGE": ["AS", "BV"], "STAIRWAY": ["AP", "MS"], "TOWER": ["MS", "HO"]}
PARTS = ["face", "left_hand", "right_hand", "pose"]

POINTS = T.ArrayType(T.ArrayType(T.DoubleType()))
POINTS_3D = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in "xyz"]))
DOUBLES = T.ArrayType(T.DoubleType())


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
CATALOG = fields(path=_S, length=_L, modified=T.TimestampType())
VIDEO = fields(participant=_S, view=_S, video=_S, fps=_D, frame_count=_L)
SEGMENT = fields(participant=_S, view=_S, task=_S, subtask=_S, start_s=_D, end_s=_D)
ANNOTATION = fields(video_url=_S, tricks=T.ArrayType(fields(start=_D, end=_D, labels=T.ArrayType(_S))))
TASK_PLAN = T.MapType(_S, T.ArrayType(_S))
SEGMENT_KEYS = ["task", "subtask", "start_s", "end_s"]
LANDMARKS = T.StructType([*fields(participant=_S, view=_S, task=_S, subtask=_S, start_s=_D, end_s=_D, frame_idx=_L).fields, *(T.StructField(p, POINTS) for p in PARTS)])
CALIBRATION = fields(
    participant=_S, pair=_S, retval=_D, left_mtx=DOUBLES, right_mtx=DOUBLES, left_dist=DOUBLES, right_dist=DOUBLES, R=DOUBLES, T=DOUBLES,
    E=DOUBLES, F=DOUBLES, R1=DOUBLES, R2=DOUBLES, P1=DOUBLES, P2=DOUBLES, Q=DOUBLES, left_count=_L, right_count=_L,
)
POINTS_TABLE = T.StructType([*fields(participant=_S, pair=_S, task=_S, subtask=_S, start_s=_D, end_s=_D, frame_idx=_L).fields, *(T.StructField(p, POINTS_3D) for p in PARTS)])
FRAME_RECORD = fields(timestamp=_D, frame_index=_L, face_presence=_I, gaze_vector=DOUBLES, head=fields(x=_D, y=_D), facial=POINTS, left_hand=POINTS, right_hand=POINTS, body=POINTS)
OBSERVATION = fields(participant=_S, pair=_S, side=_S, frame_idx=_L, ids=T.ArrayType(_I), corners=POINTS)
EXTENSION_VIDEO = (".mp4", ".mkv", ".avi", ".mov")
