"""Column functions over file names, paths and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Name = Column | str


def _c(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


_SEGMENT = r"^([^-/]+)-([^-/]+)-([^-/]+)-([^-/]+)-(\d+(?:\.\d+)?)_(\d+(?:\.\d+)?)\.(\w+)$"


def parse_segment_name(name: Name) -> Column:
    """participant-view-task-subtask-start_end.ext as a struct; null for a name of another form.  Folders before the name are dropped."""
    base = F.substring_index(_c(name), "/", -1)
    part = F.split(base, "-")
    times = F.split(F.element_at(part, 5), "_")
    end = F.regexp_extract(F.get(times, F.lit(1)), r"^(\d+(?:\.\d+)?)\.\w+$", 1)
    found = F.struct(
        *(F.get(part, F.lit(i)).alias(c) for i, c in enumerate(("participant", "view", "task", "subtask"))),
        F.get(times, F.lit(0)).try_cast("double").alias("start_s"),
        end.try_cast("double").alias("end_s"),
        F.concat_ws("_", F.get(times, F.lit(0)), end).alias("times"),
        F.substring_index(base, ".", -1).alias("ext"),
    )
    return F.when(base.rlike(_SEGMENT), found)


def canonical_path(path: Name, video: str = ".mp4") -> Column:
    """The components that start with ``p`` or ``CAM_`` or end with ``.mp4``, joined again."""
    keep = lambda x: x.startswith("p") | x.startswith("CAM_") | x.endswith(video)
    return F.array_join(F.filter(F.split(_c(path), "/"), keep), "/")


_TIMES = r"(\w+)-(\d+\.\d+)_(\d+\.\d+)\.h5"


def segment_times(name: Name) -> Column:
    """(subtask, start_s, end_s, duration) of a feature file's name; null where it has another form."""
    start = F.regexp_extract(_c(name), _TIMES, 2).try_cast("double")
    end = F.regexp_extract(_c(name), _TIMES, 3).try_cast("double")
    found = F.struct(F.regexp_extract(_c(name), _TIMES, 1).alias("subtask"), start.alias("start_s"), end.alias("end_s"), (end - start).alias("duration"))
    return F.when(_c(name).rlike(_TIMES), found)


def label_abbreviation(label: Name) -> Column:
    """What stands in the first parentheses; null without any."""
    return F.nullif(F.regexp_extract(_c(label), r"\((.*?)\)", 1), F.lit(""))


def segment_name(who: Name, view: Name, task: Name, abbreviation: Name, start: Name, end: Name, ext: str = "mp4") -> Column:
    times = F.concat(_c(start).cast("string"), F.lit("_"), _c(end).cast("string"), F.lit("." + ext))
    return F.concat_ws("-", _c(who), _c(view), _c(task), _c(abbreviation), times)


def select_files(
    files: DataFrame,
    views: list[str] | None = None,
    prefix: str | None = None,
    exts: tuple[str, ...] = (),
    participants: tuple[int, int] | None = None,
    no_calibration: bool = True,
    name: str = "file",
) -> DataFrame:
    """Files of the views, name prefix, extensions and participant numbers asked for, without ``calib`` files."""
    if views:
        files = files.where(F.col("view").isin(views))
    if prefix:
        files = files.where(F.col(name).startswith(prefix))
    if exts:
        ends = F.lit(False)
        for e in exts:
            ends |= F.lower(name).endswith(e)
        files = files.where(ends)
    if participants:
        files = files.where(F.regexp_extract("participant", r"p(\d+)", 1).try_cast("int").between(*participants))
    if no_calibration:
        files = files.where(~F.lower(name).startswith("calib"))
    return files
