"""Task plans: variants, random orders, renames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.schemas import FAMILIES, VARIANTS


def expand_task_variants(plan: DataFrame, variants: dict[str, list[str]] | None = None) -> DataFrame:
    """(participant, position, task) with each family in its variants' place, positions from 1; families without variants stay."""
    known = variants or VARIANTS
    table = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    names = F.coalesce(F.transform(table[F.col("task")], lambda v: F.concat(F.col("task"), F.lit("_"), v)), F.array("task"))
    rows = plan.select("participant", "position", F.posexplode(names).alias("variant", "name"))
    order = Window.partitionBy("participant").orderBy("position", "variant")
    return rows.select("participant", F.row_number().over(order).cast("long").alias("position"), F.col("name").alias("task"))


def rename_plan(files: DataFrame, plan: DataFrame) -> DataFrame:
    """Each camera's GX files in order of their names get the planned tasks after the first; what is over on either side is left."""
    order = Window.partitionBy("participant", "view").orderBy("file")
    named = F.col("file").startswith("GX") & F.lower("file").endswith(".mp4")
    numbered = files.where(named).select("participant", "view", "file", (F.row_number().over(order) + 1).cast("long").alias("position"))
    return numbered.join(plan, ["participant", "position"]).select("participant", "view", "file", F.concat("task", F.lit(".mp4")).alias("new_name"))


def randomize_tasks(participants: DataFrame, existing: DataFrame, seed: int = 0, families: list[str] | None = None) -> DataFrame:
    """A seeded order of task families for participants without a plan, calibration first; the order is that of an md5 of seed, participant and family."""
    todo = participants.select("participant").distinct().join(existing.select("participant").distinct(), "participant", "left_anti")
    key = lambda f: F.md5(F.concat_ws(",", F.lit(str(seed)), F.col("participant"), f))
    hashed = F.array_sort(F.array(*(F.struct(key(F.lit(f)).alias("h"), F.lit(f).alias("task")) for f in families or FAMILIES)))
    tasks = F.concat(F.array(F.lit("CALIBRATION")), F.transform(hashed, lambda s: s["task"]))
    return todo.select("participant", F.posexplode(tasks).alias("position", "task")).withColumn("position", (F.col("position") + 1).cast("long"))
