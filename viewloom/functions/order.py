"""Places and running sums in one order of a whole table, without one task that holds it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.sources import shared_folder

_LOW = (1 << 33) - 1  # monotonically_increasing_id has a row's place in its partition in these bits


def _ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows cut into ranges of ``order``, with the range's number and the place in it; written, so that all readers see the same ranges."""
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession)
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW))})
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _shifted(cut: DataFrame, amount: str, inside, name: str) -> DataFrame:
    """``inside`` plus the amounts of all ranges before; the driver sees one number a range."""
    totals = cut.groupBy("_part").agg(F.expr(amount).alias("n")).orderBy("_part").collect()
    before = list(accumulate((r["n"] or 0 for r in totals), initial=0))[:-1]
    shifts = cut.sparkSession.createDataFrame([(r["_part"], b) for r, b in zip(totals, before, strict=True)], "_part int, _shift long")
    return cut.join(F.broadcast(shifts), "_part").withColumn(name, inside + F.col("_shift")).drop("_part", "_pos", "_shift")


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with their place from 0 in ``order``; rows equal in it stand in any order."""
    return _shifted(_ranges(rows, order), "count(*)", F.col("_pos"), name)


def running_sum(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Rows with the sum of the whole-number ``value`` over all rows up to their own in ``order``."""
    up_to = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _shifted(_ranges(rows, order), f"sum({value})", F.coalesce(F.sum(value).over(up_to), F.lit(0)), name)
