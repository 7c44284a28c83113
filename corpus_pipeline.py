"""Corpus preparation as five stages over ``documents``, each written as Parquet and read again by the next.

1. quality: documents with a word go whose chance to be good is below a half by the compression classifier.
2. line dedup: lines that match an earlier line go; a document that loses all of its words goes with them, one that keeps any keeps them, however few: of a near copy these are the lines
   that are its own.
3. near duplicates: of each group of linked documents the one with the smallest id stays, of equal ids the smallest text.
4. mixing: documents are taken as often as the target weights of their sources ask, as whole repeated rows; those not taken go.
5. packing: what is left becomes windows of token ids.

Defined results: rows with null or empty text pass the first three stages as they are (quality gives them the score of no difference) and end in mixing, whose sizes are words; rows with a null id are
documents of their own, grouped by their texts alone; repeated rows (same id and text) are copies of each other, one of which stays; null languages, sources and counts are kept; further columns
are dropped, whatever their names; an empty table gives no rows in any stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.llm import compression, jaccard, lines, mixing, packing
from viewloom.llm.queries import remainder, tokenizer_path
from viewloom.llm.text import kept, shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_HAS_WORD = "[^\\x20\\x09-\\x0D]"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject, and those without a word, which it can't judge; it learns from the labelled documents among those given."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = compression.train(docs, labels.where(remainder(4) != 2))
    return compression.score(docs, model, [*COLUMNS[:1], *COLUMNS[2:], F.col("text").alias("kept")]).where((F.col("score") >= 0.5) | ~F.coalesce("kept", F.lit("")).rlike(_HAS_WORD)).select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", "n_chars"
    )


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier one; those that lose their last word go."""
    found = lines.dedup(docs.select(COLUMNS)).withColumn("text", lines.kept_text())
    left = found.where((F.size("removed") == 0) | F.col("text").rlike(_HAS_WORD))
    n_chars = F.when(F.size("removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return left.withColumn("n_chars", n_chars).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, and all that are linked with none."""
    hashed = docs.select(*COLUMNS, F.xxhash64("text").alias("_hash"))
    found = kept(jaccard.join(hashed, keys=["_hash"]))
    stays = found.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct("doc_id", "_hash")).alias("f")).select("f.*")
    stays = stays.unionByName(found.where("n_shingles = 0").select("doc_id", "_hash").distinct())
    out = hashed.join(stays.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h")), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_semi")
    equal = found.where("n_shingles > 0").groupBy("doc_id", "_hash").count().where("count > 1")
    if equal.limit(1).count():  # equal rows are copies too
        order = Window.partitionBy("doc_id", "_hash").orderBy(*COLUMNS)
        blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(_HAS_WORD)
        out = out.withColumn("_r", F.row_number().over(order)).where((F.col("_r") == 1) | blank)
    return out.select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    hashed = docs.select(*COLUMNS, F.xxhash64("text").alias("_hash"))
    mixed = mixing.mix(hashed, keys=["_hash"]).where("taken > 0")
    # rows equal in id and text share what they take
    times = mixed.groupBy("doc_id", "_hash").agg(F.sum(F.expr("taken div size")).cast("int").alias("_times"), F.count("*").alias("_of"))
    times = kept(times.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "_times", "_of"))
    if times.where("_of > 1").limit(1).count():
        hashed = hashed.dropDuplicates(["doc_id", "_hash"])
    joined = hashed.join(times, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))
    return joined.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "_times"))).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of token ids, a row for each piece."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL: str | None = None  # trained models and tokenizers: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = kept(docs, shared_folder(spark))
    return docs
