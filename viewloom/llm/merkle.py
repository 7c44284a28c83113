"""Merkle manifest of a table: a digest a row, trees a group, a tree over the groups, and for every row the proof that it is in the root.

Native: columns and joins alone.  A node is a row (group, index, digest).  Every level is joined with itself on computed sibling indices: the
index XOR 1 where two nodes have a parent, else the run's other slots by their offsets.  Rows in slot 0 then give the parents.  Proofs
go down again: a node's siblings stand before its parent's proof, so each level is read once, not once a leaf.

Where the work is.  Texts are read once, for the digests.  Leaves are numbered by a range partitioning and the counts of its parts, so no group
is put in order by one task.  Leaves are then bucketed by blocks of ``fanout ** BLOCK_LEVELS`` neighbours: siblings, parents and children of
the first ``BLOCK_LEVELS`` levels are in one bucket, and their joins need no exchange.  The levels above hold a 256th of the nodes or less and
are plain joins.  The driver learns the number of groups, the largest group's size and the root.

Defined results: rows are leaves each on their own; rows equal in group and id stand in order of their digests; null groups and ids come first, null fields are digested as
``-``; long and empty texts are digested whole; a group of one row has its leaf as its subroot, and one group's subroot is the root; an
empty table gives no rows; further columns are ignored, whatever their names.  A tampered count is added to as a decimal, so the largest one doesn't overflow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.llm.text import forget, kept, shared_folder

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 8
_LOW = (1 << 33) - 1  # monotonically_increasing_id holds a row's place in its partition in these bits


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as it is digested: bytes, colon, value; ``-`` for null."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(*map(field, values))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """Rows with ``_idx``, their place from 0 in their group, and ``_n``, the group's size; and the tables that they are read from.

    The group's columns and ``order`` part the rows into ranges; of each range only counts by group are put in order.
    """
    keys = [*group, *order, "_m"]
    ranged = rows.withColumn("_m", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_m")
    placed = kept(ranged.withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW))}))
    runs = placed.groupBy("_part", *group).agg(F.min("_pos").alias("_first"), F.count("*").alias("_here"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = kept(
        runs.withColumns({"_n": F.sum("_here").over(whole), "_shift": F.coalesce(F.sum("_here").over(before), F.lit(0)) - F.col("_first")}).select(
            F.col("_part").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in group], "_n", "_shift"
        )
    )
    same = F.col("_part") == F.col("_p")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    out = placed.join(runs, same).withColumn("_idx", F.col("_pos") + F.col("_shift"))
    return out.select(*rows.columns, "_idx", "_n"), [placed, runs]


class Buckets:
    """Tables in the shared folder, bucketed by (g, block), so that joins on these and further keys need no exchange.

    While it is open, the session lets joins use a partitioning by some of their keys; closing it puts the setting back and removes the tables.
    """

    SETTING = "spark.sql.requireAllClusterKeysForCoPartition"

    def __init__(self, spark: SparkSession):
        self.spark, self.names, self.n = spark, [], int(spark.conf.get("spark.sql.shuffle.partitions"))

    def __enter__(self) -> Buckets:
        self.held = self.spark.conf.get(self.SETTING)
        self.spark.conf.set(self.SETTING, "false")
        return self

    def write(self, rows: DataFrame, spread: bool = False) -> DataFrame:
        name = f"viewloom_{uuid.uuid4().hex}"
        rows = rows.repartition(self.n, "g", "block") if spread else rows
        folder = shared_folder(self.spark)
        rows.write.format("parquet").bucketBy(self.n, "g", "block").option("path", folder).saveAsTable(name)
        out = self.spark.table(name)
        out._kept_in = folder
        self.names.append((name, out))
        return out

    def __exit__(self, *_: object) -> None:
        self.spark.conf.set(self.SETTING, self.held)
        for name, rows in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            forget(self.spark, rows)


def siblings(nodes: DataFrame, fanout: int, keys: list[str]) -> DataFrame:
    """A level with ``before`` and ``after``: the digests of each node's siblings, left to right, by equijoins of the level with itself."""
    slot, out = F.col("idx") % fanout, nodes
    before, after = F.lit(""), F.lit("")
    for s in range(1, fanout):
        at = F.col("idx").bitwiseXOR(F.lit(1).cast("long")) if fanout == 2 else F.col("idx") - slot + (slot + s) % fanout
        shifted = nodes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("idx").alias("_idx"), F.col("digest").alias(f"_d{s}"))
        same = at == F.col("_idx")
        for k in keys:
            same &= F.col(k) == F.col(f"_{k}")
        out = out.join(shifted, same, "left").drop("_idx", *[f"_{k}" for k in keys])
        found = F.coalesce(F.col(f"_d{s}"), F.lit(""))
        after = F.concat(after, F.when(slot + s < fanout, found).otherwise(""))
        before = F.concat(before, F.when(slot + s >= fanout, found).otherwise(""))
    return out.withColumns({"before": before, "after": after}).drop(*[f"_d{s}" for s in range(1, fanout)])


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """The next level, from the nodes in slot 0; the only node of a group goes up as it is."""
    up = F.when(F.col("n") > 1, digest(F.col("digest"), F.col("after"))).otherwise(F.col("digest"))
    more = [c for c in ("block",) if c in level.columns]
    return level.where(F.col("idx") % fanout == 0).select("g", *more, F.expr(f"idx div {fanout}").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), up.alias("digest"))


def no_proof() -> Column:
    return F.expr("cast(array() as array<struct<before: string, after: string>>)")


def step() -> Column:
    return F.array(F.struct("before", "after"))


def height(n: int, fanout: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def plain(nodes: DataFrame, n: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels above ``nodes`` (g, idx, n, digest) of groups of ``n`` nodes at most, and each group's last node."""
    levels, last, now = [], nodes.where("n = 1"), nodes.where("n > 1")
    for _ in range(height(n, fanout)):
        levels.append(kept(siblings(now, fanout, ["g"])))
        up = parents(levels[-1], fanout)
        last, now = last.unionByName(up.where("n = 1")), up.where("n > 1")
    return levels, last.select("g", "digest")


def proofs(nodes: DataFrame, levels: list[DataFrame], fanout: int) -> DataFrame:
    """``nodes`` with the proofs in their groups, from the last level down."""
    down = None
    for level in reversed(levels):
        if down is None:
            down = level.select("g", "idx", step().alias("proof"))
            continue
        above = down.select(F.col("g").alias("_g"), F.col("idx").alias("_idx"), F.col("proof").alias("_proof"))
        joined = level.join(above, (F.col("g") == F.col("_g")) & (F.expr(f"idx div {fanout}") == F.col("_idx")), "left")
        down = joined.select("g", "idx", F.concat(step(), F.coalesce("_proof", no_proof())).alias("proof"))
    if down is None:
        return nodes.withColumn("proof", no_proof())
    found = nodes.join(down.withColumnsRenamed({"g": "_g", "idx": "_idx", "proof": "_proof"}), (F.col("g") == F.col("_g")) & (F.col("idx") == F.col("_idx")), "left")
    return found.withColumn("proof", F.coalesce("_proof", no_proof())).drop("_g", "_idx", "_proof")


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, start, lambda at, p: digest(p["before"], at, p["after"]))


def flat(proof: Column) -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["after"])), ""))


def manifest(leaves: DataFrame, group: str, order: str, claimed: str | None = None, fanout: int = 2, block_levels: int = BLOCK_LEVELS, with_proofs: bool = False) -> DataFrame:
    """Rows with a ``leaf`` (hex digest) in their trees: one for each value of ``group``, in which leaves ascend by ``order``, and one over the trees' roots.

    Gives ``order``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` (from the leaf in ``claimed`` where that isn't null) and ``verified``; ``with_proofs`` also
    ``proof``, for each level up to the root the digests before and after the path's node.  The result is a table in the shared folder; those between are removed.
    """
    spark = leaves.sparkSession
    shown = F.col(claimed) if claimed else F.lit(None).cast("string")
    own = kept(leaves.select(F.col(group).alias("_group"), F.col(order).alias("_order"), "leaf", shown.alias("_shown")))
    numbers, used = numbered(own, ["_group"], ["_order", "leaf"])
    ranks, more = numbered(used[1].select(F.col("_g__group").alias("_group")).distinct(), [], ["_group"])
    ranks = kept(ranks.select(F.col("_group").alias("_name"), F.col("_idx").alias("g")))
    groups, largest = ranks.count(), used[1].agg(F.max("_n")).first()[0] or 0
    block = F.expr(f"_idx div {fanout**block_levels}")
    placed = numbers.join(ranks, F.col("_group").eqNullSafe(F.col("_name")))
    with Buckets(spark) as buckets:
        nodes = buckets.write(placed.select("g", block.alias("block"), F.col("_idx").alias("idx"), F.col("_n").alias("n"), F.col("leaf").alias("digest"), "_order", "_shown"), spread=True)
        levels, n, first = [], largest, nodes
        for _ in range(min(block_levels, height(largest, fanout))):
            levels.append(buckets.write(siblings(nodes, fanout, ["g", "block"])))
            nodes, n = parents(levels[-1], fanout), -(-n // fanout)
        tops = kept(nodes.select("g", "block", "idx", "n", "digest"))
        upper, subroots = plain(tops.drop("block"), n, fanout)
        subroots = kept(subroots)
        trees = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(groups).cast("long").alias("n"), "digest")
        over, last = plain(trees, groups, fanout)
        root = last.select("digest").first()
        trees = kept(proofs(trees, over, fanout).select(F.col("idx").alias("_tree"), F.col("digest").alias("subroot"), F.col("proof").alias("_over")))
        down = proofs(tops, upper, fanout).join(trees, F.col("g") == F.col("_tree"))
        down = buckets.write(down.select("g", "block", "idx", "subroot", F.concat("proof", "_over").alias("proof")), spread=True)
        if not levels:  # no group has two rows
            down = first.join(down.select(F.col("g").alias("_g"), "subroot", "proof"), F.col("g") == F.col("_g"))
        for i in reversed(range(len(levels))):
            above = down.select(F.col("g").alias("_g"), F.col("block").alias("_block"), F.col("idx").alias("_idx"), F.col("proof").alias("_proof"), "subroot")
            up = (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_block")) & (F.expr(f"idx div {fanout}") == F.col("_idx"))
            proof = F.when(F.col("n") > 1, F.concat(step(), F.col("_proof"))).otherwise(F.col("_proof"))
            down = levels[i].join(above, up).select("g", "block", "idx", "subroot", proof.alias("proof"), *([] if i else ["digest", "_order", "_shown"]))
        rooted = F.lit(root[0] if root else None).cast("string")
        out = down.select(
            F.col("_order").alias(order),
            F.col("digest").alias("leaf"),
            "subroot",
            rooted.alias("root"),
            flat(F.col("proof")).alias("proof_sha256"),
            folded(F.coalesce("_shown", "digest"), F.col("proof")).alias("folded_root"),
            *(["proof"] if with_proofs else []),
        )
        out = kept(out.withColumn("verified", F.col("folded_root") == F.col("root")))
    forget(spark, own, *used, *more, ranks, tops, *upper, subroots, *over, trees)
    return out
