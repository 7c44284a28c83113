"""The manifest against plain trees, and its plans."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from viewloom.llm import merkle
from viewloom.llm.queries import ORACLE_SQL, op13_merkle_manifest

from .helpers import AWKWARD, FIELDS


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def runs(nodes, fanout):
    return [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]


def tree(nodes, fanout):
    """The root and, for each leaf, the siblings before and after it at every level."""
    proofs = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for run, own in zip(runs(nodes, fanout), runs(members, fanout), strict=True):
            for k, leaves in enumerate(own):
                for i in leaves:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
        nodes = [sha(*r) for r in runs(nodes, fanout)]
        members = [sum(r, []) for r in runs(members, fanout)]
    return nodes[0], proofs


def plainly(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
        other = sha(*map(field, (*r[:3], r[3] + 1, r[4]))) if bad else None
        groups.setdefault(r[2], []).append((r[0], sha(*map(field, r)), other))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        own = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((own, *tree([x[1] for x in own], fanout)))
    root, over = tree([t[1] for t in trees], fanout) if trees else (None, [])
    out = []
    for (own, subroot, proofs), top in zip(trees, over, strict=True):
        for (i, leaf, other), proof in zip(own, proofs, strict=True):
            at = other or leaf
            for before, after in proof + top:
                at = sha(before, at, after)
            out.append((str(i), leaf, subroot, root, sha(*[b + a for b, a in proof + top]), at, at == root))
    return sorted(out)


def found(rows):
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in rows.collect())


def many(n, langs):
    return [(i * 3 % (n + 1), f"s{i % 3}", langs[i * i % len(langs)], i if i % 11 else None, f"text {i} é") for i in range(n)]


CASES = {
    "awkward": [(i, s, None if i == 4 else "en", len(t) if t is not None else None, t) for i, t, s in AWKWARD],
    "one row": [(1, None, None, None, None)],
    "two groups": [(1, "a", "de", 5, "x"), (2, "a", "en", 2**63 - 1, "y"), (21, "a", "en", 7, "")],
    "many": many(301, ["en", "de", None, "fr", "zz", "en", "Ünï"]),
    "repeated": [(5, "a", "en", 3, "same")] * 40 + [(5, "a", "en", 3, "other")] * 3 + [(None, None, "en", None, None)] * 9,
}


def written(spark, rows, tmp_path):
    df = spark.createDataFrame([(i, t, g, s, n) for i, s, g, n, t in rows], FIELDS)
    for c in ("idx", "n", "g", "block", "digest", "leaf", "proof", "_order", "before", "_part"):
        df = df.withColumn(c, F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("case", CASES)
def test_equals_plain_trees(spark, tmp_path, case):
    assert found(op13_merkle_manifest(spark, written(spark, CASES[case], tmp_path))) == plainly(CASES[case])


def test_empty_table(spark, tmp_path):
    assert op13_merkle_manifest(spark, written(spark, [], tmp_path)).collect() == []


@pytest.mark.parametrize(("fanout", "block_levels"), [(3, 2), (2, 1), (5, 8)])
def test_other_shapes(spark, fanout, block_levels):
    rows = many(150, ["en", "de", None, "fr", "en", "en"])
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaf = merkle.leaf([F.col(c) for c in merkle.FIELDS])
    more = merkle.leaf([F.col(c) if c != "n_chars" else F.col(c) + 1 for c in merkle.FIELDS])
    shown = F.when((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull(), more)
    leaves = df.select("doc_id", "lang", leaf.alias("leaf"), shown.alias("shown"))
    out = merkle.manifest(leaves, "lang", "doc_id", claimed="shown", fanout=fanout, block_levels=block_levels, with_proofs=True)
    assert found(out) == plainly(rows, fanout)
    r = out.where("verified").first()
    at = r["leaf"]
    for p in r["proof"]:
        at = sha(p["before"], at, p["after"])
    assert at == r["root"]


def test_long_texts_and_more_groups_than_rows_a_group(spark, tmp_path):
    rows = [(i, "s", f"lang {i % 37}", i, "é" * 1_500_000 if i == 5 else str(i)) for i in range(60)]
    assert found(op13_merkle_manifest(spark, written(spark, rows, tmp_path))) == plainly(rows)


def test_joins_in_blocks_need_no_exchange(spark):
    own = spark.range(4000).selectExpr("cast(0 as long) as g", "id div 256 as block", "id as idx", "cast(4000 as long) as n", "sha2(cast(id as string), 256) as digest")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with merkle.Buckets(spark) as buckets:
            level = merkle.siblings(buckets.write(own, spread=True), 2, ["g", "block"])
            plan = level._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            nodes = merkle.parents(buckets.write(level), 2)
            assert "Exchange" not in merkle.siblings(nodes, 2, ["g", "block"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_tables_between_are_removed(spark, tmp_path):
    op13_merkle_manifest(spark, written(spark, CASES["two groups"], tmp_path)).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("viewloom_")]


def test_matches_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = op13_merkle_manifest(spark, sf_dir)
    want = c.execute(ORACLE_SQL["op13_merkle_manifest"]).fetchdf()[got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(want.itertuples(index=False, name=None))
