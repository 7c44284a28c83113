"""Decontamination against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from viewloom.llm import leaks
from viewloom.llm.queries import ORACLE_SQL, op11_decontamination

from .helpers import AWKWARD, docs

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plainly(texts, items, width=10):
    held = {}
    for i, t in items:
        ws = words(t)
        n = min(width, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            held.setdefault(tuple(ws[k : k + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in texts:
        ws, hit, met = words(t), set(), set()
        for k in range(len(ws)):
            for n in range(1, width + 1):
                if k + n <= len(ws) and (w := held.get(tuple(ws[k : k + n]))):
                    hit |= set(range(k, k + n))
                    met |= w
        out.append((str(i), len(ws), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def found(rows):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows.collect())


LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
ITEMS = [(1, LONG), (2, "Short one"), (3, "théta"), (3, "théta"), (10, LONG.replace("mu nu xi", "mu nu XI")), (4, None), (5, " ?! "), (None, "no id here"), (6, "a a a a a a a a a a a a")]
TEXTS = [
    *[(i, t) for i, t, _ in AWKWARD],
    (20, f"x {LONG}. y {LONG.upper()} short-ONE"),
    (21, "a " * 25 + "b " + "a " * 9),
    (22, "short one short one short two THÉTA théta, tHéta"),
    (23, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (24, "no id here " * 3),
    (25, ("word " * 40 + LONG + " ") * 300),
    (25, "repeated id, other text: " + LONG),
    (26, "x" * 2_000_000 + " " + LONG),
]


def written(spark, path, texts, items):
    docs(spark, [(i, t, "s") for i, t in texts]).withColumns({c: F.lit("clash") for c in ("_row", "_words", "items", "window", "hits")}).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit("clash")).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.mark.parametrize("items", [ITEMS, [(7, LONG), (8, LONG + " tail words more")], []], ids=["mixed", "one length", "none"])
def test_equals_brute_force(spark, tmp_path, items):
    assert found(op11_decontamination(spark, written(spark, tmp_path, TEXTS, items))) == plainly(TEXTS, items)


def test_several_passes_give_the_same(spark, tmp_path):
    d = written(spark, tmp_path, TEXTS, ITEMS)
    args = [spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark")]
    whole, parts = leaks.scan(*args, ["doc_id"]), leaks.scan(*args, ["doc_id"], most_windows=4)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_empty_table(spark, tmp_path):
    assert op11_decontamination(spark, written(spark, tmp_path, [], ITEMS)).collect() == []


def test_spans_and_documents_go(spark, tmp_path):
    d = written(spark, tmp_path, TEXTS, ITEMS)
    texts, bench = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    cleaned = leaks.clean(texts, bench)
    assert cleaned.columns == texts.columns
    rows = sorted((r["doc_id"] or 0, r["text"] or "") for r in cleaned.collect())
    assert len(rows) == len(TEXTS)
    got = dict(r for r in rows if r[0] != 25)
    assert got[20] == "x. y" and got[22] == " short two THÉTA" and got[23] == TEXTS[len(AWKWARD) + 3][1] and got[2] == "" and got[24] == " "
    assert [r["text"] for r in cleaned.where("doc_id = 26").collect()] == ["x" * 2_000_000]
    left = leaks.clean(texts, bench, spans=False)
    dirty = {r[0] for r in plainly(TEXTS, ITEMS) if r[5]}
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, _ in TEXTS if str(i) not in dirty)


def test_windows_aren_t_shuffled(spark, sf_dir):
    plan = op11_decontamination(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("regexp_extract_all") == 1


def test_matches_sql(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = op11_decontamination(spark, sf_dir)
    want = c.execute(ORACLE_SQL["op11_decontamination"]).fetchdf()[got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(want.itertuples(index=False, name=None))
    assert any(want["contaminated"])
