"""The two joins against brute force, on the tables and on made cases."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.llm import jaccard, lines
from viewloom.llm import sets as S
from viewloom.llm.queries import op8_jaccard_join, op10_line_dedup
from viewloom.llm.text import kept, table

from .helpers import AWKWARD, docs


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            inverted[x].append(k)
    for pair in {(b, a) for ks in inverted.values() for i, a in enumerate(ks) for b in ks[:i]}:
        x, y = sets[pair[0]][1], sets[pair[1]][1]
        if 100 * len(x & y) >= 75 * len(x | y):
            root[find(pair[1])] = find(pair[0])
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def rounds(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_join_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rounds(op8_jaccard_join(spark, sf_dir)) == components(rows)


@pytest.fixture(scope="module")
def near():
    """Groups of near copies, chains, and texts that share a passage."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    passage = [word() for _ in range(40)]
    rows, n = [], 0
    for g in range(12):
        base = [word() for _ in range(60)]
        for _ in range(8 if g else 90):
            own = list(base)
            for k in rng.choice(60, int(rng.integers(0, 4)), replace=False):
                own[k] = word()
            rows.append((n, " ".join(own)))
            n += 1
    for _ in range(60):
        rows.append((n, " ".join([word() for _ in range(20)] + passage + [word() for _ in range(int(rng.integers(5, 30)))])))
        n += 1
    chain = [word() for _ in range(50)]
    for k in range(10):
        chain = [*chain[3:], word(), word(), word()]
        rows.append((n, " ".join(chain)))
        n += 1
    return [rows[i] for i in rng.permutation(len(rows))]


def test_join_of_near_copies(spark, near):
    assert rounds(jaccard.join(docs(spark, [(i, t, None) for i, t in near]).repartition(3))) == components(near)


def test_awkward_rows(spark):
    assert rounds(jaccard.join(docs(spark, AWKWARD))) == components([(i, t) for i, t, _ in AWKWARD])
    assert jaccard.join(docs(spark, [])).count() == 0
    got = lines.dedup(docs(spark, [(1, None, "a"), (2, "", "a"), (5, "Word " * 5000, "b"), (None, "a b c d e f", None), (7, "f e d c b A\nx", None), (7, "f e d c b A\nx", None)], clashing=False)).collect()
    assert sorted((str(r["doc_id"]), r["removed"]) for r in got) == [("1", []), ("2", []), ("5", []), ("7", [0]), ("7", [0]), ("None", [])]
    assert lines.dedup(docs(spark, [], clashing=False)).count() == 0


def removed(rows):
    seen, gone = [], set()
    for i, k, s in sorted((i, k, frozenset(x.encode().lower().split())) for i, t in rows for k, x in enumerate((t or "").split("\n"))):
        if s:
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                gone.add((i, k))
            seen.append(s)
    return gone


def removed_by(df):
    numbers = lambda x: [int(k) for k in x.split(",") if k] if isinstance(x, str) else x
    return {(r["doc_id"], k) for r in df.collect() for k in numbers(r["removed"])}


def test_line_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert removed_by(op10_line_dedup(spark, sf_dir)) == removed(rows)


@pytest.mark.parametrize("block", [8192, 16])
def test_lines_of_near_copies(spark, near, block, monkeypatch):
    # a few lines a text, whose words come from small sets too, so that keys are crowded
    rng = np.random.default_rng(6)
    rows = [(i, "\n".join([t, " ".join(rng.choice(list("abcdefghijklm"), 14)), "short line"])) for i, t in near]
    monkeypatch.setattr(lines, "BLOCK", block)
    monkeypatch.setattr(lines, "FOUND_AT_ONCE", 50 if block == 16 else 1 << 21)
    got = removed_by(lines.dedup(docs(spark, [(i, t, None) for i, t in rows], clashing=False).repartition(3)))
    assert got == removed(rows)


def test_short_lines(spark):
    long = " ".join(f"w{k}" for k in range(9))
    rows = [(1, "all rights reserved.\nx\na b c d\np q r"), (2, "X\nAll rights reserved.\n\nd c b a e\np q r s"), (3, f"the the the\n{long}"), (4, "the\n漢字漢字\n \n1 2 3 4 5"), (5, "漢字漢字\nx x\n4 3 2 1\n1 2 3")]
    got = removed_by(lines.dedup(docs(spark, [(i, t, None) for i, t in rows], clashing=False).repartition(3)))
    # four words match five of which they are; three don't match four
    assert got == {(2, 0), (2, 1), (2, 3), (4, 0), (5, 0), (5, 1), (5, 2)}


def test_line_query_with_short_lines(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    seen, gone = [], set()
    for i, k, s in sorted((i, k, frozenset(x.encode().lower().split())) for i, t in rows for k, x in enumerate((t or "").split("\n"))):
        if s:
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                gone.add((i, k))
            seen.append(s)
    assert removed_by(op10_line_dedup(spark, sf_dir)) == gone


def test_texts_of_one_id_that_share_a_line(spark):
    rows = [(None, "a b c d e f\none own line of this text"), (None, "f e d c b a\nsomething else that stands here"), (7, "u v w x y z\nmore"), (7, "u v w x y z\nother"), (7, "u v w x y z\nother")]
    got = lines.dedup(docs(spark, [(i, t, None) for i, t in rows], clashing=False).repartition(2)).collect()
    nulls, sevens = ([(r["text"], r["removed"]) for r in got if r["doc_id"] == i] for i in (None, 7))
    assert sorted(x for _, x in nulls) == [[], [0]]
    # equal rows share a fate
    assert len({(t, tuple(x)) for t, x in sevens}) == 2 and sorted(x for _, x in {t: x for t, x in sevens}.items()) == [[], [0]]


def test_lines_that_their_first_candidates_do_not_settle(spark, near, monkeypatch):
    # without bits to tell sets apart, and one candidate a node, most nodes are searched to the end
    rng = np.random.default_rng(7)
    nothing = lambda tokens, starts: (np.zeros(len(starts) - 1, np.uint64),) * 2
    monkeypatch.setattr(lines, "parity", nothing)
    monkeypatch.setattr(lines, "CELL_FIRST", 1)
    monkeypatch.setattr(lines, "FIRST", 1)
    asked = []
    whole = lines.settled
    monkeypatch.setattr(lines, "settled", lambda docs, nodes, crowd, asking: asked.append(asking.count()) or whole(docs, nodes, crowd, asking))
    rows = [(i, "\n".join([t, " ".join(rng.choice(list("abcdefghijklm"), 14))])) for i, t in near]
    assert removed_by(lines.dedup(docs(spark, [(i, t, None) for i, t in rows], clashing=False).repartition(3))) == removed(rows)
    assert asked and asked[0] > 10


def test_lines_with_clashing_columns(spark):
    got = lines.dedup(docs(spark, [(1, "a b c d e f\nb", None), (2, "x\nf e d c b a", None)]).withColumns({"n_lines": F.lit("clash"), "_doc0": F.lit("kept"), "_hash": F.lit("kept")}))
    assert sorted((r["doc_id"], r["n_lines"], r["removed"], r["node"], r["_doc0"], r["_hash"]) for r in got.collect()) == [(1, 2, [], "clash", "kept", "kept"), (2, 2, [1], "clash", "kept", "kept")]


def test_long_lines_and_texts(spark):
    rng = np.random.default_rng(8)
    long = [f"w{k}" for k in rng.integers(0, 10**6, 60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-6000] + ["other"] * 9)), (3, " ".join(long[:40_000])), (4, "\n".join(f"line {k} of many {k * 7}" for k in range(20_000))), (5, " ".join(long))]
    df = docs(spark, [(i, t, None) for i, t in rows], clashing=False)
    assert {k for k in removed_by(lines.dedup(df)) if k[0] != 4} == {(2, 0), (5, 0)}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.join(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}


def test_links_that_the_sets_refute(spark, near, monkeypatch):
    # a bound that lets all pairs pass: the sets themselves have to find the links
    bound = jaccard.shared
    monkeypatch.setattr(jaccard, "shared", lambda x, y: bound(x, y) if x.dtype.itemsize == 8 else 1 << 40)
    again = []
    checked = jaccard.searched
    monkeypatch.setattr(jaccard, "searched", lambda cell, members, exact=False: again.append(exact) or checked(cell, members, exact))
    assert rounds(jaccard.join(docs(spark, [(i, t, None) for i, t in near]).repartition(3))) == components(near)
    assert True in again


def test_crowded_keys(spark, near, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWDED", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    assert rounds(jaccard.join(docs(spark, [(i, t, None) for i, t in near]).repartition(3))) == components(near)


@pytest.mark.parametrize("name", ["op8_jaccard_join", "op10_line_dedup"])
def test_matches_sql(spark, sf_dir, name):
    import duckdb

    from viewloom.llm.queries import ORACLE_SQL, QUERIES

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = c.execute(ORACLE_SQL[name]).fetchdf()
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got[sorted(got.columns)].values.tolist())) == sorted(map(tuple, want[sorted(got.columns)].values.tolist()))


def test_packed_rows():
    import pyarrow as pa

    from viewloom.llm.packs import pack, packs

    rng = np.random.default_rng(2)
    kind = np.dtype([("a", "<u8"), ("b", "<i4")])
    bucket, table, n = rng.integers(0, 5, 40), np.zeros(40, kind), rng.integers(0, 4, 40)
    table["a"], table["b"] = rng.integers(0, 99, 40), np.arange(40)
    values = rng.integers(0, 99, n.sum()).astype("<u4")
    cuts = np.concatenate([[0], np.cumsum(n)])
    rows = pack(bucket, [(table, None), (values, n)], ["bucket", "t", "v"])
    for k, (t, v) in packs(iter([rows.slice(0, 2), rows.slice(2)]), [kind, "<u4"]):
        own = np.flatnonzero(bucket == k)
        assert t.tolist() == table[own].tolist() and v.tolist() == np.concatenate([values[cuts[i] : cuts[i + 1]] for i in own]).tolist()
    assert not list(packs(iter([pa.record_batch([pa.array([], pa.int32())], names=["bucket"])]), []))


def test_kept_text(spark):
    df = lines.dedup(docs(spark, [(1, "a b c d e f\nkeep\n", None), (2, "keep too\nf e d c b a", None)], clashing=False))
    assert sorted(r["t"] for r in df.select(lines.kept_text().alias("t")).collect()) == ["a b c d e f\nkeep\n", "keep too"]


def test_tree_finds_all_that_pass():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, int(m), dtype=np.uint64)) for m in rng.integers(50, 1200, 100)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * f)], rng.integers(0, 2**63, int(len(s) * (1 - f)), dtype=np.uint64)])) for s, f in zip(sets, rng.random(100), strict=True)]
    tokens, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    n = np.diff(starts)
    coarse = S.blobs(jaccard.points(tokens, starts).ravel(), np.arange(len(n) + 1) * jaccard.GROUPS)
    p = jaccard.Points(n, coarse, jaccard.fine_points(tokens, starts))
    q, m = jaccard.CountTree(p, np.arange(200)).search(np.arange(200))
    found = set(zip(q.tolist(), m.tolist(), strict=True))
    a, b = (v.ravel() for v in np.meshgrid(np.arange(200), np.arange(200), indexing="ij"))
    fine = jaccard.possible(p, a, p, b)
    assert found == set(zip(a[fine].tolist(), b[fine].tolist(), strict=True))
    for i in range(200):
        for j in range(200):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert (i, j) in found
    assert len(found) < 2000


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert {got.get(i, i) for i in range(201)} == {0} and got[1001] == 1000


def test_a_filled_sketch_crowds_no_key(spark, sf_dir):
    """Where every counter of the sketch is large, keys are still counted: those of a single node give no rows."""
    texts = table(spark, sf_dir, "documents").select("text")
    full = spark.sparkContext.broadcast(np.full(S.WIDTH, 10**9, np.uint32))
    nodes = kept(jaccard.keyed(texts, full))
    crowd = jaccard.crowded(nodes)
    assert not len(crowd[0])
    rows = jaccard.cells(nodes, crowd).groupBy("key").count()
    assert rows.count() > 0 and rows.where("count < 2").count() == 0


def test_crowded_keys_are_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWDED", 5)
    shared = "one two three four five"
    texts = spark.createDataFrame([(f"{shared} own{i} words{i} of{i} text{i}",) for i in range(23)], "text string")
    nodes = kept(jaccard.keyed(texts, spark.sparkContext.broadcast(np.full(S.WIDTH, 6, np.uint32))))
    keys, parts = jaccard.crowded(nodes)
    shown = jaccard.cells(nodes, (keys, parts)).where("part >= 0")
    assert len(keys) <= 1 and set(parts.tolist()) <= {4} and (shown.count() > 0) == (len(keys) > 0)


def test_lines_are_searched_to_the_end_behind_a_full_filter(spark, near, monkeypatch):
    # filters that let all places and cells pass, as they would on a huge corpus: the same lines go, and only nodes that ask are searched
    monkeypatch.setattr(lines, "parity", lambda tokens, starts: (np.zeros(len(starts) - 1, np.uint64),) * 2)
    monkeypatch.setattr(lines, "CELL_FIRST", 1)
    monkeypatch.setattr(lines, "FIRST", 1)
    monkeypatch.setattr(S, "in_bloom", lambda bits, nodes: np.ones(len(nodes), bool))
    seen = []
    whole = lines.possible_rows

    def counted(nodes, crowd, own, buckets):
        rows = kept(whole(nodes, crowd, own, buckets))
        seen.append((rows.where("asks").count(), own.count(), rows.where("not asks").count()))
        return rows

    monkeypatch.setattr(lines, "possible_rows", counted)
    rng = np.random.default_rng(7)
    rows = [(i, "\n".join([t, " ".join(rng.choice(list("abcdefghijklm"), 14))])) for i, t in near[:120]]
    assert removed_by(lines.dedup(docs(spark, [(i, t, None) for i, t in rows], clashing=False).repartition(2))) == removed(rows)
    assert seen and 0 < seen[0][0] <= seen[0][1] and seen[0][2] > 0
