"""The pipeline's stages against plain versions of their decisions."""

from collections import Counter

import pytest

import corpus_pipeline as P
from viewloom.llm.text import kept

from .helpers import AWKWARD, docs
from .test_packing import check
from .test_similarity import components, removed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    tables, df = [spark.read.parquet(f"{SF}/documents.parquet")], None
    for _, f in P.STAGES:
        df = kept(f(spark, tables[-1], SF))
        tables.append(df)
    return [[r.asDict() for r in t.collect()] for t in tables]


def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_names_and_columns(stages):
    assert len(P.STAGES) == 5
    for rows in stages[:-1]:
        assert set(rows[0]) == set(P.COLUMNS)


def test_quality_keeps_most(stages):
    assert set(pairs(stages[1])) <= set(pairs(stages[0])) and 0.7 * len(stages[0]) < len(stages[1]) < len(stages[0])


def test_lines(stages):
    gone, want = removed(pairs(stages[1])), []
    for i, t in pairs(stages[1]):
        t = t or ""
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        if left == t or left.split():
            want.append((i, left))
    assert sorted(pairs(stages[2])) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_one_of_each_group(stages):
    groups = {i: c for i, _, c in components(pairs(stages[2]))}
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(set(groups.values()))


def test_mixture_repeats_whole_documents(stages):
    times = Counter(pairs(stages[4]))
    assert set(times) <= set(pairs(stages[3])) and max(times.values()) <= 2
    words = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert words(stages[4]) == pytest.approx(1.5 * words(stages[3]), rel=0.1)


def test_packing(stages):
    ends, pieces = Counter(), []
    for p in sorted(stages[5], key=lambda p: p["start"]):  # a document taken twice is packed twice
        k = next(k for k in range(2) if ends[p["doc_id"], k] == p["start"])
        ends[p["doc_id"], k] += p["length"]
        pieces.append(p | {"doc_id": (p["doc_id"], k)})
    times = Counter(pairs(stages[4]))
    check(pieces, {(i, k): t for (i, t), n in times.items() for k in range(n)})


def test_awkward_rows(spark):
    full = docs(spark, [*AWKWARD, (9, "f e d c b a text here for all\nthe last line", None)], clashing=False)
    df = full
    for name, f in P.STAGES[1:]:
        df = kept(f(spark, df, SF))
        assert df.count() >= 1, name
    one = kept(P.near_duplicates(spark, full, SF)).where("doc_id = 6").count()
    assert one == 1
    empty = full.limit(0)
    for _, f in P.STAGES:
        empty = kept(f(spark, empty, SF))
    assert empty.count() == 0


def test_unlike_rows_without_an_id_of_their_own(spark):
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(12)) for x in "abcde")
    rows = [(None, a, None), (None, b, None), (None, c, None), (None, c + " more", None), (3, d, None), (3, e, None), (4, e, None)]
    got = kept(P.near_duplicates(spark, docs(spark, rows, clashing=False), SF)).collect()
    texts = Counter(r["text"] for r in got)
    assert texts[c] + texts[c + " more"] == 1
    assert {t: texts[t] for t in (a, b, d, e)} == dict.fromkeys((a, b, d, e), 1) and len(got) == 5


def test_rows_without_a_word_pass_three_stages_as_they_are(spark):
    good = "These are lines of plain words, which nothing else in the table has."
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, None, None), (2, "", "a"), (7, good, "a")]
    df = docs(spark, rows, clashing=False)
    for _, f in P.STAGES[:3]:
        df = kept(f(spark, df, SF))
        got = Counter((r["doc_id"], r["text"], r["source"], r["n_chars"]) for r in df.collect() if r["doc_id"] != 7)
        assert got == Counter((i, t, s, len(t) if t is not None else None) for i, t, s in rows[:-1])


def test_a_few_own_lines_of_a_large_document_stay(spark):
    shared = "\n".join(" ".join(f"word{k}of{j}" for j in range(8)) for k in range(60))
    own = "only one of both documents has this line with its nine and more words"
    got = {r["doc_id"]: r["text"] for r in P.line_dedup(spark, docs(spark, [(1, shared, "a"), (2, shared + "\n" + own, "a")], clashing=False), SF).collect()}
    assert got == {1: shared, 2: own}
