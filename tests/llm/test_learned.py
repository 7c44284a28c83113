"""Models: held-out accuracy, exact parts against brute force, awkward rows."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from viewloom.llm import ann, blocks, compression, hmm, rules, toxicity
from viewloom.llm import queries as Q

from .helpers import AWKWARD, crc, docs

BIG = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [b" end"]


def test_hmm_query(spark, sf_dir):
    got = {r["doc_id"]: r for r in Q.op1_hmm_scoring(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts = Counter(w for i, t in texts.items() if crc(i, 10) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        r, own = got[i], tokens(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(own), sum(w in counts for w in own), n, crc(i, 10) == 0)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), abs=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_forward_is_exact_and_sums_to_one():
    rng = np.random.default_rng(0)
    k, size = 3, 4
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    model = hmm.Hmm(norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((size, k)), 0))
    import itertools

    words = np.array(list(itertools.product(range(size), repeat=4)))
    got = hmm.forward(model, words.ravel(), np.arange(len(words) + 1) * 4)
    assert (10**got).sum() == pytest.approx(1.0)
    for w, s in zip(words[::37], got[::37], strict=True):
        brute = sum(model.start[p[0]] * model.emit[w[0], p[0]] * np.prod([model.move[p[t - 1], p[t]] * model.emit[w[t], p[t]] for t in range(1, 4)]) for p in itertools.product(range(k), repeat=4))
        assert 10**s == pytest.approx(brute)
    # posteriors of the expected counts are distributions, and a round of Baum-Welch never lowers the likelihood
    ids = rng.integers(0, size, (50, 9))
    start, move, posterior, before = hmm.expected(model, ids)
    assert np.allclose(posterior.sum(1), 1) and start.sum() == pytest.approx(50) and move.sum() == pytest.approx(50 * 8)
    emit = np.stack([np.bincount(ids.T.ravel(), posterior[:, j], size) for j in range(k)], 1)
    after = hmm.expected(hmm.Hmm(norm(start, 0), norm(move, 1), norm(emit, 0)), ids)[3]
    assert after >= before


def test_hmm_awkward_rows(spark):
    got = hmm.score(docs(spark, AWKWARD), F.lit(True), k=2, rounds=1, n_frequent=4, n_known=2).collect()
    assert len(got) == len(AWKWARD) and all(np.isfinite(r["score"]) and np.isfinite(r["base_score"]) for r in got)
    counts = Counter(w for _, t, _ in AWKWARD for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for r in got:  # words beyond the broadcast ones come by the join
        if r["doc_id"] == 4:
            assert r["base_score"] == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens("one")))
    assert hmm.score(docs(spark, []), F.lit(True)).count() == 0
    assert hmm.score(docs(spark, AWKWARD[:4]), F.lit(False)).where("n_known = 0").count() == 4


def exact(vectors, k=20):
    x = np.array([v for _, v in vectors], float)
    ids = np.array([i for i, _ in vectors])
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[ids == ids[i]] = -np.inf
        out[int(ids[i])] = ids[np.lexsort((ids, -s))[:k]].tolist()
    return out


def test_search_recall(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{BIG}/embeddings.parquet").collect()]
    want, got = exact(vectors), {}
    table = dict(vectors)
    for r in sorted(Q.op3_adaptive_scan(spark, BIG).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["score"] == pytest.approx(float(np.dot(np.array(table[r["query_id"]], float), np.array(table[r["vec_id"]], float))), abs=1e-12)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_search_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    same = rng.standard_normal(8).tolist()
    rows = [(i, same) for i in range(60)] + [(100, None), (101, []), (102, [0.0] * 8), (103, [float("nan")] * 8), (104, [None] * 8), (120, [1.0] * 8), (121, [float("inf")] * 8)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit("clash")), F.col("vec_id") % 20 == 0, k=5, cell=16).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by[0] == [1, 2, 3, 4, 5] and by[20] == [0, 1, 2, 3, 4] and set(by) == {0, 20, 40, 120}
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
    assert ann.search(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>"), F.lit(True)).count() == 6


def test_cells():
    assert ann.cells([(0, 3), (1, 3), (2, 9), (3, 1)], 4) == [(0, 0, 1), (1, 1, 1), (2, 2, 3), (3, 5, 1)]


def accuracy(rows, labels, name):
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    return sum(p == y for p, y in held) / len(held), held


def labels(spark, folder, name):
    return {r["doc_id"]: r[name] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}


def test_quality_query(spark):
    rows = Q.op7_compression_quality(spark, BIG).collect()
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert accuracy(rows, labels(spark, BIG, "quality"), "quality")[0] >= 0.9


def test_quality_awkward_rows(spark):
    known = spark.createDataFrame([(1, 1), (2, 0), (9, None)], "doc_id long, label int")
    model = compression.train(docs(spark, AWKWARD), known)
    rows = compression.score(docs(spark, AWKWARD), model, ["doc_id"]).collect()
    assert len(rows) == len(AWKWARD) and all(r["score"] == 0.5 for r in rows)
    assert compression.score(docs(spark, []), model, ["doc_id"]).count() == 0


def test_toxicity_query(spark):
    rows = Q.op6_pu_toxicity(spark, BIG).collect()
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    share, held = accuracy(rows, labels(spark, BIG, "toxic"), "toxic")
    assert share >= 0.88
    assert sum(p for p, y in held if y == 0) <= 0.05 * len(held)


def test_pu_risk_stays_above_zero():
    rng = np.random.default_rng(0)
    background = lambda: np.unique(rng.integers(100, 400, 30))
    pos = [np.unique(np.append(background(), rng.integers(0, 5, 2))) for _ in range(240)]
    unl = [np.unique(np.append(background(), rng.integers(0, 5, 2))) if i % 5 == 0 else background() for i in range(900)]
    model = toxicity.fit(pos, unl, 0.2, size=400)
    assert min(model.loss) >= 0 and model.loss[-1] < model.loss[0]
    hidden = [model.weights[u].sum() + model.offset for i, u in enumerate(unl) if i % 5 == 0]
    others = [model.weights[u].sum() + model.offset for i, u in enumerate(unl) if i % 5]
    assert np.mean(np.array(hidden)[:, None] > np.array(others)) > 0.75


def test_toxicity_awkward_rows(spark):
    known = spark.createDataFrame([(4, 1), (5, 0), (6, None)], "doc_id long, label int")
    model = toxicity.train(docs(spark, AWKWARD), known)
    assert toxicity.score(docs(spark, AWKWARD), model, ["doc_id"]).count() == len(AWKWARD)
    none = toxicity.train(docs(spark, []), known.limit(0))
    assert all(r["score"] < 1e-15 for r in toxicity.score(docs(spark, AWKWARD), none, ["doc_id"]).collect())
    assert toxicity.score(docs(spark, []), none, ["doc_id"]).count() == 0


def statistics(text):
    t = text or ""
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    found = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + j for i in range(len(words) - 4) if found[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines_ = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines_) - len(set(lines_)), len(inside)


def test_rules_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    rows = Q.op4_decision_list(spark, BIG).collect()
    known = labels(spark, BIG, "quality")
    for r in rows:
        n, chars, symbols, dup, repeat = statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n) and not (r["base_failed"] and r["kept"])
    judged = [(r["kept"], known[r["doc_id"]]) for r in rows if known.get(r["doc_id"]) is not None and not r["base_failed"]]
    assert sum(k for k, y in judged if y == 1) >= 0.97 * sum(y == 1 for _, y in judged)
    assert sum(not k for k, y in judged if y == 0) >= 0.6 * sum(y == 0 for _, y in judged)


def test_learned_list(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = np.where((x[:, 0] > 0.8) & (x[:, 1] < 0.5), 0, 1)
    learned = rules.learn(x, y, ["a", "b", "c"])
    assert learned and all(c[0] in ("a", "b") for c in learned[0].conditions)
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = [r["v"] for r in df.select(rules.verdict(learned).alias("v")).collect()]
    assert np.mean([(g is not None) == (v == 0) for g, v in zip(got, y, strict=True)]) > 0.97
    assert rules.learn(x[:0], y[:0], ["a", "b", "c"]) == [] and rules.learn(x, np.ones(600), ["a", "b", "c"]) == []


def test_rules_awkward_rows(spark):
    rows = {(r["doc_id"], r["n_words"]) for r in rules.statistics(docs(spark, AWKWARD), ["doc_id"]).collect()}
    assert {(1, 0), (2, 0), (3, 0), (4, 1), (5, 5000), (6, 7), (None, 6)} == rows
    assert rules.statistics(docs(spark, []), ["doc_id"]).count() == 0
    assert rules.train(docs(spark, []), spark.createDataFrame([], "doc_id long, label int")) == []


def test_blocks_of_a_page():
    page = "<body><nav><a href='x>y'>Home</a></nav><script>var t='</p>';</script><article><h1>A &amp; B</h1><p>one\n two<br>three<p>four &lt;<b>bold</b></article><!-- <p>no --><footer>&copy; x</footer><p>cut <a hre"
    got = blocks.blocks(page)
    assert [b.text for b in got] == ["Home", "A & B", "one two three", "four <bold", "© x", "cut"]
    assert [blocks.teacher(b) for b in got] == [0, 1, 1, 1, 0, -1]
    assert blocks.blocks("") == [] and [b.text for b in blocks.blocks("a < b")] == ["a < b"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<p><a title="5"" href="x">one</a> two</p><p>three</p>', ["one two", "three"]),
        ('<p><a title="5"" href="x">one</a></p><p>say "two"</p><p>three</p>', ["one", 'say "two"', "three"]),
        ("<p>x <y, it's so</p><p>three</p>", ["x", "three"]),
        ('<p><a href="x>one</a></p><p>three</p>', ["one", "three"]),
        ("<p>love </3 this</p><p>three</p>", ["love", "three"]),
        ('<p title = "a > b" lang=\'>\'>one</p>', ["one"]),
        ("<p>one</p><p title='a", ["one"]),
        ("<html><head><title>no</title><meta name=a><body><p>one</p></body></html>", ["one"]),
        ("<head><title>no</title><script>no</script><style>no</style><p>one</p>", ["one"]),
        ("<head><title>no</title><img src=a>one<p>two</p>", ["one", "two"]),
        ("<head><title>no</title>\none <b>two</b>", ["one two"]),
        ("<head><title>no</title></head><body><p>one</p>", ["one"]),
    ],
)
def test_blocks_of_careless_pages(page, want):
    assert [b.text for b in blocks.blocks(page)] == want


def test_a_tag_of_many_values_that_breaks_off():
    assert [b.text for b in blocks.blocks("<p>one</p><p " + 'a="b" ' * 5000)] == ["one"]


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(0)
    model = blocks.Labeller.new(3, rng)
    x, mask = blocks.padded([rng.random((4, blocks.WIDTH)).astype(np.float32), rng.random((2, blocks.WIDTH)).astype(np.float32)])
    y = np.array([[1, 0], [0, 1], [1, -1], [-1, -1]])
    model.w = [w.astype(np.float64) for w in model.w]
    model.out = model.out.astype(np.float64)
    _, grads = model.gradients(x.astype(np.float64), y, mask)
    for w, g in zip([*model.w, model.out], grads, strict=True):
        at = tuple(rng.integers(0, s) for s in w.shape)
        old = w[at]
        losses = []
        for e in (1e-3, -1e-3):
            w[at] = old + e
            losses.append(model.gradients(x.astype(np.float64), y, mask)[0])
        w[at] = old
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(float(g[at]), abs=2e-4)


def test_pages_query(spark, sf_dir):
    import html
    import re

    rows = {r["page_id"]: r for r in Q.op5_block_labeller(spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", p["html"] or "", re.S)
        parts = re.split(r"<[^b>][^>]*>", body.group(1)) if body else []
        want = "\n".join(z for z in (" ".join(html.unescape(re.sub(r"<(b|br)>", "", y)).split()) for y in parts) if z)
        assert rows[p["page_id"]]["text"] == want and rows[p["page_id"]]["n_chars"] == len(want)


def test_other_pages(spark):
    seen = [blocks.blocks(f"<body><nav><li>Menu {i}</li></nav><article><h1>Head {i}</h1><p>Some words of text, they end here.</p></article><footer>Foot {i}</footer></body>") for i in range(60)]
    model = blocks.fit(seen)
    page = "<main><h1>Head line</h1><p>Some text that is long enough, yes.</p></main><aside class='sidebar'><p>Other stories that you like.</p></aside><form><label>Name</label></form>"
    own = blocks.blocks(page)
    p = model.probabilities([blocks.vectors(own)])[0]
    assert (p >= 0.5).tolist() == [True, True, False, False]
    df = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "u", page), (3, "u", page)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert [r["text"] for r in blocks.extract(df, model, ["page_id"]).orderBy("page_id").collect()][:2] == ["", ""]
    assert blocks.extract(df.limit(0), None, ["page_id"]).count() == 0 and blocks.train(df.limit(0)) is None


def test_quality_scores_by_hand(spark):
    import zstandard as zstd

    docs_, known = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = compression.train(docs_, known)
    press = [zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(d), level=3, write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs_.collect()}
    for r in compression.score(docs_, model, ["doc_id"]).collect():
        t = texts[r["doc_id"]]
        g, b = (sum(len(p.compress(t[i : i + compression.BLOCK])) for i in range(0, len(t), compression.BLOCK)) for p in press)
        difference = (b - g) / len(t) if t else 0.0
        assert r["difference"] == pytest.approx(difference, abs=1e-12)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(model.weight * difference + model.offset))), abs=1e-9)


def test_toxicity_scores_by_hand(spark, sf_dir):
    import re

    from viewloom.llm.text import value_of

    docs_ = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    model = toxicity.Model(np.random.default_rng(4).standard_normal(toxicity.LEVELS << toxicity.BITS) / 50, -1.0, 1.5, 0.25)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs_.collect()}
    apart = bytes(np.flatnonzero(toxicity.APART).astype(np.uint8))
    for r in toxicity.score(docs_, model, ["doc_id"]).collect():
        counts = Counter()
        for w in re.findall(b"[^" + re.escape(apart) + b"]+", texts[r["doc_id"]]):
            for k in (None, 4, 5, 6, 7):
                if k is None or len(w) > k:
                    counts[value_of(w[:k]) * (2 * (k or 0) + 1) % 2**64 >> 64 - toxicity.BITS] += 1
        raw = sum(model.weights[f * 3 + n] for f, c in counts.items() for n in range(min(c, 3))) - 1.0
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(1.5 * raw + 0.25))), abs=1e-9)


def test_pu_risk_by_hand():
    rng = np.random.default_rng(1)
    pos, unl = ([np.unique(rng.integers(0, 30, 5)) for _ in range(n)] for n in (20, 50))
    prior = 0.3
    b = float(np.log(prior / (1 - prior)))
    loss = lambda x: float(np.log1p(np.exp(-x)))
    first = prior * loss(b) + max(0.0, loss(-b) - prior * loss(-b))  # all weights are 0 at first
    model = toxicity.fit(pos, unl, prior, size=30, rounds=40, least=1)
    assert model.loss[0] == pytest.approx(first)
    # another round would begin from the model's own risk
    g = lambda rows: [model.weights[u].sum() + model.offset for u in rows]
    risk = prior * np.mean([loss(x) for x in g(pos)]) + max(0.0, np.mean([loss(-x) for x in g(unl)]) - prior * np.mean([loss(-x) for x in g(pos)]))
    assert toxicity.fit(pos, unl, prior, size=30, rounds=41, least=1).loss[40] == pytest.approx(risk)


def test_windows_hold_every_move_once():
    flat, starts = np.arange(400), np.array([0, 1, 1, 65, 129, 400])
    moves, firsts, tokens_ = Counter(), 0, Counter()
    for ids, first in hmm.in_windows(flat, starts):
        firsts += int(first.sum())
        for row, is_first in zip(ids, first, strict=True):
            assert (np.diff(row) == 1).all()
            moves.update(row[:-1].tolist())
            tokens_.update((row if is_first else row[1:]).tolist())
    assert firsts == 4 and set(tokens_.values()) == {1} and len(tokens_) == 400
    assert moves == Counter(set(range(400)) - {int(s) - 1 for s in starts[1:]})


@pytest.mark.parametrize("first_lists", [4096, 24])
def test_search_beyond_the_sample(spark, first_lists, monkeypatch):
    monkeypatch.setattr(ann, "FIRST_LISTS", first_lists)
    # the index is fitted on, and first bounds come from, far fewer vectors than there are
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((40, 24))
    x = centres[rng.integers(0, 40, 6000)] + 0.5 * rng.standard_normal((6000, 24))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    build, bound = ann.build, ann.BOUND
    try:
        ann.build = lambda *a, **k: build(*a, **k, most=500)
        ann.BOUND = 100
        got = ann.search(df, F.col("vec_id") % 20 == 0, cell=256).collect()
    finally:
        ann.build, ann.BOUND = build, bound
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    want = exact([(i, v) for i, v in enumerate(x)])
    assert by.keys() == want.keys() and sum(len(set(by[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_blocks_without_telling_names():
    rng = np.random.default_rng(3)
    words = lambda kind, n: " ".join(f"{kind}{k}" for k in rng.integers(0, 30, n))
    page = lambda: f"<body><nav><li><a>{words('menu', 2)}</a></li></nav><article><h1>{words('Head', 4)}</h1><p>{words('text', 30)}.</p><p>{words('text', 25)}.</p></article><footer>{words('foot', 3)}</footer></body>"
    model = blocks.fit([blocks.blocks(page()) for _ in range(80)])
    right = total = 0
    for _ in range(30):
        own = blocks.blocks(page().replace("nav", "div").replace("article", "div").replace("footer", "div"))
        p = model.probabilities([blocks.vectors(own)])[0] >= 0.5
        right, total = right + int((p == np.array([False, True, True, True, False])).sum()), total + len(own)
    assert right >= 0.9 * total
