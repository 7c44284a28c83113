"""Language-model scoring with a hidden Markov model over words.

The alphabet of the hidden Markov model is a bounded set of word classes: each of the ``n_frequent`` most frequent words of the training texts is a class of its own,
every other word falls into one of ``n_buckets`` classes by a hash of it.  Inside a class a word has its add-0.1 share of the class's
count, one unseen word included, so

    P(text) = P_hmm(classes of the text) * product of P(word | its class)

is one distribution over all texts.  Training counts every word of every training text.  Baum-Welch's expected counts
are gathered in numpy in each task, from windows of ``WINDOW`` tokens, summed over partitions by Spark.  Windows of one text share a token, so every move is counted once; a text's first
window begins from the model's starting distribution, which is learned from first tokens alone, later ones from its stationary distribution.  The counts are re-estimated on the driver; the parameters (states x classes) do not grow with the corpus.  States
begin from a clustering of the classes by their neighbours, again counted over all partitions.  Scoring runs the scaled forward
recursion over the whole text, so its likelihood is exact, whatever the text's length.

Words are known by 64-bit values (see ``text``).  Frequent words' counts are broadcast, ``n_known`` of them at most; the
counts of rarer ones reach their documents by a join on the word.

Defined results: null and empty texts are their end token alone; repeated rows are scored each on their own; rows with a null id are scored and counted as training rows; with no training rows
every word is unseen; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.text import kept, narrow, slices, value_of, word_values

#: The end token's value; a word can't hold a space.
END = np.uint64(value_of(b"end") ^ 0x5DEECE66D5DEECE6)
WINDOW = 64
SMOOTH = 0.1


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of the words of each row, each row's end token after them, and where each row's begin."""
    values, at = word_values(column)
    n = len(at) - 1
    out = np.full(len(values) + n, END, np.uint64)
    starts = at + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[starts[1:] - 1] = False
    out[keep] = values
    return out, starts


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the count of each token over all rows of (text); summed in each task before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in slices(batches, "text", 1 << 23):
            held.append(np.unique(tokens(batch.column(0))[0], return_counts=True))
            size += len(held[-1][0])
            if size > 4_000_000:
                words, counts = merge(held)
                held, size = [(words, counts)], len(words)
                if size > 2_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            words, counts = merge(held)
            yield out()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    words, place = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
    return words, np.bincount(place, np.concatenate([c for _, c in parts]), len(words)).astype(np.int64)


@dataclass
class Vocabulary:
    """Counts of the frequent words, by value, and the totals of every class."""

    words: np.ndarray  # ascending values of the known words
    counts: np.ndarray
    classes: np.ndarray  # the class of each known word
    class_total: np.ndarray
    class_kinds: np.ndarray
    n_frequent: int
    total: int
    kinds: int

    def lookup(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each word and its place among the known words (-1: not among them)."""
        kinds, inverse = np.unique(values, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, kinds), max(len(self.words) - 1, 0))
        known = (self.words[at] == kinds) if len(self.words) else np.zeros(len(kinds), bool)
        buckets = len(self.class_total) - self.n_frequent
        of = self.n_frequent + (kinds >> np.uint64(8)).astype(np.int64) % buckets
        if len(self.words):
            of = np.where(known, self.classes[at], of)
        return of[inverse], np.where(known, at, -1)[inverse]

    def inside(self, count: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class; a frequent word is the whole of its class."""
        share = (count + SMOOTH) / (self.class_total[of] + SMOOTH * (self.class_kinds[of] + 1))
        return np.where(of < self.n_frequent, 0.0, np.log10(share))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + SMOOTH) / (self.total + SMOOTH * (self.kinds + 1)))


def vocabulary(counts: DataFrame, n_frequent: int, n_buckets: int, n_known: int) -> Vocabulary:
    """``counts``: (word, n), written.  The most frequent words, ``n_known`` at most, come to the driver, as do the totals of the classes."""
    # the counts' bins (64 to a doubling) tell from which count on the words are few enough to be collected
    bin_of = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")
    bins = sorted(((r["bin"], r["count"]) for r in counts.groupBy(bin_of.alias("bin")).count().collect()), reverse=True)
    least, total_words = 1 << 20, 0
    for b, many in bins:
        if total_words + many > n_known:
            break
        least, total_words = b, total_words + many
    top = counts.where(bin_of >= least).toArrow()
    words, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.lexsort((words, -n))
    words, n = words[order], n[order]
    n_frequent = min(n_frequent, len(words))
    classes = np.where(np.arange(len(words)) < n_frequent, np.arange(len(words)), n_frequent + (words >> np.uint64(8)).astype(np.int64) % n_buckets)
    size = n_frequent + n_buckets
    total, kinds = np.zeros(size, np.int64), np.zeros(size, np.int64)
    bucket = F.pmod(F.shiftrightunsigned("word", 8), F.lit(n_buckets))
    whole = counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    for r in whole:
        total[n_frequent + r["b"]] = r["n"]
        kinds[n_frequent + r["b"]] = r["k"]
    all_n, all_k = int(total.sum()), int(kinds.sum())
    own = n_frequent + (words[:n_frequent] >> np.uint64(8)).astype(np.int64) % n_buckets
    np.subtract.at(total, own, n[:n_frequent])  # frequent words leave their buckets
    np.subtract.at(kinds, own, 1)
    total[:n_frequent], kinds[:n_frequent] = n[:n_frequent], 1
    order = np.argsort(words)
    return Vocabulary(words[order], n[order], classes[order], total, kinds, n_frequent, all_n, all_k)


def encoded(docs: DataFrame, held) -> DataFrame:
    """(row, doc_id, train, classes, rare, n_tokens, n_known, base, inside): classes as 32-bit bytes, and the values of the words that are not among the known ones.

    n_known, base and inside are the number of the known words' tokens and the sums of their log10 shares.
    """
    schema = "row long, doc_id long, train boolean, classes binary, rare binary, n_tokens long, n_known long, base double, inside double"
    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "train", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab: Vocabulary = held.value
        for batch in slices(batches, "text", 1 << 23):
            values, starts = tokens(batch.column(3))
            of, place = vocab.lookup(values)
            known = place >= 0
            count = np.where(known, vocab.counts[place] if len(vocab.counts) else 0, 0)
            sums = []
            for x in (known.astype(np.int64), np.where(known, vocab.base(count), 0.0), np.where(known, vocab.inside(count, of), 0.0)):
                total = np.concatenate([[0], np.cumsum(x)])
                sums.append(total[starts[1:]] - total[starts[:-1]])
            short = of.astype("<i4")
            rare = [values[a:b][~known[a:b]].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            classes = [short[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(classes, pa.binary()), pa.array(rare, pa.binary()), pa.array(np.diff(starts)), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2])],
                names=["row", "doc_id", "train", "classes", "rare", "n_tokens", "n_known", "base", "inside"],
            )

    return source.mapInArrow(run, schema)


@dataclass
class Hmm:
    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # classes x K


def sequences(batches: Iterator[pa.RecordBatch], at: int, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Class sequences of some rows together, about ``most`` tokens of them, and where each begins."""
    for batch in batches:
        held: list[np.ndarray] = []
        size = 0
        for x in batch.column(at):
            held.append(np.frombuffer(x.as_buffer(), "<i4"))
            size += len(held[-1])
            if size >= most:
                yield np.concatenate(held), np.concatenate([[0], np.cumsum([len(h) for h in held])])
                held, size = [], 0
        if held:
            yield np.concatenate(held), np.concatenate([[0], np.cumsum([len(h) for h in held])])


def in_windows(flat: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Matrices of windows of equal length, and whether each begins its row; a row's windows share one token, so they hold every move once."""
    lengths, step = np.diff(starts), WINDOW - 1
    full = np.maximum(lengths - 1, 0) // step
    place = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
    begin = np.repeat(starts[:-1], full) + place * step
    for i in range(0, len(begin), 4096):
        yield flat[begin[i : i + 4096, None] + np.arange(WINDOW)], place[i : i + 4096] == 0
    rest, begin = lengths - full * step, starts[:-1] + full * step
    rest = np.where((rest == 1) & (full > 0), 0, rest)
    for n in np.unique(rest[rest > 0]):
        yield flat[begin[rest == n][:, None] + np.arange(n)], full[rest == n] == 0


def stationary(move: np.ndarray) -> np.ndarray:
    """The distribution that the moves leave as it is."""
    p = np.full(len(move), 1 / len(move))
    for _ in range(200):
        p = p @ move
    return (p / p.sum()).astype(move.dtype)


def expected(model: Hmm, ids: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch expected counts of start states, moves and posteriors (tokens x K, in the order of ``ids.T``), and the log likelihood.

    ``first``: whether each window begins its text (None: all do); the first token of one that doesn't is the last of the window before and counts there.
    """
    n, length = ids.shape
    later = np.zeros(n, bool) if first is None else ~first
    begin = np.where(later[:, None], stationary(model.move), model.start) if later.any() else model.start
    k = len(model.start)
    b = model.emit[ids.T]  # length x n x K
    alpha = np.empty((length, n, k), b.dtype)
    scale = np.empty((length, n), b.dtype)
    for t in range(length):
        a = b[t] * (begin if t == 0 else alpha[t - 1] @ model.move)
        scale[t] = a.sum(1)
        alpha[t] = a / scale[t][:, None]
    beta = np.ones((n, k), b.dtype)
    moves = np.zeros((k, k))
    back = model.move.T.copy()
    for t in range(length - 1, 0, -1):
        weighted = b[t] * beta / scale[t][:, None]
        moves += alpha[t - 1].T @ weighted
        beta = weighted @ back
        b[t] = weighted  # keeps b * beta / scale
    # posterior: alpha * beta; beta of t is (weighted of t + 1) @ move.T
    for t in range(length - 1):
        alpha[t] *= b[t + 1] @ back
    alpha[0][later], scale[0][later] = 0, 1
    return alpha[0].sum(0), moves * model.move, alpha.reshape(-1, k), float(np.log10(scale).sum(dtype=np.float64))


def expectation(rows: DataFrame, held, size: int, k: int) -> DataFrame:
    """(part, counts): sums over all training rows of expected counts, a row for each slice of the parameters."""
    schema = "part int, counts binary"
    step = 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Hmm = held.value
        emit, start, move, likelihood, seen = np.zeros((size, k)), np.zeros(k), np.zeros((k, k)), 0.0, 0
        for flat, starts in sequences(batches, 0):
            for ids, first in in_windows(flat, starts):
                s, m, posterior, like = expected(model, ids, first)
                order = ids.T.ravel()
                for j in range(k):
                    emit[:, j] += np.bincount(order, posterior[:, j], size)
                start, move, likelihood, seen = start + s, move + m, likelihood + like, seen + ids.size - int((~first).sum())
        if not seen:
            return
        parts = [emit[i : i + step] for i in range(0, size, step)] + [np.concatenate([start, move.ravel(), [likelihood, seen]])]
        yield pa.record_batch([pa.array(np.arange(len(parts)), pa.int32()), pa.array([p.astype("<f8").tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    return added(rows.where("train").select("classes").mapInArrow(run, schema), "<f8")


def added(parts: DataFrame, kind: str) -> DataFrame:
    """Sum binary vectors by part."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(raw.as_buffer(), kind)
                total[part] = total[part] + own if part in total else own
        if total:
            keys = sorted(total)
            yield pa.record_batch([pa.array(keys, pa.int32()), pa.array([total[x].tobytes() for x in keys], pa.binary())], names=["part", "counts"])

    return parts.repartition("part").mapInArrow(add, "part int, counts binary")


def neighbours(rows: DataFrame, size: int, marks: int) -> DataFrame:
    """(part, counts): for each class, how often each mark (frequent class, or hash of a class) stands right before and after it."""
    schema = "part int, counts binary"
    step = 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((size, 2 * marks), np.int64)
        seen = 0
        for flat, _ in sequences(batches, 0, 1 << 21):
            mark = np.where(flat < marks // 2, flat, marks // 2 + flat % (marks - marks // 2)).astype(np.int64)
            for a, b, shift in ((flat[1:], mark[:-1], 0), (flat[:-1], mark[1:], marks)):
                counts += np.bincount(a.astype(np.int64) * (2 * marks) + shift + b, minlength=counts.size).reshape(counts.shape)
            seen += len(flat)
        if seen:
            parts = [counts[i : i + step] for i in range(0, size, step)]
            yield pa.record_batch([pa.array(np.arange(len(parts)), pa.int32()), pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    return added(rows.where("train").select("classes").mapInArrow(run, schema), "<i8")


def beginning(counts: np.ndarray, total: np.ndarray, k: int, seed: int = 0) -> Hmm:
    """States from a clustering of classes by the square roots of their neighbours' shares (weighted k-means)."""
    rng = np.random.default_rng(seed)
    x = np.sqrt((counts + 1e-3) / (counts.sum(1, keepdims=True) + 1e-3 * counts.shape[1]))
    weight = np.sqrt(total.astype(float) + 1)
    centres = x[rng.choice(len(x), 1, p=weight / weight.sum())]
    while len(centres) < k:  # k-means++
        far = ((x[:, None] - centres[None]) ** 2).sum(2).min(1) * weight
        centres = np.vstack([centres, x[rng.choice(len(x), 1, p=far / far.sum() if far.sum() else weight / weight.sum())]])
    for _ in range(15):
        of = ((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)).argmin(1)
        for j in range(k):
            if (of == j).any():
                centres[j] = np.average(x[of == j], 0, weight[of == j])
    share = (total + SMOOTH) / (total + SMOOTH).sum()
    emit = np.full((len(x), k), 0.15) * share[:, None]
    emit[np.arange(len(x)), of] += share * (1 + 0.1 * rng.random(len(x)))
    emit /= emit.sum(0)
    move = np.full((k, k), 1.0 / k) + np.eye(k) * 0.5 + 0.05 * rng.random((k, k))
    return Hmm(np.full(k, 1.0 / k), move / move.sum(1, keepdims=True), emit)


def gathered(df: DataFrame, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(bytes(r["counts"]), kind) for r in sorted(df.collect(), key=lambda r: r["part"])]


def reestimate(parts: list[np.ndarray], share: np.ndarray, k: int) -> tuple[Hmm, float]:
    emit = np.concatenate(parts[:-1]).reshape(-1, k)
    start, move = parts[-1][:k], parts[-1][k : k + k * k].reshape(k, k)
    emit = emit + 2.0 * share[:, None] + 1e-3 / len(emit)  # a little of the words' overall shares in every state
    start, move = start + 1.0, move + 1.0
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)), float(parts[-1][-2] / max(1.0, parts[-1][-1]))


def train(rows: DataFrame, vocab: Vocabulary, k: int, rounds: int, seed: int = 0, marks: int = 32) -> tuple[Hmm, list[float]]:
    """Baum-Welch on ``encoded`` rows; returns the model and each round's log10 likelihood a token."""
    context = rows.sparkSession.sparkContext
    size = len(vocab.class_total)
    parts = gathered(neighbours(rows, size, marks), "<i8")
    if not parts:
        share = np.full(size, 1 / size)
        return Hmm(np.full(k, 1 / k), np.full((k, k), 1 / k), np.repeat(share[:, None], k, 1)), []
    share = (vocab.class_total + SMOOTH) / (vocab.class_total + SMOOTH).sum()
    model, likelihoods = beginning(np.concatenate(parts).reshape(size, 2 * marks).astype(float), vocab.class_total, k, seed), []
    for _ in range(rounds):
        single = Hmm(model.start.astype(np.float32), model.move.astype(np.float32), model.emit.astype(np.float32))
        held = context.broadcast(single)
        model, likelihood = reestimate(gathered(expectation(rows, held, size, k), "<f8"), share, k)
        likelihoods.append(likelihood)
        held.unpersist()
    return model, likelihoods


def forward(model: Hmm, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Exact log10 likelihood of each class sequence by the scaled forward recursion, all sequences a step at a time."""
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = starts[:-1][order], lengths[order]
    total = np.zeros(len(order))
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")  # sequences longer than t
    alpha = None
    for t, n in enumerate(active.tolist()):
        b = model.emit[flat[begin[:n] + t]]
        alpha = b * model.start if t == 0 else (alpha[:n] @ model.move) * b
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(order))
    out[order] = total
    return out


def scored(rows: DataFrame, held) -> DataFrame:
    """``encoded`` rows with ``hmm``, the exact log10 likelihood of their classes, in place of these."""
    schema = "row long, doc_id long, train boolean, rare binary, n_tokens long, n_known long, base double, inside double, hmm double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column(3)]
            if not classes:
                continue
            likelihood = forward(held.value, np.concatenate(classes), np.concatenate([[0], np.cumsum([len(c) for c in classes])]))
            yield pa.record_batch([*batch.columns[:3], *batch.columns[4:], pa.array(likelihood)], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))
    return rows.select("row", "doc_id", "train", "classes", "rare", "n_tokens", "n_known", "base", "inside").mapInArrow(run, schema)


def rare_words(rows: DataFrame) -> DataFrame:
    """(row, word, times): each row's words that are not among the known ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.unique(np.frombuffer(x.as_buffer(), np.uint64), return_counts=True) for x in batch.column(1)]
            lengths = [len(w) for w, _ in held]
            if sum(lengths):
                row = np.repeat(batch.column(0).to_numpy(), lengths)
                words, times = np.concatenate([w for w, _ in held]), np.concatenate([t for _, t in held])
                yield pa.record_batch([pa.array(row), pa.array(words.view(np.int64)), pa.array(times.astype(np.int32))], names=["row", "word", "times"])

    return rows.select("row", "rare").mapInArrow(run, "row long, word long, times int")


def score(docs: DataFrame, train_rows, k: int = 12, rounds: int = 6, n_frequent: int = 16_384, n_buckets: int = 1024, n_known: int = 262_144, seed: int = 0) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for every row of (doc_id, text).

    ``train_rows``: a column expression that tells the training rows.  ``k`` states, ``rounds`` of Baum-Welch.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    narrow(spark)
    marked = docs.select("doc_id", F.coalesce(train_rows, F.lit(True)).alias("train"), "text")
    counts = kept(word_counts(marked.where("train")))
    vocab = vocabulary(counts, n_frequent, n_buckets, n_known)
    held = context.broadcast(vocab)
    rows = kept(encoded(marked, held))
    model, _ = train(rows, vocab, k, rounds, seed)
    known = scored(rows, context.broadcast(model))
    # the words that are not broadcast: their counts come by a join, and their shares are summed by row
    rare = rare_words(rows).join(counts, "word", "left")
    count = F.coalesce("n", F.lit(0))
    bucket = F.pmod(F.shiftrightunsigned("word", 8), F.lit(n_buckets))
    totals = np.column_stack([np.arange(n_buckets), vocab.class_total[vocab.n_frequent :], vocab.class_kinds[vocab.n_frequent :]])
    classes = spark.createDataFrame(totals.tolist(), "bucket long, total long, kinds long")
    rare = rare.withColumn("bucket", bucket.cast("long")).join(F.broadcast(classes), "bucket")
    base = F.log10((count + SMOOTH) / F.lit(vocab.total + SMOOTH * (vocab.kinds + 1)))
    inside = F.log10((count + SMOOTH) / (F.col("total") + SMOOTH * (F.col("kinds") + 1)))
    sums = rare.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("k"), F.sum(F.col("times") * base).alias("b"), F.sum(F.col("times") * inside).alias("i")
    )
    zero = F.lit(0.0)
    return known.join(sums, "row", "left").select(
        "doc_id",
        "train",
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("hmm") + F.col("inside") + F.coalesce("i", zero)).alias("score"),
    )
