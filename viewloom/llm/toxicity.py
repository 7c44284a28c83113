"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed letter runs and their beginnings is trained in numpy from confirmed toxic texts and unlabelled
texts.  The risk is the class-prior-corrected estimate

    prior * E_pos[loss(+g)] + max(0, E_unl[loss(-g)] - prior * E_pos[loss(-g)])

with the logistic loss; while the second part is negative its gradient is reversed, which keeps the classifier from
fitting the positives by declaring the unlabelled ones negative.  A logistic calibration on labelled texts kept out of training
maps the raw score to a probability.

Defined results: null and empty texts have no features and get the calibrated score of the offset; repeated rows are scored each on
their own; null labels are ignored; without positives every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.text import _hash_spans, column_bytes, kept, narrow, sample, slices, word_spans

BITS = 20
#: Bytes that part letter runs: all of ASCII but letters, digits and the apostrophe.
APART = np.array([b < 128 and not (chr(b).isalnum() or b == 39) for b in range(256)])


#: Word beginnings of so many bytes are features beside whole words; each feature counts as seen once, twice and three times or more.
BEGINNINGS = (4, 5, 6, 7)
LEVELS = 3


def features(column: pa.Array, use: np.ndarray | None = None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The features of each row, ascending, and where each row's begin.

    A feature is ``LEVELS`` * hash of a letter run or beginning, plus 0, 1 or 2 for the count that it reaches.  ``use``: the hashes that matter.
    """
    raw, at = column_bytes(column)
    start, end = word_spans(raw, at, APART)
    rows = np.searchsorted(start, at[1:-1], "left") if len(at) > 2 else np.zeros(0, np.int64)
    owner = np.zeros(len(start), np.int64)
    np.add.at(owner, rows[rows < len(start)], 1)
    owner = np.cumsum(owner)
    shift, keys = np.uint64(64 - bits), []
    for k in (None, *BEGINNINGS):
        fits = slice(None) if k is None else np.flatnonzero(end - start > k)
        stop = end if k is None else start[fits] + k
        found = (_hash_spans(raw, start[fits], stop, True) * np.uint64(2 * (k or 0) + 1) >> shift).astype(np.int64)
        keep = slice(None) if use is None else use[found]
        keys.append((owner[fits][keep] << bits) | found[keep])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    out = np.concatenate([key[count > n] * LEVELS + n for n in range(LEVELS)])
    out.sort()
    wide = LEVELS << bits
    return out % wide, np.searchsorted(out, np.arange(len(at)) * wide)


def row_sums(weights: np.ndarray, found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the found features' weights by row."""
    total = np.concatenate([[0.0], np.cumsum(weights[found])])
    return total[at[1:]] - total[at[:-1]]


@dataclass
class Model:
    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    loss: list[float] = field(default_factory=list)

    def raw(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        return row_sums(self.weights, found, at) + self.offset

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -40, 40)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int = LEVELS << BITS, rounds: int = 300, rate: float = 0.05, decay: float = 2e-4, least: int = 5) -> Model:
    """Train on lists of distinct features; ``least``: positive texts that a feature must be in."""
    np_, nu = len(positive), len(unlabelled)
    rows = [*positive, *unlabelled]
    flat = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    seen = np.bincount(flat[owner < np_], minlength=size)
    use = np.flatnonzero(seen >= least)
    place = np.full(size, -1)
    place[use] = np.arange(len(use))
    col = place[flat]
    owner, col = owner[col >= 0], col[col >= 0]
    sign = np.concatenate([np.ones(np_), np.zeros(nu)]).astype(bool)
    w, b = np.zeros(len(use)), float(np.log(prior / (1 - prior)))
    moments = np.zeros((2, len(use) + 1))
    model = Model(np.zeros(size), b)
    soft = lambda x: np.logaddexp(0, x)
    for step in range(1, rounds + 1):
        g = np.bincount(owner, w[col], len(rows)) + b
        p = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
        r_plus, r_minus = prior * soft(-g[sign]).mean(), soft(g[~sign]).mean() - prior * soft(g[sign]).mean()
        model.loss.append(float(r_plus + max(0.0, r_minus)))
        d = np.zeros(len(rows))
        if r_minus >= 0:
            d[sign] = prior * (p[sign] - 1) / np_ - prior * p[sign] / np_
            d[~sign] = p[~sign] / nu
        else:  # the corrected part went below zero: step back on it alone
            d[sign] = prior * p[sign] / np_
            d[~sign] = -p[~sign] / nu
        grad = np.append(np.bincount(col, d[owner], len(use)) + decay * w, d.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.999 * moments[1] + 0.001 * grad**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    model.weights[use], model.offset = w, float(b)
    return model


def telling(rows: DataFrame, n_positive: int, n_unlabelled: int, most: int = 8192, least: int = 5) -> np.ndarray:
    """Hashes that are at least twice as frequent in positive as in unlabelled rows of (kinds, text), ``most`` at most."""
    schema = "feature long, positive long, unlabelled long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, LEVELS << BITS), np.int32)
        for batch in slices(batches, "text"):
            found, at = features(batch.column(1))
            for i, kinds in enumerate(batch.column(0).to_pylist()):
                own = found[at[i] : at[i + 1]]
                if 1 in kinds:
                    count[0, own] += 1
                if -1 in kinds:
                    count[1, own] += 1
        some = np.flatnonzero(count[0])
        yield pa.record_batch([pa.array(some), pa.array(count[0][some].astype(np.int64)), pa.array(count[1][some].astype(np.int64))], names=["feature", "positive", "unlabelled"])

    sums = rows.select("kinds", "text").mapInArrow(run, schema).groupBy("feature").agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
    ratio = F.log(((F.col("p") + 0.5) / n_positive) / ((F.col("u") + 0.5) / n_unlabelled))
    best = sums.where(F.col("p") >= least).withColumn("r", ratio).where(F.col("r") >= float(np.log(2))).orderBy(-F.col("r") * F.sqrt("p"), "feature").limit(most)
    use = np.zeros(1 << BITS, bool)
    use[[r["feature"] // LEVELS for r in best.select("feature").collect()]] = True
    return use


def with_features(rows: DataFrame, columns: list[str], use: np.ndarray, text: str = "text") -> DataFrame:
    """The named columns and the features of the text as little-endian 32-bit bytes."""
    chosen = rows.select(*columns, F.col(text).alias("_text"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("features", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found, at = features(batch.column(batch.num_columns - 1), use)
            found = found.astype("<u4")
            packed = pa.array([found[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.record_batch([*batch.columns[:-1], packed], names=schema.names)

    return chosen.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, most_positive: int = 6000, most_unlabelled: int = 18_000, seed: int = 0) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label: 1 toxic, 0 not, null unknown).

    Bounded samples in a seeded hash order: ``most_positive`` texts labelled 1, as many labelled 0 for the calibration alone, and ``most_unlabelled``
    texts of ``docs`` whose labels are not looked at.  A quarter of the positives is kept for the calibration.  The class prior is the share of label 1
    among the labelled rows.
    """
    clean = labels.where("label in (0, 1)")
    counts = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    if not counts.get(1):
        return Model(np.zeros(LEVELS << BITS), 0.0, 0.0, -40.0)
    prior = min(0.5, max(1e-4, counts[1] / sum(counts.values())))
    kinds = {
        1: sample(clean.where("label = 1"), most_positive, seed).select("doc_id"),
        0: sample(clean.where("label = 0"), most_positive, seed).select("doc_id"),
        -1: sample(docs.select("doc_id"), most_unlabelled, seed + 1).select("doc_id"),
    }
    ids = None
    for kind, rows in kinds.items():
        rows = rows.distinct().select("doc_id", F.lit(kind).alias("kind"))
        ids = rows if ids is None else ids.unionByName(rows)
    ids = ids.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))
    # an id that stands in many rows gives its smallest text alone, so the sample is bounded in rows too
    chosen = kept(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("kinds").alias("kinds")))
    number = {k: chosen.where(F.array_contains("kinds", k)).count() for k in (1, -1)}
    use = telling(chosen, max(1, number[1]), max(1, number[-1]))
    found = with_features(chosen, ["doc_id", "kinds"], use).collect()
    found = sorted(((r["doc_id"] * 0x9E3779B97F4A7C15 % 2**64, set(r["kinds"]), bytes(r["features"])) for r in found), key=lambda x: (x[0], x[2]))
    rows = {k: [np.frombuffer(x[2], "<u4") for x in found if k in x[1]] for k in kinds}
    cut = max(1, len(rows[1]) // 4) if len(rows[1]) > 3 else 0
    model = fit(rows[1][cut:], rows[-1], prior)
    if cut and rows[0]:
        from viewloom.llm.compression import logistic

        raw = lambda rs: np.array([model.weights[r].sum() + model.offset for r in rs])
        x = np.concatenate([raw(rows[1][:cut]), raw(rows[0])])
        y = np.concatenate([np.ones(cut), np.zeros(len(rows[0]))])
        slope, shift = logistic(x, y, 1e-4)
        # from the sample's share of label 1 to its share among all labelled rows
        shift += float(np.log(prior / (1 - prior)) - np.log(cut / len(rows[0])))
        if slope > 0:
            model.slope, model.shift = slope, shift
    return model


def score(docs: DataFrame, model: Model, columns: list[str | Column], text: str = "text") -> DataFrame:
    """The named columns of ``docs`` and ``score``, the probability that the whole text is toxic."""
    narrow(docs.sparkSession)
    chosen = docs.select(*columns, F.col(text).alias("_text"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        use = own.weights.reshape(-1, LEVELS).any(1)
        for batch in slices(batches, "_text"):
            found, at = features(batch.column(batch.num_columns - 1), use)
            yield pa.record_batch([*batch.columns[:-1], pa.array(own.probability(own.raw(found, at)))], names=schema.names)

    return chosen.mapInArrow(run, schema)
