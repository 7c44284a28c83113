"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained on a bounded sample of labelled texts.  A text is cut into blocks; each block is
compressed alone with either dictionary, so that the dictionary keeps its weight in long texts.  The difference of the two
summed sizes over the text's size is the one input of a logistic regression, on labelled texts that the dictionaries have not seen; its probability of label 1 is the score.

The sample is fitted in one task (it is bounded by ``most`` texts of each label and ``most_chars`` characters a text), so no text goes to the driver.

Defined results: null and empty texts have difference 0 and so the calibrated score of it; repeated rows are scored each on their own; of rows that repeat a labelled id the sample takes the smallest text;
labels that are null are ignored, an id with both labels takes part with either; equal texts have equal scores;
without labelled texts of both kinds the score is the share of label 1 (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.text import column_bytes, narrow, sample, slices, trim

BLOCK = 512


@dataclass
class Model:
    good: bytes
    bad: bytes
    weight: float = 0.0
    offset: float = 0.0
    level: int = 3

    def difference(self):
        """A function from the bytes of a text to the normalised difference of its compressed sizes."""
        import zstandard as zstd

        if not self.good or not self.bad:
            return lambda text: 0.0
        with_dict = []
        for raw in (self.good, self.bad):
            d = zstd.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.level)
            with_dict.append(zstd.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
        good, bad = with_dict

        def normalised(text: bytes) -> float:
            g = b = 0
            for i in range(0, len(text), BLOCK):
                block = text[i : i + BLOCK]
                g += len(good.compress(block))
                b += len(bad.compress(block))
            return (b - g) / len(text) if text else 0.0

        return normalised

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(difference * self.weight + self.offset, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Weight and offset of a logistic regression on one input, by Newton's method on the scaled input."""
    middle, scale = x.mean(), max(x.std(), 1e-9)
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    w, penalty = np.zeros(2), np.diag([ridge * len(y), 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * middle / scale)


def fit(texts: dict[int, list[bytes]], shares: tuple[int, int], dictionary: int = 64 * 1024) -> Model:
    """Dictionaries from every other text of each label (0, 1), the calibration from the rest; ``shares``: how many labels of each kind there are in all."""
    import zstandard as zstd

    if min(map(len, texts.values())) < 8:
        return Model(b"", b"", offset=float(np.log((shares[1] + 1) / (shares[0] + 1))))
    trained = {}
    for label, own in texts.items():
        blocks = [t[i : i + BLOCK] for t in own[::2] for i in range(0, len(t), BLOCK)]
        blocks = [b for b in blocks if len(b) >= 64]
        try:
            trained[label] = zstd.train_dictionary(min(dictionary, max(4096, sum(map(len, blocks)) // 10)), blocks).as_bytes()
        except zstd.ZstdError:  # too little text to train on: the text itself as a plain dictionary
            trained[label] = b"".join(own[::2])[-dictionary:]
    model = Model(trained[1], trained[0])
    difference = model.difference()
    x = np.array([difference(t) for label in (0, 1) for t in texts[label][1::2]])
    y = np.array([label for label in (0, 1) for _ in texts[label][1::2]], float)
    model.weight, model.offset = logistic(x, y)
    # the sample holds the labels evenly where there are plenty; the offset is moved to their shares among all labelled rows
    model.offset += float(np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return model


def train(docs: DataFrame, labels: DataFrame, most: int = 4000, most_chars: int = 100_000, dictionary: int = 64 * 1024, seed: int = 0, most_total: int = 24_000_000) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label).

    The sample has at most ``most`` ids of each label, those first in a seeded hash order, with texts of ``most_chars`` characters at most (a longer text leaves its id out of the sample, not out of what is scored),
    and of these the first in that order that have ``most_total`` characters together, at most, so that one task can hold them.
    Half of it trains the dictionaries, the other half the calibration.
    """
    clean = labels.where("label in (0, 1)")
    ids = sample(clean.where("label = 0"), most, seed).unionByName(sample(clean.where("label = 1"), most, seed)).select("doc_id", "label").distinct()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= most_chars)
    lengths = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.max(F.length("text")).alias("length"))  # ``most`` rows a label
    up_to = Window.partitionBy("label").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    ids = lengths.withColumn("_sum", F.sum("length").over(up_to)).where(F.col("_sum") <= most_total).select("doc_id", "label")
    found = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    counts = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    shares = counts.get(0, 0), counts.get(1, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(r["doc_id"], r["label"], r["text"].encode()) for batch in batches for r in batch.to_pylist()]
        held.sort(key=lambda r: (r[0] * 0x9E3779B97F4A7C15 % 2**64, r[2]))
        m = fit({label: [t for _, own, t in held if own == label] for label in (0, 1)}, shares, dictionary)
        yield pa.record_batch([pa.array([m.good], pa.binary()), pa.array([m.bad], pa.binary()), pa.array([m.weight]), pa.array([m.offset])], names=["good", "bad", "weight", "offset"])
        trim()

    # one task holds the bounded sample; it gives a model even for no rows
    r = found.repartition(1).mapInArrow(run, "good binary, bad binary, weight double, offset double").first()
    return Model(bytes(r["good"]), bytes(r["bad"]), r["weight"], r["offset"]) if r else fit({0: [], 1: []}, shares)


def score(docs: DataFrame, model: Model, columns: list[str | Column], text: str = "text") -> DataFrame:
    """The named columns of ``docs``, ``difference`` and ``score`` (probability of label 1) for every whole text."""
    narrow(docs.sparkSession)
    chosen = docs.select(*columns, F.col(text).alias("_text"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("difference", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = model.difference()
        for batch in slices(batches, "_text"):
            raw, at = column_bytes(batch.column(batch.num_columns - 1))
            body = raw.tobytes()
            x = np.array([difference(body[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
            yield pa.record_batch([*batch.columns[:-1], pa.array(x), pa.array(model.probability(x))], names=schema.names)

    return chosen.mapInArrow(run, schema)
