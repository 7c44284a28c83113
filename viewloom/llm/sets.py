"""What the two set-similarity joins share: sets of units, a frequency sketch, keys of prefixes, exact verification, components.

A unit (a document, a line) is a set of 64-bit token values.  Equal sets are one *node*, known by a 64-bit signature.  A global order of
tokens, from rare to frequent, comes from a sketch of ``WIDTH`` counters that every task fills over all units and Spark adds up; its size does not grow
with the corpus.  Any order that all units share makes the prefix filter exact, so the sketch decides speed alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.text import forget, kept, mix

WIDTH = 1 << 22
PARTS = 64


def slots(tokens: np.ndarray) -> np.ndarray:
    """The sketch's counter of each token."""
    return (tokens >> np.uint64(42)).astype(np.int64)


def packed(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A sketch as compressed slices, empty ones left out."""
    import zstandard as zstd

    press = zstd.ZstdCompressor(level=1)
    step = WIDTH // PARTS
    for i in range(PARTS):
        own = counts[i * step : (i + 1) * step]
        if own.any():
            kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if int(own.max()) <= np.iinfo(k).max)
            yield i, kind.encode() + press.compress(own.astype(kind).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    import zstandard as zstd

    return np.frombuffer(zstd.ZstdDecompressor().decompress(raw[3:]), raw[:3].decode()).astype(np.int64)


def frequency(parts: DataFrame) -> np.ndarray:
    """Add up the slices (part, counts) of all tasks; the sum is ``WIDTH`` counters, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + unpacked(raw)
        if total:
            keys = sorted(total)
            yield pa.record_batch([pa.array(keys, pa.int32()), pa.array([np.minimum(total[k], 2**32 - 1).astype("<u4").tobytes() for k in keys], pa.binary())], names=["part", "counts"])

    out, step = np.zeros(WIDTH, np.uint32), WIDTH // PARTS
    for r in parts.select("part", "counts").repartition("part").mapInArrow(add, "part int, counts binary").collect():
        out[r["part"] * step : (r["part"] + 1) * step] = np.frombuffer(bytes(r["counts"]), "<u4")
    return out


def rare_first(tokens: np.ndarray, starts: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of each row, given ascending, from rare to frequent (ties by value), and their counters."""
    count = sketch[slots(tokens)]
    order = np.empty(len(tokens), np.int64)
    for i in range(0, len(starts) - 1, 1 << 16):
        own = starts[i : i + (1 << 16) + 1]
        a, b = own[0], own[-1]
        owner = np.repeat(np.arange(len(own) - 1, dtype=np.uint64), np.diff(own))
        key = (owner << np.uint64(48)) | (np.minimum(count[a:b], 65_535).astype(np.uint64) << np.uint64(32)) | (tokens[a:b] >> np.uint64(32))
        place = np.argsort(key)
        key = key[place]
        tied = np.flatnonzero(key[1:] == key[:-1])
        if len(tied):  # the whole tokens decide, so that all rows agree
            among = np.unique(np.concatenate([tied, tied + 1]))
            place[among] = place[among][np.lexsort((tokens[a:b][place[among]], key[among]))]
        order[a:b] = place + a
    return tokens[order], count[order]


def rare_sets(values: np.ndarray, starts: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values of each row, from rare to frequent (ties by value), where each row's begin, and their counters.  One sort does both."""
    found, cuts, counts = [], [np.zeros(1, np.int64)], []
    for i in range(0, len(starts) - 1, 1 << 16):
        own = starts[i : i + (1 << 16) + 1]
        tokens = values[own[0] : own[-1]]
        owner = np.repeat(np.arange(len(own) - 1, dtype=np.uint64), np.diff(own))
        count = sketch[slots(tokens)]
        key = (owner << np.uint64(48)) | (np.minimum(count, 65_535).astype(np.uint64) << np.uint64(32)) | (tokens >> np.uint64(32))
        place = np.argsort(key)
        key, t = key[place], tokens[place]
        tied = key[1:] == key[:-1]
        if (odd := tied & (t[1:] != t[:-1])).any():  # unlike values that the key doesn't tell apart
            group = np.concatenate([[0], np.cumsum(~tied)])
            among = np.flatnonzero(np.isin(group, group[1:][odd]))
            place[among] = place[among][np.lexsort((t[among], group[among]))]
            t = tokens[place]
        keep = np.ones(len(t), bool)
        keep[1:] = ~tied | (t[1:] != t[:-1])
        found.append(t[keep])
        counts.append(count[place[keep]])
        cuts.append(cuts[-1][-1] + np.cumsum(np.bincount(owner[place[keep]].astype(np.int64), minlength=len(own) - 1)))
    none = values[:0]
    return np.concatenate([none, *found]), np.concatenate(cuts), np.concatenate([np.zeros(0, sketch.dtype), *counts])


def ascending(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, ascending, and where each row's begin."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, owner))
    v = values[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (owner[1:] != owner[:-1])  # rows keep their order, so owner is sorted as it is
    return v[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(starts) - 1))])


def signatures_128(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit signatures of each row's set."""
    out = []
    for k in (0x51ED270B9F652295, 0xA0761D6478BD642F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ np.uint64(k)), dtype=np.uint64)])
        out.append(mix(total[starts[1:]] - total[starts[:-1]] + np.diff(starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out[0], out[1]


def signatures(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit signature of each row's set: sums of mixed values, mixed with the set's size; 0 for the empty set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ np.uint64(0x51ED270B9F652295)), dtype=np.uint64)])
    n = np.diff(starts)
    out = mix(total[starts[1:]] - total[starts[:-1]] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(n > 0, out, np.uint64(0)).view(np.int64)


def blobs(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Rows of a flat array as binary."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((np.asarray(starts) * width).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A binary column as one flat array, and where each row's values begin."""
    from viewloom.llm.text import column_bytes

    raw, at = column_bytes(column)
    return raw.view(kind), at // np.dtype(kind).itemsize


#: Bits of a Bloom filter: 24 for each row, a power of two between these.
BLOOM_LEAST, BLOOM_MOST = 20, 27


def bloom(nodes: DataFrame, rows: int = 1 << 20) -> np.ndarray:
    """A Bloom filter over (node) for about so many rows, packed: it spares work where few nodes are wanted and is right at any fill."""
    import zstandard as zstd

    n = 1 << min(max(BLOOM_LEAST, (24 * rows).bit_length()), BLOOM_MOST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(n // 8, np.uint8)
        for batch in batches:
            for x in _bits(batch.column(0).to_numpy(), n):
                np.bitwise_or.at(bits, x >> 3, (1 << (x & 7)).astype(np.uint8))
        if bits.any():
            yield pa.record_batch([pa.array([zstd.compress(bits.tobytes(), 1)], pa.binary())], names=["bits"])

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(n // 8, np.uint8)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                bits |= np.frombuffer(zstd.decompress(raw), np.uint8)
        if bits.any():
            yield pa.record_batch([pa.array([zstd.compress(bits.tobytes(), 1)], pa.binary())], names=["bits"])

    out = np.zeros(n // 8, np.uint8)
    # a filter a task at most, added in a few tasks before the driver sees them
    for r in nodes.select("node").mapInArrow(run, "bits binary").repartition(8).mapInArrow(either, "bits binary").collect():
        out |= np.frombuffer(zstd.decompress(bytes(r["bits"])), np.uint8)
    return out


def _bits(nodes: np.ndarray, n: int) -> list[np.ndarray]:
    v, shift = nodes.view(np.uint64), np.uint64(64 - (n.bit_length() - 1))
    return [(mix(v + np.uint64(k)) >> shift).astype(np.int64) for k in (1, 2, 3)]


def in_bloom(bits: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    out = np.ones(len(nodes), bool)
    for x in _bits(nodes, 8 * len(bits)):
        out &= (bits[x >> 3] >> (x & 7)).astype(np.uint8) & 1 == 1
    return out


def overlaps(pairs: pa.RecordBatch, a: int, b: int) -> np.ndarray:
    """Sizes of the intersections of two binary columns of ascending 64-bit values."""
    x, xs = flat(pairs.column(a), "<u8")
    y, ys = flat(pairs.column(b), "<u8")
    out = np.zeros(pairs.num_rows, np.int64)
    for i in range(pairs.num_rows):
        p, q = x[xs[i] : xs[i + 1]], y[ys[i] : ys[i + 1]]
        if len(p) > len(q):
            p, q = q, p
        if len(q):
            at = np.minimum(np.searchsorted(q, p), len(q) - 1)
            out[i] = (q[at] == p).sum()
    return out


def verified(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) whose sets' Jaccard similarity is at least numerator / denominator; ``sets``: (node, tokens), one row a node."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = overlaps(batch, 2, 3)
                sizes = sum(np.diff(flat(batch.column(k), "<u8")[1]) for k in (2, 3))
                keep = pa.array(denominator * both >= numerator * (sizes - both))
                yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): for each node of the edges (a, b) the smallest node of its component, by alternating large and small stars.

    Every round is written to the shared folder, so a lost executor costs that round at most.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, state = kept(edges), None
    written = [now]
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(root.select("a", F.col("m").alias("b")))
        now = kept(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        written.append(now)
        got = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == (got["n"], got["x"]):
            break
        state = (got["n"], got["x"])
    else:
        raise RuntimeError("components did not settle")
    forget(edges.sparkSession, *written[:-1])
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def split_rows(spark: SparkSession, units: Callable[[pa.RecordBatch], tuple[list[pa.Array], np.ndarray, np.ndarray]], names: list[str], fields: str, docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """One pass over the texts: a written table of units (``fields``, node, n), and the sketch of all their tokens.

    ``units`` gives, for a batch, the columns of its units and their distinct tokens.
    """
    from viewloom.llm.text import slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(WIDTH, np.int64)
        for batch in slices(batches, "text"):
            columns, tokens, starts = units(batch)
            np.add.at(counts, slots(tokens), 1) if len(tokens) < 1000 else np.add(counts, np.bincount(slots(tokens), minlength=WIDTH), out=counts)
            n = len(starts) - 1
            yield pa.record_batch([*columns, pa.array(signatures(tokens, starts)), pa.array(np.diff(starts)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=[*names, "node", "n", "part", "counts"])
        found = list(packed(counts))
        if found:
            empty = [pa.nulls(len(found), c.type) for c in schema[: len(names)]]
            yield pa.record_batch(
                [*empty, pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64()), pa.array([i for i, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())],
                names=[*names, "node", "n", "part", "counts"],
            )

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    whole = f"{fields}, node long, n long, part int, counts binary"
    schema = list(to_arrow_schema(_parse_datatype_string(whole)))
    table = kept(docs.mapInArrow(run, whole))
    return table.where("part is null").drop("part", "counts"), frequency(table.where("part is not null"))
