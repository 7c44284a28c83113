"""Many narrow rows as few packed ones, for shuffles in which a text gives hundreds of rows.

A task sorts its rows by bucket and sends one row a bucket, (bucket, binary, binary, ...), each binary column being a numpy array of all the bucket's
values; records are laid out field by field, as they compress better so.  Spark deals the buckets out and sorts them; a receiving task reads one bucket at a time, so the number of buckets bounds what it holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewloom.llm.text import column_bytes


def bucket_count(spark, words: int) -> int:
    """Buckets for the rows of a corpus of so many words: at least four for each shuffle partition, and one for each 2**20 words."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), words >> 20)


def take_runs(values: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of the given rows, one after the other, and their lengths."""
    begin, n = np.cumsum(lengths) - lengths, lengths[rows]
    return values[np.repeat(begin[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())], n


def pack(bucket: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray | None]], names: list[str]) -> pa.RecordBatch:
    """One row for each bucket.  ``parts``: values, and how many of them each row has (None: one)."""
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    edge = np.concatenate([np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])), [len(own)]]) if len(own) else np.zeros(1, np.int64)
    columns = [pa.array(own[edge[:-1]].astype(np.int32))]
    for values, lengths in parts:
        if lengths is None:
            values, cut = values[order], edge
        else:
            values, n = take_runs(values, lengths, order)
            cut = np.concatenate([[0], np.cumsum(n)])[edge]
        offsets = (cut * values.dtype.itemsize).astype(np.int32)
        data = fields_first(values, cut) if values.dtype.names else np.ascontiguousarray(values).view(np.uint8) if len(values) else b""
        columns.append(pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]))
    return pa.record_batch(columns, names=names)


def fields_first(values: np.ndarray, cut: np.ndarray) -> bytes:
    """The records of each of the pieces between ``cut``, one field of all of them after the other."""
    fields = [np.ascontiguousarray(values[c]) for c in values.dtype.names]
    return b"".join(f[a:b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) for f in fields)


def records(raw: np.ndarray, kind) -> np.ndarray:
    """The array of one packed piece."""
    kind = np.dtype(kind)
    if not kind.names:
        return raw.view(kind).copy()
    out, at = np.empty(len(raw) // kind.itemsize, kind), 0
    for c in kind.names:
        size = len(out) * kind[c].itemsize
        out[c] = raw[at : at + size].view(kind[c])
        at += size
    return out


def packs(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Each bucket of rows that come sorted by bucket, with its arrays of the given types; null is empty."""
    held: list[list[np.ndarray]] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column(0).to_numpy()
        raws = [column_bytes(c) for c in batch.columns[1:]]
        edge = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if held and bucket[a] != current:
                yield current, [np.concatenate(x) for x in zip(*held, strict=True)]
                held = []
            current = int(bucket[a])
            held.extend([records(raw[at[i] : at[i + 1]], kind) for (raw, at), kind in zip(raws, kinds, strict=True)] for i in range(a, b))
    if held:
        yield current, [np.concatenate(x) for x in zip(*held, strict=True)]


def dealt(rows: DataFrame) -> DataFrame:
    """Packed rows with equal buckets in one task, one bucket after the other."""
    return rows.repartition("bucket").sortWithinPartitions("bucket")
