"""Vectorised text helpers shared by the operators of this subpackage.

Words are the maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``, which for UTF-8 are exactly the
matches of ``[^\\x20\\x09-\\x0D]+``.  A word is known by a 64-bit value, a polynomial over a table of random
64-bit constants; two different words of one corpus share a value with a chance of about 2**-64 a pair.
All helpers work on the raw buffers of an Arrow batch, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import gc
import os
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
_RNG = np.random.default_rng(20240611)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE_LOWER = _TABLE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SHINGLE = [np.uint64(x) for x in (_RNG.integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 1 << 19
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, CHUNK + 4096)
        p, q = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 2**64), np.uint64)
        p[0] = q[0] = 1
        if size > 4 * CHUNK:  # a single giant word: don't keep tables of its length
            return np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
        _POWERS["p"], _POWERS["q"] = np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
    return _POWERS["p"], _POWERS["q"]


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column (null: empty) and its n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_spans(raw: np.ndarray, at: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; a word never crosses a document's edge.  ``apart``: for each byte, is it between words?"""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~apart[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    out, i, table = np.empty(len(start), np.uint64), 0, _TABLE_LOWER if lower else _TABLE
    while i < len(start):
        first = start[i]
        j = max(i + 1, int(np.searchsorted(end, first + CHUNK, "right")))
        piece = table[raw[first : end[j - 1]]]
        power, inverse = _powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * power[: len(piece)], out=total[1:])
        out[i:j] = (total[end[i:j] - first] - total[start[i:j] - first]) * inverse[start[i:j] - first]
        i = j
    return mix(out)


def word_values(column: pa.Array, lower: bool = True, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit values of all words of a column in order, and for each row where its words begin (n + 1 entries)."""
    raw, at = column_bytes(column)
    start, end = word_spans(raw, at, apart)
    return _hash_spans(raw, start, end, lower), np.searchsorted(start, at)


def value_of(word: bytes, lower: bool = True) -> int:
    """The 64-bit value of one word."""
    return int(word_values(pa.array([word]), lower)[0][0])


def windows(values: np.ndarray, at: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Values of all runs of ``width`` words inside each row, and where each row's runs begin.

    A row of fewer words, but one at least, has its whole sequence as its one run.
    """
    n = np.diff(at)
    runs = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(runs)])
    owner = np.repeat(np.arange(len(n)), runs)
    first = at[:-1][owner] + (np.arange(starts[-1]) - starts[:-1][owner])
    out = np.zeros(len(first), np.uint64)
    left = n[owner]
    for k in range(width):
        inside = left > k
        out += np.where(inside, values[np.minimum(first + k, max(len(values) - 1, 0))] if len(values) else 0, np.uint64(k + 1)) * _SHINGLE[k]
    return mix(out), starts


def distinct(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, ascending, and where each row's begin."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, owner)) if len(values) < 200 else _row_sort(values, starts)
    v = values[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[keep], minlength=len(starts) - 1)
    return v[keep], np.concatenate([[0], np.cumsum(counts)])


TOKEN_BITS = 48


def distinct_short(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``distinct`` for many short rows: of the first ``TOKEN_BITS`` bits of the values, as rows are sorted together with these behind their number."""
    shift, most = np.uint64(64 - TOKEN_BITS), 1 << (64 - TOKEN_BITS)
    out, counts = [], []
    for i in range(0, len(starts) - 1, most):
        own = starts[i : i + most + 1]
        owner = np.repeat(np.arange(len(own) - 1, dtype=np.uint64), np.diff(own))
        key = np.sort((owner << np.uint64(TOKEN_BITS)) | (values[own[0] : own[-1]] >> shift))
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        out.append(key << shift)
        counts.append(np.bincount((key >> np.uint64(TOKEN_BITS)).astype(np.int64), minlength=len(own) - 1))
    if not out:
        return values[:0], np.zeros(1, np.int64)
    return np.concatenate(out), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def _row_sort(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    order = np.empty(len(values), np.int64)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        order[a:b] = np.argsort(values[a:b]) + a
    return order


def trim() -> None:
    """Give freed memory back to the system, where the C library knows how to: a worker outlives its tasks."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        return


#: What a worker keeps from one task to the next, by the operator that keeps it; tasks of other operators let it go.
CACHES: dict[str, object] = {}


def narrow(spark: SparkSession, rows: int = 2000) -> None:
    """Rows of whole texts are wide: Arrow batches of ``rows`` at most keep a task's memory small.  A smaller number that is set stays.

    The setting stays for the session, as the operators' results are read after they return.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 22, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, one row at least."""
    for name in [x for x in CACHES if x != keep]:
        del CACHES[name]
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = column_bytes(batch.column(batch.schema.get_field_index(text)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j
        trim()


def sample(rows: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """The rows of at most ``most`` ids (``doc_id``), those first in a seeded hash order.

    Ids are picked from the id column alone, so no text is sorted or sent; the list of ids that is broadcast has ``most`` entries.
    """
    ids = rows.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most)
    return rows.join(F.broadcast(ids), "doc_id")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``, or the context's checkpoint folder; a local one only where neither is set and the session is a local one."""
    root, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not root:
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            root = held.get()
        elif context.master.startswith("local") and not context.master.startswith("local-cluster"):
            root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "viewloom-checkpoints")
        else:
            raise RuntimeError("spark.checkpoint.dir is not set: tables between steps need a folder that all executors share")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def kept(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_in = path
    return out


def release(spark: SparkSession) -> None:
    """Let go of what Spark keeps for plans that nothing refers to any more, shuffle files above all."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.5)  # the cleaner works beside


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove tables written by ``kept`` once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    for folder in (getattr(df, "_kept_in", None) for df in frames):
        if folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
