"""Alignment of two tokenizers' ids over the same texts, cut at white-space anchors.

A text with a space before it is encoded by both tokenizers: a byte-level BPE and a sentence-piece model.  Both give a sequence of byte ranges over the same
bytes.  An anchor is a place where a range of either ends, by its bytes, and where the next id of either begins with a space.  Anchors cut a document's
ids into windows, a word or so each.  What a window holds (its groups and its links) depends on its two tuples of ids alone, so it is worked out
once a worker and kept by them; documents are then put together from their windows.

Encoding.  Words between plain spaces are encoded once a worker too: a space after a character that is no white space ends a piece of the byte-level
pre-tokenizer whatever follows, and no entry of the piece model holds a space after another character (its vocabulary is checked; a model with such entries
has its texts encoded whole).  All ids are checked to spell the text's bytes; a text that they don't spell is encoded again as a whole.

Counts.  Each document gives its distinct linked id pairs with their numbers.  Pairs are counted over documents by an aggregation with partial sums; the
``MOST_PAIRS`` most frequent ones go back to the tasks as sorted arrays, the others by a join on the pair, in which no key holds more than that fraction of all
rows; the result is the same at every size.

Defined results: texts that are null, empty, or not spelled by their ids have no tokens: numbers of 0, no groups, no links; repeated rows and ids are documents each on
their own; null ids are kept; texts of any length are aligned whole; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.text import CACHES, _hash_spans, column_bytes, forget, kept, mix, narrow, slices

#: So many of the most frequent id pairs are sent to all tasks, 17 bytes each.
MOST_PAIRS = 500_000
#: Words beyond so many bytes are encoded each time.
LONG_WORD = 64
#: A worker's tables are thinned out beyond so many words, windows, or links of windows.
MOST_WORDS, MOST_LINKS = 400_000, 8_000_000
_SPACE = 32
_ODD = np.random.default_rng(20250117).integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Spelled:
    """The bytes of each id: ``begin`` and ``flat``, and whether they begin with a space."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])
        self.flat = np.frombuffer(b"".join(entries) or b"\0", np.uint8)
        self.spaced = np.array([e[:1] == b" " for e in entries], bool)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.begin[ids], self.length[ids])]


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all runs that begin at ``first`` and are ``length`` long, one run after another."""
    ends = np.cumsum(length)
    return np.repeat(first - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)


class Encoders:
    """The two tokenizers, whole texts to ids, with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte, special = byte_of(), {i for i, x in self.a.get_added_tokens_decoder().items() if x.special}
        held = {i: x for x, i in self.a.get_vocab().items()}
        entries = [held.get(i, "") for i in range(max(held) + 1)]
        self.spelled_a = Spelled([x.encode() if i in special else bytes(byte[c] for c in x) for i, x in enumerate(entries)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.spelled_b = Spelled([bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)])
        self.parts = not any("▁" in x.lstrip("▁") for x in pieces)  # no entry goes on after a space inside it

    def ids_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all ids."""
        return flat_ids([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]) if texts else flat_ids([])

    def ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of texts that begin with a space, which the model adds itself."""
        return flat_ids(self.b.encode([t[1:] for t in texts], num_threads=1) if texts else [])


def flat_ids(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in found], np.int64)
    return lengths, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))


class Known:
    """What a worker knows of things by their 64-bit values: a number for each, and runs of numbers kept by it.

    Beyond ``most`` things those stay, half as many at most, that were met again since the last time.
    """

    def __init__(self, *kinds: type, most: int = MOST_WORDS):
        self.kinds, self.most = kinds, most
        self.place: dict[int, int] = {}
        self.values, self.met = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.runs = [(np.zeros(1, np.int64), np.zeros(0, k)) for k in kinds]
        self.objects: list[bytes] = []

    def thin(self) -> None:
        """Called between batches."""
        if len(self.values) <= self.most:
            return
        stay = np.flatnonzero(self.met)[: self.most // 2]
        kept_runs = [self.take(k, stay) for k in range(len(self.kinds))]
        self.objects = [self.objects[i] for i in stay.tolist()] if self.objects else []
        self.values, self.met = self.values[stay], np.zeros(len(stay), bool)
        self.place = {v: i for i, v in enumerate(self.values.tolist())}
        self.runs = [(np.concatenate([[0], np.cumsum(n)]), flat) for flat, n in kept_runs]

    def add(self, values: np.ndarray, *runs: tuple[np.ndarray, np.ndarray]) -> None:
        """New things, and of each kind of run the lengths and the runs one after another."""
        for i, v in enumerate(values.tolist(), len(self.values)):
            self.place[v] = i
        self.values = np.concatenate([self.values, values])
        self.met = np.concatenate([self.met, np.zeros(len(values), bool)])
        own = zip(self.runs, runs, strict=True)
        self.runs = [(np.concatenate([begin, begin[-1] + np.cumsum(n)]), np.concatenate([flat, new.astype(flat.dtype)])) for (begin, flat), (n, new) in own]

    def unknown(self, values: np.ndarray) -> np.ndarray:
        """Which of some distinct values aren't known; the others are met again."""
        place = np.array([self.place.get(v, -1) for v in values.tolist()], np.int64)
        self.met[place[place >= 0]] = True
        return np.flatnonzero(place < 0)

    def places(self, values: np.ndarray) -> np.ndarray:
        return np.array([self.place[v] for v in values.tolist()], np.int64)

    def take(self, kind: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of a kind one after another, and the length of each."""
        begin, flat = self.runs[kind]
        length = begin[places + 1] - begin[places]
        return flat[spread(begin[places], length)], length


def cuts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where words begin: texts' beginnings, and spaces after a byte that ends no white-space character of any script."""
    if not len(raw):
        return np.zeros(0, np.int64)
    b1, b2, b3 = (np.concatenate([np.zeros(k, np.uint8), raw[:-k]]) if len(raw) > k else np.zeros(len(raw), np.uint8) for k in (1, 2, 3))
    white = (b1 <= 32) | (b1 == 127)
    wide = b1 >= 0x80
    white |= wide & (((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 == 0xE1) & (b2 == 0x9A)) | ((b3 == 0xE2) & ((b2 == 0x80) | (b2 == 0x81))) | ((b3 == 0xE3) & (b2 == 0x80)))
    cut = (raw == _SPACE) & ~white
    cut[at[:-1][at[:-1] < at[1:]]] = True
    return np.flatnonzero(cut)


class Words:
    """Ids of whole texts by both tokenizers, from a worker's table of words between spaces."""

    def __init__(self, encoders: Encoders):
        self.encoders, self.known = encoders, Known(np.uint32, np.uint32)

    def __call__(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For texts with a space before each: ids and where each text's begin, of either tokenizer."""
        self.known.thin()
        body, encoders = raw.tobytes(), self.encoders
        start = cuts(raw, at) if encoders.parts else at[:-1][at[:-1] < at[1:]]
        end = np.append(start[1:], len(raw))[: len(start)]
        row = np.searchsorted(start, at)
        short = (end - start <= LONG_WORD) & encoders.parts
        spots, long = np.flatnonzero(short), np.flatnonzero(~short)

        def texts(which: np.ndarray) -> list[str]:
            return [body[i:j].decode("utf-8", "replace") for i, j in zip(start[which].tolist(), end[which].tolist(), strict=True)]

        new, first, back = np.unique(_hash_spans(raw, start[spots], end[spots], False), return_index=True, return_inverse=True)
        unknown = self.known.unknown(new)
        if len(unknown):
            words = texts(spots[first[unknown]])
            self.known.add(new[unknown], encoders.ids_a(words), encoders.ids_b(words))
        place = self.known.places(new)[back] if len(new) else np.zeros(0, np.int64)
        whole, out = texts(long), []
        for kind, encode in enumerate((encoders.ids_a, encoders.ids_b)):
            taken, n = self.known.take(kind, place)
            n_long, own = encode(whole)
            length = np.zeros(len(start), np.int64)
            length[spots], length[long] = n, n_long
            ends = np.concatenate([[0], np.cumsum(length)])
            ids = np.empty(int(ends[-1]), np.uint32)
            ids[spread(ends[spots], n)] = taken
            ids[spread(ends[long], n_long)] = own
            out.append((ids, ends[row]))
        return out


def window(a: list[int], b: list[int], long_a: list[int], long_b: list[int]) -> tuple[int, list[int], bytes]:
    """Number of groups, linked pairs in order (A's id in the high bits), and the groups written out, of ids and the lengths of their ranges."""
    i = j = 0
    end_a, end_b = long_a[0], long_b[0]
    links, groups, from_a, from_b = [], [], 0, 0
    while True:
        links.append(a[i] << 32 | b[j])
        if end_a == end_b:
            i, j = i + 1, j + 1
            groups.append(",".join(map(str, a[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
            from_a, from_b = i, j
            if i == len(a):
                return len(groups), links, ";".join(groups).encode()
            end_a, end_b = end_a + long_a[i], end_b + long_b[j]
        elif end_a < end_b:
            i += 1
            end_a += long_a[i]
        else:
            j += 1
            end_b += long_b[j]


def tuple_values(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, odd: np.uint64) -> np.ndarray:
    """64-bit values of runs of ids, by ids and order."""
    base = int(odd) % 2**64
    n = len(ids)
    power = np.full(n + 1, base, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    back = np.full(n + 1, pow(base, -1, 2**64), np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    return mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64) * odd)


FOUND = T.StructType(
    [
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("groups", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType(), False)),
        T.StructField("times", T.ArrayType(T.IntegerType(), False)),
    ]
)


class Aligner:
    """Aligns texts with what a worker has kept."""

    def __init__(self, path_a: str, path_b: str):
        self.paths, self.encoders = (path_a, path_b), Encoders(path_a, path_b)
        self.words = Words(self.encoders)
        self.known = Known(np.int64, np.int64)  # of windows: the links; the number of groups; as objects, the groups written out

    @classmethod
    def kept(cls, path_a: str, path_b: str) -> Aligner:
        held = CACHES.get("align")
        if not isinstance(held, cls) or held.paths != (path_a, path_b):
            held = CACHES["align"] = cls(path_a, path_b)
        return held

    def ids(self, column: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Bytes of each text with its space (0 for those without tokens), and the ids of either tokenizer with the places where texts begin."""
        raw, at = column_bytes(column)
        size = np.diff(at)
        some = size > 0
        full = np.where(some, size + 1, 0)
        begin = np.concatenate([[0], np.cumsum(full)])
        spaced = np.full(int(begin[-1]), _SPACE, np.uint8)
        spaced[spread(begin[:-1][some] + 1, size[some])] = raw  # texts lie one after another in raw
        a, b = self.words(spaced, begin)
        kinds = ((self.encoders.spelled_a, self.encoders.ids_a), (self.encoders.spelled_b, self.encoders.ids_b))
        right = spells(a, kinds[0][0], spaced, begin) & spells(b, kinds[1][0], spaced, begin)
        wrong = np.flatnonzero(~right & some)
        if len(wrong):  # once more, as whole texts
            texts = [spaced[begin[k] : begin[k + 1]].tobytes().decode("utf-8", "replace") for k in wrong.tolist()]
            a, b = put(a, wrong, *kinds[0][1](texts)), put(b, wrong, *kinds[1][1](texts))
            right = spells(a, kinds[0][0], spaced, begin) & spells(b, kinds[1][0], spaced, begin)
        none = np.flatnonzero(~(right & some))
        if len(none):
            empty = np.zeros(len(none), np.int64), np.zeros(0, np.uint32)
            a, b = put(a, none, *empty), put(b, none, *empty)
        return np.where(right, full, 0), a, b

    def __call__(self, column: pa.Array, write: bool) -> list[pa.Array]:
        self.known.most = MOST_WORDS if len(self.known.runs[0][1]) < MOST_LINKS else 0
        self.known.thin()
        size, (a, at_a), (b, at_b) = self.ids(column)
        spelled_a, spelled_b = self.encoders.spelled_a, self.encoders.spelled_b
        end_a, end_b = np.cumsum(spelled_a.length[a]), np.cumsum(spelled_b.length[b])
        total = int(size.sum())
        here = np.zeros(total + 1, np.int64)  # where an id of B ends: how many ids of B have ended
        here[end_b] = np.arange(1, len(b) + 1)
        shared = np.flatnonzero(here[end_a]) + 1  # places in A after an end that is one in B too
        of_b, byte = here[end_a[shared - 1]], end_a[shared - 1]
        edge = np.zeros(total + 1, bool)
        edge[np.cumsum(size)] = True
        anchor = edge[byte]
        inside = np.flatnonzero(~anchor)
        anchor[inside] = spelled_a.spaced[a[shared[inside]]] & spelled_b.spaced[b[of_b[inside]]]
        cut_a, cut_b = np.concatenate([[0], shared[anchor]]), np.concatenate([[0], of_b[anchor]])
        places = self._places(a, b, cut_a, cut_b)
        row = np.searchsorted(cut_a, at_a)  # the window at which each text begins
        groups = np.concatenate([[0], np.cumsum(self.known.take(1, places)[0])])[row]
        n_a, n_b, n_groups = np.diff(at_a), np.diff(at_b), np.diff(groups)
        written, shas, held, spots = [], [], self.known.objects, places.tolist()
        for i, j in zip(row[:-1].tolist(), row[1:].tolist(), strict=True):
            whole = b";".join([held[p] for p in spots[i:j]])
            shas.append(hashlib.sha256(whole).hexdigest() if j > i else "")
            written.append(whole.decode() if write else None)
        pairs, times, begin = self._pairs(places, row)
        lists = [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(x, k)) for x, k in ((pairs, pa.int64()), (times, pa.int32()))]
        numbers = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_a + n_b - n_groups)]
        return [*numbers, pa.array(shas, pa.string()), pa.array(written, pa.string()), *lists]

    def _places(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """For each window its place among those known; new ones are aligned."""
        first_a, next_a, first_b, next_b = cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:]
        if not len(first_a):
            return np.zeros(0, np.int64)
        values = tuple_values(a, first_a, next_a, _ODD[0]) ^ tuple_values(b, first_b, next_b, _ODD[1])
        new, first, back = np.unique(values, return_index=True, return_inverse=True)
        unknown = self.known.unknown(new)
        if len(unknown):
            at, ids = first[unknown], []
            for x, spelled, i, j in ((a, self.encoders.spelled_a, first_a[at], next_a[at]), (b, self.encoders.spelled_b, first_b[at], next_b[at])):
                own = x[spread(i, j - i)]
                ids.append((own.tolist(), spelled.length[own].tolist(), np.concatenate([[0], np.cumsum(j - i)]).tolist()))
            (x, long_x, at_x), (y, long_y, at_y) = ids
            found = [window(x[i:j], y[k:m], long_x[i:j], long_y[k:m]) for i, j, k, m in zip(at_x[:-1], at_x[1:], at_y[:-1], at_y[1:], strict=True)]
            lengths = np.array([len(f[1]) for f in found], np.int64)
            links = np.fromiter(chain.from_iterable(f[1] for f in found), np.int64, int(lengths.sum()))
            self.known.add(new[unknown], (lengths, links), (np.ones(len(found), np.int64), np.array([f[0] for f in found], np.int64)))
            self.known.objects.extend(f[2] for f in found)
        return self.known.places(new)[back]

    def _pairs(self, places: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's distinct linked pairs in order, how often each is linked, and where a text's begin."""
        text, known = np.repeat(np.arange(len(row) - 1), np.diff(row)), max(len(self.known.values), 1)
        both, times = np.unique(text * known + places, return_counts=True)
        links, length = self.known.take(0, both % known)
        text, times = np.repeat(both // known, length), np.repeat(times, length)
        order = np.lexsort((links, text))
        text, links, times = text[order], links[order], times[order]
        starts = np.ones(len(links), bool)
        starts[1:] = (text[1:] != text[:-1]) | (links[1:] != links[:-1])
        first = np.flatnonzero(starts)
        summed = np.add.reduceat(times, first) if len(first) else times
        return links[first], summed, np.concatenate([[0], np.cumsum(np.bincount(text[first], minlength=len(row) - 1))])


def spells(ids: tuple[np.ndarray, np.ndarray], spelled: Spelled, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text: are its ids' bytes its own bytes?"""
    flat, begin = ids
    ends = np.concatenate([[0], np.cumsum(spelled.length[flat])])
    same = ends[begin[1:]] - ends[begin[:-1]] == np.diff(at)
    if same.all():
        differs = np.concatenate([[0], np.cumsum(spelled.bytes_of(flat) != raw)])
        return differs[at[1:]] == differs[at[:-1]]
    for k in np.flatnonzero(same).tolist():
        same[k] = np.array_equal(spelled.bytes_of(flat[begin[k] : begin[k + 1]]), raw[at[k] : at[k + 1]])
    return same


def put(ids: tuple[np.ndarray, np.ndarray], texts: np.ndarray, lengths: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with those of some texts replaced."""
    flat, begin = ids
    n, at = np.diff(begin), np.concatenate([[0], np.cumsum(lengths)])
    parts = [flat[i:j] for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    for k, i, j in zip(texts.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        parts[k], n[k] = new[i:j], j - i
    return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum(n)])


def aligned(docs: DataFrame, path_a: str, path_b: str, carry: list[str], text: str = "text", write: bool = True) -> DataFrame:
    """Each text's ``carry`` and FOUND; ``groups`` is written where ``write`` says so."""
    narrow(docs.sparkSession)
    named = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(text).cast("string").alias("_text"))
    schema = T.StructType([*[T.StructField(c, named.schema[f"_c{i}"].dataType) for i, c in enumerate(carry)], *FOUND])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.kept(path_a, path_b)
        for batch in slices(batches, "_text", 1 << 21, "align"):
            out = aligner(batch.column(len(carry)), write)
            yield pa.record_batch([*batch.columns[: len(carry)], *out], names=[f.name for f in schema])

    return named.mapInArrow(run, schema)


def counted(docs: DataFrame, path_a: str, path_b: str, carry: list[str], text: str = "text", write: bool = False, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``aligned`` with ``n_best`` (links whose count is the highest of their A id) and ``count_sum`` (counts over links); a pair's count is the number of documents that hold it linked.

    The result is a table in the shared folder.
    """
    spark = docs.sparkSession
    found = kept(aligned(docs, path_a, path_b, carry, text, write).withColumn("_row", F.monotonically_increasing_id()))
    counts = kept(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")))
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("top"))
    judged = kept(counts.join(best, F.shiftright("pair", 32) == F.col("a")).select("pair", "count", (F.col("count") == F.col("top")).alias("best")))
    frequent = judged.orderBy(F.desc("count"), "pair").limit(most_pairs).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast([frequent.column(c).to_numpy() for c in ("pair", "count", "best")])
    names = [f.name for f in found.schema if f.name not in ("pairs", "times")]
    lists = [found.schema[c] for c in ("pairs", "times")]
    schema = T.StructType([*[found.schema[c] for c in names], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, number, top = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            row, pairs, times = unlisted(batch.column("pairs"), batch.column("times"))
            at = np.searchsorted(keys, pairs)
            at[at == len(keys)] = 0
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            at = at[hit]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row[hit], times[hit] * top[at])
            np.add.at(sums[1], row[hit], times[hit] * number[at])
            begin = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]), pa.int32())
            rest = [pa.ListArray.from_arrays(begin, pa.array(x[~hit], k)) for x, k in ((pairs, pa.int64()), (times, pa.int32()))]
            yield pa.record_batch([*[batch.column(c) for c in names], *map(pa.array, sums), *rest], names=[f.name for f in schema])

    out = found.mapInArrow(run, schema)
    if judged.count() > most_pairs:
        out = kept(out)
        rest = out.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("_row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
        sums = rest.join(judged, "pair").groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("count")).alias("_sum"))
        joined = out.join(sums, "_row", "left")
        final = joined.withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))})
    else:
        final = out
    result = kept(final.drop("_row", "_best", "_sum", "pairs", "times"))
    forget(spark, found, counts, judged, out)
    sent.unpersist()
    return result


def unlisted(pairs: pa.ListArray, times: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For two lists of equal lengths: the row, the pair and the number of each entry."""
    row = np.repeat(np.arange(len(pairs)), np.diff(pairs.offsets.to_numpy()))
    return row, pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
