"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task packs the documents of its own partition, in their order, so nothing is shuffled and a lost
task gives the same windows when it runs again.  A document's ids are cut into full windows and one rest;
the rest goes into the fill level for which the sum, over the levels, of the squared number of partly
filled windows becomes least (ties: the fullest level; a new window is level 0).  The numbers of open windows are held in a
level array of ``window`` entries.  What is still open when the partition ends is laid end to end, cut
into full windows, and the last of it into sequences whose lengths are powers of two.

Defined results: null text is an empty document, which is its end id alone; repeated rows are packed
each on their own; a row with a null id is packed, with a null id in its pieces; an empty table gives no
rows; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from viewloom.llm.text import CACHES, _hash_spans, column_bytes, narrow, slices, word_spans

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
MARK = "\x00"


class WordIds:
    """Token ids of whole texts from a table of white-space words.

    For a tokenizer whose pre-tokenizer drops white space and never joins across it, the ids of a text are
    those of its words one after the other.  Words are known by 64-bit values in an open-addressing table of numpy arrays.  New words are encoded
    many at a time and parted again by the ids that end a piece; where their number is not the expected one, a mark between the words parts them.
    When the table is full, words that were not met since it was last thinned out leave it.
    """

    GROUP = 256

    def __init__(self, path: str, most_words: int = 1_500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path, self.tokenizer, self.most = path, Tokenizer.from_file(path), most_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._fill(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32))

    @classmethod
    def kept(cls, path: str) -> WordIds:
        """The one of this Python worker, which later tasks find filled."""
        held = CACHES.get("packing")
        if not isinstance(held, cls) or held.path != path:
            held = CACHES["packing"] = cls(path)
        return held

    def _fill(self, values: np.ndarray, begin: np.ndarray, flat: np.ndarray) -> None:
        """The table of these words alone: their values, where their ids begin, and their ids."""
        self.values, self.begin, self.flat = values, begin, flat
        self.met = np.zeros(len(values), bool)
        self.bits = max(12, int(2 * len(values)).bit_length())
        self.keys, self.number = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self._insert(values, 0)

    def _slots(self, values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, values: np.ndarray, first: int) -> None:
        at, rest = self._slots(values), np.arange(len(values))
        while len(rest):
            free = self.keys[at] == 0
            self.keys[at[free]] = values[rest[free]]
            mine = self.keys[at] == values[rest]
            self.number[at[mine]] = first + rest[mine]
            at, rest = (at[~mine] + 1) & ((1 << self.bits) - 1), rest[~mine]

    def _find(self, values: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for unknown ones."""
        at = self._slots(values)
        key = self.keys[at]
        out = np.where(key == values, self.number[at], -1)
        rest = np.flatnonzero((key != values) & (key != 0))
        at = at[rest]
        while len(rest):
            at = (at + 1) & ((1 << self.bits) - 1)
            key = self.keys[at]
            hit = key == values[rest]
            out[rest[hit]] = self.number[at[hit]]
            on = ~hit & (key != 0)
            at, rest = at[on], rest[on]
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of any words, a mark between them, or each by itself where a word holds the mark or a special token may be meant."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = [i for i, w in enumerate(texts) if "<|" not in w and MARK not in w] if self.mark is not None else []
        if plain:
            ids = self._ids([f" {MARK} ".join(texts[i] for i in plain)])[0]
            at = 0
            for i, end in zip(plain, [*np.flatnonzero(ids == self.mark).tolist(), len(ids)], strict=True):
                out[i] = ids[at:end]
                at = end + 1
        rest = sorted(set(range(len(texts))) - set(plain))
        for i, ids in zip(rest, self._ids([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order in which the words were encoded, the number of ids of each in that order, and all ids."""
        texts = b" ".join(words).decode("utf-8", "replace").split(" ") if words else []
        letters, pieces, others = [], [], []
        for i, w in enumerate(texts):
            if w.isalpha():
                letters.append(i)
                pieces.append(1)
            elif w[-1] in ".,|!?" and w[:-1].isalpha():
                letters.append(i)
                pieces.append(2)
            else:
                others.append(i)
        lengths, flat = [], []
        cuts = range(0, len(letters), self.GROUP)
        for k, ids in zip(cuts, self._ids([" ".join(texts[i] for i in letters[k : k + self.GROUP]) for k in cuts]), strict=True):
            ends = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum(pieces[k : k + self.GROUP])
            if len(ends) == last[-1] and ends[-1] == len(ids):
                lengths.append(np.diff(ends[last - 1], prepend=0))
                flat.append(ids)
            else:
                own = self._marked([texts[i] for i in letters[k : k + self.GROUP]])
                lengths.append(np.array([len(x) for x in own], np.int64))
                flat.extend(own)
        for k in range(0, len(others), self.GROUP):
            own = self._marked([texts[i] for i in others[k : k + self.GROUP]])
            lengths.append(np.array([len(x) for x in own], np.int64))
            flat.extend(own)
        none = np.zeros(0, np.int64)
        return np.array(letters + others, np.int64), np.concatenate([none, *lengths]), np.concatenate([none.astype(np.uint32), *flat])

    def _learn(self, values: np.ndarray, words: list[bytes]) -> None:
        order, lengths, flat = self._encode(words)
        if len(self.values) + len(values) > self.most:
            stay = np.flatnonzero(self.met)
            stay = stay[: max(0, self.most // 2)]
            n = np.diff(self.begin)[stay]
            at = np.repeat(self.begin[stay] - np.cumsum(n) + n, n) + np.arange(n.sum())
            self._fill(self.values[stay], np.concatenate([[0], np.cumsum(n)]), self.flat[at])
        known, own = len(self.values), values[order]
        begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(lengths)])
        both = np.concatenate([self.values, own])
        if 2 * len(both) > 1 << self.bits:
            met = np.concatenate([self.met, np.zeros(len(own), bool)])
            self._fill(both, begin, np.concatenate([self.flat, flat]))
            self.met = met
        else:
            self.values, self.begin, self.flat = both, begin, np.concatenate([self.flat, flat])
            self.met = np.concatenate([self.met, np.zeros(len(own), bool)])
            self._insert(own, known)

    def __call__(self, texts: pa.Array | list[bytes]) -> list[np.ndarray]:
        raw, at = column_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
        start, end = word_spans(raw, at)
        values = _hash_spans(raw, start, end, False)
        values[values == 0] = 1  # 0 is an empty slot
        row = np.searchsorted(start, at)
        number = self._find(values)
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new, first = np.unique(values[unknown], return_index=True)
            place = unknown[first]
            body = raw.tobytes()
            self._learn(new, [body[a:b] for a, b in zip(start[place].tolist(), end[place].tolist(), strict=True)])
            number = self._find(values)
        missing = np.flatnonzero(number < 0)
        if len(missing):  # thinned out while the batch was read: these words come in again
            new, first = np.unique(values[missing], return_index=True)
            body, place = raw.tobytes(), missing[first]
            most, self.most = self.most, len(self.values) + len(new)
            self._learn(new, [body[a:b] for a, b in zip(start[place].tolist(), end[place].tolist(), strict=True)])
            self.most = most
            number = self._find(values)
        self.met[number] = True
        first, length = self.begin[number], self.begin[number + 1] - self.begin[number]
        ends = np.cumsum(length)
        flat = self.flat[np.repeat(first - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)]
        edge = np.concatenate([[0], ends])[row]
        return [flat[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list] = {}

    def place(self, size: int) -> int:
        """The level to put ``size`` (below the window) into; 0 is a new window."""
        w, count = self.window, self.count
        last = w - size
        change = 2 * (count[size : w + 1] - count[: last + 1] + 1)  # one window leaves level h for h + size
        change[0] = 2 * count[size] + 1  # a new one only arrives
        change[last] = 1 - 2 * count[last]  # a full one only leaves
        possible = count[: last + 1] > 0
        possible[0] = True
        change = np.where(possible, change, np.iinfo(np.int64).max)
        return last - int(np.argmin(change[::-1]))

    def put(self, size: int, piece: tuple) -> list | None:
        """Place a piece; returns a window's pieces once it is full."""
        level = self.place(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.open.setdefault(level + size, []).append(pieces)
        self.count[level + size] += 1
        return None

    def rest(self) -> list:
        return [piece for level in sorted(self.open, reverse=True) for pieces in self.open[level] for piece in pieces]


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack every document's ids plus ``end_id``; one row per piece, with its ids as little-endian unsigned 32-bit bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, levels = WordIds.kept(tokenizer), Levels(window)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def emit(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset))
                offset += len(ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=PIECES.names)
            rows.clear()
            return out

        for batch in slices(batches, text, 1 << 21, "packing"):
            names = batch.column(batch.schema.get_field_index(doc_id)).to_pylist()
            for doc, ids in zip(names, words(batch.column(batch.schema.get_field_index(text))), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                total = len(ids)
                full = total - total % window
                for start in range(0, full, window):
                    emit([(doc, start, ids[start : start + window], total)])
                    if len(rows) >= 4096:
                        yield flush()
                if full < total and (done := levels.put(total - full, (doc, full, ids[full:].copy(), total))):
                    emit(done)
            if len(rows) >= 1024:
                yield flush()
        left = levels.rest()
        remaining, group, room = sum(len(p[2]) for p in left), [], 0
        for doc, start, ids, total in left:
            while len(ids):
                if not room:
                    room = window if remaining >= window else 1 << (remaining.bit_length() - 1)
                part, ids = ids[:room], ids[room:]
                group.append((doc, start, part, total))
                start, room, remaining = start + len(part), room - len(part), remaining - len(part)
                if not room:
                    emit(group)
                    group = []
        if rows:
            yield flush()

    narrow(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias(doc_id), docs[text].alias(text)).mapInArrow(run, PIECES)
