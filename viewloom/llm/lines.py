"""Line dedup by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased).  Every line with a word takes part.  Two lines match when the Jaccard similarity of
their sets is 0.8 or more; a line is removed when it matches a line in an earlier place, removed itself or not.  Places are ordered by (doc_id, line
number, hash of the text), null ids first.

1. Equal sets (128-bit signatures) are one node, which stands for its first place; all other places of it go at once.  Sets of fewer than ``LEAST`` words match equal ones alone.
2. Each larger node sends the first n - ceil(0.8 n) + 1 of its words, rare first, as keys; words that stand once in the corpus are left out, as they can't be shared.
   A key that more than ``BLOCK`` nodes send, by real count, is cut into blocks, and each pair of blocks meets in a cell of its own.
3. In a cell, nodes are compared under the length filter, the positional filter and a bound from parity bits of each set.  A node takes its most similar earlier ones alone (``CELL_FIRST`` a cell, ``FIRST`` in all),
   so groups of near copies don't list their pairs.  These are verified on the sets.
4. A node that none of these settles, and that has more, is compared with all others of its cells: first by the filters alone, then, of the rows that pass, sets in hand, until one matches; only the nodes that go leave the task.

Defined results: null and empty texts have no lines that take part and stay as they are; repeated rows (same id and text) lose the same lines, rows of one id and different texts are told apart by a hash of the text;
columns of the input named ``n_lines`` or ``removed`` are replaced by the operator's own, all others are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm import sets as S
from viewloom.llm.packs import bucket_count, dealt, fields_first, pack, packs, records, take_runs
from viewloom.llm.text import _hash_spans, column_bytes, forget, kept, narrow, release, shared_folder, slices, trim, word_spans, word_values

NUMERATOR, DENOMINATOR = 4, 5
LEAST = DENOMINATOR - 1  # a set of n words and one of n + 1 match from here on
BLOCK = 4096
CELL_FIRST, FIRST = 2, 3
#: Keys that are cut into blocks, at most; those beyond it, the least crowded, are compared as one cell.
MOST_CROWDED = 1_000_000
PARTS = 3
WIDE, WIDE_WORDS = 192, 8
HELD = 150_000
FOUND_AT_ONCE = 1 << 21

PLACE = np.dtype([("doc", "<i8"), ("hash", "<i8"), ("line", "<i4")])
NODE = np.dtype([("a", "<u8"), ("b", "<u8"), *((c, PLACE[c]) for c in PLACE.names), ("n", "<i4"), ("p", "<u8"), ("q", "<u8"), ("k", "<i4")])
CELL = np.dtype([("cell", "<u8"), *((c, PLACE[c]) for c in PLACE.names), ("n", "<i4"), ("pos", "<i4"), ("own", "<u2"), ("other", "<u2"), ("p", "<u8"), ("q", "<u8")])
PAIR = np.dtype([("xd", "<i8"), ("xh", "<i8"), ("xl", "<i4"), ("differ", "<i4"), ("yd", "<i8"), ("yh", "<i8"), ("yl", "<i4"), ("more", "<i4")])
COUNT = np.dtype([("key", "<u8"), ("count", "<i8")])
FIRSTS = "bucket int, nodes binary, keys binary, pos binary, wide binary, rest binary, crowd binary"


def line_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and number of each line with a word, the values of its words, and where each line's begin."""
    raw, at = column_bytes(column)
    owner, number, begin = line_starts(raw, at)
    start, end = word_spans(raw, at)
    cuts = np.append(np.searchsorted(start, begin), len(start))
    use = np.diff(cuts) > 0
    return owner[use], number[use], _hash_spans(raw, start, end, True), np.append(cuts[:-1][use], len(start))


def line_starts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in its row, and first byte of every line."""
    newline = np.flatnonzero(raw == 10)
    owner = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, newline, "right") - 1])
    begin = np.concatenate([at[:-1], newline + 1])
    order = np.lexsort((begin, owner))
    owner, begin = owner[order], begin[order]
    return owner, (np.arange(len(owner)) - np.searchsorted(owner, owner)).astype(np.int32), begin


def parity(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: each token flips one.  Sets differ in as many tokens as bits, at least."""
    bit = tokens >> np.uint64(20) & np.uint64(127)
    out = []
    for half in (0, 1):
        flips = np.where(bit >> np.uint64(6) == half, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
        run = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(flips)])
        out.append(run[starts[1:]] ^ run[starts[:-1]])
    return out[0], out[1]


def wide_parity(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``WIDE_WORDS`` 64-bit numbers of such bits of each set of ``WIDE`` tokens and more, and how many each set has."""
    large = np.flatnonzero(np.diff(starts) >= WIDE)
    bits = WIDE_WORDS * 64
    out = np.zeros((len(large), bits // 8), np.uint8)
    for i, row in enumerate(large.tolist()):
        bit = (tokens[starts[row] : starts[row + 1]] >> np.uint64(27)).astype(np.int64) % bits
        out[i] = np.packbits(np.bincount(bit, minlength=bits).astype(np.uint8) & 1)
    return out.reshape(-1).view("<u8"), np.where(np.diff(starts) >= WIDE, WIDE_WORDS, 0)


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    return np.where(n >= LEAST, n + (-NUMERATOR * n // DENOMINATOR) + 1, 0)


def place_keys(doc: np.ndarray, text_hash: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A 64-bit value of each place, for filters and buckets."""
    return S.mix(S.mix(doc.view(np.uint64) + np.uint64(0x1F83D9ABFB41BD6B)) ^ S.mix(text_hash.view(np.uint64) + line.astype(np.uint64)))


def counted(docs: DataFrame) -> np.ndarray:
    """The sketch of all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(S.WIDTH, np.int64)
        for batch in slices(batches, "text"):
            counts += np.bincount(S.slots(word_values(batch.column(0))[0]), minlength=S.WIDTH)
        found = list(S.packed(counts))
        yield pa.record_batch([pa.array([i for i, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["part", "counts"])

    return S.frequency(docs.select("text").mapInArrow(run, "part int, counts binary"))


def first_of(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of nodes at places: the rows of the nodes' first places, and those of their other places (a repeated row has the same places again)."""
    order = np.lexsort((table["hash"], table["line"], table["doc"], table["b"], table["a"]))
    own = table[order]
    new = np.ones(len(own), bool)
    new[1:] = (own["a"][1:] != own["a"][:-1]) | (own["b"][1:] != own["b"][:-1])
    first = own[new][np.cumsum(new) - 1] if len(own) else own
    other = (own["doc"] != first["doc"]) | (own["line"] != first["line"]) | (own["hash"] != first["hash"])
    return np.sort(order[new]), order[other]


def places(table: np.ndarray) -> np.ndarray:
    out = np.empty(len(table), PLACE)
    for c in PLACE.names:
        out[c] = table[c]
    return out


def nodes_of(docs: DataFrame, sketch, buckets: int) -> DataFrame:
    """``FIRSTS``, packed: each node at its first place with its prefix keys, the places that repeat a node, and counts of keys that may be crowded."""
    names = [c.split(" ")[0] for c in FIRSTS.split(", ")]

    def parts(table: np.ndarray, keys: np.ndarray, pos: np.ndarray, wide: np.ndarray, rows: np.ndarray) -> list:
        k, w = table["k"].astype(np.int64), np.where(table["n"] >= WIDE, WIDE_WORDS, 0)
        return [(table[rows], None), take_runs(keys, k, rows), take_runs(pos, k, rows), take_runs(wide, w, rows)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            table, keys, pos, wide = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            first, rest = first_of(table)
            out = pack((table["a"][first] % np.uint64(buckets)).astype(np.int64), parts(table, keys, pos, wide, first), names[:5])
            none = pa.nulls(out.num_rows, pa.binary())
            yield pa.record_batch([*out.columns, none], names=names[:6])
            if len(rest):  # of no node's bucket, as one node may have very many
                again = places(table[rest])
                out = pack((place_keys(again["doc"], again["hash"], again["line"]) % np.uint64(buckets)).astype(np.int64), [(again, None)], ["bucket", "rest"])
                none = pa.nulls(out.num_rows, pa.binary())
                yield pa.record_batch([out.column(0), none, none, none, none, out.column(1)], names=names[:6])

        for batch in slices(batches, "text"):
            owner, number, values, starts = line_words(batch.column(2))
            tokens, starts, count = S.rare_sets(values, starts, sketch.value)
            n = np.diff(starts)
            take = prefix_lengths(n)
            cuts = np.cumsum(take) - take
            row = np.repeat(np.arange(len(n)), take)
            pos = np.arange(len(row)) - cuts[row]
            at = starts[:-1][row] + pos
            shared = count[at] > 1  # a word that stands once is no key
            row, pos, at = row[shared], pos[shared], at[shared]
            table = np.empty(len(n), NODE)
            table["a"], table["b"] = S.signatures_128(tokens, starts)
            table["doc"], table["hash"] = (batch.column(k).to_numpy()[owner] for k in (0, 1))
            table["line"], table["n"] = number, n
            table["p"], table["q"] = parity(tokens, starts)
            table["k"] = np.bincount(row, minlength=len(n))
            wide, _ = wide_parity(tokens, starts)
            held.append((table, tokens[at], (pos << 1 | (count[at] > BLOCK)).astype("<u4"), wide))
            if sum(len(h[0]) for h in held) >= HELD:
                yield from flush()
        if held:
            yield from flush()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, (table, keys, pos, wide, rest) in packs(batches, [NODE, "<u8", "<u4", "<u8", PLACE]):
            rows, others = first_of(table)
            own = parts(table, keys, pos, wide, rows)
            key, n = np.unique(own[1][0][own[2][0] & 1 == 1], return_counts=True)
            crowd = np.empty(len(key), COUNT)
            crowd["key"], crowd["count"] = key, n
            values = [own[0][0], *(x[0] for x in own[1:]), np.concatenate([rest, places(table[others])]), crowd]
            yield pa.record_batch([pa.array([bucket], pa.int32()), *(pa.array([fields_first(v, np.array([0, len(v)])) if v.dtype.names else v.tobytes()], pa.binary()) for v in values)], names=names)

    sent = docs.select("doc", "hash", "text").mapInArrow(run, FIRSTS.rsplit(", ", 1)[0])
    return dealt(sent).mapInArrow(first, FIRSTS)


def unpacked(packed: DataFrame, column: str, kind: np.dtype) -> DataFrame:
    """The records of a packed column as rows."""
    types = {"<i8": "long", "<u8": "long", "<i4": "int"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in (x for batch in batches for x in batch.column(0)):
            got = records(np.frombuffer(raw.as_buffer(), np.uint8), kind)
            for i in range(0, len(got), 1 << 16):
                own = got[i : i + (1 << 16)]
                yield pa.record_batch([pa.array(own[c].astype(np.int32 if kind[c].itemsize == 4 else np.int64)) for c in kind.names], names=list(kind.names))

    return packed.where(F.length(column) > 0).select(column).mapInArrow(run, ", ".join(f"{c} {types[kind[c].str]}" for c in kind.names))


def crowded(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys that more than ``BLOCK`` nodes send, ascending, and how many nodes do: real counts of all keys whose counter in the sketch is that large."""
    counts = unpacked(nodes, "crowd", COUNT).groupBy("key").agg(F.sum("count").alias("count")).where(F.col("count") > BLOCK)
    got = counts.orderBy(F.desc("count"), "key").limit(MOST_CROWDED).collect()
    key, n = np.array([r["key"] for r in got], np.int64).view(np.uint64), np.array([r["count"] for r in got], np.int64)
    order = np.argsort(key)
    return key[order], n[order]


def spread(table: np.ndarray, keys: np.ndarray, pos: np.ndarray, wide: np.ndarray, crowd: tuple[np.ndarray, np.ndarray], part: int = 0, parts: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``CELL`` rows of nodes, each one's node, and the wide bits of all; of one of ``parts`` parts of the keys."""
    row = np.repeat(np.arange(len(table)), table["k"])
    if parts > 1:
        mine = S.mix(keys) % np.uint64(parts) == part
        keys, pos, row = keys[mine], pos[mine], row[mine]
    blocks = np.ones(len(row), np.int64)
    may = np.flatnonzero(pos & 1)
    if len(crowd[0]) and len(may):
        at = np.minimum(np.searchsorted(crowd[0], keys[may]), len(crowd[0]) - 1)
        blocks[may] = np.where(crowd[0][at] == keys[may], np.minimum(-(-crowd[1][at] // BLOCK), 65_535), 1)
    own = (S.mix(table["a"][row]) % blocks.astype(np.uint64)).astype(np.int64)
    other = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    many = np.repeat(np.arange(len(row)), blocks)
    own, row, blocks = own[many], row[many], blocks[many]
    low, high = np.minimum(own, other), np.maximum(own, other)
    out = np.empty(len(row), CELL)
    out["cell"] = keys[many] ^ S.mix(np.where(blocks > 1, (low * 1_000_003 + high + 1).astype(np.uint64), np.uint64(0)))
    out["pos"], out["own"], out["other"] = pos[many] >> 1, own, np.where(low == high, own, other)
    for c in (*PLACE.names, "n", "p", "q"):
        out[c] = table[c][row]
    return out, row, take_runs(wide, np.where(table["n"] >= WIDE, WIDE_WORDS, 0), row)[0]


def earlier(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is row a's place before row b's?"""
    doc, line, text = rows["doc"], rows["line"], rows["hash"]
    return (doc[a] < doc[b]) | ((doc[a] == doc[b]) & ((line[a] < line[b]) | ((line[a] == line[b]) & (text[a] < text[b]))))


class Cells:
    """Rows of cells, sorted by cell and size, and the search for pairs of them."""

    def __init__(self, rows: np.ndarray, wide: np.ndarray):
        has = rows["n"] >= WIDE
        order = np.lexsort((rows["n"], rows["cell"]))
        self.order, self.rows = order, rows[order]
        self.cell, self.n, self.pos = (np.ascontiguousarray(self.rows[c]) for c in ("cell", "n", "pos"))
        self.p, self.q = np.ascontiguousarray(self.rows["p"]), np.ascontiguousarray(self.rows["q"])
        self.wide, self.place = wide.reshape(-1, WIDE_WORDS), np.where(has, np.cumsum(has) - 1, -1)[order]

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of rows of one cell that pass the length filter, in bulk: rows a given number of steps apart, over all cells at once.

        Rows are sorted by size within a cell, so a row whose partner is too large has no further ones.
        """
        end = np.searchsorted(self.cell, self.cell, "right")
        left, step = np.arange(len(self.cell)), 1
        while True:
            left = left[left + step < end[left]]
            left = left[NUMERATOR * self.n[left + step] <= DENOMINATOR * self.n[left]]
            if not len(left):
                return
            for i in range(0, len(left), 1 << 16):
                a = left[i : i + (1 << 16)]
                yield a, a + step
            step += 1

    def possible(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the pairs (a, b) that pass all filters, and in how many bits they differ."""
        total = self.n[a] + self.n[b]
        differ = np.bitwise_count(self.p[a] ^ self.p[b]).astype(np.int32) + np.bitwise_count(self.q[a] ^ self.q[b])
        at = np.flatnonzero(9 * differ <= total)  # two sets of which need ones are shared differ in total - 2 need, or fewer
        a, b, total, differ = a[at], b[at], total[at].astype(np.int64), differ[at].astype(np.int64)
        need = -(-NUMERATOR * total // (NUMERATOR + DENOMINATOR))
        p, q = self.pos[a], self.pos[b]
        fine = (total - differ >= 2 * need) & (np.minimum(p, q) + np.minimum(self.n[a] - p, self.n[b] - q) >= need)
        own, other = self.rows["own"], self.rows["other"]
        fine &= (own[a] != own[b]) | (own[a] == other[a])  # in a cell of two blocks, pairs across
        large = np.flatnonzero(fine & (self.place[a] >= 0) & (self.place[b] >= 0))
        if len(large):
            x = self.wide[self.place[a[large]]] ^ self.wide[self.place[b[large]]]
            differ[large] = np.maximum(differ[large], np.bitwise_count(x).sum(1, dtype=np.int64))
            fine[large] = total[large] - differ[large] >= 2 * need[large]
        return a[fine], b[fine], differ[fine]

    def pairs(self, asks: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(x, y, bits) of pairs that pass, y in the earlier place; only x that ask, if given."""
        for a, b in self.steps():
            if asks is not None:
                keep = asks[a] | asks[b]
                a, b = a[keep], b[keep]
            a, b, differ = self.possible(a, b)
            before = earlier(self.rows, a, b)
            x, y = np.where(before, b, a), np.where(before, a, b)
            if asks is not None:
                keep = asks[x]
                x, y, differ = x[keep], y[keep], differ[keep]
            if len(x):
                yield x, y, differ


def leading(x: tuple[np.ndarray, ...], differ: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The places, among rows sorted by x and differ, of the first ``most`` of each x; and for each whether its x has more."""
    new = np.ones(len(differ), bool)
    new[1:] = np.any([v[1:] != v[:-1] for v in x], axis=0)
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(differ)))
    keep = np.arange(len(differ)) - np.repeat(begin, times) < most
    return np.flatnonzero(keep), np.repeat(times > most, times)[keep]


def candidates(nodes: DataFrame, crowd, buckets: int, part: int, parts: int) -> DataFrame:
    """Packed ``PAIR`` records: nodes x and earlier nodes y that may match them, the ``CELL_FIRST`` most similar ones of each cell of one of ``parts`` parts of the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows, wide = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            n = np.where(rows["n"] >= WIDE, WIDE_WORDS, 0)
            return pack((S.mix(rows["cell"]) % np.uint64(buckets)).astype(np.int64), [(rows, None), (wide, n)], ["bucket", "rows", "wide"])

        for _, (table, keys, pos, wide) in packs(batches, [NODE, "<u8", "<u4", "<u8"]):
            rows, _, bits = spread(table, keys, pos, wide, crowd.value, part, parts)
            held.append((rows, bits))
            if sum(len(h[0]) for h in held) >= 3 * HELD:
                yield flush()
        if held:
            yield flush()
        trim()

    def work(rows: np.ndarray, wide: np.ndarray) -> pa.RecordBatch | None:
        cells = Cells(rows, wide)

        def first(found: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
            got = np.concatenate(found)
            x, y, differ = got.T
            got = got[np.lexsort((cells.rows["hash"][y], cells.rows["line"][y], cells.rows["doc"][y], differ, x))]
            at, more = leading((got[:, 0],), got[:, 2], most)
            return got[at], more

        found, many = [], 0
        for pair in cells.pairs():
            found.append(np.column_stack(pair))
            many += len(found[-1])
            if many > FOUND_AT_ONCE:  # of a crowded cell's pairs, those that may count are kept, and one more to tell that there are more
                found = [first(found, CELL_FIRST + 1)[0]]
                many = len(found[0])
        if not found:
            return None
        got, more = first(found, CELL_FIRST)
        x, y, differ = got.T
        out = np.empty(len(x), PAIR)
        for c, of in (("x", x), ("y", y)):
            out[f"{c}d"], out[f"{c}h"], out[f"{c}l"] = (cells.rows[k][of] for k in PLACE.names)
        out["differ"], out["more"] = differ, more
        return pack((place_keys(out["xd"].copy(), out["xh"].copy(), out["xl"]) % np.uint64(buckets)).astype(np.int64), [(out, None)], ["bucket", "pairs"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for _, arrays in packs(batches, [CELL, "<u8"]):
            held.append(arrays)
            if sum(len(h[0]) for h in held) >= HELD:  # small buckets go together
                if (out := work(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
                    yield out
                held = []
        if held and (out := work(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
            yield out
        trim()

    sent = nodes.select("bucket", "nodes", "keys", "pos", "wide").mapInArrow(run, "bucket int, rows binary, wide binary")
    return dealt(sent).mapInArrow(match, "bucket int, pairs binary")


PAIRS = "xd long, xh long, xl int, yd long, yh long, yl int, rank int, more boolean"


def best(found: DataFrame) -> DataFrame:
    """(x, y, rank, more) of packed pairs, as rows: the ``FIRST`` most similar y of each x over all cells; ``more``: it has others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (p,) in packs(batches, [PAIR]):
            p = p[np.lexsort((p["yh"], p["yl"], p["yd"], p["differ"], p["xh"], p["xl"], p["xd"]))]
            x = tuple(p[c] for c in ("xd", "xl", "xh"))
            begin = np.ones(len(p), bool)
            begin[1:] = np.any([v[1:] != v[:-1] for v in x], axis=0)
            group = np.cumsum(begin) - 1
            more = np.bincount(group, p["more"]) > 0
            new = begin.copy()
            new[1:] |= np.any([p[c][1:] != p[c][:-1] for c in ("yd", "yl", "yh")], axis=0)
            p, group = p[new], group[new]
            at, others = leading((group,), p["differ"], FIRST)
            own = p[at]
            rank = at - np.searchsorted(group, group[at])
            yield pa.record_batch([*(pa.array(own[c].copy()) for c in ("xd", "xh", "xl", "yd", "yh", "yl")), pa.array(rank.astype(np.int32)), pa.array(others | more[group[at]])], names=[c.split(" ")[0] for c in PAIRS.split(", ")])

    return dealt(found).mapInArrow(run, PAIRS)


def place_filter(rows: DataFrame, many: int):
    """A Bloom filter over about so many places (doc, hash, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(place_keys(*(c.to_numpy() for c in batch.columns)).view(np.int64))], names=["node"])

    return rows.sparkSession.sparkContext.broadcast(S.bloom(rows.select("doc", "hash", "line").mapInArrow(run, "node long"), many))


def sets_of(docs: DataFrame, wanted: DataFrame, many: int) -> DataFrame:
    """(doc, hash, line, tokens) of at least the wanted places (doc, hash, line), about so many: only their lines are taken apart."""
    bits = place_filter(wanted, many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, at = column_bytes(batch.column(2))
            owner, number, begin = line_starts(raw, at)
            end = np.append(begin[1:], len(raw))
            doc, text = (batch.column(k).to_numpy()[owner] for k in (0, 1))
            use = np.flatnonzero(S.in_bloom(bits.value, place_keys(doc, text, number).view(np.int64)))
            own, n = take_runs(raw, end - begin, use)
            own_at = np.concatenate([[0], np.cumsum(n)])
            start, stop = word_spans(own, own_at)
            tokens, starts = S.ascending(_hash_spans(own, start, stop, True), np.searchsorted(start, own_at))
            yield pa.record_batch([pa.array(doc[use]), pa.array(text[use]), pa.array(number[use]), S.blobs(tokens, starts)], names=["doc", "hash", "line", "tokens"])

    found = docs.select("doc", "hash", "text").mapInArrow(run, "doc long, hash long, line int, tokens binary")
    return found.groupBy("doc", "hash", "line").agg(F.first("tokens").alias("tokens"))


def enough(a: np.ndarray, b: np.ndarray) -> bool:
    """Are two ascending sets similar enough?"""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


GONE = "doc long, hash long, line int"


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The places x of pairs whose sets match."""
    side = lambda s: sets.select(*(F.col(c).alias(f"{s}{c[0]}") for c in PLACE.names), F.col("tokens").alias(f"t{s}"))
    joined = pairs.drop("rank", "more").join(side("x"), ["xd", "xh", "xl"]).join(side("y"), ["yd", "yh", "yl"]).select("xd", "xh", "xl", "tx", "ty")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = S.overlaps(batch, 3, 4)
                sizes = sum(np.diff(S.flat(batch.column(k), "<u8")[1]) for k in (3, 4))
                keep = pa.array(DENOMINATOR * both >= NUMERATOR * (sizes - both))
                yield pa.record_batch([batch.column(k).filter(keep) for k in range(3)], names=["doc", "hash", "line"])

    return joined.mapInArrow(run, GONE).distinct()


def row_values(rows: np.ndarray) -> np.ndarray:
    """A 64-bit value of each row's cell and place."""
    return S.mix(rows["cell"] ^ S.mix(place_keys(*(np.ascontiguousarray(rows[c]) for c in PLACE.names))))


def asking_rows(nodes: DataFrame, crowd, asking: DataFrame) -> DataFrame:
    """(cell, value) of the cell rows of nodes whose places ask."""
    within = place_filter(asking, asking.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (table, keys, pos, wide) in packs(batches, [NODE, "<u8", "<u4", "<u8"]):
            use = np.flatnonzero(S.in_bloom(within.value, place_keys(*(table[c].copy() for c in PLACE.names)).view(np.int64)))
            k, w = table["k"].astype(np.int64), np.where(table["n"] >= WIDE, WIDE_WORDS, 0)
            rows, _, _ = spread(table[use], take_runs(keys, k, use)[0], take_runs(pos, k, use)[0], take_runs(wide, w, use)[0], crowd.value)
            columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (rows["cell"], row_values(rows))]
            yield pa.record_batch([*columns, *(pa.array(rows[c].copy()) for c in PLACE.names)], names=["cell", "value", *PLACE.names])

    rows = nodes.select("bucket", "nodes", "keys", "pos", "wide").mapInArrow(run, "cell long, value long, doc long, hash long, line int")
    return rows.join(asking, list(PLACE.names), "left_semi").select("cell", "value")


def possible_rows(nodes: DataFrame, crowd, own: DataFrame, buckets: int) -> DataFrame:
    """The cell rows that ask, of which ``own`` has (cell, value), and those that may match one of them by all filters, with ``asks``."""
    near = nodes.sparkSession.sparkContext.broadcast(S.bloom(own.select(F.col("cell").alias("node")), own.count()))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows, wide = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            n = np.where(rows["n"] >= WIDE, WIDE_WORDS, 0)
            return pack((S.mix(rows["cell"]) % np.uint64(buckets)).astype(np.int64), [(rows, None), (wide, n)], ["bucket", "rows", "wide"])

        for _, (table, keys, pos, wide) in packs(batches, [NODE, "<u8", "<u4", "<u8"]):
            rows, _, bits = spread(table, keys, pos, wide, crowd.value)
            use = np.flatnonzero(S.in_bloom(near.value, rows["cell"].copy().view(np.int64)))
            held.append((rows[use], take_runs(bits, np.where(rows["n"] >= WIDE, WIDE_WORDS, 0), use)[0]))
            if sum(len(h[0]) for h in held) >= HELD:
                yield flush()
        if held:
            yield flush()
        trim()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, value = (c.to_numpy().view(np.uint64) for c in batch.columns)
            yield pack((S.mix(cell) % np.uint64(buckets)).astype(np.int64), [(value, None)], ["bucket", "asked"])

    def work(rows: np.ndarray, wide: np.ndarray, asked: np.ndarray) -> Iterator[pa.RecordBatch]:
        asks = np.isin(row_values(rows), asked)
        use = np.flatnonzero(np.isin(rows["cell"], np.unique(rows["cell"][asks])))  # the filter lets some other cells through
        cells = Cells(rows[use], take_runs(wide, np.where(rows["n"] >= WIDE, WIDE_WORDS, 0), use)[0])
        asks = asks[use][cells.order]
        possible = np.zeros(len(asks), bool)
        for x, y, _ in cells.pairs(asks):
            possible[x] = possible[y] = True
        at = np.flatnonzero(possible)
        for i in range(0, len(at), 1 << 14):
            own = at[i : i + (1 << 14)]
            has = cells.place[own] >= 0
            cut = np.concatenate([[0], np.cumsum(np.where(has, WIDE_WORDS, 0))])
            columns = [pa.array(cells.rows[c][own].astype(np.int64 if CELL[c].itemsize == 8 else np.int32)) for c in CELL.names]
            yield pa.record_batch([*columns, S.blobs(cells.wide[cells.place[own[has]]].reshape(-1), cut), pa.array(asks[own])], names=[*CELL.names, "bits", "asks"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for _, arrays in packs(batches, [CELL, "<u8", "<u8"]):
            held.append(arrays)
            if sum(len(h[0]) for h in held) >= HELD:  # small buckets go together
                yield from work(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
        if held:
            yield from work(*(np.concatenate(x) for x in zip(*held, strict=True)))
        trim()

    rows = nodes.select("bucket", "nodes", "keys", "pos", "wide").mapInArrow(members, "bucket int, rows binary, wide binary")
    sent = rows.unionByName(own.mapInArrow(asked, "bucket int, asked binary"), allowMissingColumns=True)
    fields = ", ".join(f"{c} {'long' if CELL[c].itemsize == 8 else 'int'}" for c in CELL.names)
    return dealt(sent).mapInArrow(search, f"{fields}, bits binary, asks boolean")


def settled(docs: DataFrame, nodes: DataFrame, crowd, asking: DataFrame) -> DataFrame:
    """Of the places that ask, those that match an earlier node of one of their cells; rows that pass the filters have their sets with them, and each search ends at its first match."""
    spark = docs.sparkSession
    own = kept(asking_rows(nodes, crowd, asking))
    buckets = nodes.agg(F.max("bucket")).first()[0] + 1
    members = kept(possible_rows(nodes, crowd, own, buckets))
    forget(spark, own)
    release(spark)
    sets = kept(sets_of(docs, members.select(*PLACE.names), members.count()))
    rows = members.join(sets, list(PLACE.names)).select(*members.columns, "tokens")

    def work(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        rows = np.empty(len(table), CELL)
        for c in CELL.names:
            rows[c] = table.column(c).to_numpy()
        column = lambda c: table.column(c).combine_chunks() if isinstance(table.column(c), pa.ChunkedArray) else table.column(c)
        tokens, at = S.flat(column("tokens"), "<u8")
        cell = Cells(rows, S.flat(column("bits"), "<u8")[0])
        asks = table.column("asks").to_numpy(zero_copy_only=False)[cell.order]
        gone = np.zeros(len(rows), bool)
        of = lambda i: tokens[at[cell.order[i]] : at[cell.order[i] + 1]]
        for x, y, _ in cell.pairs(asks):
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                if not gone[i] and enough(of(i), of(j)):
                    gone[i] = True
        return pa.record_batch([pa.array(cell.rows[c][gone].copy()) for c in PLACE.names], names=list(PLACE.names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(0).to_numpy()
            cut = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
            if held and (cut or held[-1].column(0)[-1].as_py() != cell[0]):
                yield work(pa.Table.from_batches([*held, batch.slice(0, cut)] if cut else held))
                held = []
            elif cut:
                yield work(pa.Table.from_batches([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
        if held:
            yield work(pa.Table.from_batches(held))

    out = kept(rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, GONE).distinct())
    forget(spark, members, sets)
    return out


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, hash, removed): for each id and text hash with any, the numbers of its removed lines, ascending."""
    spark = docs.sparkSession
    narrow(spark)
    docs = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    sketch = counted(docs)
    buckets = bucket_count(spark, int(sketch.sum(dtype=np.int64)))
    held = spark.sparkContext.broadcast(sketch)
    nodes = kept(nodes_of(docs, held, buckets))
    held.destroy()
    del sketch, held
    crowd = spark.sparkContext.broadcast(crowded(nodes))
    release(spark)
    folder = shared_folder(spark)
    for i in range(PARTS):  # a part of the keys at a time, so that a part of their rows is on disk
        candidates(nodes, crowd, buckets, i, PARTS).write.mode("append").parquet(folder)
        release(spark)
    found = spark.read.schema("bucket int, pairs binary").parquet(folder)
    found._kept_in = folder
    pairs = kept(best(found))
    forget(spark, found)
    side = lambda p, s: p.select(*(F.col(f"{s}{c[0]}").alias(c) for c in PLACE.names))

    def settle(some: DataFrame) -> DataFrame:
        sets = kept(sets_of(docs, side(some, "x").unionByName(side(some, "y")), 2 * some.count()))
        out = kept(verified(some, sets))
        forget(spark, sets)
        release(spark)
        return out

    places_ = list(PLACE.names)
    gone = settle(pairs.where("rank = 0"))  # the most similar one settles most of the nodes
    left = kept(pairs.where("rank > 0").join(gone.toDF("xd", "xh", "xl"), ["xd", "xh", "xl"], "left_anti").select(pairs.columns))
    if left.limit(1).count():
        gone = gone.unionByName(settle(left))
    asking = kept(side(pairs.where("more"), "x").distinct().join(gone, places_, "left_anti"))
    if asking.limit(1).count():
        gone = gone.unionByName(settled(docs, nodes, crowd, asking))
    every = unpacked(nodes, "rest", PLACE).unionByName(gone)
    forget(spark, pairs, left, asking)
    return every.groupBy("doc", "hash").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, ``n_lines``, and ``removed``, the numbers (from 0) of the lines that go."""
    docs = docs.drop(*({"n_lines", "removed"} - {doc_id, text}))
    own = [next(f"_{c}{i}" for i in range(len(docs.columns) + 1) if f"_{c}{i}" not in docs.columns) for c in ("doc", "hash")]
    gone = kept(removed_lines(docs, doc_id, text)).toDF(*own, "removed")
    # lines are counted before the join, so that a query that doesn't ask for the text doesn't shuffle it
    n_lines = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1, F.lit(0)).cast("long")
    marked = docs.withColumns({own[0]: F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))), own[1]: F.xxhash64(text), "n_lines": n_lines})
    none = F.array().cast("array<int>")
    return marked.join(gone, own, "left").withColumn("removed", F.coalesce("removed", none)).drop(*own)


def kept_text(text: str = "text", removed: str = "removed") -> Column:
    """The text without the removed lines."""
    lines = F.split(F.col(text), "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.array_contains(F.col(removed), i))
    return F.when(F.size(removed) == 0, F.col(text)).otherwise(F.array_join(left, "\n"))
