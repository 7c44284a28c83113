"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its 5-word shingles.  Shingles are hashed into ``GROUPS`` groups; a document's group counts are a point, and
the sum of the smaller coordinates of two points bounds their sets' overlap from above.  Points are indexed in R-trees; whatever survives the bound is
verified on the sets themselves, so the links are exact.

One R-tree over all points would compare every document with a fixed share of all others, since points of unrelated documents lie close in so many
dimensions.  So the search space is first cut by the prefix filter: two sets of the wanted similarity share one of their first (rare first) n - ceil(0.75 n) + 1 shingles,
and only documents that share such a key meet, in that key's cell.  Linking goes in two rounds.  The first links each cell's members to its first members (stars), so that
a large group of near copies becomes one component without its pairs being listed.  In the second, each cell that still holds several components
is searched by an R-tree, large cells in pairs of blocks.  Pairs that the tree finds are checked in the task by the same bound over ``SPARSE`` groups, which is all but exact,
one pair of components after another until they are linked, so a task gives out links between components and no lists of pairs.  The links are verified on the sets;
if one should fail, its cells are searched once more with the sets themselves in the task.

Defined results: null, empty and blank texts have the empty set and are linked with nothing (their component is their own id); a text of fewer than five words is one shingle; repeated rows are equal
sets and so linked; rows with a null id share their component's smallest id, null if it has none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm import sets as S
from viewloom.llm.packs import take_runs
from viewloom.llm.text import distinct, forget, kept, narrow, release, shared_folder, slices, trim, windows, word_values

GROUPS = 256
#: Sets of so many shingles and more have a second, finer point.
LARGE, FINE = 768, 1536
PARTS = 3
NUMERATOR, DENOMINATOR = 75, 100
LEADERS = 3
BLOCK = 2048
#: Groups of the bound that is checked before a link is given out; kept as a list of groups, a number for each shingle.
SPARSE, DENSE = 1 << 16, 1 << 12
#: A key that more nodes send, by real count, has leaders of its own in each of several parts.
CROWDED = 1 << 17


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and where each text's begin."""
    return distinct(*windows(*word_values(column)))


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n + (-NUMERATOR * n // DENOMINATOR) + 1, 0)


def points(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Group counts of each row, as bytes (255: that many or more, which the bound takes as without limit)."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    group = (tokens & np.uint64(GROUPS - 1)).astype(np.int64)
    counts = np.bincount(owner * GROUPS + group, minlength=(len(starts) - 1) * GROUPS).reshape(-1, GROUPS)
    return np.minimum(counts, 255).astype(np.uint8)


def fine_points(tokens: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Counts by ``FINE`` groups of the rows of ``LARGE`` tokens and more, null for smaller ones."""
    out: list[bytes | None] = [None] * (len(starts) - 1)
    for i in np.flatnonzero(np.diff(starts) >= LARGE).tolist():
        group = ((tokens[starts[i] : starts[i + 1]] >> np.uint64(9)) % np.uint64(FINE)).astype(np.int64)
        out[i] = np.minimum(np.bincount(group, minlength=FINE), 255).astype(np.uint8).tobytes()
    return pa.array(out, pa.binary())


class Points:
    """Points of rows: coarse ones of all, fine ones of the large sets (``place``: the row's place among these, or -1)."""

    def __init__(self, n: np.ndarray, coarse: pa.Array, fine: pa.Array):
        self.n = n.astype(np.int64)
        self.coarse = S.flat(coarse, np.uint8)[0].reshape(-1, GROUPS)
        table, at = S.flat(fine, np.uint8)
        has = np.diff(at) > 0
        self.fine, self.place = table.reshape(-1, FINE), np.where(has, np.cumsum(has) - 1, -1)


def bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The most that the sets of two points can share: the sum of coordinate minima."""
    least = np.minimum(x, y)
    return least.sum(-1, dtype=np.int64) + (1 << 40) * (least == 255).any(-1)


def needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest overlap of sets of these sizes that reaches the similarity."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


class CountTree:
    """An R-tree over count vectors, packed by halving along the widest coordinate; a node keeps its coordinates' maxima and its sizes' range."""

    LEAF = 32

    def __init__(self, points_: Points, own: np.ndarray):
        self.points, self.x, self.n = points_, points_.coarse, points_.n
        self.root = self._pack(own) if len(own) else None

    def _pack(self, own: np.ndarray) -> tuple:
        top, sizes = self.x[own].max(0), (int(self.n[own].min()), int(self.n[own].max()))
        if len(own) <= self.LEAF:
            return top, sizes, own, None
        some = np.column_stack([self.x[own].astype(np.int64), self.n[own]])
        own = own[np.argsort(some[:, (some.max(0) - some.min(0)).argmax()], kind="stable")]
        return top, sizes, None, (self._pack(own[: len(own) // 2]), self._pack(own[len(own) // 2 :]))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) that may be similar enough; all queries go down the tree together."""
        low, high = -(-NUMERATOR * self.n // DENOMINATOR), self.n * DENOMINATOR // NUMERATOR
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        stack = [(self.root, queries)] if self.root else []
        while stack:
            (top, (least, most), own, below), q = stack.pop()
            q = q[(most >= low[q]) & (least <= high[q])]
            q = q[bound(self.x[q], top) >= needed(np.maximum(least, low[q]), self.n[q])]
            if not len(q):
                continue
            if below:
                stack.extend((x, q) for x in below)
                continue
            for i in range(0, len(q), 1024):
                a, b = (v.ravel() for v in np.meshgrid(q[i : i + 1024], own, indexing="ij"))
                fine = possible(self.points, a, self.points, b)
                first.append(a[fine])
                second.append(b[fine])
        return np.concatenate(first), np.concatenate(second)


def possible(x: Points, a: np.ndarray, y: Points, b: np.ndarray) -> np.ndarray:
    """Which pairs (a of x, b of y) pass the length filter and the bounds."""
    n, m = x.n[a], y.n[b]
    fine = NUMERATOR * np.maximum(n, m) <= DENOMINATOR * np.minimum(n, m)
    rest = np.flatnonzero(fine)
    for i in range(0, len(rest), 1 << 14):
        at = rest[i : i + (1 << 14)]
        fine[at] = bound(x.coarse[a[at]], y.coarse[b[at]]) >= needed(n[at], m[at])
    rest = np.flatnonzero(fine & (x.place[a] >= 0) & (y.place[b] >= 0))
    for i in range(0, len(rest), 1 << 12):
        at = rest[i : i + (1 << 12)]
        fine[at] = bound(x.fine[x.place[a[at]]], y.fine[y.place[b[at]]]) >= needed(n[at], m[at])
    return fine


def sparse(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The group, of ``SPARSE``, of each token, ascending in each row."""
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.uint64), np.diff(starts))
    return (np.sort(owner << np.uint64(16) | (tokens >> np.uint64(24) & np.uint64(SPARSE - 1))) & np.uint64(SPARSE - 1)).astype("<u2")


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """The sum of coordinate minima of two lists of groups."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    once = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1])
    value, times = x[once], np.diff(np.append(once, len(x)))
    return int(np.minimum(times, np.searchsorted(y, value, "right") - np.searchsorted(y, value, "left")).sum())


def linked(root: np.ndarray, a: np.ndarray, b: np.ndarray, check) -> np.ndarray:
    """Which of the pairs (a, b) of rows link different components: a spanning set of all pairs that ``check`` lets pass.

    ``check(a, b)`` is asked for one pair of two components at first, then for twice as many each time, until the two are linked or have no pairs left.
    """
    comp = np.unique(root, return_inverse=True)[1]
    parent = np.arange(comp.max() + 1 if len(comp) else 0)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    pair, most, edges = np.arange(len(a)), 1, []
    while len(pair):
        now = np.array([find(x) for x in range(len(parent))])[comp]
        low, high = np.minimum(now[a[pair]], now[b[pair]]), np.maximum(now[a[pair]], now[b[pair]])
        still = low != high
        pair, key = pair[still], low[still] * len(parent) + high[still]
        order = np.argsort(key, kind="stable")
        pair, key = pair[order], key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        chosen = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key)))) < most
        fine = pair[chosen][check(a[pair[chosen]], b[pair[chosen]])] if len(pair) else pair
        for i in fine.tolist():
            x, y = find(comp[a[i]]), find(comp[b[i]])
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append(i)
        pair, most = pair[~chosen], 2 * most
    return np.array(edges, np.int64)


def keyed(docs: DataFrame, sketch) -> DataFrame:
    """(node, n, prefix, point, maybe, fine) of every row of (text), one row a node: its prefix of rare shingles, its group counts, and which keys may be crowded by the sketch."""
    most = CROWDED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            tokens, starts = shingles(batch.column(0))
            node, n = S.signatures(tokens, starts), np.diff(starts)
            ordered, _ = S.rare_first(tokens, starts, sketch.value)
            take = prefix_lengths(n)
            new = np.zeros(len(n), bool)
            for i, x in enumerate(node.tolist()):  # equal sets of a task are sent once
                new[i] = n[i] > 0 and x not in seen
                seen.add(x)
            if len(seen) > 1_000_000:
                seen.clear()
            rows = np.flatnonzero(new)
            cuts = np.concatenate([[0], np.cumsum(take[rows])])
            at = np.repeat(starts[rows] - cuts[:-1], take[rows]) + np.arange(cuts[-1])
            x = points(tokens, starts)[rows]
            columns = [pa.array(node[rows]), pa.array(n[rows]), S.blobs(ordered[at], cuts), S.blobs(x.ravel(), np.arange(len(rows) + 1) * GROUPS)]
            columns.append(S.blobs((sketch.value[S.slots(ordered[at])] > most).astype(np.uint8), cuts))
            yield pa.record_batch([*columns, fine_points(tokens, starts).take(pa.array(rows))], names=["node", "n", "prefix", "point", "maybe", "fine"])

    found = docs.select("text").mapInArrow(run, "node long, n long, prefix binary, point binary, maybe binary, fine binary")
    return found.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "prefix", "point", "maybe", "fine")))


def crowded(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys that more than ``CROWDED`` nodes send, ascending, and into how many parts, 250 at most, each is cut for its leaders' sake.

    The sketch only says which keys have to be counted: where its counters have filled these are all keys, and the real counts still tell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, maybe = S.flat(batch.column(0), "<i8")[0], S.flat(batch.column(1), np.uint8)[0]
            yield pa.record_batch([pa.array(keys[maybe > 0])], names=["key"])

    counts = nodes.select("prefix", "maybe").mapInArrow(run, "key long").groupBy("key").count().where(F.col("count") > CROWDED).collect()
    found = sorted((r["key"], min(r["count"] // CROWDED, 250)) for r in counts)
    return np.array([k for k, _ in found], np.int64), np.array([n for _, n in found], np.int64)


LED = [f"{c}{i}" for i in range(1, LEADERS + 1) for c in "ln"]
CELL = "key long, part int, node long, n int, " + ", ".join(f"{c} {'long' if c[0] == 'l' else 'int'}" for c in LED)


def cells(nodes: DataFrame, crowd: tuple[np.ndarray, np.ndarray], part: int = 0, parts: int = 1) -> DataFrame:
    """(key, part, node, n, l1, n1, ...) of all keys that two nodes or more share, with the first ``LEADERS`` nodes and their sizes of the key, or of the node's
    part of it where the key is crowded; of one of ``parts`` parts of the keys."""
    crowd_keys, crowd_parts = crowd

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts = S.flat(batch.column(2), "<i8")
            row = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            if parts > 1:
                mine = np.flatnonzero(S.mix(keys.view(np.uint64)) % np.uint64(parts) == part)
                keys, row = keys[mine], row[mine]
            cut = np.zeros(len(keys), np.int64)
            if len(crowd_keys):
                at = np.minimum(np.searchsorted(crowd_keys, keys), len(crowd_keys) - 1)
                cut = np.where(crowd_keys[at] == keys, crowd_parts[at], 0)
            node = batch.column(0).to_numpy()[row]
            own = np.where(cut > 0, (S.mix(node.view(np.uint64)) % (cut.astype(np.uint64) + np.uint64(1))).astype(np.int64), -1)
            yield pa.record_batch([pa.array(keys), pa.array(own.astype(np.int32)), pa.array(node), pa.array(batch.column(1).to_numpy()[row].astype(np.int32))], names=["key", "part", "node", "n"])

    names = ["key", "part", "node", "n", *LED]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by key; of a batch's last run the first rows are remembered, as it may go on in the next batch
        before: list[np.ndarray] = []
        shown = True  # have all remembered rows been given out?
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy().astype(np.int64) for c in batch.columns]
            goes_on = bool(before) and before[0][0] == rows[0][0] and before[0][1] == rows[1][0]
            if goes_on:  # put the remembered rows before the batch's own
                rows = [np.concatenate([[b[i] for b in before], r]) for i, r in enumerate(rows)]
            given = len(before) if goes_on and shown else 0
            key, own, node, n = rows
            edge = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (own[1:] != own[:-1])) + 1])
            size = np.diff(np.append(edge, len(key)))
            run = np.repeat(np.arange(len(edge)), size)
            led = [np.minimum(edge[run] + i, edge[run] + size[run] - 1) for i in range(LEADERS)]
            give = (size[run] > 1) | (own >= 0)  # a part may have one node, its key has others
            give[:given] = False
            at = np.flatnonzero(give)
            last = edge[-1]
            before = [np.array([key[i], own[i], node[i], n[i]]) for i in range(last, min(last + LEADERS, len(key)))]
            shown = len(key) - last > 1 or own[last] >= 0
            if len(at):
                columns = [key[at], own[at].astype(np.int32), node[at], n[at].astype(np.int32), *(v for i in led for v in (node[i[at]], n[i[at]].astype(np.int32)))]
                yield pa.record_batch([pa.array(c) for c in columns], names=names)

    spread_out = nodes.select("node", "n", "prefix").mapInArrow(spread, "key long, part int, node long, n int")
    return spread_out.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(runs, CELL)


def stars(cell: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of nodes and their keys' first nodes that pass the length filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, *leaders = (c.to_numpy() for c in batch.columns)
            found = []
            for leader, m in zip(leaders[::2], leaders[1::2], strict=True):
                fine = (node != leader) & (NUMERATOR * np.maximum(n, m).astype(np.int64) <= DENOMINATOR * np.minimum(n, m).astype(np.int64))
                found.append(np.column_stack([np.maximum(node, leader), np.minimum(node, leader)])[fine])
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return cell.select("node", "n", *LED).mapInArrow(run, "a long, b long").distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, groups: bool = False) -> DataFrame:
    """(node, tokens), one row for each wanted node, from the texts; ``groups``: (node, groups), the group of each token instead."""
    wanted = wanted.select("node")
    bits = docs.sparkSession.sparkContext.broadcast(S.bloom(wanted, wanted.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            tokens, starts = shingles(batch.column(0))
            node = S.signatures(tokens, starts)
            rows = [i for i in np.flatnonzero(S.in_bloom(bits.value, node) & (np.diff(starts) > 0)).tolist() if not (node[i] in seen or seen.add(node[i]))]
            cut = np.concatenate([[0], np.cumsum(np.diff(starts)[rows])])
            own = np.concatenate([tokens[starts[i] : starts[i + 1]] for i in rows]) if rows else np.zeros(0, np.uint64)
            yield pa.record_batch([pa.array(node[rows]), S.blobs(sparse(own, cut) if groups else own, cut)], names=["node", name])

    name = "groups" if groups else "tokens"
    found = docs.select("text").mapInArrow(run, f"node long, {name} binary").groupBy("node").agg(F.first(name).alias(name))
    return found.join(wanted.select("node").distinct(), "node", "left_semi")


def passing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose points allow the similarity."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("point").alias(f"p{s}"), F.col("fine").alias(f"f{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "pa", "fa", "nb", "pb", "fb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (Points(batch.column(k).to_numpy(), batch.column(k + 1), batch.column(k + 2)) for k in (2, 5))
                each = np.arange(batch.num_rows)
                keep = pa.array(possible(x, each, y, each))
                yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return joined.mapInArrow(run, "a long, b long")


def opened(cell: DataFrame, first: DataFrame) -> DataFrame:
    """(key, node, root) of the cells that still hold several components, and pairs that the stars didn't meet: in a cell of ``LEADERS`` + 1 nodes or fewer every pair has a leader.

    Cells with the same smallest and the same largest node, as the shingles of a shared passage give by the dozen, become one cell; where that would be more than twice as large as the
    largest of them, they stay as they are.
    """
    large = cell.groupBy("key").agg(F.count("*").alias("c"), F.max("part").alias("part")).where((F.col("c") > LEADERS + 1) | (F.col("part") >= 0)).select("key")
    member = cell.select("key", "node").join(large, "key").join(first, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = (
        member.groupBy("key")
        .agg(F.count("*").alias("c"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.min("root").alias("r"), F.max("root").alias("s"))
        .where("r <> s")
        .select("key", "lo", "hi", "c")
    )
    rows = kept(member.join(several, "key"))
    merged = rows.groupBy("lo", "hi", "node").agg(F.min("root").alias("root"), F.max("c").alias("c"))
    wide = kept(merged.groupBy("lo", "hi").agg(F.count("*").alias("u"), F.max("c").alias("c")).where("u > 2 * c + 8").select("lo", "hi"))
    one = merged.join(wide, ["lo", "hi"], "left_anti").select(F.xxhash64("lo", "hi").alias("key"), "node", "root").groupBy("key", "node").agg(F.min("root").alias("root"))
    out = kept(one.unionByName(rows.join(wide, ["lo", "hi"], "left_semi").select("key", "node", "root")))
    forget(cell.sparkSession, rows, wide)
    return out


def searched(cell: DataFrame, members: DataFrame, exact: bool = False) -> DataFrame:
    """Links (a, b, key) between different components that R-trees find in the cells (key, node, root); large cells as pairs of blocks.

    ``members``: (node, n, point, groups).  The links hold by the bound over ``SPARSE`` groups; they are exact if the groups are the tokens themselves (``exact``).
    """
    sizes = cell.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = cell.join(sizes, "key").withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    rows = rows.join(members.select("node", "n", "point", "groups"), "node")
    names = ["key", "i", "j", "block", "node", "root"]

    def work(table: pa.Table) -> pa.RecordBatch | None:
        key, i, j, block, node, root = (table.column(c).to_numpy() for c in names)
        points_ = Points(table.column("n").to_numpy(), table.column("point").combine_chunks(), pa.nulls(len(table), pa.binary()))
        groups, at = S.flat(table.column("groups").combine_chunks(), "<u8" if exact else "<u2")
        begin = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1])
        size = np.diff(np.append(begin, len(key)))
        found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def check_in(first: int, members: int):
            """A check of pairs of the rows from ``first`` on: over ``DENSE`` groups in bulk, then over all groups, or the sets."""
            dense = None
            if members > CountTree.LEAF:
                owner = np.repeat(np.arange(members), np.diff(at[first : first + members + 1]))
                cell_groups = (groups[at[first] : at[first + members]].astype(np.uint64) % np.uint64(DENSE)).astype(np.int64)
                dense = np.minimum(np.bincount(owner * DENSE + cell_groups, minlength=members * DENSE), 255).astype(np.uint8).reshape(members, DENSE)

            def check(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                need, fine = needed(points_.n[a], points_.n[b]), np.ones(len(a), bool)
                if dense is not None:
                    for k in range(0, len(a), 1 << 11):
                        cut = slice(k, k + (1 << 11))
                        fine[cut] = bound(dense[a[cut] - first], dense[b[cut] - first]) >= need[cut]
                for k in np.flatnonzero(fine).tolist():
                    fine[k] = shared(groups[at[a[k]] : at[a[k] + 1]], groups[at[b[k]] : at[b[k] + 1]]) >= need[k]
                return fine

            return check

        # cells of one leaf: all their pairs pass the bound together, cells of equal size at once
        small = [np.zeros((0, 2), np.int64)]
        for s in np.unique(size[size <= CountTree.LEAF]).tolist():
            own = begin[size == s]
            small.extend(np.column_stack([own + p, own + q]) for p in range(s) for q in range(p))
        a, b = np.concatenate(small).T
        fine = (root[a] != root[b]) & ((block[a] != block[b]) | (i[a] == j[a]))
        a, b = a[fine], b[fine]
        fine = possible(points_, a, points_, b)
        a, b = a[fine], b[fine]
        if len(a):  # components are told apart by cell as well
            number = np.repeat(np.arange(len(begin)), size)
            _, within = np.unique(np.column_stack([number, root]), axis=0, return_inverse=True)
            edge = linked(within.reshape(-1), a, b, check_in(0, 0))
            found[0].append(a[edge])
            found[1].append(b[edge])
        for first, s in zip(begin[size > CountTree.LEAF].tolist(), size[size > CountTree.LEAF].tolist(), strict=True):
            own = np.arange(first, first + s)
            a, b = CountTree(points_, own[block[own] == i[first]]).search(own[block[own] == j[first]])
            fine = (root[a] != root[b]) & ((i[first] != j[first]) | (b < a))
            a, b = a[fine], b[fine]
            if len(a):
                edge = linked(root[own], a - first, b - first, lambda x, y, f=first, c=check_in(first, s): c(x + f, y + f))
                found[0].append(a[edge])
                found[1].append(b[edge])
        a, b = (np.concatenate(x) for x in found)
        return pa.record_batch([pa.array(np.maximum(node[a], node[b])), pa.array(np.minimum(node[a], node[b])), pa.array(key[a])], names=["a", "b", "key"]) if len(a) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, i, j = (batch.column(k).to_numpy() for k in range(3))
            cut = int(((key == key[-1]) & (i == i[-1]) & (j == j[-1])).argmax())  # rows are sorted: the last cell's first row
            ended = bool(held) and (cut > 0 or tuple(held[-1].column(k)[-1].as_py() for k in range(3)) != (key[0], i[0], j[0]))
            if cut:
                held.append(batch.slice(0, cut))
                ended = True
            if ended:
                if (out := work(pa.Table.from_batches(held))) is not None:
                    yield out
                held = []
                trim()
            held.append(batch.slice(cut))
        if held and (out := work(pa.Table.from_batches(held))) is not None:
            yield out

    rows = rows.select(*names, "n", "point", "groups")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long, key long")


def checked(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough."""
    pairs = pairs.select("a", "b").distinct()
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    own = kept(sets_of(docs, wanted))
    out = kept(S.verified(pairs, own, NUMERATOR, DENOMINATOR))
    forget(docs.sparkSession, own)
    return out


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keys: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(doc_id, keys, n_shingles, node, root, component_id) for every row: exact components of the links of similarity 0.75 and more.

    ``root``: the component itself, null for the empty set; components whose rows have no id, or share one, differ in it alone.
    ``keys``: further whole-number columns to carry.
    """
    spark = docs.sparkSession
    narrow(spark)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *(F.col(k).cast("long").alias(k) for k in keys), F.col(text).alias("text"))

    def units(batch: pa.RecordBatch) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
        return batch.columns[:-1], *shingles(batch.column(batch.num_columns - 1))

    names = ["doc_id", *keys]
    rows, sketch = S.split_rows(spark, units, names, ", ".join(f"{k} long" for k in names), docs)
    held = spark.sparkContext.broadcast(sketch)
    nodes = kept(keyed(docs, held))
    held.destroy()
    del sketch, held
    release(spark)
    folder, crowd = shared_folder(spark), crowded(nodes)
    for i in range(PARTS):  # a part of the keys at a time, so that a part of their rows is on disk
        cells(nodes, crowd, i, PARTS).write.mode("append").parquet(folder)
        release(spark)
    cell = spark.read.schema(CELL).parquet(folder)
    cell._kept_in = folder
    candidates = kept(passing(stars(cell), nodes))
    links = checked(docs, candidates)
    forget(spark, candidates)
    release(spark)
    first = S.components(links)

    # second round: cells of several components
    rest = opened(cell, first)
    forget(spark, cell)
    release(spark)
    points_ = nodes.select("node", "n", "point")
    own = kept(points_.join(sets_of(docs, rest.select("node").distinct(), True), "node"))
    more = kept(searched(rest, own))
    forget(spark, own)
    release(spark)
    added, exact = checked(docs, more), None
    refuted = kept(more.join(added, ["a", "b"], "left_anti").select("key").distinct())
    if refuted.limit(1).count():
        now = S.components(links.unionByName(added))
        again = kept(rest.join(refuted, "key").drop("root").join(now, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")))
        own = kept(points_.join(sets_of(docs, again.select("node").distinct()).withColumnRenamed("tokens", "groups"), "node"))
        exact = kept(searched(again, own, True).select("a", "b").distinct())
        forget(spark, own, again)
    forget(spark, rest, more, refuted, nodes)
    final = S.components(links.unionByName(added) if exact is None else links.unionByName(added).unionByName(exact))
    labels = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    smallest = labels.join(final, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    smallest = smallest.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labels.join(final, "node", "left").select("node", F.coalesce("root", "node").alias("root")).join(smallest, "root").select("node", "root", "component_id")
    return rows.join(named, "node", "left").select(
        *names, F.col("n").alias("n_shingles"), "node", "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
