"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Largest inner products become smallest distances by one more dimension that lifts every vector to the same length.
Vectors are rotated by a random orthogonal matrix and dealt to lists around k-means centroids, which are fitted on a bounded sample; every
vector is indexed.  The number of lists grows with the square root of the number of vectors: beyond ``FIRST_LISTS`` centroids, each list is parted by the nearest of several centroids of what
is left of vectors once their own is taken away, which all lists share.  A query scans the lists whose centroids are nearest, one block of columns at a time: after each block, a candidate's partial
distance, scaled to all dimensions, is tested against the distance of the worst neighbour so far, and the candidate is abandoned when the hypothesis that it
belongs among the neighbours is rejected.  Lists are scanned one after the other, nearest first, and the worst neighbour so far is carried from list to list and from the nearest list's cell to
the other cells; it starts from a bound that at most ``BOUND`` of the sampled vectors give.  Survivors get their score from the original vectors in double precision.

A list is cut into blocks of bounded size by a hash of the id, so a crowded list is many tasks' work, and the queries of a cell into blocks of about ``QUERIES``; each pair of blocks gives its own nearest, which are merged by query.

Defined results: vectors that are null, zero, of another length than most of the sample's, or with null or non-finite components take no part; ties go to the smaller id; repeated ids are
candidates each on their own (a query leaves out its own id); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.text import kept


#: Sampled vectors that give queries their first bound, and queries that meet a cell's vectors in one task.
BOUND, QUERIES = 1000, 2048
#: So many queries' lists are ranked at once.
RANKED = 256
#: Lists around centroids of the vectors themselves, and lists in all.
FIRST_LISTS, MOST_LISTS = 4096, 1 << 18


@dataclass
class Index:
    rotation: np.ndarray  # dimensions + 1, squared
    centroids: np.ndarray  # rotated
    longest: float  # squared length to which vectors are lifted
    sample: np.ndarray  # original vectors, and their ids
    ids: np.ndarray
    lists: np.ndarray  # and the list of each
    fine: np.ndarray  # centroids of what is left, a row of zeros if lists aren't parted

    @property
    def n_lists(self) -> int:
        return len(self.centroids) * len(self.fine)

    def kth(self, q: np.ndarray, own: np.ndarray, near: np.ndarray, k: int) -> np.ndarray:
        """For each query the k-th largest inner product among the sampled vectors of the lists it probes, its own row left out; -inf for fewer.

        At least k of the vectors that the query scans are no worse, so whatever is worse can't be among its k nearest.
        """
        out = np.full(len(q), -np.inf)
        sample, ids, lists = self.sample[:BOUND], self.ids[:BOUND], self.lists[:BOUND]
        if len(sample) <= k:
            return out
        for i in range(0, len(q), 256):
            probed = np.zeros((len(q[i : i + 256]), self.n_lists), bool)
            np.put_along_axis(probed, near[i : i + 256], True, 1)
            inner = q[i : i + 256] @ sample.T
            inner[~probed[:, lists] | (own[i : i + 256, None] == ids)] = -np.inf
            out[i : i + 256] = np.partition(inner, len(sample) - k, axis=1)[:, len(sample) - k]
        return out

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the added dimension (0 for queries), rotated."""
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest - (x**2).sum(1), 0))
        return np.column_stack([x, more]) @ self.rotation

    def far(self, x: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Squared distance, less the vector's own length, of each vector to the lists of its given first centroids (vectors x firsts x parts)."""
        c, f = self.centroids, self.fine
        own = (c**2).sum(1)[firsts] - 2 * np.take_along_axis(x @ c.T, firsts, 1)
        return own[:, :, None] + 2 * (c @ f.T)[firsts] + (f**2).sum(1) - 2 * (x @ f.T)[:, None, :]

    def ranked(self, x: np.ndarray, most: int | None = None) -> np.ndarray:
        """The lists of each vector, nearest first: those of its ``most`` nearest first centroids, or all."""
        m, n = len(self.fine), len(self.centroids)
        firsts = np.tile(np.arange(n), (len(x), 1))
        if most is not None and most < n:
            firsts = np.argpartition((self.centroids**2).sum(1) - 2 * x @ self.centroids.T, most - 1, axis=1)[:, :most]
            firsts.sort(1)
        order = np.argsort(self.far(x, firsts).reshape(len(x), -1), axis=1, kind="stable")
        return np.take_along_axis((firsts[:, :, None] * m + np.arange(m)).reshape(len(x), -1), order, 1)

    def own_list(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector: the nearest first centroid, and the nearest of the others to what is left."""
        first = ((self.centroids**2).sum(1) - 2 * x @ self.centroids.T).argmin(1)
        left = x - self.centroids[first]
        return first * len(self.fine) + ((self.fine**2).sum(1) - 2 * left @ self.fine.T).argmin(1)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, e): vectors without null or non-finite components and not zero, in double precision."""
    e = F.transform(embedding, lambda v: v.cast("double"))
    fine = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("e", lambda v: v != 0)
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("e")).where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & fine)


def build(vectors: DataFrame, lists: int, k: int, reach: float, most: int = 20_000, rounds: int = 10, seed: int = 0) -> tuple[Index, int, int]:
    """Rotation and centroids from a sample of at most ``most`` vectors, first in a seeded hash order; the usual dimension; the lists to probe.

    So many lists are probed that they hold the share ``reach`` of the exact ``k`` nearest neighbours of 256 sampled vectors within the sample.
    With all vectors in the index neighbours are nearer than within the sample, so more of them are met.
    """
    ids = vectors.select("vec_id").distinct().orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(most)
    longest = vectors.agg(F.max(F.aggregate("e", F.lit(0.0), lambda a, v: a + v * v)).alias("m")).first()["m"]
    rows = [(np.array(r["e"]), r["vec_id"]) for r in vectors.join(F.broadcast(ids), "vec_id").orderBy("vec_id").limit(2 * most).collect()]
    sizes = np.bincount([len(r) for r, _ in rows]) if rows else np.zeros(2, int)
    width = max(1, int(sizes.argmax()))
    x = np.array([r for r, _ in rows if len(r) == width]).reshape(-1, width)
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((width + 1, width + 1)))
    index = Index(rotation, np.zeros((1, width + 1)), float(longest or 0.0), x, np.array([v for r, v in rows if len(r) == width]), np.zeros(len(x), int), np.zeros((1, width + 1)))

    def means(z: np.ndarray, many: int) -> np.ndarray:
        centres = z[rng.choice(len(z), min(many, len(z)), replace=False)]
        for _ in range(rounds):
            of = ((centres**2).sum(1) - 2 * z @ centres.T).argmin(1)
            sums, n = np.zeros_like(centres), np.bincount(of, minlength=len(centres))
            np.add.at(sums, of, z)
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        return centres

    if len(x):
        z = np.unique(index.lifted(x).round(12), axis=0)
        index.centroids = means(z, min(lists, FIRST_LISTS))
        if lists > FIRST_LISTS and len(index.centroids) == FIRST_LISTS:
            first = ((index.centroids**2).sum(1) - 2 * z @ index.centroids.T).argmin(1)
            index.fine = means(z - index.centroids[first], -(-lists // FIRST_LISTS))
    if len(x) < 2:
        return index, width, 1
    z, asked = index.lifted(x), rng.choice(len(x), min(256, len(x), max(16, (1 << 22) // index.n_lists)), replace=False)
    inner = x[asked] @ x.T
    inner[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(x) - 1)
    nearest_k = np.argpartition(-inner, k - 1, axis=1)[:, :k]
    place = np.argsort(index.ranked(index.lifted(x[asked], True)), axis=1)
    of = index.lists = index.own_list(z)
    ranks = np.sort(np.take_along_axis(place, of[nearest_k], 1).ravel())
    return index, width, int(ranks[min(len(ranks) - 1, int(np.ceil(reach * len(ranks))))]) + 1


def scanned(x: np.ndarray, q: np.ndarray, k: int, most: float = np.inf, cut: int = 16, strict: float = 2.1) -> np.ndarray:
    """Adaptive dimension scan of one list's rotated candidates for one rotated query: the candidates that were never abandoned.

    The hypothesis that a candidate is within the k-th distance so far is rejected when its partial distance over d of D
    dimensions exceeds d / D * (1 + strict / sqrt(d))**2 times that distance.  ``most``: a distance that the k-th is known not to exceed.
    """
    alive, width = np.arange(len(x)), x.shape[1]
    if not len(alive):
        return alive
    part, worst = ((x[:, :cut] - q[:cut]) ** 2).sum(1), most
    if len(alive) > 2 * k and not np.isfinite(most):
        some = np.argpartition(part, 2 * k - 1)[: 2 * k]  # those nearest so far, in full, give the first k-th distance
        worst = np.partition(((x[some] - q) ** 2).sum(1), k - 1)[k - 1]
    for d in range(cut, width + cut, cut):
        d = min(d, width)
        limit = worst if d == width else worst * d / width * (1 + strict / np.sqrt(d)) ** 2
        keep = part <= limit * (1 + 1e-9) + 1e-12
        alive, part = alive[keep], part[keep]
        if d == width:
            return alive
        part = part + ((x[alive, d : d + cut] - q[d : d + cut]) ** 2).sum(1)
    return alive


def cells(counts: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(list, first cell, number of cells): small lists share a cell of about ``most`` vectors, large ones have several of their own."""
    out, cell, inside = [], 0, 0
    for name, n in sorted(counts):
        if n > most:
            cell += inside > 0
            own = -(-n // most)
            out.append((name, cell, own))
            cell, inside = cell + own, 0
        else:
            if inside and inside + n > most:
                cell, inside = cell + 1, 0
            out.append((name, cell, 1))
            inside += n
    return out


def search(vectors: DataFrame, is_query, k: int = 20, cell: int = 2048, reach: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for every query row, among all other rows.

    There are twice as many lists as the square root of the number of vectors, ``MOST_LISTS`` at most.  Lists share cells of about ``cell`` vectors, and a list of
    more is cut into several by a hash of the id, so no task holds a crowded list; a query goes to each cell that has a list it probes.
    """
    spark = vectors.sparkSession
    rows = kept(usable(vectors, vec_id, embedding))
    n = rows.count()
    index, width, n_probe = build(rows, int(np.clip(round(2 * np.sqrt(n)), 1, MOST_LISTS)), k, reach, seed=seed)
    held = spark.sparkContext.broadcast(index)
    rows = rows.where(F.size("e") == width)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = held.value.lifted(np.array(b["e"].tolist()))
                yield pd.DataFrame({"vec_id": b["vec_id"], "e": b["e"], "list": held.value.own_list(x).astype(np.int32)})

    listed = kept(rows.mapInPandas(assign, "vec_id long, e array<double>, list int"))
    counts = [(r["list"], r["count"]) for r in listed.groupBy("list").count().collect()]  # a row for each list
    dealt = cells(counts, cell)
    sizes = np.zeros(index.n_lists, np.int64)
    # first centroids whose lists a query ranks: enough for several times the lists it probes
    firsts = max(64, -(-8 * n_probe // len(index.fine))) if len(index.fine) > 1 else None
    for name, many in counts:
        sizes[name] = many
    where = spark.sparkContext.broadcast({name: range(first, first + own) for name, first, own in dealt})

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for i in range(0, len(whole), RANKED):
                b = whole.iloc[i : i + RANKED]
                e = np.array(b["e"].tolist())
                order = held.value.ranked(held.value.lifted(e, True), firsts)
                near = order[:, :n_probe]
                # lists enough for k candidates and more, even where the nearest ones are almost empty
                enough = (np.cumsum(sizes[order], 1) < 2 * k + 2).sum(1) + 1
                lists_of = [o[: max(n_probe, m)] for o, m in zip(order.tolist(), enough.tolist(), strict=True)]
                # of the 2 k-th: should the test abandon a few of those by mistake, k are left still
                least = held.value.kth(e, b["vec_id"].to_numpy(), near, 2 * k) - 1e-9
                to: list[dict[int, list[int]]] = []
                for lists in lists_of:
                    own: dict[int, list[int]] = {}
                    for name in lists:
                        for c in where.value.get(name, ()):
                            own.setdefault(c, []).append(name)
                    to.append(own)
                times = [len(x) for x in to]
                yield pd.DataFrame(
                    {
                        "to_cell": [c for x in to for c in x], "query": b["vec_id"].repeat(times), "q": b["e"].repeat(times), "least": least.repeat(times),
                        "lists": [v for x in to for v in x.values()], "home": [i == 0 for x in to for i in range(len(x))],
                    }
                )

    places = F.broadcast(spark.createDataFrame(dealt or [(0, 0, 1)], "list int, first int, own int"))
    placed = listed.join(places, "list").select((F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("own"))).cast("int").alias("cell"), "vec_id", "e", "list")
    asked = rows.where(is_query).mapInPandas(probes, "to_cell int, query long, q array<double>, least double, lists array<int>, home boolean")

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            left = left.sort_values("list", kind="stable")
            x, ids, of = np.array(left["e"].tolist()), left["vec_id"].to_numpy(), left["list"].to_numpy()
            z, q = held.value.lifted(x), np.array(right["q"].tolist())
            least, asking, u = right["least"].to_numpy(), right["query"].to_numpy(), held.value.lifted(np.array(right["q"].tolist()), True)
            for i, lists in enumerate(right["lists"]):
                far = held.value.longest + q[i] @ q[i]  # a squared distance is this less twice the inner product
                j, score, worst = np.zeros(0, np.int64), np.zeros(0), least[i]
                for name in lists:  # nearest first
                    a, b = np.searchsorted(of, [name, name + 1])
                    inside = np.arange(a, b)[ids[a:b] != asking[i]]
                    new = inside[scanned(z[inside], u[i], k, far - 2 * worst)]
                    own = x[new] @ q[i]
                    new, own = new[own >= worst], own[own >= worst]
                    if len(new):
                        j, score = np.concatenate([j, new]), np.concatenate([score, own])
                        best = np.lexsort((ids[j], -score))[:k]
                        j, score = j[best], score[best]
                        if len(j) == k:
                            worst = max(worst, score[-1])  # the k-th so far: what is worse can't be among the nearest
                found.append((np.full(len(j), asking[i]), ids[j], score))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True))).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    asked = kept(asked)

    def meet(asking: DataFrame) -> DataFrame:
        """The nearest of each cell for the queries that ask it."""
        blocks = asking.groupBy("to_cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
        own = asking.join(blocks, "to_cell").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).drop("blocks", "home")
        there = placed.join(blocks.withColumnRenamed("to_cell", "cell"), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        return there.groupBy("cell", "block").cogroup(own.groupBy("to_cell", "block")).applyInPandas(scan, "query_id long, vec_id long, score double")

    # the cell of the nearest list first: its k-th score is where the other cells' lists begin
    near_by = kept(meet(asked.where("home")))
    kth = near_by.groupBy(F.col("query_id").alias("query")).agg((F.min("score") - 1e-9).alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).drop("n")
    others = asked.where("not home").join(kth, "query", "left").withColumn("least", F.greatest("least", "kth")).drop("kth")
    found = near_by.unionByName(meet(others.select(asked.columns)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
