"""Nearest neighbours by largest inner product over balanced posting lists.

Equal vectors are one class that carries its smallest ids, as many as an answer
can need. Classes are clustered: centroids come from balanced k-means on a
bounded sample (``sample`` vectors, ``most_lists`` centroids), where a cluster
that is full costs more. A vector goes to its nearest centroids, replicated to
those within ``boundary`` times the nearest distance. A query searches a
neighbour graph over the centroids, held in memory by each task, and keeps the
lists within ``prune`` times the nearest distance, ``least`` to ``probes`` of them. Lists
beyond ``block`` vectors are dealt into blocks, and so are the queries of a
list, so that no task holds a list whole; blocks answer with their best classes
and the best of those are expanded to ids.

Inner product is turned into distance by one more component that gives all
vectors the largest norm; scores are inner products of the original vectors in
double precision. All classes are in the index; only the centroids are fitted on
the sample. The model's size is bounded by ``most_lists``.

Defined results: null, zero or non-finite vectors and those not of the most
frequent length (of equally frequent ones the longest) take no part; a null id
takes no part; fewer candidates than asked for give fewer rows; of rows that
repeat an id the smallest vector counts, once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackgrid.session import cut


@dataclass(frozen=True)
class Settings:
    sample: int = 32_768
    most_lists: int = 2_048
    list_size: int = 128
    copies: int = 4
    boundary: float = 1.25
    probes: int = 160
    prune: float = 1.8
    least: int = 16
    degree: int = 24
    beam: int = 192
    block: int = 2_048


def usable(rows: DataFrame) -> DataFrame:
    """Rows that take part: id and vector (as doubles)."""
    v = F.col("vector")
    ok = rows.filter(F.col("id").isNotNull() & v.isNotNull()).filter(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    length = ok.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    whole = F.transform(F.col("vector").cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 counts as 0.0
    return ok.filter(F.size("vector") == (length["n"] if length else 0)).select("id", whole.alias("vector")).groupBy("id").agg(F.min("vector").alias("vector"))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """vector, the k + 1 smallest ids of it, and class, the smallest; a copied vector is thinned in two steps."""
    rank = lambda *by: F.row_number().over(Window.partitionBy("vector", *by).orderBy("id"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("r", rank("salt")).filter(F.col("r") <= k + 1)
    few = salted.withColumn("r", rank()).filter(F.col("r") <= k + 1)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("class", F.element_at("ids", 1))


def kmeans(x: np.ndarray, lists: int, rounds: int = 10, weight: float = 0.05) -> np.ndarray:
    """Balanced k-means: a centroid's distance grows with the share of vectors it already has."""
    rng = np.random.default_rng(4)
    c = x[rng.choice(len(x), lists, replace=False)].copy()
    load = np.zeros(lists)
    scale = float(((x - x.mean(0)) ** 2).sum(1).mean()) or 1.0
    for _ in range(rounds):
        near = np.concatenate([(distances(x[at : at + 4096], c) + weight * scale * load).argmin(1) for at in range(0, len(x), 4096)])
        size = np.bincount(near, minlength=lists)
        load = np.minimum(4.0, size * lists / len(x))
        order = np.argsort(near, kind="stable")
        full = np.flatnonzero(size)
        c[full] = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(size[full])[:-1]]), axis=0) / size[full, None]
        empty = np.flatnonzero(size == 0)
        if len(empty):
            c[empty] = x[rng.choice(len(x), len(empty))]
    return c


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :])


@dataclass
class Graph:
    """Centroids with a neighbour graph; searched best first from fixed entries."""

    centroids: np.ndarray
    near: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray, degree: int) -> Graph:
        n, degree = len(centroids), min(degree, len(centroids) - 1)
        links = [np.argsort(distances(centroids[at : at + 512], centroids), axis=1)[:, 1 : degree + 1] for at in range(0, n, 512)]
        near = np.concatenate(links) if degree else np.zeros((n, 0), np.int64)
        rng = np.random.default_rng(5)
        far = rng.integers(0, n, (n, min(4, n)))  # a few long links keep the graph in one piece
        return cls(centroids, np.concatenate([near, far], axis=1), rng.choice(n, min(n, 32), replace=False))

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """[queries, beam] centroids and squared distances, nearest first (-1 and inf where there are fewer)."""
        m, n, step = len(q), len(self.centroids), 4
        beam = min(beam, n)
        norm, qq = (self.centroids**2).sum(1), (q * q).sum(1)
        seen = np.zeros((m, n + 1), bool)
        rows = np.arange(m)[:, None]
        ids = np.full((m, beam), n)
        dist = np.full((m, beam), np.inf)
        done = np.ones((m, beam), bool)
        new = np.broadcast_to(self.entries, (m, len(self.entries)))
        while True:
            fresh = ~seen[rows, new]
            # a centroid that several expanded ones link to comes in once
            order = np.argsort(new, axis=1, kind="stable")
            same = np.zeros_like(fresh)
            ordered = np.take_along_axis(new, order, 1)
            np.put_along_axis(same, order, np.concatenate([np.zeros((m, 1), bool), ordered[:, 1:] == ordered[:, :-1]], axis=1), 1)
            fresh &= ~same
            seen[rows, new] = True
            at = np.minimum(new, n - 1)
            d = norm[at] + qq[:, None] - 2 * np.einsum("md,mkd->mk", q, self.centroids[at])
            d = np.where(fresh & (new < n), np.maximum(d, 0), np.inf)
            ids, dist, done = (np.concatenate(x, axis=1) for x in ((ids, new), (dist, d), (done, ~np.isfinite(d))))
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = (np.take_along_axis(x, order, 1) for x in (ids, dist, done))
            todo = np.argsort(done, axis=1, kind="stable")[:, :step]
            open_ = ~np.take_along_axis(done, todo, 1)
            if not open_.any():
                return np.where(np.isfinite(dist), ids, -1), dist
            np.put_along_axis(done, todo, True, 1)
            pick = np.where(open_, np.take_along_axis(ids, todo, 1), n)
            links = np.concatenate([self.near, np.full((1, self.near.shape[1]), n)])
            new = links[np.minimum(pick, n)].reshape(m, -1)


def index_of(classes: DataFrame, s: Settings) -> tuple[Graph | None, float]:
    """The centroid graph, fitted on at most ``sample`` vectors, and the largest squared norm."""
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).first()
    if not stats["n"]:
        return None, 0.0
    few = classes.select("class", "vector").orderBy(F.xxhash64("class"), "class").limit(s.sample).select("vector").toArrow()
    x = lifted(matrix(few.column(0).combine_chunks()), stats["top"])
    lists = int(max(1, min(s.most_lists, stats["n"] // s.list_size, len(x))))
    return Graph.build(kmeans(x, lists), s.degree), stats["top"]


def matrix(vectors: pa.Array) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def lifted(x: np.ndarray, top: float, query: bool = False) -> np.ndarray:
    """One more component, so that nearest by distance is largest by inner product."""
    more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, top - (x * x).sum(1)))
    return np.concatenate([x, more[:, None]], axis=1)


def dealt(rows: DataFrame, graph: Graph, top: float, s: Settings, query: bool) -> DataFrame:
    """(class, vector, list): a row per list that holds the vector, or that the query visits."""
    most, ratio, beam = (s.probes, s.prune, s.beam) if query else (s.copies, s.boundary, max(32, 4 * s.copies))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids, d = graph.search(lifted(matrix(some.column(1)), top, query), beam)
                ids, d = ids[:, :most], d[:, :most]
                ok = (ids >= 0) & (d <= ratio**2 * np.maximum(d[:, :1], 1e-12))
                ok[:, : s.least if query else 1] |= ids[:, : s.least if query else 1] >= 0
                row, col = np.nonzero(ok)
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), pa.array(ids[row, col].astype(np.int32))], names=["class", "vector", "list"])

    return rows.select("class", "vector").mapInArrow(run, "class long, vector array<double>, list int")


def blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their block of the list, and how many blocks each list has (a row per list)."""
    rows = cut(rows, f"ann-{name}")
    count = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias("n"))
    return rows, cut(count, f"ann-{name}-blocks")


def nearest(rows: DataFrame, queries: Column, k: int = 20, s: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score from (id, vector); ``queries`` says which ids ask."""
    good = cut(usable(rows), "ann-vectors")
    classes = cut(classes_of(good, k), "ann-classes")
    graph, top = index_of(classes, s)
    if graph is None:
        return good.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asking = cut(good.filter(queries).join(classes.select("vector", "class"), "vector").select("id", "class", "vector"), "ann-queries")
    lists, held = blocks(dealt(classes, graph, top, s, False), s.block, "lists")
    asks, asked = blocks(dealt(asking.dropDuplicates(["class"]), graph, top, s, True), s.block, "asks")
    turn = lambda n: F.pmod(F.xxhash64("class", F.lit(9)), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sizes = held.withColumnRenamed("n", "held").join(asked.withColumnRenamed("n", "asked"), "list")
    left = lists.join(sizes, "list").withColumn("hb", turn("held")).withColumn("ab", spread("asked")).select("list", "hb", "ab", "class", "vector")
    right = asks.join(sizes, "list").withColumn("ab", turn("asked")).withColumn("hb", spread("held")).select("list", "hb", "ab", "class", "vector")
    want = k + 1

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        """The best classes of a block of a list for each query of a block."""
        take, score, who = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        if a.num_rows and b.num_rows:
            x, ids = matrix(a.column("vector")), a.column("class").to_numpy()
            ask, names = matrix(b.column("vector")), b.column("class").to_numpy()
            keep = min(len(x), want + 4)  # a few more than wanted: the matrix product may differ in the last bits
            for at in range(0, len(ask), 128):
                some = ask[at : at + 128]
                col = np.argpartition(-(some @ x.T), keep - 1, axis=1)[:, :keep]
                exact = (some[:, None, :] * x[col]).sum(2)
                order = np.lexsort((ids[col], -exact), axis=1)[:, :want]
                take.append(ids[np.take_along_axis(col, order, 1)].ravel())
                score.append(np.take_along_axis(exact, order, 1).ravel())
                who.append(np.repeat(names[at : at + 128], order.shape[1]))
        return pa.table({"query": np.concatenate(who), "class": np.concatenate(take), "score": np.concatenate(score)})

    keys = ["list", "hb", "ab"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "query long, class long, score double")
    first = lambda n, by, *order: F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), *order)) <= n
    # a class may stand in several lists; the best k + 1 classes of a query hold its k nearest ids
    ranked = found.distinct().withColumn("ok", first(2 * want, "query", "class")).filter("ok")
    expanded = ranked.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    expanded = expanded.withColumn("ok", first(want, "query", "vec_id")).filter("ok").drop("ok")
    answer = asking.select(F.col("id").alias("query_id"), F.col("class").alias("query")).join(expanded, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answer.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
