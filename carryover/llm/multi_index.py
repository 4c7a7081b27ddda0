"""Approximate nearest neighbours with an inverted multi-index.

A vector is cut into two halves, each quantised by its own codebook of ``k``
centroids; the pair of centroids is its cell.  A query orders the centroids of
both halves by distance and walks the grid of pairs by summed squared
distance, with a heap of the cells that may come next (the multi-sequence
algorithm), until the cells met hold enough entries.  Their entries are
reranked by exact Euclidean distance in double precision.

How many entries are enough is measured, not guessed: for ``TRIALS`` vectors
the exact neighbours are found by one pass over all rows in blocks, and the
walk length that reaches ``REACH`` of them is taken for all queries.

At scale: codebooks are fitted on at most ``SAMPLE`` vectors (least id hashes);
every row is indexed.  The codebooks and the cells' row counts go to the
tasks: ``2 k`` centroids and ``k * k`` numbers, ``k`` at most ``MOST_CENTROIDS``.
Queries meet entries in a co-grouped join on (slab of cells, block of entries,
block of queries): a cell with more than ``BLOCK`` entries or queries is cut into such
blocks at random, so a vector that a third of the rows share fills many tasks,
not one.  Each block keeps ``top`` neighbours a query before the last shuffle.

Cases: null, empty and zero vectors, vectors with a null, infinite or NaN
component or of another length than most take no part, as query or candidate;
nor do rows with a null id; equal distances go to the smaller id; a query
never finds its own id; rows that repeat an id are all candidates, and one
query (of the least vector) if it is one; a query with fewer than ``top``
candidates returns all it found; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces_of, stored

SAMPLE = 40_000
#: Queries whose walks are one task's.
WALKS = 200
MOST_CENTROIDS = 512
BLOCK = 4096
TRIALS = 128
REACH = 0.985


def usable(vector: str = "vec") -> Column:
    """No null, no non-finite component, not zero."""
    return F.expr(
        f"{vector} IS NOT NULL AND size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) "
        f"AND abs(x) < double('infinity')) AND exists({vector}, x -> x <> 0)"
    )


def k_means(x: np.ndarray, k: int, steps: int = 15, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm from distinct starting points; fewer centroids if there are fewer points."""
    points = np.unique(x, axis=0)
    k = min(k, len(points))
    centroids = points[np.random.default_rng(seed).permutation(len(points))[:k]].copy()
    for _ in range(steps):
        near = nearest(x, centroids)
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids)
    return centroids


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0)


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[i : i + 8192], centroids).argmin(1) for i in range(0, max(1, len(x)), 8192)])


def walk(d1: np.ndarray, d2: np.ndarray):
    """Pairs of centroids by rising summed distance (multi-sequence with a heap)."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b = d1[o1].tolist(), d2[o2].tolist()
    heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(o1[i]), int(o2[j])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (a[p] + b[q], p, q))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def best(distance: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` least, ties to the smaller id."""
    if len(distance) > top:
        edge = np.partition(distance, top - 1)[top - 1]
        near = np.flatnonzero(distance <= edge)
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((ids[near], distance[near]))[:top]]


class MultiIndex:
    """Codebooks, and the indexed rows ``vec_id, vec, cell`` as a stored table."""

    def __init__(self, vectors: DataFrame, k: int | None = None):
        """``vectors``: ``vec_id long, vec array<double>``, usable rows of one length."""
        self.size = vectors.count()
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toPandas()["vec"]
        x = np.stack([np.asarray(v, float) for v in sample])
        self.d = d = x.shape[1]
        self.half = d // 2
        k = k or min(MOST_CENTROIDS, max(4, 2 ** round(math.log2(math.sqrt(self.size / 64) + 1))))
        self.books = books = [k_means(x[:, : self.half], k), k_means(x[:, self.half :], k)]
        self.width = width = len(books[1])
        half = self.half

        def assign(batches):
            for batch in batches:
                v = matrix(batch.column(1), d)
                cell = nearest(v[:, :half], books[0]) * width + nearest(v[:, half:], books[1]) if len(v) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32))], names=["vec_id", "vec", "cell"])

        self.rows = stored(vectors.mapInArrow(assign, "vec_id long, vec array<double>, cell int"), "index")
        counts = self.rows.groupBy("cell").count().toPandas()
        self.counts = np.zeros(len(books[0]) * width, np.int64)
        self.counts[counts["cell"].to_numpy()] = counts["count"].to_numpy()

    def distances(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(v[:, : self.half], self.books[0]), squared(v[:, self.half :], self.books[1])

    def walk_length(self, top: int) -> int:
        """Entries to be met before the walk has reached ``REACH`` of the true neighbours of the trial vectors."""
        trial = self.rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(TRIALS).toPandas()
        ids, v, d = trial["vec_id"].to_numpy(), np.stack(trial["vec"].to_numpy()), self.d

        def nearest_here(batches):
            kept: list = [([], [], []) for _ in ids]
            for batch in batches:
                own, x, cell = batch.column(0).to_numpy(), matrix(batch.column(1), d), batch.column(2).to_numpy()
                for i, q in enumerate(v):
                    dist = np.sqrt(((x - q) ** 2).sum(1))
                    dist[own == ids[i]] = np.inf
                    s = best(dist, own, top)
                    parts = [np.concatenate([a, b[s]]) for a, b in zip(kept[i], (dist, own, cell))]
                    s = best(parts[0], parts[1], top)
                    kept[i] = tuple(p[s] for p in parts)
            for i, (dist, own, cell) in enumerate(kept):
                if len(dist):
                    yield pa.RecordBatch.from_pydict({"q": pa.array([i] * len(dist), pa.int32()), "dist": pa.array(dist, pa.float64()), "vec_id": pa.array(own.astype(np.int64)), "cell": pa.array(cell.astype(np.int32))})

        found = self.rows.mapInArrow(nearest_here, "q int, dist double, vec_id long, cell int").where(F.col("dist") < float("inf"))
        order = Window.partitionBy("q").orderBy("dist", "vec_id")
        cells = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).groupBy("q").agg(F.collect_list("cell").alias("cells"))
        needed = []
        for q, wanted in cells.collect():
            d1, d2 = self.distances(v[q : q + 1])
            met, wanted = 0, list(wanted)
            for i, j in walk(d1[0], d2[0]):
                cell = i * self.width + j
                needed += [met] * wanted.count(cell)
                wanted = [c for c in wanted if c != cell]
                if not wanted:
                    break
                met += int(self.counts[cell])
        return int(np.quantile(needed, REACH, method="higher")) + 1 if needed else 1

    def search(self, queries: DataFrame, top: int = 10) -> DataFrame:
        """``query_id, rank, vec_id, score``: the nearest found of each query ``query_id, qvec``."""
        enough = max(self.walk_length(top), top + 1)
        d, half, books, width, counts = self.d, self.half, self.books, self.width, self.counts

        def probe(batches):
            for batch in batches:
                v = matrix(batch.column(1), d)
                rows, cells = [], []
                d1, d2 = squared(v[:, :half], books[0]), squared(v[:, half:], books[1])
                for r in range(len(v)):
                    met = 0
                    for i, j in walk(d1[r], d2[r]):
                        n = int(counts[i * width + j])
                        if n:
                            rows.append(r)
                            cells.append(i * width + j)
                        met += n
                        if met >= enough:
                            break
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(cells, pa.int32())], names=["query_id", "qvec", "cell"])

        # walks are long work on short rows: dealt by number, not by bytes
        queries = stored(queries.select("query_id", "qvec"), "queries")
        queries = queries.repartition(pieces_of(queries.count(), WALKS), "query_id")
        probes = stored(queries.mapInArrow(probe, "query_id long, qvec array<double>, cell int"), "probes")
        spread = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK)).cast("int")
        blocks = probes.groupBy("cell").agg(F.count(F.lit(1)).alias("asked")).join(self.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("held")), "cell")
        # one row for each cell of the grid at most: k * k of them
        blocks = F.broadcast(stored(blocks.select("cell", spread("held").alias("e"), spread("asked").alias("q")), "blocks"))
        # small cells meet in slabs of about a block, so that a query leaves one list a slab, not one a cell
        slabs = max(1, math.ceil(self.size / BLOCK))
        slab = F.pmod(F.xxhash64("cell"), F.lit(slabs)).cast("int").alias("slab")
        entries = self.rows.join(blocks, "cell").withColumn("eb", F.pmod(F.xxhash64("vec_id", "vec"), "e").cast("int"))
        entries = entries.select(slab, "cell", "eb", F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"), "vec_id", "vec")
        asked = probes.join(blocks, "cell").withColumn("qb", F.pmod(F.xxhash64("query_id"), "q").cast("int"))
        asked = asked.select(slab, "cell", F.explode(F.sequence(F.lit(0), F.col("e") - 1)).alias("eb"), "qb", "query_id", "qvec")

        def rerank(entries: pa.Table, asked: pa.Table) -> pa.Table:
            out: list[list] = [[], [], []]
            if entries.num_rows and asked.num_rows:
                entries, asked = entries.sort_by("cell"), asked.sort_by("query_id")
                ids, x, cell = entries.column("vec_id").to_numpy(), matrix(entries.column("vec"), d), entries.column("cell").to_numpy()
                wanted, vectors = asked.column("cell").to_numpy(), matrix(asked.column("qvec"), d)
                low, high = np.searchsorted(cell, wanted), np.searchsorted(cell, wanted, side="right")
                who = asked.column("query_id").to_numpy()
                first = np.flatnonzero(np.diff(who, prepend=who[0] - 1))
                for a, b in zip(first.tolist(), [*first[1:].tolist(), len(who)]):
                    q = int(who[a])
                    at = np.concatenate([np.arange(i, j) for i, j in zip(low[a:b].tolist(), high[a:b].tolist())])
                    at = at[ids[at] != q]
                    score = np.sqrt(((x[at] - vectors[a]) ** 2).sum(1))
                    s = best(score, ids[at], top)
                    score, s = score[s], at[s]
                    for part, values in zip(out, ([q] * len(s), ids[s], score)):
                        part.extend(values)
            return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

        near = entries.groupBy("slab", "eb", "qb").cogroup(asked.groupBy("slab", "eb", "qb")).applyInArrow(rerank, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, is_query: Column, top: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Nearest neighbours of the rows for which ``is_query`` (over the id) holds."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable())
    length = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vec") == length["d"])
    queries = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vec").alias("qvec"))
    return MultiIndex(rows).search(queries, top)
