"""Nearest neighbours by inner product on robust-pruned directed graphs.

Vectors are dealt to shards by hash. Each shard is one graph: points are added in batches
that double in size; a greedy beam search from the entry point over the graph so far
proposes neighbours, and robust pruning keeps a near one only if no kept one is closer to
it by the factor ``ALPHA``, so that edges stay few and point in different directions.
Reversed edges are added and pruned alike. A query runs a beam search in every shard; the
shards' best are merged. Inner products become distances by one more component that brings
all vectors to one length, so vectors need no norm.

Equal vectors are one point that carries the smallest ``k + 1`` ids of its rows, which is
all that a list of k can show; a value that a third of the rows share is trimmed before the
shuffle. Queries meet a shard in blocks of ``QUERY_BLOCK``.

Defined results: rows with a null id or an unusable vector take no part; vectors of another
length than the query's are not compared; repeated rows count once; ties go to the smaller
id; an empty table gives no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiframe.llm import vectors
from epiframe.llm.tables import store

DEGREE, ALPHA = 32, 1.2
BUILD_BEAM, SEARCH_BEAM, EXPANDED = 64, 96, 4
BATCH = 512
#: Shards as long as none is larger than ``SHARD_ROWS``, which bounds a task's memory.
SHARDS, SHARD_ROWS = 8, 200_000
QUERY_BLOCK = 20_000


class Graph:
    def __init__(self, points: np.ndarray):
        norms = (points**2).sum(1)
        self.points = np.hstack([points, np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))[:, None]]).astype(np.float32)
        self.squares = (self.points**2).sum(1)
        self.edges = np.full((len(points), DEGREE), -1, np.int32)
        self.entry = int(((self.points - self.points.mean(0)) ** 2).sum(1).argmin()) if len(points) else 0

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Per query the ``beam`` nearest points that a greedy search meets, nearest first, -1 where there are fewer."""
        n = len(queries)
        ids, far = np.full((n, beam), -1, np.int64), np.full((n, beam), np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.points)), bool)
        ids[:, 0], open_[:, 0], seen[:, self.entry] = self.entry, True, True
        far[:, 0] = self.squares[self.entry] - 2 * queries @ self.points[self.entry]
        rows = np.arange(n)
        while len(rows):
            # the nearest open points of every query that still has one
            rank = np.argsort(np.where(open_[rows], far[rows], np.inf), 1, kind="stable")[:, :EXPANDED]
            go = np.take_along_axis(open_[rows], rank, 1)
            picked = np.where(go, np.take_along_axis(ids[rows], rank, 1), -1)
            open_[rows[:, None], rank] = False
            near = np.where(picked[:, :, None] >= 0, self.edges[picked], -1).reshape(len(rows), -1).astype(np.int64)
            near.sort(1)
            fresh = (near >= 0) & ~seen[rows[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            who, at = np.nonzero(fresh)
            new = near[who, at]
            seen[rows[who], new] = True
            gap = np.full(near.shape, np.inf, np.float32)
            gap[who, at] = self.squares[new] - 2 * np.einsum("ij,ij->i", self.points[new], queries[rows[who]])
            every = np.concatenate([far[rows], gap], 1)
            best = np.argpartition(every, beam - 1, 1)[:, :beam]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(every, best, 1), 1, kind="stable"), 1)
            far[rows] = np.take_along_axis(every, best, 1)
            ids[rows] = np.where(np.isfinite(far[rows]), np.take_along_axis(np.concatenate([ids[rows], near], 1), best, 1), -1)
            open_[rows] = np.take_along_axis(np.concatenate([open_[rows], fresh], 1), best, 1)
            rows = rows[open_[rows].any(1)]
        return ids

    def prune(self, of: np.ndarray, near: np.ndarray) -> np.ndarray:
        """At most ``DEGREE`` of the candidates of every point, -1 for none, no two in one direction."""
        near = np.where(near == of[:, None], -1, near)
        near = np.sort(near, 1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        x = self.points[near]
        gap = ((x - self.points[of][:, None, :]) ** 2).sum(2)
        gap[near < 0] = np.inf
        order = np.argsort(gap, 1, kind="stable")
        near, gap = np.take_along_axis(near, order, 1), np.take_along_axis(gap, order, 1)
        x = np.take_along_axis(x, order[:, :, None], 1)
        squares = (x**2).sum(2)
        alive, out = np.isfinite(gap), np.full((len(of), DEGREE), -1, np.int32)
        rows = np.arange(len(of))
        for slot in range(DEGREE):
            pick = alive.argmax(1)
            rows = rows[alive[rows, pick[rows]]]
            if not len(rows):
                break
            chosen = pick[rows]
            out[rows, slot] = near[rows, chosen]
            apart = squares[rows] + squares[rows, chosen][:, None] - 2 * np.einsum("ijk,ik->ij", x[rows], x[rows, chosen])
            alive[rows] &= ALPHA**2 * apart > gap[rows]
            alive[rows, chosen] = False
        return out

    def add(self, batch: np.ndarray) -> None:
        self.edges[batch] = self.prune(batch, self.search(self.points[batch], BUILD_BEAM))
        source, slot = np.nonzero(self.edges[batch] >= 0)
        to, back = self.edges[batch][source, slot], batch[source]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        # a point that many new ones chose looks at the nearest of them
        width = min(int(count.max(initial=0)), 2 * DEGREE)
        crowded = np.flatnonzero(count > width)
        if len(crowded):
            gap = ((self.points[to] - self.points[back]) ** 2).sum(1)
            order = np.lexsort((gap, to))
            to, back = to[order], back[order]
        place = np.arange(len(to)) - np.repeat(first, count)
        fresh = np.full((len(targets), width), -1, np.int64)
        use = place < width
        fresh[np.repeat(np.arange(len(targets)), count)[use], place[use]] = back[use]
        every = np.concatenate([self.edges[targets], fresh], 1)
        for part in np.array_split(np.arange(len(targets)), max(1, len(targets) // BATCH)):
            degree = (every[part] >= 0).sum(1)
            roomy, full = part[degree <= DEGREE], part[degree > DEGREE]
            self.edges[targets[roomy]] = -np.sort(-every[roomy], 1)[:, :DEGREE]
            if len(full):
                self.edges[targets[full]] = self.prune(targets[full], every[full])

    def build(self, seed: int = 11) -> "Graph":
        order = np.random.default_rng(seed).permutation(len(self.points))
        order = np.concatenate([[self.entry], order[order != self.entry]]).astype(np.int64)
        most = max(8, min(BATCH, 64_000_000 // max(1, len(order))))
        at = 1
        while at < len(order):
            step = min(at, most)
            self.add(order[at : at + step])
            at += step
        return self


def _build(k: int):
    def build(table: pa.Table) -> pa.Table:
        shard, ids = table["shard"][0].as_py(), table["vec_id"].to_numpy()
        points, member = np.unique(vectors.matrix(table["v"]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([member.ravel(), ids], 1), axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(points)))
        kept = np.arange(len(pairs)) - first[pairs[:, 0]] <= k
        graph = Graph(points).build()
        return pa.table({"shard": pa.array([shard], pa.int64()), "dim": pa.array([points.shape[1]], pa.int32()), "entry": [graph.entry], "points": [points.tobytes()], "edges": [graph.edges.tobytes()], "members": [pairs[kept].tobytes()]})

    return build


GRAPHS = "shard long, dim int, entry long, points binary, edges binary, members binary"


def index(df: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One graph per shard over all usable rows, with at least the ids that a list of ``k`` needs."""
    good = vectors.rows(df, vec_id, vector).filter(vectors.usable("v")).filter("vec_id is not null")
    shards = max(SHARDS, -(-good.count() // SHARD_ROWS))
    by_value = Window.partitionBy("v").orderBy("vec_id")
    few = good.withColumn("r", F.dense_rank().over(by_value)).filter(F.col("r") <= k + 1)
    dealt = few.withColumn("dim", F.size("v")).withColumn("shard", F.col("dim").cast("long") * 1_000_000 + F.pmod(F.xxhash64("v"), F.lit(shards)))
    return store(dealt.select("shard", "vec_id", "v").groupBy("shard").applyInArrow(_build(k), GRAPHS))


def _search(k: int):
    def search(key: tuple, graphs: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not graphs.num_rows or not queries.num_rows:
            return empty
        row = graphs.slice(0, 1).to_pylist()[0]
        points = np.frombuffer(row["points"]).reshape(-1, row["dim"])
        graph = Graph(points)
        graph.edges, graph.entry = np.frombuffer(row["edges"], np.int32).reshape(len(points), DEGREE), row["entry"]
        pairs = np.frombuffer(row["members"], np.int64).reshape(-1, 2)
        first = np.searchsorted(pairs[:, 0], np.arange(len(points) + 1))
        asked, q = queries["vec_id"].to_numpy(), vectors.matrix(queries["v"])
        wide = np.hstack([q, np.zeros((len(q), 1))]).astype(np.float32)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = max(1, min(1024, 64_000_000 // len(points)))
        for a in range(0, len(q), step):
            found = graph.search(wide[a : a + step], max(SEARCH_BEAM, 2 * k))
            who, slot = np.nonzero(found >= 0)
            point = found[who, slot]
            score = (points[point] * q[a + who]).sum(1)
            count = first[point + 1] - first[point]
            place = np.repeat(first[point] - np.cumsum(count) + count, count) + np.arange(count.sum())
            who, score, ids = np.repeat(who, count), np.repeat(score, count), pairs[place, 1]
            other = ids != asked[a + who]
            who, score, ids = who[other], score[other], ids[other]
            order = np.lexsort((ids, -score, who))
            who, score, ids = who[order], score[order], ids[order]
            start = np.searchsorted(who, np.arange(step + 1))
            best = np.arange(len(who)) - start[who] < k
            out.append((asked[a + who[best]], ids[best], score[best]))
        return pa.table({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("query_id", "vec_id", "score"))})

    return search


def nearest(df: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` rows with the largest inner product found for each query.

    ``queries`` says which rows ask; all rows but the asking one are candidates.
    """
    graphs = index(df, k, vec_id, vector)
    asking = vectors.rows(df.filter(queries), vec_id, vector).filter(vectors.usable("v")).filter("vec_id is not null").distinct()
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))
    shards = graphs.select(F.col("shard").alias("s"), "dim")  # one row per shard
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    sent = asking.withColumn("dim", F.size("v")).withColumn("block", block).join(F.broadcast(shards), "dim").select(F.col("s").alias("shard"), "block", "vec_id", "v")
    spread = graphs.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    found = spread.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInArrow(_search(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
