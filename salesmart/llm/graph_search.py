"""Approximate nearest neighbours by robust-pruned directed graphs.

1. Equal vectors collapse to one, with the few smallest ids any answer can
   need; distinct vectors are dealt in the order of their norms into shards of
   a bounded size.
2. Each shard builds its own graph.  Nodes come in batches that double in size:
   a greedy beam search over the graph so far proposes neighbours, relaxed
   distance pruning (a candidate goes if a kept neighbour is closer to it than
   the node by the factor ``alpha``) keeps diverse edges, and edges back are
   added and pruned alike.  Every node can be reached from the entry point.
3. Every query walks every shard with a beam; what it found is scored again in
   double precision, and the best of all shards are the answer.

The inner product is no distance: vectors get one more component, the root of
what they lack to the largest norm, so that the largest inner product is the
smallest Euclidean distance.  Scores never use it.  In a shard of similar norms
that component is small, and slots that pruning leaves free are filled with the
nearest candidates it covered; both keep recall up where norms differ much.

A task holds one shard (at most ``SHARD`` vectors) and one block of queries (at
most ``QUERIES``).  All work of a shard is NumPy over whole batches of nodes or queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import global_row_number
from .common import written

#: Most vectors of a shard, and most queries a task walks at once with it.
SHARD, QUERIES = 65_536, 65_536
#: Shards at least, so that a small table is spread too.
SPREAD = 16
#: Out-degree, beam width and the factor by which pruning is relaxed.
DEGREE, BEAM, ALPHA = 32, 64, 1.2
_BATCH = 1024


class Graph:
    """A directed graph over the rows of ``x`` (float64, distinct, finite, not zero)."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA):
        self.degree, self.beam, self.alpha = degree, max(beam, degree), alpha
        self.scale = float(np.abs(x).max())
        y = x / self.scale
        norm2 = (y * y).sum(axis=1)
        extra = np.sqrt(np.maximum(norm2.max() - norm2, 0))
        self.points = np.concatenate([y, extra[:, None]], axis=1).astype(np.float32)
        self.entry = int(((self.points - self.points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        self.edges = np.full((len(x), degree + 1), -1, np.int32)

    def build(self) -> Graph:
        n = len(self.points)
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]])
        done = 1
        while done < n:
            batch = order[done:done + min(max(done, 16), _BATCH)]
            self._insert(batch)
            done += len(batch)
        self._reach_all()
        return self

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, squared distances) of the ``width`` nearest found, nearest first, -1 where there are fewer; and all ids expanded."""
        q, n = len(queries), len(self.points)
        ids = np.full((q, width), -1, np.int64)
        dist = np.full((q, width), np.inf, np.float32)
        closed = np.ones((q, width), bool)
        seen = np.zeros((q, n), bool)
        ids[:, 0], closed[:, 0], seen[:, self.entry] = self.entry, False, True
        dist[:, 0] = ((queries - self.points[self.entry]) ** 2).sum(axis=1)
        walked = []
        every = np.arange(q)
        while len(every):
            # the nearest node of each beam that was not expanded yet
            at = np.where(closed[every], np.inf, dist[every]).argmin(axis=1)
            going = ~closed[every, at]
            every, at = every[going], at[going]
            if not len(every):
                break
            node = ids[every, at]
            closed[every, at] = True
            step = np.full(q, -1, np.int64)
            step[every] = node
            walked.append(step)
            near = self.edges[node].astype(np.int64)
            fresh = (near >= 0) & ~seen[every[:, None], near]
            near = np.where(fresh, near, -1)
            r, c = np.nonzero(fresh)
            seen[every[r], near[r, c]] = True
            d = np.full(near.shape, np.inf, np.float32)
            diff = self.points[near[r, c]] - queries[every[r]]
            d[r, c] = np.einsum("ij,ij->i", diff, diff)
            both_d = np.concatenate([dist[every], d], axis=1)
            best = np.argsort(both_d, axis=1, kind="stable")[:, :width]
            rows = np.arange(len(every))[:, None]
            ids[every] = np.concatenate([ids[every], near], axis=1)[rows, best]
            dist[every] = both_d[rows, best]
            closed[every] = np.concatenate([closed[every], ~fresh], axis=1)[rows, best]
        return ids, dist, np.stack(walked, axis=1) if walked else np.empty((q, 0), np.int64)

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """The kept edges of each node out of its candidates (-1: none): nearest first, dropping what a kept one covers."""
        cand = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        diff = self.points[cand] - self.points[nodes][:, None, :]
        d = np.einsum("ijk,ijk->ij", diff, diff)
        d[cand < 0] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
        width = int(np.isfinite(d).sum(axis=1).max(initial=0))
        cand, d = cand[:, :width], d[:, :width]
        vectors = self.points[cand]
        out, alive = np.full((len(nodes), self.degree), -1, np.int32), np.isfinite(d)
        left = alive.copy()
        rows = np.arange(len(nodes))
        for k in range(self.degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            out[some, k] = cand[rows, pick][some]
            diff = vectors - vectors[rows, pick][:, None, :]
            covered = self.alpha ** 2 * np.einsum("ijk,ijk->ij", diff, diff) <= d
            alive &= ~covered
            alive[rows, pick] = False
            left[rows[some], pick[some]] = False
        # slots that stay free go to the nearest candidates that were covered: norms that differ much leave few edges otherwise
        taken = (out >= 0).sum(axis=1)
        spare = np.argsort(~left, axis=1, kind="stable")[:, :self.degree]
        r, c = np.nonzero(np.take_along_axis(left, spare, 1) & (np.arange(spare.shape[1]) < (self.degree - taken)[:, None]))
        out[r, taken[r] + c] = cand[r, spare[r, c]]
        return out

    def _insert(self, batch: np.ndarray) -> None:
        # a block of queries sees one bit a node: keep that below some tens of MB
        size = max(16, min(len(batch), (32 << 20) // len(self.points)))
        for i in range(0, len(batch), size):
            nodes = batch[i:i + size]
            ids, _, walked = self.search(self.points[nodes], self.beam)
            self.edges[nodes, :-1] = self._prune(nodes, np.concatenate([ids, walked], axis=1))
        # edges back, of all new nodes at once
        targets = self.edges[batch, :-1]
        source, target = np.repeat(batch, self.degree), targets.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hit, start, count = np.unique(target, return_index=True, return_counts=True)
        for part in range(0, len(hit), _BATCH):
            h, s, c = hit[part:part + _BATCH], start[part:part + _BATCH], count[part:part + _BATCH]
            back = np.full((len(h), int(c.max())), -1, np.int64)
            col = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            back[np.repeat(np.arange(len(h)), c), col] = source[np.repeat(s, c) + col]
            both = np.concatenate([self.edges[h, :-1].astype(np.int64), back], axis=1)
            room = (both >= 0).sum(axis=1) <= self.degree
            kept = np.full((len(h), self.degree), -1, np.int32)
            if room.any():
                packed = np.take_along_axis(both[room], np.argsort(both[room] < 0, axis=1, kind="stable"), 1)
                packed = packed[:, :self.degree]
                kept[room, :packed.shape[1]] = packed
            full = np.flatnonzero(~room)
            for i in range(0, len(full), 128):
                kept[full[i:i + 128]] = self._prune(h[full[i:i + 128]], both[full[i:i + 128]])
            self.edges[h, :-1] = kept

    def _reach_all(self) -> None:
        """Hang each node that no path from the entry reaches under a reached one, by the slot every node keeps for that."""
        n = len(self.points)
        while True:
            reached, wave = np.zeros(n, bool), np.array([self.entry])
            reached[self.entry] = True
            while len(wave):
                near = np.unique(self.edges[wave])
                wave = near[near >= 0]
                wave = wave[~reached[wave]]
                reached[wave] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            ids, _, _ = self.search(self.points[lost[:1]], self.beam)
            homes = np.concatenate([ids[0][ids[0] >= 0], np.flatnonzero(reached)])
            home = homes[self.edges[homes, -1] < 0][0]                 # a node that was hung has its own slot free
            self.edges[home, -1] = lost[0]


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first component to the last."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j].astype(np.float64) * b[:, j].astype(np.float64)
    return out


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, every component present and finite."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda v: v != 0)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): each distinct vector with its ``keep`` smallest ids, ascending.

    The limit applies to each task's rows first: copies of one vector, however many, never meet in one task.
    """
    w = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def build_index(vectors: DataFrame, shards: int, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """(dim, shard, node, v, ids, edges): one graph a shard over ``vectors`` (v, ids); vectors of another length are apart."""
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ranked = global_row_number(vectors.withColumn("_norm", norm2), [F.size("v"), "_norm", F.xxhash64("v")], "_rn")
    rows = max(1, -(-ranked.count() // shards))
    dealt = ranked.select(F.size("v").alias("dim"), F.expr(f"CAST((_rn - 1) div {rows} AS INT)").alias("shard"), "v", "ids")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        order = np.lexsort(x.T[::-1])                                  # rows come in any order: the graph does not depend on it
        rows, x = rows.iloc[order], x[order]
        g = Graph(x, degree, beam, alpha).build()
        return pd.DataFrame({"dim": rows["dim"].to_numpy(), "shard": rows["shard"].to_numpy(), "node": np.arange(len(x)), "v": rows["v"].to_numpy(),
                             "ids": rows["ids"].to_numpy(), "entry": g.entry, "edges": list(g.edges)})

    kind = f"dim int, shard int, node int, v {dict(vectors.dtypes)['v']}, ids array<long>, entry int, edges array<int>"
    return dealt.groupBy("dim", "shard").applyInPandas(one, kind)


def search_index(index: DataFrame, queries: DataFrame, k: int, blocks: int = 1, beam: int = BEAM) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` best each shard finds for each query (id, v), the query's own id left out.

    Every block of queries meets every shard of its dimension.
    """
    shards = index.select(F.col("dim").alias("in_dim"), F.col("shard").alias("in_shard")).distinct()
    asked = queries.select(F.col("id").alias("query_id"), "v", F.size("v").alias("in_dim"),
                           F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("in_block")).join(shards, "in_dim")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def one(nodes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(nodes) and len(rows):
            nodes = nodes.sort_values("node")
            x = np.stack(nodes["v"].to_numpy()).astype(np.float64)
            g = Graph(x, len(nodes["edges"].iloc[0]) - 1, beam)
            g.entry, g.edges = int(nodes["entry"].iloc[0]), np.stack(nodes["edges"].to_numpy())
            ids_of, n_ids = nodes["ids"].to_numpy(), nodes["ids"].str.len().to_numpy()
            flat = np.concatenate(ids_of)
            first = np.cumsum(n_ids) - n_ids
            size = max(16, min(_BATCH, (32 << 20) // len(x)))
            width = min(max(beam, k + 1), len(x))
            q_ids = rows["query_id"].to_numpy(np.int64)
            qs = np.stack(rows["v"].to_numpy()).astype(np.float64)
            for i in range(0, len(rows), size):
                q, own = qs[i:i + size], q_ids[i:i + size]
                # any positive factor keeps a query's order of inner products
                scaled = np.concatenate([q / np.abs(q).max(axis=1, keepdims=True), np.zeros((len(q), 1))], axis=1).astype(np.float32)
                found, _, _ = g.search(scaled, width)
                r, c = np.nonzero(found >= 0)
                node = found[r, c]
                score = inner_products(q[r], x[node])
                # copies of a vector share its score: one line an id
                times = n_ids[node]
                r, score = np.repeat(r, times), np.repeat(score, times)
                at = np.repeat(first[node], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                vec = flat[at]
                other = vec != own[r]
                r, vec, score = r[other], vec[other], score[other]
                order = np.lexsort((vec, -score, r))
                r, vec, score = r[order], vec[order], score[order]
                starts = np.searchsorted(r, r)                         # first line of the same query
                top = np.arange(len(r)) - starts < k
                out["query_id"].append(own[r[top]])
                out["vec_id"].append(vec[top])
                out["score"].append(score[top])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()})

    return asked.groupBy("in_dim", "in_shard", "in_block").cogroup(held.groupBy("dim", "shard", "block")).applyInPandas(
        lambda rows, nodes: one(nodes, rows), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            shard_rows: int = SHARD, spread: int = SPREAD, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA,
            query_rows: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by inner product for every row for which ``is_query`` holds.

    * Ids are unique names: rows of one id are one row's repeats, a query never finds its own id.  An id with several
      vectors asks with the smallest of them and can be found by each, best score first, once.
    * Rows without an id, and vectors that are null, empty, zero or hold a null or non-finite component, take no part.
    * A vector only meets vectors of its own length.  Ties go to the smaller id.
    * Fewer than ``k`` candidates: all of them.  No query or no candidate: no rows.
    * Only the two named columns and those in ``is_query`` enter, so no other name can clash.
    """
    clean = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = clean.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    queries = clean.where(is_query).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    queries = written(queries, "ann_queries")
    one = written(distinct_vectors(rows, k + 1), "ann_vectors")
    shards = max(spread, -(-one.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    index = written(build_index(one, shards, degree, beam, alpha), "ann_index")
    found = search_index(index, queries, k, blocks, beam).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
