"""Operator 9: approximate nearest neighbours with a vantage-point tree per shard.

Nearest means largest inner product. One more component makes all vectors of a shard equally long
and gives queries 0, so that the largest product is the smallest Euclidean distance, where the
triangle inequality holds. A tree splits its vectors at the median distance from a vantage point.
A query at distance ``d`` from it skips the ball of radius ``r`` if ``d - factor * t > r`` and the
rest if ``d + factor * t < r``, where ``t`` is its distance to the k-th best found so far; with
factor 1 nothing is lost, a smaller one skips more. All queries of a block walk the tree together,
and a shard's tree is built once for all blocks that meet it in a task.

Every vector is in a tree; nothing is sampled. Scores are inner products of the original vectors
in doubles.

Defined cases: vectors that are null, empty, all zero or hold a null or non-finite component take
no part, nor do rows without id. A query meets only vectors of its own length. Rows with a query's
own id are no candidates of it; other repeated rows each count. Ties go to the smaller id. An
empty table gives an empty table.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import tiles

K = 20
FACTOR = 0.6
LEAF = 128


class VantageTree:
    """Median splits by distance from a vantage point; vectors are reordered so that every node
    is a range of them."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.reach = norms.max()
        self.order = np.arange(len(vectors))
        self.points = np.concatenate([vectors, np.sqrt(np.maximum(self.reach - norms, 0))[:, None]], axis=1)
        self.leaf = leaf
        self.root = self._build(0, len(vectors))
        self.points = self.points[self.order]
        self.vectors = vectors[self.order]
        self.place = np.argsort(self.order)

    def _build(self, a: int, b: int):
        if b - a <= self.leaf:
            return (a, b)
        mine = self.points[self.order[a:b]]
        centre = mine.mean(axis=0)
        point = mine[np.argmax(((mine - centre) ** 2).sum(axis=1))]
        distance = np.sqrt(((mine - point) ** 2).sum(axis=1))
        rank = np.argsort(distance, kind="stable")
        self.order[a:b] = self.order[a:b][rank]
        middle = (b - a) // 2
        return (a, b, point, distance[rank[middle - 1]], distance[rank[middle]], self._build(a, a + middle), self._build(a + middle, b))

    def search(self, q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, k: int, factor: float):
        """Rows (query number, place in the shard, score) that hold the best found."""
        self.q_ids, self.ids, self.k, self.factor = q_ids, ids[self.order], k, factor
        self.queries = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        self.square = np.einsum("ij,ij->i", queries, queries) + self.reach
        self.best = np.full((len(queries), k), -np.inf)
        self.where = np.full((len(queries), k), -1)
        self.visited = 0
        self._visit(self.root, np.arange(len(queries)))
        rows, columns = np.nonzero(self.where >= 0)
        return rows, self.order[self.where[rows, columns]], self.best[rows, columns]

    def _limit(self, who: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square[who] - 2 * self.best[who].min(axis=1), 0)) * self.factor

    def _visit(self, node, who: np.ndarray) -> None:
        if not len(who):
            return
        if len(node) == 2:
            self._scan(*node, who)
            return
        _, _, point, inner, outer, near, far = node
        distance = np.sqrt(np.maximum(((self.queries[who] - point) ** 2).sum(axis=1), 0))
        inside = distance < (inner + outer) / 2
        for first, second, mine in ((near, far, inside), (far, near, ~inside)):
            self._visit(first, who[mine])
            rest, d = who[mine], distance[mine]
            limit = self._limit(rest)
            open_to = d + limit >= outer if second is far else d - limit <= inner
            self._visit(second, rest[open_to])

    def _scan(self, a: int, b: int, who: np.ndarray) -> None:
        self.visited += len(who) * (b - a)
        scores = self.queries[who, :-1] @ self.vectors[a:b].T
        scores[self.q_ids[who][:, None] == self.ids[None, a:b]] = -np.inf
        useful = scores.max(axis=1) >= self.best[who].min(axis=1)
        who, scores = who[useful], scores[useful]
        if not len(who):
            return
        all_scores = np.concatenate([self.best[who], scores], axis=1)
        all_where = np.concatenate([self.where[who], np.broadcast_to(np.arange(a, b), scores.shape)], axis=1)
        ids = np.where(all_where >= 0, self.ids[np.maximum(all_where, 0)], np.iinfo(np.int64).max)
        order = np.lexsort((ids, -all_scores), axis=1)[:, : self.k]
        best = np.take_along_axis(all_scores, order, axis=1)
        where = np.take_along_axis(all_where, order, axis=1)
        where[best == -np.inf] = -1
        self.best[who], self.where[who] = best, where


def _tile(q_ids, q, ids, tree: VantageTree, k: int, factor: float):
    rows, places, _ = tree.search(q_ids, q, ids, k, factor)
    scores = np.einsum("ij,ij->i", q[rows], tree.vectors[tree.place[places]])
    return q_ids[rows], ids[places], scores


def nearest(
    vectors: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, leaf: int = LEAF, **sizes
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``is_query`` is a condition on ``vec_id``."""
    if not 0 < factor <= 1:
        raise ValueError("the factor is above 0 and at most 1")
    rows = tiles.usable(vectors).where(F.exists("vector", lambda x: x != 0))
    build = functools.partial(VantageTree, leaf=leaf)
    tile = functools.partial(_tile, k=k, factor=factor)
    return tiles.search(rows, is_query, build, tile, k, "double", **sizes)
