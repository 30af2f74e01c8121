"""Operator 8: exact top-k by tiled matrix products.

Each component becomes ``floor(scale * x)``. A tile is the integer product of a block of queries
with a shard of vectors; the best k of each query leave the tile, and lists merge as a tree (see
:mod:`threadloom.llm.tiles`). The product runs in doubles where the sums of a tile stay below
2**53, so that every step is exact, and in 64-bit integers beyond; scores beyond 64 bits wrap.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part,
nor do rows without id. A query meets only vectors of its own length. Rows with a query's own id,
repeated ones included, are no candidates of it; other repeated rows each count. Ties go to the
smaller id. A query without candidates has no row. An empty table gives an empty table.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame

from threadloom.llm import tiles

K = 10
SCALE = 1024


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(x * scale), -(2.0**62), 2.0**62)


def _tile(q_ids, q, ids, v, k: int, scale: int):
    q = _whole(q, scale)
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2.0**53:
        scores = (q @ v.T).astype(np.int64)
    else:
        scores = q.astype(np.int64) @ v.astype(np.int64).T
    rows, columns = tiles.best_of(scores, q_ids, ids, k)
    return q_ids[rows], ids[columns], scores[rows, columns]


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, **sizes) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; ``is_query`` is a condition on ``vec_id``."""
    whole = functools.partial(_whole, scale=scale)
    tile = functools.partial(_tile, k=k, scale=scale)
    return tiles.search(tiles.usable(vectors), is_query, whole, tile, k, "bigint", **sizes)


SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
