"""Query blocks against shards of vectors: the frame that exact and tree search share.

Vectors are packed into shards and queries into blocks, each a row of ids and one matrix. A shard
is packed and numbered by the task that read its vectors; every block of queries is copied to every
shard of its length and meets it there, one tile (block by shard) at a time. A tile returns the best of each of its
queries, and the lists of a query are merged as a tree: first in lanes of shards, then once more.
So neither the queries nor the vectors, however many, are ever together in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.shared import arrow_map
from threadloom.sources.tables import stage

SHARD_ROWS = 8192
BLOCK_ROWS = 512
LANES = 16

_PACKED = pa.schema([("dim", pa.int32()), ("number", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])
_PACKED_SQL = "dim int, number bigint, ids binary, data binary"
FOUND_SQL = "query_id bigint, vec_id bigint, score {score}"


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` as doubles; rows without id, or whose vector is null, empty or holds a
    null, infinite or undefined component, take no part."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(key).cast("long").alias("vec_id"), values.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad
    )


def _pack(batches: Iterator, rows: int) -> Iterator:
    held: dict[int, list] = {}
    number = 0

    def put(dim: int):
        nonlocal number
        ids, data = (np.concatenate(x) for x in zip(*held[dim]))
        number += 1
        for at in range(0, len(ids), rows):
            yield pa.RecordBatch.from_pydict(
                {"dim": [dim], "number": [number], "ids": [ids[at : at + rows].tobytes()],
                 "data": [data[at : at + rows].tobytes()]}, schema=_PACKED,
            )
        held[dim] = []

    for batch in batches:
        ids = batch.column(0).to_numpy()
        vectors = batch.column(1)
        sizes = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        for dim in np.unique(sizes):
            mine = np.flatnonzero(sizes == dim)
            held.setdefault(int(dim), []).append((ids[mine], values[starts[mine][:, None] + np.arange(dim)]))
            if sum(len(x[0]) for x in held[int(dim)]) >= rows:
                yield from put(int(dim))
    for dim in list(held):
        if held[dim]:
            yield from put(dim)


def pack(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows ``(dim, number, ids, data)`` of at most ``rows`` vectors of one length each."""
    return arrow_map(vectors, _pack, _PACKED_SQL, rows=rows)


def search(
    vectors: DataFrame, is_query: Column, prepare: Callable, tile: Callable, k: int, score: str,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the best ``k`` per query, ties to the smaller id.

    ``prepare(vectors)`` makes of a shard what its tiles share, once for all blocks that meet it in
    a task. ``tile(query_ids, queries, ids, prepared)`` returns three arrays: query ids, ids and
    scores, at most a few more than ``k`` per query, and never a query with itself.
    """
    # a shard gets its number in the task that packs it
    shards = stage(pack(vectors, shard_rows).withColumn("shard", F.monotonically_increasing_id()), "shards")
    queries = vectors.where(is_query)
    blocks = max(1, -(-queries.count() // block_rows))
    packed = stage(pack(queries.repartition(blocks), block_rows), "queries")
    # a block of queries is copied once for every shard of its length; these are a row of two
    # numbers for up to ``shard_rows`` vectors, and no matrix meets another but its own tile's
    sent = packed.select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data")).join(
        F.broadcast(shards.select("dim", "shard")), "dim"
    )
    # a merge join leaves the tiles of a shard one after another
    tiles = sent.join(
        shards.select("shard", F.col("ids").alias("v_ids"), F.col("data").alias("v_data")).hint("merge"), "shard"
    ).select("shard", "dim", "q_ids", "q_data", "v_ids", "v_data")

    found = arrow_map(tiles, _run, FOUND_SQL.format(score=score), prepare=prepare, tile=tile, kind=score)
    order = [F.col("score").desc(), F.col("vec_id")]
    lane = Window.partitionBy("query_id", "_lane").orderBy(*order)
    # merging as a tree: at most LANES * k rows of a query meet in the last step
    first = (
        found.withColumn("_lane", F.pmod(F.xxhash64("vec_id"), F.lit(LANES)))
        .withColumn("_n", F.row_number().over(lane)).where(F.col("_n") <= k)
    )
    last = Window.partitionBy("query_id").orderBy(*order)
    return (
        first.withColumn("rank", F.row_number().over(last).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _run(batches: Iterator, prepare: Callable, tile: Callable, kind: str) -> Iterator:
    value = pa.int64() if kind == "bigint" else pa.float64()
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", value)])
    last, prepared = None, None
    for batch in batches:
        for row in batch.to_pylist():
            dim = row["dim"]
            q_ids, v_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["v_ids"], np.int64)
            q = np.frombuffer(row["q_data"], np.float64).reshape(-1, dim)
            v = np.frombuffer(row["v_data"], np.float64).reshape(-1, dim)
            if prepared is None or row["shard"] != last:
                last, prepared = row["shard"], prepare(v)
            a, b, scores = tile(q_ids, q, v_ids, prepared)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(scores, value)], schema=schema)


def best_of(scores: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the best ``k`` of each row, all ties with the k-th included, a query's
    own id left out. ``scores`` must be a float or integer matrix."""
    own = q_ids[:, None] == ids[None, :]
    allowed = ~own
    if scores.shape[1] > k + 1:
        low = np.iinfo(scores.dtype).min if scores.dtype.kind == "i" else -np.inf
        masked = np.where(own, low, scores)
        least = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed &= scores >= least[:, None]
    rows, columns = np.nonzero(allowed)
    return _trim(rows, columns, scores, ids, k)


def _trim(rows, columns, scores, ids, k):
    """Of each row's candidates the first ``k`` by score and id, so that many ties (one vector
    repeated in a shard) do not leave the tile."""
    order = np.lexsort((ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    first = np.searchsorted(rows, np.arange(scores.shape[0]))
    keep = np.arange(len(rows)) - first[rows] < k
    return rows[keep], columns[keep]
