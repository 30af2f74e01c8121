"""Operator 1: documents packed into sequences of bounded length by bulk-synchronous best fit.

Only lengths move. A task tokenizes its documents and forwards one row per piece (place in the
document, length, checksum of the ids). Pieces and the gaps of open sequences are then kept in
order of size. In each round

1. pieces and gaps are counted by size (both have at most ``capacity`` sizes, whatever the input);
2. a sweep from the largest size down pairs every run of equal pieces with its successor, the
   smallest gap size that still fits and is not yet used up;
3. the rows of a run and of a gap size are matched by rank, so no two pieces claim one place;
4. gaps shrink, and pieces that fit nowhere open new sequences, the largest first.

Rounds repeat until no piece is left. Ranks within a size are counted in hashed lanes, so a size
that holds a third of all rows is never sorted in one task.

Defined cases: a null text is an empty one (one token, the end id). Rows are packed one by one, so
repeated rows, null or repeated ids each get their own place. An empty table gives an empty table.
Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.shared import arrow_map, table_of
from threadloom.llm.tokens import WordTokens
from threadloom.sources.tables import stage

CAPACITY = 4096
END_ID = 1
LANES = 64

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64())]
)
_PIECES_SQL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(batches: Iterator, tokenizer: str, capacity: int, end: int) -> Iterator:
    tokens = WordTokens(tokenizer)
    last = np.array([end], "<u4").tobytes()
    for batch in batches:
        out: dict[str, list] = {name: [] for name in PIECES.names}
        for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1))):
            ids += last
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))
                for values, value in zip(out.values(), row):
                    values.append(value)
        yield table_of(out, PIECES)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_ID,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids, cut every ``capacity``."""
    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(named, _cut, _PIECES_SQL, tokenizer=tokenizer, capacity=capacity, end=end)


def sweep(piece_runs: dict[int, tuple[int, int]], gap_runs: dict[int, int]) -> list[tuple]:
    """Successor of every run: ``(length, first, after, gap, gap_first, per_gap)``.

    ``piece_runs`` maps a length to the ranks ``[first, after)`` of its unplaced pieces. Pieces
    ``first..after`` of a result go to gaps of that size from rank ``gap_first`` on, ``per_gap``
    to each.
    """
    stack: list[list[int]] = []
    waiting = sorted(gap_runs, reverse=True)
    found = []
    at = 0
    for length in sorted(piece_runs, reverse=True):
        first, after = piece_runs[length]
        while at < len(waiting) and waiting[at] >= length:
            stack.append([waiting[at], 0])
            at += 1
        while first < after and stack:
            gap, used = stack[-1]
            per = gap // length
            left = gap_runs[gap] - used
            gaps = min(left, (after - first) // per)
            if gaps:
                found.append((length, first, first + gaps * per, gap, used, per))
                first += gaps * per
            elif after - first < per:
                gaps = 1
                found.append((length, first, after, gap, used, per))
                first = after
            stack[-1][1] += gaps
            if stack[-1][1] == gap_runs[gap]:
                stack.pop()
    return found


def openings(left: dict[int, tuple[int, int]], room: int, capacity: int) -> list[tuple[int, int, int]]:
    """Pieces ``(length, first, after)`` that each open a sequence: those over half a sequence,
    and the largest others as far as the open gaps cannot hold what is left."""
    total = sum(size * (b - a) for size, (a, b) in left.items())
    must = sum(b - a for size, (a, b) in left.items() if 2 * size > capacity)
    count = max(must, -(-max(0, total - room) // capacity), 1)
    out = []
    for size in sorted(left, reverse=True):
        first, after = left[size]
        after = min(after, first + count)
        if after > first:
            out.append((size, first, after))
            count -= after - first
    return out


def ranked(df: DataFrame, size: str, order: list[str], lanes: int = LANES) -> DataFrame:
    """Rank from 0 within equal ``size``, in column ``rank``: by lane (a hash of the order
    columns), then by order. The rows are written, as the counts per lane read them too."""
    lane = F.pmod(F.xxhash64(*order), F.lit(lanes))
    rows = stage(
        df.withColumn("_lane", lane).withColumn(
            "_place", F.row_number().over(Window.partitionBy(size, "_lane").orderBy(*order)) - 1
        ),
        "lanes",
    )
    before = Window.partitionBy(size).orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes_before = rows.groupBy(size, "_lane").agg(F.count(F.lit(1)).alias("_n")).select(
        size, "_lane", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return rows.join(lanes_before, [size, "_lane"]).select(
        *df.columns, (F.col("_before") + F.col("_place")).alias("rank")
    )


def pack(parts: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """The rows of ``parts`` with ``sequence_id`` and ``offset``; ``length`` must be 1 to capacity."""
    spark = parts.sparkSession
    columns = parts.columns
    parts = stage(ranked(parts, "length", list(order)), "pieces")
    runs = {r["length"]: (0, r["n"]) for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    gaps = local_table(spark, [], ("sequence_id", "gap", "rank"))
    gap_runs: dict[int, int] = {}
    opened = 0
    placed: DataFrame | None = None
    while runs:
        segments = sweep(runs, gap_runs)
        for length, _, after, *_ in segments:
            runs[length] = (after, runs[length][1])
        runs = {size: run for size, run in runs.items() if run[0] < run[1]}
        room = sum(g * n for g, n in gap_runs.items()) - sum(s[0] * (s[2] - s[1]) for s in segments)
        new = []
        if runs:
            for size, first, after in openings(runs, room, capacity):
                new.append((size, first, after, opened))
                opened += after - first
                runs[size] = (after, runs[size][1])
            runs = {size: run for size, run in runs.items() if run[0] < run[1]}
        taken = _seated(parts, gaps, segments, new, capacity)
        taken = stage(taken, "placed")
        placed = taken if placed is None else placed.unionByName(taken)
        if runs:
            least = min(runs)
            used = taken.groupBy("sequence_id").agg(F.sum("length").alias("_used"))
            fresh = taken.where("offset = 0").select("sequence_id", F.lit(capacity).cast("long").alias("gap"))
            gaps = (
                gaps.select("sequence_id", "gap").unionByName(fresh)
                .join(used, "sequence_id", "left")
                .select("sequence_id", (F.col("gap") - F.coalesce("_used", F.lit(0))).alias("gap"))
                .where(F.col("gap") >= least)
            )
            gaps = ranked(gaps, "gap", ["sequence_id"])
            gap_runs = {r["gap"]: r["n"] for r in gaps.groupBy("gap").agg(F.count(F.lit(1)).alias("n")).collect()}
    if placed is None:
        return parts.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.select(*columns, "sequence_id", "offset")


def local_table(spark, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A small table of long columns, sent without a job."""
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return spark.createDataFrame(
        pa.table({name: pa.array(values, pa.int64()) for name, values in zip(names, columns)})
    )


def _seated(parts, gaps, segments, new, capacity) -> DataFrame:
    """The pieces of this round with their sequence and offset. The runs are at most a few per
    size, so they are broadcast; pieces and gaps meet on (gap size, rank), one gap per key."""
    spark = parts.sparkSession
    plan = [(*s, None) for s in segments] + [(a, b, c, None, None, None, d) for a, b, c, d in new]
    runs = local_table(spark, plan, ("length", "first", "after", "gap", "gap_first", "per", "opened"))
    mine = parts.join(F.broadcast(runs), "length").where("rank >= first AND rank < after")
    place = F.col("rank") - F.col("first")
    fresh = mine.where("gap IS NULL").withColumns(
        {"sequence_id": F.col("opened") + place, "offset": F.lit(0).cast("long")}
    )
    kept = [c for c in parts.columns if c != "rank"] + ["sequence_id", "offset"]
    if not segments:
        return fresh.select(*kept)
    matched = (
        mine.where("gap IS NOT NULL")
        .withColumn("_slot", F.expr("(rank - first) % per"))
        .withColumn("_gap_rank", F.col("gap_first") + F.expr("(rank - first) div per"))
        .withColumnRenamed("gap", "_gap")
        .join(
            gaps.select(F.col("gap").alias("_gap"), F.col("rank").alias("_gap_rank"), "sequence_id"),
            ["_gap", "_gap_rank"],
        )
        .withColumn("offset", capacity - F.col("_gap") + F.col("_slot") * F.col("length"))
    )
    return matched.select(*kept).unionByName(fresh.select(*kept))


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack(pieces(docs, tokenizer, capacity, end), capacity)
