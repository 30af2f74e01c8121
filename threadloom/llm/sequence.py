"""Rows in order: places within groups, running sums over long groups, digests of ordered pieces.

A group may hold any share of all rows. Rows are sorted into ranges, so that a large group lies in
many neighbouring tasks, and what a task needs from the ones before it is one small row each.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.sources.tables import stage

PIECE_BYTES = 4 << 20
SPAN = 4096


def numbered(
    df: DataFrame, group: str, ranges: Sequence[str | Column], order: Sequence[str | Column],
    keep: Sequence[Column], name: str,
) -> DataFrame:
    """The ``keep`` columns (which include the group) and ``pos``, the row's place in its group,
    from 0.

    Rows are dealt to tasks by ranges of the group and ``ranges`` and sorted there by the group and
    ``order``, which has to refine ``ranges``. Only rows alike in all of ``ranges`` are bound to
    one task, which sorts them on disk if need be. The result reads a staged table.
    """
    placed = df.repartitionByRange(F.col(group), *ranges).sortWithinPartitions(F.col(group), *order)
    rows = stage(
        placed.select(*keep, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")),
        name,
    )
    # a group's rows lie side by side in a task, so its first number and count say all
    parts = rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    joined = rows.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    return joined.select(*[c for c in rows.columns if c not in ("_part", "_at")], pos.alias("pos"))


def running(
    df: DataFrame, group: str, place: str, totals: dict[str, tuple[str, str]], span: int = SPAN
) -> DataFrame:
    """Adds, for each new name, the aggregate (function name, column) of the group's rows with a
    smaller ``place``; 0 for the first. Places are whole numbers, once per group.

    A group is cut into spans of places. Sums run inside a span and over the spans, so a task sees
    at most ``span`` rows of a group, or one row for each of its spans.
    """
    df = df.withColumn("_span", F.floor(F.col(place) / F.lit(span)))
    inside = Window.partitionBy(group, "_span").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    outside = Window.partitionBy(group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    combine = {"sum": lambda x, y: x + y, "bit_xor": lambda x, y: x.bitwiseXOR(y)}
    spans = df.groupBy(group, "_span").agg(*[getattr(F, how)(c).alias(n) for n, (how, c) in totals.items()])
    before = spans.select(
        F.col(group).alias("_g"), F.col("_span").alias("_s"),
        *[getattr(F, how)(n).over(outside).alias("_b_" + n) for n, (how, _) in totals.items()],
    ).where("_s > 0")  # the first span has none before it
    out = df.select("*", *[getattr(F, how)(c).over(inside).alias("_i_" + n) for n, (how, c) in totals.items()])
    out = out.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_span") == F.col("_s")), "left")
    return out.select(
        *[c for c in df.columns if c != "_span"],
        *[
            combine[how](F.coalesce("_i_" + n, F.lit(0)), F.coalesce("_b_" + n, F.lit(0))).alias(n)
            for n, (how, _) in totals.items()
        ],
    )


def _rows(batches: Iterator) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])


def _cut(values: Iterator[bytes], separator: bytes) -> Iterator[bytes]:
    """The values joined, in pieces of about ``PIECE_BYTES``."""
    buffer, size = [], 0
    for value in values:
        buffer.append(value)
        size += len(value)
        if size > PIECE_BYTES:
            yield separator.join(buffer)
            buffer, size = [], 0
    if buffer:
        yield separator.join(buffer)


def _pieces(batches: Iterator, keys: int, separator: bytes) -> Iterator:
    """Digests of the keys that begin and end in this task. Of its first and last key, and of long
    ones, the joined pieces: neighbours may hold more of them."""
    part = TaskContext.get().partitionId()
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*held))
        kinds = [pa.int64()] * keys + [pa.int32(), pa.int64(), pa.binary(), pa.string()]
        names = [f"k{i}" for i in range(keys)] + ["part", "seq", "piece", "sha256"]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    alone = None  # the key before, whole in one piece, unless the task ends with it
    for place, (key, group) in enumerate(itertools.groupby(_rows(batches), lambda r: r[:keys])):
        if alone is not None:
            held.append((*alone[0], part, None, None, hashlib.sha256(alone[1]).hexdigest()))
            alone = None
        pieces = _cut((bytes(r[keys]) for r in group), separator)
        begin = list(itertools.islice(pieces, 2))
        if place and len(begin) == 1:
            alone = (key, begin[0])
        else:
            for seq, piece in enumerate(itertools.chain(begin, pieces)):
                held.append((*key, part, seq, piece, None))
                yield flush()
        if len(held) >= 4096:
            yield flush()
    if alone is not None:
        held.append((*alone[0], part, 0, alone[1], None))
    if held:
        yield flush()


def _digests(batches: Iterator, keys: int, separator: bytes) -> Iterator:
    names = [f"k{i}" for i in range(keys)] + ["sha256"]
    for key, group in itertools.groupby(_rows(batches), lambda r: r[:keys]):
        hasher, begun = hashlib.sha256(), False
        for row in group:
            hasher.update((separator if begun else b"") + row[keys])
            begun = True
        yield pa.RecordBatch.from_arrays([pa.array([k]) for k in (*key, hasher.hexdigest())], names=names)


def ordered_sha256(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], piece: str, separator: str, name: str
) -> DataFrame:
    """``(keys..., sha256)``: SHA-256 of each key's pieces (a binary column) in order, joined by the
    separator. Keys are whole numbers and not null.

    A task hashes the keys that lie in its range of the sorted rows. Only a key on the edge of a
    range, or one of more than ``PIECE_BYTES``, goes on to a second step, as a few joined pieces:
    a digest is a chain, so one task has to read a key's bytes, but it never holds them.
    """
    kinds = ", ".join(f"k{i} bigint" for i in range(len(keys)))
    named = [F.col(k).cast("long").alias(f"k{i}") for i, k in enumerate(keys)]
    by_key = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*named, F.col(piece).alias("_piece"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    by_order = [f"_o{i}" for i in range(len(order))]
    placed = rows.repartitionByRange(*by_key, *by_order).sortWithinPartitions(*by_key, *by_order)
    given = {"keys": len(keys), "separator": separator.encode()}
    first = stage(
        placed.select(*by_key, "_piece").mapInArrow(
            functools.partial(_pieces, **given), f"{kinds}, part int, seq long, piece binary, sha256 string"
        ),
        name,
    )
    rest = (
        first.where("sha256 is null").repartition(*by_key).sortWithinPartitions(*by_key, "part", "seq")
        .select(*by_key, "piece").mapInArrow(functools.partial(_digests, **given), f"{kinds}, sha256 string")
    )
    whole = first.where("sha256 is not null").select(*by_key, "sha256").union(rest)
    return whole.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "sha256")
