"""Top-n, per group and overall, without gathering a large group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.sources.tables import stage

LANES = 256
# up to this many rows per task may meet in the task of a plain sorted limit
SMALL_LIMIT = 50
HASH_PREFIX = 4


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    lanes: int = LANES,
) -> DataFrame:
    """The first ``n`` rows of every group by ``order``, numbered from 1 in column ``rank``.

    Runs as a tree: every task keeps at most n rows of a group, ``lanes`` reducers then merge the
    tasks' leftovers of one group, and the last step sees at most ``lanes * n`` rows of it. A
    group that holds most of the table is therefore never sorted in one place. ``order`` must be
    total for a repeatable answer.
    """
    if n > 1 and lanes > 1:
        lane = F.pmod(F.spark_partition_id(), F.lit(lanes))
        spread = Window.partitionBy(*group, "_lane").orderBy(*order)
        df = (
            df.withColumn("_lane", lane)
            .withColumn("_place", F.row_number().over(spread))
            .where(F.col("_place") <= n)
            .drop("_lane", "_place")
        )
    merged = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(merged)).where(F.col(rank) <= n)


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every group by ``order``; each task forwards one row per group."""
    return top_n_per_group(df, group, order, 1, rank="_rank").drop("_rank")


def _first_buckets(df: DataFrame, bucket: str, n: int) -> DataFrame:
    """Rows of the lowest buckets that together hold at least ``n`` rows.

    ``bucket`` must have few distinct values (65,536 here): their counts are one small table.
    """
    counts = df.groupBy(bucket).count()
    running = F.sum("count").over(Window.orderBy(bucket))
    enough = counts.withColumn("_upto", running).where(F.col("_upto") >= n)
    last = enough.agg(F.min(bucket)).scalar()
    return df.where(last.isNull() | (F.col(bucket) <= last))


def first_by_hash(df: DataFrame, hash_column: str, ties: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest hex digest, in order.

    For a large ``n`` a first pass over the digests finds the prefix that covers n rows, so only
    about n rows, not n per task, reach the final sort.
    """
    if n > SMALL_LIMIT:
        df = df.withColumn("_bucket", F.substring(hash_column, 1, HASH_PREFIX))
        df = _first_buckets(df, "_bucket", n).drop("_bucket")
    return df.orderBy(hash_column, *ties).limit(n)


def first_rows(df: DataFrame, order: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the smallest value of column ``order``, in order; nulls come first.

    Spark tables have no file order, so a prefix scan names its order; with ``ties`` it should be
    total. Any type that sorts will do. The order columns alone are sorted into ranges and counted
    per range; the n-th of them is the cut, so no task gathers the n rows. Rows equal to the cut
    beyond the n-th go in a last step that sees only them.
    """
    keys = [order, *ties]
    ranges = stage(
        df.select(*keys).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "keys"
    )
    counts = ranges.groupBy("_range").count().orderBy("_range").collect()  # one row per task
    before = 0
    for row in counts:
        if before + row["count"] >= n:
            break
        before += row["count"]
    else:
        return df.orderBy(*keys)
    if n <= 0:
        return df.limit(0)
    inside = ranges.where(F.col("_range") == row["_range"])
    numbered = inside.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*keys)))
    cut = numbered.where(F.col("_n") == n - before).select(*keys).first()
    types = df.select(*keys).schema
    edge = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, types)])
    key = F.struct(*[F.col(k) for k in keys])
    lower = df.where(key < edge)
    same = df.where(key == edge).limit(n - lower.count())
    return lower.unionByName(same).orderBy(*keys)


def number_by_hash(
    df: DataFrame, hash_column: str, ties: Sequence[str], place: str
) -> DataFrame:
    """Number all rows from 1 by their hex digest without sorting them in one place.

    Rows are numbered inside the 65,536 digest prefixes; a prefix starts where the counts of the
    lower prefixes end.
    """
    bucketed = df.withColumn("_bucket", F.substring(hash_column, 1, HASH_PREFIX))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy("_bucket").count()
    starts = counts.select(
        "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(hash_column, *ties))
    # one row per prefix, so at most 65,536
    return (
        bucketed.withColumn("_inside", inside)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(place, F.col("_start") + F.col("_inside"))
        .drop("_bucket", "_inside", "_start")
    )
