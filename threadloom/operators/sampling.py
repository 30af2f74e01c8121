"""Seeded samples that do not depend on how the data is partitioned.

A row's place in a sample is the MD5 digest of the seed and the row id, so the same rows are
drawn on one core and on a thousand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.operators.classes import value_counts
from threadloom.operators.ranking import first_by_hash, number_by_hash, top_n_per_group


def draw_key(seed: int, row_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))


def sample(df: DataFrame, row_id: str, n: int, seed: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows in random order."""
    keyed = df.withColumn("_draw", draw_key(seed, F.col(row_id)))
    return first_by_hash(keyed, "_draw", [row_id], n).drop("_draw")


def shuffle_order(df: DataFrame, row_id: str, seed: int, place: str = "place") -> DataFrame:
    """Number the rows from 1 in random order."""
    keyed = df.withColumn("_draw", draw_key(seed, F.col(row_id)))
    return number_by_hash(keyed, "_draw", [row_id], place).drop("_draw")


def sample_per_stratum(
    df: DataFrame, stratum: str, row_id: str, n: int, seed: int, rank: str = "draw_rank"
) -> DataFrame:
    """``min(n, size)`` random rows of every stratum, numbered in draw order."""
    keyed = df.withColumn("_draw", draw_key(seed, F.col(row_id)))
    order = [F.col("_draw"), F.col(row_id)]
    return top_n_per_group(keyed, [stratum], order, n, rank).drop("_draw")


def proportional_quotas(
    df: DataFrame,
    stratum: str,
    total: int = presets.PROPORTIONAL_TOTAL,
    skip: Sequence[str] = (presets.UNCLASSIFIED,),
) -> DataFrame:
    """``(stratum, n, share, quota)``: share of all rows times ``total``, half to even, at least 1.

    Skipped strata count in the shares but get no quota.
    """
    counts = value_counts(df, stratum)
    quota = F.greatest(F.lit(1), F.bround(F.col("share") * total, 0).cast("int"))
    return counts.where(~F.col(stratum).isin(list(skip))).withColumn("quota", quota)


def sample_proportional(
    df: DataFrame,
    stratum: str,
    row_id: str,
    seed: int,
    total: int = presets.PROPORTIONAL_TOTAL,
    skip: Sequence[str] = (presets.UNCLASSIFIED,),
) -> DataFrame:
    """Random rows of every stratum by its proportional quota.

    No quota exceeds ``total``, so the draw keeps that many rows per stratum before it meets the
    quota table.
    """
    quotas = proportional_quotas(df, stratum, total, skip).select(stratum, "quota")
    drawn = sample_per_stratum(df, stratum, row_id, max(total, 1), seed)
    return drawn.join(quotas, stratum).where(F.col("draw_rank") <= F.col("quota"))


def first_k_per_class(df: DataFrame, label: str, row_id: str, k: int = 5) -> DataFrame:
    """The first ``k`` rows of every class by id."""
    return top_n_per_group(df, [label], [F.col(row_id)], k, "class_rank")
