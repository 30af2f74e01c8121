"""Evaluating an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters cannot copy.

    A filter on an ordinary computed column is pushed below it by substituting the expression, so
    a classification made of dozens of searches would run once for the filter and once for the
    output. Columns produced by a one-row ``inline`` stay where they are.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
