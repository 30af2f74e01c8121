"""Vector columns (``ARRAY<FLOAT>`` or ``ARRAY<DOUBLE>``); sums are taken in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def unit(v: Column) -> Column:
    """The vector divided by its length; a zero vector stays as it is."""
    length = F.sqrt(dot(v, v))
    return F.transform(
        v, lambda x: F.coalesce(F.try_divide(x.cast("double"), length), F.lit(0.0)).cast("float")
    )
