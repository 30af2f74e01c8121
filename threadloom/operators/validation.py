"""Checking hand-entered scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T


def score_errors(human: DataFrame, judge: DataFrame) -> DataFrame:
    """``(message_id, field, value, error)``, one row per fault; no row if all is well.

    Faults are ``unknown_id``, ``empty``, ``not_integer`` and ``out_of_range``.
    """
    fields = [
        F.struct(F.lit(c).alias("field"), T.strip(F.coalesce(c, F.lit(""))).alias("value"))
        for c in (*presets.SCORE_DIMENSIONS, "total")
    ]
    long = human.select("message_id", F.explode(F.array(*fields)).alias("f")).select(
        "message_id", "f.*"
    )
    number = F.col("value").try_cast("decimal(38,0)")
    is_total = F.col("field") == "total"
    low, high = presets.DIMENSION_RANGE
    total_low, total_high = presets.TOTAL_RANGE
    in_range = F.when(is_total, number.between(total_low, total_high)).otherwise(
        number.between(low, high)
    )
    fault = (
        F.when(F.col("value") == "", F.lit("empty"))
        .when(~F.col("value").rlike(r"^[+-]?[0-9]+$"), F.lit("not_integer"))
        .when(~F.coalesce(in_range, F.lit(False)), F.lit("out_of_range"))
    )
    faults = long.withColumn("error", fault).where(F.col("error").isNotNull())
    strangers = human.join(judge.select("message_id"), "message_id", "left_anti").select(
        "message_id",
        F.lit("message_id").alias("field"),
        F.col("message_id").alias("value"),
        F.lit("unknown_id").alias("error"),
    )
    return faults.unionByName(strangers)
