"""Reports as long tables of (section, metric, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import agreement as A
from threadloom.operators import evaluation as E
from threadloom.operators import grounding as G


def as_metrics(row: DataFrame, section: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the columns of a one-row table into ``(section, metric, value)`` rows."""
    names = list(columns or row.columns)
    pairs = [
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names
    ]
    return row.select(F.lit(section).alias("section"), F.explode(F.array(*pairs)).alias("m")).select(
        "section", "m.*"
    )


def evaluation_report(results: DataFrame) -> DataFrame:
    """Class, escalation and groundedness metrics of agent results."""
    pairs = E.cells(E.scored_rows(results))
    per_class = E.class_report(pairs).select(
        F.lit("class_f1").alias("section"), F.col("label").alias("metric"),
        F.col("f1").alias("value"),
    )
    grounded = G.groundedness(
        results, F.col("draft_reply"), G.joined_replies(F.col("retrieved_hits"))
    )
    parts = [
        as_metrics(E.summary(pairs), "intent"),
        per_class,
        as_metrics(E.escalation_report(results), "escalation"),
        as_metrics(G.mean_groundedness(grounded), "groundedness"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def agreement_report(judge: DataFrame, human: DataFrame) -> DataFrame:
    """Per dimension, pooled and for the binned total: kappa, band, raw agreement and means, all
    over the valid judgements."""
    judge = A.valid_judgements(judge)
    scores = A.long_scores(judge, human)
    by_dimension = A.kappa(scores, overall=True).join(A.rater_means(scores), "dimension", "left")
    binned = A.binned_kappa(judge, human)
    return by_dimension.unionByName(binned, allowMissingColumns=True)


def baseline_report(predictions: dict[str, DataFrame]) -> DataFrame:
    """One row of metrics per named classifier."""
    rows = [E.baseline_metrics(frame, name) for name, frame in predictions.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
