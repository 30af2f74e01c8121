"""Classifying rows by keywords and counting the classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import keywords as K
from threadloom.functions import text as T
from threadloom.operators.binding import evaluate_once
from threadloom.operators.ranking import top_n_per_group
from threadloom.sources.tables import stage


# with more searches in one generated method, the JVM no longer compiles it
SEARCHES_PER_STEP = 64


def class_scores(
    df: DataFrame, text: Column, classes: K.Classes, boundary: bool = False
) -> tuple[DataFrame, dict[str, Column]]:
    """Add the keyword scores in steps of bounded size; return the table and the score columns."""
    sums: dict[str, Column] = {label: F.lit(0) for label in classes}
    for number, step in enumerate(K.in_steps(classes, SEARCHES_PER_STEP)):
        if not step:
            continue
        names = {f"_s{number}_{i}": part for i, part in enumerate(step)}
        df = evaluate_once(
            df, **{name: K.score(text, words, boundary) for name, (_, words) in names.items()}
        )
        for name, (label, _) in names.items():
            sums[label] = sums[label] + F.col(name)
    return df, sums


def classify(
    df: DataFrame,
    text: Column,
    classes: K.Classes,
    fallback: str = presets.UNCLASSIFIED,
    label: str = "intent",
    points: str = "best_score",
    boundary: bool = False,
    single_pass: bool = False,
    cleaned: Column | None = None,
) -> DataFrame:
    """Add the best class of the cleaned text and its score; a projection, no shuffle. ``cleaned`` is
    the text where several classifications share its cleaning."""
    scored = df.withColumn("_clean", T.clean(text, single_pass) if cleaned is None else cleaned)
    scored, scores = class_scores(scored, F.col("_clean"), classes, boundary)
    best = evaluate_once(scored, _best=K.pick_class(scores, fallback))
    return best.select(
        *df.columns, F.col("_best.label").alias(label), F.col("_best.score").alias(points)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, share)``. The total is a scalar over the already aggregated counts."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def majority_class(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent class, the alphabetically first one among equals."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(1)


def predict_majority(df: DataFrame, column: str, label: str = "pred_intent") -> DataFrame:
    """Add the majority class as the prediction for every row, and ``auto`` as the decision. The rows
    are staged, so that the classes are worked out once."""
    df = stage(df, "majority")
    winner = majority_class(df, column).select(column).scalar()
    return df.withColumn(label, winner).withColumn("pred_decision", F.lit(presets.AUTO))


def class_examples(
    df: DataFrame, label: str, points: str, row_id: str, n: int = 3
) -> DataFrame:
    """The ``n`` rows of every class with the highest class score, smallest id first."""
    classified = df.where(F.col(label) != presets.UNCLASSIFIED)
    order = [F.desc(points), F.col(row_id)]
    return top_n_per_group(classified, [label], order, n, "example")
