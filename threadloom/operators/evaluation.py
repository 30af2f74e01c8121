"""Classification and escalation metrics.

Everything derives from the counts of (gold, predicted) pairs, so the rows are read once and only
a few counts per task are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import presets

NOT_SCORED = (presets.UNCLASSIFIED, presets.OUT_OF_SCOPE)


def scored_rows(rows: DataFrame, gold: str = "gold_intent") -> DataFrame:
    """Rows whose gold class is a real class."""
    return rows.where(~F.col(gold).isin(list(NOT_SCORED)))


def labelled_or_all(rows: DataFrame, labelled: Column, minimum: int) -> DataFrame:
    """The labelled rows, or all rows if fewer than ``minimum`` are labelled, as the caller chooses:
    0 for the labelled rows whatever their number."""
    known = F.coalesce(labelled, F.lit(False))
    count = rows.agg(F.count_if(known)).scalar()
    return rows.where(known | (count < minimum))


def was_reviewed(labelled_by: Column) -> Column:
    return ~F.coalesce(labelled_by, F.lit("")).isin([presets.NEEDS_REVIEW, ""])


def cells(rows: DataFrame, gold: str = "gold_intent", pred: str = "pred_intent") -> DataFrame:
    """``(gold, pred, n)`` of the pairs that occur."""
    return rows.groupBy(F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion(pairs: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """``(gold, pred, n)`` of the pairs that occur, and zeros for the other pairs of ``labels``.

    Labels outside the list keep the pairs that they occur in.
    """
    if not labels:
        return pairs.select("gold", "pred", "n")
    spark = pairs.sparkSession
    zeros = spark.createDataFrame([(a, b, 0) for a in labels for b in labels], "gold string, pred string, n long")
    return pairs.select("gold", "pred", "n").unionByName(zeros).groupBy("gold", "pred").agg(F.sum("n").alias("n"))


def confusion_matrix(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per gold label, listed or seen, one column per listed label, and ``other`` for
    predictions outside the list, so that a row adds up to all rows of its label."""
    listed = [F.sum(F.when(F.col("pred") == name, F.col("n")).otherwise(0)).alias(name) for name in labels]
    inside = F.coalesce(F.col("pred").isin(list(labels)), F.lit(False))
    other = F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("other")
    return confusion(pairs, labels).groupBy("gold").agg(*listed, other)


def class_counts(pairs: DataFrame) -> DataFrame:
    """``(label, support, predicted, correct)`` over the labels of either side."""
    hit = F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")

    def side(label: str, support: Column, predicted: Column, correct: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"), support.cast("long").alias("support"),
            predicted.cast("long").alias("predicted"), correct.cast("long").alias("correct"),
        )

    both = F.array(side("gold", F.col("n"), zero, hit), side("pred", zero, F.col("n"), zero))
    return (
        pairs.select(F.explode(both).alias("s"))
        .groupBy("s.label")
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.predicted").alias("predicted"),
            F.sum("s.correct").alias("correct"),
        )
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_report(pairs: DataFrame) -> DataFrame:
    """``(label, precision, recall, f1, support)``; undefined ratios are 0."""
    correct, support, predicted = F.col("correct"), F.col("support"), F.col("predicted")
    return class_counts(pairs).select(
        "label",
        _ratio(correct, predicted).alias("precision"),
        _ratio(correct, support).alias("recall"),
        _ratio(2 * correct, support + predicted).alias("f1"),
        "support",
        "correct",
    )


def summary(pairs: DataFrame) -> DataFrame:
    """One row: accuracy, macro and weighted F1, number of rows."""
    support = F.sum("support")
    return class_report(pairs).agg(
        _ratio(F.sum("correct"), support).alias("accuracy"),
        F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"),
        _ratio(F.sum(F.col("f1") * F.col("support")), support).alias("weighted_f1"),
        F.coalesce(support, F.lit(0)).alias("n"),
    )


def worst_classes(report: DataFrame, n: int = 3) -> DataFrame:
    return report.orderBy("f1", "label").limit(n)


def escalation_report(
    rows: DataFrame, gold: str = "gold_decision", pred: str = "pred_decision"
) -> DataFrame:
    """One row of counts, precision, recall and F1 with ``escalate`` as the positive class.

    Missed escalations are false_auto, needless ones false_escalate; other values count nowhere.
    """

    def both(g: str, p: str) -> Column:
        return F.count_if((F.col(gold) == g) & (F.col(pred) == p))

    auto, escalate = presets.AUTO, presets.ESCALATE
    counts = rows.agg(
        both(escalate, escalate).alias("tp"),
        both(auto, escalate).alias("fp"),
        both(escalate, auto).alias("fn"),
        both(auto, auto).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp", "fp", "fn", "tn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        fn.alias("false_auto"),
        fp.alias("false_escalate"),
    )


def failures(
    rows: DataFrame, gold: str, pred: str, row_id: str = "message_id", n: int | None = None
) -> DataFrame:
    """Rows decided ``pred`` although ``gold`` was right, the first ``n`` by id if given."""
    wrong = rows.where((F.col("gold_decision") == gold) & (F.col("pred_decision") == pred))
    return wrong if n is None else wrong.orderBy(row_id).limit(n)


def baseline_metrics(rows: DataFrame, name: str) -> DataFrame:
    """One row of class and escalation metrics of a classifier over the scored rows."""
    usable = scored_rows(rows)
    classes = summary(cells(usable)).select(
        F.struct(
            F.col("accuracy").alias("intent_accuracy"),
            F.col("macro_f1").alias("intent_macro_f1"),
            F.col("weighted_f1").alias("intent_weighted_f1"),
            F.col("n"),
        ).alias("c")
    )
    decisions = escalation_report(usable).select(
        F.lit(name).alias("name"),
        F.col("precision").alias("esc_precision"),
        F.col("recall").alias("esc_recall"),
        "false_auto",
        "false_escalate",
        classes.scalar().alias("c"),
    )
    return decisions.select(
        "name", "c.intent_accuracy", "c.intent_macro_f1", "c.intent_weighted_f1",
        "esc_precision", "esc_recall", "false_auto", "false_escalate", "c.n",
    )
