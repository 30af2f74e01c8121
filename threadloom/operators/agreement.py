"""Agreement of two raters: kappa, raw agreement, means, disagreements, scoring sheets.

Kappa needs the joint and the chance disagreement of all label pairs. Neither needs the pairs
themselves: with linear weights, the distance of two labels is the number of positions between
them, so both sums run over positions and need only the running counts of either rater. The plan
is one aggregate per label and a window over the few labels; it never crosses the label set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators.grounding import joined_replies
from threadloom.operators.incremental import pending
from threadloom.operators.sampling import shuffle_order

OVERALL = "overall"


def valid_judgements(judge: DataFrame) -> DataFrame:
    """Rows with a total; a missing total counts as -1."""
    return judge.where(F.coalesce("total", F.lit(-1)) >= 0)


def to_judge(results: DataFrame, judged: DataFrame | None = None, n: int = 50) -> DataFrame:
    """The first ``n`` results by id that have a draft, less those judged before."""
    first = first_rows_with_draft(results, n)
    return first if judged is None else pending(first, judged, "message_id")


def first_rows_with_draft(results: DataFrame, n: int) -> DataFrame:
    return results.where(F.length("draft_reply") > 0).orderBy("message_id").limit(n)


def judge_means(judge: DataFrame) -> DataFrame:
    return valid_judgements(judge).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("total").alias("mean_total"),
        *[F.avg(d).alias(f"mean_{d}") for d in presets.SCORE_DIMENSIONS],
    )


def long_scores(
    judge: DataFrame, human: DataFrame, dimensions: Sequence[str] = presets.SCORE_DIMENSIONS
) -> DataFrame:
    """``(message_id, dimension, judge_score, human_score)`` of the messages both rated.

    Human scores are text and become whole numbers.
    """
    left = judge.select("message_id", *[F.col(d).alias(f"j_{d}") for d in dimensions])
    right = human.select("message_id", *[F.col(d).alias(f"h_{d}") for d in dimensions])
    pairs = [
        F.struct(
            F.lit(d).alias("dimension"),
            F.col(f"j_{d}").cast("int").alias("judge_score"),
            T.strip(F.col(f"h_{d}").cast("string")).try_cast("int").alias("human_score"),
        )
        for d in dimensions
    ]
    both = left.join(right, "message_id")
    return both.select("message_id", F.explode(F.array(*pairs)).alias("p")).select(
        "message_id", "p.*"
    )


def _label_counts(scores: DataFrame, by: str, a: str, b: str, overall: bool) -> DataFrame:
    """Per ``(by, label)``: how often either rater chose it, agreements, and distance steps."""
    pairs = scores.groupBy(by, a, b).agg(F.count(F.lit(1)).alias("n"))
    if overall:
        groups = F.explode(F.array(F.col(by), F.lit(OVERALL))).alias(by)
        pairs = pairs.select(groups, a, b, "n")
    n, zero = F.col("n"), F.lit(0).cast("long")

    def at(label: Column, in_a: Column, in_b: Column, same: Column, step: Column) -> Column:
        return F.struct(
            label.alias("label"), in_a.alias("in_a"), in_b.alias("in_b"), same.alias("same"),
            step.alias("step"),
        )

    same = F.when(F.col(a) == F.col(b), n).otherwise(zero)
    marks = F.array(
        at(F.col(a), n, zero, same, zero),
        at(F.col(b), zero, n, zero, zero),
        at(F.least(a, b), zero, zero, zero, n),
        at(F.greatest(a, b), zero, zero, zero, -n),
    )
    return (
        pairs.select(by, F.explode(marks).alias("m"))
        .groupBy(by, "m.label")
        .agg(*[F.sum(f"m.{c}").alias(c) for c in ("in_a", "in_b", "same", "step")])
    )


def kappa(
    scores: DataFrame,
    by: str = "dimension",
    a: str = "judge_score",
    b: str = "human_score",
    weighted: bool = True,
    overall: bool = False,
) -> DataFrame:
    """``(by, n, kappa, raw_agreement, band)`` per value of ``by``, and pooled if ``overall``.

    Linear weights count positions in the sorted list of labels that either rater used. Where
    chance disagreement is zero, kappa is undefined and NULL. Pairs with a missing score do not
    count.
    """
    usable = scores.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    labels = _label_counts(usable, by, a, b, overall)
    upto = Window.partitionBy(by).orderBy("label")
    positions = labels.select(
        "*",
        F.sum("in_a").over(upto).cast("double").alias("below_a"),
        F.sum("in_b").over(upto).cast("double").alias("below_b"),
        F.sum("step").over(upto).cast("double").alias("apart"),
        F.sum("in_a").over(Window.partitionBy(by)).cast("double").alias("total"),
    )
    low_a, low_b, total = F.col("below_a"), F.col("below_b"), F.col("total")
    if weighted:
        observed = F.sum("apart") * F.max(total)
        expected = F.sum(low_a * (total - low_b) + low_b * (total - low_a))
    else:
        observed = F.max(total) * (F.max(total) - F.sum("same"))
        expected = F.max(total) * F.max(total) - F.sum(
            F.col("in_a").cast("double") * F.col("in_b")
        )
    out = positions.groupBy(by).agg(
        F.sum("in_a").alias("n"),
        (1 - F.try_divide(observed, expected)).alias("kappa"),
        (F.sum("same") / F.sum("in_a")).alias("raw_agreement"),
    )
    return out.withColumn("band", kappa_band(F.col("kappa")))


def kappa_band(value: Column) -> Column:
    """Name of the band; an undefined kappa has none."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in presets.KAPPA_BANDS:
        chain = chain.when(value > bound, F.lit(name))
    return chain.otherwise(F.lit(presets.KAPPA_LOWEST_BAND))


def rater_means(scores: DataFrame, by: str = "dimension") -> DataFrame:
    return scores.groupBy(by).agg(
        F.avg("judge_score").alias("judge_mean"), F.avg("human_score").alias("human_mean")
    )


def total_bin(total: Column) -> Column:
    chain = None
    for bound, name in presets.TOTAL_BINS:
        test = total <= bound
        chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
    return chain.when(total.isNotNull(), F.lit(presets.TOTAL_TOP_BIN))


def binned_kappa(judge: DataFrame, human: DataFrame) -> DataFrame:
    """Unweighted kappa of the binned totals."""
    totals = long_scores(judge, human, ["total"])
    binned = totals.withColumn("judge_score", total_bin(F.col("judge_score"))).withColumn(
        "human_score", total_bin(F.col("human_score"))
    )
    return kappa(binned, weighted=False)


def disagreements(scores: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Scores more than one point apart, with the first 80 characters of message and draft."""
    diff = F.col("judge_score") - F.col("human_score")
    far = scores.where(F.abs(diff) > 1).withColumn("diff", diff)
    if results is None:
        return far
    shown = results.select(
        "message_id",
        T.truncate(F.col("input_text"), 80).alias("customer_msg"),
        T.truncate(F.col("draft_reply"), 80).alias("draft_reply"),
    )
    return far.join(shown, "message_id", "left").fillna(
        "", subset=["customer_msg", "draft_reply"]
    )


def sheet_messages(judge: DataFrame, n: int = 20) -> DataFrame:
    """``message_id`` of the first ``n`` valid judgements: the rows of :func:`blind_sheet`."""
    return valid_judgements(judge).select("message_id").orderBy("message_id").limit(n)


def blind_sheet(judge: DataFrame, results: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """The first ``n`` valid judgements in random order, with blank score columns.

    The n ids go to the results by broadcast; the large table is only filtered.
    """
    first = sheet_messages(judge, n)
    details = results.join(F.broadcast(first), "message_id", "left_semi").select(
        "message_id",
        F.col("input_text").alias("customer_message"),
        F.col("pred_intent").alias("classified_intent"),
        joined_replies(F.col("retrieved_hits"), "\n---\n").alias("retrieved_references"),
        "draft_reply",
        F.col("pred_decision").alias("escalation_decision"),
        F.col("pred_reason").alias("escalation_reason"),
    )
    placed = shuffle_order(first, "message_id", seed)
    sheet = placed.join(details, "message_id", "left").fillna("")
    blanks = [F.lit("").alias(c) for c in (*presets.SCORE_DIMENSIONS, "total", "notes")]
    return sheet.select("place", *[c for c in details.columns], *blanks)
