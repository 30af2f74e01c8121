"""How much of a draft is covered by the replies it was based on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators.binding import evaluate_once


def joined_replies(hits: Column, separator: str = " ") -> Column:
    """The reply texts of all hits as one string."""
    return F.array_join(F.transform(hits, lambda h: h["reply_text"]), separator)


def groundedness(
    rows: DataFrame,
    draft: Column,
    references: Column,
    stop_words: Sequence[str] = presets.GROUNDING_STOP_WORDS,
) -> DataFrame:
    """Add ``groundedness``: share of the draft's distinct words found in ``references``.

    Rows without draft, references or scorable words are left out. Everything happens inside a
    row; there is no shuffle.
    """
    usable = rows.where((F.length(draft) > 0) & (F.length(references) > 0))
    # bound, as the filter would work the words out a second time
    worded = evaluate_once(usable, _draft=T.content_words(draft, stop_words))
    known = T.content_words(references, stop_words)
    share = F.size(F.array_intersect(F.col("_draft"), known)) / F.size("_draft")
    return worded.where(F.size("_draft") > 0).withColumn("groundedness", share).drop("_draft")


def mean_groundedness(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.coalesce(F.avg("groundedness"), F.lit(0.0)).alias("mean_groundedness"),
        F.count(F.lit(1)).alias("n_scored"),
    )
