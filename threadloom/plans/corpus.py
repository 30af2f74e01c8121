"""Building the searchable corpus of resolved threads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import keywords as K
from threadloom.operators.classes import classify, value_counts
from threadloom.operators.ranking import first_by_hash, number_by_hash
from threadloom.operators.sampling import draw_key
from threadloom.operators.threads import pair_longest
from threadloom.sources.tables import stage

SEED = 42


def matched_pairs(
    messages: DataFrame, account: str | None = None, min_chars: int = presets.MIN_SIDE_CHARS
) -> DataFrame:
    """The resolved threads, staged: a draw reads their ids and then only the drawn texts."""
    return stage(pair_longest(messages, account, min_chars), "pairs")


def corpus_of(
    pairs: DataFrame, classes: K.Classes, size: int | None = None, seed: int = SEED
) -> DataFrame:
    """``(idx, tweet_id, customer_text, reply_text, intent_seed, created_at)`` of all threads, or of
    ``size`` of them drawn by hash. ``idx`` numbers the drawn threads in draw order."""
    keyed = pairs.withColumn("_draw", draw_key(seed, F.col("tweet_id")))
    drawn = keyed if size is None else first_by_hash(keyed, "_draw", ["tweet_id"], size)
    numbered = number_by_hash(drawn, "_draw", ["tweet_id"], "_place").withColumn(
        "idx", F.col("_place") - 1
    )
    labelled = classify(numbered, F.col("text"), classes, label="intent_seed")
    return labelled.select(
        "idx",
        "tweet_id",
        F.col("text").alias("customer_text"),
        "reply_text",
        "intent_seed",
        "created_at",
    )


def build_corpus(
    messages: DataFrame,
    classes: K.Classes,
    account: str | None = None,
    size: int | None = None,
    seed: int = SEED,
    min_chars: int = presets.MIN_SIDE_CHARS,
) -> DataFrame:
    """The corpus (see :func:`corpus_of`) of a message table."""
    return corpus_of(matched_pairs(messages, account, min_chars), classes, size, seed)


def corpus_report(
    messages: DataFrame, corpus: DataFrame, account: str | None = None, *, pairs: DataFrame
) -> DataFrame:
    """The build report as ``(metric, value)`` rows: table sizes, and count and share of every
    class."""
    reply = ~F.col("inbound")
    if account is not None:
        reply = reply & (F.col("author_id") == account)
    rows = F.count(F.lit(1)).alias("value")
    sizes = [
        messages.agg(rows).select(F.lit("total_rows").alias("metric"), "value"),
        messages.agg(F.count_if(reply).alias("value")).select(F.lit("brand_replies").alias("metric"), "value"),
        pairs.agg(rows).select(F.lit("matched_pairs").alias("metric"), "value"),
        corpus.agg(rows).select(F.lit("indexed_corpus").alias("metric"), "value"),
    ]
    per_class = value_counts(corpus, "intent_seed")
    metric = F.explode(
        F.array(
            F.struct(F.concat(F.lit("class:"), "intent_seed").alias("metric"), F.col("n").cast("double").alias("value")),
            F.struct(F.concat(F.lit("share:"), "intent_seed").alias("metric"), F.round("share", 6).alias("value")),
        )
    )
    out = per_class.select(metric.alias("m")).select("m.*")
    for size in sizes:
        out = out.unionByName(size.withColumn("value", F.col("value").cast("double")))
    return out
