"""Profiling and ranking of support accounts, all accounts in one grouped plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators.ranking import first_rows, top_n_per_group
from threadloom.operators.threads import inbound, outbound
from threadloom.sources.tables import stage


def activity(messages: DataFrame) -> DataFrame:
    """Per author with outbound messages: counts by direction, inbound share, noise share.

    Noise is the share of outbound texts of at most 20 characters, 1.0 without any text.
    """
    sent = ~F.col("inbound")
    short = F.when(sent, (F.length("text") <= presets.NOISE_CHARS).cast("double"))
    counts = messages.groupBy("author_id").agg(
        F.count_if(sent).alias("outbound_count"),
        F.count_if(F.col("inbound")).alias("inbound_count"),
        F.coalesce(F.avg(short), F.lit(1.0)).alias("noise_frac"),
    )
    total = F.col("outbound_count") + F.col("inbound_count")
    return counts.where(F.col("outbound_count") > 0).withColumn(
        "pct_inbound", F.col("inbound_count") / total
    )


def eligible(
    accounts: DataFrame,
    max_inbound: float = presets.MAX_INBOUND_SHARE,
    min_outbound: int = presets.MIN_OUTBOUND,
) -> DataFrame:
    """Accounts that mostly reply and reply often."""
    return accounts.where(
        (F.col("pct_inbound") < max_inbound) & (F.col("outbound_count") >= min_outbound)
    )


def completeness(messages: DataFrame) -> DataFrame:
    """Per account: share of the distinct messages it replied to that are known inbound ones."""
    edges = (
        outbound(messages)
        .where(F.col("in_response_to_tweet_id").isNotNull())
        .select("author_id", F.col("in_response_to_tweet_id").alias("tweet_id"))
        .distinct()
    )
    known = inbound(messages).select("tweet_id", F.lit(1).alias("_known"))
    return (
        edges.join(known, "tweet_id", "left")
        .groupBy("author_id")
        .agg((F.count("_known") / F.count(F.lit(1))).alias("thread_completeness"))
    )


def answering_texts(messages: DataFrame) -> DataFrame:
    """``(author_id, tweet_id, text)``: customer texts that answer one of the account's messages."""
    own = outbound(messages).select(
        "author_id", F.col("tweet_id").alias("in_response_to_tweet_id")
    )
    answers = (
        inbound(messages)
        .where(F.col("text").isNotNull() & F.col("in_response_to_tweet_id").isNotNull())
        .select("in_response_to_tweet_id", "tweet_id", "text")
    )
    return answers.join(own, "in_response_to_tweet_id").select("author_id", "tweet_id", "text")


def vocabulary_richness(
    texts: DataFrame, account: str, row_id: str, first: int | None = None
) -> DataFrame:
    """Type-token ratio over all texts of every account, or the ``first`` of each.

    Words are counted per (account, word) first, so no task holds all words of an account.
    """
    kept = texts if first is None else top_n_per_group(texts, [account], [F.col(row_id)], first)
    words = kept.select(
        account, F.explode_outer(T.split_words(F.lower("text"))).alias("word")
    )
    return (
        words.groupBy(account, "word")
        .agg(F.count("word").alias("n"))
        .groupBy(account)
        .agg((F.count("word") / F.greatest(F.sum("n"), F.lit(1))).alias("topic_ttr"))
    )


def profile_accounts(
    messages: DataFrame,
    max_inbound: float = presets.MAX_INBOUND_SHARE,
    min_outbound: int = presets.MIN_OUTBOUND,
    prefix: int | None = None,
    prefix_order: str | None = None,
) -> DataFrame:
    """The eligible accounts with all measures, rounded to three decimals.

    ``prefix`` restricts the profile to the first rows by the numeric column ``prefix_order``,
    which are staged, as five measures read them.
    """
    if prefix is not None:
        messages = stage(first_rows(messages, prefix_order, prefix, ["tweet_id"]), "prefix")
    accounts = eligible(activity(messages), max_inbound, min_outbound)
    # the other measures have one row per account, too: no message row is joined on its author
    richness = vocabulary_richness(answering_texts(messages), "author_id", "tweet_id")
    return assemble(accounts, completeness(messages), richness)


def assemble(accounts: DataFrame, complete: DataFrame, richness: DataFrame) -> DataFrame:
    """Accounts with all measures, rounded to three decimals; one row per account on every side."""
    joined = accounts.join(complete, "author_id", "left").join(richness, "author_id", "left")
    measures = {
        "pct_inbound": F.col("pct_inbound"),
        "thread_completeness": F.coalesce("thread_completeness", F.lit(0.0)),
        "noise_frac": F.col("noise_frac"),
        "topic_ttr": F.coalesce("topic_ttr", F.lit(0.0)),
    }
    return joined.select(
        "author_id",
        "outbound_count",
        "inbound_count",
        *[F.bround(c, 3).alias(n) for n, c in measures.items()],
    )


def name_accounts(accounts: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``brand_name`` from ``names(author_id, brand_name)``, whose ids must be unique."""
    unknown = F.concat(F.lit("unknown_"), F.col("author_id"))
    return accounts.join(names, "author_id", "left").withColumn(
        "brand_name", F.coalesce("brand_name", unknown)
    )


def score_accounts(
    profile: DataFrame, weights: tuple[float, float, float, float] = presets.PROFILE_WEIGHTS
) -> DataFrame:
    """Add min-max normalised measures and their weighted sum.

    The extremes are one scalar row, not a window over the whole table.
    """
    measures = ["outbound_count", "thread_completeness", "noise_frac", "topic_ttr"]
    ends = profile.agg(
        F.struct(
            *[F.min(m).alias(f"{m}_low") for m in measures],
            *[F.max(m).alias(f"{m}_high") for m in measures],
        )
    ).scalar()
    out = profile.withColumn("_ends", ends)
    for m in measures:
        low, high = F.col(f"_ends.{m}_low"), F.col(f"_ends.{m}_high")
        span = F.when(high != low, high - low).otherwise(F.lit(1))
        out = out.withColumn(f"{m}_norm", (F.col(m) - low) / span)
    volume, complete, clean, breadth = weights
    score = (
        volume * F.col("outbound_count_norm")
        + complete * F.col("thread_completeness_norm")
        + clean * (1 - F.col("noise_frac_norm"))
        + breadth * F.col("topic_ttr_norm")
    )
    return out.withColumn("score", score).drop("_ends")


def ordered_accounts(scored: DataFrame) -> DataFrame:
    """All accounts, best first; the sort deals ranges of scores to tasks."""
    return scored.orderBy(F.desc("score"), "author_id")


def top_accounts(scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best accounts with their rank."""
    best = ordered_accounts(scored).limit(n)
    order = Window.orderBy(F.desc("score"), F.col("author_id"))
    return best.withColumn("rank", F.row_number().over(order))
