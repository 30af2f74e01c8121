"""Pairing customer messages with an account's replies.

``messages`` has the columns tweet_id (unique), author_id, inbound, created_at, text,
in_response_to_tweet_id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators.ranking import best_per_group


def normalise(messages: DataFrame, accept_01: bool = False) -> DataFrame:
    """Turn the text column ``inbound`` into a boolean; unknown words become NULL."""
    return messages.withColumn("inbound", T.parse_bool(F.col("inbound"), accept_01))


def inbound(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("inbound"))


def outbound(messages: DataFrame, account: Column | str | None = None) -> DataFrame:
    """Replies, of one account if given; rows of unknown direction are in neither side."""
    replies = messages.where(~F.col("inbound"))
    return replies if account is None else replies.where(F.col("author_id") == account)


def replied_ids(messages: DataFrame, account: str | None = None) -> DataFrame:
    """Distinct ids that were replied to; duplicates are dropped before the shuffle."""
    edges = outbound(messages, account).where(F.col("in_response_to_tweet_id").isNotNull())
    return edges.select(F.col("in_response_to_tweet_id").alias("tweet_id")).distinct()


def replied(messages: DataFrame, account: str | None = None) -> DataFrame:
    """Inbound messages with at least one reply."""
    return inbound(messages).join(replied_ids(messages, account), "tweet_id", "left_semi")


def unreplied(messages: DataFrame, account: str | None = None) -> DataFrame:
    """Inbound messages without any reply."""
    return inbound(messages).join(replied_ids(messages, account), "tweet_id", "left_anti")


def _reply_columns(replies: DataFrame) -> DataFrame:
    return replies.where(F.col("in_response_to_tweet_id").isNotNull()).select(
        F.col("in_response_to_tweet_id").alias("tweet_id"),
        F.col("tweet_id").alias("reply_id"),
        F.col("text").alias("reply_text"),
        F.col("created_at").alias("reply_at"),
    )


def pair_all(
    messages: DataFrame, account: str | None = None, keep_unreplied: bool = False
) -> DataFrame:
    """Every (message, reply) pair; a message with several replies gives several rows.

    The pairs are an inner join, which lets adaptive execution split a message that drew a large
    part of all replies. Unreplied messages, if wanted, are appended with NULL replies instead of
    asked from an outer join, which could not be split on that side.
    """
    replies = _reply_columns(outbound(messages, account))
    pairs = inbound(messages).join(replies, "tweet_id")
    if not keep_unreplied:
        return pairs
    return pairs.unionByName(unreplied(messages, account), allowMissingColumns=True)


def pair_longest(
    messages: DataFrame,
    account: str | None = None,
    min_chars: int | None = presets.MIN_SIDE_CHARS,
) -> DataFrame:
    """One row per replied message with its longest reply (smallest reply id among equals).

    Pairs with a side of at most ``min_chars`` characters are dropped, after the choice.
    """
    replies = _reply_columns(outbound(messages, account))
    order = [F.desc_nulls_last(F.length("reply_text")), F.col("reply_id")]
    pairs = inbound(messages).join(best_per_group(replies, ["tweet_id"], order), "tweet_id")
    if min_chars is None:
        return pairs
    return pairs.where(
        T.longer_than(F.col("text"), min_chars) & T.longer_than(F.col("reply_text"), min_chars)
    )


def last_before(
    df: DataFrame, group: str, position: str, wanted: Mapping[str, Column], chunk: int = 4096
) -> DataFrame:
    """Add, per entry of ``wanted``, the latest earlier ``position`` at which its test was true.

    A running maximum in two levels: inside chunks of ``chunk`` positions, and over one row per
    chunk. A group of any length is thus handled in pieces. ``position`` is a whole number,
    unique in its group.
    """
    marks = {name: F.when(test, F.col(position)) for name, test in wanted.items()}
    marked = df.withColumn("_chunk", F.floor(F.col(position) / chunk))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    tops = marked.groupBy(group, "_chunk").agg(
        *[F.max(mark).alias(f"_top_{name}") for name, mark in marks.items()]
    )
    by_chunk = earlier.partitionBy(group).orderBy("_chunk")
    carried = tops.select(
        group, "_chunk", *[F.max(f"_top_{n}").over(by_chunk).alias(f"_carry_{n}") for n in marks]
    )
    inside = earlier.partitionBy(group, "_chunk").orderBy(position)
    return (
        marked.withColumns({f"_in_{n}": F.max(mark).over(inside) for n, mark in marks.items()})
        .join(carried, [group, "_chunk"])
        .select(
            *df.columns, *[F.coalesce(f"_in_{n}", f"_carry_{n}").alias(n) for n in marks]
        )
    )
