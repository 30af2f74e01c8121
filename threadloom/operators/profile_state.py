"""Account profiles from daily partial states, so that a new day does not read the old messages.

A day is reduced once to counts per account, ids, and word counts, and becomes one run of a
:class:`~threadloom.operators.incremental.RunLog`. A profile adds the states up. Words of an answer go
to the account at once if the message that it answers is known by then; else they wait under that
message's id and are added when states are read. Message ids are unique: a message that comes again,
on whatever day, counts once. The result equals :func:`~threadloom.operators.profile.profile_accounts`
over all days' messages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators import profile as P
from threadloom.operators.incremental import RunLog, unique_rows
from threadloom.operators.threads import inbound, outbound
from threadloom.sources.tables import stage

BY = (("kind", S.StringType()),)
# count: an account's messages of a day; sent: its message ids; edge: messages it replied to; known:
# customers' message ids; word: words of the answers to it; open: words that wait for a message
_COLUMNS = {"author_id": "string", "tweet_id": "string", "word": "string", **dict.fromkeys(("outbound", "inbound", "short", "texts", "n"), "long")}


def open_log(spark, path: str) -> RunLog:
    return RunLog(spark, path, BY)


def _rows(df: DataFrame, kind: str) -> DataFrame:
    given = [F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in _COLUMNS.items()]
    return df.select(*given, F.lit(kind).alias("kind"))


def _kind(state: DataFrame, kind: str) -> DataFrame:
    return state.where(F.col("kind") == kind)


def _total(name: str) -> Column:
    return F.sum(name).alias(name)


def _words_by(words: DataFrame, key: str) -> DataFrame:
    return words.groupBy(key, "word").agg(_total("n"))


def day_state(messages: DataFrame, before: DataFrame | None) -> DataFrame:
    """The state rows of messages that ``before`` does not hold."""
    fresh = unique_rows(messages.select("tweet_id", "author_id", "inbound", "text", "in_response_to_tweet_id"), "tweet_id")
    if before is not None:
        ids = before.where(F.col("kind").isin("sent", "known")).select("tweet_id")
        fresh = fresh.join(ids, "tweet_id", "left_anti")
    fresh = stage(fresh, "fresh")
    sent = ~F.col("inbound")
    counts = fresh.groupBy("author_id").agg(
        F.count_if(sent).alias("outbound"), F.count_if(F.col("inbound")).alias("inbound"),
        F.count_if(sent & (F.length("text") <= presets.NOISE_CHARS)).alias("short"),
        F.count_if(sent & F.col("text").isNotNull()).alias("texts"),
    )
    own = outbound(fresh).select("author_id", "tweet_id")
    edges = outbound(fresh).where(F.col("in_response_to_tweet_id").isNotNull()).select(
        "author_id", F.col("in_response_to_tweet_id").alias("tweet_id")
    ).distinct()
    known = inbound(fresh).select("tweet_id")
    answers = inbound(fresh).where(F.col("in_response_to_tweet_id").isNotNull()).select(
        F.col("in_response_to_tweet_id").alias("tweet_id"), F.explode(T.split_words(F.lower("text"))).alias("word")
    )
    words = answers.groupBy("tweet_id", "word").agg(F.count(F.lit(1)).alias("n"))
    senders = own if before is None else own.union(_kind(before, "sent").select("author_id", "tweet_id"))
    placed = stage(words.join(senders, "tweet_id", "left"), "day-words")
    resolved = _words_by(placed.where(F.col("author_id").isNotNull()), "author_id")
    waiting = placed.where(F.col("author_id").isNull()).select("tweet_id", "word", "n")
    parts = [
        _rows(counts, "count"), _rows(own, "sent"), _rows(edges, "edge"),
        _rows(known, "known"), _rows(resolved, "word"), _rows(waiting, "open"),
    ]
    return reduce(DataFrame.unionByName, parts)


def add_day(log: RunLog, messages: DataFrame, day: str) -> None:
    """Reduce a day's messages and commit them, unless that day was committed before."""
    if not log.committed(day):
        log.append(day_state(messages, log.read()), day)


def _settled(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Word counts ``(author_id, word, n)`` of all accounts, and those that still wait."""
    senders = _kind(state, "sent").select("author_id", "tweet_id")
    waiting = _words_by(_kind(state, "open"), "tweet_id").join(senders, "tweet_id", "left")
    words = _kind(state, "word").select("author_id", "word", "n").union(
        waiting.where(F.col("author_id").isNotNull()).select("author_id", "word", "n")
    )
    return _words_by(words, "author_id"), waiting.where(F.col("author_id").isNull()).select("tweet_id", "word", "n")


def _counted(state: DataFrame) -> DataFrame:
    return _kind(state, "count").groupBy("author_id").agg(*[_total(c) for c in ("outbound", "inbound", "short", "texts")])


def profile(
    log: RunLog, max_inbound: float = presets.MAX_INBOUND_SHARE, min_outbound: int = presets.MIN_OUTBOUND
) -> DataFrame:
    """The profile of the eligible accounts over all committed days, from their states alone."""
    state = log.read()
    if state is None:
        raise ValueError("no day was added")
    total = F.col("outbound") + F.col("inbound")
    accounts = _counted(state).where("outbound > 0").select(
        "author_id", F.col("outbound").alias("outbound_count"), F.col("inbound").alias("inbound_count"),
        F.coalesce(F.try_divide(F.col("short").cast("double"), F.col("texts")), F.lit(1.0)).alias("noise_frac"),
        (F.col("inbound") / total).alias("pct_inbound"),
    )
    edges = _kind(state, "edge").select("author_id", "tweet_id").distinct()
    known = _kind(state, "known").select("tweet_id", F.lit(1).alias("_known"))
    complete = edges.join(known, "tweet_id", "left").groupBy("author_id").agg(
        (F.count("_known") / F.count(F.lit(1))).alias("thread_completeness")
    )
    words, _ = _settled(state)
    richness = words.groupBy("author_id").agg(
        (F.count("word") / F.greatest(F.sum("n"), F.lit(1))).alias("topic_ttr")
    )
    return P.assemble(P.eligible(accounts, max_inbound, min_outbound), complete, richness)


def merge_days(log: RunLog) -> None:
    """Replace the states of all days by their sum. Days stay known as committed."""
    state = log.read()
    if state is None or len(log.runs()) < 2:
        return
    words, waiting = _settled(state)
    parts = [
        _rows(_counted(state), "count"), _rows(words, "word"), _rows(waiting, "open"),
        _rows(_kind(state, "edge").select("author_id", "tweet_id").distinct(), "edge"),
        *[_rows(_kind(state, k).select("author_id", "tweet_id"), k) for k in ("sent", "known")],
    ]
    log.merge(reduce(DataFrame.unionByName, parts))
