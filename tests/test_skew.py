"""Hot keys: a third of the rows or more behind one key, with joins forced to shuffle."""

import pytest
from pyspark.sql import functions as F

from threadloom.operators import profile as P
from threadloom.operators import threads as H

TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in TIGHT}
    for k, v in TIGHT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_messages(spark):
    """Message q0 draws most replies, account a0 writes most of them."""
    ids = spark.range(3000, numPartitions=6)
    questions = ids.where("id < 300").select(
        F.concat(F.lit("q"), "id").alias("tweet_id"), F.lit("u").alias("author_id"),
        F.lit(True).alias("inbound"), F.lit("t").alias("created_at"),
        F.concat(F.lit("please help with my order number "), "id").alias("text"),
        F.when(F.col("id") >= 100, F.concat(F.lit("r"), F.col("id") * 3))
        .alias("in_response_to_tweet_id"),
    )
    target = F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 350)
    replies = ids.select(
        F.concat(F.lit("r"), "id").alias("tweet_id"),
        F.when(F.col("id") % 5 > 0, F.lit("a0")).otherwise(F.lit("a1")).alias("author_id"),
        F.lit(False).alias("inbound"), F.lit("t").alias("created_at"),
        F.rpad(F.lit("we look into it "), (F.col("id") % 97 + 30).cast("int"), F.lit("z"))
        .alias("text"),
        F.concat(F.lit("q"), target).alias("in_response_to_tweet_id"),
    )
    return questions.unionByName(replies)


def test_pairs_of_a_hot_message(tight):
    messages = hot_messages(tight)
    rows = messages.collect()
    known = {r.tweet_id for r in rows if r.inbound}
    want = sorted((r.in_response_to_tweet_id, r.tweet_id) for r in rows
                  if not r.inbound and r.in_response_to_tweet_id in known)
    pairs = H.pair_all(messages).select("tweet_id", "reply_id")
    assert sorted(tuple(r) for r in pairs.collect()) == want
    assert sum(1 for q, _ in want if q == "q0") > len(want) / 2
    # the finished plan reads the hot partition in pieces
    pairs.write.format("noop").mode("overwrite").save()
    executed = H.pair_all(messages).select("tweet_id", "reply_id")
    executed.collect()
    assert "skew=true" in executed._jdf.queryExecution().executedPlan().toString()


def test_longest_reply_of_a_hot_message(tight):
    messages = hot_messages(tight)
    best = {}
    for r in messages.where("not inbound").collect():
        key = (-len(r.text), r.tweet_id)
        best[r.in_response_to_tweet_id] = min(best.get(r.in_response_to_tweet_id, key), key)
    got = {r.tweet_id: r.reply_id for r in H.pair_longest(messages).collect()}
    assert got == {q: best[q][1] for q in got} and "q0" in got


def test_profile_of_a_hot_account(tight):
    rows = {r.author_id: r for r in P.profile_accounts(hot_messages(tight)).collect()}
    assert rows["a0"].outbound_count == 2400 and rows["a1"].outbound_count == 600
    texts = [r for r in hot_messages(tight).where("inbound").collect()
             if r.in_response_to_tweet_id is not None]
    own = {"a0": [], "a1": []}
    for r in sorted(texts, key=lambda r: r.tweet_id):
        n = int(r.in_response_to_tweet_id[1:])
        if n < 3000:
            own["a0" if n % 5 else "a1"].append(r.text)
    for name, found in own.items():
        words = " ".join(found).lower().split()
        assert rows[name].topic_ttr == round(len(set(words)) / len(words), 3)


def test_text_richness_reads_the_first_texts_only(tight):
    texts = tight.range(2500, numPartitions=5).select(
        F.lit("hot").alias("a"), "id", F.concat(F.lit("w"), "id").alias("text")
    ).unionByName(
        tight.range(2).select(F.lit("cold").alias("a"), "id", F.lit("same").alias("text"))
    )
    same = texts.withColumn("text", F.when(F.col("id") < 1000, F.lit("x y")).otherwise("text"))
    got = {r.a: r.topic_ttr for r in P.vocabulary_richness(same, "a", "id", first=1000).collect()}
    assert got == {"hot": 2 / 2000, "cold": 2 / 4}
    # without a limit the other 1,500 texts count, too; all of them are the word "text"
    whole = {r.a: r.topic_ttr for r in P.vocabulary_richness(same, "a", "id").collect()}
    assert whole == {"hot": 3 / 3500, "cold": 2 / 4}
