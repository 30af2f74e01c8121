import pytest
from pyspark.sql import functions as F

from threadloom.operators import profile as P
from threadloom.operators import threads as H

SCHEMA = (
    "tweet_id string, author_id string, inbound string, created_at string, text string, "
    "in_response_to_tweet_id string"
)


def build(spark, *rows):
    full = [(i, a, d, "t", text, parent) for i, a, d, text, parent in rows]
    return H.normalise(spark.createDataFrame(full, SCHEMA))


@pytest.fixture(scope="module")
def messages(spark):
    return build(
        spark,
        ("q1", "u1", "True", "q" * 25, None),
        ("q2", "u2", "True", "q" * 20, None),
        ("q3", "u3", "True", "q" * 30, None),
        ("q4", "u4", "True", "q" * 30, None),
        ("x", "u5", "maybe", "q" * 30, "q1"),
        ("a1", "shop", "False", "a" * 30, "q1"),
        ("a2", "shop", "False", "b" * 50, "q1"),
        ("a3", "shop", "False", "c" * 50, "q1"),
        ("a4", "shop", "False", "d" * 30, "q2"),
        ("a5", "shop", "False", "e" * 20, "q3"),
        ("a6", "shop", "False", None, "q4"),
        ("a7", "shop", "False", "f" * 30, None),
        ("a8", "other", "False", "g" * 99, "q1"),
        ("a9", "shop", "False", "h" * 30, "gone"),
        ("q5", "u1", "True", "Good good", "a1"),
        ("q6", "u1", "True", None, "a2"),
    )


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_sides(messages):
    assert H.inbound(messages).count() == 6
    assert H.outbound(messages, F.lit("shop")).count() == 8


def test_pair_all_fans_out(messages):
    pairs = ids(H.pair_all(messages, F.lit("shop")), "tweet_id", "reply_id")
    assert pairs == [("q1", "a1"), ("q1", "a2"), ("q1", "a3"), ("q2", "a4"), ("q3", "a5"),
                     ("q4", "a6")]


def test_pair_all_keeps_unreplied_on_request(messages):
    pairs = H.pair_all(messages, F.lit("shop"), keep_unreplied=True)
    assert ids(pairs.where("reply_id is null"), "tweet_id") == [("q5",), ("q6",)]


def test_pair_longest(messages):
    every = H.pair_longest(messages, F.lit("shop"), None)
    assert ids(every, "tweet_id", "reply_id") == [("q1", "a2"), ("q2", "a4"), ("q3", "a5"),
                                                  ("q4", "a6")]
    assert ids(H.pair_longest(messages, F.lit("shop")), "tweet_id", "reply_id") == [("q1", "a2")]


def test_replied_and_unreplied(messages):
    assert ids(H.replied(messages), "tweet_id") == [("q1",), ("q2",), ("q3",), ("q4",)]
    assert ids(H.unreplied(messages), "tweet_id") == [("q5",), ("q6",)]


def test_profile(messages):
    rows = {r.author_id: r for r in P.profile_accounts(messages, min_outbound=1).collect()}
    shop, other = rows["shop"], rows["other"]
    assert (shop.outbound_count, shop.inbound_count, shop.pct_inbound) == (8, 0, 0.0)
    assert shop.thread_completeness == 0.8  # q1 q2 q3 q4 of five targets
    assert shop.noise_frac == 0.143  # one of seven texts
    assert shop.topic_ttr == 0.5  # "good good"
    assert (other.thread_completeness, other.topic_ttr) == (1.0, 0.0)
    assert "u1" not in rows


def test_account_without_text_or_links(spark):
    m = build(spark, ("a", "shop", "False", None, None))
    row = P.profile_accounts(m, min_outbound=1).first()
    assert (row.noise_frac, row.thread_completeness, row.topic_ttr) == (1.0, 0.0, 0.0)


def test_eligibility_bounds(spark):
    rows = [("a", 200, 0.19), ("b", 199, 0.0), ("c", 300, 0.2)]
    df = spark.createDataFrame(rows, "author_id string, outbound_count long, pct_inbound double")
    assert [r.author_id for r in P.eligible(df).collect()] == ["a"]


def test_scores_of_equal_accounts(spark):
    rows = [("a", 5, 0.5, 0.5, 0.5), ("b", 5, 0.5, 0.5, 0.5)]
    df = spark.createDataFrame(
        rows, "author_id string, outbound_count long, thread_completeness double, "
        "noise_frac double, topic_ttr double",
    )
    scored = P.top_accounts(P.score_accounts(df)).collect()
    assert [(r["rank"], r.author_id, r.score) for r in scored] == [(1, "a", 0.2), (2, "b", 0.2)]


def test_published_score_formula(spark):
    rows = [("top", 42944, 0.997, 0.002, 0.236), ("low", 200, 0.5, 0.3, 0.236)]
    df = spark.createDataFrame(
        rows, "author_id string, outbound_count long, thread_completeness double, "
        "noise_frac double, topic_ttr double",
    )
    scored = {r.author_id: round(r.score, 3) for r in P.score_accounts(df).collect()}
    assert scored == {"top": 0.9, "low": 0.0}


def test_names(spark):
    accounts = spark.createDataFrame([("1",), ("2",)], "author_id string")
    names = spark.createDataFrame([("1", "One")], "author_id string, brand_name string")
    assert ids(P.name_accounts(accounts, names), "author_id", "brand_name") == [
        ("1", "One"), ("2", "unknown_2")
    ]


@pytest.mark.parametrize("chunk", [1, 2, 3, 4096])
def test_last_before_in_any_chunk_size(spark, chunk):
    flags = {("a", 0): 1, ("a", 1): 0, ("a", 2): 0, ("a", 5): 1, ("a", 9): 0, ("b", 7): 0}
    rows = [(g, p, f) for (g, p), f in flags.items()]
    df = spark.createDataFrame(rows, "g string, p long, f int")
    out = H.last_before(df, "g", "p", {"last": F.col("f") == 1, "miss": F.col("f") == 0}, chunk)
    got = {(r.g, r.p): (r.last, r.miss) for r in out.collect()}
    for g, p in flags:
        earlier = [q for (h, q) in flags if h == g and q < p]
        want = tuple(
            max((q for q in earlier if flags[g, q] == flag), default=None) for flag in (1, 0)
        )
        assert got[g, p] == want
