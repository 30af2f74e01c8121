import hashlib

import pytest
from pyspark.sql import functions as F

from threadloom.operators import classes as C
from threadloom.operators import golden as G
from threadloom.operators import ranking as R
from threadloom.operators import sampling as S


def digest(seed, i):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most of the rows."""
    group = F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(
        F.concat(F.lit("g"), (F.col("id") % 70).cast("string"))
    )
    return spark.range(6000).select(group.alias("g"), "id", (F.col("id") * 37 % 101).alias("v"))


def brute(hot, n):
    rows = {}
    for r in hot.collect():
        rows.setdefault(r.g, []).append((-r.v, r.id))
    return {(g, i + 1, x[1]) for g, xs in rows.items() for i, x in enumerate(sorted(xs)[:n])}


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("n, lanes", [(1, 256), (5, 256), (5, 1), (40, 3), (1500, 4)])
def test_top_n_per_group(hot, parts, n, lanes):
    spread = hot.repartition(parts)
    out = R.top_n_per_group(spread, ["g"], [F.desc("v"), F.col("id")], n, lanes=lanes)
    assert {(r.g, r["rank"], r.id) for r in out.collect()} == brute(hot, n)


@pytest.mark.parametrize("n", [10, 1000, 2500, 6000, 9000])
def test_samples_are_exact_and_do_not_depend_on_partitions(hot, n):
    want = sorted(range(6000), key=lambda i: (digest(42, i), i))[:n]
    for parts in (1, 5):
        got = [r.id for r in S.sample(hot.repartition(parts), "id", n, 42).collect()]
        assert got == want


@pytest.mark.parametrize("n", [10, 1500, 9000])
def test_first_rows(hot, n):
    for column, ties in (("id", []), ("v", ["id"])):
        rows = [(r[column], r.id) for r in hot.collect()]
        got = [(r[column], r.id) for r in R.first_rows(hot, column, n, ties).collect()]
        assert got == sorted(rows)[:n]


def test_first_rows_of_any_type(spark):
    wide = spark.createDataFrame([(-9 * 10**18,), (9 * 10**18,), (None,), *[(i,) for i in range(300)]], "k long")
    assert [r.k for r in R.first_rows(wide, "k", 60).collect()] == [None, -9 * 10**18, *range(58)]
    text = wide.select(F.col("k").cast("string").alias("k"))
    want = sorted((r.k for r in text.collect()), key=lambda x: (x is not None, x))
    assert [r.k for r in R.first_rows(text, "k", 60).collect()] == want[:60]
    assert R.first_rows(wide, "k", 0).count() == 0


def test_first_rows_of_equal_and_empty(spark):
    same = spark.range(3000).select("id", F.lit(7).alias("k"))
    assert [r.id for r in R.first_rows(same, "k", 1200, ["id"]).collect()] == list(range(1200))
    assert R.first_rows(same.where("id < 0"), "k", 1200, ["id"]).count() == 0


def test_shuffle_order_numbers_all_rows(hot):
    got = {r.id: r.place for r in S.shuffle_order(hot, "id", 3).collect()}
    want = sorted(range(6000), key=lambda i: (digest(3, i), i))
    assert got == {i: place + 1 for place, i in enumerate(want)}


def test_stratified(hot):
    out = S.sample_per_stratum(hot, "g", "id", 4, 9).collect()
    by = {}
    for r in hot.collect():
        by.setdefault(r.g, []).append(r.id)
    want = {(g, i) for g, xs in by.items() for i in sorted(xs, key=lambda x: digest(9, x))[:4]}
    assert {(r.g, r.id) for r in out} == want


def test_quota_rounds_half_to_even_and_is_at_least_one(spark):
    # shares 1/32 -> 2.5, 1/1000-ish -> 1; the skipped class counts in the shares
    sizes = {"a": 100, "b": 3, "UNCLASSIFIED": 3097}
    rows = [(c,) for c, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "c string")
    got = {r.c: r.quota for r in S.proportional_quotas(df, "c", 80).collect()}
    assert got == {"a": 2, "b": 1}


def test_value_counts_and_majority(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",)], "c string")
    assert {r.c: (r.n, r.share) for r in C.value_counts(df, "c").collect()} == {
        "a": (2, 0.4), "b": (2, 0.4), "c": (1, 0.2)
    }
    assert C.majority_class(df, "c").first().c == "a"


def test_published_class_shares(spark):
    counts = {"UNCLASSIFIED": 17504, "rest": 22121, "small": 375}
    df = spark.range(40000).select(
        F.when(F.col("id") < 17504, "UNCLASSIFIED").when(F.col("id") < 39625, "rest")
        .otherwise("small").alias("c")
    )
    got = {r.c: (r.n, round(100 * r.share, 1)) for r in C.value_counts(df, "c").collect()}
    assert got == {c: (n, round(100 * n / 40000, 1)) for c, n in counts.items()}
    assert got["UNCLASSIFIED"][1] == 43.8 and got["small"][1] == 0.9


def test_near_duplicates_with_a_hot_prefix(spark):
    rows = [("same" * 30, i) for i in range(500)] + [(f"t{i}", 500 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "prefix string, seq int").repartition(6)
    kept = sorted(r.seq for r in G.drop_near_duplicates(df, "prefix", "seq").collect())
    assert kept == [0] + list(range(500, 520))


def golden_corpus(spark):
    labels = ["ORDER_DELIVERY_STATUS"] * 12 + ["ACCOUNT_ACCESS"] * 2 + ["ORDER_CANCELLATION"]
    labels += ["UNCLASSIFIED"] * 5
    rows = []
    for i in range(400):
        label = labels[i % 20]
        text = "copy " * 30 if i % 40 == 3 else f"message number {i} " + "x" * (i % 90)
        rows.append((i, text, "reply", label))
    rows.append((400, "ж" * 30, "reply", "ACCOUNT_ACCESS"))
    return spark.createDataFrame(
        rows, "tweet_id int, customer_text string, reply_text string, intent_seed string"
    )


def test_golden_set(spark):
    policy = {"ACCOUNT_ACCESS": ("escalate", "identity"), "ORDER_DELIVERY_STATUS": ("auto", "track")}
    corpus = golden_corpus(spark)
    rule = {"cap": 250, "dedup_prefix": 100}
    one = G.build(corpus.repartition(1), policy, **rule).collect()
    many = G.build(corpus.repartition(9), policy, **rule).collect()
    assert sorted(one) == sorted(many)
    batches = {}
    for r in one:
        batches.setdefault(r.sampling_batch, []).append(r)
    assert len({r.input_text[:100] for r in one}) == len(one)
    assert len({r.message_id for r in one}) == len(one)
    assert all(r.labelled_by == "NEEDS_HUMAN_REVIEW" for r in one)
    assert 45 <= len(batches["A_proportional"]) <= 60  # 48 + 8 + 4 quotas, less copies
    assert {r.gold_decision for r in batches.get("D_escalation_positive", [])} <= {"escalate"}
    assert {r.gold_decision for r in batches.get("E_auto_handle", [])} <= {"auto"}
    assert all(20 <= len(r.input_text) <= 80 for r in batches["C_short"])
    assert {r.gold_intent for r in batches["C_ambiguous"]} == {"UNCLASSIFIED"}
    assert not any("ж" in r.input_text for r in one)


def test_golden_set_of_whole_texts_and_with_a_cap(spark):
    policy = {"ACCOUNT_ACCESS": ("escalate", "identity")}
    corpus = golden_corpus(spark).withColumn(
        "customer_text", F.concat(F.repeat(F.lit("same words "), F.lit(12)), (F.col("tweet_id") % 50).cast("string"))
    )
    whole = G.build(corpus, policy).collect()
    assert len({r.input_text for r in whole}) == len(whole) > 10
    assert len(G.build(corpus, policy, dedup_prefix=100).collect()) == 1
    capped = G.build(corpus, policy, cap=7).collect()
    assert sorted(r.message_id for r in capped) == sorted(r.message_id for r in whole)[:7]
