"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from threadloom.operators import classes as C
from threadloom.operators import grounding as G
from threadloom.operators import threads as H
from threadloom.operators.sampling import sample_per_stratum
from threadloom.sources import tables as IO
from workload import catalog, eval_queries
from workload import common as W

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.ENTRIES))
def test_no_cross_join_and_no_python_expression(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in text


def test_texts_are_cleaned_once_for_two_classifiers(spark):
    # once for all of _rows: three patterns, then the gaps
    assert plan(eval_queries._rows(spark, SF)).count("regexp_replace(") == 4


def test_words_of_a_draft_are_taken_once(spark):
    rows = spark.createDataFrame([("ab cd", "cd")], "d string, r string")
    text = plan(G.groundedness(rows, F.col("d"), F.col("r")).select("groundedness"))
    assert text.count("regexp_replace(") == 2  # draft and references


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "messages")
    IO.write_table(W.messages(spark, SF), path)
    return IO.read_table(spark, path)


def test_account_filter_and_columns_reach_the_scan(messages):
    text = plan(H.outbound(messages, F.lit("acct1")).select("tweet_id"))
    assert "EqualTo(author_id,acct1)" in text
    assert "struct<tweet_id:string,author_id:string,inbound:boolean>" in text


def test_longest_reply_is_reduced_before_the_shuffle(messages):
    text = plan(H.pair_longest(messages))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("row_number(), 1, Final") < partial
    assert "Exchange hashpartitioning" in text[: partial]


def test_stratified_sample_is_reduced_before_both_shuffles(spark):
    docs = W.table(spark, SF, "documents").select("doc_id", "lang")
    text = plan(sample_per_stratum(docs, "lang", "doc_id", 5, 1))
    assert text.count("row_number(), 5, Partial") == 2
    assert "struct<doc_id:bigint,lang:string>" in text


def test_filter_on_the_class_does_not_copy_the_classification(spark):
    rows = C.classify(W.table(spark, SF, "conversations"), F.col("text"), W.CLASSES)
    text = plan(rows.where(F.col("intent") == "ACCOUNT_ACCESS").select("conv_id"))
    assert text.count("Contains(") == sum(len(w) for w in W.CLASSES.values())


def test_class_counts_shuffle_counts_only(spark):
    rows = C.classify(W.table(spark, SF, "conversations"), F.col("text"), W.CLASSES)
    text = plan(C.value_counts(rows, "intent"))
    assert "partial_count(1)" in text


@pytest.mark.parametrize("name", ["triage_threads", "escalation_policy", "escalation_simple"])
def test_no_message_is_shuffled_by_its_class(spark, name):
    result = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(pred_intent" not in plan and "hashpartitioning(intent" not in plan
