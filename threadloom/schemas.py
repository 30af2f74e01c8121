"""Explicit schemas; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_MESSAGES = _strings(
    "tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id",
    "in_response_to_tweet_id",
)

CORPUS = T.StructType(
    [T.StructField("idx", T.LongType())]
    + _strings("tweet_id", "customer_text", "reply_text", "intent_seed", "created_at").fields
)

HIT = T.StructType(CORPUS.fields + [T.StructField("score", T.DoubleType())])

VECTORS = T.StructType(
    [T.StructField("idx", T.LongType()), T.StructField("vec", T.ArrayType(T.FloatType()))]
)

TAXONOMY = T.StructType(
    [T.StructField("ord", T.IntegerType())]
    + _strings("id", "label", "description").fields
    + [T.StructField("seed_keywords", T.ArrayType(T.StringType()))]
    + _strings("escalation_default", "escalation_note").fields
    + [T.StructField("data_frequency_pct", T.DoubleType())]
)

GOLDEN_SET = _strings(
    "message_id", "input_text", "gold_intent", "gold_decision", "gold_decision_reason",
    "reference_resolution_note", "sampling_batch", "labelled_by", "correction_note",
)

AGENT_RESULTS = T.StructType(
    _strings(
        "message_id", "gold_intent", "gold_decision", "pred_intent", "pred_decision",
        "pred_reason", "draft_reply",
    ).fields
    + [
        T.StructField("retrieved_hits", T.ArrayType(HIT)),
        T.StructField("confidence", T.DoubleType()),
    ]
    + _strings("input_text", "reference_note", "agent_type").fields
)

JUDGE_RESULTS = T.StructType(
    _strings("message_id", "gold_intent").fields
    + [
        T.StructField(n, T.IntegerType())
        for n in ("groundedness", "accuracy", "helpfulness", "tone", "total")
    ]
    + _strings("overall_comment", "raw_response").fields
)

HUMAN_SCORES = _strings(
    "message_id", "customer_message", "classified_intent", "retrieved_references", "draft_reply",
    "escalation_decision", "escalation_reason", "groundedness", "accuracy", "helpfulness", "tone",
    "total", "notes",
)
