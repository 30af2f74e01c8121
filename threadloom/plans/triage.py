"""Triage of messages: class, decision with reason, and a draft taken from past replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import keywords as K
from threadloom.functions import replies as P
from threadloom.functions import rules as R
from threadloom.operators.binding import evaluate_once
from threadloom.operators.classes import classify
from threadloom.operators.similarity import gather_hits, top_k

MOST_CLASSES = 10_000
HIT_COLUMNS = ["tweet_id", "customer_text", "reply_text", "intent_seed", "created_at"]


def with_policy(rows: DataFrame, taxonomy: DataFrame, label: str) -> DataFrame:
    """Add ``escalation_default`` and ``escalation_note`` of the row's class.

    A taxonomy of at most ``MOST_CLASSES`` classes (checked) is broadcast, so that no message is
    shuffled by its class, of which a few hold most messages.
    """
    if taxonomy.limit(MOST_CLASSES + 1).count() > MOST_CLASSES:
        raise ValueError(f"a taxonomy has at most {MOST_CLASSES} classes")
    policy = taxonomy.select(
        F.col("id").alias(label), "escalation_default", "escalation_note"
    )
    return rows.join(F.broadcast(policy), label, "left")


def decide(
    rows: DataFrame,
    taxonomy: DataFrame,
    label: str = "pred_intent",
    text: str = "input_text",
    reasoning: str | None = None,
    triggers: Sequence[str] = presets.ESCALATION_TRIGGERS,
    hard_classes: Sequence[str] = presets.HARD_ESCALATION_CLASSES,
) -> DataFrame:
    """Add pred_decision, pred_reason and the level (1 to 4) that decided."""
    said = F.lit("") if reasoning is None else F.col(reasoning)
    verdict = R.escalation(
        F.col(label), F.col("_hits"), said, F.col("escalation_default"),
        F.col("escalation_note"), hard_classes,
    )
    known = with_policy(rows, taxonomy, label)
    lowered = known.withColumn("_lower", F.lower(F.col(text)))
    found = evaluate_once(lowered, _hits=R.trigger_hits(F.col("_lower"), triggers))
    return found.withColumn("_verdict", verdict).select(
        *rows.columns,
        F.col("_verdict.decision").alias("pred_decision"),
        F.col("_verdict.reason").alias("pred_reason"),
        F.col("_verdict.level").alias("decision_level"),
    )


def decide_simple(
    rows: DataFrame,
    taxonomy: DataFrame,
    label: str = "pred_intent",
    text: str = "input_text",
    triggers: Sequence[str] = presets.ESCALATION_TRIGGERS_SIMPLE,
) -> DataFrame:
    """Add pred_decision and pred_reason by trigger substrings and the class default."""
    verdict = R.escalation_simple(
        F.col("_hits"), F.col("escalation_default"), F.col("escalation_note")
    )
    known = with_policy(rows, taxonomy, label)
    lowered = known.withColumn("_lower", F.lower(F.col(text)))
    found = evaluate_once(lowered, _hits=R.trigger_hits(F.col("_lower"), triggers, False))
    return found.withColumn("_verdict", verdict).select(
        *rows.columns,
        F.col("_verdict.decision").alias("pred_decision"),
        F.col("_verdict.reason").alias("pred_reason"),
    )


def triage(
    rows: DataFrame,
    classes: K.Classes,
    taxonomy: DataFrame,
    text: str = "input_text",
    fallback: str = presets.DEFAULT_CLASS,
    triggers: Sequence[str] = presets.ESCALATION_TRIGGERS_SIMPLE,
) -> DataFrame:
    """Add pred_intent, confidence, pred_decision and pred_reason by keywords alone.

    Stateless, so the same plan serves batch and streaming.
    """
    labelled = classify(
        rows, F.col(text), classes, fallback, "pred_intent", "_score", single_pass=True
    )
    scored = labelled.withColumn("confidence", K.confidence(F.col("_score"))).drop("_score")
    return decide_simple(scored, taxonomy, "pred_intent", text, triggers)


def draft_from_hits(
    questions: DataFrame, corpus: DataFrame, k: int = 5, exclude_self: bool = True
) -> DataFrame:
    """Add ``retrieved_hits`` and, as the draft, the reply of the most similar past thread.

    ``questions`` has ``(message_id, input_text, vec, ...)``, ``corpus`` the corpus columns and
    ``vec``; ``exclude_self`` compares message_id with idx.
    """
    asked = questions.select(F.col("message_id").alias("query_id"), "vec")
    ranked = top_k(corpus, asked, k, exclude_self)
    present = [c for c in HIT_COLUMNS if c in corpus.columns]
    hits = gather_hits(ranked, corpus, present).withColumnRenamed("query_id", "message_id")
    joined = questions.drop("vec").join(hits, "message_id", "left")
    first_reply = F.get("hits", F.lit(0))["reply_text"]
    return joined.withColumn(
        "draft_reply", F.coalesce(first_reply, F.lit(presets.DRAFT_FALLBACK))
    ).withColumnRenamed("hits", "retrieved_hits")


def retrieval_agent(
    questions: DataFrame,
    corpus: DataFrame,
    classes: K.Classes,
    taxonomy: DataFrame,
    k: int = 5,
    exclude_self: bool = True,
    fallback: str = presets.DEFAULT_CLASS,
    triggers: Sequence[str] = presets.ESCALATION_TRIGGERS_SIMPLE,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Triage every question and draft its reply from the most similar past thread.

    A question's row depends on that question and the corpus alone. So where a report shows a few rows,
    ``wanted`` (one column ``message_id``, few rows, compared as text) selects the questions before they
    are searched for; a filter on the result would not get past the search.
    """
    if wanted is not None:
        ids = wanted.select(F.col("message_id").cast("string").alias("_wanted"))
        named = F.col("message_id").cast("string") == F.col("_wanted")
        questions = questions.join(F.broadcast(ids), named, "left_semi")
    answered = draft_from_hits(questions, corpus, k, exclude_self)
    return triage(answered, classes, taxonomy, "input_text", fallback, triggers).withColumn(
        "agent_type", F.lit("retrieval_only_baseline")
    )


def read_classifier_replies(
    rows: DataFrame, raw: str, labels: Sequence[str], default: str = presets.DEFAULT_CLASS
) -> DataFrame:
    """Add pred_intent, confidence and reasoning from the model replies in column ``raw``."""
    parsed = rows.withColumn("_parsed", P.parse_object(F.col(raw)))
    reply = P.classifier_reply(F.col(raw), F.col("_parsed"), labels, default)
    return evaluate_once(parsed, _reply=reply).select(
        *rows.columns,
        F.col("_reply.intent").alias("pred_intent"),
        F.col("_reply.confidence").alias("confidence"),
        F.col("_reply.reasoning").alias("reasoning"),
    )


def triage_replies(
    rows: DataFrame,
    raw: str,
    taxonomy: DataFrame,
    labels: Sequence[str],
    default: str = presets.DEFAULT_CLASS,
    triggers: Sequence[str] = presets.ESCALATION_TRIGGERS,
) -> DataFrame:
    """Class, confidence and decision from a classifier's replies: the step between two prompts."""
    read = read_classifier_replies(rows, raw, labels, default)
    return decide(read, taxonomy, reasoning="reasoning", triggers=triggers)


def read_judge_replies(rows: DataFrame, raw: str) -> tuple[DataFrame, DataFrame]:
    """Score columns of the readable judge replies, and the unreadable rows."""
    parsed = rows.withColumn("_parsed", P.parse_object(F.col(raw)))
    good = parsed.where(F.col("_parsed").isNotNull()).withColumn(
        "_scores", P.judge_reply(F.col("_parsed"))
    )
    readable = good.select(*rows.columns, "_scores.*")
    return readable, parsed.where(F.col("_parsed").isNull()).drop("_parsed")
