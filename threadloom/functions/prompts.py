"""Prompt texts as columns; calling a model is left to the caller.

The data-bearing lines have a fixed format. The instructions around them are arguments, with
``{labels}``, ``{intent}``, ``{decision}`` and ``{reason}`` filled per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions import text as T

CLASSIFY_INSTRUCTIONS = (
    "Choose the single label that fits the customer's message best:\n{labels}\n\n"
    "With several issues, prefer the one about money or account access.\n"
    "Answer with one JSON object with the keys intent, confidence and reasoning."
)
REPLY_INSTRUCTIONS = (
    "Write a short reply to the customer, based only on the past replies shown.\n"
    "Detected intent: {intent}\nEscalation decision: {decision} — {reason}"
)
JUDGE_INSTRUCTIONS = (
    "Rate the draft reply from 0 to 3 on groundedness, accuracy, helpfulness and tone.\n"
    "Answer with one JSON object with these keys, total and overall_comment."
)


def label_lines(labels: Sequence[tuple[str, str]]) -> str:
    return "\n".join(f"  {name}: {description}" for name, description in labels)


def numbered_replies(hits: Column, count: int = 5, chars: int = 300) -> Column:
    """``  [1] reply`` lines of the first hits, every reply cut to ``chars``."""
    lines = F.transform(
        F.slice(hits, 1, count),
        lambda h, i: F.concat(
            F.lit("  ["), (i + 1).cast("string"), F.lit("] "),
            F.substring(h["reply_text"], 1, chars),
        ),
    )
    return F.coalesce(F.array_join(lines, "\n"), F.lit(""))


def similar_cases(hits: Column, brand: str, count: int = 3, chars: int = 200) -> Column:
    cases = F.transform(
        F.slice(hits, 1, count),
        lambda h, i: F.concat(
            F.lit("\nSimilar past case "), (i + 1).cast("string"), F.lit(" (similarity="),
            F.format_string("%.2f", F.bround(h["score"], 2)), F.lit("):\n  Customer: "),
            F.substring(h["customer_text"], 1, chars), F.lit(f"\n  {brand} replied: "),
            F.substring(h["reply_text"], 1, chars), F.lit("\n"),
        ),
    )
    return F.coalesce(F.array_join(cases, ""), F.lit(""))


def classify_prompt(
    text: Column,
    hits: Column,
    labels: Sequence[tuple[str, str]],
    brand: str,
    instructions: str = CLASSIFY_INSTRUCTIONS,
) -> Column:
    """``struct(system, user)`` asking for a label, with up to three similar past cases."""
    system = T.fill(instructions, labels=F.lit(label_lines(labels)))
    user = F.concat(
        F.lit("Customer message: "), F.coalesce(text, F.lit("")),
        F.lit(f"\n\nContext — similar resolved cases from {brand}'s support history:"),
        similar_cases(hits, brand),
    )
    return F.struct(system.alias("system"), user.alias("user"))


def reply_prompt(
    text: Column,
    intent: Column,
    hits: Column,
    decision: Column,
    reason: Column,
    brand: str,
    instructions: str = REPLY_INSTRUCTIONS,
) -> Column:
    """``struct(system, user)`` asking for a draft based on up to five past replies."""
    system = T.fill(instructions, intent=intent, decision=decision, reason=reason)
    user = F.concat(
        F.lit("Customer message: "), F.coalesce(text, F.lit("")),
        F.lit(f"\n\nRetrieved {brand} historical replies (from real support conversations):\n"),
        numbered_replies(hits),
    )
    return F.struct(system.alias("system"), user.alias("user"))


def judge_prompt(
    text: Column,
    hits: Column,
    draft: Column,
    intent: Column,
    decision: Column,
    brand: str,
    instructions: str = JUDGE_INSTRUCTIONS,
) -> Column:
    """``struct(system, user)`` asking for scores of a draft."""
    user = F.concat(
        F.lit("CUSTOMER MESSAGE: "), F.coalesce(text, F.lit("")),
        F.lit("\n\nDETECTED INTENT: "), intent,
        F.lit("\nESCALATION DECISION: "), decision,
        F.lit(f"\n\nRETRIEVED {brand.upper()} REPLIES:\n"), numbered_replies(hits),
        F.lit("\n\nAI DRAFT REPLY:\n"), F.coalesce(draft, F.lit("")),
        F.lit("\n\nScore the AI DRAFT REPLY using the rubric."),
    )
    return F.struct(F.lit(instructions).alias("system"), user.alias("user"))
