"""Ordered rules: relabelling and escalation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import keywords as K
from threadloom.functions import text as T


def is_continuation(cleaned: Column) -> Column:
    """True if the whole text is one courtesy word with optional punctuation."""
    words = "|".join(presets.CONTINUATION_WORDS)
    return cleaned.rlike(f"^{T.SPACE}*({words})[!.{T.SPACE_CHARS}]*$")


def _fires(cleaned: Column, rule: presets.Rule) -> Column:
    test = K.any_word(cleaned, rule.any_of) if rule.any_of else F.lit(True)
    for word in rule.all_of:
        test = test & F.contains(cleaned, F.lit(word))
    if rule.none_of:
        test = test & ~K.any_word(cleaned, rule.none_of)
    if rule.unless_has:
        exempt = F.contains(cleaned, F.lit(rule.unless_has))
        if rule.unless_lacks:
            exempt = exempt & ~F.contains(cleaned, F.lit(rule.unless_lacks))
        test = test & ~exempt
    return test


def _outcome(label: str, decision: str, note: str) -> Column:
    return F.struct(
        F.lit(label).alias("label"), F.lit(decision).alias("decision"), F.lit(note).alias("note")
    )


def apply_rules(
    raw: Column,
    cleaned: Column,
    rules: Sequence[presets.Rule] = presets.RELABEL_RULES,
    default: tuple[str, str, str] = presets.DEFAULT_OUTCOME,
) -> Column:
    """``struct(label, decision, note)`` of the first rule that fires.

    Foreign-language text and mere continuations are out of scope before any rule is tried.
    ``cleaned`` is :func:`threadloom.functions.text.clean_keep_punctuation` of ``raw``.
    """
    foreign = ~T.is_mostly_ascii(raw, presets.ASCII_SHARE_RELABEL)
    chain = F.when(foreign, _outcome(*presets.FOREIGN_OUTCOME)).when(
        is_continuation(cleaned), _outcome(*presets.CONTINUATION_OUTCOME)
    )
    for rule in rules:
        chain = chain.when(_fires(cleaned, rule), _outcome(rule.label, rule.decision, rule.note))
    return chain.otherwise(_outcome(*default))


def trigger_hits(
    lowered: Column,
    triggers: Sequence[str] = presets.ESCALATION_TRIGGERS,
    boundary: bool = True,
) -> Column:
    """The trigger words that occur in a lower-cased text column, in list order."""
    return K.found_words(F.coalesce(lowered, F.lit("")), triggers, boundary)


def escalation(
    label: Column,
    hits: Column,
    reasoning: Column,
    default: Column,
    note: Column,
    hard_classes: Sequence[str] = presets.HARD_ESCALATION_CLASSES,
) -> Column:
    """``struct(decision, reason, level)`` by four levels, the first that applies.

    1 the class always goes to a person, 2 there are trigger ``hits``, 3 the model's reasoning
    asks for a person, 4 the class default. ``default`` and ``note`` are the taxonomy columns of
    the class, NULL for an unknown class.
    """
    said = F.coalesce(reasoning, F.lit(""))

    def out(decision: Column, reason: Column, level: int) -> Column:
        return F.struct(
            decision.alias("decision"), reason.alias("reason"), F.lit(level).alias("level")
        )

    person = F.lit(presets.ESCALATE)
    known_note = F.coalesce(note, F.lit(""))
    hard = T.fill(presets.HARD_RULE_REASON, intent=label, note=known_note)
    triggered = T.fill(presets.TRIGGER_REASON, hits=T.quoted_list(hits))
    asked = T.fill(presets.REASONING_REASON, note=T.truncate(said, 200))
    by_default = F.coalesce(note, T.fill(presets.DEFAULT_REASON, intent=label))
    return (
        F.when(label.isin(list(hard_classes)), out(person, hard, 1))
        .when(F.size(hits) > 0, out(person, triggered, 2))
        .when(K.any_word(F.lower(said), presets.REASONING_FLAGS), out(person, asked, 3))
        .otherwise(out(F.coalesce(default, F.lit(presets.AUTO)), by_default, 4))
    )


def escalation_simple(hits: Column, default: Column, note: Column) -> Column:
    """``struct(decision, reason)``: any trigger hit escalates, else the class default."""
    return F.when(
        F.size(hits) > 0,
        F.struct(
            F.lit(presets.ESCALATE).alias("decision"),
            T.fill(presets.TRIGGER_REASON_SIMPLE, hits=T.quoted_list(hits)).alias("reason"),
        ),
    ).otherwise(
        F.struct(
            F.coalesce(default, F.lit(presets.AUTO)).alias("decision"),
            F.coalesce(note, F.lit(presets.DEFAULT_REASON_SIMPLE)).alias("reason"),
        )
    )
