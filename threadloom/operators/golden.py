"""Evaluation sets: stratified batches, near-duplicate removal, relabelling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import rules as R
from threadloom.functions import text as T
from threadloom.operators.binding import evaluate_once
from threadloom.operators.ranking import best_per_group, top_n_per_group
from threadloom.operators.sampling import draw_key, proportional_quotas

Policy = Mapping[str, tuple[str, str]]


def _lookup(policy: Policy, label: Column, part: int, missing: str) -> Column:
    pairs = [F.lit(x) for name, entry in policy.items() for x in (name, entry[part])]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(missing))


def draw_batches(
    corpus: DataFrame,
    row_id: str,
    text: str,
    label: str,
    seed: int = presets.GOLDEN_SEED,
    total: int = presets.PROPORTIONAL_TOTAL,
    tail: Sequence[str] = presets.TAIL_CLASSES,
    escalating: Sequence[str] = presets.ESCALATION_CLASSES,
    automatic: Sequence[str] = presets.AUTO_CLASSES,
    dedup_prefix: int | None = None,
) -> DataFrame:
    """``(row_id, label, batch, seq, same)``: the drawn rows, numbered in batch order; ``same`` is
    equal for texts that count as one, by default a digest of the whole text, or else its first
    ``dedup_prefix`` characters.

    A row may be drawn by several batches. All batches are drawn in one pass: every row lists the
    batches it is a candidate for, and each task keeps only the best draws per batch and class.
    Only ids and these keys take part.
    """
    own, whole = F.col(label), F.lit("")
    unclassified = own == presets.UNCLASSIFIED

    def candidate(
        order: int, tag: str, stratum: Column, place: Column, quota: int, condition: Column
    ) -> Column:
        return F.when(
            condition,
            F.struct(
                F.lit(order).alias("batch_order"),
                F.lit(tag).alias("batch"),
                stratum.alias("stratum"),
                place.cast("long").alias("place"),
                F.lit(quota).alias("quota"),
                draw_key(seed + max(0, order - 1), F.col(row_id)).alias("draw"),
            ),
        )

    def listed(names: Sequence[str]) -> tuple[Column, Column]:
        return F.array_position(F.array(*map(F.lit, names)), own), own.isin(list(names))

    tail_place, in_tail = listed(tail)
    escalating_place, in_escalating = listed(escalating)
    automatic_place, in_automatic = listed(automatic)
    short = T.length_between(F.col(text), *presets.SHORT_BAND)
    hard = presets.HARD_CASE_QUOTA
    zero = F.lit(0)
    candidates = F.array_compact(
        F.array(
            candidate(1, "A_proportional", own, zero, total, ~unclassified),
            candidate(2, "B_tail_oversample", own, tail_place, presets.TAIL_QUOTA, in_tail),
            candidate(3, "C_short", whole, zero, hard, short),
            candidate(4, "C_ambiguous", whole, zero, hard, unclassified),
            candidate(
                5, "D_escalation_positive", own, escalating_place, presets.ESCALATION_QUOTA,
                in_escalating,
            ),
            candidate(
                6, "E_auto_handle", own, automatic_place, presets.AUTO_QUOTA, in_automatic
            ),
        )
    )
    exploded = corpus.select(
        row_id,
        label,
        text_key(F.col(text), dedup_prefix).alias("same"),
        F.explode(candidates).alias("c"),
    ).select(row_id, label, "same", "c.*")
    largest = max(total, presets.TAIL_QUOTA, hard, presets.ESCALATION_QUOTA, presets.AUTO_QUOTA)
    drawn = top_n_per_group(
        exploded, ["batch_order", "stratum"], [F.col("draw"), F.col(row_id)], largest
    )
    quotas = proportional_quotas(corpus, label, total).select(
        F.col(label).alias("stratum"), F.col("n").alias("size"), F.col("quota").alias("own_quota")
    )
    proportional = F.col("batch_order") == 1
    chosen = drawn.join(quotas, "stratum", "left").where(
        F.col("rank") <= F.when(proportional, F.col("own_quota")).otherwise(F.col("quota"))
    )
    # a few rows per batch and class are left, so one task may number them
    size_order = F.when(proportional, F.col("size"))
    order = Window.orderBy(
        "batch_order", F.desc_nulls_last(size_order), "place", "stratum", "draw", row_id
    )
    return chosen.select(
        row_id, label, "batch", F.row_number().over(order).alias("seq"), "same"
    )


def text_key(text: Column, prefix: int | None = None) -> Column:
    """Equal for equal texts, or, with ``prefix``, for texts that begin alike."""
    return F.md5(text) if prefix is None else T.truncate(text, prefix)


def drop_near_duplicates(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the first row by ``order`` of every ``key``; a task forwards one row per key."""
    return best_per_group(rows, [key], [F.col(order)])


def build(
    corpus: DataFrame,
    policy: Policy,
    row_id: str = "tweet_id",
    text: str = "customer_text",
    reply: str = "reply_text",
    label: str = "intent_seed",
    cap: int | None = None,
    **batches,
) -> DataFrame:
    """The evaluation set: drawn batches without copies, the first ``cap`` rows if it is given.

    ``policy`` maps a class to its (decision, reason). Ids number the drawn rows before
    copies are dropped, so they have gaps. ``dedup_prefix`` is handed to :func:`draw_batches`.
    """
    usable = corpus.where(T.is_mostly_ascii(F.col(text), presets.ASCII_SHARE_SAMPLING))
    drawn = draw_batches(usable, row_id, text, label, **batches)
    picked = drop_near_duplicates(drawn, "same", "seq").select(row_id, "seq", "batch")
    if cap is not None:
        # at most ``cap`` rows, so they can be sent to the full texts instead of the reverse
        picked = F.broadcast(picked.orderBy("seq").limit(cap))
    rows = usable.select(row_id, text, reply, label).join(picked, row_id)
    own = F.col(label)
    decision = (
        F.when(F.col("batch") == "D_escalation_positive", F.lit(presets.ESCALATE))
        .when(F.col("batch") == "E_auto_handle", F.lit(presets.AUTO))
        .otherwise(_lookup(policy, own, 0, presets.AUTO))
    )
    reason = F.when(
        F.startswith(F.col("batch"), F.lit("C_")), F.lit(presets.AMBIGUOUS_REASON)
    ).otherwise(_lookup(policy, own, 1, ""))
    return rows.select(
        F.format_string("MSG_%04d", "seq").alias("message_id"),
        F.col(text).alias("input_text"),
        own.alias("gold_intent"),
        decision.alias("gold_decision"),
        reason.alias("gold_decision_reason"),
        T.truncate(F.col(reply), presets.NOTE_CHARS).alias("reference_resolution_note"),
        F.col("batch").alias("sampling_batch"),
        F.lit(presets.NEEDS_REVIEW).alias("labelled_by"),
    )


def relabel(
    golden: DataFrame,
    overrides: DataFrame | None = None,
    rules: Sequence[presets.Rule] = presets.RELABEL_RULES,
    default: tuple[str, str, str] = presets.DEFAULT_OUTCOME,
) -> DataFrame:
    """Replace the gold columns by the rules' outcome, or by an override for the same id.

    ``overrides`` has ``(message_id, label, decision, note)`` with unique ids. The note of a
    changed row says what its class was before.
    """
    cleaned = golden.withColumn(
        "_clean", T.clean_keep_punctuation(F.coalesce("input_text", F.lit("")))
    )
    ruled = evaluate_once(
        cleaned, _rule=R.apply_rules(F.col("input_text"), F.col("_clean"), rules, default)
    )
    if overrides is None:
        final = ruled.withColumn("_final", F.col("_rule"))
    else:
        fixed = overrides.select("message_id", F.struct("label", "decision", "note").alias("_o"))
        final = ruled.join(fixed, "message_id", "left").withColumn(
            "_final", F.coalesce("_o", "_rule")
        )
    old, new = F.col("gold_intent"), F.col("_final.label")
    kept = [
        c for c in golden.columns
        if c not in (
            "gold_intent", "gold_decision", "gold_decision_reason", "labelled_by",
            "correction_note",
        )
    ]
    return final.select(
        *kept,
        new.alias("gold_intent"),
        F.col("_final.decision").alias("gold_decision"),
        F.col("_final.note").alias("gold_decision_reason"),
        F.lit(presets.REVIEWED_BY).alias("labelled_by"),
        F.when(old.eqNullSafe(new), F.lit(""))
        .otherwise(F.concat(F.lit("changed from "), F.coalesce(old, F.lit(""))))
        .alias("correction_note"),
    )


def relabel_audit(relabelled: DataFrame) -> DataFrame:
    """One row: rows, corrections, out-of-scope rows, decisions of either kind."""
    return relabelled.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("correction_note") != "").alias("corrections"),
        F.count_if(F.col("gold_intent") == presets.OUT_OF_SCOPE).alias("out_of_scope"),
        F.count_if(F.col("gold_decision") == presets.AUTO).alias("auto"),
        F.count_if(F.col("gold_decision") == presets.ESCALATE).alias("escalate"),
    )
