"""Reading model replies: the JSON object inside free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import presets


def json_part(raw: Column) -> Column:
    """From the first ``{`` to the last ``}`` across lines; the whole text if there is none."""
    found = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    return F.when(found == "", raw).otherwise(found)


FIELDS = ("intent", "confidence", "reasoning", *presets.SCORE_DIMENSIONS, "total", "overall_comment")


def parse_object(raw: Column, names: Sequence[str] = FIELDS) -> Column:
    """The JSON object in ``raw`` as a one-element variant list; NULL if it is not exactly one.

    The list brackets make the parser see trailing text, which it would otherwise ignore. Variants
    know neither repeated keys nor NaN; of objects with such only the fields ``names`` are read, the
    last one of a name counts, and NaN is no number.
    """
    part = json_part(F.coalesce(raw, F.lit("")))
    text = F.concat(F.lit("["), part, F.lit("]"))
    listed = F.try_parse_json(text)
    single = F.try_variant_get(listed, "$[1]", "variant").isNull()
    fields = ", ".join(f"{n} string" for n in names)
    loose = F.from_json(text, f"array<struct<{fields}>>", {"allowSingleQuotes": "false"})
    again = F.when(F.size(loose) == 1, F.try_parse_json(F.to_json(loose)))
    found = F.when(listed.isNotNull(), F.when(single, listed)).otherwise(again)
    return F.when(F.startswith(part, F.lit("{")), found)


def field(parsed: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(parsed, f"$[0].{name}", kind)


def classifier_reply(
    raw: Column, parsed: Column, labels: Sequence[str], default: str = presets.DEFAULT_CLASS
) -> Column:
    """``struct(intent, confidence, reasoning)`` from a reply and its :func:`parse_object`.

    An unreadable reply becomes the default class with low confidence and its first 200
    characters as reasoning; a label outside ``labels`` becomes the default class.
    """
    label = F.coalesce(field(parsed, "intent"), F.lit(default))
    readable = F.struct(
        F.when(label.isin(list(labels)), label).otherwise(F.lit(default)).alias("intent"),
        F.coalesce(
            F.try_variant_get(parsed, "$[0].confidence", "double"),
            F.lit(presets.PARSED_CONFIDENCE_DEFAULT),
        ).alias("confidence"),
        F.coalesce(field(parsed, "reasoning"), F.lit("")).alias("reasoning"),
    )
    unreadable = F.struct(
        F.lit(default).alias("intent"),
        F.lit(presets.UNPARSED_CONFIDENCE).alias("confidence"),
        F.substring(json_part(F.coalesce(raw, F.lit(""))), 1, 200).alias("reasoning"),
    )
    return F.when(parsed.isNotNull(), readable).otherwise(unreadable)


def judge_reply(parsed: Column) -> Column:
    """``struct`` of the judge's scores, total and comment; fields that are absent are NULL."""
    numbers = [
        F.try_variant_get(parsed, f"$[0].{n}", "int").alias(n)
        for n in (*presets.SCORE_DIMENSIONS, "total")
    ]
    return F.struct(*numbers, field(parsed, "overall_comment").alias("overall_comment"))
