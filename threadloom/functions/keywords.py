"""Keyword scoring: how many listed words occur, and which class scores best."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions.text import WORD

Classes = Mapping[str, Sequence[str]]


def _occurs(text: Column, word: str, boundary: bool) -> Column:
    inside = F.contains(text, F.lit(word))
    if not boundary:
        return inside
    # the plain search is cheap and spares most rows the regular expression
    return inside & text.rlike(f"(?<!{WORD}){re.escape(word)}(?!{WORD})")


def score(text: Column, words: Sequence[str], boundary: bool = False) -> Column:
    """Number of listed words found in the text; every word counts at most once per listing.

    A word that contains another listed one is searched only where the shorter one occurs.
    """
    if boundary:
        return reduce(add, [_occurs(text, w, True).cast("int") for w in words], F.lit(0))
    longer: dict[str, list[str]] = {w: [] for w in words if w not in _redundant(words)}
    equal = {w: 0 for w in longer}
    for word in words:
        if word in longer:
            equal[word] += 1
        else:
            longer[next(w for w in longer if w in word)].append(word)
    terms = []
    for word, dependent in longer.items():
        found = reduce(
            add, [_occurs(text, w, False).cast("int") for w in dependent], F.lit(equal[word])
        )
        terms.append(F.when(_occurs(text, word, False), found).otherwise(F.lit(0)))
    return reduce(add, terms, F.lit(0))


def _redundant(words: Sequence[str]) -> set[str]:
    """Words that contain another word of the list."""
    return {w for w in words if any(v != w and v in w for v in words)}


def any_word(text: Column, words: Sequence[str], boundary: bool = False) -> Column:
    """True if a listed word occurs. As substrings, words that contain another one add nothing."""
    if not boundary:
        words = [w for w in dict.fromkeys(words) if w not in _redundant(words)]
    return reduce(or_, [_occurs(text, w, boundary) for w in words], F.lit(False))


def found_words(text: Column, words: Sequence[str], boundary: bool = False) -> Column:
    """The listed words that occur, in list order."""
    marks = [F.when(_occurs(text, w, boundary), F.lit(w)) for w in words]
    return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")


def score_columns(text: Column, classes: Classes, boundary: bool = False) -> list[Column]:
    """One ``score_<class>`` column per class."""
    return [score(text, words, boundary).alias(f"score_{c}") for c, words in classes.items()]


def pick_class(scores: Mapping[str, Column], fallback: str = presets.UNCLASSIFIED) -> Column:
    """``struct(score, label)`` of the best score; ties go to the class declared first.

    If no score is above 0, the label is ``fallback``.
    """
    ranked = [(F.lit(0), 1, fallback)]
    ranked += [(points, -turn, label) for turn, (label, points) in enumerate(scores.items())]
    return F.array_max(
        F.array(
            *[
                F.struct(
                    points.alias("score"), F.lit(turn).alias("turn"), F.lit(label).alias("label")
                )
                for points, turn, label in ranked
            ]
        )
    )


def best_class(
    text: Column, classes: Classes, fallback: str = presets.UNCLASSIFIED, boundary: bool = False
) -> Column:
    """:func:`pick_class` of the keyword scores, as one expression."""
    scores = {label: score(text, words, boundary) for label, words in classes.items()}
    return pick_class(scores, fallback)


def in_steps(classes: Classes, searches: int) -> list[list[tuple[str, list[str]]]]:
    """The keyword table cut into steps of at most ``searches`` words."""
    steps, free = [[]], searches
    for label, words in classes.items():
        rest = list(words)
        while rest:
            if not free:
                steps.append([])
                free = searches
            part, rest = rest[:free], rest[free:]
            steps[-1].append((label, part))
            free -= len(part)
    return steps


def confidence(points: Column) -> Column:
    """Score scaled to 0..1 with two decimals; a text without keywords gets the floor value."""
    scaled = F.least(points / F.lit(float(presets.CONFIDENCE_SATURATION)), F.lit(1.0))
    return F.when(points > 0, F.bround(scaled, 2)).otherwise(F.lit(presets.FALLBACK_CONFIDENCE))
