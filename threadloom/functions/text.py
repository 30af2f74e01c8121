"""Cleaning, length, language and token functions.

Character classes are spelled out so that Java's regular expressions mean the same as
Unicode-aware ones: a word character is any letter, number or underscore of any script, and white
space includes the no-break and ideographic spaces.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
SPACE = f"[{SPACE_CHARS}]"
NON_SPACE = f"[^{SPACE_CHARS}]"

URL = f"http{NON_SPACE}+"
MENTION = f"@{WORD}+"
HASHTAG = f"#{WORD}+"
# any of the three; the look at its first character spares most places the alternatives
TAGS = f"(?=[h@#])(?:{URL}|{MENTION}|{HASHTAG})"
# a run of anything outside [a-z0-9]: characters listed one by one are looked up in a table, ranges
# are compared; nothing follows the run, so it need not give back
GAPS = f"[^{ascii_lowercase}{digits}]++"


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def parse_bool(c: Column, accept_01: bool = False) -> Column:
    """``true``/``false`` in any case and padding (also ``1``/``0`` on request); else NULL."""
    word = F.lower(strip(c))
    yes, no = (["true", "1"], ["false", "0"]) if accept_01 else (["true"], ["false"])
    return F.when(word.isin(yes), F.lit(True)).when(word.isin(no), F.lit(False))


def clean(c: Column, single_pass: bool = False) -> Column:
    """Lower-case text without URLs, mentions, hashtags and punctuation; NULL becomes ``''``.

    ``single_pass`` removes the three kinds of token by one alternation instead of one after the
    other; the two differ only where removing one token creates another.
    """
    out = F.lower(F.coalesce(c, F.lit("")))
    for pattern in [TAGS] if single_pass else [URL, MENTION, HASHTAG]:
        out = F.regexp_replace(out, pattern, "")
    # one run of anything outside [a-z0-9] is one space, so no separate collapsing pass is needed
    return F.trim(F.regexp_replace(out, GAPS, " "))


def clean_keep_punctuation(c: Column) -> Column:
    """Drop mentions, URLs and hashtags, then lower-case and strip; punctuation stays."""
    return strip(F.lower(F.regexp_replace(c, f"{MENTION}|{URL}|{HASHTAG}", "")))


def ascii_share(c: Column) -> Column:
    """Share of code points below 128; 0 for empty or missing text."""
    kept = F.length(F.regexp_replace(c, r"[^\x00-\x7F]", ""))
    return F.coalesce(F.try_divide(kept.cast("double"), F.length(c).cast("double")), F.lit(0.0))


def is_mostly_ascii(c: Column, threshold: float) -> Column:
    return ascii_share(c) > F.lit(float(threshold))


def char_count(c: Column) -> Column:
    """Length in code points, 0 for NULL."""
    return F.coalesce(F.length(c), F.lit(0))


def longer_than(c: Column, chars: int) -> Column:
    return char_count(c) > F.lit(chars)


def length_between(c: Column, low: int, high: int) -> Column:
    return F.length(c).between(low, high)


def truncate(c: Column, chars: int) -> Column:
    return F.substring(c, 1, chars)


def split_words(c: Column) -> Column:
    """White-space tokens without empty ones."""
    return F.filter(F.split(c, f"{SPACE}+"), lambda t: t != "")


def tokens(cleaned: Column, stop_words: Sequence[str] = (), min_chars: int = 2) -> Column:
    """Terms of cleaned text, in order, stop words removed."""
    stop = list(stop_words)

    def keep(t: Column) -> Column:
        long_enough = F.length(t) >= min_chars
        return long_enough & ~t.isin(stop) if stop else long_enough

    return F.filter(F.split(cleaned, " "), keep)


def with_bigrams(terms: Column) -> Column:
    """The terms followed by every pair of neighbours joined by a space."""
    following = F.slice(terms, 2, F.greatest(F.size(terms) - 1, F.lit(0)))
    pairs = F.zip_with(terms, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(terms, F.filter(pairs, lambda p: p.isNotNull()))


def content_words(c: Column, stop_words: Sequence[str]) -> Column:
    """Distinct lower-case words outside the stop list; ``[]`` for NULL."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), GAPS, " "), " ")
    return F.array_except(words, F.array(*[F.lit(w) for w in ["", *stop_words]]))


def quoted_list(c: Column) -> Column:
    """An array of words written as ``['a', 'b']``."""
    return F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']"))


def fill(template: str, **values: Column) -> Column:
    """A format string with ``{name}`` places filled by columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        starts = {n: rest.find("{" + n + "}") for n in values}
        found = {n: p for n, p in starts.items() if p >= 0}
        if not found:
            parts.append(F.lit(rest))
            break
        name = min(found, key=found.get)
        if found[name]:
            parts.append(F.lit(rest[: found[name]]))
        parts.append(values[name].cast("string"))
        rest = rest[found[name] + len(name) + 2:]
    return F.concat(*parts)
