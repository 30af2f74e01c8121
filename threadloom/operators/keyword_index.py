"""Keyword scores from a keyword table of any size.

:mod:`threadloom.functions.keywords` searches every text for every word, which is right for some
hundred words that are part of the program. Here words are rows. Each word is indexed by one of its
grams, the one that fewest words share, and a text looks up its own grams. What is found is compared
with the text around the gram, so the cost follows the text and the words found, not the number of
words. Words without white space lie between two white spaces, so they are looked for once in every
different piece of the texts, and texts meet what was found there by their pieces; only words with
white space are looked for in whole texts. Small tables are broadcast by the optimiser, others meet
by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions.keywords import Classes
from threadloom.functions.text import WORD
from threadloom.sources.tables import stage

GRAM = 4
# texts are cut into stretches of so many characters, as a place in a string is reached from its start
STRETCH = 64
_EDGE = "\x00"
_GAPS = "[ \t\n\r]"


def keyword_table(spark: SparkSession, classes: Classes) -> DataFrame:
    """``(turn, class, word)`` of a keyword table that is part of the program, in its order."""
    rows = [(turn, label, w) for turn, (label, words) in enumerate(classes.items()) for w in words]
    return spark.createDataFrame(rows, "turn int, class string, word string")


def gram_index(keywords: DataFrame, gram: int = GRAM) -> DataFrame:
    """``(gram, at, word)``: each different word with its rarest gram among all words and the place
    of the gram in it. A word shorter than ``gram`` is its own gram."""
    words = keywords.select("word").where("word != ''").distinct()
    places = F.sequence(F.lit(1), F.greatest(F.char_length("word") - gram + 1, F.lit(1)))
    each = words.select("word", F.explode(places).alias("at")).withColumn("gram", F.substr("word", F.col("at"), F.lit(gram)))
    shared = each.groupBy("gram").agg(F.count_distinct("word").alias("n"))
    first = Window.partitionBy("word").orderBy("n", "gram", "at")
    return (
        each.join(shared, "gram").withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
        .select("gram", "at", "word")
    )


def _grams(df: DataFrame, row_id: str, text: Column, lengths: list[int], radius: int) -> DataFrame:
    """``(row_id, gram, around)`` of every place of a text; ``around`` has ``radius`` characters
    before the gram and after its beginning."""
    edge = F.repeat(F.lit(_EDGE), F.lit(radius))
    whole = df.select(F.col(row_id).alias("row_id"), F.concat(edge, text, edge).alias("_text"), F.char_length(text).alias("_n"))
    cut = whole.where("_n > 0").select("row_id", "_text", "_n", F.explode(F.sequence(F.lit(1), F.col("_n"), F.lit(STRETCH))).alias("_from"))
    stretch = cut.select(
        "row_id", F.substr("_text", F.col("_from"), F.lit(STRETCH + 2 * radius)).alias("_text"),
        F.least(F.lit(STRETCH), F.col("_n") - F.col("_from") + 1).alias("_n"),
    )
    places = stretch.select("row_id", "_text", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_at"))
    around = places.select("row_id", F.substr("_text", F.col("_at"), F.lit(2 * radius)).alias("around"))
    grams = F.array(*[F.substring("around", radius + 1, n) for n in lengths])
    return around.select("row_id", "around", F.explode(grams).alias("gram"))


def _searched(
    df: DataFrame, row_id: str, text: Column, keywords: DataFrame, boundary: bool, gram: int
) -> DataFrame:
    """``(row_id, word)``, once per row: whole texts are looked through, place by place."""
    index = stage(gram_index(keywords, gram), "gram-index")
    # the lengths of grams, at most ``gram`` of them, and the longest word
    lengths = sorted(r[0] for r in index.select(F.char_length("gram")).distinct().collect())
    longest = index.agg(F.coalesce(F.max(F.char_length("word")), F.lit(0))).first()[0]
    radius = longest + 1
    met = _grams(df, row_id, text, lengths or [gram], radius).join(index, "gram")
    start = F.lit(radius + 2) - F.col("at")
    here = F.substr("around", start, F.char_length("word")) == F.col("word")
    if boundary:
        before = F.substr("around", start - 1, F.lit(1))
        after = F.substr("around", start + F.char_length("word"), F.lit(1))
        here = here & ~before.rlike(WORD) & ~after.rlike(WORD)
    return met.where(here).select("row_id", "word").distinct()


def found_words(
    df: DataFrame, row_id: str, text: Column, keywords: DataFrame, boundary: bool = False, gram: int = GRAM
) -> DataFrame:
    """``(row_id, word)``: the words of the table that occur in each row's text, once per row.

    With ``boundary`` a word counts only between characters that are not word characters.
    """
    gaps = F.col("word").rlike(_GAPS)
    pieces = df.select(
        F.col(row_id).alias("row_id"), F.explode(F.array_distinct(F.split(text, _GAPS + "+"))).alias("piece")
    ).where("piece != ''")
    known = _searched(
        pieces.select("piece").distinct(), "piece", F.col("piece"), keywords.where(~gaps), boundary, gram
    ).groupBy(F.col("row_id").alias("piece")).agg(F.collect_list("word").alias("words"))
    found = pieces.join(stage(known, "pieces"), "piece").select("row_id", F.explode("words").alias("word")).distinct()
    spaced = keywords.where(gaps)
    if spaced.isEmpty():
        return found
    return found.unionByName(_searched(df, row_id, text, spaced, boundary, gram))


def scores(
    df: DataFrame, row_id: str, text: Column, keywords: DataFrame, boundary: bool = False, gram: int = GRAM
) -> DataFrame:
    """``(row_id, turn, class, score)``: how many words of a class occur, where any do. A word that a
    class lists twice counts twice."""
    listed = keywords.groupBy("turn", "class", "word").agg(F.count(F.lit(1)).alias("times"))
    found = found_words(df, row_id, text, keywords, boundary, gram)
    return found.join(listed, "word").groupBy("row_id", "turn", "class").agg(F.sum("times").alias("score"))


def best_classes(
    df: DataFrame, row_id: str, text: Column, keywords: DataFrame, fallback: str = presets.UNCLASSIFIED,
    boundary: bool = False, gram: int = GRAM,
) -> DataFrame:
    """``(row_id, label, score)`` for every row: the class of the best score, the one declared first
    among equals, ``fallback`` and 0 where no word occurs."""
    found = scores(df, row_id, text, keywords, boundary, gram).groupBy("row_id").agg(
        F.max(F.struct("score", (-F.col("turn")).alias("_turn"), "class")).alias("_best")
    )
    best = found.select(F.col("row_id").alias("_key"), "_best")
    return df.select(F.col(row_id).alias("row_id")).join(best, F.col("row_id") == F.col("_key"), "left").select(
        "row_id", F.coalesce("_best.class", F.lit(fallback)).alias("label"), F.coalesce("_best.score", F.lit(0)).alias("score")
    )
