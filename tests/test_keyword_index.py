import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions import keywords as K
from threadloom.operators import keyword_index as X


def texts(rng, n=60):
    letters = "abcdeé- '"
    return ["".join(rng.choices(letters, k=rng.choice([0, 1, 3, 40, 900]))) for _ in range(n)] + [None]


@pytest.mark.parametrize("boundary", [False, True])
@pytest.mark.parametrize("gram", [2, 4])
def test_scores_equal_the_searches(spark, boundary, gram):
    rng = random.Random(gram)
    word = lambda: "".join(rng.choices("abcdeé- '", k=rng.choice([1, 2, 3, 4, 5, 7])))
    classes = {f"c{i}": [word() for _ in range(12)] for i in range(4)}
    classes["c1"] += classes["c0"][:3] + classes["c1"][:2]
    df = spark.createDataFrame(list(enumerate(texts(rng))), "id long, t string").repartition(3)
    table = X.keyword_table(spark, classes)
    got = {(r.row_id, r["class"]): r.score for r in X.scores(df, "id", F.col("t"), table, boundary, gram).collect()}
    rows = df.select("id", *[K.score(F.col("t"), w, boundary).alias(c) for c, w in classes.items()]).collect()
    assert got == {(r.id, c): r[c] for r in rows for c in classes if r[c]}
    best = df.select("id", K.best_class(F.col("t"), classes, "none", boundary).alias("b")).collect()
    want = {(r.id, r.b.label if r.b else "none", r.b.score if r.b else 0) for r in best}
    assert {tuple(r) for r in X.best_classes(df, "id", F.col("t"), table, "none", boundary, gram).collect()} == want


def test_ten_thousand_words(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(4, 9))) for _ in range(10_000)]
    kept = rng.sample(words, 400)
    rows = [(i, " ".join(rng.sample(kept, 20)) + "x" * (i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(4)
    table = spark.createDataFrame([(i % 7, f"c{i % 7}", w) for i, w in enumerate(words)], "turn int, class string, word string")
    got = {(r.row_id, r.word) for r in X.found_words(df, "id", F.col("t"), table).collect()}
    assert got == {(i, w) for i, t in rows for w in set(words) if w in t}


def test_no_words_and_no_texts(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, t string")
    table = X.keyword_table(spark, {"a": ["b"]})
    assert X.scores(df, "id", F.col("t"), table.limit(0)).count() == 0
    assert X.scores(df.limit(0), "id", F.col("t"), table).count() == 0
    assert X.best_classes(df, "id", F.col("t"), table.limit(0), "none").collect() == [(1, "none", 0)]


def test_equal_pieces_are_looked_through_once(spark, monkeypatch):
    """Many texts of few words: places are made for the different words, not for the texts."""
    seen, grams = [], X._grams

    def counted(*args):
        out = grams(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(X, "_grams", counted)
    df = spark.range(300).select("id", F.concat_ws(" ", F.lit("order\tstatus"), F.lit("reorders\nnow"), F.col("id") % 5).alias("t"))
    table = X.keyword_table(spark, {"a": ["order", "tus", "now 3"], "b": ["no", "reorder"]})
    got = {(r.row_id, r.word) for r in X.found_words(df, "id", F.col("t"), table.where("word != 'now 3'")).collect()}
    assert got == {(i, w) for i in range(300) for w in ("order", "tus", "no", "reorder")}
    assert sum(seen) < 100
    got = {r.row_id for r in X.found_words(df, "id", F.col("t"), table).where("word = 'now 3'").collect()}
    assert got == {i for i in range(300) if i % 5 == 3}
