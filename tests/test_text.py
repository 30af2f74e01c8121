import pytest
from pyspark.sql import functions as F

from threadloom.functions import keywords as K
from threadloom.functions import text as T
from threadloom.operators import classes as C


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(*columns).first()


X = F.col("x")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("@José Hi!! see http://t.co/x #late  don't", "hi see don t"),
        ("see http://t.co/a next word", "see next word"),
        ("a　b\tc\nd", "a b c d"),
        (None, ""),
        ("", ""),
        ("ÀB1", "b1"),
    ],
)
def test_clean(spark, raw, expected):
    assert one(spark, raw, T.clean(X))[0] == expected


def test_clean_modes_differ_only_on_nested_tokens(spark):
    row = one(spark, "#http://x.y z", T.clean(X), T.clean(X, single_pass=True))
    assert tuple(row) == ("z", "x y z")


def test_clean_keep_punctuation(spark):
    assert one(spark, " @Bob It's LOST! http://a #x\n", T.clean_keep_punctuation(X))[0] == "it's lost!"


@pytest.mark.parametrize(
    "raw, strict, loose",
    [(" True ", True, True), ("FALSE", False, False), ("1", None, True), ("0", None, False),
     ("yes", None, None), (None, None, None)],
)
def test_parse_bool(spark, raw, strict, loose):
    row = one(spark, raw, T.parse_bool(X), T.parse_bool(X, accept_01=True))
    assert tuple(row) == (strict, loose)


@pytest.mark.parametrize(
    "raw, at_60, at_65",
    [("aaaaaaéééé", False, False), ("a" * 13 + "é" * 7, True, False), ("", False, False),
     (None, False, False), ("abc", True, True)],
)
def test_ascii_share(spark, raw, at_60, at_65):
    row = one(spark, raw, T.is_mostly_ascii(X, 0.6), T.is_mostly_ascii(X, 0.65))
    assert tuple(row) == (at_60, at_65)


@pytest.mark.parametrize("size, longer, band", [(20, False, True), (21, True, True),
                                                (80, True, True), (81, True, False)])
def test_lengths(spark, size, longer, band):
    row = one(spark, "ü" * size, T.longer_than(X, 20), T.length_between(X, 20, 80))
    assert tuple(row) == (longer, band)


def test_length_of_null(spark):
    assert one(spark, None, T.longer_than(X, 0))[0] is False


def test_score_counts_each_listed_word_once_as_substring(spark):
    row = one(spark, "it happened, app app", K.score(X, ["app", "ups"]),
              K.score(X, ["app", "happened"], boundary=True))
    assert tuple(row) == (1, 2)


def test_score_of_nested_and_repeated_words(spark):
    words = ["ship", "shipping", "shipping fee", "fee", "fee", "coffee", "late"]
    texts = ["ship", "shipping", "shipping fee", "coffee", "fe", "late ship coffee", "", "shippin"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(K.score(X, words)).collect()]
    assert got == [sum(w in t for w in words) for t in texts]


def test_score_of_no_words(spark):
    assert one(spark, "x", K.score(X, []))[0] == 0


def test_apostrophe_never_survives_cleaning(spark):
    assert one(spark, "i don't want it", K.score(T.clean(X), ["don't want"]))[0] == 0


@pytest.mark.parametrize(
    "raw, label, score", [("a b", "A", 1), ("b b2", "B", 2), ("zzz", "none", 0), ("", "none", 0)]
)
def test_best_class(spark, raw, label, score):
    row = one(spark, raw, K.best_class(X, {"A": ["a", "a9"], "B": ["b", "b2"]}, "none").alias("m"))
    assert (row.m.label, row.m.score) == (label, score)


@pytest.mark.parametrize("score, expected", [(0, 0.1), (1, 0.2), (3, 0.6), (5, 1.0), (7, 1.0)])
def test_confidence(spark, score, expected):
    assert spark.range(1).select(K.confidence(F.lit(score))).first()[0] == expected


def test_any_word_without_redundant_words_is_the_same(spark):
    words = ["lock", "locked out", "blocked", "fee"]
    texts = ["blocked", "fe", "a lock", "locked out", "coffee", ""]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(K.any_word(X, words)).collect()]
    assert got == [any(w in t for w in words) for t in texts]


def test_bigrams_follow_stop_word_removal(spark):
    row = one(spark, "lost the red parcel", T.with_bigrams(T.tokens(X, ["the"])))
    assert row[0] == ["lost", "red", "parcel", "lost red", "red parcel"]


@pytest.mark.parametrize("raw, expected", [("one", ["one"]), ("a", []), ("", [])])
def test_bigrams_of_short_texts(spark, raw, expected):
    assert one(spark, raw, T.with_bigrams(T.tokens(X)))[0] == expected


def test_fill(spark):
    row = one(spark, "v", T.fill("a {p} b {q}", p=X, q=F.lit(2)), T.fill("{p}{p}", p=X))
    assert tuple(row) == ("a v b 2", "vv")


def test_classify_with_many_keywords(spark):
    classes = {
        "A": [f"w{i} " for i in range(70)] + ["w1"], "B": ["x", "xy", "x"],
        "C": [f"v{i}" for i in range(90)], "D": [],
    }
    texts = ["w1 w2 w69 end", "xy", "v1 v22 v89", "x v1", "", None, "W5 V6 V7", "zzz"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [(r.x, r.intent, r.best_score) for r in
           C.classify(df, X, classes).collect()]
    for text, label, score in got:
        cleaned = (text or "").lower()
        points = {c: sum(w in cleaned for w in words) for c, words in classes.items()}
        best = max(points, key=points.get)
        assert (label, score) == (best if points[best] else "UNCLASSIFIED", points[best])


def test_steps_keep_every_keyword():
    classes = {"A": list("abcde"), "B": [], "C": list("fg")}
    steps = K.in_steps(classes, 3)
    assert [sum(len(w) for _, w in s) for s in steps] == [3, 3, 1]
    assert [x for s in steps for _, w in s for x in w] == list("abcdefg")


def test_cleaning_is_that_of_the_plain_patterns(spark):
    texts = [
        "", "...", "a", "Hh http https://x.y/z?q=#t @me#you ##a @@b #_1 @", "hhttp://a b", "É#É@É é", "#a@b#c http@x#y z",
        "  A--B\u00a0C\n\t1 2\u3000", "h@#", "x" * 50 + "@y" + "!" * 50, None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.lower(F.coalesce("t", F.lit("")))
    once = F.regexp_replace(plain, f"{T.URL}|{T.MENTION}|{T.HASHTAG}", "")
    each = plain
    for pattern in (T.URL, T.MENTION, T.HASHTAG):
        each = F.regexp_replace(each, pattern, "")
    trimmed = [F.trim(F.regexp_replace(c, "[^a-z0-9]+", " ")) for c in (once, each)]
    got = rows.select(T.clean(F.col("t"), True).alias("a"), T.clean(F.col("t")).alias("b"), *trimmed).collect()
    assert [(r[0], r[1]) for r in got] == [(r[2], r[3]) for r in got]
