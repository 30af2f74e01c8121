import pytest
from pyspark.sql import functions as F

from threadloom.operators import agreement as A
from threadloom.operators import evaluation as E
from threadloom.operators import grounding as G
from threadloom.operators import validation as V
from threadloom.operators.classes import predict_majority


def pairs(spark, cells):
    rows = [(g, p) for (g, p), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "gold_intent string, pred_intent string")


def test_majority_baseline_of_the_published_counts(spark):
    sizes = [98, 31, 20, 15, 12, 9, 5, 3]
    cells = {(f"c{i}", "none"): n for i, n in enumerate(sizes)}
    rows = predict_majority(pairs(spark, cells).drop("pred_intent"), "gold_intent")
    row = E.summary(E.cells(rows)).first()
    assert row.n == 193
    assert row.accuracy == pytest.approx(0.50777, abs=5e-6)
    assert row.macro_f1 == pytest.approx(0.08419, abs=5e-6)
    assert row.weighted_f1 == pytest.approx(0.34200, abs=5e-6)


def decisions(spark, tp, fp, fn, tn, other=0):
    rows = [("escalate", "escalate")] * tp + [("auto", "escalate")] * fp
    rows += [("escalate", "auto")] * fn + [("auto", "auto")] * tn + [("odd", "auto")] * other
    return spark.createDataFrame(rows, "gold_decision string, pred_decision string")


@pytest.mark.parametrize(
    "counts, precision, recall, f1",
    [((33, 14, 12, 134), 0.70213, 0.73333, 0.71739), ((8, 4, 7, 24), 0.66667, 0.53333, 0.59259),
     ((0, 0, 45, 148), 0.0, 0.0, 0.0)],
)
def test_escalation(spark, counts, precision, recall, f1):
    row = E.escalation_report(decisions(spark, *counts, other=3)).first()
    assert (row.tp, row.fp, row.fn, row.tn) == counts
    assert (row.precision, row.recall, row.f1) == pytest.approx((precision, recall, f1), abs=5e-6)
    assert (row.false_auto, row.false_escalate) == (counts[2], counts[1])


def test_class_report_counts_labels_of_either_side(spark):
    cells = {("a", "a"): 3, ("a", "b"): 1, ("b", "b"): 2, ("c", "x"): 1}
    frame = E.cells(pairs(spark, cells))
    report = {r.label: r for r in E.class_report(frame).collect()}
    assert set(report) == {"a", "b", "c", "x"}
    assert report["a"].recall == 0.75 and report["a"].precision == 1.0
    assert (report["x"].support, report["x"].f1, report["c"].f1) == (0, 0.0, 0.0)
    row = E.summary(frame).first()
    assert row.macro_f1 == pytest.approx((6 / 7 + 0.8 + 0 + 0) / 4)
    assert [r.label for r in E.worst_classes(E.class_report(frame)).collect()] == ["c", "x", "b"]
    seen = {(r.gold, r.pred): r.n for r in E.confusion(frame).collect()}
    assert seen == cells
    grid = {(r.gold, r.pred): r.n for r in E.confusion(frame, ["a", "b", "x"]).collect()}
    assert len(grid) == 10 and grid["a", "b"] == 1 and grid["x", "a"] == 0 and grid["c", "x"] == 1
    wide = {r.gold: r for r in E.confusion_matrix(frame, ["a", "b"]).collect()}
    assert (wide["a"].a, wide["a"].b, wide["a"].other, wide["c"].other) == (3, 1, 0, 1)


def test_summary_of_nothing(spark):
    row = E.summary(E.cells(pairs(spark, {("a", "a"): 1}).limit(0))).first()
    assert tuple(row) == (0.0, 0.0, 0.0, 0)


def test_unscored_labels(spark):
    frame = pairs(spark, {("UNCLASSIFIED", "a"): 2, ("OOS", "a"): 1, ("a", "OOS"): 1})
    assert E.scored_rows(frame).count() == 1


@pytest.mark.parametrize("labelled, kept", [(9, 20), (10, 10), (0, 20)])
def test_labelled_or_all(spark, labelled, kept):
    by = F.when(F.col("id") < labelled, "me").when(F.col("id") % 2 == 0, "NEEDS_HUMAN_REVIEW")
    rows = spark.range(20).select("id", by.alias("labelled_by"))
    assert E.labelled_or_all(rows, E.was_reviewed(F.col("labelled_by")), 10).count() == kept
    assert E.labelled_or_all(rows, F.lit(False), 0).count() == 0


def test_failures(spark):
    rows = decisions(spark, 1, 7, 2, 1).withColumn("message_id", F.monotonically_increasing_id())
    assert E.failures(rows, "escalate", "auto").count() == 2
    assert E.failures(rows, "auto", "escalate", n=5).count() == 5


@pytest.mark.parametrize(
    "draft, references, expected",
    [("Please track the parcel", "track parcel now", 1.0), ("Track IT twice", "track", 0.5),
     ("the and", "x", None), ("", "x", None), ("x", "", None), (None, "x", None), ("x", None, None)],
)
def test_groundedness(spark, draft, references, expected):
    rows = spark.createDataFrame([(draft, references)], "d string, r string")
    scored = [r.groundedness for r in G.groundedness(rows, F.col("d"), F.col("r")).collect()]
    assert scored == ([] if expected is None else [expected])


def test_mean_groundedness_of_nothing(spark):
    rows = spark.createDataFrame([], "groundedness double")
    assert tuple(G.mean_groundedness(rows).first()) == (0.0, 0)


CELLS = {
    "groundedness": {(3, 3): 16, (2, 2): 1, (2, 3): 2, (3, 2): 1},
    "accuracy": {(3, 3): 17, (2, 3): 1, (3, 2): 1, (3, 1): 1},
    "helpfulness": {(2, 2): 7, (3, 3): 3, (2, 3): 3, (3, 2): 7},
    "tone": {(3, 3): 19, (3, 2): 1},
}
KAPPAS = {
    "groundedness": (0.318182, 0.85, "fair"), "accuracy": (-0.052632, 0.85, "slight"),
    "helpfulness": (0.0, 0.5, "slight"), "tone": (0.0, 0.95, "slight"),
    "overall": (0.341865, 0.7875, "fair"),
}


def scores(spark, cells, kind="int"):
    rows = [(d, a, b) for d, c in cells.items() for (a, b), n in c.items() for _ in range(n)]
    return spark.createDataFrame(
        rows, f"dimension string, judge_score {kind}, human_score {kind}"
    )


def test_published_kappas(spark):
    got = {r.dimension: r for r in A.kappa(scores(spark, CELLS), overall=True).collect()}
    for name, (kappa, raw, band) in KAPPAS.items():
        assert got[name].kappa == pytest.approx(kappa, abs=5e-7)
        assert got[name].raw_agreement == pytest.approx(raw)
        assert got[name].band == band
    assert (got["tone"].n, got["overall"].n) == (20, 80)
    means = {r.dimension: r for r in A.rater_means(scores(spark, CELLS)).collect()}
    assert (means["accuracy"].judge_mean, means["accuracy"].human_mean) == (2.95, 2.85)


def test_binned_kappa_is_unweighted(spark):
    cells = {"total": {("high", "high"): 19, ("high", "medium"): 1}}
    row = A.kappa(scores(spark, cells, "string"), weighted=False).first()
    assert (row.kappa, row.raw_agreement) == (0.0, 0.95)


def test_kappa_weights_by_position_not_by_value(spark):
    row = A.kappa(scores(spark, {"d": {(1, 1): 1, (1, 3): 1, (3, 3): 1}})).first()
    assert row.kappa == pytest.approx(0.4)


def test_kappa_is_undefined_for_one_label(spark):
    for weighted in (True, False):
        row = A.kappa(scores(spark, {"d": {(3, 3): 2}}), weighted=weighted).first()
        assert row.kappa is None and row.band is None and row.raw_agreement == 1.0


@pytest.mark.parametrize(
    "value, band",
    [(0.2, "slight"), (0.21, "fair"), (0.4, "fair"), (0.41, "moderate"), (0.6, "moderate"),
     (0.61, "substantial"), (0.8, "substantial"), (0.81, "almost perfect"), (-1.0, "slight")],
)
def test_bands(spark, value, band):
    assert spark.range(1).select(A.kappa_band(F.lit(value))).first()[0] == band


@pytest.mark.parametrize("total, name", [(0, "low"), (4, "low"), (5, "medium"), (8, "medium"),
                                         (9, "high")])
def test_bins(spark, total, name):
    assert spark.range(1).select(A.total_bin(F.lit(total))).first()[0] == name


def judged(spark):
    rows = [("a", 3, 3, 3, 3, 12), ("b", 1, 2, 3, 0, 6), ("c", 0, 0, 0, 0, None), ("z", 1, 1, 1, 1, 4)]
    return spark.createDataFrame(
        rows, "message_id string, groundedness int, accuracy int, helpfulness int, tone int, total int"
    )


def humans(spark, *rows):
    return spark.createDataFrame(
        list(rows), "message_id string, groundedness string, accuracy string, helpfulness string, "
        "tone string, total string",
    )


def test_long_scores_and_disagreements(spark):
    human = humans(spark, ("a", " 3 ", "2", "1", "3", "9"), ("b", "1", "2", "3", "2", "8"))
    long = A.long_scores(judged(spark), human)
    assert long.count() == 8
    results = spark.createDataFrame([("a", "m" * 99, "d" * 99)],
                                    "message_id string, input_text string, draft_reply string")
    got = {(r.message_id, r.dimension): r for r in A.disagreements(long, results).collect()}
    assert set(got) == {("a", "helpfulness"), ("b", "tone")}
    assert (got["a", "helpfulness"].diff, got["b", "tone"].diff) == (2, -2)
    assert len(got["a", "helpfulness"].customer_msg) == 80 and got["b", "tone"].draft_reply == ""


def test_judge_means_skip_rows_without_total(spark):
    row = A.judge_means(judged(spark)).first()
    assert (row.n, row.mean_total, row.mean_tone) == (3, pytest.approx(22 / 3), pytest.approx(4 / 3))


def test_validation(spark):
    human = humans(
        spark, ("a", "3", "0", "1", "2", "6"), ("b", "", "x", "4", "2.0", "13"),
        ("u", "1", "1", "1", "1", "-1"), ("z", None, " 1", "+2", "9" * 30, "12"),
    )
    got = {(r.message_id, r.field, r.error) for r in V.score_errors(human, judged(spark)).collect()}
    assert got == {
        ("b", "groundedness", "empty"), ("b", "accuracy", "not_integer"),
        ("b", "helpfulness", "out_of_range"), ("b", "tone", "not_integer"),
        ("b", "total", "out_of_range"), ("u", "total", "out_of_range"),
        ("u", "message_id", "unknown_id"), ("z", "groundedness", "empty"),
        ("z", "tone", "out_of_range"),
    }


def test_blind_sheet(spark):
    results = spark.createDataFrame(
        [("a", "text", "I", "D", "auto", "why", [("r1",), ("r2",)])],
        "message_id string, input_text string, pred_intent string, draft_reply string, "
        "pred_decision string, pred_reason string, retrieved_hits array<struct<reply_text string>>",
    )
    rows = {r.message_id: r for r in A.blind_sheet(judged(spark), results, n=2).collect()}
    assert set(rows) == {"a", "b"} and {r.place for r in rows.values()} == {1, 2}
    assert rows["a"].retrieved_references == "r1\n---\nr2"
    assert rows["b"].customer_message == "" and rows["a"].tone == ""
