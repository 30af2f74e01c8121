import pytest
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import replies as P
from threadloom.operators import golden as G
from threadloom.plans import triage as TR


def relabel(spark, *texts):
    rows = [(f"M{i}", t, "X") for i, t in enumerate(texts)]
    golden = spark.createDataFrame(rows, "message_id string, input_text string, gold_intent string")
    return {r.input_text: r for r in G.relabel(golden).collect()}


@pytest.mark.parametrize(
    "text, label, decision",
    [
        ("thanks!", "OOS", "escalate"),
        ("  Thank you .. ", "OOS", "escalate"),
        ("no", "OOS", "escalate"),
        ("no way", "ORDER_DELIVERY_STATUS", "auto"),
        ("где мой заказ", "OOS", "escalate"),
        ("", "OOS", "escalate"),
        ("my account is locked", "ACCOUNT_ACCESS", "escalate"),
        ("my prime is locked", "ORDER_DELIVERY_STATUS", "auto"),
        ("my prime account is locked", "ACCOUNT_ACCESS", "escalate"),
        ("was charged after a free month of prime", "PRIME_SUBSCRIPTION", "auto"),
        ("was charged twice", "CHARGE_PAYMENT_BILLING", "escalate"),
        ("charged, want to return", "RETURN_REFUND_REPLACEMENT", "auto"),
        ("cancel prime now", "PRIME_SUBSCRIPTION", "auto"),
        ("cancel my order", "ORDER_CANCELLATION", "auto"),
        ("got a fake", "PRODUCT_COMPLAINT", "auto"),
        ("the app is slow", "DEVICE_APP_TECHNICAL", "auto"),
        ("bad seller", "PRODUCT_COMPLAINT", "auto"),
        ("is it late", "ORDER_DELIVERY_STATUS", "auto"),
        ("can i pay", "CHARGE_PAYMENT_BILLING", "escalate"),
        ("hello there", "ORDER_DELIVERY_STATUS", "auto"),
    ],
)
def test_rules(spark, text, label, decision):
    row = relabel(spark, text)[text]
    assert (row.gold_intent, row.gold_decision) == (label, decision)


def test_override_and_audit(spark):
    golden = spark.createDataFrame(
        [("a", "is it late", "ORDER_DELIVERY_STATUS"), ("b", "is it late", "OOS"),
         ("c", "is it late", "ORDER_DELIVERY_STATUS")],
        "message_id string, input_text string, gold_intent string",
    )
    overrides = spark.createDataFrame(
        [("c", "OOS", "escalate", "by hand")],
        "message_id string, label string, decision string, note string",
    )
    out = G.relabel(golden, overrides)
    rows = {r.message_id: r for r in out.collect()}
    assert rows["a"].correction_note == ""
    assert rows["b"].correction_note == "changed from OOS"
    assert (rows["c"].gold_intent, rows["c"].gold_decision_reason) == ("OOS", "by hand")
    audit = G.relabel_audit(out).first()
    assert (audit["rows"], audit.corrections, audit.out_of_scope) == (3, 2, 1)


TAXONOMY = [("ACCOUNT_ACCESS", "escalate", "check identity"), ("CHARGE", "escalate", "look"),
            ("ORDER", "auto", "track")]


def decide(spark, label, text, reasoning=""):
    rows = spark.createDataFrame([(label, text, reasoning)],
                                 "pred_intent string, input_text string, why string")
    taxonomy = spark.createDataFrame(
        TAXONOMY, "id string, escalation_default string, escalation_note string"
    )
    return TR.decide(rows, taxonomy, reasoning="why").first()


@pytest.mark.parametrize(
    "label, text, reasoning, decision, level",
    [
        ("ACCOUNT_ACCESS", "hello", "", "escalate", 1),
        ("ORDER", "this is #fraud", "", "escalate", 2),
        ("ORDER", "what a FRAUD!", "", "escalate", 2),
        ("ORDER", "a fraudster", "", "auto", 4),
        ("ORDER", "hello", "No need to escalate", "escalate", 3),
        ("ORDER", "hello", "A Human Agent", "escalate", 3),
        ("ORDER", "hello", "", "auto", 4),
        ("CHARGE", "hello", "", "escalate", 4),
        ("OTHER", "hello", "", "auto", 4),
        ("ORDER", None, None, "auto", 4),
    ],
)
def test_escalation_levels(spark, label, text, reasoning, decision, level):
    row = decide(spark, label, text, reasoning)
    assert (row.pred_decision, row.decision_level) == (decision, level)


def test_escalation_reasons(spark):
    assert decide(spark, "ORDER", "scam and fraud").pred_reason == (
        "Customer message contains high-risk keyword(s): ['fraud', 'scam']. "
        "Routing to human agent."
    )
    assert decide(spark, "OTHER", "x").pred_reason == "Default policy for OTHER."
    assert decide(spark, "ACCOUNT_ACCESS", "x").pred_reason.endswith("(check identity)")
    long = decide(spark, "ORDER", "x", "cannot resolve " + "y" * 300).pred_reason
    assert long.endswith("y" * 185) and len(long.split("LLM note: ")[1]) == 200


def test_simple_policy_matches_inside_words(spark):
    rows = spark.createDataFrame([("ORDER", "a fraudster")], "pred_intent string, input_text string")
    taxonomy = spark.createDataFrame(
        TAXONOMY, "id string, escalation_default string, escalation_note string"
    )
    row = TR.decide_simple(rows, taxonomy).first()
    assert tuple(row)[2:] == ("escalate", "High-risk keyword(s) detected: ['fraud']")


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('x {"intent":"A",\n"confidence":0.9} y', ("A", 0.9, "")),
        ('{"intent":"Z", "reasoning":"r"}', ("D", 0.5, "r")),
        ('{"confidence":"high"}', ("D", 0.5, "")),
        ("nonsense", ("D", 0.3, "nonsense")),
        ('{"intent":"A"} {"intent":"A"}', ("D", 0.3, '{"intent":"A"} {"intent":"A"}')),
        ('{"intent":"A"},{"intent":"A"}', ("D", 0.3, '{"intent":"A"},{"intent":"A"}')),
        ('{"intent":"D","confidence":0.1,"intent":"A","confidence":0.7}', ("A", 0.7, "")),
        ('{"intent":"A","intent":"Z","other":{"intent":"A"}}', ("D", 0.5, "")),
        ('{"intent":"A","confidence":NaN,"reasoning":"r"}', ("A", 0.5, "r")),
        ('{"intent":"A","intent":"A"} {"intent":"A"}', ("D", 0.3, '{"intent":"A","intent":"A"} {"intent":"A"}')),
        ('{"intent":"A","intent":"A"},{"intent":"A"}', ("D", 0.3, '{"intent":"A","intent":"A"},{"intent":"A"}')),
        ('{"intent":"A","intent":"A"', ("D", 0.3, '{"intent":"A","intent":"A"')),
        ("{'intent':'A'}", ("D", 0.3, "{'intent':'A'}")),
        ("n" * 300, ("D", 0.3, "n" * 200)),
        (None, ("D", 0.3, "")),
    ],
)
def test_classifier_reply(spark, raw, expected):
    rows = spark.createDataFrame([(raw,)], "raw string")
    row = TR.read_classifier_replies(rows, "raw", ["A", "D"], "D").first()
    assert (row.pred_intent, row.confidence, row.reasoning) == expected


def test_judge_reply_goes_to_scores_or_errors(spark):
    good = 'ok: {"groundedness":3,"accuracy":2,"helpfulness":1,"tone":0,"total":6,"overall_comment":"c"}'
    rows = spark.createDataFrame([("a", good), ("b", "no"), ("c", '{"tone":1}')], "id string, raw string")
    readable, bad = TR.read_judge_replies(rows, "raw")
    scores = {r.id: r for r in readable.collect()}
    assert (scores["a"].groundedness, scores["a"].total, scores["a"].overall_comment) == (3, 6, "c")
    assert scores["c"].tone == 1 and scores["c"].total is None
    assert [r.id for r in bad.collect()] == ["b"]


def test_json_part(spark):
    df = spark.createDataFrame([("a {b\n} c}",), ("plain",)], "x string")
    assert [r[0] for r in df.select(P.json_part(F.col("x"))).collect()] == ["{b\n} c}", "plain"]


def test_rule_lists_cover_all_classes():
    labels = {r.label for r in presets.RELABEL_RULES}
    assert len(labels) == 8
