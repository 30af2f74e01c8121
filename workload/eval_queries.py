"""Classification, escalation, grounding and rater agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators import agreement as A
from threadloom.operators import evaluation as E
from threadloom.operators import grounding as G
from threadloom.operators import threads as H
from threadloom.operators import validation as V
from threadloom.operators.binding import evaluate_once
from threadloom.operators.classes import classify, predict_majority
from threadloom.operators.ranking import top_n_per_group
from threadloom.operators.sampling import shuffle_order
from threadloom.plans import reports as RP
from threadloom.plans import triage as TR
from threadloom.sources import tables as IO
from workload import common as W
from workload import policy_queries as PQ

# --- two classifiers over the documents ------------------------------------------------------


def _rows(spark, sf):
    """Gold class by the long word table, prediction by the short one; decisions likewise."""
    once = evaluate_once(W.documents(spark, sf), cleaned=T.clean(F.col("text")))
    gold = classify(
        once, F.col("text"), W.CLASSES, label="gold_intent", cleaned=F.col("cleaned")
    )
    both = classify(
        gold, F.col("text"), W.CLASSES_SHORT, "ORDER_DELIVERY_STATUS", "pred_intent", "_points",
        cleaned=F.col("cleaned"),
    )
    labels = W.table(spark, sf, "labels")
    decided = both.join(labels, "doc_id", "left").withColumn(
        "gold_decision",
        F.when(F.col("quality") == 0, F.lit("escalate"))
        .when(F.col("quality") == 1, F.lit("auto"))
        .otherwise(F.lit("unknown")),
    )
    return decided.select(
        F.col("doc_id").alias("message_id"), F.col("text").alias("input_text"), "gold_intent",
        "pred_intent", "gold_decision",
        F.when(T.longer_than(F.col("text"), 1500), F.lit("escalate")).otherwise(F.lit("auto"))
        .alias("pred_decision"),
        "quality", "lang",
    )


_SQL_ROWS = f"""
src AS (SELECT *, {W.sql_clean('text')} AS cleaned FROM documents),
golds AS (SELECT doc_id, text, lang, cleaned, intent AS gold_intent
  FROM ({W.sql_classified('src', 'cleaned')})),
preds AS ({W.sql_classified('golds', 'cleaned', W.CLASSES_SHORT, 'ORDER_DELIVERY_STATUS')}),
rows AS (
  SELECT doc_id AS message_id, text AS input_text, lang, gold_intent, intent AS pred_intent,
    CASE quality WHEN 0 THEN 'escalate' WHEN 1 THEN 'auto' ELSE 'unknown' END AS gold_decision,
    CASE WHEN length(text) > 1500 THEN 'escalate' ELSE 'auto' END AS pred_decision, quality
  FROM preds LEFT JOIN labels USING (doc_id)),
scored AS (SELECT * FROM rows WHERE gold_intent NOT IN ('UNCLASSIFIED', 'OOS'))
"""


def _sql_report(source: str) -> str:
    return f"""
labels_seen AS (SELECT gold_intent AS label FROM {source} UNION SELECT pred_intent FROM {source}),
counts AS (
  SELECT label,
    (SELECT count(*) FROM {source} WHERE gold_intent = label) AS support,
    (SELECT count(*) FROM {source} WHERE pred_intent = label) AS predicted,
    (SELECT count(*) FROM {source} WHERE gold_intent = label AND pred_intent = label) AS correct
  FROM labels_seen),
report AS (
  SELECT label, coalesce(correct / nullif(predicted, 0), 0) AS precision,
    coalesce(correct / nullif(support, 0), 0) AS recall,
    coalesce(2 * correct / nullif(support + predicted, 0), 0) AS f1, support, correct
  FROM counts)
"""


def _stored_rows(spark, sf):
    """The classified rows without texts, written once for reports that read them repeatedly."""
    return IO.stage(_rows(spark, sf).drop("input_text"), "results")


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def confusion(spark, sf):
    return E.confusion(E.cells(E.scored_rows(_stored_rows(spark, sf))), list(W.CLASSES_SHORT))


CONFUSION = f"""
WITH {_SQL_ROWS},
listed AS (SELECT unnest({W.sql_list(W.CLASSES_SHORT)}) AS label),
zeros AS (SELECT g.label AS gold, p.label AS pred, 0 AS n FROM listed g CROSS JOIN listed p),
seen AS (SELECT gold_intent AS gold, pred_intent AS pred, count(*) AS n FROM scored GROUP BY ALL)
SELECT gold, pred, sum(n)::BIGINT AS n FROM (SELECT * FROM zeros UNION ALL SELECT * FROM seen) GROUP BY ALL
"""


def confusion_matrix(spark, sf):
    names = list(W.CLASSES_SHORT)
    return E.confusion_matrix(E.cells(E.scored_rows(_stored_rows(spark, sf))), names)


CONFUSION_MATRIX = f"""
WITH {_SQL_ROWS},
labels_seen AS (SELECT gold_intent AS label FROM scored UNION SELECT unnest({W.sql_list(W.CLASSES_SHORT)}))
SELECT label AS gold, {', '.join(
    f"count(*) FILTER (WHERE pred_intent = '{c}') AS {c}" for c in W.CLASSES_SHORT)},
  count(*) FILTER (WHERE message_id IS NOT NULL
    AND NOT coalesce(list_contains({W.sql_list(W.CLASSES_SHORT)}, pred_intent), false)) AS other
FROM labels_seen LEFT JOIN scored ON gold_intent = label GROUP BY label
"""


def class_report(spark, sf):
    report = E.class_report(E.cells(E.scored_rows(_rows(spark, sf)))).drop("correct")
    return _rounded(report, "precision", "recall", "f1")


CLASS_REPORT = f"""
WITH {_SQL_ROWS}, {_sql_report('scored')}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  support FROM report
"""


def eval_summary(spark, sf):
    row = E.summary(E.cells(E.scored_rows(_rows(spark, sf))))
    return _rounded(row, "accuracy", "macro_f1", "weighted_f1")


EVAL_SUMMARY = f"""
WITH {_SQL_ROWS}, {_sql_report('scored')}
SELECT round(sum(correct) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1, sum(support)::BIGINT AS n FROM report
"""


def worst_classes(spark, sf):
    report = E.class_report(E.cells(E.scored_rows(_rows(spark, sf))))
    return _rounded(E.worst_classes(report).select("label", "f1"), "f1")


WORST_CLASSES = f"""
WITH {_SQL_ROWS}, {_sql_report('scored')}
SELECT label, round(f1, 6) AS f1 FROM report ORDER BY report.f1, label LIMIT 3
"""


def escalation_report(spark, sf):
    return _rounded(E.escalation_report(_rows(spark, sf)), "precision", "recall", "f1")


_SQL_ESCALATION = """
counted AS (
  SELECT count(*) FILTER (WHERE gold_decision = 'escalate' AND pred_decision = 'escalate') AS tp,
    count(*) FILTER (WHERE gold_decision = 'auto' AND pred_decision = 'escalate') AS fp,
    count(*) FILTER (WHERE gold_decision = 'escalate' AND pred_decision = 'auto') AS fn,
    count(*) FILTER (WHERE gold_decision = 'auto' AND pred_decision = 'auto') AS tn
  FROM {source})
"""
ESCALATION_REPORT = f"""
WITH {_SQL_ROWS}, {_SQL_ESCALATION.format(source='rows')}
SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
  fn AS false_auto, fp AS false_escalate FROM counted
"""


def failure_slices(spark, sf):
    rows = _rows(spark, sf)
    missed = E.failures(rows, "escalate", "auto")
    needless = E.failures(rows, "auto", "escalate", n=5)
    return missed.unionByName(needless).select(
        "message_id", "gold_decision", "pred_decision", "gold_intent", "pred_intent",
        T.truncate(F.col("input_text"), 200).alias("shown"),
    )


FAILURE_SLICES = f"""
WITH {_SQL_ROWS},
wrong AS (
  SELECT * FROM rows WHERE gold_decision = 'escalate' AND pred_decision = 'auto'
  UNION ALL (SELECT * FROM rows WHERE gold_decision = 'auto' AND pred_decision = 'escalate'
    ORDER BY message_id LIMIT 5))
SELECT message_id, gold_decision, pred_decision, gold_intent, pred_intent, input_text[1:200] AS shown
FROM wrong
"""


def baseline_metrics(spark, sf):
    rows = _stored_rows(spark, sf)
    majority = predict_majority(rows.drop("pred_intent", "pred_decision"), "gold_intent")
    out = RP.baseline_report({"majority": majority, "keywords": rows})
    return _rounded(
        out, "intent_accuracy", "intent_macro_f1", "intent_weighted_f1", "esc_precision",
        "esc_recall",
    )


def _sql_baseline(name: str, source: str) -> str:
    return f"""(WITH {_sql_report(source)}, {_SQL_ESCALATION.format(source=source)}
SELECT '{name}' AS name, round(sum(correct) / sum(support), 6) AS intent_accuracy,
  round(avg(f1), 6) AS intent_macro_f1,
  round(sum(f1 * support) / sum(support), 6) AS intent_weighted_f1,
  round(coalesce(max(tp) / nullif(max(tp + fp), 0), 0), 6) AS esc_precision,
  round(coalesce(max(tp) / nullif(max(tp + fn), 0), 0), 6) AS esc_recall,
  max(fn) AS false_auto, max(fp) AS false_escalate, sum(support)::BIGINT AS n
FROM report CROSS JOIN counted)"""


BASELINE_METRICS = f"""
WITH {_SQL_ROWS},
constant AS (
  SELECT * REPLACE ('auto' AS pred_decision, (SELECT gold_intent FROM rows GROUP BY 1
    ORDER BY count(*) DESC, 1 LIMIT 1) AS pred_intent) FROM scored)
SELECT * FROM {_sql_baseline('majority', 'constant')}
UNION ALL SELECT * FROM {_sql_baseline('keywords', 'scored')}
"""


def labelled_or_all(spark, sf):
    rows = _stored_rows(spark, sf)
    many = E.labelled_or_all(rows, F.col("quality").isNotNull(), presets.MIN_LABELLED)
    few = E.labelled_or_all(rows, F.col("quality").isNotNull(), minimum=10**9)
    counted = F.count(F.lit(1)).alias("n")
    return many.agg(F.lit("labelled").alias("case"), counted).unionByName(
        few.agg(F.lit("all").alias("case"), counted)
    )


LABELLED_OR_ALL = """
SELECT 'labelled' AS case, count(*) AS n FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels) OR (SELECT count(*) FROM labels) < 10
UNION ALL SELECT 'all', count(*) FROM documents
"""


def label_union(spark, sf):
    rows = _rows(spark, sf)
    return rows.select(F.col("gold_intent").alias("label")).union(
        rows.select("pred_intent")
    ).distinct()


LABEL_UNION = f"""
WITH {_SQL_ROWS} SELECT gold_intent AS label FROM rows UNION SELECT pred_intent FROM rows
"""


def id_sets(spark, sf):
    """Documents that carry a label, and documents that do not."""
    docs = W.table(spark, sf, "documents").select("doc_id")
    rated = W.table(spark, sf, "labels").select("doc_id")
    both = docs.intersect(rated).withColumn("side", F.lit("both"))
    return both.unionByName(docs.subtract(rated).withColumn("side", F.lit("unlabelled")))


ID_SETS = """
SELECT doc_id, 'both' AS side FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'unlabelled'
FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
"""


def stratified_subset(spark, sf):
    rows = E.scored_rows(_rows(spark, sf)).select("message_id", "gold_intent", "pred_intent")
    return top_n_per_group(rows, ["gold_intent"], [F.col("message_id")], 5, "class_rank")


STRATIFIED_SUBSET = f"""
WITH {_SQL_ROWS}
SELECT message_id, gold_intent, pred_intent, class_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY gold_intent ORDER BY message_id)::INTEGER AS class_rank
  FROM scored) WHERE class_rank <= 5
"""

# --- grounding -------------------------------------------------------------------------------


def groundedness(spark, sf):
    pairs = H.pair_all(W.messages(spark, sf))
    scored = G.groundedness(pairs, F.col("reply_text"), F.col("text"), W.STOP_WORDS)
    return scored.select("tweet_id", "reply_id", F.round("groundedness", 6).alias("groundedness"))


def _sql_words(expr: str, stop=W.STOP_WORDS) -> str:
    words = f"regexp_split_to_array(regexp_replace(lower({expr}), '[^a-z0-9]+', ' ', 'g'), ' ')"
    listed = W.sql_list(["", *stop])
    return f"list_filter(list_distinct({words}), lambda w: NOT list_contains({listed}, w))"


GROUNDEDNESS = f"""
WITH {W.SQL_RAW_MESSAGES},
worded AS (
  SELECT m.tweet_id, r.tweet_id AS reply_id, {_sql_words('r.text')} AS d, {_sql_words('m.text')} AS k
  FROM messages m JOIN messages r ON r.in_response_to_tweet_id = m.tweet_id AND NOT r.inbound
  WHERE m.inbound AND length(r.text) > 0 AND length(m.text) > 0)
SELECT tweet_id, reply_id, round(length(list_intersect(d, k)) / length(d), 6) AS groundedness
FROM worded WHERE length(d) > 0
"""


def mean_groundedness(spark, sf):
    results = TR.draft_from_hits(*PQ.questions_and_corpus(spark, sf), 3)
    scored = G.groundedness(
        results, F.col("input_text"), G.joined_replies(F.col("retrieved_hits"))
    )
    return _rounded(G.mean_groundedness(scored), "mean_groundedness")


MEAN_GROUNDEDNESS = f"""
WITH {PQ.SQL_AGENT},
refs AS (SELECT query_id, string_agg('Answer: ' || text, ' ' ORDER BY rank) AS refs
  FROM hits JOIN documents ON doc_id = idx GROUP BY 1),
worded AS (
  SELECT {_sql_words('text', presets.GROUNDING_STOP_WORDS)} AS d,
    {_sql_words('refs', presets.GROUNDING_STOP_WORDS)} AS k
  FROM agent JOIN refs ON query_id = doc_id WHERE length(text) > 0)
SELECT round(avg(length(list_intersect(d, k)) / length(d)), 6) AS mean_groundedness,
  count(*) AS n_scored
FROM worded WHERE length(d) > 0
"""


def evaluation_report(spark, sf):
    gold = _rows(spark, sf).select("message_id", "gold_intent", "gold_decision")
    results = PQ.agent_results(spark, sf).join(gold, "message_id")
    return _rounded(RP.evaluation_report(IO.stage(results, "results")), "value")


EVALUATION_REPORT = f"""
WITH {PQ.SQL_AGENT.replace('src AS', 'src_a AS').replace('FROM src)', 'FROM src_a)')},
{_SQL_ROWS},
results AS (
  SELECT a.doc_id, g.gold_intent, g.gold_decision, a.pred_intent, a.pred_decision, a.draft_reply
  FROM agent a JOIN rows g ON g.message_id = a.doc_id),
usable AS (SELECT * FROM results WHERE gold_intent NOT IN ('UNCLASSIFIED', 'OOS')),
{_sql_report('usable')}, {_SQL_ESCALATION.format(source='results')},
refs AS (SELECT query_id, string_agg('Answer: ' || text, ' ' ORDER BY rank) AS refs
  FROM hits JOIN documents ON doc_id = idx GROUP BY 1),
worded AS (
  SELECT {_sql_words('draft_reply', presets.GROUNDING_STOP_WORDS)} AS d,
    {_sql_words('refs', presets.GROUNDING_STOP_WORDS)} AS k
  FROM results JOIN refs ON query_id = doc_id),
grounded AS (SELECT avg(length(list_intersect(d, k)) / length(d)) AS m, count(*) AS n
  FROM worded WHERE length(d) > 0),
whole AS (SELECT sum(correct) / sum(support) AS accuracy, avg(f1) AS macro_f1,
  sum(f1 * support) / sum(support) AS weighted_f1, sum(support) AS n FROM report),
out AS (
  SELECT 'intent' AS section, unnest(['accuracy', 'macro_f1', 'weighted_f1', 'n']) AS metric,
    unnest([accuracy, macro_f1, weighted_f1, n::DOUBLE]) AS value FROM whole
  UNION ALL SELECT 'class_f1', label, f1 FROM report
  UNION ALL SELECT 'escalation', unnest(['tp', 'fp', 'fn', 'tn', 'precision', 'recall', 'f1',
      'false_auto', 'false_escalate']),
    unnest([tp, fp, fn, tn, coalesce(tp / nullif(tp + fp, 0), 0),
      coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0),
      fn, fp]::DOUBLE[]) FROM counted
  UNION ALL SELECT 'groundedness', unnest(['mean_groundedness', 'n_scored']),
    unnest([m, n]::DOUBLE[]) FROM grounded)
SELECT section, metric, round(value, 6) AS value FROM out
"""

# --- raters ----------------------------------------------------------------------------------


def _judge(spark, sf):
    """Scores made from the documents: a judge who looks at length, quality and language."""
    docs = W.table(spark, sf, "documents").join(W.table(spark, sf, "labels"), "doc_id", "left")
    n = F.col("n_chars")
    rows = docs.select(
        F.col("doc_id").cast("string").alias("message_id"),
        (n % 4).cast("int").alias("groundedness"),
        F.coalesce(F.col("quality") * 3 - F.col("toxic"), F.lit(2)).alias("accuracy"),
        F.when(F.col("lang") == "en", F.lit(3)).otherwise(F.lit(1)).alias("helpfulness"),
        F.lit(3).alias("tone"),
        F.col("toxic"),
    ).withColumn("accuracy", F.greatest("accuracy", F.lit(0)))
    total = F.col("groundedness") + F.col("accuracy") + F.col("helpfulness") + F.col("tone")
    return rows.withColumn("total", F.when(F.coalesce("toxic", F.lit(0)) == 0, total)).drop("toxic")


def _human(spark, sf):
    """A second rater who looks at other digits, as text; some documents are not rated."""
    docs = W.table(spark, sf, "documents").where(F.col("source") != "src7")
    n = F.col("n_chars")
    short = n < 800
    rows = docs.select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.when(short, n % 4).otherwise((n + 1) % 4).alias("groundedness"),
        F.when(n % 5 == 0, F.lit(1)).otherwise(F.lit(2)).alias("accuracy"),
        F.when(F.col("lang") == "fr", F.lit(1)).otherwise(F.lit(3)).alias("helpfulness"),
        F.lit(3).alias("tone"),
    )
    total = F.col("groundedness") + F.col("accuracy") + F.col("helpfulness") + F.col("tone")
    return rows.withColumn("total", total).select(
        "message_id",
        *[
            F.concat(F.lit(" "), F.col(c).cast("string")).alias(c)
            for c in (*presets.SCORE_DIMENSIONS, "total")
        ],
    )


_SQL_RATERS = """
judge AS (
  SELECT *, CASE WHEN coalesce(toxic, 0) = 0
    THEN groundedness + accuracy + helpfulness + tone END AS total
  FROM (SELECT doc_id::VARCHAR AS message_id, (n_chars % 4)::INTEGER AS groundedness,
      greatest(coalesce(quality * 3 - toxic, 2), 0) AS accuracy,
      CASE WHEN lang = 'en' THEN 3 ELSE 1 END AS helpfulness, 3 AS tone, toxic
    FROM documents LEFT JOIN labels USING (doc_id))),
human AS (
  SELECT *, groundedness + accuracy + helpfulness + tone AS total
  FROM (SELECT doc_id::VARCHAR AS message_id,
      CASE WHEN n_chars < 800 THEN n_chars % 4 ELSE (n_chars + 1) % 4 END AS groundedness,
      CASE WHEN n_chars % 5 = 0 THEN 1 ELSE 2 END AS accuracy,
      CASE WHEN lang = 'fr' THEN 1 ELSE 3 END AS helpfulness, 3 AS tone
    FROM documents WHERE source <> 'src7')),
long AS (
  SELECT message_id, d.dimension,
    CASE d.dimension WHEN 'groundedness' THEN j.groundedness WHEN 'accuracy' THEN j.accuracy
      WHEN 'helpfulness' THEN j.helpfulness ELSE j.tone END::INTEGER AS a,
    CASE d.dimension WHEN 'groundedness' THEN h.groundedness WHEN 'accuracy' THEN h.accuracy
      WHEN 'helpfulness' THEN h.helpfulness ELSE h.tone END::INTEGER AS b
  FROM judge j JOIN human h USING (message_id)
  CROSS JOIN (VALUES ('groundedness'), ('accuracy'), ('helpfulness'), ('tone')) d(dimension))
"""


def _sql_kappa(source: str, weight: str) -> str:
    """Kappa by its definition: every pair of labels, observed and expected by chance."""
    return f"""
labels_of AS (
  SELECT dimension, label, row_number() OVER (PARTITION BY dimension ORDER BY label) AS pos
  FROM (SELECT dimension, a AS label FROM {source} UNION SELECT dimension, b FROM {source})),
totals AS (SELECT dimension, count(*) AS n, avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) AS raw
  FROM {source} GROUP BY 1),
grid AS (
  SELECT x.dimension, x.label AS la, y.label AS lb, {weight} AS w
  FROM labels_of x JOIN labels_of y ON x.dimension = y.dimension),
sums AS (
  SELECT g.dimension,
    sum(w * (SELECT count(*) FROM {source} s
      WHERE s.dimension = g.dimension AND a = la AND b = lb)) AS observed,
    sum(w * (SELECT count(*) FROM {source} s WHERE s.dimension = g.dimension AND a = la)
      * (SELECT count(*) FROM {source} s WHERE s.dimension = g.dimension AND b = lb)) AS expected
  FROM grid g GROUP BY 1),
kappas AS (
  SELECT dimension, n, round(1 - observed / nullif(expected / n, 0), 6)::DOUBLE AS kappa,
    round(raw, 6)::DOUBLE AS raw_agreement
  FROM sums JOIN totals USING (dimension))
SELECT *, CASE WHEN kappa > 0.8 THEN 'almost perfect' WHEN kappa > 0.6 THEN 'substantial'
    WHEN kappa > 0.4 THEN 'moderate' WHEN kappa > 0.2 THEN 'fair'
    WHEN kappa IS NOT NULL THEN 'slight' END AS band
FROM kappas
"""


def kappa_by_dimension(spark, sf):
    scores = A.long_scores(_judge(spark, sf), _human(spark, sf))
    return _rounded(A.kappa(scores, overall=True), "kappa", "raw_agreement")


KAPPA_BY_DIMENSION = f"""
WITH {_SQL_RATERS},
pooled AS (SELECT dimension, a, b FROM long UNION ALL SELECT 'overall', a, b FROM long),
{_sql_kappa('pooled', 'abs(x.pos - y.pos)')}
"""


def kappa_binned(spark, sf):
    out = A.binned_kappa(A.valid_judgements(_judge(spark, sf)), _human(spark, sf))
    return _rounded(out, "kappa", "raw_agreement")


KAPPA_BINNED = f"""
WITH {_SQL_RATERS},
binned AS (
  SELECT 'total' AS dimension,
    CASE WHEN j.total <= 4 THEN 'low' WHEN j.total <= 8 THEN 'medium' ELSE 'high' END AS a,
    CASE WHEN h.total <= 4 THEN 'low' WHEN h.total <= 8 THEN 'medium' ELSE 'high' END AS b
  FROM judge j JOIN human h USING (message_id) WHERE j.total IS NOT NULL),
{_sql_kappa('binned', 'CASE WHEN x.pos = y.pos THEN 0 ELSE 1 END')}
"""


def agreement_report(spark, sf):
    report = RP.agreement_report(
        IO.stage(_judge(spark, sf), "judge"), IO.stage(_human(spark, sf), "human")
    )
    return _rounded(report, "kappa", "raw_agreement", "judge_mean", "human_mean")


# every part of the report covers the judgements with a total
_VALID_KAPPA = KAPPA_BY_DIMENSION.replace(
    "FROM judge j JOIN", "FROM (SELECT * FROM judge WHERE total IS NOT NULL) j JOIN"
)
AGREEMENT_REPORT = f"""
WITH {_SQL_RATERS}
SELECT k.*, m.judge_mean, m.human_mean FROM ({_VALID_KAPPA}) k
LEFT JOIN (SELECT dimension, round(avg(a), 6) AS judge_mean, round(avg(b), 6) AS human_mean
  FROM long JOIN judge USING (message_id) WHERE total IS NOT NULL GROUP BY dimension) m USING (dimension)
UNION ALL SELECT *, NULL, NULL FROM ({KAPPA_BINNED})
"""


def to_judge(spark, sf):
    results = W.table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"),
        F.when(F.col("role") != "system", F.col("text")).otherwise(F.lit("")).alias("draft_reply"),
    )
    judged = W.table(spark, sf, "conversations").where(F.col("role") == "user").select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id")
    )
    return A.to_judge(results, judged)


TO_JUDGE = """
SELECT message_id, draft_reply FROM (
  SELECT conv_id || '-' || turn AS message_id, text AS draft_reply, role FROM conversations
  WHERE role <> 'system' ORDER BY message_id LIMIT 50) WHERE role <> 'user'
"""


def judge_means(spark, sf):
    row = A.judge_means(_judge(spark, sf))
    return _rounded(row, *[c for c in row.columns if c != "n"])


JUDGE_MEANS = f"""
WITH {_SQL_RATERS}
SELECT count(*) AS n, round(avg(total), 6) AS mean_total,
  round(avg(groundedness), 6) AS mean_groundedness, round(avg(accuracy), 6) AS mean_accuracy,
  round(avg(helpfulness), 6) AS mean_helpfulness, round(avg(tone), 6) AS mean_tone
FROM judge WHERE coalesce(total, -1) >= 0
"""


def rater_means(spark, sf):
    means = A.rater_means(A.long_scores(_judge(spark, sf), _human(spark, sf)))
    return _rounded(means, "judge_mean", "human_mean")


RATER_MEANS = f"""
WITH {_SQL_RATERS}
SELECT dimension, round(avg(a), 6) AS judge_mean, round(avg(b), 6) AS human_mean
FROM long GROUP BY dimension
"""


def disagreements(spark, sf):
    results = W.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("message_id"), F.col("text").alias("input_text"),
        F.col("source").alias("draft_reply"),
    )
    scores = A.long_scores(_judge(spark, sf), _human(spark, sf))
    return A.disagreements(scores, results)


DISAGREEMENTS = f"""
WITH {_SQL_RATERS}
SELECT message_id, dimension, a AS judge_score, b AS human_score, a - b AS diff,
  text[1:80] AS customer_msg, source[1:80] AS draft_reply
FROM long JOIN documents ON doc_id::VARCHAR = message_id WHERE abs(a - b) > 1
"""


def validate_scores(spark, sf):
    human = W.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.when(F.col("lang") == "fr", F.lit(" ")).otherwise(F.lit(" 2 ")).alias("groundedness"),
        F.when(F.col("source") == "src1", F.lit("x")).otherwise(F.lit("3")).alias("accuracy"),
        F.when(F.col("n_chars") > 9000, F.lit("4")).otherwise(F.lit("0")).alias("helpfulness"),
        F.when(F.col("n_chars") > 9000, F.lit("1.5")).when(
            F.col("source") == "src2", F.lit("-1")).otherwise(F.lit("+1")).alias("tone"),
        F.when(F.col("lang") == "de", F.lit("13")).when(
            F.col("lang") == "es", F.lit("99999999999999999999")).otherwise(F.lit("12"))
        .alias("total"),
    )
    judge = W.table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("message_id")
    )
    return V.score_errors(human, judge)


VALIDATE_SCORES = """
WITH human AS (SELECT doc_id::VARCHAR AS message_id, * FROM documents)
SELECT message_id, 'groundedness' AS field, '' AS value, 'empty' AS error FROM human
  WHERE lang = 'fr'
UNION ALL SELECT message_id, 'accuracy', 'x', 'not_integer' FROM human WHERE source = 'src1'
UNION ALL SELECT message_id, 'helpfulness', '4', 'out_of_range' FROM human WHERE n_chars > 9000
UNION ALL SELECT message_id, 'tone', '1.5', 'not_integer' FROM human WHERE n_chars > 9000
UNION ALL SELECT message_id, 'tone', '-1', 'out_of_range' FROM human
  WHERE n_chars <= 9000 AND source = 'src2'
UNION ALL SELECT message_id, 'total', '13', 'out_of_range' FROM human WHERE lang = 'de'
UNION ALL SELECT message_id, 'total', '99999999999999999999', 'out_of_range' FROM human
  WHERE lang = 'es'
UNION ALL SELECT message_id, 'message_id', message_id, 'unknown_id' FROM human
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)
"""


def blind_order(spark, sf):
    rated = W.table(spark, sf, "benchmark").select("item_id")
    return shuffle_order(rated, "item_id", 42)


BLIND_ORDER = """
SELECT item_id, row_number() OVER (ORDER BY md5('42|' || item_id), item_id) AS place
FROM benchmark
"""

QUERIES = {
    "confusion": (confusion, CONFUSION),
    "confusion_matrix": (confusion_matrix, CONFUSION_MATRIX),
    "class_report": (class_report, CLASS_REPORT),
    "eval_summary": (eval_summary, EVAL_SUMMARY),
    "worst_classes": (worst_classes, WORST_CLASSES),
    "escalation_report": (escalation_report, ESCALATION_REPORT),
    "failure_slices": (failure_slices, FAILURE_SLICES),
    "baseline_metrics": (baseline_metrics, BASELINE_METRICS),
    "labelled_or_all": (labelled_or_all, LABELLED_OR_ALL),
    "label_union": (label_union, LABEL_UNION),
    "id_sets": (id_sets, ID_SETS),
    "stratified_subset": (stratified_subset, STRATIFIED_SUBSET),
    "groundedness": (groundedness, GROUNDEDNESS),
    "mean_groundedness": (mean_groundedness, MEAN_GROUNDEDNESS),
    "evaluation_report": (evaluation_report, EVALUATION_REPORT),
    "kappa_by_dimension": (kappa_by_dimension, KAPPA_BY_DIMENSION),
    "kappa_binned": (kappa_binned, KAPPA_BINNED),
    "agreement_report": (agreement_report, AGREEMENT_REPORT),
    "to_judge": (to_judge, TO_JUDGE),
    "judge_means": (judge_means, JUDGE_MEANS),
    "rater_means": (rater_means, RATER_MEANS),
    "disagreements": (disagreements, DISAGREEMENTS),
    "validate_scores": (validate_scores, VALIDATE_SCORES),
    "blind_order": (blind_order, BLIND_ORDER),
}
