"""Text functions, thread pairing, keyword classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import keywords as K
from threadloom.functions import text as T
from threadloom.operators import classes as C
from threadloom.operators import threads as H
from workload import common as W


def clean_text(spark, sf):
    text = F.col("text")
    return W.documents(spark, sf).select(
        "doc_id",
        T.clean(text).alias("cleaned"),
        T.clean(text, single_pass=True).alias("cleaned_once"),
        T.clean_keep_punctuation(text).alias("cleaned_lower"),
    )


CLEAN_TEXT = f"""
SELECT doc_id, {W.sql_clean('text')} AS cleaned, {W.sql_clean('text', True)} AS cleaned_once,
  {W.sql_clean_keep('text')} AS cleaned_lower FROM documents
"""


def language_share(spark, sf):
    text = F.col("text")
    return W.documents(spark, sf).select(
        "doc_id",
        F.round(T.ascii_share(text), 6).alias("ascii_share"),
        T.is_mostly_ascii(text, 0.6).alias("passes_60"),
        T.is_mostly_ascii(text, 0.65).alias("passes_65"),
        T.is_mostly_ascii(text, 0.97).alias("passes_97"),
    )


LANGUAGE_SHARE = """
SELECT doc_id, round(share, 6) AS ascii_share, share > 0.6 AS passes_60, share > 0.65 AS passes_65,
  share > 0.97 AS passes_97
FROM (SELECT doc_id, coalesce(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))
        / nullif(length(text), 0), 0.0) AS share FROM documents)
"""


def length_band(spark, sf):
    text = F.col("text")
    return W.table(spark, sf, "conversations").groupBy("role").agg(
        F.count_if(T.longer_than(text, 100)).alias("over_100"),
        F.count_if(T.length_between(text, 20, 80)).alias("short"),
        F.max(T.char_count(text)).alias("longest"),
        F.max(F.length(T.truncate(text, 80))).alias("longest_cut"),
    )


LENGTH_BAND = """
SELECT role, count(*) FILTER (WHERE coalesce(length(text), 0) > 100) AS over_100,
  count(*) FILTER (WHERE length(text) BETWEEN 20 AND 80) AS short,
  max(coalesce(length(text), 0))::INTEGER AS longest,
  max(length(text[1:80]))::INTEGER AS longest_cut
FROM conversations GROUP BY role
"""


def parse_bool(spark, sf):
    padded = F.concat(F.lit("  "), F.col("quality").cast("string"), F.lit("\n"))
    word = F.when(F.col("toxic") == 1, F.lit("\tTRUE ")).otherwise(padded)
    parsed = W.table(spark, sf, "labels").select(
        T.parse_bool(word).alias("strict"), T.parse_bool(word, accept_01=True).alias("loose")
    )
    return parsed.groupBy("strict", "loose").agg(F.count(F.lit(1)).alias("n"))


PARSE_BOOL = """
SELECT strict, loose, count(*) AS n FROM (
  SELECT CASE WHEN toxic = 1 THEN true END AS strict,
    CASE WHEN toxic = 1 THEN true WHEN quality = 1 THEN true WHEN quality = 0 THEN false END AS loose
  FROM labels) GROUP BY ALL
"""


def direction_split(spark, sf):
    m = W.messages(spark, sf)
    sides = H.inbound(m).select("author_id", F.lit("in").alias("side")).unionByName(
        H.outbound(m, F.lit("acct1")).select("author_id", F.lit("out").alias("side"))
    )
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


DIRECTION_SPLIT = f"""
WITH {W.SQL_RAW_MESSAGES}
SELECT CASE WHEN inbound THEN 'in' ELSE 'out' END AS side, count(*) AS n FROM messages
WHERE inbound OR (NOT inbound AND author_id = 'acct1') GROUP BY 1
"""

_PAIR = ["tweet_id", "text", "reply_id", "reply_text", "reply_at"]

_PAIRS_SQL = """
SELECT m.tweet_id, m.text, r.tweet_id AS reply_id, r.text AS reply_text, r.created_at AS reply_at
FROM messages m {join} JOIN (SELECT * FROM messages WHERE NOT inbound) r
  ON r.in_response_to_tweet_id = m.tweet_id WHERE m.inbound
"""


def thread_pairs_all(spark, sf):
    return H.pair_all(W.messages(spark, sf)).select(*_PAIR)


THREAD_PAIRS_ALL = f"WITH {W.SQL_RAW_MESSAGES} {_PAIRS_SQL.format(join='')}"


def thread_pairs_left(spark, sf):
    return H.pair_all(W.messages(spark, sf), keep_unreplied=True).select(*_PAIR)


THREAD_PAIRS_LEFT = f"WITH {W.SQL_RAW_MESSAGES} {_PAIRS_SQL.format(join='LEFT')}"


def thread_pairs_longest(spark, sf):
    return H.pair_longest(W.messages(spark, sf)).select(*_PAIR)


THREAD_PAIRS_LONGEST = f"""
WITH {W.SQL_RAW_MESSAGES},
replies AS (
  SELECT *, row_number() OVER (PARTITION BY in_response_to_tweet_id
    ORDER BY length(text) DESC NULLS LAST, tweet_id) AS place
  FROM messages WHERE NOT inbound AND in_response_to_tweet_id IS NOT NULL)
SELECT m.tweet_id, m.text, r.tweet_id AS reply_id, r.text AS reply_text, r.created_at AS reply_at
FROM messages m JOIN replies r ON r.in_response_to_tweet_id = m.tweet_id AND r.place = 1
WHERE m.inbound AND length(m.text) > 20 AND length(r.text) > 20
"""


def replied_semi(spark, sf):
    return H.replied(W.messages(spark, sf)).select("tweet_id", "author_id", "text")


def unreplied_anti(spark, sf):
    return H.unreplied(W.messages(spark, sf)).select("tweet_id", "author_id", "text")


_REPLIED_SQL = """
SELECT tweet_id, author_id, text FROM messages WHERE inbound AND {word} EXISTS (
  SELECT 1 FROM messages r WHERE NOT r.inbound AND r.in_response_to_tweet_id = messages.tweet_id)
"""
REPLIED_SEMI = f"WITH {W.SQL_RAW_MESSAGES} {_REPLIED_SQL.format(word='')}"
UNREPLIED_ANTI = f"WITH {W.SQL_RAW_MESSAGES} {_REPLIED_SQL.format(word='NOT')}"


def keyword_scores(spark, sf):
    cleaned = W.documents(spark, sf).withColumn("cleaned", T.clean(F.col("text")))
    return cleaned.select("doc_id", *K.score_columns(F.col("cleaned"), W.CLASSES))


KEYWORD_SCORES = (
    "SELECT doc_id, "
    + ", ".join(f"{W.sql_score('cleaned', w)} AS score_{c}" for c, w in W.CLASSES.items())
    + f" FROM (SELECT doc_id, {W.sql_clean('text')} AS cleaned FROM documents)"
)


def keyword_scores_boundary(spark, sf):
    text = F.lower(F.col("text"))
    return W.documents(spark, sf).select(
        "doc_id", K.score(text, W.TRIGGERS, boundary=True).alias("words"),
        K.score(text, W.TRIGGERS).alias("substrings"),
    )


KEYWORD_SCORES_BOUNDARY = f"""
SELECT doc_id, length({W.sql_hits('lower(text)', W.TRIGGERS, True)})::INTEGER AS words,
  {W.sql_score('lower(text)', W.TRIGGERS)} AS substrings FROM documents
"""


def keyword_argmax(spark, sf):
    rows = W.table(spark, sf, "conversations")
    return C.classify(rows, F.col("text"), W.CLASSES).select(
        "conv_id", "turn", "intent", "best_score"
    )


KEYWORD_ARGMAX = f"""
WITH src AS (SELECT *, {W.sql_clean('text')} AS cleaned FROM conversations)
SELECT conv_id, turn, intent, best_score FROM ({W.sql_classified('src', 'cleaned')})
"""


def keyword_confidence(spark, sf):
    rows = C.classify(
        W.documents(spark, sf), F.col("text"), W.CLASSES, fallback="ORDER_DELIVERY_STATUS",
        single_pass=True,
    )
    return rows.select("doc_id", "intent", K.confidence(F.col("best_score")).alias("confidence"))


KEYWORD_CONFIDENCE = f"""
WITH src AS (SELECT *, {W.sql_clean('text', True)} AS cleaned FROM documents)
SELECT doc_id, intent,
  CASE WHEN best_score > 0 THEN round_even(least(best_score / 5.0, 1.0)::DOUBLE, 2)
    ELSE 0.1::DOUBLE END AS confidence
FROM ({W.sql_classified('src', 'cleaned', fallback='ORDER_DELIVERY_STATUS')})
"""

_SQL_TURNS = f"""
WITH src AS (SELECT *, {W.sql_clean('text')} AS cleaned FROM conversations),
classified AS ({W.sql_classified('src', 'cleaned')})
"""


def _classified_turns(spark, sf):
    return C.classify(W.table(spark, sf, "conversations"), F.col("text"), W.CLASSES)


def class_distribution(spark, sf):
    counts = C.value_counts(_classified_turns(spark, sf), "intent")
    return counts.withColumn("share", F.round("share", 6))


CLASS_DISTRIBUTION = f"""
{_SQL_TURNS} SELECT intent, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM classified GROUP BY intent
"""


def majority_class(spark, sf):
    return C.majority_class(_classified_turns(spark, sf), "intent")


MAJORITY_CLASS = f"""
{_SQL_TURNS} SELECT intent, count(*) AS n FROM classified GROUP BY intent
ORDER BY n DESC, intent LIMIT 1
"""


def majority_predictions(spark, sf):
    rows = C.predict_majority(_classified_turns(spark, sf).select("conv_id", "turn", "intent"), "intent")
    return rows.select("conv_id", "turn", "pred_intent", "pred_decision")


MAJORITY_PREDICTIONS = f"""
{_SQL_TURNS} SELECT conv_id, turn, 'auto' AS pred_decision,
  (SELECT intent FROM classified GROUP BY intent ORDER BY count(*) DESC, intent LIMIT 1)
    AS pred_intent
FROM classified
"""


def class_examples(spark, sf):
    rows = C.classify(W.documents(spark, sf), F.col("text"), W.CLASSES)
    best = C.class_examples(rows, "intent", "best_score", "doc_id", 3)
    return best.select(
        "intent", "example", "doc_id", "best_score", T.truncate(F.col("text"), 200).alias("shown")
    )


CLASS_EXAMPLES = f"""
WITH src AS (SELECT *, {W.sql_clean('text')} AS cleaned FROM documents),
classified AS ({W.sql_classified('src', 'cleaned')})
SELECT intent, example, doc_id, best_score, text[1:200] AS shown FROM (
  SELECT *, row_number() OVER (PARTITION BY intent ORDER BY best_score DESC, doc_id)::INTEGER
    AS example FROM classified WHERE intent <> 'UNCLASSIFIED') WHERE example <= 3
"""

QUERIES = {
    "clean_text": (clean_text, CLEAN_TEXT),
    "language_share": (language_share, LANGUAGE_SHARE),
    "length_band": (length_band, LENGTH_BAND),
    "parse_bool": (parse_bool, PARSE_BOOL),
    "direction_split": (direction_split, DIRECTION_SPLIT),
    "thread_pairs_all": (thread_pairs_all, THREAD_PAIRS_ALL),
    "thread_pairs_left": (thread_pairs_left, THREAD_PAIRS_LEFT),
    "thread_pairs_longest": (thread_pairs_longest, THREAD_PAIRS_LONGEST),
    "replied_semi": (replied_semi, REPLIED_SEMI),
    "unreplied_anti": (unreplied_anti, UNREPLIED_ANTI),
    "keyword_scores": (keyword_scores, KEYWORD_SCORES),
    "keyword_scores_boundary": (keyword_scores_boundary, KEYWORD_SCORES_BOUNDARY),
    "keyword_argmax": (keyword_argmax, KEYWORD_ARGMAX),
    "keyword_confidence": (keyword_confidence, KEYWORD_CONFIDENCE),
    "class_distribution": (class_distribution, CLASS_DISTRIBUTION),
    "majority_class": (majority_class, MAJORITY_CLASS),
    "majority_predictions": (majority_predictions, MAJORITY_PREDICTIONS),
    "class_examples": (class_examples, CLASS_EXAMPLES),
}
