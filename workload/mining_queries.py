"""Account profiles, TF-IDF, similarity, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.functions import vectors as V
from threadloom.operators import classes as C
from threadloom.operators import keyword_index as KX
from threadloom.operators import profile as P
from threadloom.operators import profile_state as PS
from threadloom.operators import ranking as R
from threadloom.operators import sampling as S
from threadloom.operators import similarity as M
from threadloom.operators import text_similarity as TS
from threadloom.operators import tfidf as X
from threadloom.sources import tables as IO
from workload import common as W

# --- accounts --------------------------------------------------------------------------------

MIN_OUTBOUND = 5


def account_activity(spark, sf):
    events = W.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("author_id"),
        F.when(F.col("event_type") != "error", F.col("event_type") == "click").alias("inbound"),
        F.col("props").alias("text"),
    )
    return P.eligible(P.activity(events), 0.35, MIN_OUTBOUND).select(
        "author_id", "outbound_count", "inbound_count",
        F.round("pct_inbound", 6).alias("pct_inbound"),
        F.round("noise_frac", 6).alias("noise_frac"),
    )


ACCOUNT_ACTIVITY = f"""
SELECT author_id, outbound_count, inbound_count,
  round(inbound_count / (outbound_count + inbound_count), 6) AS pct_inbound,
  round(coalesce(noise, 1.0), 6) AS noise_frac
FROM (
  SELECT user_id::VARCHAR AS author_id,
    count(*) FILTER (WHERE event_type NOT IN ('error', 'click')) AS outbound_count,
    count(*) FILTER (WHERE event_type = 'click') AS inbound_count,
    avg(CASE WHEN event_type NOT IN ('error', 'click')
      THEN CASE WHEN length(props) <= 20 THEN 1.0 ELSE 0.0 END END) AS noise
  FROM events GROUP BY 1)
WHERE outbound_count >= {MIN_OUTBOUND}
  AND inbound_count / (outbound_count + inbound_count) < 0.35
"""

_PROFILE_SQL = f"""
WITH {W.SQL_RAW_MESSAGES},
counts AS (
  SELECT author_id, count(*) FILTER (WHERE NOT inbound) AS outbound_count,
    count(*) FILTER (WHERE inbound) AS inbound_count,
    coalesce(avg(CASE WHEN NOT inbound THEN CASE WHEN length(text) <= 20 THEN 1.0 ELSE 0.0 END END),
      1.0) AS noise
  FROM messages GROUP BY 1),
accounts AS (
  SELECT *, inbound_count / (outbound_count + inbound_count) AS pct FROM counts
  WHERE outbound_count >= {MIN_OUTBOUND}
    AND inbound_count / (outbound_count + inbound_count) < 0.2),
edges AS (
  SELECT DISTINCT author_id, in_response_to_tweet_id AS id FROM messages
  WHERE NOT inbound AND in_response_to_tweet_id IS NOT NULL),
complete AS (
  SELECT author_id, count(*) FILTER (WHERE id IN (SELECT tweet_id FROM messages WHERE inbound))
    / count(*) AS completeness FROM edges GROUP BY 1),
answers AS (
  SELECT b.author_id, m.text,
    row_number() OVER (PARTITION BY b.author_id ORDER BY m.tweet_id) AS place
  FROM messages m JOIN messages b
    ON m.in_response_to_tweet_id = b.tweet_id AND NOT b.inbound
  WHERE m.inbound AND m.text IS NOT NULL),
words AS (
  SELECT author_id, unnest(regexp_split_to_array(lower(text), '{T.SPACE}+')) AS word
  FROM answers),
ttr AS (
  SELECT author_id, count(DISTINCT word) / greatest(count(*), 1) AS ratio FROM words
  WHERE word <> '' GROUP BY 1),
profile AS (
  SELECT author_id, outbound_count, inbound_count, round_even(pct, 3) AS pct_inbound,
    round_even(coalesce(completeness, 0), 3) AS thread_completeness,
    round_even(noise, 3) AS noise_frac, round_even(coalesce(ratio, 0), 3) AS topic_ttr
  FROM accounts LEFT JOIN complete USING (author_id) LEFT JOIN ttr USING (author_id))
"""


def account_profile(spark, sf):
    return P.profile_accounts(W.stored_messages(spark, sf), min_outbound=MIN_OUTBOUND)


ACCOUNT_PROFILE = f"{_PROFILE_SQL} SELECT * FROM profile"


def account_profile_days(spark, sf):
    """The same profile from the states of three days; many answers come before what they answer."""
    messages = W.stored_messages(spark, sf)
    log = PS.open_log(spark, IO.work_folder(spark, "profile"))
    for day in range(3):
        PS.add_day(log, messages.where(F.col("turn") % 3 == (2 - day)), f"day-{day}")
    return PS.profile(log, min_outbound=MIN_OUTBOUND)


def _scored_accounts(spark, sf):
    names = spark.createDataFrame([("acct1", "Alpha"), ("acct2", "Beta")],
                                  "author_id string, brand_name string")
    profile = P.profile_accounts(W.stored_messages(spark, sf), min_outbound=MIN_OUTBOUND)
    return P.score_accounts(P.name_accounts(profile, names))


def account_rank(spark, sf):
    best = P.top_accounts(_scored_accounts(spark, sf))
    return best.select(
        "rank", "author_id", "brand_name", "outbound_count",
        F.round("outbound_count_norm", 6).alias("outbound_count_norm"),
        F.round("score", 6).alias("score"),
    )


ACCOUNT_RANK = f"""{_PROFILE_SQL},
named AS (
  SELECT *, CASE author_id WHEN 'acct1' THEN 'Alpha' WHEN 'acct2' THEN 'Beta'
    ELSE 'unknown_' || author_id END AS brand_name FROM profile),
norm AS (
  SELECT *,
    (outbound_count - min(outbound_count) OVER ())
      / coalesce(nullif(max(outbound_count) OVER () - min(outbound_count) OVER (), 0), 1) AS a,
    (thread_completeness - min(thread_completeness) OVER ()) / coalesce(nullif(
      max(thread_completeness) OVER () - min(thread_completeness) OVER (), 0), 1) AS b,
    (noise_frac - min(noise_frac) OVER ())
      / coalesce(nullif(max(noise_frac) OVER () - min(noise_frac) OVER (), 0), 1) AS c,
    (topic_ttr - min(topic_ttr) OVER ())
      / coalesce(nullif(max(topic_ttr) OVER () - min(topic_ttr) OVER (), 0), 1) AS d
  FROM named),
scored AS (SELECT *, 0.4 * a + 0.3 * b + 0.2 * (1 - c) + 0.1 * d AS total FROM norm)
SELECT row_number() OVER (ORDER BY total DESC, author_id)::INTEGER AS rank, author_id, brand_name,
  outbound_count, round(a, 6) AS outbound_count_norm, round(total, 6)::DOUBLE AS score
FROM scored ORDER BY total DESC, author_id LIMIT 10
"""


def account_order(spark, sf):
    """Every account of the profile, best first."""
    return P.ordered_accounts(_scored_accounts(spark, sf)).select(
        "author_id", "brand_name", "outbound_count", F.round("score", 6).alias("score")
    )


ACCOUNT_ORDER = f"""
SELECT author_id, brand_name, outbound_count, score
FROM ({ACCOUNT_RANK.replace(' LIMIT 10', '')}) ORDER BY rank
"""


def source_vocabulary(spark, sf):
    docs = W.documents(spark, sf).select("source", "doc_id", "text")
    richness = P.vocabulary_richness(docs, "source", "doc_id", first=20)
    return richness.select("source", F.round("topic_ttr", 6).alias("topic_ttr"))


SOURCE_VOCABULARY = f"""
SELECT source, round(count(DISTINCT word) / count(*), 6) AS topic_ttr FROM (
  SELECT source, unnest(regexp_split_to_array(lower(text), '{T.SPACE}+')) AS word FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents)
  WHERE place <= 20)
WHERE word <> '' GROUP BY source
"""


def prefix_rows(spark, sf):
    return R.first_rows(W.table(spark, sf, "events"), "event_id", 5000).select(
        "event_id", "user_id", "event_type"
    )


PREFIX_ROWS = (
    "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 5000"
)

# --- TF-IDF ----------------------------------------------------------------------------------


def _sql_tfidf(source: str, doc: str, bigrams: bool, min_df: int, max_df: float, features: int | None,
               by: str | None = None) -> str:
    """CTEs ending in weighted(by, doc, term, weight, n_docs) over ``source(by, doc, text)``."""
    part = f"{by}, " if by else ""
    stop = ", ".join(W.sql_text(w) for w in W.STOP_WORDS)
    pairs = f"""
      UNION ALL SELECT {part}{doc}, a || ' ' || b FROM (
        SELECT {part}{doc}, word AS a, lead(word) OVER (PARTITION BY {doc} ORDER BY pos) AS b
        FROM toks) WHERE b IS NOT NULL""" if bigrams else ""
    over = f"PARTITION BY {by} " if by else ""
    join = f"JOIN sizes USING ({by})" if by else "CROSS JOIN sizes"
    size = f"SELECT {by}, count(*) AS n_docs FROM {source} GROUP BY {by}" if by else (
        f"SELECT count(*) AS n_docs FROM {source}"
    )
    return f"""
raw_toks AS (
  SELECT {part}{doc}, unnest(string_split(cleaned, ' ')) AS word,
    generate_subscripts(string_split(cleaned, ' '), 1) AS pos
  FROM (SELECT {part}{doc}, {W.sql_clean('text')} AS cleaned FROM {source})),
toks AS (SELECT * FROM raw_toks WHERE length(word) >= 2 AND word NOT IN ({stop})),
terms AS (SELECT {part}{doc}, word AS term FROM toks {pairs}),
tfs AS (SELECT {part}{doc}, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS ({size}),
dfs AS (SELECT {part}term, count(*) AS df, sum(tf) AS total FROM tfs GROUP BY ALL),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER ({over}ORDER BY total DESC, term) AS place
    FROM dfs {join} WHERE df >= {min_df} AND df <= {max_df} * n_docs)
  {f'WHERE place <= {features}' if features else ''}),
raw_w AS (
  SELECT {', '.join(f'tfs.{c}' for c in ([by] if by else []) + [doc])}, tfs.term, n_docs,
    tf * (ln((1 + n_docs) / (1 + df)) + 1) AS w
  FROM tfs JOIN kept ON kept.term = tfs.term {f'AND kept.{by} = tfs.{by}' if by else ''}),
weighted AS (
  SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY {doc})) AS weight FROM raw_w)
"""


def _sql_top(n: int) -> str:
    return f"""
means AS (SELECT term, round_even(sum(weight) / max(n_docs), 5) AS mean_weight
  FROM weighted GROUP BY term)
SELECT row_number() OVER (ORDER BY mean_weight DESC, term)::INTEGER AS rank, term, mean_weight
FROM means ORDER BY mean_weight DESC, term LIMIT {n}
"""


def tfidf_top_terms(spark, sf):
    docs = W.documents(spark, sf)
    return X.top_terms(docs, "doc_id", F.col("text"), 200, W.STOP_WORDS, 5, 0.6, 5000).select(
        "rank", "term", "mean_weight"
    )


TFIDF_TOP_TERMS = (
    f"WITH {_sql_tfidf('documents', 'doc_id', True, 5, 0.6, 5000)}, {_sql_top(200)}"
)


def tfidf_unclassified(spark, sf):
    turns = C.classify(W.messages(spark, sf), F.col("text"), W.CLASSES)
    rest = turns.where(F.col("intent") == "UNCLASSIFIED").select("tweet_id", "text")
    return X.top_terms(rest, "tweet_id", F.col("text"), 60, W.STOP_WORDS, 3, 0.7, 2000).select(
        "rank", "term", "mean_weight"
    )


TFIDF_UNCLASSIFIED = f"""
WITH {W.SQL_RAW_MESSAGES},
src AS (SELECT *, {W.sql_clean('text')} AS cleaned FROM messages),
classified AS ({W.sql_classified('src', 'cleaned')}),
rest AS (SELECT tweet_id, text FROM classified WHERE intent = 'UNCLASSIFIED'),
{_sql_tfidf('rest', 'tweet_id', True, 3, 0.7, 2000)}, {_sql_top(60)}
"""


def tfidf_by_class(spark, sf):
    docs = W.documents(spark, sf)
    return X.top_terms_by_class(
        docs, "doc_id", F.col("text"), "lang", 10, W.STOP_WORDS, max_features=200
    ).select("lang", "rank", "term", "mean_weight")


TFIDF_BY_CLASS = f"""
WITH {_sql_tfidf('documents', 'doc_id', False, 2, 1.0, 200, by='lang')},
means AS (SELECT lang, term, round_even(sum(weight) / max(n_docs), 5) AS mean_weight
  FROM weighted WHERE n_docs >= 5 GROUP BY lang, term),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY mean_weight DESC, term)::INTEGER
  AS rank FROM means)
SELECT lang, rank, term, mean_weight FROM ranked WHERE rank <= 10
"""


def text_top_k(spark, sf):
    docs = W.table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "text"
    )
    weights = IO.stage(
        X.weights(docs, "id", F.col("text"), W.STOP_WORDS, bigrams=False).select("id", "term", "weight"),
        "weights",
    )
    return TS.text_top_k(
        weights.withColumnRenamed("id", "idx"), weights.withColumnRenamed("id", "query_id"), 3
    )


TEXT_TOP_K = f"""
WITH src AS (SELECT conv_id || '-' || turn AS id, text FROM conversations),
{_sql_tfidf('src', 'id', False, 1, 1.0, None)},
pairs AS (
  SELECT q.id AS query_id, v.id AS idx, round(sum(q.weight * v.weight), 6) AS score
  FROM weighted q JOIN weighted v ON q.term = v.term AND q.id <> v.id GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, idx)::INTEGER
  AS rank FROM pairs)
SELECT query_id, rank, idx, score FROM ranked WHERE rank <= 3 AND score > 0
"""

# --- similarity ------------------------------------------------------------------------------


def _vectors(spark, sf):
    rows = W.table(spark, sf, "embeddings")
    corpus = W.spread(rows, "vec_id").select(
        F.col("vec_id").alias("idx"), F.col("embedding").alias("vec")
    )
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    return corpus, queries


_SQL_SIMILAR = """
units AS (
  SELECT vec_id, label, list_transform(v, lambda x: x / n) AS u FROM (
    SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM (
      SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings))),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS idx, round(list_dot_product(q.u, v.u), 6) AS score
  FROM units q, units v {where}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, idx)::INTEGER
  AS rank FROM pairs)
"""
_OTHERS = _SQL_SIMILAR.format(where="WHERE q.vec_id <> v.vec_id")


def top_k_cosine(spark, sf):
    return M.top_k(*_vectors(spark, sf), 5, exclude_self=False).select(
        "query_id", "rank", "idx", "score"
    )


TOP_K_COSINE = (
    f"WITH {_SQL_SIMILAR.format(where='')} "
    "SELECT query_id, rank, idx, score FROM ranked WHERE rank <= 5"
)


def top_k_exclude_self(spark, sf):
    return M.top_k(*_vectors(spark, sf), 5).select("query_id", "rank", "idx", "score")


TOP_K_EXCLUDE_SELF = f"WITH {_OTHERS} SELECT query_id, rank, idx, score FROM ranked WHERE rank <= 5"


def keyword_table(spark, sf):
    """Best class of every document by a keyword table drawn from the data: the words of the
    benchmark, classed by their first letter."""
    words = W.table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"), 1)).alias("word"))
    first = F.substring("word", 1, 1)
    table = words.distinct().select(F.ascii(first).alias("turn"), first.alias("class"), "word")
    return KX.best_classes(
        W.table(spark, sf, "documents"), "doc_id", F.coalesce(F.lower("text"), F.lit("")), table, "none"
    ).select(F.col("row_id").alias("doc_id"), "label", "score")


KEYWORD_TABLE = """
WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM benchmark),
hits AS (
  SELECT doc_id, left(word, 1) AS label, count(*) AS score
  FROM documents JOIN words ON contains(lower(text), word) GROUP BY ALL),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1)
SELECT doc_id, coalesce(label, 'none') AS label, coalesce(score, 0) AS score FROM documents LEFT JOIN best USING (doc_id)
"""


def top_k_grid(spark, sf):
    return M.top_k(*_vectors(spark, sf), 5, cell_rows=40).select(
        "query_id", "rank", "idx", "score"
    )


def nearest_label(spark, sf):
    corpus, queries = _vectors(spark, sf)
    labels = W.table(spark, sf, "embeddings").select("vec_id", "label")
    best = M.top_k(corpus, queries, 1)
    return (
        best.join(labels.select(F.col("vec_id").alias("idx"), F.col("label").alias("pred")), "idx")
        .join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("gold")),
              "query_id")
        .select("query_id", "idx", "score", "gold", "pred")
    )


NEAREST_LABEL = f"""
WITH {_OTHERS}
SELECT query_id, idx, score, q.label AS gold, v.label AS pred FROM ranked
JOIN units q ON q.vec_id = query_id JOIN units v ON v.vec_id = idx WHERE rank = 1
"""


def hit_lists(spark, sf):
    corpus, queries = _vectors(spark, sf)
    named = corpus.join(
        W.table(spark, sf, "embeddings").select(F.col("vec_id").alias("idx"), "label"), "idx"
    )
    hits = M.gather_hits(M.top_k(corpus, queries, 3), named, ["label"])
    return hits.select(
        "query_id",
        F.array_join(
            F.transform("hits", lambda h: F.concat_ws(":", h["rank"], h["idx"], h["label"])), " "
        ).alias("hits"),
    )


HIT_LISTS = f"""
WITH {_OTHERS}
SELECT query_id, string_agg(rank || ':' || idx || ':' || label, ' ' ORDER BY rank) AS hits
FROM ranked JOIN units ON vec_id = idx WHERE rank <= 3 GROUP BY query_id
"""


def vector_table(spark, sf):
    corpus, _ = _vectors(spark, sf)
    out = IO.work_folder(spark, "vectors")
    IO.write_table(corpus.select("idx", V.unit(F.col("vec")).alias("vec")), out)
    stored = IO.read_table(spark, out)
    return stored.select(
        "idx",
        F.round(V.dot(F.col("vec"), F.col("vec")), 4).alias("length"),
        F.round(F.get("vec", F.lit(0)).cast("double"), 4).alias("first"),
    )


VECTOR_TABLE = f"""
WITH {_SQL_SIMILAR.format(where='')}
SELECT vec_id AS idx, round(list_dot_product(u, u), 4) AS length,
  round(u[1]::FLOAT::DOUBLE, 4) AS first FROM units
"""

# --- samples ---------------------------------------------------------------------------------


def sample_hash(spark, sf):
    rows = W.table(spark, sf, "events").select("event_id", "user_id")
    return S.sample(rows, "event_id", 5000, seed=42)


SAMPLE_HASH = """
SELECT event_id, user_id FROM events
ORDER BY md5('42|' || event_id), event_id LIMIT 5000
"""


def sample_stratified(spark, sf):
    rows = W.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return S.sample_per_stratum(rows, "lang", "doc_id", 15, seed=7)


SAMPLE_STRATIFIED = """
SELECT doc_id, lang, n_chars, draw_rank FROM (
  SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang
    ORDER BY md5('7|' || doc_id), doc_id)::INTEGER AS draw_rank FROM documents)
WHERE draw_rank <= 15
"""


def proportional_quota(spark, sf):
    quotas = S.proportional_quotas(W.table(spark, sf, "documents"), "source", 90, ["src3"])
    return quotas.select("source", "n", F.round("share", 6).alias("share"), "quota")


_QUOTA = """
SELECT {c}, count(*) AS n, count(*) / sum(count(*)) OVER () AS share,
  greatest(1, round_even(count(*) / sum(count(*)) OVER () * {total}, 0))::INTEGER AS quota
FROM {table} GROUP BY {c}
"""
PROPORTIONAL_QUOTA = f"""
SELECT source, n, round(share, 6) AS share, quota
FROM ({_QUOTA.format(c='source', total=90, table='documents')}) WHERE source <> 'src3'
"""


def sample_proportional(spark, sf):
    rows = W.table(spark, sf, "documents").select("doc_id", "lang")
    return S.sample_proportional(rows, "lang", "doc_id", 2024, 80, []).select(
        "doc_id", "lang", "draw_rank", "quota"
    )


SAMPLE_PROPORTIONAL = f"""
SELECT doc_id, lang, draw_rank, quota FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
    ORDER BY md5('2024|' || doc_id), doc_id)::INTEGER AS draw_rank FROM documents)
JOIN ({_QUOTA.format(c='lang', total=80, table='documents')}) USING (lang)
WHERE draw_rank <= quota
"""


def first_k_per_class(spark, sf):
    rows = W.table(spark, sf, "embeddings").select("vec_id", "label")
    return S.first_k_per_class(rows, "label", "vec_id", 5)


FIRST_K_PER_CLASS = """
SELECT vec_id, label, class_rank FROM (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id)::INTEGER
    AS class_rank FROM embeddings) WHERE class_rank <= 5
"""

QUERIES = {
    "account_activity": (account_activity, ACCOUNT_ACTIVITY),
    "account_profile": (account_profile, ACCOUNT_PROFILE),
    "account_profile_days": (account_profile_days, ACCOUNT_PROFILE),
    "keyword_table": (keyword_table, KEYWORD_TABLE),
    "account_rank": (account_rank, ACCOUNT_RANK),
    "account_order": (account_order, ACCOUNT_ORDER),
    "source_vocabulary": (source_vocabulary, SOURCE_VOCABULARY),
    "prefix_rows": (prefix_rows, PREFIX_ROWS),
    "tfidf_top_terms": (tfidf_top_terms, TFIDF_TOP_TERMS),
    "tfidf_unclassified": (tfidf_unclassified, TFIDF_UNCLASSIFIED),
    "tfidf_by_class": (tfidf_by_class, TFIDF_BY_CLASS),
    "text_top_k": (text_top_k, TEXT_TOP_K),
    "top_k_cosine": (top_k_cosine, TOP_K_COSINE),
    "top_k_exclude_self": (top_k_exclude_self, TOP_K_EXCLUDE_SELF),
    "top_k_grid": (top_k_grid, TOP_K_EXCLUDE_SELF),
    "nearest_label": (nearest_label, NEAREST_LABEL),
    "hit_lists": (hit_lists, HIT_LISTS),
    "vector_table": (vector_table, VECTOR_TABLE),
    "sample_hash": (sample_hash, SAMPLE_HASH),
    "sample_stratified": (sample_stratified, SAMPLE_STRATIFIED),
    "proportional_quota": (proportional_quota, PROPORTIONAL_QUOTA),
    "sample_proportional": (sample_proportional, SAMPLE_PROPORTIONAL),
    "first_k_per_class": (first_k_per_class, FIRST_K_PER_CLASS),
}
