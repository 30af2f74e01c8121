"""Test vocabularies, derived inputs and SQL fragments shared by the registered queries.

The driver's texts are invented prose, so keyword lists here are made of its syllables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import presets
from threadloom.functions import text as T
from threadloom.operators.threads import last_before, normalise
from threadloom.sources.tables import stage

CLASSES = {
    "ORDER_DELIVERY_STATUS": ["thing", "onth", "eron", "ered", "hed "],
    "RETURN_REFUND_REPLACEMENT": ["ment", "elle", "tre ", "eaux"],
    "ACCOUNT_ACCESS": ["blest", "shon", "ntin"],
    "CHARGE_PAYMENT_BILLING": ["keit", "heit", "lich", "ung "],
    "PRIME_SUBSCRIPTION": ["mente", "ado ", "ando"],
    "PRODUCT_COMPLAINT": ["erre", "ati ", "ingst", "don't"],
    "ORDER_CANCELLATION": ["zuver", "schst", "berkeit"],
    "DEVICE_APP_TECHNICAL": ["queou", "ouai", "vipa"],
}

# a second, shorter table, as a classifier to be judged against the first
CLASSES_SHORT = {
    "ORDER_DELIVERY_STATUS": ["thing", "ing ", "wh "],
    "RETURN_REFUND_REPLACEMENT": ["ment", "eaux"],
    "CHARGE_PAYMENT_BILLING": ["keit", "ung"],
    "PRIME_SUBSCRIPTION": ["mente", "ado"],
    "PRODUCT_COMPLAINT": ["erre"],
}

POLICY = {
    "ORDER_DELIVERY_STATUS": ("auto", "Look up the parcel."),
    "RETURN_REFUND_REPLACEMENT": ("auto", "Explain how to return."),
    "ACCOUNT_ACCESS": ("escalate", "Identity must be checked."),
    "CHARGE_PAYMENT_BILLING": ("escalate", "Records must be reviewed."),
    "PRIME_SUBSCRIPTION": ("auto", "Explain the membership."),
    "PRODUCT_COMPLAINT": ("auto", "Offer a replacement."),
    "ORDER_CANCELLATION": ("auto", "Cancel before shipping."),
}

TRIGGERS = ("idiot", "worthless", "pathetic", "stupid", "onth", "zu")

STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "de", "la", "en",
    "que", "der", "die", "und", "le", "les", "el", "los",
)

RULES = (
    presets.Rule("ACCOUNT_ACCESS", "escalate", "access", any_of=("shon", "blest"),
                 unless_has="the", unless_lacks="and"),
    presets.Rule("CHARGE_PAYMENT_BILLING", "escalate", "billing", any_of=("keit", "erre"),
                 all_of=("en", "er"), none_of=("tion", "sch")),
    presets.Rule("RETURN_REFUND_REPLACEMENT", "auto", "return", any_of=("elle", "ment")),
    presets.Rule("PRIME_SUBSCRIPTION", "auto", "member", all_of=("ing", "ed")),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a table that is read in one piece to all cores; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *[F.col(k) for k in keys])


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def taxonomy(spark: SparkSession) -> DataFrame:
    rows = [(name, decision, note) for name, (decision, note) in POLICY.items()]
    return spark.createDataFrame(
        rows, "id string, escalation_default string, escalation_note string"
    )


def raw_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations in the shape of a message table with reply edges.

    An assistant turn replies to the latest earlier user turn, a user turn to the latest earlier
    assistant turn; system turns have no direction.
    """
    turns = last_before(
        table(spark, sf, "conversations"), "conv_id", "turn",
        {"user_turn": F.col("role") == "user", "assistant_turn": F.col("role") == "assistant"},
    )
    conv = F.col("conv_id").cast("string")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    parent = F.when(assistant, F.col("user_turn")).when(user, F.col("assistant_turn"))
    return turns.select(
        "conv_id",
        "turn",
        F.concat_ws("-", conv, "turn").alias("tweet_id"),
        F.when(assistant, F.concat(F.lit("acct"), (F.col("conv_id") % 4).cast("string")))
        .when(user, F.concat(F.lit("cust"), conv))
        .otherwise(F.lit("system"))
        .alias("author_id"),
        F.when(user, F.lit(" True ")).when(assistant, F.lit("FALSE")).otherwise(F.lit("n/a"))
        .alias("inbound"),
        F.concat(F.lit("t"), F.col("turn").cast("string")).alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.when(parent.isNotNull(), F.concat_ws("-", conv, parent)).alias(
            "in_response_to_tweet_id"
        ),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return normalise(raw_messages(spark, sf))


def stored_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The message table written out, for queries that read it several times."""
    return stage(messages(spark, sf), "messages")


# --- SQL fragments ---------------------------------------------------------------------------

SQL_RAW_MESSAGES = """
raw_messages AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS tweet_id,
    CASE role WHEN 'assistant' THEN 'acct' || (conv_id % 4) WHEN 'user' THEN 'cust' || conv_id
      ELSE 'system' END AS author_id,
    CASE role WHEN 'user' THEN true WHEN 'assistant' THEN false END AS inbound,
    't' || turn AS created_at, text,
    CASE role WHEN 'assistant' THEN conv_id || '-' || user_turn
      WHEN 'user' THEN conv_id || '-' || assistant_turn END AS in_response_to_tweet_id
  FROM (
    SELECT *,
      max(CASE WHEN role = 'user' THEN turn END) OVER w AS user_turn,
      max(CASE WHEN role = 'assistant' THEN turn END) OVER w AS assistant_turn
    FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), messages AS (SELECT * FROM raw_messages)
"""


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{T.SPACE}+|{T.SPACE}+$', '', 'g')"


def sql_clean(expr: str, single_pass: bool = False) -> str:
    out = f"lower(coalesce({expr}, ''))"
    steps = (
        [f"{T.URL}|{T.MENTION}|{T.HASHTAG}"] if single_pass else [T.URL, T.MENTION, T.HASHTAG]
    )
    for pattern in steps:
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    out = f"regexp_replace({out}, '[^a-z0-9{T.SPACE_CHARS}]', ' ', 'g')"
    return f"trim(regexp_replace({out}, '{T.SPACE}+', ' ', 'g'))"


def sql_clean_keep(expr: str) -> str:
    pattern = f"{T.MENTION}|{T.URL}|{T.HASHTAG}"
    return sql_strip(f"lower(regexp_replace({expr}, '{pattern}', '', 'g'))")


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_score(expr: str, words) -> str:
    return "(" + " + ".join(
        f"CASE WHEN contains({expr}, {sql_text(w)}) THEN 1 ELSE 0 END" for w in words
    ) + ")"


def sql_classified(source: str, clean: str, classes=None, fallback: str = "UNCLASSIFIED") -> str:
    """A SELECT adding columns best_score and intent to ``source``; ``clean`` is a text column."""
    classes = classes or CLASSES
    scores = ", ".join(
        f"{sql_score(clean, words)} AS s{i}" for i, words in enumerate(classes.values())
    )
    best = "greatest(" + ", ".join(f"s{i}" for i in range(len(classes))) + ")"
    cases = " ".join(
        f"WHEN s{i} = best_score THEN {sql_text(label)}" for i, label in enumerate(classes)
    )
    hidden = ", ".join(f"s{i}" for i in range(len(classes)))
    return f"""
    SELECT * EXCLUDE ({hidden}),
      CASE WHEN best_score = 0 THEN {sql_text(fallback)} {cases} END AS intent
    FROM (SELECT *, {best} AS best_score FROM (SELECT *, {scores} FROM {source}))
    """


def sql_any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {sql_text(w)})" for w in words) + ")"


def sql_hits(expr: str, words, boundary: bool) -> str:
    """The listed words found in a text, in list order."""
    tests = [
        f"CASE WHEN regexp_matches({expr}, '(^|[^\\p{{L}}\\p{{N}}_]){w}($|[^\\p{{L}}\\p{{N}}_])') "
        f"THEN {sql_text(w)} END"
        if boundary
        else f"CASE WHEN contains({expr}, {sql_text(w)}) THEN {sql_text(w)} END"
        for w in words
    ]
    return f"list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL)"


def sql_quoted(expr: str) -> str:
    return f"'[''' || array_to_string({expr}, ''', ''') || ''']'"


def sql_policy() -> str:
    rows = ", ".join(
        f"({sql_text(c)}, {sql_text(d)}, {sql_text(n)})" for c, (d, n) in POLICY.items()
    )
    return f"policy(id, escalation_default, escalation_note) AS (VALUES {rows})"


def sql_rules(raw: str, cleaned: str, rules, default=presets.DEFAULT_OUTCOME) -> str:
    """A CASE giving the number of the rule that decides: -2 foreign, -1 continuation, n none."""
    share = f"length(regexp_replace({raw}, '[^\\x00-\\x7F]', '', 'g')) / length({raw})"
    words = "|".join(presets.CONTINUATION_WORDS)
    out = [
        f"CASE WHEN NOT coalesce(length({raw}) > 0 AND {share} > 0.65, false) THEN -2",
        f"WHEN regexp_matches({cleaned}, '^{T.SPACE}*({words})[!.{T.SPACE_CHARS}]*$') THEN -1",
    ]
    for i, rule in enumerate(rules):
        tests = [sql_any(cleaned, rule.any_of)] if rule.any_of else []
        tests += [f"contains({cleaned}, {sql_text(w)})" for w in rule.all_of]
        tests += [f"NOT contains({cleaned}, {sql_text(w)})" for w in rule.none_of]
        if rule.unless_has:
            tests.append(
                f"NOT (contains({cleaned}, {sql_text(rule.unless_has)}) "
                f"AND NOT contains({cleaned}, {sql_text(rule.unless_lacks)}))"
            )
        out.append(f"WHEN {' AND '.join(tests)} THEN {i}")
    return " ".join(out) + f" ELSE {len(rules)} END"


def sql_outcomes(rules, default=presets.DEFAULT_OUTCOME) -> str:
    rows = [(-2, *presets.FOREIGN_OUTCOME), (-1, *presets.CONTINUATION_OUTCOME)]
    rows += [(i, r.label, r.decision, r.note) for i, r in enumerate(rules)]
    rows.append((len(rules), *default))
    values = ", ".join(
        f"({n}, {sql_text(a)}, {sql_text(b)}, {sql_text(c)})" for n, a, b, c in rows
    )
    return f"outcomes(rule, label, decision, note) AS (VALUES {values})"
