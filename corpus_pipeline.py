"""The preparation of a training corpus, stage by stage, over the table ``documents``.

Every stage works on all that the one before it kept and returns the columns of ``documents``; the
last returns the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import language, mixing, near_dup, packing, repeats
from threadloom.llm.queries import TOKENIZER
from threadloom.sources.tables import stage

# a text whose best language gets less than this could be in any of them
LEAST_SCORE = 0.3
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of at most BATCH_BYTES: a worker holds a few copies of its
    batch, and with the session's default these add up from stage to stage."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def unused(name: str, columns: list[str]) -> str:
    """The name with as many underscores before it as no column has."""
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def with_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a column that is different in every one, and its name: the id where ids are
    unique and not null (a check that reads ids alone), else numbers written beside a copy."""
    key = unused("_key", docs.columns)
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("doc_id").isNull() | (F.col("_n") > 1))
    if twice.isEmpty():
        return docs.withColumn(key, F.col("doc_id").cast("long")), key
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or in no language that the network can tell, go."""
    small_batches(spark)
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    found = language.identify(rows, language.fit(docs), "_row")
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles, the one with the smallest id stays.

    Every row is a document of its own; where ids are null or repeat, the first row read stays.
    """
    small_batches(spark)
    rows, key = with_keys(docs)
    found = near_dup.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), width=5, percent=80)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(key))
    return rows.join(gone.hint("merge"), key, "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows of 20 words go; a text of nothing else goes as a whole.

    Every row is a document of its own; where ids are null or repeat, rows count in the order read.
    """
    small_batches(spark)
    rows, key = with_keys(docs)
    cut = unused("_cut", rows.columns)
    changed = stage(
        repeats.remove_repeats(rows.select(F.col(key).alias("doc_id"), "text")).where("n_removed > 0").select(
            F.col("doc_id").alias(key),
            F.struct(F.col("kept_text").alias("text"), (F.col("n_removed") == F.col("n_words")).alias("gone")).alias(cut),
        ),
        "cut",
    )
    joined = rows.join(changed.hint("merge"), key, "left").where(F.col(cut).isNull() | ~F.col(cut)["gone"])
    text = F.coalesce(F.col(cut)["text"], F.col("text"))
    values = {"text": text, "n_chars": F.when(F.col(cut).isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))}
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight, to 150 % of the words; documents repeat or are left out as the mix says."""
    # names that cannot meet those of the operator
    names = [c if c in ("doc_id", "text", "source", "n_chars") else f"column {i}" for i, c in enumerate(docs.columns)]
    return mixing.mix_documents(docs.toDF(*names)).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece of a document."""
    small_batches(spark)
    return packing.best_fit_packing(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]

# a trained classifier, tokenizers and packing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
