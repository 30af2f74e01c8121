"""Scans and sinks: CSV, JSON lines, JSON arrays, vector tables, and the working folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.sources import quoted_csv
from threadloom.sources.staging import (  # noqa: F401
    read_table, release, session_folder, stage, work_folder, write_table,
)

# words that the usual CSV readers of the Python world take as missing (fixed values)
COMMON_MISSING_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, missing: Sequence[str] = (),
    stray_quotes: bool = False,
) -> DataFrame:
    """CSV with header, quoted line breaks and doubled quotes.

    Empty fields are NULL, and so are the words in ``missing``. Large files are read in byte ranges,
    which takes quotes at their word. Files with quotes inside unquoted fields need
    ``stray_quotes``; then one task reads a whole file.
    """
    if stray_quotes:
        raw = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .csv(path)
        )
    else:
        raw = quoted_csv.read(spark, path, schema)
    gone = ["", *missing]
    return raw.select(
        *[
            F.when(~F.col(f.name).isin(gone), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def land_csv(
    spark: SparkSession, path: str, schema: T.StructType, out: str, missing: Sequence[str] = ()
) -> DataFrame:
    """Copy a CSV source to Parquet once and return the Parquet table."""
    read_csv(spark, path, schema, missing).write.mode("overwrite").parquet(out)
    return spark.read.schema(schema).parquet(out)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with header, every field quoted, quotes doubled, outer blanks kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file that is one JSON list of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
