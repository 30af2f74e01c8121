"""Parquet tables, the working folder, and intermediate tables staged there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet sink, also used for vector tables and report tables."""
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an expensive intermediate table once and go on from its copy.

    Later plans read only the columns and rows they need, and lost executors do not bring the
    whole derivation back.
    """
    path = work_folder(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path, df.schema)


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    spark = staged.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in staged.inputFiles()}
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if folder.split("/")[-2] == session_folder(spark).rsplit("/", 1)[-1]:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach, below the session's own working folder."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def session_folder(spark: SparkSession) -> str:
    """Where a session keeps its staged tables: below ``spark.checkpoint.dir``, or, where that is
    not set, below the warehouse, which a cluster shares as well."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/threadloom-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete every staged table of the session. Call it when no result that reads one is needed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
