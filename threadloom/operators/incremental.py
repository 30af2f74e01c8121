"""Resumable work: process what is not in the output yet, and append it.

The output is a table of runs. A run's rows are written to a folder of their own, and only a small
file in the log of commits makes them count. What a lost driver or a stopped job leaves behind is
never read, and the run that takes its place writes over it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_BUCKET = "_bucket"
BY = ((_BUCKET, T.IntegerType()),)


class RunLog:
    """Committed runs of rows at ``path``: ``runs/_run=<name>`` holds rows, ``commits/<name>`` says
    that they count, of which columns they are, and which runs they replace. Rows are laid out in
    folders by the columns ``by``, which they must have."""

    def __init__(self, spark: SparkSession, path: str, by: tuple[tuple[str, T.DataType], ...] = BY):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._channels = jvm.java.nio.channels.Channels
        self._charset = jvm.java.nio.charset.StandardCharsets.UTF_8

    def _names(self) -> list[str]:
        folder = self._path(f"{self.path}/commits")
        if not self._files.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(folder))

    def _commit(self, name: str) -> dict:
        stream = self._files.open(self._path(f"{self.path}/commits/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def committed(self, name: str) -> bool:
        return self._files.exists(self._path(f"{self.path}/commits/{name}"))

    def runs(self) -> list[str]:
        """The runs whose rows make up the table, oldest name first."""
        names = self._names()
        gone = {old for name in names if name.startswith("merged-") for old in self._commit(name)["replaces"]}
        return [n for n in names if n not in gone]

    def next_name(self) -> str:
        """A number after all that were committed; a run that was not keeps it for the next try."""
        return f"run-{sum(n.startswith('run-') for n in self._names()):08d}"

    def read(self, schema: T.StructType | None = None) -> DataFrame | None:
        """All rows that count, with their folder columns; columns as given, or as the latest run has them.
        Before the first run, an empty table of ``schema`` (None if not given)."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        if schema is None:
            schema = T.StructType.fromJson(self._commit(runs[-1])["schema"])
        folders = [T.StructField(name, kind) for name, kind in self.by]
        fields = [f for f in schema.fields if f.name not in {name for name, _ in self.by}]
        reader = self.spark.read.option("basePath", f"{self.path}/runs")
        reader = reader.schema(T.StructType([*fields, *folders]))
        return reader.parquet(*[f"{self.path}/runs/_run={n}" for n in runs]).drop("_run")

    def write(self, df: DataFrame, name: str) -> None:
        """Write a run's rows, which do not count until :meth:`commit`."""
        df.write.mode("overwrite").partitionBy(*[name for name, _ in self.by]).parquet(f"{self.path}/runs/_run={name}")

    def commit(self, name: str, schema: T.StructType, replaces: tuple[str, ...] = ()) -> None:
        """Make a written run count. Of two jobs that commit one name, the second fails."""
        stream = self._files.create(self._path(f"{self.path}/commits/{name}"), False)
        try:
            stream.write(bytearray(json.dumps({"replaces": list(replaces), "schema": schema.jsonValue()}).encode()))
        finally:
            stream.close()

    def append(self, df: DataFrame, name: str) -> None:
        """Write and commit a run, unless it was committed before."""
        if not self.committed(name):
            self.write(df, name)
            self.commit(name, df.schema)

    def merge(self, rows: DataFrame | None = None) -> None:
        """Put the rows of all runs, or what is given for them, into one run, so that a long log
        stays quick to read."""
        runs = self.runs()
        if len(runs) > 1:
            name = f"merged-{sum(n.startswith('merged-') for n in self._names()):08d}"
            # as many files as folders: rows of a folder come together
            rows = (self.read() if rows is None else rows).repartition(*[c for c, _ in self.by])
            self.write(rows, name)
            self.commit(name, rows.schema, tuple(runs))


def bucket(row_id: str) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(BUCKETS)).cast("int")


def _sortable(field: T.StructField) -> Column:
    text = field.dataType.simpleString()
    return F.to_json(F.struct(field.name)) if "map<" in text or "variant" in text else F.col(field.name)


def unique_rows(df: DataFrame, row_id: str) -> DataFrame:
    """One row of each id: the smallest by the other columns in their order. Rows without id, which
    could not be found again, are left out."""
    others = [f for f in df.schema.fields if f.name != row_id]
    named = df.where(F.col(row_id).isNotNull())
    if not others:
        return named.distinct()
    row = F.struct(*[f.name for f in others])
    best = named.groupBy(row_id).agg(F.min_by(row, F.struct(*[_sortable(f) for f in others])).alias("_row"))
    return best.select(row_id, "_row.*").select(*df.columns)


def pending(source: DataFrame, done: DataFrame, row_id: str) -> DataFrame:
    """Rows of ``source`` whose id is not in ``done``; the smallest one of each id, if ids repeat."""
    return unique_rows(source.join(done.select(row_id), row_id, "left_anti").select(*source.columns), row_id)


def add_run(
    log: RunLog, source: DataFrame, row_id: str, work: Callable[[DataFrame], DataFrame], name: str, few: bool = False
) -> None:
    """Commit ``work`` of the rows that the log lacks as one run. ``few`` rows look up only those
    buckets of the stored ids that they fall into."""
    if log.committed(name):
        return
    done = log.read()
    if done is None:
        todo = unique_rows(source, row_id)
    else:
        if few:
            mine = [r[0] for r in source.select(bucket(row_id)).distinct().collect()]  # at most BUCKETS
            done = done.where(F.col(_BUCKET).isin(mine))
        todo = pending(source, done, row_id)
    made = work(todo).withColumn(_BUCKET, bucket(row_id))
    # one file a bucket from a few rows; many rows are written where they are
    log.append(made.repartition(_BUCKET) if few else made, name)


def resume(
    source: DataFrame, path: str, row_id: str, work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run ``work`` on the rows that the output at ``path`` lacks, append, return all."""
    log = RunLog(source.sparkSession, path)
    add_run(log, source, row_id, work, log.next_name())
    return log.read().drop(_BUCKET)
