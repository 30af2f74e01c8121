"""Incremental triage with Structured Streaming: files in, triaged rows appended to a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from threadloom.operators.incremental import RunLog, add_run

# so many micro-batches are merged into one run
MERGE_EVERY = 100


def read_new_files(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet"
) -> DataFrame:
    """A stream of the Parquet files in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def drop_seen(stream: DataFrame, row_id: str, event_time: str, delay: str = "1 day") -> DataFrame:
    """Keep the first row of every id as far back as ``delay`` before the watermark; the state holds
    no older ids."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([row_id])


def run_available(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    row_id: str = "message_id",
    event_time: str | None = None,
    progress: list | None = None,
) -> DataFrame:
    """Process all files that arrived since the last run and return the output table.

    An id is triaged once, ever: a micro-batch is compared with the ids stored in the output, of which
    it reads the buckets it needs, so the stream itself remembers none. With an event time, the state
    of :func:`drop_seen` takes early repeats out first. A micro-batch is one run of the output
    (:class:`RunLog`), named by its number, so the job may be stopped or lose executors at any point
    and be run again: a repeated micro-batch is not added twice. ``progress`` collects the query's
    progress reports.
    """
    log = RunLog(stream.sparkSession, out)
    schema = work(stream).schema

    def add(rows: DataFrame, number: int) -> None:
        add_run(log, rows, row_id, work, f"batch-{number:012d}", few=True)
        if number % MERGE_EVERY == MERGE_EVERY - 1:
            log.merge()

    fresh = stream if event_time is None else drop_seen(stream, row_id, event_time)
    query = (
        fresh.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if progress is not None:
        progress.extend(query.recentProgress)
    return log.read(schema).select(*schema.names)
