"""CSV files with quoted line breaks, read by many tasks.

A byte range cannot tell by itself whether it begins inside a quoted field. Every range counts its
quotes; the number of quotes in the ranges before it says which of its line breaks end a record. So:

1. each range is read as lines and reduced to one row: whether its quotes are odd, and, for either
   case, where its last record begins;
2. these rows, a few per gigabyte, are put in order per file: running parity, and for a range that
   begins inside a record the place where that record began;
3. the lines are read again. A line that is a record by itself, as most are, is parsed where it was
   read; only the lines of records that span lines are shuffled and joined.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.sources.staging import stage

# as many ranges (some 32 TB at 128 MB each) may be broadcast to the second read
BROADCAST_RANGES = 1 << 18


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _walk(batches: Iterator):
    """For every stretch of lines of one range: the rows, range, first line's number, quotes, parity
    of the range's quotes before each line, and for both cases the latest line so far that would
    begin a record (-1: none). Rows of a range come in order and one after the other."""
    import numpy as np
    import pyarrow.compute as pc

    at, line, odd, last = None, 0, 0, [-1, -1]
    for batch in batches:
        files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        quotes = pc.fill_null(pc.count_substring(batch.column(0), '"'), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = [0, *(i for i in range(1, len(files)) if (files[i], starts[i]) != (files[i - 1], starts[i - 1])), len(files)]
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            if (files[low], starts[low]) != at:
                at, line, odd, last = (files[low], starts[low]), 0, 0, [-1, -1]
            mine = quotes[low:high]
            upto = odd + np.cumsum(mine)
            parity = (upto - mine) & 1
            number = line + np.arange(high - low)
            begun = [np.maximum.accumulate(np.maximum(np.where(parity == side, number, -1), last[side])) for side in (0, 1)]
            yield batch.slice(low, high - low), at, number, mine, parity, begun
            line, odd, last = line + high - low, int(upto[-1]) & 1, [int(b[-1]) for b in begun]


def _summary(batches: Iterator) -> Iterator:
    import pyarrow as pa

    ranges: dict = {}
    for _, at, number, quotes, parity, begun in _walk(batches):
        ranges[at] = (int(parity[-1] + quotes[-1]) & 1, int(begun[0][-1]), int(begun[1][-1]))
    if ranges:
        rows = [(*at, *seen) for at, seen in ranges.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "start", "odd", "last0", "last1"])


def _marked(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for rows, _, number, quotes, parity, begun in _walk(batches):
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(number), pa.array(quotes & 1), pa.array(parity), *map(pa.array, begun)],
            names=["value", "file", "start", "line", "odd", "parity", "begun0", "begun1"],
        )


def _ranges(lines: DataFrame) -> DataFrame:
    """``(file, start, inside, from_start, from_line)``: whether a range begins inside quotes, and
    where the record that it begins in began."""
    rows = lines.mapInArrow(_summary, "file string, start long, odd long, last0 long, last1 long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    begin = F.when(last >= 0, F.struct("start", last.alias("line")))
    known = inside.withColumn("_from", F.last(begin, ignorenulls=True).over(before))
    return known.select("file", "start", "inside", F.col("_from.start").alias("from_start"), F.col("_from.line").alias("from_line"))


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``(value)``: the records of the CSV files at ``path`` as text, without headers and empty lines.

    Quotes have to enclose fields, doubled inside them. Lines end with LF or CR LF; line breaks inside
    fields stay as they are.
    """
    lines = _lines(spark, path)
    ranges = stage(_ranges(lines), "csv-ranges")
    known = ranges.select(*[F.col(c).alias("_" + c) for c in ranges.columns])
    if ranges.count() <= BROADCAST_RANGES:
        known = F.broadcast(known)
    marked = lines.mapInArrow(
        _marked, "value string, file string, start long, line long, odd long, parity long, begun0 long, begun1 long"
    ).join(known, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
    begun = F.when(F.col("_inside") == 0, F.col("begun0")).otherwise(F.col("begun1"))
    owner = F.when(begun >= 0, F.struct(F.col("start").alias("s"), begun.alias("l"))).otherwise(
        F.struct(F.col("_from_start").alias("s"), F.col("_from_line").alias("l"))
    )
    placed = marked.select("value", "file", "start", "line", owner.alias("owner"), (
        (F.col("parity") == F.col("_inside")) & (F.col("odd") == 0)
    ).alias("whole"))
    if header:
        placed = placed.where((F.col("owner.s") > 0) | (F.col("owner.l") > 0))
    joined = placed.where(~F.col("whole")).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("_lines")
    ).select(F.array_join("_lines.value", "\n").alias("value"))
    both = placed.where("whole").select("value").union(joined)
    text = F.when(F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return both.select(text.alias("value")).where("value != ''")


def read(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The records, parsed by the schema."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", F.lit(fields), {"quote": '"', "escape": '"'})
    return records(spark, path, header).select(parsed.alias("_row")).select("_row.*")
