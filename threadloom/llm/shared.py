"""What several operators need: unique ids, packed exchange by hash, connected components."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.sources.tables import stage

EXCHANGE_BYTES = 16 << 20


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(df: DataFrame, column: str) -> int:
    """Buckets of hashes, so that what one bucket gets from the column's bytes stays bounded."""
    size = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(partitions(df), size // EXCHANGE_BYTES + 1)


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per id: rows without id are left out, and of rows that share an id (repeated rows)
    the one with the smallest text stays. The check for shared ids reads the ids alone."""
    named = docs.where(F.col(key).isNotNull())
    twice = docs.select(key).groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
    if twice.isEmpty():
        return docs
    others = [c for c in docs.columns if c not in (key, text)]
    best = named.groupBy(key).agg(F.min(F.struct(text, *others)).alias("_row"))
    return best.select(key, "_row.*").select(*docs.columns)


def keyed(docs: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
    """The rows with a long column ``name`` that differs in every one: the id where ids are unique
    and not null (a check that reads the ids alone), else a number written beside a copy of the rows,
    so that a task that runs again finds the same one."""
    twice = docs.select(key).groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
    if twice.isEmpty():
        return docs.withColumn(name, F.col(key).cast("long"))
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "keyed")


def packed(bucket: np.ndarray, count: int, columns: dict[str, np.ndarray]) -> dict[str, list]:
    """Rows cut by bucket: for each bucket that has any, the bytes of its part of each column."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(count + 1))
    used = np.flatnonzero(np.diff(edges))
    out: dict[str, list] = {"bucket": used.tolist()}
    for name, values in columns.items():
        values = np.ascontiguousarray(values[order])
        out[name] = [values[edges[b] : edges[b + 1]].tobytes() for b in used]
    return out


def unpacked(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column if x.is_valid), kind)


def table_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the schema; columns not given are null."""
    n = len(next(iter(columns.values())))
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def stars(edges: DataFrame) -> DataFrame:
    """Links ``(a, b)``, a < b, that connect the same ids as ``edges`` do, and never more of them.

    An id keeps the link to its smallest neighbour; its other smaller neighbours are linked to that
    one instead of to the id. Where many ids share the same neighbours, these links coincide.
    """
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    smallest = links.groupBy("b").agg(F.min("a").alias("m"))
    other = F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a"))
    return links.join(smallest, "b").select(F.col("m").alias("a"), other.alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest id reachable over undirected links.

    ``edges`` has two long columns ``a`` and ``b``; the result has ``id`` and ``component`` for
    every id in them. The links become ``stars`` first, so that members of a dense group do not
    bring all links of the group to every round. Each round hooks every label to the smallest label among its neighbours and
    then shortens all paths by following labels of labels. Rounds read the labels that the round
    before wrote to the shared folder. Rows with a null end are ignored; an empty table gives an
    empty table.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    starred = stage(stars(edges), name + "-stars")
    links = stage(starred.union(starred.select(F.col("b"), F.col("a"))), name + "-links")
    labels = stage(
        links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        .select("id", F.least("id", "m").alias("component")),
        name,
    )
    while True:
        near = (
            links.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        hooked = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "m").alias("low")
        )
        # the label's own row may know a smaller one: its old label's best offer, then that label's
        offer = hooked.groupBy(F.col("old").alias("root")).agg(F.min("low").alias("offer"))
        jumped = hooked.join(offer, hooked["old"] == offer["root"]).select(
            "id", "old", F.least("low", "offer").alias("component")
        )
        above = labels.select(F.col("id").alias("component"), F.col("component").alias("top"))
        moved = jumped.join(above, "component").select(
            "id", F.least("component", "top").alias("component"),
            (F.least("component", "top") != F.col("old")).alias("changed"),
        )
        moved = stage(moved, name)
        labels = moved.select("id", "component")
        if moved.where("changed").isEmpty():
            return labels


def arrow_map(df: DataFrame, function, schema, **given) -> DataFrame:
    return df.mapInArrow(functools.partial(function, **given), schema)
