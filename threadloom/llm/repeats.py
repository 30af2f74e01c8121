"""Operator 10: repeated word windows removed, found by level-wise doubling.

Every window of ``window`` words has one place of its own for each shorter length: the part of
that length with the smallest hash. Equal windows have equal parts there, so a window can only
repeat if its part occurs at a second place.

* Level 1 takes the parts of length ``start`` (about one place in six for 10 of 20 words) and
  looks for those that occur twice in the corpus.
* Each next level doubles the length and looks only at windows whose part was repeated, until the
  length is that of the window, or no candidates survive.
* At the last level every sequence of words has a first occurrence (smallest id, then smallest
  start); all other windows with it are removed, and the words under them.

Places go to the bucket of their hash as packed arrays and come back to that of their document. A task
forwards one place per hash and run of texts: a passage that a third of all documents contain is
known as repeated before it is sent, so its bucket gets one entry per run, not per occurrence. What a
run knows of its own texts goes to a bucket of its own, spread evenly over tasks and runs.

Defined cases: rows without id take no part; of rows that share an id the one with the smallest
text counts. Null or empty texts, or texts without words, have no words and an empty text left.
Texts shorter than a window lose nothing. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.shared import arrow_map, buckets_for, identified, packed, table_of, unpacked
from threadloom.llm.words import Words, chunks, mix, strings, window_hashes
from threadloom.sources.tables import stage

WINDOW, START = 20, 10

# what a packed row holds: places to be compared by hash, places known to be repeated, or the
# description of documents
PLACES, KNOWN, DOCUMENTS = 0, 1, 2
_PACKED = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("hash", pa.binary()), ("doc", pa.binary()),
     ("pos", pa.binary()), ("many", pa.binary()), ("words", pa.binary()), ("sha", pa.binary())]
)
_PACKED_SQL = (
    "kind int, bucket int, hash binary, doc binary, pos binary, many binary, words binary, sha binary"
)
_FOUND = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("doc", pa.binary()), ("pos", pa.binary()),
     ("doc_id", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string())]
)
_FOUND_SQL = "kind int, bucket int, doc binary, pos binary, doc_id bigint, n_words bigint, sha string"


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, where in ``values[place : place + width]`` the first smallest one stands."""
    best, at, size = values, np.arange(len(values)), 1

    def lower(a, i, b, j):
        take = b < a
        return np.where(take, b, a), np.where(take, j, i)

    while 2 * size <= width:
        best, at = lower(best[:-size], at[:-size], best[size:], at[size:])
        size *= 2
    rest = width - size
    if rest:
        n = len(values) - width + 1
        best, at = lower(best[:n], at[:n], best[rest : rest + n], at[rest : rest + n])
    return at


def parts(words: Words, hashes: np.ndarray, window: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the start of each one's part, and the hashes by start of a part."""
    starts = np.flatnonzero(words.inside(window))
    part = window_hashes(hashes, length)
    if not len(starts):
        return starts, starts, part
    return starts, _smallest(part, window - length + 1)[starts], part


def _exchange(hashes, docs, pos, many, count: int) -> Iterator[pa.RecordBatch]:
    bucket = (hashes >> np.uint64(32)) % np.uint64(count)
    columns = packed(bucket.astype(np.int64), count, {"hash": hashes, "doc": docs, "pos": pos, "many": many})
    if columns["bucket"]:
        yield table_of({"kind": [PLACES] * len(columns["bucket"])} | columns, _PACKED)


def _known(docs, pos, bucket: int) -> Iterator[pa.RecordBatch]:
    if len(docs):
        yield table_of(
            {"kind": [KNOWN], "bucket": [bucket], "doc": [docs.tobytes()], "pos": [pos.tobytes()]}, _PACKED
        )


def own_buckets(task: int, count: int) -> Iterator[int]:
    """A bucket for each run of texts of a task: one after another, from a start that steps through
    the buckets by the golden section from task to task, so that no stretch of them is preferred."""
    start = task * 0.6180339887498949 % 1 * count
    return (int(start + run) % count for run in itertools.count())


def _own_buckets(count: int) -> Iterator[int]:
    return own_buckets(TaskContext.get().partitionId(), count)


def _first_level(batches: Iterator, window: int, length: int, count: int) -> Iterator:
    own = _own_buckets(count)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for texts in chunks(batch.column(1)):
            bucket = next(own)
            words = Words(texts)
            mine = ids[texts.first : texts.first + len(texts)].astype(np.int64)
            data, offsets = words.joined(np.ones(len(words), bool))
            sha = b"".join(hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets, offsets[1:]))
            yield table_of(
                {"kind": [DOCUMENTS], "bucket": [bucket], "doc": [mine.tobytes()],
                 "words": [words.count.astype(np.int64).tobytes()], "sha": [sha]}, _PACKED,
            )
            _, part, part_hashes = parts(words, words.hashes(lower=False), window, length)
            at = np.unique(part)
            yield from _repeated_or_sent(words, mine, at, part_hashes[at], bucket, count)


def _repeated_or_sent(words: Words, mine, at, hashes, bucket: int, count: int) -> Iterator:
    """Places with a hash that this run of texts has twice are known as repeated; one of each
    goes out all the same, marked as many, for the runs that have it once."""
    order = np.argsort(hashes, kind="stable")
    at, hashes = at[order], hashes[order]
    first = np.ones(len(at), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    group = np.cumsum(first) - 1
    many = np.bincount(group, minlength=1)[group] > 1 if len(at) else np.zeros(0, bool)
    docs, pos = mine[words.text[at]], (at - words.first[words.text[at]]).astype(np.int32)
    yield from _known(docs[many], pos[many], bucket)
    # a stable sort keeps places in order, so what goes out is in order of document per bucket
    back = np.sort(np.flatnonzero(first))
    yield from _exchange(hashes[back], docs[back], pos[back], many[back].astype(np.uint8), count)


def _level(batches: Iterator, window: int, length: int, count: int) -> Iterator:
    """A later level: candidate windows are those whose part of half the length was repeated."""
    own = _own_buckets(count)
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        found = batch.column(2)
        for texts in chunks(batch.column(1)):
            bucket = next(own)
            words = Words(texts)
            mine = ids[texts.first : texts.first + len(texts)].astype(np.int64)
            hashes = words.hashes(lower=False)
            starts, part, _ = parts(words, hashes, window, length // 2)
            alive = np.zeros(len(words) + 1, bool)
            for i in range(len(texts)):
                places = np.frombuffer(found[texts.first + i].as_py(), np.int32)
                alive[words.first[i] + places] = True
            starts = starts[alive[part]]
            if length < window:
                _, part, part_hashes = parts(words, hashes, window, length)
                at = np.unique(part[np.isin(np.flatnonzero(words.inside(window)), starts)])
                yield from _repeated_or_sent(words, mine, at, part_hashes[at], bucket, count)
            else:
                whole = window_hashes(hashes, window)[starts]
                yield from _first_or_known(words, mine, starts, whole, bucket, count)


def _first_or_known(words: Words, mine, at, hashes, bucket: int, count: int) -> Iterator:
    """Of the windows with one hash in this run of texts, the first may be the first of all; the
    others are known to be preceded."""
    docs, pos = mine[words.text[at]], (at - words.first[words.text[at]]).astype(np.int32)
    order = np.lexsort((pos, docs, hashes))
    hashes, docs, pos = hashes[order], docs[order], pos[order]
    first = np.ones(len(order), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    rest = np.lexsort((pos[~first], docs[~first]))
    yield from _known(docs[~first][rest], pos[~first][rest], bucket)
    send = np.flatnonzero(first)
    send = send[np.lexsort((pos[send], docs[send]))]
    yield from _exchange(hashes[send], docs[send], pos[send], np.zeros(len(send), np.uint8), count)


def _by_document(table: pa.Table) -> pa.Table:
    """The places of each document of one bucket, as one row per document."""
    docs, pos = unpacked(table.column("doc"), np.int64), unpacked(table.column("pos"), np.int32)
    order = np.argsort(docs, kind="stable")
    docs, pos = docs[order], np.ascontiguousarray(pos[order])
    at = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    ends = np.append(at[1:], len(docs))
    places = pa.array([pos[a:b].tobytes() for a, b in zip(at, ends)], pa.binary())
    return pa.table({"doc_id": docs[at], "places": places})


def _settle(table: pa.Table, last: bool, count: int) -> pa.Table:
    """One bucket: repeated places (or, at the last level, all but the first place of a hash)."""
    kind = table.column("kind").to_numpy()
    out = []
    described = table.filter(pa.array(kind == DOCUMENTS))
    if len(described):
        docs = unpacked(described.column("doc"), np.int64)
        sha = b"".join(x.as_py() for x in described.column("sha"))
        out.append(
            table_of(
                {"kind": [DOCUMENTS] * len(docs), "doc_id": docs.tolist(),
                 "n_words": unpacked(described.column("words"), np.int64).tolist(),
                 "sha": [sha[32 * i : 32 * i + 32].hex() for i in range(len(docs))]}, _FOUND,
            )
        )
    known = table.filter(pa.array(kind == KNOWN))
    docs, pos = [unpacked(known.column("doc"), np.int64)], [unpacked(known.column("pos"), np.int32)]
    sent = table.filter(pa.array(kind == PLACES))
    h = unpacked(sent.column("hash"), np.uint64)
    d, p = unpacked(sent.column("doc"), np.int64), unpacked(sent.column("pos"), np.int32)
    many = unpacked(sent.column("many"), np.uint8).astype(bool)
    order = np.lexsort((p, d, h)) if last else np.argsort(h, kind="stable")
    h, d, p, many = h[order], d[order], p[order], many[order]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    if last:
        use = ~first
    elif len(h):
        group = np.cumsum(first) - 1
        # what a run marked as many, that run has already returned
        use = (np.bincount(group)[group] > 1) & ~many
        use |= (np.bincount(group, weights=many)[group] > 0) & ~many
    else:
        use = first
    docs, pos = np.concatenate([*docs, d[use]]), np.concatenate([*pos, p[use]])
    bucket = (mix(docs.view(np.uint64)) >> np.uint64(32)) % np.uint64(count)
    rows = packed(bucket.astype(np.int64), count, {"doc": docs, "pos": pos})
    if rows["bucket"]:
        out.append(table_of({"kind": [KNOWN] * len(rows["bucket"])} | rows, _FOUND))
    return pa.Table.from_batches(out, schema=_FOUND)


def _settled(places: DataFrame, last: bool, count: int) -> DataFrame:
    def settle(table: pa.Table) -> pa.Table:
        return _settle(table, last, count)

    return stage(places.groupBy("bucket").applyInArrow(settle, _FOUND_SQL), "level")


def _places(found: DataFrame) -> DataFrame:
    """``(doc_id, places)``: they come packed by bucket of their document."""
    sent = found.where(F.col("kind") == KNOWN).select("bucket", "doc", "pos")
    return sent.groupBy("bucket").applyInArrow(_by_document, "doc_id bigint, places binary")


def _cut(batches: Iterator, window: int) -> Iterator:
    schema = pa.schema([("doc_id", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha", pa.string())])
    for batch in batches:
        removed = batch.column(2)
        for texts in chunks(batch.column(1)):
            words = Words(texts)
            edge = np.zeros(len(words) + window + 1, np.int64)
            for i in range(len(texts)):
                places = np.unique(np.frombuffer(removed[texts.first + i].as_py(), np.int32)) + words.first[i]
                edge[places] += 1
                edge[places + window] -= 1
            keep = np.cumsum(edge)[: len(words)] == 0
            data, offsets = words.joined(keep)
            sums = np.concatenate([[0], np.cumsum(~keep)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(texts.first, len(texts)),
                    pa.array(sums[words.first[1:]] - sums[words.first[:-1]], pa.int64()),
                    strings(data, offsets),
                    pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:])]),
                ],
                schema=schema,
            )


def remove_repeats(docs: DataFrame, window: int = WINDOW, start: int = START) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept_text)`` for every document.

    ``kept_text`` is null where nothing was removed, else the kept words joined by one space.
    ``window`` must be ``start`` doubled once or more.
    """
    if window <= start or window % start or (window // start) & (window // start - 1):
        raise ValueError("the window must be the first length doubled once or more")
    docs = identified(docs).where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    count = buckets_for(docs, "text")
    given = {"window": window, "count": count}
    found = _settled(arrow_map(docs, _first_level, _PACKED_SQL, length=start, **given), False, count)
    described = found.where(F.col("kind") == DOCUMENTS).select("doc_id", "n_words", "sha")
    length, texts = start, docs
    while length < window:
        length *= 2
        texts = stage(texts.join(_places(found).hint("merge"), "doc_id").select("doc_id", "text", "places"), "candidates")
        places = arrow_map(texts, _level, _PACKED_SQL, length=length, **given)
        found = _settled(places, length == window, count)
        texts = texts.select("doc_id", "text")
    cut = arrow_map(
        texts.join(_places(found).hint("merge"), "doc_id").select("doc_id", "text", "places"), _cut,
        "doc_id bigint, n_removed bigint, kept_text string, kept_sha string", window=window,
    )
    return described.join(cut, "doc_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"), "kept_text",
    )


SQL = """
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM tokens),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i+19], ' ')) AS h FROM starts),
late AS (
  SELECT doc_id, i FROM (
    SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS p FROM late),
lists AS (SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])),
      lambda x: x[1]) END, ' ')) AS kept_sha256
FROM tokens LEFT JOIN lists USING (doc_id)
"""
