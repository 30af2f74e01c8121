"""Operator 3: near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. *Signatures.* Each task hashes the shingles of its documents and takes 128 minima per document.
   Bands of 4 minima give 32 candidate keys; the low 4 bits of every minimum are packed, bit by
   bit, into 8 longs. Documents with the same shingle set are folded into the smallest id first.
2. *Candidates.* A document meets the smallest id of each of its bands' buckets. The similarity of
   such a pair is estimated from the bit counts of the packed signatures, corrected for low bits
   that agree by chance, and a pair of at least ``near`` is kept. Members that are ``COVERED`` by
   the smallest id are done with that bucket. All others of a bucket then meet each other, in
   tiles, and pairs of at least ``near + 1 - COVERED`` are kept. What is connected is a family.
   Every linked pair that shares a bucket and is estimated at 0.6 or more lies within one: one
   minus the estimate is a metric, so if one of the two is covered, both are near the smallest id,
   and if none is, they meet.
3. *Links.* The full sets of a family are compared exactly, in tiles of about ``TILE`` by
   ``TILE`` documents, or fewer where these have more than ``TILE_SHINGLES`` shingles, each tile a
   task of its own. A tile returns a spanning forest of its links,
   so that families of many near copies yield no pairs beyond their number of documents.
4. *Groups.* Connected components of these links, by rounds in Spark.

With similarity 0.8 a pair shares no band with a probability of 5e-8, and its estimate is below
0.6 with one of about 1e-7 (5.3 standard deviations).

Defined cases: rows without id take no part; of rows that share an id the one with the smallest
text counts. Null or empty texts, or texts without a word, have an empty set and no link. A text
with fewer words than a shingle is one shingle. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.shared import arrow_map, components, identified
from threadloom.llm.words import Words, chunks, mix, window_hashes
from threadloom.sources.tables import stage

SLOTS, ROWS, BITS = 128, 4, 4
BANDS = SLOTS // ROWS
WORDS64 = SLOTS // 64 * BITS
NEAR = 0.45
COVERED = 0.85
TILE = 512
TILE_SHINGLES = 1 << 20
# a worker takes the shingles of texts of about so many bytes at a time: some 30 bytes for each of them
CHUNK = 1 << 18

_rng = np.random.default_rng(77)
_MULTIPLY = _rng.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_BAND = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, and the first one of each text."""
    hashes = words.hashes(lower=True)
    inside = words.inside(width)
    windows = window_hashes(hashes, width)
    inside_at = np.flatnonzero(inside)
    all_texts, all_hashes = [words.text[inside_at]], [windows[inside_at]]
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for place in range(width - 1):
            has = words.count[short] > place
            value[has] = mix(value[has] * np.uint64(0x9FB21C651E98DF25) + hashes[words.first[short[has]] + place])
        # a short text is no window of another: its length goes into the hash
        all_texts.append(short)
        all_hashes.append(mix(value + words.count[short].astype(np.uint64)))
    text, value = np.concatenate(all_texts), np.concatenate(all_hashes)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, value = text[fresh], value[fresh]
    return value, np.searchsorted(text, np.arange(len(words.texts) + 1))


def minima(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[text, slot] smallest value of each hash function; texts must not be empty."""
    out = np.empty((len(first) - 1, SLOTS), np.uint64)
    step = np.empty_like(values)
    for slot in range(SLOTS):
        np.multiply(values, _MULTIPLY[slot], out=step)
        np.add(step, _ADD[slot], out=step)
        out[:, slot] = np.minimum.reduceat(step, first[:-1])
    return out


def low_bits(minimum: np.ndarray) -> np.ndarray:
    """Low bits packed into longs: first all lowest bits, then all second bits, and so on."""
    mixed = mix(minimum)
    planes = [
        np.packbits((mixed >> np.uint64(bit) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
        for bit in range(BITS)
    ]
    return np.concatenate([p.view("<i8") for p in planes], axis=1)


_SKETCH = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
     ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
)
_SKETCH_SQL = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bits array<bigint>, bands array<bigint>"


def _sketch(batches: Iterator, width: int) -> Iterator:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for texts in chunks(batch.column(1), CHUNK):
            values, first = shingles(Words(texts), width)
            count = np.diff(first)
            mine = ids[texts.first : texts.first + len(texts)]
            used = np.flatnonzero(count)
            sums = np.zeros((2, len(texts)), np.uint64)
            bits = np.zeros((len(texts), WORDS64), np.int64)
            bands = np.zeros((len(texts), BANDS), np.int64)
            if len(used):
                starts = first[:-1][used]
                sums[0, used] = np.add.reduceat(mix(values), starts)
                sums[1, used] = np.add.reduceat(mix(values ^ np.uint64(0xA0761D6478BD642F)), starts)
                low = minima(values, np.append(starts, len(values)))
                bits[used] = low_bits(low)
                keys = mix((low.reshape(-1, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                bands[used] = keys.view(np.int64)
            # texts without a shingle have no band
            ends = np.concatenate([[0], np.cumsum(np.where(count > 0, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mine, pa.int64()), pa.array(count, pa.int64()),
                    pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                    pa.ListArray.from_arrays(np.arange(0, (len(texts) + 1) * WORDS64, WORDS64, dtype=np.int32), bits.ravel()),
                    pa.ListArray.from_arrays(ends, bands[used].ravel()),
                ],
                schema=_SKETCH,
            )


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n_shingles, d1, d2, bits, bands)``; d1 and d2 are equal for equal sets."""
    return arrow_map(docs.select("doc_id", "text"), _sketch, _SKETCH_SQL, width=width)


def estimate(a, b) -> F.Column:
    """Similarity from two packed signatures, corrected for agreement by chance."""
    halves = SLOTS // 64
    differ = [
        F.bit_count(
            F.expr(" | ".join(f"({a}[{half + halves * bit}] ^ {b}[{half + halves * bit}])" for bit in range(BITS)))
        )
        for half in range(halves)
    ]
    agree = 1 - sum(differ[1:], differ[0]) / F.lit(float(SLOTS))
    chance = 1.0 / (1 << BITS)
    return (agree - chance) / (1 - chance)


def forest(rows: np.ndarray, columns: np.ndarray, count: int) -> tuple[list, list]:
    """Of these pairs among ``count`` places as many as connect the same places."""
    parent = list(range(count))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a, b = [], []
    for x, y in zip(rows.tolist(), columns.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            a.append(x)
            b.append(y)
    return a, b


def _near_pairs(batches: Iterator, least: float) -> Iterator:
    """Each row is a tile of a bucket: a spanning forest of its pairs estimated at ``least`` or more."""
    for batch in batches:
        a, b = [], []
        for row in range(batch.num_rows):
            ids, block, bits = (batch.column(i)[row].values.to_numpy(zero_copy_only=False) for i in range(3))
            bits = np.frombuffer(b"".join(bits), ">i8").astype(np.uint64).reshape(len(ids), BITS, -1)
            left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
            differ = np.zeros((len(left), len(right)), np.int64)
            for half in range(bits.shape[2]):
                other = np.zeros(differ.shape, np.uint64)
                for bit in range(BITS):
                    other |= bits[left, bit, half][:, None] ^ bits[right, bit, half][None, :]
                differ += np.bitwise_count(other)
            chance = 1.0 / (1 << BITS)
            rows, columns = np.nonzero((1 - differ / SLOTS - chance) / (1 - chance) >= least)
            x, y = forest(left[rows], right[columns], len(ids))
            a.append(ids[x])
            b.append(ids[y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(0, np.int64), *x]), pa.int64()) for x in (a, b)], names=["a", "b"]
        )


def families(signatures: DataFrame, near: float = NEAR, tile: int = TILE) -> DataFrame:
    """``(id, component)`` of documents that have a near candidate; one row per distinct set."""
    keyed = signatures.select("doc_id", F.explode("bands").alias("band"))
    lead = keyed.groupBy("band").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stage(
        keyed.join(lead.select("band", "a"), "band").where("doc_id != a").select("band", "a", F.col("doc_id").alias("b")),
        "met",
    )
    bits = signatures.select(F.col("doc_id").alias("_id"), F.col("bits"))
    pairs = stage(
        met.select("a", "b").distinct()
        .join(bits.select(F.col("_id").alias("a"), F.col("bits").alias("x")), "a")
        .join(bits.select(F.col("_id").alias("b"), F.col("bits").alias("y")), "b")
        .select("a", "b", estimate("x", "y").alias("estimate")).where(F.col("estimate") >= near),
        "near",
    )
    left = met.join(pairs.where(F.col("estimate") >= COVERED).select("a", "b"), ["a", "b"], "left_anti").select("band", "b")
    sized = left.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / tile).cast("int")
    )
    members = left.join(sized.select("band", "blocks"), "band").join(
        # bits as bytes, highest first
        bits.select(F.col("_id").alias("b"), F.expr("array_join(transform(bits, x -> lpad(hex(x), 16, '0')), '')").alias("x")), "b"
    ).select("band", F.col("b").alias("id"), F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "blocks", F.unhex("x").alias("x"))
    tiles = members.select(
        "band", "id", "block", "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).groupBy("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(
        F.collect_list(F.struct("id", "block", "x")).alias("rows")
    ).where(F.size("rows") > 1).select("rows.id", "rows.block", "rows.x")
    found = arrow_map(tiles, _near_pairs, "a bigint, b bigint", least=near + 1 - COVERED)
    return components(pairs.select("a", "b").union(found.distinct()), "families")


def _sets(batches: Iterator, width: int) -> Iterator:
    for batch in batches:
        for texts in chunks(batch.column(0), CHUNK):
            values, first = shingles(Words(texts), width)
            rows = [batch.column(i).slice(texts.first, len(texts)) for i in range(1, batch.num_columns)]
            data = values.tobytes()
            sets = pa.array([data[8 * a : 8 * b] for a, b in zip(first[:-1], first[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows, sets], names=[*batch.schema.names[1:], "set"])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every set on the left with every set on the right."""
    lx, rx = np.concatenate(left), np.concatenate(right)
    column = np.intersect1d(lx, rx)
    out = np.zeros((len(left), len(right)), np.int64)
    if not len(column):
        return out
    at_l, at_r = np.searchsorted(column, lx), np.searchsorted(column, rx)
    in_l = column[np.minimum(at_l, len(column) - 1)] == lx
    in_r = column[np.minimum(at_r, len(column) - 1)] == rx
    row_l = np.repeat(np.arange(len(left)), [len(x) for x in left])[in_l]
    row_r = np.repeat(np.arange(len(right)), [len(x) for x in right])[in_r]
    at_l, at_r = at_l[in_l], at_r[in_r]
    step = max(1, (4 << 20) // max(len(left), len(right)))
    for low in range(0, len(column), step):  # the columns in parts, so that memory stays bounded
        width = min(step, len(column) - low)
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        use = (at_l >= low) & (at_l < low + width)
        a[row_l[use], at_l[use] - low] = 1
        use = (at_r >= low) & (at_r < low + width)
        b[row_r[use], at_r[use] - low] = 1
        out += (a @ b.T).astype(np.int64)  # a part has at most 2**22 columns, so floats are exact
    return out


def linked(sets: list[np.ndarray], block: np.ndarray, percent: int) -> tuple[list, list]:
    """A spanning forest of the links within one tile. With two blocks, only links between them:
    links inside a block belong to that block's own tile."""
    sizes = np.array([len(s) for s in sets], np.int64)
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    common = _overlaps([sets[i] for i in left], [sets[i] for i in right])
    union = sizes[left][:, None] + sizes[right][None, :] - common
    rows, columns = np.nonzero(100 * common >= percent * union)
    return forest(left[rows], right[columns], len(sets))


def _tile(table: pa.Table, percent: int) -> pa.Table:
    sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("set")]
    a, b = linked(sets, table.column("block").to_numpy(), percent)
    ids = table.column("id")
    return pa.table({"a": ids.take(pa.array(a, pa.int64())), "b": ids.take(pa.array(b, pa.int64()))})


def links(
    docs: DataFrame, family: DataFrame, width: int, percent: int, tile: int = TILE, tile_shingles: int = TILE_SHINGLES,
) -> DataFrame:
    """Links ``(a, b)`` that connect the same documents as all links within the families do.

    ``family`` has columns ``id``, ``component`` and ``n_shingles``."""
    # blocks bounded in documents and in shingles, so that a tile of long texts fits a task too
    sized = family.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n_shingles") / tile_shingles)).cast("int").alias("blocks")
    )
    members = family.join(sized, "component").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(
        # a merge join at every size: few members would be broadcast only while the input is small
        members.select("id", "component", "block", "blocks").hint("merge"), "id"
    )
    sets = arrow_map(
        texts.select("text", "id", "component", "block", "blocks"), _sets,
        "id bigint, component bigint, block int, blocks int, set binary", width=width,
    )
    sets = stage(sets, "sets")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = sets.select("id", "component", "block", "set", other).select(
        "id", "component", "block", "set",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )

    def tile_links(table: pa.Table) -> pa.Table:
        return _tile(table, percent)

    return tiles.groupBy("component", "low", "high").applyInArrow(tile_links, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, width: int = 4, percent: int = 80, near: float = NEAR, tile: int = TILE,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every document.

    Linked are documents whose shingle sets share at least ``percent`` of their union.
    """
    docs = identified(docs)
    sketch = stage(sketches(docs.where(F.col("doc_id").isNotNull()), width), "sketches")
    full = sketch.where("n_shingles > 0")
    folded = stage(
        full.groupBy("d1", "d2", "n_shingles").agg(
            F.min("doc_id").alias("doc_id"), F.first("bits").alias("bits"), F.first("bands").alias("bands")
        ),
        "sets-of",
    )
    sizes = folded.select(F.col("doc_id").alias("id"), "n_shingles")
    found = links(docs, families(folded, near).join(sizes, "id"), width, percent, tile)
    groups = components(stage(found, "links"), "groups")
    representative = folded.select("d1", "d2", "n_shingles", F.col("doc_id").alias("id")).join(groups, "id", "left")
    labelled = sketch.select("doc_id", "n_shingles", "d1", "d2").join(
        representative.select("d1", "d2", "n_shingles", F.coalesce("component", "id").alias("component_id")),
        ["d1", "d2", "n_shingles"], "left",
    )
    component = F.coalesce("component_id", "doc_id")
    return labelled.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


SQL = """
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [md5(array_to_string(w, ' '))]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: md5(array_to_string(w[i:i+3], ' ')))) END AS s
  FROM tokens),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components USING (doc_id)
"""
