"""Operator 13: documents whose n-gram sets have a Jaccard similarity of 0.8 or more, by a join over
prefix trees.

With ``need(n)`` the least overlap that a set of n grams must have with a partner, and a set thus
allowed to lose ``n - need(n)`` of its grams:

1. *Sets without a chance.* A fixed share of all grams (those of small hash) is exchanged by hash.
   Each task sends its grams once, however many of its documents hold them, and learns which occur
   in other documents. A set with more unshared grams among these than it may lose has no partner.
   Sets that are equal are one set from here on.
2. *Global order.* The grams of the remaining sets are counted, and every set is ordered by rising
   frequency class, then hash. Grams of one set alone come first; they cannot match.
3. *Families.* Linked sets share a gram among the first ``n - need(n) + 1`` of this order. Every such
   gram ties its sets to the smallest of them, and what is tied is a family. Rare grams come
   first, so common lines tie only sets that consist of common lines.
4. *Prefix trees.* A family is cut into blocks of sets of similar size. The sets of a block are a
   prefix tree with compressed paths. Each set walks the tree; sets that begin alike share the
   overlap counted so far. A subtree is left as soon as the overlap and the grams that remain, on
   either side, cannot reach what the smallest set in it asks for, or as soon as all of it is
   already connected with the set that walks. A walk to the end counts the full sets, exactly.
5. *Blocks of a large family.* Blocks are chained by one set each. Then only pairs of blocks meet
   whose sizes allow a link and which are not connected already, so a family of near copies
   costs its length, not its square.
6. *Groups.* Connected components of the links found.

Links leave a tree as a spanning forest; no link between different components is left out. Unlinked
sets of one family and of similar size do meet block by block, which is quadratic in blocks.

Defined cases: every row is a document of its own, also where its id is null or repeated; a row
without id can link others, and its ``component_id`` is the smallest id reachable (null if there is
none). Null or empty texts, or texts without a word, have an empty set and no link. A text with
fewer words than a gram is one gram. An empty table gives an empty table. Other columns are not
read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.near_dup import forest, shingles
from threadloom.llm.sequence import numbered, running
from threadloom.llm.shared import arrow_map, buckets_for, components, table_of
from threadloom.llm.words import Words, chunks, mix
from threadloom.sources.tables import stage

RUN_DOCS = 1 << 16
BLOCK_GRAMS = 1 << 20
LEAST_GRAMS = 1 << 11
STEP = 64
_SAMPLE = np.uint64(0xA24BAED4963EE407)


def need(n, percent: int):
    """Least overlap of a set of n grams with any linked set."""
    return -(-percent * n // 100)


def keyed(docs: DataFrame) -> DataFrame:
    """``(key, doc_id, text)`` with a number of its own for every row: the id where ids are unique
    and not null (a check that reads ids alone), else numbers written beside a copy."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if ids.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return ids.select(F.col("doc_id").alias("key"), "doc_id", "text")
    return stage(ids.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), "keyed")


# ---- sets without a chance ---------------------------------------------------------------------


def pack48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _range_of(values: np.ndarray, high: int, buckets: int) -> np.ndarray:
    """Bucket of each value by its highest 32 of ``high`` bits; in the order of the values."""
    return ((values >> np.uint64(high - 32)) * np.uint64(buckets)) >> np.uint64(32)


_SENT = pa.schema(
    [("bucket", pa.int32()), ("run", pa.int64()), ("grams", pa.binary()), ("who", pa.binary()), ("known", pa.binary()),
     ("info", pa.binary())]
)
_SENT_SQL = "bucket int, run bigint, grams binary, who binary, known binary, info binary"
_INFO = np.dtype(
    [("key", "<i8"), ("doc_id", "<i8"), ("named", "?"), ("n", "<i8"), ("d1", "<u8"), ("d2", "<u8"), ("sampled", "<i8"), ("shared", "<i8")]
)


def _send(batches: Iterator, width: int, share: float, buckets: int) -> Iterator:
    """For each run of texts: what is known of them, and its sampled grams by bucket."""
    limit = np.uint64(int(share * (1 << 64)) - 1) if share < 1 else np.uint64((1 << 64) - 1)
    for batch in batches:
        for low in range(0, batch.num_rows, RUN_DOCS):
            piece = batch.slice(low, RUN_DOCS)
            keys = piece.column(0).to_numpy(zero_copy_only=False)
            ids = piece.column(1)
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for texts in chunks(piece.column(2)):
                values, first = shingles(Words(texts), width)
                mine = slice(texts.first, texts.first + len(texts))
                info = np.zeros(len(texts), _INFO)
                info["key"], info["doc_id"], info["named"] = keys[mine], ids[mine], named[mine]
                info["n"] = np.diff(first)
                used = np.flatnonzero(info["n"])
                if len(used):
                    starts = first[:-1][used]
                    info["d1"][used] = np.add.reduceat(mix(values), starts)
                    info["d2"][used] = np.add.reduceat(mix(values ^ np.uint64(0xA0761D6478BD642F)), starts)
                chosen = mix(values ^ _SAMPLE) <= limit
                who = np.repeat(np.arange(len(texts)), info["n"])[chosen]
                grams = values[chosen] >> np.uint64(16)
                one, at, count = np.unique(grams, return_inverse=True, return_counts=True)
                twice = count[at] > 1
                info["sampled"] = np.bincount(who, minlength=len(texts))
                info["shared"] = np.bincount(who[twice], minlength=len(texts))
                run = int(info["key"][0])
                rows = [(hash(run) % buckets, run, None, None, None, info.tobytes())]
                lonely, owner, known = grams[~twice], who[~twice], one[count > 1]
                place, known_place = _range_of(lonely, 48, buckets), _range_of(known, 48, buckets)
                order = np.argsort(place, kind="stable")
                lonely, owner, place = lonely[order], owner[order].astype("<u2"), place[order]
                for b in np.union1d(place, known_place):
                    a, z = np.searchsorted(place, [b, b + np.uint64(1)])
                    x, y = np.searchsorted(known_place, [b, b + np.uint64(1)])
                    rows.append((int(b), run, pack48(lonely[a:z]), owner[a:z].tobytes(), pack48(known[x:y]), None))
                yield table_of(dict(zip(_SENT.names, zip(*rows))), _SENT)


_BACK = pa.schema([("run", pa.int64()), ("who", pa.binary()), ("info", pa.binary())])


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for each run, which documents hold grams that other runs hold too."""
    rows = table.to_pydict()
    out = [(run, None, info) for run, info in zip(rows["run"], rows["info"]) if info is not None]
    sent = [i for i, info in enumerate(rows["info"]) if info is None]
    if sent:
        grams = [unpack48(rows["grams"][i]) for i in sent]
        known = np.unique(np.concatenate([unpack48(rows["known"][i]) for i in sent]))
        every = np.concatenate(grams)
        _, at, count = np.unique(every, return_inverse=True, return_counts=True)
        both = (count[at] > 1) | np.isin(every, known) if len(every) else np.zeros(0, bool)
        edge = 0
        for i, part in zip(sent, grams):
            mine = both[edge : edge + len(part)]
            edge += len(part)
            if mine.any():
                out.append((rows["run"][i], np.frombuffer(rows["who"][i], "<u2")[mine].tobytes(), None))
    columns = list(zip(*out)) or [[], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _BACK)], schema=_BACK)


_DOC_SQL = "key bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, chance boolean"


def _judged(table: pa.Table, percent: int) -> pa.Table:
    """The documents of one run, and whether enough of their sampled grams are shared."""
    rows = table.to_pydict()
    info = np.frombuffer(next(i for i in rows["info"] if i is not None), _INFO)
    who = np.frombuffer(b"".join(w for w in rows["who"] if w is not None), "<u2")
    shared = info["shared"] + np.bincount(who, minlength=len(info))
    lost = info["n"] - need(info["n"], percent)
    chance = (info["n"] > 0) & (info["sampled"] - shared <= lost)
    return pa.table({
        "key": info["key"], "doc_id": pa.array(info["doc_id"], mask=~info["named"]), "n": info["n"],
        **{d: np.ascontiguousarray(info[d]).view(np.int64) for d in ("d1", "d2")}, "chance": chance,
    })


def candidates(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(key, doc_id, n, d1, d2, chance)`` of every keyed document; d1, d2, n name its set."""
    buckets = buckets_for(docs, "text")
    share = min(1.0, 1.5 * (100 - percent) / 100)
    sent = arrow_map(docs.select("key", "doc_id", "text"), _send, _SENT_SQL, width=width, share=share, buckets=buckets)
    back = sent.groupBy("bucket").applyInArrow(lambda t: _shared(t), "run bigint, who binary, info binary")
    return back.groupBy("run").applyInArrow(lambda t: _judged(t, percent), _DOC_SQL)


# ---- global order ------------------------------------------------------------------------------

_RUN_SQL = "run bigint, keys binary, sizes binary, grams binary"


def _sets(batches: Iterator, width: int) -> Iterator:
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for texts in chunks(batch.column(1)):
            values, first = shingles(Words(texts), width)
            mine = np.ascontiguousarray(keys[texts.first : texts.first + len(texts)], np.int64)
            yield pa.RecordBatch.from_pydict({
                "run": [int(mine[0])], "keys": [mine.tobytes()], "sizes": [np.diff(first).astype("<i8").tobytes()],
                "grams": [values.tobytes()],
            })


def _counts(batches: Iterator, buckets: int) -> Iterator:
    for batch in batches:
        for run, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grams, count = np.unique(np.frombuffer(data, np.uint64), return_counts=True)
            place = _range_of(grams, 64, buckets)
            count = np.minimum(count, 65535).astype("<u2")
            used, edge = np.unique(place, return_index=True)
            edge = [*edge, len(grams)]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(used, pa.int32()), "run": pa.array([run] * len(used), pa.int64()),
                "grams": [grams[a:z].tobytes() for a, z in zip(edge, edge[1:])],
                "count": [count[a:z].tobytes() for a, z in zip(edge, edge[1:])],
            })


def _classes(table: pa.Table) -> pa.Table:
    """Frequency class of every gram of one bucket: 0 if one set holds it, else rising with the
    logarithm of their number."""
    rows = table.to_pydict()
    grams = [np.frombuffer(g, np.uint64) for g in rows["grams"]]
    _, at = np.unique(np.concatenate(grams), return_inverse=True)
    held = np.bincount(at, np.concatenate([np.frombuffer(c, "<u2") for c in rows["count"]]))
    kind = np.minimum(np.floor(8 * np.log2(held)), 255).astype(np.uint8)[at]
    edges = np.cumsum([0, *map(len, grams)])
    return pa.table({
        "run": pa.array(rows["run"], pa.int64()), "bucket": pa.array(rows["bucket"], pa.int32()),
        "kinds": pa.array([kind[a:z].tobytes() for a, z in zip(edges, edges[1:])], pa.binary()),
    })


_SET_SQL = "key bigint, n bigint, alone bigint, grams binary, kinds binary"


def _ordered(batches: Iterator, percent: int) -> Iterator:
    """The sets of a run in global order, without grams that no other set holds."""
    for batch in batches:
        for keys, sizes, data, parts in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            grams = np.frombuffer(data, np.uint64)
            one, at = np.unique(grams, return_inverse=True)
            kind = np.frombuffer(b"".join(p["kinds"] for p in parts), np.uint8)[at]
            keys, sizes = np.frombuffer(keys, np.int64), np.frombuffer(sizes, "<i8")
            who = np.repeat(np.arange(len(keys)), sizes)
            alone = np.bincount(who[kind == 0], minlength=len(keys))
            stays = (alone <= sizes - need(sizes, percent)) & (alone < sizes)
            use = np.flatnonzero((kind > 0) & stays[who])
            use = use[np.lexsort((grams[use], kind[use], who[use]))]
            edges = np.searchsorted(who[use], np.arange(len(keys) + 1))
            kept = np.flatnonzero(stays)
            grams, kind = grams[use], kind[use]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(keys[kept]), "n": pa.array(sizes[kept]), "alone": pa.array(alone[kept]),
                "grams": pa.array([grams[edges[i] : edges[i + 1]].tobytes() for i in kept], pa.binary()),
                "kinds": pa.array([kind[edges[i] : edges[i + 1]].tobytes() for i in kept], pa.binary()),
            })


def ordered_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(key, n, alone, grams, kinds)`` of keyed documents with different sets: grams that others
    hold, rare ones first, and how many of the n it holds alone."""
    buckets = buckets_for(docs, "text")
    runs = stage(arrow_map(docs.select("key", "text"), _sets, _RUN_SQL, width=width), "gram-runs")
    counts = arrow_map(runs.select("run", "grams"), _counts, "bucket int, run bigint, grams binary, count binary", buckets=buckets)
    kinds = counts.groupBy("bucket").applyInArrow(lambda t: _classes(t), "run bigint, bucket int, kinds binary")
    by_run = kinds.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("bucket", "kinds"))).alias("parts"))
    return stage(
        arrow_map(
            runs.join(by_run.hint("merge"), "run").select("keys", "sizes", "grams", "parts"), _ordered, _SET_SQL, percent=percent
        ),
        "ordered",
    )


# ---- families ----------------------------------------------------------------------------------


def _ties(batches: Iterator, percent: int, buckets: int, inside: bool) -> Iterator:
    """Per batch of sets, the smallest key of each prefix gram: as ties between the batch's sets
    (``inside``), or to be met by other batches, by bucket."""
    for batch in batches:
        keys, n, alone = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        take = n - need(n, percent) + 1 - alone
        grams = [np.frombuffer(g.as_buffer(), np.uint64)[:t] for g, t in zip(batch.column(3), take)]
        size = [len(g) for g in grams]
        owner = np.repeat(keys, size)
        gram = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.lexsort((owner, gram))
        gram, owner = gram[order], owner[order]
        first = np.ones(len(gram), bool)
        first[1:] = gram[1:] != gram[:-1]
        lead = owner[first]
        if inside:
            pairs = np.unique(np.stack([lead[np.cumsum(first) - 1], owner], axis=1), axis=0) if len(gram) else np.zeros((0, 2), np.int64)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
            continue
        gram = gram[first]
        used, edge = np.unique(_range_of(gram, 64, buckets), return_index=True)
        edge = [*edge, len(gram)]
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(used, pa.int32()),
            "grams": pa.array([gram[a:z].tobytes() for a, z in zip(edge, edge[1:])], pa.binary()),
            "leads": pa.array([np.ascontiguousarray(lead[a:z]).tobytes() for a, z in zip(edge, edge[1:])], pa.binary()),
        })


def _met(table: pa.Table) -> pa.Table:
    gram = np.frombuffer(b"".join(table.column("grams").to_pylist()), np.uint64)
    lead = np.frombuffer(b"".join(table.column("leads").to_pylist()), np.int64)
    order = np.lexsort((lead, gram))
    gram, lead = gram[order], lead[order]
    first = np.ones(len(gram), bool)
    first[1:] = gram[1:] != gram[:-1]
    pairs = np.unique(np.stack([lead[first][np.cumsum(first) - 1], lead], axis=1), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def families(sets: DataFrame, percent: int) -> DataFrame:
    """``(id, component)`` of sets tied by grams of their prefixes."""
    buckets = buckets_for(sets, "grams")
    given = sets.select("key", "n", "alone", "grams")
    inside = arrow_map(given, _ties, "a bigint, b bigint", percent=percent, buckets=buckets, inside=True)
    sent = arrow_map(given, _ties, "bucket int, grams binary, leads binary", percent=percent, buckets=buckets, inside=False)
    across = sent.groupBy("bucket").applyInArrow(lambda t: _met(t), "a bigint, b bigint")
    return components(stage(inside.union(across), "ties"), "gram-families")


# ---- prefix trees ------------------------------------------------------------------------------


class Tree:
    """Sets of ranked grams as a prefix tree with compressed paths.

    Sets lie in the order of their grams. A node is (from, to, depth above, depth): these sets agree
    in their first ``depth`` grams.
    """

    def __init__(self, ranks: list[np.ndarray], sizes: np.ndarray):
        self.order = sorted(range(len(ranks)), key=lambda i: ranks[i].astype(">u4").tobytes())
        self.ranks = [ranks[i] for i in self.order]
        self.sizes = sizes[self.order]
        self.held = np.array([len(r) for r in self.ranks])
        agree = [0] * len(ranks)  # grams that a set shares with the one before it
        for i in range(1, len(ranks)):
            x, y = self.ranks[i - 1], self.ranks[i]
            m = min(len(x), len(y))
            other = np.flatnonzero(x[:m] != y[:m])
            agree[i] = int(other[0]) if len(other) else m
        self.agree = np.array(agree)

    def children(self, low: int, high: int, depth: int) -> list[tuple[int, int, int, int]]:
        cuts = [low, *(low + 1 + np.flatnonzero(self.agree[low + 1 : high] <= depth)).tolist(), high]
        out = []
        for a, z in zip(cuts, cuts[1:]):
            below = int(self.agree[a + 1 : z].min()) if z - a > 1 else len(self.ranks[a])
            out.append((a, z, depth, below))
        return out


def tree_links(
    ranks: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, label: np.ndarray, percent: int, seen: list | None = None
) -> list[tuple[int, int]]:
    """Links (walker, member) by which sets become connected that were not.

    ``left`` are the sets in the tree. The others walk it, or the same ones if there are no others.
    Sets of equal ``label`` count as connected. ``seen`` collects (walker, node) of nodes walked.
    """
    walkers = np.setdiff1d(np.arange(len(ranks)), left)
    if not len(walkers):
        walkers = left
    tree = Tree([ranks[i] for i in left], sizes[left])
    member = left[tree.order]
    label = label.copy()
    inside = np.zeros(1 + max((int(r[-1]) if len(r) else 0) for r in ranks), bool)
    links = []
    for walker in walkers.tolist():
        mine, n = ranks[walker], int(sizes[walker])
        inside[mine] = True
        todo = [(node, 0) for node in tree.children(0, len(left), 0)[::-1]]
        while todo:
            (low, high, depth, below), overlap = todo.pop()
            if (label[member[low:high]] == label[walker]).all():
                continue
            least = int(tree.sizes[low:high].min())
            asked = -(-percent * (n + least) // (100 + percent))
            longest = int(tree.held[low:high].max())
            if 100 * n < percent * least or 100 * int(tree.sizes[low:high].max()) < percent * n:
                continue
            path, step, hopeless = tree.ranks[low], STEP, False
            if seen is not None:
                seen.append((walker, (low, high, depth, below)))
            while depth < below:
                stop = min(depth + step, below)
                overlap += int(np.count_nonzero(inside[path[depth:stop]]))
                depth, step = stop, step * 2
                rest = len(mine) - int(np.searchsorted(mine, path[depth - 1], "right"))
                if overlap + min(longest - depth, rest) < asked:
                    hopeless = True
                    break
            if hopeless:
                continue
            ends = low
            while ends < high and tree.held[ends] == depth:  # sets that end here
                other = member[ends]
                if label[other] != label[walker] and (100 + percent) * overlap >= percent * (n + int(sizes[other])):
                    links.append((walker, int(other)))
                    label[label == label[other]] = label[walker]
                ends += 1
            if ends < high:
                todo += [(node, overlap) for node in tree.children(ends, high, depth)[::-1]]
        inside[mine] = False
    return links


def _walk(batches: Iterator, percent: int) -> Iterator:
    """Each row is a tile: the sets of one block, or of two, and the labels of what is connected."""
    for batch in batches:
        a, b = [], []
        for rows in batch.column(0):
            rows = rows.values
            column = {name: rows.field(name) for name in ("key", "n", "side", "label", "grams", "kinds")}
            key, n, side, label = (column[c].to_numpy(zero_copy_only=False) for c in ("key", "n", "side", "label"))
            grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in column["grams"]]
            kinds = np.frombuffer(b"".join(column["kinds"].to_pylist()), np.uint8)
            one, start, at = np.unique(np.concatenate(grams), return_index=True, return_inverse=True)
            rank = np.empty(len(one), np.int64)
            rank[np.lexsort((one, kinds[start]))] = np.arange(len(one))
            ranks = np.split(rank[at], np.cumsum([len(g) for g in grams])[:-1])
            links = tree_links(ranks, n, np.flatnonzero(side == side.min()), label, percent)
            a += [int(key[x]) for x, _ in links]
            b += [int(key[y]) for _, y in links]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within tiles. ``members`` has (key, family, tile, side, label)."""
    full = sets.select("key", "n", "grams", "kinds").join(members.hint("merge"), "key")
    rows = full.groupBy("family", "tile").agg(
        F.collect_list(F.struct("key", "n", "side", "label", "grams", "kinds")).alias("rows")
    )
    return arrow_map(rows.where(F.size("rows") > 1).select("rows"), _walk, "a bigint, b bigint", percent=percent)


def links(sets: DataFrame, family: DataFrame, percent: int, block: int = BLOCK_GRAMS) -> DataFrame:
    """Links ``(a, b)`` that connect the same sets as all links do."""
    sized = sets.select("key", "n", F.greatest(F.octet_length("grams") / 8, F.lit(min(LEAST_GRAMS, block))).cast("long").alias("w")).join(
        family.select(F.col("id").alias("key"), F.col("component").alias("family")), "key"
    )
    columns = [F.col(c) for c in ("key", "family", "n", "w")]
    placed = running(numbered(sized, "family", ["n", "key"], ["n", "key"], columns, "by-size"), "family", "pos", {"upto": ("sum", "w")})
    placed = stage(placed.select("key", "family", "n", "pos", F.floor(F.col("upto") / block).alias("block")), "blocks-of")
    own = placed.select("key", "family", F.col("block").cast("string").alias("tile"), F.lit(0).alias("side"), F.col("key").alias("label"))
    found = stage(_tiles(own, sets, percent), "links-inside")
    if placed.where("block > 0").isEmpty():
        return found
    large = placed.join(placed.where("block > 0").select("family").distinct(), "family", "left_semi")
    first = large.groupBy("family", "block").agg(F.min_by("key", "pos").alias("key"))
    chain = first.select("key", "family", F.explode(F.array(F.col("block"), F.col("block") - 1)).alias("t")).select(
        "key", "family", F.col("t").cast("string").alias("tile"), F.lit(0).alias("side"), F.col("key").alias("label")
    )
    found = stage(found.union(_tiles(chain, sets, percent)), "links-chained")
    label = components(found, "gram-labels")
    large = stage(
        large.join(label.withColumnRenamed("id", "key"), "key", "left").select(
            "key", "family", "block", "n", F.coalesce("component", "key").alias("label")
        ),
        "labelled",
    )
    known = large.groupBy("family", "block").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("label").alias("one"), F.max("label").alias("other")
    )
    later = known.select("family", *[F.col(c).alias("_" + c) for c in ("block", "least", "one", "other")])
    meet = known.join(later, "family").where(
        (F.col("block") < F.col("_block")) & (100 * F.col("most") >= percent * F.col("_least"))
        & ~((F.col("one") == F.col("other")) & (F.col("_one") == F.col("_other")) & (F.col("one") == F.col("_one")))
    )
    tile = F.concat_ws("-", "block", "_block").alias("tile")
    sides = meet.select("family", tile, F.explode(F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("side")),
                                                          F.struct(F.col("_block").alias("block"), F.lit(1).alias("side")))).alias("s"))
    pairs = large.select("key", "family", "block", "label").join(
        sides.select("family", "tile", F.col("s.block").alias("block"), F.col("s.side").alias("side")), ["family", "block"]
    )
    return found.union(_tiles(pairs.select("key", "family", "tile", "side", "label"), sets, percent))


def gram_groups(docs: DataFrame, width: int = 5, percent: int = 80, block: int = BLOCK_GRAMS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every document."""
    docs = keyed(docs)
    sketch = stage(candidates(docs, width, percent), "gram-sketch")
    name = ["d1", "d2", "n"]
    folded = stage(
        sketch.where("n > 0").groupBy(*name).agg(
            F.min("key").alias("key"), F.min("doc_id").alias("smallest"), F.bool_or("chance").alias("chance")
        ),
        "gram-sets",
    )
    texts = docs.select("key", "text").join(
        # a merge join at every size: few sets would be broadcast only while the input is small
        folded.where("chance").select("key").hint("merge"), "key"
    )
    sets = ordered_sets(texts, width, percent)
    groups = components(stage(links(sets, families(sets, percent), percent, block), "gram-links"), "gram-groups")
    labelled = folded.join(groups.withColumnRenamed("id", "key"), "key", "left").select(
        *name, "smallest", F.coalesce("component", "key").alias("component")
    )
    lowest = labelled.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = labelled.join(lowest, "component").select(*name, "component_id")
    full = sketch.select("doc_id", *name).join(named, name, "left")
    return full.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


SQL = """
WITH RECURSIVE tokens AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [md5(array_to_string(w, ' '))]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i+4], ' ')))) END AS s
  FROM tokens),
grams AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT x.r AS a, y.r AS b FROM grams x JOIN grams y ON x.g = y.g AND x.r <> y.r
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (
  SELECT r AS a, r AS b FROM tokens
  UNION SELECT reach.a, p.b FROM reach JOIN pairs p ON reach.b = p.a),
components AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN tokens ON tokens.r = b GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN components USING (r)
"""
