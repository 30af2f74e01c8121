"""Near duplicates and repeated windows against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from threadloom.llm import near_dup, repeats, shared
from threadloom.sources.tables import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 60))
    base = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(25)]
    out = list(base)
    for text in base:
        words = text.split()
        for edits in (0, 1, 2, 4, 8):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = word()
            out.append("  ".join(copy).upper() if edits == 1 else "\t".join(copy))
    passage = " ".join(word() for _ in range(60))
    out += [f"{word()} {passage} {word()}", f"{passage}\n{passage}", "Ärger über Öl", "ärger über Öl"]
    out += [None, "", "   \n", "one", "ONE", "one two", "two one", "x " * 5000, "  nbsp", "a\u0085b"]
    return out


def shingles(text, width):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(lower)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def groups(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize(("width", "tile"), [(4, 512), (5, 7)])
def test_groups_match_brute_force(spark, width, tile):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, kept string, n_shingles long")
    got = near_dup.near_duplicates(docs, width=width, tile=tile).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == groups(rows, width, 80)
    assert len(got) == len(rows)


def test_near_copies_among_many_excerpts(spark):
    # every bucket of the two whole texts is led by a smaller id that is unlike both
    rng = random.Random(5)
    whole = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(sorted(rng.sample(whole, 54)))) for i in range(2500)]
    rows += [(2500, " ".join(whole)), (2501, " ".join([*whole[:-1], "other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, width=1).collect()}
    assert got == {i: min(i, 2500) for i in range(2502)}


def test_tiles_of_a_bucket(spark):
    odd = 0x5555555555555555
    bits = [[0] * 8, [-1] * 8, [odd, odd, ~odd, ~odd] * 2]  # no slot agrees
    rows = [(i, bits[i % 3], [7]) for i in range(40)]
    sketch = spark.createDataFrame(rows, "doc_id long, bits array<long>, bands array<long>")
    for tile in (512, 4):
        got = {r["id"]: r["component"] for r in near_dup.families(sketch, tile=tile).collect()}
        assert got == {i: i % 3 for i in range(40)}


def test_tiles_of_long_texts_and_exact_sums(spark):
    rng = random.Random(8)
    long = [f"w{rng.randint(0, 10**6)}" for _ in range(900)]
    rows = []
    for i in range(30):
        words = list(long)
        words[rng.randrange(900)] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    family = spark.createDataFrame([(i, 0, 897) for i, _ in rows], "id long, component long, n_shingles long")
    found = near_dup.links(docs, family, 4, 80, tile_shingles=4000)  # 7 blocks of about four texts
    assert {r["component"] for r in shared.components(found).collect()} == {0}
    sets = [np.arange(0, 3_000_000, dtype=np.uint64), np.arange(1, 3_000_002, dtype=np.uint64)]
    assert near_dup._overlaps(sets, sets).tolist() == [[3_000_000, 2_999_999], [2_999_999, 3_000_001]]


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(docs).count() == 0
    assert repeats.remove_repeats(docs).count() == 0


def test_dense_group_brings_few_links_to_the_rounds(spark, monkeypatch):
    # 300 ids that each meet the same 30, as near copies meet the smallest ids of their buckets
    edges = spark.createDataFrame([(a, b) for a in range(30) for b in range(100, 400)], "a long, b long")
    staged = {}

    def kept(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(shared, "stage", kept)
    got = {r["id"]: r["component"] for r in shared.components(edges, "dense").collect()}
    assert got == {i: 0 for i in [*range(30), *range(100, 400)]}
    # 18,000 before: all links, in both directions
    assert staged["dense-links"].count() == 2 * 329


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(500, x) for x in range(501, 560)] + [(None, 3), (7, 7)]
    got = {r["id"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    assert got == {x: root(x) for x in parent}


def removed(rows, window):
    seen, gone = set(), {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        drop = set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                drop.update(range(at, at + window))
            seen.add(key)
        kept = " ".join(w for n, w in enumerate(words) if n not in drop)
        gone[i] = (len(words), len(drop), hashlib.sha256(kept.encode()).hexdigest(), kept if drop else None)
    return gone


@pytest.mark.parametrize(("window", "start"), [(20, 10), (20, 5), (6, 3), (4, 2)])
def test_repeats_match_brute_force(spark, window, start):
    rows = list(enumerate(texts(2)))
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, places long")
    got = repeats.remove_repeats(docs.repartition(3), window, start).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in got} == removed(rows, window)


def test_buckets_of_runs_are_spread():
    for tasks, runs, count in ((24, 64, 200), (32, 7, 51), (1000, 64, 900), (211, 1, 211)):
        counts = collections.Counter()
        for task in range(tasks):
            counts.update(itertools.islice(repeats.own_buckets(task, count), runs))
        assert max(counts.values()) <= 2 * max(1, tasks * runs / count)


def test_window_must_be_a_doubling():
    with pytest.raises(ValueError, match="doubled"):
        repeats.remove_repeats(None, 20, 7)


def test_shingles_are_taken_from_small_runs_of_texts(monkeypatch):
    """A worker's arrays are some 30 times the bytes of a run of texts."""
    import pyarrow as pa

    from threadloom.llm import near_dup

    sizes, words = [], near_dup.Words

    def counted(texts):
        sizes.append(len(texts.data))
        return words(texts)

    monkeypatch.setattr(near_dup, "Words", counted)
    text = "one two three four five six seven " * 100
    ids, texts = pa.array(range(400)), pa.array([text] * 400)
    rows = list(near_dup._sketch([pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])], 4))
    sets = list(near_dup._sets([pa.RecordBatch.from_arrays([texts, ids], names=["text", "id"])], 4))
    assert sum(b.num_rows for b in rows) == sum(b.num_rows for b in sets) == 400
    assert sum(sizes) == 2 * 400 * len(text) and max(sizes) <= 1 << 18


def test_word_hashes_take_little_memory_and_do_not_depend_on_pieces(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from threadloom.llm import words as W

    texts = [" ".join(f"word{i * 7 % 9973}" for i in range(k, k + 3000)) for k in range(0, 240_000, 3000)]
    texts += ["x" * 600_000 + " Y", "", None, "a" * 40 + "\t" + "b" * 41]
    words = W.Words(W.texts_of(pa.array(texts)))
    words.hashes(lower=True)  # tables of powers are made once
    tracemalloc.start()
    try:
        whole = words.hashes(lower=True)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        data, offsets = words.joined(np.ones(len(words), bool))
        joined = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    size = len(words.texts.data)
    assert size > 2_500_000 and most < 10 * size and joined < 14 * size
    assert bytes(data[offsets[0] : offsets[1]]).decode() == texts[0]
    monkeypatch.setattr(W, "HASH_BYTES", 64)
    monkeypatch.setattr(W, "_powers", {})
    assert np.array_equal(words.hashes(lower=True), whole)
