"""Packing and mixing: round trips, bounds and brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from threadloom.llm import mixing, packing
from threadloom.llm.queries import TOKENIZER

ODD = [
    None, "", " \t\n", "It's I'LL don't 'S '' a1b2 x_y", "Ünïcode straße “quotes” ½ x² 日本語 Σίσυφος İstanbul ÀÉ×÷ª º µ",
    "<|endoftext|> x<|startoftext|>y", "a\x1cb \x85  c\x1f", "Hello, WORLD!!! " * 700, "é é",
]


@pytest.fixture(scope="module")
def packed(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "Onth", "zuver", "é"]) for _ in range(rng.randint(0, 3000)))) for i in range(120)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(5, "again"), (5, "again"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "y") for i, t in rows], "doc_id long, text string, rank string")
    return rows, [r.asDict() for r in packing.best_fit_packing(docs, TOKENIZER).collect()]


def test_pieces_are_the_tokenizer_s(packed):
    rows, got = packed
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    for doc_id, text in rows:
        if doc_id in (5, None):
            continue
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want = [
            (n, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()))
            for n, at in enumerate(range(0, len(ids), 4096))
        ]
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_id[doc_id])
        assert mine == want, text
    assert len(by_id[5]) >= 3 and len(by_id[None]) == 1


def test_sequences_are_gapless_and_few(packed):
    _, got = packed
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in got)
    assert len(sequences) <= 1.05 * -(-total // 4096) + 1


def test_equal_lengths_and_empty(spark):
    parts = spark.createDataFrame([(i, 0, 5) for i in range(3000)], "doc_id long, piece int, length long")
    got = packing.pack(parts).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3000
    assert len({r["sequence_id"] for r in got}) == -(-3000 // (4096 // 5))
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.best_fit_packing(docs, TOKENIZER).count() == 0


def targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        rate = (total - sum(full.values())) / sum(weight[s] for s in left) if left else 0
        above = [s for s in left if weight[s] * rate > 2 * sizes[s]]
        if not above:
            return full | {s: weight[s] * rate for s in left}
        full |= {s: 2.0 * sizes[s] for s in above}


def test_mix_matches_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(900):
        source = rng.choice(["hot"] * 6 + ["b", "a", "Z", None, "é"])
        rows.append((i, rng.choice([None, "", "w " * rng.randint(1, 60)]), source))
    rows += [(5000, "x y z", "tiny"), (5001, None, "none")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    size = {i: len((t or "").split()) for i, t, _ in rows}
    totals = defaultdict(int)
    for i, _, s in rows:
        totals[s] += size[i]
    want = targets(totals)
    for s in totals:
        mine = [i for i, _, x in rows if x == s]
        order = sorted(mine, key=lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), i))
        epochs = int(want[s]) // totals[s] if totals[s] else 0
        rest = int(want[s]) - epochs * totals[s]
        for i in order:
            cut = min(size[i], max(0, rest))
            rest -= size[i]
            r = got[i]
            assert (r["size"], r["source_size"], r["taken"]) == (size[i], totals[s], epochs * size[i] + cut)
            assert abs(r["target"] - want[s]) < 1e-6 and r["taken"] <= 2 * size[i]
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}


def test_mixed_documents_have_the_words_taken(spark):
    rows = [(i, "w%d " % i * (i % 7), "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    words = defaultdict(int)
    for r in mixing.mix_documents(docs).collect():
        words[r["doc_id"]] += len(r["text"].split())
    assert {i: words[i] for i in taken} == taken


def test_mixed_documents_with_null_and_repeated_ids(spark):
    rows = [([None, 1, 1, i][i % 4], " ".join([f"w{i}"] * (1 + i % 5)), "ab"[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, got = defaultdict(int), defaultdict(int)
    for r in mixing.mix(docs).collect():
        want[r["source"], r["doc_id"]] += r["taken"]
    for r in mixing.mix_documents(docs).collect():
        got[r["source"], r["doc_id"]] += len(r["text"].split())
    assert {k: n for k, n in want.items() if n} == got


def test_mix_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
