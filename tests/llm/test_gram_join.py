"""The prefix-tree join against brute force."""

import random

import numpy as np
import pytest
from test_dedup import groups, shingles, texts

from threadloom.llm import gram_join


def table(spark, rows, parts=5):
    extra = [(i, t, 1, "x", "y", 2) for i, t in rows]
    return spark.createDataFrame(extra, "doc_id bigint, text string, key int, component string, d1 string, n int").repartition(parts)


def wanted(rows, width, percent):
    """As groups, but each row by itself: ids may repeat or be null."""
    numbered = list(enumerate(t for _, t in rows))
    found = groups(numbered, width, percent)
    lowest = {}
    for n, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[found[n][1]] = min(doc, lowest.get(found[n][1], doc))
    return sorted(
        ((doc, found[n][0], lowest.get(found[n][1]) if found[n][0] else doc) for n, (doc, _) in enumerate(rows)), key=str
    )


@pytest.mark.parametrize(("width", "percent", "block"), [(5, 80, 1 << 20), (5, 80, 300), (3, 60, 200), (1, 95, 50)])
def test_groups_match_brute_force(spark, width, percent, block):
    rows = list(enumerate(texts(seed=width + percent)))
    got = gram_join.gram_groups(table(spark, rows), width, percent, block)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == wanted(rows, width, percent)


def test_null_and_repeated_ids(spark):
    rng = random.Random(3)
    near = " ".join(f"w{rng.randrange(900)}" for _ in range(80))
    rows = [
        (7, near), (None, near + " end"), (None, near + " end more"), (7, "something else"), (3, near.upper()),
        (None, "alone and without id"), (None, None), (9, None), (9, ""), (5, "  \n"), (None, "something else"),
    ]
    got = gram_join.gram_groups(table(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == wanted(rows, 5, 80)


@pytest.mark.parametrize("block", [1 << 20, 4000])
def test_large_family_and_common_lines(spark, block):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(150)]
    lines = [[word() for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(120):  # near copies: each changes a few words of one text
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((rng.randrange(10**9), " ".join(copy)))
    for i in range(120):  # made of common lines in changing order
        rows.append((rng.randrange(10**9), " ".join(sum(rng.sample(lines, 4), []) + [word()])))
    rows += [(10**10 + i, rows[0][1]) for i in range(300)]
    rows = list(dict(rows).items())
    got = gram_join.gram_groups(table(spark, rows), block=block)
    assert sorted(map(tuple, got.collect()), key=str) == wanted(rows, 5, 80)


def test_long_text(spark):
    """Above the size of a run of texts, where hashes take another path."""
    words = [f"{i * 7919 % 1000003:x}" for i in range(420_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-9] + ["z"])), (3, " ".join(words[200_000:]))]
    assert min(len(t) for _, t in rows[:2]) > 2 << 20
    got = sorted(map(tuple, gram_join.gram_groups(table(spark, rows, 2)).collect()))
    assert [(r[0], r[2]) for r in got] == [(1, 1), (2, 1), (3, 3)]


def test_nothing(spark):
    assert gram_join.gram_groups(table(spark, [])).count() == 0
    got = gram_join.gram_groups(table(spark, [(1, None), (2, "a b")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 1, 2)]


def test_tree_leaves_subtrees_early():
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.choice(100_000, 200, replace=False)) for _ in range(200)]
    near = [np.sort(np.append(s[:-1], 100_001 + i)) for i, s in enumerate(sets[:20])]
    ranks = sets + near
    sizes = np.array([len(r) for r in ranks])
    seen = []
    links = gram_join.tree_links(ranks, sizes, np.arange(len(ranks)), np.arange(len(ranks)), 80, seen)
    assert {frozenset(x) for x in links} == {frozenset((i, 200 + i)) for i in range(20)}
    copies = [np.arange(300) * 3 for _ in range(150)]
    for i, c in enumerate(copies):
        c[-1] += i
    seen = []
    links = gram_join.tree_links(copies, np.full(150, 300), np.arange(150), np.arange(150), 80, seen)
    assert len(links) == 149 and len(seen) < 2000  # not 150 * 150


def test_shingle_helper_agrees():
    assert len(shingles("a b c d e f", 5)) == 2
