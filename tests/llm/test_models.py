"""Language identification and suffix-tree scores: held-out accuracy, exact parts, distributions."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from threadloom.llm import language, suffix_tree

SF = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def crc(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert sum(held) >= 0.97 * len(held)


def test_language_defined_cases(spark):
    rows = [(i, "the onth of and heing " * 9, "en") for i in range(40)] + [(i, "der zuver schlich und " * 9, "de") for i in range(40, 80)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 -- 7", "de"), (103, "the", None), (None, "und der zuver", None), (104, "der zuver und " * 3000, None)]
    docs = spark.createDataFrame([(*r, "z", 7) for r in rows + odd], "doc_id long, text string, lang string, lang_pred string, score int")
    got = {r["doc_id"]: r for r in language.language_id(docs).collect()}
    assert len(got) == len(rows + odd)
    for i in (100, 101, 102):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[None]["lang_pred"] == "de" and got[104]["lang_pred"] == "de"
    bare = docs.limit(5).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {(r["lang_pred"], r["score"]) for r in language.language_id(bare).collect()} == {("und", 0.0)}
    assert language.language_id(docs.where("false")).count() == 0


def test_responses_are_the_convolution():
    network = language.Network(["a", "b"])
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 256, (5, 40 + 3), dtype=np.uint8)
    got = network.responses(windows)
    for k, width in enumerate(language.WIDTHS):
        want = sum(network.filters[k][j][windows[:, j : 40 + j]] for j in range(width))
        np.testing.assert_allclose(got[:, :, k * 16 : k * 16 + 16], want, rtol=1e-4, atol=1e-5)


def tokens(text):
    return WORD.findall((text or "").encode().translate(_UPPER))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    words = ["the", "a", "onth", "zuver", "und", "X1", "É"] + [f"w{i}" for i in range(80)]
    follow = {w: rng.sample(words, 4) for w in words}
    rows = []
    for i in range(400):
        text, last = [], rng.choice(words)
        for _ in range(rng.randint(0, 60)):
            last = rng.choice(follow[last]) if rng.random() < 0.7 else rng.choice(words)
            text.append(last)
        rows.append((i, " ".join(text)))
    rows += [(900, None), (901, ""), (902, "never seen words"), (903, "the " * 4000), (904, "the a\tthe\na")]
    return rows, spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, score double")


SETTINGS = {"word_share": 1e-3, "context_share": 1e-3, "pair_share": 1e-4, "gain": 2.0}


def test_scores(corpus):
    rows, docs = corpus
    got = {r["doc_id"]: r for r in suffix_tree.score_texts(docs, **SETTINGS).collect()}
    counts = collections.Counter()
    for i, text in rows:
        if crc(i, 7) != 2:
            counts.update(tokens(text))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    base = score = 0
    for i, text in rows:
        words = [*tokens(text), None]
        r = got[i]
        assert r["held_out"] == (crc(i, 7) == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert abs(r["base_score"] - want) <= 1e-9 * max(1, abs(want))
        if r["held_out"]:
            base, score = base + r["base_score"], score + r["score"]
    assert score > base + 0.05 * abs(base)


def test_rows_without_id_and_shared_ids(spark):
    one, two = [i for i in range(1, 30) if crc(i, 7) != 2][:2]
    rows = [(one, "a b"), (None, "a c d"), (two, "a"), (two, "x y z"), (two, "x y z"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_tree.score_texts(docs, **SETTINGS).collect()
    counts = collections.Counter(w for _, text in rows for w in [*tokens(text), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), len(tokens(t)) + 1, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*tokens(t), None])) for i, t in rows
    )
    for r, (i, size, base) in zip(sorted(got, key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"])), want, strict=True):
        assert (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (i, size, size, n, False)
        assert abs(r["base_score"] - base) < 1e-9


def test_every_node_is_a_distribution(corpus):
    rows, docs = corpus
    train = docs.selectExpr("text", "true as train")
    tree, _, _ = suffix_tree.suffix_tree(train, **SETTINGS)
    assert len(tree.nodes[0][0].keys) > 20 and len(tree.nodes[1][0].keys) > 0
    counts = collections.Counter()
    for _, text in rows:
        counts.update(tokens(text))
    listed = np.arange(len(tree.counts)) + 2
    root = np.concatenate([tree.root(np.array([0])), tree.root(listed)])
    other = 1 - root.sum()  # words that are not frequent, and the unknown word
    for depth in (1, 2):
        for key in tree.nodes[depth - 1][0].keys[:40]:
            symbol = np.concatenate([[0], listed, [1]])
            logs, found = tree.factor(np.full(len(symbol), key), symbol, depth)
            assert found.all()
            assert abs((np.append(root, other) * 10.0**logs).sum() - 1) < 1e-6


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_tree.score_texts(docs).count() == 0
    held = next(i for i in range(100) if crc(i, 7) == 2)
    only = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    row = suffix_tree.score_texts(only).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def full_tree_scores(rows, gain):
    """Scores of (text, train) rows by the definition: every context of every length, in Python."""
    texts = [[*tokens(text), None] for text, _ in rows]
    train = [t for t, (_, use) in zip(texts, rows) if use]
    counts = collections.Counter(s for t in train for s in t)
    n, v = sum(counts.values()), len(counts)
    follow = collections.defaultdict(collections.Counter)
    for t in train:
        for i, s in enumerate(t):
            for d in range(1, i + 1):
                follow[tuple(t[i - d : i])][s] += 1
    nodes = set()

    def p(symbol, context):
        while context and context not in nodes:
            context = context[1:]
        if not context:
            return (counts[symbol] + 1) / (n + v + 1)
        total = sum(follow[context].values())
        return (follow[context][symbol] + suffix_tree.SMOOTH * p(symbol, context[1:])) / (total + suffix_tree.SMOOTH)

    for context in sorted(follow, key=len):
        total, seen = sum(follow[context].values()), follow[context]
        before = {s: p(s, context[1:]) for s in seen}
        here = {s: (seen[s] + suffix_tree.SMOOTH * before[s]) / (total + suffix_tree.SMOOTH) for s in seen}
        rest = suffix_tree.SMOOTH / (total + suffix_tree.SMOOTH)
        divergence = sum(here[s] * math.log(here[s] / before[s]) for s in seen) + rest * (1 - sum(before.values())) * math.log(rest)
        if total * divergence >= gain:
            nodes.add(context)
    return [sum(math.log10(p(s, tuple(t[:i]))) for i, s in enumerate(t)) for t in texts], nodes


@pytest.mark.parametrize("levels, heavy", [(3, 40), (1, 1 << 19), (2, 5)])
def test_all_contexts_that_diverge_are_nodes(spark, monkeypatch, levels, heavy):
    """Contexts of a few occurrences, words that are rare, and nodes of more than two words: as many
    texts as make any share of the tokens small."""
    monkeypatch.setattr(suffix_tree, "LEVELS", levels)
    monkeypatch.setattr(suffix_tree, "CHUNK", 2000)
    monkeypatch.setattr(suffix_tree, "HEAVY", heavy)
    monkeypatch.setattr(suffix_tree, "CELLS", 100)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(300)]
    # what follows the rare word is known by the word; what follows a b c d by the word five before
    rows += [(i, " ".join([*rng.choices(words, k=3), "rare", f"after{i % 2}"])) for i in range(300, 320)]
    for i in range(320, 560):
        lead = rng.choice("xy")
        rows.append((i, f"{rng.choice(words)} {lead} a b c d {lead}{lead} {rng.choice(words)}"))
    rows += [(900, None), (901, ""), (902, "never seen rare after0"), (903, "q x a b c d xx")]
    want, nodes = full_tree_scores([(text, crc(i, 7) != 2) for i, text in rows], 15.0)
    assert max(map(len, nodes)) >= 5 and (b"rare",) in nodes
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(docs, gain=15.0).collect()}
    assert len(got) == len(rows)
    for (i, _), score in zip(rows, want):
        assert abs(got[i] - score) <= 1e-9 * max(1, abs(score)), i
