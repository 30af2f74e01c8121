"""Conversation operators against brute force."""

import hashlib
import random
import zlib

import pytest

from threadloom.llm import prefix_trie, role_repair, sequence

SCHEMA = "conv_id bigint, turn bigint, role string, text string, a string, pos string, sha256 string"


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)


def brute_nodes(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = {}
    for c, q in seqs.items():
        for d in range(len(q) + 1):
            nodes.setdefault(tuple(q[:d]), []).append(c)
    out = []
    for p, cs in nodes.items():
        sub = [m for m in nodes if m[: len(p)] == p]
        kids = [m for m in nodes if len(m) == len(p) + 1 and m[: len(p)] == p]
        leaves = [m for m in sub if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in nodes)]
        saved = sum((len(nodes[m]) - 1) * len(m[-1][1]) for m in sub if m)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(seqs[c]) == len(p)))
        out.append((
            min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(kids), len(leaves), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed, n=60, longest=30):
    rng = random.Random(seed)
    texts = ["a", "bb", "", None, "ccc", "Öl"]
    rows = []
    for c in rng.sample(range(250), n):
        for _ in range(rng.choice([1, 2, 3, 5, 8, rng.randint(1, longest)])):
            rows.append((c, rng.choice([None, *range(30)]), rng.choice(["user", "user", None, "system"]), rng.choice(texts)))
    rows += rng.sample(rows, 5)
    rows += [(None, 1, "user", "lost"), (100, None, None, None)]
    return rows


@pytest.mark.parametrize(("seed", "width"), [(1, 8), (2, 3), (3, 1)])
def test_trie_matches_brute_force(spark, seed, width, monkeypatch):
    rows = conversations(seed)
    got = prefix_trie.prefix_nodes(table(spark, rows), width)
    assert got.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    assert sorted(map(tuple, got.collect()), key=str) == brute_nodes(rows)


def test_trie_of_long_and_hot_conversations(spark):
    rows = [(7, i, "user", f"t{i % 11}") for i in range(900)]
    rows += [(c, i, "user", f"t{i % 11}") for c in range(1000, 1400) for i in range(2)]
    rows += [(c, i, "user", "z" * (5000 * (c == 701) + 1)) for c in (700, 701) for i in range(3)]
    got = prefix_trie.prefix_nodes(table(spark, rows))
    want = {r[:2] + r[3:4] + r[7:]: r for r in small_nodes(rows)}
    assert {(r[0], r[1], r[3], r[7]): tuple(r) for r in got.collect()} == want


def small_nodes(rows):
    """As brute_nodes, but by parents instead of all pairs of nodes."""
    own = {}
    for c, _, role, text in rows:
        own.setdefault(c, []).append((role, text))
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = {}
    for c, q in seqs.items():
        for d in range(len(q) + 1):
            nodes.setdefault(tuple(q[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
        if p:
            up = p[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    for p, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(seqs[c]) == len(p)))
        yield (
            min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), kids.get(p, 0), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        )


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_nodes(table(spark, [])).count() == 0
    assert prefix_trie.prefix_nodes(table(spark, [(None, 1, "user", "x")])).count() == 0


MOVES = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("P", "u"): "U", ("U", "a"): "P"}
ROLE = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, must go, truncated), from the end backwards."""
    best = {"E": (0, "", ()), "P": (0, "", ())}

    def spread(best):
        changed = True
        while changed:
            changed = False
            for q in "ESUP":
                for x in "ua":
                    after = best.get(MOVES.get((q, x)))
                    if after:
                        way = (after[0] + 3, "I" + after[1], (f"{ROLE[x]}:", *after[2]))
                        if q not in best or way[:2] < best[q][:2]:
                            best[q], changed = way, True
        return best

    best = spread(best)
    for role, text, gone, cut in reversed(rows):
        now = {}
        for q in "ESUP":
            ways = []
            if q in best:
                c, audit, lines = best[q]
                ways.append((c + 4, "D" + audit, lines))
            if not gone:
                for x, op in ((role[:1], "K"), ("u", "R"), ("a", "R")):
                    after = best.get(MOVES.get((q, x)))
                    if after:
                        fee = 3 * (op == "R") + 3 * cut
                        ways.append((after[0] + fee, op + after[1], (f"{role if op == 'K' else ROLE[x]}:{text}", *after[2])))
            if ways:
                now[q] = min(ways)
        best = spread(now)
    return best["E"]


def brute_repairs(rows):
    convs = {}
    for c, turn, role, text in rows:
        mine = convs.setdefault(c, [])
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(x): None for x in ".!?"})
        if kind == 4:
            role = "user"
        mine += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for c, mine in convs.items():
        mine.sort()
        seen, faults, read = set(), [], []
        for _, _, role, text in mine:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            read.append((role, text, fault in ("b", "d"), fault == "t"))
        named = [t for has, t, _, _ in mine if has]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit, lines = cheapest(read)
        yield (
            c, max(named) - min(named) + 1 - len(set(named)) if named else 0, *[faults.count(f) for f in "bdt"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


def chats(seed, n=120, longest=40):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "So?  ", " ", "", None, "Good!\n", "a.b", "é"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "ummm"]
    rows = []
    for c in range(n):
        for i in range(rng.randint(1, rng.choice([3, 8, longest]))):
            rows.append((c, rng.choice([i, i, i, i, None, i // 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"{i}."))
    return rows + rng.sample(rows, 6) + [(None, 3, "user", "x."), (None, None, "assistant", "y"), (1234, 12, "user", "dropped")]


@pytest.mark.parametrize(("seed", "span"), [(1, 1 << 16), (2, 5), (3, 1)])
def test_repairs_match_brute_force(spark, seed, span):
    rows = chats(seed)
    got = role_repair.repair_conversations(table(spark, rows), span)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_repairs(rows), key=str)


def test_repair_of_nothing_and_of_all_dropped(spark):
    assert role_repair.repair_conversations(table(spark, [])).count() == 0
    turn = next(t for t in range(99) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = role_repair.repair_conversations(table(spark, [(5, turn, "user", "x")])).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_graph_of_another_grammar():
    """What may follow a pair depends on the node below it."""
    graph = role_repair.Graph((("S", "Pair"), ("S", "s Pair a"), ("Pair", "u a")))
    for symbols, cost in (("ua", 0), ("suaa", 0), ("sua", 3), ("uaa", 4), ("a", 3), ("saaa", 3), ("s", 6)):
        tops, _ = graph.read(symbols, graph.root)
        assert graph.closing(tops)[0] == cost, symbols


@pytest.mark.parametrize("size", [4 << 20, 40])
def test_digests_over_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(sequence, "PIECE_BYTES", size)
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 3, -4]), 9, i, str(i).encode() * rng.randint(0, 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, l bigint, o bigint, piece binary").repartition(7)
    got = {r["k"]: r["sha256"] for r in sequence.ordered_sha256(df, ["k", "l"], ["o"], "piece", "\n", "t").collect()}
    for k in (1, 2, 3, -4):
        assert got.pop(k) == hashlib.sha256(b"\n".join(r[3] for r in rows if r[0] == k)).hexdigest()
    assert not got


def test_running_sums_over_spans(spark):
    rows = [(1, i, i * i) for i in range(50)] + [(None, i, 3) for i in range(9)] + [(2, 4, 5)]
    df = spark.createDataFrame(rows, "g bigint, p bigint, v bigint").repartition(4)
    got = sequence.running(df, "g", "p", {"s": ("sum", "v"), "x": ("bit_xor", "v")}, span=8)
    assert got.columns == ["g", "p", "v", "s", "x"]
    for g, p, v, s, x in got.collect():
        before = [r[2] for r in rows if r[0] == g and r[1] < p]
        total = 0
        for b in before:
            total ^= b
        assert (s, x) == (sum(before), total)
