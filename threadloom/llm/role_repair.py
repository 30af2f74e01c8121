"""Operator 12: the cheapest repair of a conversation's role order, by generalised LR parsing.

The order of roles is a grammar; its LR(0) automaton is built from the productions. A conversation
is read row by row. All stacks that some edits lead to live side by side in a graph: a node is an
automaton state above the node below, made once, so stacks share what they have in common. Before
each row any turns may be inserted; the row is then kept, given another role, or deleted, each at its
price, and complete productions are reduced. Stacks whose tops are the same node merge to the
smallest (cost, audit). The stacks of this grammar are few (its only recursion is to the left), so
the same changes of the whole graph come again and again; each is worked out once and looked up.

Two edit sequences over the same rows and of the same cost are never the beginning of one another
(they hold one letter per row and end with one), so ranks take the place of audits while reading,
and steps back along the graph spell the audit out.

A conversation of more than ``SPAN`` rows is cut into spans of rows. Every span is parsed from every
stack, its (entry, exit) results meet in order, a few numbers a span, and the chosen way is then
spelt out span by span.

Faults of a row, the first counts: *blank* (nothing but white space), *duplicate* (role and text of
an earlier row), *truncated* (ends without ``.``, ``!`` or ``?``).

Defined cases: null role or text is one space, and so is a null id or turn in the text that decides
on damage. Rows without conversation id are one conversation with a null id. Rows of equal turn are
ordered by role, then text. A role that does not begin with s, u or a cannot be kept. Repeated rows
are rows of their own. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.sequence import numbered, ordered_sha256
from threadloom.sources.tables import stage

SPAN = 1 << 16
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}  # roles that edits may give
LEGAL = ("su", "ua", "au")
# start first; s, u, a are the role initials
ROLES = (("Chat", ""), ("Chat", "Turns"), ("Chat", "s Turns"), ("Turns", "Pair"), ("Turns", "Turns Pair"), ("Pair", "u a"))
NOTHING = hashlib.sha256(b"").hexdigest()
MUST_GO = "-"


class Automaton:
    """The LR(0) automaton of a grammar; the first production's left side is the start."""

    def __init__(self, productions):
        self.rules = [(left, tuple(right.split())) for left, right in productions]
        self.start = self.rules[0][0]
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self._state(frozenset((r, 0) for r, (left, _) in enumerate(self.rules) if left == self.start))

    def _state(self, kernel: frozenset) -> int:
        items, todo = set(kernel), list(kernel)
        while todo:
            rule, dot = todo.pop()
            after = self.rules[rule][1][dot:]
            for r, (left, _) in enumerate(self.rules):
                if after and left == after[0] and (r, 0) not in items:
                    items.add((r, 0))
                    todo.append((r, 0))
        items = frozenset(items)
        if items in self.states:
            return self.states.index(items)
        number = len(self.states)
        self.states.append(items)
        self.moves.append({})
        for symbol in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
            self.moves[number][symbol] = self._state(
                frozenset((r, d + 1) for r, d in items if self.rules[r][1][d : d + 1] == (symbol,))
            )
        return number

    def complete(self, state: int, start: bool) -> list[tuple[str, int]]:
        """Left side and length of the productions that are complete in the state."""
        done = [self.rules[r] for r, d in self.states[state] if d == len(self.rules[r][1])]
        return sorted((left, len(right)) for left, right in done if (left == self.start) == start)


class Node:
    """A state on top of the node below it."""

    __slots__ = ("state", "below", "name")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below
        self.name = f"{below.name}.{state}" if below else str(state)


class Graph:
    """All stacks reached so far, and the steps between sets of them. The grammar must have finitely
    many stacks, so no recursion but to the left."""

    def __init__(self, productions=ROLES):
        self.automaton = Automaton(productions)
        self.nodes: dict[tuple, Node] = {}
        self.root = self.node(0, None)
        self.fronts: dict[tuple, int] = {}
        self.known: list[tuple] = []
        self.steps: dict[tuple[int, str], tuple] = {}

    def node(self, state: int, below: Node | None) -> Node:
        key = (state, below.name if below else None)
        if key not in self.nodes:
            self.nodes[key] = Node(state, below)
        return self.nodes[key]

    def shift(self, node: Node, symbol: str) -> list[Node]:
        """Stacks after the symbol and all reductions; a complete one need not be reduced."""
        state = self.automaton.moves[node.state].get(symbol)
        if state is None:
            return []
        found, todo = [], [self.node(state, node)]
        while todo:
            top = todo.pop()
            if self.automaton.moves[top.state] or self.automaton.complete(top.state, True):
                found.append(top)
            for left, size in self.automaton.complete(top.state, False):
                below = top
                for _ in range(size):
                    below = below.below
                todo.append(self.node(self.automaton.moves[below.state][left], below))
        return found

    def accepts(self, node: Node) -> bool:
        for _, size in self.automaton.complete(node.state, True):
            below = node
            for _ in range(size):
                below = below.below
            if below is self.root:
                return True
        return False

    @functools.cache
    def inserted(self, node: Node) -> list[tuple]:
        """(node, cost, letters, roles) after inserting any turns, the cheapest way to each node."""
        best = {node: (0, "", "")}
        todo = [node]
        for at in todo:
            cost, letters, roles = best[at]
            for role in sorted(NAMES):
                for top in self.shift(at, role):
                    if top not in best:  # ways of fewer turns come first
                        best[top] = (cost + INSERT, letters + "I", roles + role)
                        todo.append(top)
        return [(top, *way) for top, way in best.items()]

    def front(self, tops: dict[Node, tuple[int, int]]) -> int:
        """Number of a set of tops with (cost, rank of the audit)."""
        key = tuple(sorted((top.name, cost, rank) for top, (cost, rank) in tops.items()))
        if key not in self.fronts:
            self.fronts[key] = len(self.known)
            self.known.append(tuple(sorted(tops.items(), key=lambda x: x[0].name)))
        return self.fronts[key]

    def step(self, front: int, symbol: str) -> tuple:
        """(front after the row, cost to add, {top: (top before, letters, roles)})."""
        if (front, symbol) in self.steps:
            return self.steps[front, symbol]
        best: dict[Node, tuple] = {}
        fee = TRUNCATED if symbol.isupper() else 0
        for before, (paid, rank) in self.known[front]:
            for at, cost, letters, roles in self.inserted(before):
                edits = [(at, DELETE, "D", ".")]
                if symbol != MUST_GO:
                    edits += [(top, fee, "K", "=") for top in self.shift(at, symbol.lower())]
                    edits += [(top, fee + REROLE, "R", r) for r in sorted(NAMES) for top in self.shift(at, r)]
                for top, price, letter, role in edits:
                    way = (paid + cost + price, (rank, letters + letter), roles + role, before)
                    if top not in best or way[:3] < best[top][:3]:
                        best[top] = way
        least = min(way[0] for way in best.values())
        order = {audit: i for i, audit in enumerate(sorted({way[1] for way in best.values()}))}
        after = self.front({top: (way[0] - least, order[way[1]]) for top, way in best.items()})
        back = {top: (way[3], way[1][1], way[2]) for top, way in best.items()}
        self.steps[front, symbol] = (after, least, back)
        return self.steps[front, symbol]

    def read(self, symbols: str, entry: Node) -> tuple[dict[Node, tuple[int, int]], list[dict]]:
        """(cost, rank of the audit) of each top after the rows, and the ways back."""
        front, cost, backs = self.front({entry: (0, 0)}), 0, []
        for symbol in symbols:
            front, least, back = self.step(front, symbol)
            cost += least
            backs.append(back)
        return {top: (cost + more, rank) for top, (more, rank) in self.known[front]}, backs

    def closing(self, tops: dict[Node, tuple[int, int]]) -> tuple:
        """(cost, top, letters, roles) of the best end."""
        ends = [
            ((paid + cost, rank, letters, roles), top)
            for top, (paid, rank) in tops.items()
            for at, cost, letters, roles in self.inserted(top) if self.accepts(at)
        ]
        (cost, _, letters, roles), top = min(ends, key=lambda e: e[0])
        return cost, top, letters, roles

    def everywhere(self) -> list[Node]:
        """All stacks that the grammar's symbols lead to."""
        seen, todo = {self.root.name: self.root}, [self.root]
        for at in todo:
            for symbol in sorted({s for m in self.automaton.moves for s in m}):
                for top in self.shift(at, symbol):
                    if top.name not in seen:
                        seen[top.name] = top
                        todo.append(top)
        return list(seen.values())


def spelt(backs: list[dict], top: Node) -> list[tuple[str, str]]:
    """(letters, roles) of every row on the way to this top."""
    out = []
    for back in reversed(backs):
        top, letters, roles = back[top]
        out.append((letters, roles))
    return out[::-1]


@functools.cache
def _graph() -> Graph:
    return Graph()


def lines_of(ways: list[tuple[str, str]], first: int, tail: str) -> tuple[list, list, list, list]:
    """Of the repaired turns: the row they stand before or at, their number there, whether they are
    that row, and their new role (null: the row's)."""
    places, numbers, own, roles = [], [], [], []
    for place, (letters, given) in enumerate([*ways, ("I" * len(tail), tail)], first):
        for number, (letter, role) in enumerate(zip(letters, given)):
            if letter != "D":
                places.append(place)
                numbers.append(number)
                own.append(letter != "I")
                roles.append(NAMES.get(role))
    return places, numbers, own, roles


_LINES = "places array<bigint>, numbers array<int>, own array<boolean>, roles array<string>"
_PIECE = pa.schema([
    ("conv_id", pa.int64()), ("span", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("places", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int32())),
    ("own", pa.list_(pa.bool_())), ("roles", pa.list_(pa.string())),
])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _whole(batches: Iterator) -> Iterator:
    graph = _graph()
    for batch in batches:
        rows = []
        for conv, span, symbols in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            tops, backs = graph.read(symbols, graph.root)
            cost, top, letters, roles = graph.closing(tops)
            ways = spelt(backs, top)
            rows.append((conv, span, cost, "".join(x for x, _ in ways) + letters, *lines_of(ways, 0, roles)))
        yield _batch(rows, _PIECE)


_WAYS = pa.schema([
    ("conv_id", pa.int64()), ("span", pa.int64()), ("entry", pa.list_(pa.string())), ("exit", pa.list_(pa.string())),
    ("cost", pa.list_(pa.int64())), ("rank", pa.list_(pa.int32())),
])
_WAYS_SQL = "conv_id bigint, span bigint, entry array<string>, exit array<string>, cost array<bigint>, rank array<int>"


def _ways(batches: Iterator) -> Iterator:
    """For every stack before the span and every one after it, cost and rank of the best audit."""
    graph = _graph()
    for batch in batches:
        rows = []
        for conv, span, symbols in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            found = []
            for entry in graph.everywhere():
                tops, backs = graph.read(symbols, entry)
                found += [
                    (entry.name, top.name, cost, "".join(x for x, _ in spelt(backs, top)))
                    for top, (cost, _) in tops.items()
                ]
            order = {a: i for i, a in enumerate(sorted({f[3] for f in found}))}
            entry, leave, cost, audit = zip(*found)
            rows.append((conv, span, entry, leave, cost, [order[a] for a in audit]))
        yield _batch(rows, _WAYS)


_CHOSEN = pa.schema([
    ("conv_id", pa.int64()), ("span", pa.int64()), ("entry", pa.string()), ("exit", pa.string()),
    ("cost", pa.int64()), ("letters", pa.string()), ("tail", pa.string()),
])


def _choose(table: pa.Table) -> pa.Table:
    """The way of one long conversation through its spans."""
    graph = _graph()
    nodes = {node.name: node for node in graph.everywhere()}
    spans = sorted(table.to_pylist(), key=lambda r: r["span"])
    tops, backs = {graph.root.name: (0, 0)}, []
    for row in spans:
        best: dict[str, tuple] = {}
        for entry, leave, cost, rank in zip(row["entry"], row["exit"], row["cost"], row["rank"]):
            if entry in tops:
                way = (tops[entry][0] + cost, (tops[entry][1], rank), entry)
                if leave not in best or way < best[leave]:
                    best[leave] = way
        order = {audit: i for i, audit in enumerate(sorted({way[1] for way in best.values()}))}
        tops = {leave: (way[0], order[way[1]]) for leave, way in best.items()}
        backs.append({leave: way[2] for leave, way in best.items()})
    cost, top, letters, roles = graph.closing({nodes[n]: v for n, v in tops.items()})
    leave, rows = top.name, []
    for row, back in zip(reversed(spans), reversed(backs)):
        last = row is spans[-1]
        rows.append((
            row["conv_id"], row["span"], back[leave], leave, cost if last else 0, letters if last else "", roles if last else "",
        ))
        leave = back[leave]
    return pa.Table.from_batches([_batch(rows, _CHOSEN)])


def _spell(batches: Iterator, span_rows: int) -> Iterator:
    graph = _graph()
    nodes = {node.name: node for node in graph.everywhere()}
    for batch in batches:
        rows = []
        for conv, span, symbols, entry, leave, cost, letters, tail in zip(*[batch.column(i).to_pylist() for i in range(8)]):
            _, backs = graph.read(symbols, nodes[entry])
            ways = spelt(backs, nodes[leave])
            audit = "".join(x for x, _ in ways) + letters
            rows.append((conv, span, cost, audit, *lines_of(ways, span * span_rows, tail)))
        yield _batch(rows, _PIECE)


def visible(text: Column) -> Column:
    """The text without white space (space and the characters 9 to 13) at its end."""
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` after damage that a hash of ``conv_id:turn`` decides: of 20
    rows one is dropped, one emptied, one loses its ends of sentences, one is repeated, and one gets
    the role user."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        one("role").alias("role"), one("text").alias("text"), kind.alias("_kind"),
    ).where("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_copy")).drop("_copy")


def placed(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` with their place ``pos`` and first ``fault``, if any."""
    rows = numbered(
        rows, "conv_id", ["turn", "role", F.substring("text", 1, 64)], ["turn", "role", "text"],
        [F.col(c) for c in ("conv_id", "turn", "role", "text")], "rows",
    )
    digest = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = rows.withColumn("_digest", digest)
    # of any number of equal rows only the first is looked up, so none of them meet
    first = rows.groupBy(F.col("conv_id").alias("_c"), F.col("_digest").alias("_d")).agg(F.min("pos").alias("_first"))
    known = rows.join(
        first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_digest") == F.col("_d")) & (F.col("pos") == F.col("_first")),
        "left",
    )
    seen = visible(F.col("text"))
    fault = (
        F.when(seen == "", "blank").when(F.col("_first").isNull(), "duplicate")
        .when(~F.right(seen, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return known.select("conv_id", "turn", "role", "text", "pos", fault.alias("fault"))


def repair(rows: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of placed rows.

    Returns one row per conversation ``(conv_id, cost, audit, illegal)`` and the repaired turns
    ``(conv_id, pos, number, role, text)``; inserted ones have an empty text and precede the row at
    their place.
    """
    first = F.substring("role", 1, 1)
    code = F.when(first.isin("s", "u", "a"), first).otherwise("x")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", F.upper(code)).otherwise(code)
    )
    spans = stage(
        rows.select("conv_id", F.floor(F.col("pos") / span).alias("span"), F.struct("pos", symbol.alias("s"), code.alias("c")).alias("e"))
        .groupBy("conv_id", "span").agg(F.sort_array(F.collect_list("e")).alias("e"))
        .select("conv_id", "span", F.array_join("e.s", "").alias("symbols"), F.array_join("e.c", "").alias("codes")),
        "symbols",
    )
    many = spans.where("span > 0").select(F.col("conv_id").alias("_many")).distinct()
    is_long = F.col("conv_id").eqNullSafe(F.col("_many"))
    short, long = spans.join(many, is_long, "left_anti"), spans.join(many, is_long, "left_semi")
    sql = f"conv_id bigint, span bigint, cost bigint, audit string, {_LINES}"
    whole = short.select("conv_id", "span", "symbols").mapInArrow(_whole, sql)
    chosen = long.select("conv_id", "span", "symbols").mapInArrow(_ways, _WAYS_SQL).groupBy("conv_id").applyInArrow(
        _choose, "conv_id bigint, span bigint, entry string, exit string, cost bigint, letters string, tail string"
    ).select(F.col("conv_id").alias("_c"), F.col("span").alias("_s"), "entry", "exit", "cost", "letters", "tail")
    parts = long.join(chosen, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("span") == F.col("_s"))).select(
        "conv_id", "span", "symbols", "entry", "exit", "cost", "letters", "tail"
    ).mapInArrow(functools.partial(_spell, span_rows=span), sql)
    pieces = stage(whole.union(parts), "repairs")
    # neighbours within a span, and the pair of its first row and the last one of the span before
    edges = spans.select(
        "conv_id", "span", F.substring("codes", 1, 1).alias("_first"), F.right("codes", F.lit(1)).alias("_last"),
        (F.char_length("codes") - 1 - F.regexp_count("codes", F.lit("s(?=u)|u(?=a)|a(?=u)"))).alias("_inside"),
    )
    pair = F.concat(F.lag("_last").over(Window.partitionBy("conv_id").orderBy("span")), "_first")
    illegal = edges.select(
        F.col("conv_id").alias("_c"), (F.col("_inside") + F.coalesce((~pair.isin(*LEGAL)).cast("int"), F.lit(0))).alias("_n")
    ).groupBy("_c").agg(F.sum("_n").alias("illegal"))
    summary = pieces.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("span", "audit"))).alias("_e")
    ).join(illegal, F.col("conv_id").eqNullSafe(F.col("_c"))).select(
        "conv_id", "cost", F.array_join("_e.audit", "").alias("audit"), "illegal"
    )
    made = pieces.select("conv_id", F.inline(F.arrays_zip("places", "numbers", "own", "roles"))).select(
        "conv_id", F.col("places").alias("pos"), F.col("numbers").alias("number"), "own", F.col("roles").alias("_given")
    )
    old = rows.select(F.col("conv_id").alias("_c"), F.col("pos").alias("_p"), F.col("role").alias("_role"), "text")
    turns = made.join(
        old, F.col("own") & F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("pos") == F.col("_p")), "left"
    ).select(
        "conv_id", "pos", "number", F.coalesce("_given", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return summary, turns


def repair_conversations(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """Faults, cost, audit and digest of the repair of every conversation, after damage."""
    rows = stage(placed(damage(conversations)), "placed")
    faults = rows.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    summary, turns = repair(rows, span)
    line = F.encode(F.concat("role", F.lit(":"), "text"), "UTF-8").alias("_line")
    digests = ordered_sha256(
        turns.select(F.isnull("conv_id").cast("long").alias("_none"), F.coalesce("conv_id", F.lit(0)).alias("_id"), "pos", "number", line),
        ["_none", "_id"], ["pos", "number"], "_line", "\n", "lines",
    ).select(F.when(F.col("_none") == 0, F.col("_id")).alias("conv_id"), "sha256")
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (faults, summary, digests):
        part = part.withColumnRenamed("conv_id", "_key")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_key")), "left").drop("_key")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", *[count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(NOTHING)).alias("repaired_sha256"),
    )


SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1),
      lambda i: ascii(substr(k, i, 1))::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, range(2) copies(c) WHERE kind <> 0 AND (c = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS r, CASE WHEN last = '' THEN 'b' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS bad
  FROM placed),
-- grammar: E nothing yet, S after s, U after an open u, P after a pair
shifts(f, x, g) AS (VALUES ('E', 's', 'S'), ('E', 'u', 'U'), ('S', 'u', 'U'), ('P', 'u', 'U'), ('U', 'a', 'P')),
inserts(f, g, ins, added) AS (
  VALUES ('E', 'E', '', ''), ('E', 'U', 'I', chr(10) || 'user:'), ('E', 'P', 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('S', 'S', '', ''), ('S', 'U', 'I', chr(10) || 'user:'), ('S', 'P', 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('U', 'U', '', ''), ('U', 'P', 'I', chr(10) || 'assistant:'), ('P', 'P', '', ''), ('P', 'U', 'I', chr(10) || 'user:')),
edits AS (
  SELECT n.f, n.ins, n.added, 'K' AS op, s.x, NULL AS given, s.g, 3 * length(ins) AS price FROM inserts n JOIN shifts s ON s.f = n.g
  UNION ALL SELECT n.f, n.ins, n.added, 'R', NULL, CASE s.x WHEN 'u' THEN 'user' ELSE 'assistant' END, s.g, 3 * length(ins) + 3
    FROM inserts n JOIN shifts s ON s.f = n.g AND s.x <> 's'
  UNION ALL SELECT f, ins, added, 'D', NULL, NULL, g, 3 * length(ins) + 4 FROM inserts),
ids AS (SELECT conv_id, row_number() OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations)),
readable AS (SELECT n, f.* FROM faulty f JOIN ids ON f.conv_id IS NOT DISTINCT FROM ids.conv_id),
steps(n, i, f, cost, audit, said) AS (
  SELECT n, 0::BIGINT, 'E', 0, '', '' FROM ids
  UNION ALL
  SELECT n, i, f, cost, audit, said FROM (
    SELECT s.n, r.i, e.g AS f, s.cost + e.price + CASE WHEN r.fault = 't' AND op <> 'D' THEN 3 ELSE 0 END AS cost,
      s.audit || ins || op AS audit,
      s.said || added || CASE op WHEN 'D' THEN '' ELSE chr(10) || coalesce(given, r.role) || ':' || r.text END AS said
    FROM steps s JOIN readable r ON r.n = s.n AND r.i = s.i + 1
      JOIN edits e ON e.f = s.f AND (op = 'D' OR r.fault NOT IN ('b', 'd')) AND (op <> 'K' OR e.x = r.r))
  QUALIFY row_number() OVER (PARTITION BY n, f ORDER BY cost, audit) = 1),
finished AS (
  SELECT n, cost + 3 * length(ins) AS cost, audit || ins AS audit, said || added AS said
  FROM (SELECT * FROM steps QUALIFY i = max(i) OVER (PARTITION BY n)) s JOIN inserts e ON s.f = e.f AND e.g IN ('E', 'P')
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY cost + 3 * length(ins), audit || ins) = 1),
counted AS (
  SELECT n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
    count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE bad) AS illegal
  FROM readable GROUP BY n)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
  sha256(substr(said, 2)) AS repaired_sha256
FROM ids JOIN finished USING (n) LEFT JOIN counted USING (n)
"""
