"""Operator 11: the trie of conversation prefixes, by ROLLUP over columns of turn ids.

1. *Turns.* Rows are placed in their conversation by turn (null first; ties by role, then text) and
   cut down to a digest of (role, text) and the text's length.
2. *Column blocks.* Each conversation becomes one row for every ``width`` turns, with a column per
   place that holds the turn's id. A turn id is 128 random-looking bits of (place, role, text), so
   the exclusive-or of the ids of a path names its node. A block carries the node that the blocks
   before it lead to, as running exclusive-ors, so blocks of a long conversation need no rounds.
3. *ROLLUP.* ``GROUP BY block, node before, ROLLUP(columns)`` gives all prefixes of a block at once;
   ``grouping_id`` tells the depth. A node that many conversations share is counted inside the
   tasks first. Groups that reach beyond a conversation's end are left out.
4. *Subtrees.* A second ROLLUP over the same rows adds up two numbers per conversation: 1 if it is
   the smallest member of a leaf, and the characters of its path above the first node of which it
   is the smallest member (all of them if it is of none). With n members, ``above`` characters
   before the node's last text and ``own`` the number of its smallest member,
   ``saved = sum of the numbers - own - (n - 1) * above``: the members' characters from the node on
   are sum(total - above), and every node below is paid once, by its smallest member. No node is
   joined to its ancestors, so a path of any depth costs its length.
5. *Ends.* Conversations that end at a node are sorted by number and hashed in ranges.

Defined cases: rows without conversation id are left out. Null role or text is empty. A repeated
row is a turn of its own. A conversation without turns is a member of the root alone. An empty
table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.sequence import numbered, ordered_sha256, running
from threadloom.sources.tables import stage

WIDTH = 8
GROUP = 100
FRONTS = 6
NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn_id, chars)``: a digest of role and text and the text's code points."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id is not null")
    digest = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    return numbered(
        rows, "conv_id",
        # the first characters are enough to deal rows out; whole texts are compared in the task
        ["turn", "role", F.substring("text", 1, 64)], ["turn", "role", "text"],
        [F.col("conv_id"), digest.alias("turn_id"), F.char_length("text").cast("long").alias("chars")],
        "turns",
    )


def rebuilt(turns: DataFrame, group: int = GROUP, fronts: int = FRONTS) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their first turns: every conversation starts with the first h turns
    of the one at the start of its hundred, h being a hash of its id below ``fronts``, and goes on
    with its own turns after its first h.

    Returns ``(conv_id, pos, turn_id, chars)`` and ``(conv_id, turns)``, which also lists those that
    have no turn left.
    """
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_own"))
    front = turns.where((F.col("pos") < fronts - 1) & (F.col("conv_id") % group == 0))
    lent = front.groupBy(F.col("conv_id").alias("_top")).agg(F.count(F.lit(1)).alias("_lent"))
    plan = own.select(
        "conv_id", "_own", (F.col("conv_id") - F.col("conv_id") % group).alias("_top"),
        (F.crc32(F.col("conv_id").cast("string")) % fronts).alias("_h"),
    ).join(lent, "_top", "left").select(
        "conv_id", "_top", "_h", "_own", F.least("_h", F.coalesce("_lent", F.lit(0))).alias("_head")
    )
    heads = plan.select("conv_id", "_top", "_head").join(
        front.select(F.col("conv_id").alias("_top"), "pos", "turn_id", "chars"), "_top"
    ).where("pos < _head")  # a hundred conversations at most read one front
    tails = turns.join(plan.select("conv_id", "_h", "_head"), "conv_id").where("pos >= _h")
    rows = heads.select("conv_id", "pos", "turn_id", "chars").union(
        tails.select("conv_id", (F.col("pos") - F.col("_h") + F.col("_head")).alias("pos"), "turn_id", "chars")
    )
    return rows, plan.select("conv_id", (F.col("_head") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))).alias("turns"))


def blocks(rows: DataFrame, members: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(conv_id, block, t0.., a, b, before)``: ids of ``width`` turns in columns, the node that the
    blocks before lead to, and the characters of those blocks."""
    ids = rows.select(
        "conv_id", "pos", F.floor(F.col("pos") / width).alias("block"),
        F.struct(
            F.xxhash64("turn_id", "pos").alias("a"), F.xxhash64(F.lit(1), "pos", "turn_id").alias("b"), "chars"
        ).alias("t"),
    )
    wide = ids.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("pos") % width == i, F.col("t"))).alias(f"t{i}") for i in range(width)],
        F.bit_xor("t.a").alias("xa"), F.bit_xor("t.b").alias("xb"), F.sum("t.chars").alias("chars"),
    )
    none = members.where("turns = 0").select("conv_id", F.lit(0).cast("long").alias("block"))
    wide = wide.unionByName(none, allowMissingColumns=True).fillna(0, ["xa", "xb", "chars"])
    return stage(
        running(
            wide, "conv_id", "block",
            {"a": ("bit_xor", "xa"), "b": ("bit_xor", "xb"), "before": ("sum", "chars")},
        ),
        "blocks",
    )


def _rollup(table: DataFrame, width: int, measures: dict[str, str]) -> DataFrame:
    """``(a, b, depth, last, above, measures...)`` of every node, from one ROLLUP over the blocks."""
    columns = [f"t{i}" for i in range(width)]
    grouped = table.sparkSession.sql(
        f"""SELECT block, a AS _a, b AS _b, {', '.join(columns)}, {width} - bit_count(grouping_id()) AS _level,
            min(before) AS _before, {', '.join(f'{e} AS {n}' for n, e in measures.items())}
        FROM {{table}} GROUP BY block, a, b, ROLLUP({', '.join(columns)})""",
        table=table,
    )
    known = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    # level 0 of a later block is the last node of the block before
    valid = grouped.where((known == F.col("_level")) & ((F.col("_level") > 0) | (F.col("block") == 0)))
    for side in "ab":
        node = F.col(f"_{side}")
        for c in columns:
            node = node.bitwiseXOR(F.coalesce(F.col(c)[side], F.lit(0)))
        valid = valid.withColumn(side, node)
    last = F.coalesce(*[F.col(c) for c in reversed(columns)])
    chars = sum((F.coalesce(F.col(c)["chars"], F.lit(0)) for c in columns), F.col("_before"))
    return valid.select(
        "a", "b", (F.col("block") * width + F.col("_level")).cast("long").alias("depth"), last.alias("last"),
        (chars - F.coalesce(last["chars"], F.lit(0))).alias("above"), *measures,
    )


def prefix_trie(rows: DataFrame, members: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The trie of sequences ``(conv_id, pos, turn_id, chars)`` of ``members (conv_id, turns)``.

    Returns nodes ``(a, b, depth, chars, conv_id, n_convs, n_children, n_leaves, saved_tokens,
    parent_a, parent_b, parent_conv_id)`` and ends ``(conv_id, a, b)``: the node at which each
    member ends.
    """
    table = blocks(rows, members, width)
    nodes = stage(_rollup(table, width, {"conv_id": "min(conv_id)"}), "nodes")
    up = [F.when(F.col("depth") > 0, F.col(s).bitwiseXOR(F.col("last")[s])).alias(f"parent_{s}") for s in "ab"]
    tree = nodes.select("a", "b", "depth", "above", "conv_id", *up)
    children = stage(
        tree.where("depth > 0").groupBy(F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(
            F.count(F.lit(1)).alias("n_children")
        ),
        "children",
    )
    # what each conversation brings to the subtrees it lies in
    owned = tree.join(children, ["a", "b"], "left").groupBy("conv_id").agg(
        F.min("above").alias("own"), F.count_if(F.col("n_children").isNull()).alias("leaf")
    )
    whole = table.groupBy("conv_id").agg(
        F.bit_xor("xa").alias("a"), F.bit_xor("xb").alias("b"), F.sum("chars").alias("chars")
    )
    brought = stage(
        whole.join(owned, "conv_id", "left").select(
            "conv_id", "a", "b", F.coalesce("own", "chars").alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf")
        ),
        "brought",
    )
    measured = _rollup(
        table.join(brought.select("conv_id", "own", "leaf"), "conv_id"), width,
        {"n_convs": "count(1)", "n_leaves": "sum(leaf)", "_sum": "sum(own)", "_first": "min(struct(conv_id, own))"},
    )
    saved = F.col("_sum") - F.col("_first.own") - (F.col("n_convs") - 1) * F.col("above")
    full = measured.select(
        "a", "b", "depth", F.coalesce(F.col("last.chars"), F.lit(0)).alias("chars"),
        F.col("_first.conv_id").alias("conv_id"), "n_convs", "n_leaves", saved.alias("saved_tokens"), *up,
    ).join(children, ["a", "b"], "left")
    parents = tree.select(
        F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id")
    )
    # last, so that the children of one node can be split over tasks
    full = full.withColumn("n_children", F.coalesce("n_children", F.lit(0))).join(
        parents, ["parent_a", "parent_b"], "left"
    )
    return full, brought.select("conv_id", "a", "b")


def prefix_nodes(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations, with the digest of its ends."""
    nodes, ends = prefix_trie(*rebuilt(turns(conversations)), width)
    digests = ordered_sha256(
        ends.withColumn("_id", F.encode(F.col("conv_id").cast("string"), "UTF-8")),
        ["a", "b"], ["conv_id"], "_id", ",", "ends",
    )
    return nodes.join(digests, ["a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
seqs AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS own FROM placed GROUP BY conv_id),
hashed AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 6 AS h
  FROM seqs, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(s.own[1:c.h], []), c.own[c.h + 1:]) AS q
  FROM hashed c LEFT JOIN seqs s ON s.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (SELECT conv_id, unnest(range(len(q) + 1)) AS d, q FROM rebuilt),
nodes AS (
  SELECT d, q[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(q) = d), '') AS ends
  FROM prefixes GROUP BY ALL),
kids AS (SELECT p[1:d-1] AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (
  SELECT n.*, coalesce(k, 0) AS k, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(n.p[d].t) END AS saved
  FROM nodes n LEFT JOIN kids ON n.p = kids.p),
below AS (
  SELECT p[1:e] AS p, sum(saved)::BIGINT AS saved, count(*) FILTER (WHERE k = 0) AS leaves
  FROM (SELECT p, saved, k, unnest(range(d + 1)) AS e FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, n.k AS n_children,
  leaves AS n_leaves, below.saved AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below ON below.p = n.p LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d-1]
"""
