"""Exact and tree search against brute force."""

import functools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.llm import exact_search, tiles, tree_search


def vectors(n=700, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = centres[rng.integers(0, 6, n)] + 0.4 * rng.normal(size=(n, dim))
    out[50:60] = out[50]  # repeated vectors: ties
    return out.astype(np.float32)


SCHEMA = "vec_id long, embedding array<float>, score int"


def table(spark, data):
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(data)]
    rows += [
        (10_000, None, 1), (10_100, [], 1), (10_200, [1.0, float("nan")], 1), (10_300, [float("inf")] * 12, 1),
        (10_400, [None] * 12, 1), (None, [0.5] * 12, 1), (10_500, [1.0, 2.0], 1), (10_600, [2.0, 2.0], 1),
        (10_700, [0.0] * 12, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute(data, ids, queries, k, score):
    out = {}
    for q in queries:
        scores = score(data, data[ids.index(q)])
        order = sorted((-s, i) for s, i in zip(scores, ids) if i != q)[:k]
        out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(order, 1)]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 90, "block_rows": 3}])
def test_exact_top_k(spark, sizes):
    data = vectors()
    got = collected(exact_search.exact_top_k(table(spark, data), F.col("vec_id") % 100 == 0, **sizes))
    whole = np.floor(1024 * data.astype(float)).astype(np.int64)
    ids = [*range(len(data)), 10_700]
    whole = np.concatenate([whole, np.zeros((1, 12), np.int64)])
    want = brute(whole, ids, [i for i in ids if i % 100 == 0], 10, lambda d, q: (d @ q).tolist())
    want[10_500] = [(1, 10_600, 1024 * 1024 * 6)]
    want[10_600] = [(1, 10_500, 1024 * 1024 * 6)]
    assert got == want


def test_large_components_stay_exact(spark):
    rows = [(0, [1e8, 3.0]), (1, [1e8, 2.0]), (2, [1e8, 2.0009765625])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(exact_search.exact_top_k(df, F.col("vec_id") == 0, scale=16))[0]
    big = (16 * 10**8) ** 2
    assert [(i, s) for _, i, s in got] == [(1, big + 48 * 32), (2, big + 48 * 32)]


def test_factor_one_is_exact(spark):
    data = vectors()
    got = collected(
        tree_search.nearest(table(spark, data), F.col("vec_id") % 20 == 0, factor=1.0, leaf=8, shard_rows=200, block_rows=7)
    )
    ids = list(range(len(data)))
    wide = data.astype(float)
    want = brute(wide, ids, [i for i in ids if i % 20 == 0], 20, lambda d, q: np.einsum("ij,j->i", d, q).tolist())
    for q, rows in want.items():
        assert [i for _, i, _ in got[q]] == [i for _, i, _ in rows]
        np.testing.assert_allclose([s for *_, s in got[q]], [s for *_, s in rows], rtol=1e-12)
    assert 10_700 not in got and 10_000 not in got


def test_a_smaller_factor_visits_fewer_and_finds_most():
    data = vectors(6000, 16).astype(float)
    ids = np.arange(len(data))
    queries = ids[::60]
    seen = {}
    for factor in (1.0, 0.6):
        tree = tree_search.VantageTree(data, 32)
        rows, places, _ = tree.search(queries, data[queries], ids, 20, factor)
        seen[factor] = (tree.visited, set(zip(rows.tolist(), places.tolist())))
    assert seen[0.6][0] < seen[1.0][0] < len(queries) * len(ids)
    assert len(seen[0.6][1] & seen[1.0][1]) >= 0.9 * len(seen[1.0][1])


def test_a_tree_serves_all_blocks_of_its_shard():
    data, built = np.random.default_rng(5).normal(size=(300, 4)), []

    def build(v):
        built.append(len(v))
        return tree_search.VantageTree(v, 16)

    def row(shard, low, high, q):
        return {"shard": shard, "dim": 4, "q_ids": np.array([q]).tobytes(), "q_data": data[q].tobytes(),
                "v_ids": np.arange(low, high).tobytes(), "v_data": data[low:high].tobytes()}

    rows = [row(7, 0, 200, q) for q in range(5)] + [row(9, 200, 300, q) for q in range(5)]
    batches = [pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])]
    tile = functools.partial(tree_search._tile, k=3, factor=1.0)
    out = list(tiles._run(iter(batches), build, tile, "double"))
    assert built == [200, 100]
    for batch, r in zip(out, rows):
        q, (low, high) = int(np.frombuffer(r["q_ids"], np.int64)[0]), (0, 200) if r["shard"] == 7 else (200, 300)
        order = sorted((i for i in range(low, high) if i != q), key=lambda i: -float(data[q] @ data[i]))[:3]
        assert sorted(batch.column("vec_id").to_pylist()) == sorted(order)


def test_no_matrix_passes_a_single_task(spark):
    data, ids = np.random.default_rng(3).normal(size=(60, 4)), range(60)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, data)], "vec_id long, embedding array<double>")
    found = exact_search.exact_top_k(rows, F.col("vec_id") < 5)
    assert "SinglePartition" not in found._jdf.queryExecution().sparkPlan().toString()
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_queries_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_search.exact_top_k(empty, F.col("vec_id") >= 0).count() == 0
    assert tree_search.nearest(empty, F.col("vec_id") >= 0).count() == 0
    assert tiles.usable(empty).count() == 0
    assert exact_search.exact_top_k(table(spark, vectors(70)), F.col("vec_id") < 0).count() == 0
