"""Search over vectors with large finite components."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starloom.llm import search


@pytest.mark.parametrize("sharded", [False, True])
def test_large_components_are_scored_exactly(spark, monkeypatch, sharded):
    if sharded:
        monkeypatch.setattr(search, "SHARD", 3)
    rng = random.Random(3)
    size = lambda i: (1.0, 1.0, 1e5, 3e18, 3e38)[i % 5]
    data = [(i, [float(rng.randint(-9, 9)) / 9 * size(i) for _ in range(4)]) for i in range(40)] + [(40, [3e38] * 4), (41, [3e38] * 3 + [2.9e38]), (42, [-3e38] * 4)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    whole = {r["vec_id"]: [int(x // (1 / 256)) if abs(x) < 1e6 else int(x) * 256 for x in r["embedding"]] for r in df.collect()}
    want = []
    for q in whole:
        scores = {i: sum(a * b for a, b in zip(whole[q], v)) for i, v in whole.items() if i != q}
        for rank, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:5], 1):
            want.append((q, rank, i, min(max(scores[i], -(1 << 63)), (1 << 63) - 1)))
    assert sorted(map(tuple, search.top_k(df, F.lit(True)).collect())) == sorted(want)


def test_order_beyond_longs():
    values = sorted(s * (1 << n) + d for n in (63, 64, 71, 72, 80, 500) for d in (-1, 0, 1) for s in (1, -1))
    values = [v for v in values if not search.LEAST < v < search.MOST]
    keys = [search._order_of(v) for v in values]
    assert keys == sorted(keys) and len(set(keys)) == len(values)
    assert search._order_of(search.MOST - 1) is None


def test_copies_of_the_queries_are_not_broadcast(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "vec_id long, embedding array<float>")
    plan = search.top_k(df, F.col("vec_id") % 5 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "BroadcastHashJoin" not in plan  # each group of shards gets all queries, which no estimate counts


@pytest.mark.parametrize("group", [1, 3, 100])
def test_groups_do_not_change_the_result(spark, monkeypatch, group):
    monkeypatch.setattr(search, "SHARD", 4)
    monkeypatch.setattr(search, "BLOCK", 3)
    monkeypatch.setattr(search, "GROUP", group)
    rng = random.Random(5)
    data = [(i, [float(rng.randint(-5, 5)) for _ in range(3)]) for i in range(60)]
    want = []
    for q, a in data[::5]:
        scores = {i: int(sum(x * y for x, y in zip(a, b)) * 65536) for i, b in data if i != q}
        want += [(q, rank, i, scores[i]) for rank, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i))[:5], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, search.top_k(df, F.col("vec_id") % 5 == 0).collect())) == sorted(want)
