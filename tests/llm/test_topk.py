"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest

from tillsight.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, queries, k):
    sound = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in sound:
        if q in queries:
            hits = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def table(seed, n, dim, ties=False):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(size=dim).astype(np.float32).round(0 if ties else 6).tolist(), 1) for i in range(n)]
    rows += [(n + i, rows[3][1], 1) for i in range(30)]
    odd = [None, [None] * dim, [float("nan")] * dim, [float("-inf")] + [0.0] * (dim - 1), [0.0] * dim, [1.0], []]
    return rows + [(n + 100 + i, v, None) for i, v in enumerate(odd)]


@pytest.mark.parametrize("seed,k,ties,blocks,slices", [(1, 5, False, (1024, 4096), 4), (2, 5, True, (3, 17), 3), (3, 40, False, (2, 9), 8)])
def test_top_k_equals_brute_force(spark, monkeypatch, seed, k, ties, blocks, slices):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    rows = table(seed, 200, 12, ties)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), k, slices=slices)
    assert sorted(map(tuple, got.collect())) == by_hand(rows, set(range(0, 400, 10)), k)


def test_few_candidates_large_numbers_and_odd_tables(spark):
    rows = [(0, [1.0, 2.0], 1), (50, [3.0, -4.0], 1), (7, [1e6, 1e6], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, df.where("vec_id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == by_hand(rows, {0, 50}, 5)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0
    one = df.where("vec_id = 0")
    assert topk.top_k(one, one).count() == 0
    twice = one.union(one).union(df)
    assert {r.vec_id for r in topk.top_k(twice, one).collect()} == {7, 50}
    big = spark.createDataFrame([(0, [1e7, 1.0], 1), (1, [9e6, 5.0], 1), (2, [9e6, 4.0], 1)], SCHEMA)
    assert sorted(map(tuple, topk.top_k(big, big).collect())) == by_hand([tuple(r) for r in big.collect()], {0, 1, 2}, 5)


def test_vectors_of_length_zero_and_large_components(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(i, [], 1) for i in range(0, 140, 7)] + [(200 + i, [i / 100, 1.0], 1) for i in range(20)]
    # components past 2**45 stay in the search
    rows += [(300, [1e14, 0.5], 1), (301, [0.0, 3.0], 1), (303, [-0.25, 2.0**20], 1)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = topk.top_k(df, df.where("vec_id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == by_hand(rows, {0, 50, 100, 200, 300}, 5)
    # whole numbers tell scores apart that doubles do not
    near = [(i, [3e6 + i % 3, 7.0 + i / 256, 1.0], 1) for i in range(30)]
    df = spark.createDataFrame(near, schema).repartition(4)
    got = topk.top_k(df, df.where("vec_id % 10 = 0"))
    assert sorted(map(tuple, got.collect())) == by_hand(near, {0, 10, 20}, 5)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        far = spark.createDataFrame([(0, [1e14, 1.0], 1), (1, [1e14, 1.0], 1)], schema)
        topk.top_k(far, far).collect()
    # what is far below the best may have any size
    low = [(0, [1e12], 1), (1, [-1e15], 1)] + [(2 + i, [-float(i)], 1) for i in range(6)]
    df = spark.createDataFrame(low, schema)
    assert sorted(map(tuple, topk.top_k(df, df.where("vec_id = 0")).collect())) == by_hand(low, {0}, 5)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(df, df.where("vec_id = 0"), k=7).collect()


def test_candidates_are_dealt_once(spark):
    """Only query blocks are sent to every group; vectors of candidates are shuffled once a phase."""
    rows = [(i, [float(i % 7), float(i % 11)], 1) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    plan = topk.top_k(df, df.where("vec_id % 50 = 0"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and plan.count("hashpartitioning(group") == 1
