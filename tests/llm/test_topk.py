import math
import random

import pytest

from stormledger.llm import topk as T


def brute(rows, queries, k):
    fit = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for q, v in fit:
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fit if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(set(out))


@pytest.mark.parametrize("dims,k,block", [(3, 5, 16), (8, 2, 1000), (1, 7, 7)])
def test_equals_brute_force(spark, dims, k, block):
    rng = random.Random(dims)
    rows = [(i * 3, [rng.choice([-0.5, 0.0, 0.004, rng.uniform(-1, 1)]) for _ in range(dims)]) for i in range(120)]
    rows += [(1000 + i, [0.25] * dims) for i in range(40)]  # one common vector
    rows += [(2000, None), (2001, [float("nan")] + [0.0] * (dims - 1)), (2002, [float("inf")] * dims), (2003, [None] * dims), (None, [0.1] * dims), (2004, [0.0] * dims)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    single = [(i, None if v is None else [None if x is None else __import__("struct").unpack("f", __import__("struct").pack("f", x))[0] for x in v]) for i, v in rows]
    vectors = T.prepared(table)
    queries = {i for i, _ in rows if i is not None and i % 5 == 0}
    got = T.top_k(vectors.filter("vec_id % 5 = 0"), vectors, k, candidate_block=block, query_block=11).collect()
    assert sorted(tuple(r) for r in got) == brute(single, queries, k)


def test_fewer_candidates_and_empty_table(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (50, [0.5])], "vec_id long, embedding array<double>")
    vectors = T.prepared(table)
    got = sorted(tuple(r) for r in T.top_k(vectors, vectors).collect())
    assert got == [(0, 1, 50, 256 * 128), (50, 1, 0, 256 * 128)]
    assert T.top_k(vectors.filter("vec_id < 0"), vectors.filter("vec_id < 0")).count() == 0


def test_walk_stops_early():
    import numpy as np

    vectors = np.zeros((5000, 4), np.int64)
    vectors[:, 0] = np.arange(5000)
    lists = T.Lists(np.arange(5000), vectors)
    met = []

    class Seen(np.ndarray):
        def __getitem__(self, rows):
            met.append(np.size(rows))
            return np.asarray(self)[rows]

    lists.exact = lists.exact.view(Seen)
    rows, scores = lists.search(np.array([2, 0, 0, 0]), -1, 3)
    assert rows.tolist() == [4999, 4998, 4997] and scores.tolist() == [9998, 9996, 9994]
    assert sum(met) < 50
