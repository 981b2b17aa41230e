import math
import random

import numpy as np

from assay.llm.kd_topk import KDTree, scaled_vectors, top_k


def brute(candidates, queries, k):
    out = []
    for qid, q in queries:
        best = sorted(((-sum(int(a) * int(b) for a, b in zip(q, v)), i) for i, v in candidates if i != qid and len(v) == len(q)))[:k]
        out += [(qid, r, i, max(-2**63, min(2**63 - 1, -s))) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_matches_brute_force_with_ties_and_lengths(spark, rows):
    rng = random.Random(1)
    vecs = [(i, [float(rng.randint(-3, 3)) for _ in range(6)]) for i in range(400)]
    vecs += [(1000 + i, [2.0] * 6) for i in range(60)]  # a common vector
    vecs += [(2000 + i, [float(i), 1.0]) for i in range(7)] + [(3000, []), (3050, [])]
    df = spark.createDataFrame(vecs, "id long, vec array<double>")
    queries = df.where("id % 10 = 0")
    got = rows(top_k(df, queries, 5, shard_rows=50, leaf=8))
    assert sorted(got) == brute(vecs, [v for v in vecs if v[0] % 10 == 0], 5)


def test_large_components_are_exact(spark, rows):
    vecs = [(0, [2.0**40, 1.0]), (1, [2.0**40, 3.0]), (2, [2.0**20, -5.0]), (3, [1.0, 2.0**22])]
    df = spark.createDataFrame(vecs, "id long, vec array<double>")
    assert rows(top_k(df, df, 2)) == brute(vecs, vecs, 2)


def test_bad_vectors_take_no_part_and_edges(spark, rows):
    data = [(0, [0.5, -0.25], "a"), (50, [0.1, 0.2], "b"), (100, None, "c"), (150, [None, 1.0], "d"), (200, [math.nan, 1.0], "e"),
            (250, [math.inf, 1.0], "f"), (None, [1.0, 1.0], "g"), (50, [0.1, 0.2], "repeated")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string")
    v = scaled_vectors(df, "vec_id", "embedding")
    vec = {r.id: list(r.vec) for r in v.collect()}
    assert vec == {0: [128.0, -64.0], 50: [math.floor(256 * float(np.float32(0.1))), math.floor(256 * float(np.float32(0.2)))]}
    got = rows(top_k(v, v.where("id % 50 = 0"), 5))
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 50), (0, 2, 50), (50, 1, 0)]
    assert top_k(v.limit(0), v.limit(0)).count() == 0


def test_tree_boxes_are_tight():
    rng = np.random.default_rng(0)
    x = rng.integers(-9, 9, (300, 4)).astype(float)
    t = KDTree(x, np.arange(300), 16)
    for (a, b), lo, hi, first in zip(t.span, t.lo, t.hi, t.first):
        assert (t.x[a:b].min(0) == lo).all() and (t.x[a:b].max(0) == hi).all() and t.ids[a:b].min() == first
