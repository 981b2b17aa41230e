import math

import numpy as np
import pytest

from assay.llm.whitening import fit, integer_vectors, whiten_embeddings


def dense(vectors, k):
    """n, deviations, whitened rows (signs free), explained: a dense solver over the distinct vectors."""
    x = np.array(vectors, dtype=object)
    u = np.array(sorted({tuple(r) for r in vectors}), dtype=object)
    n, sums = len(u), u.sum(axis=0)
    away = n * x - sums
    centred = ((n * u - sums) / n).astype(float)
    values, q = np.linalg.eigh(centred.T @ centred / n)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    keep = values > 1e-9 * values[0]
    values, q = values[keep], q[:, keep]
    return n, [sum(int(v) ** 2 for v in r) for r in away], (away / n).astype(float) @ q / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def columns(df):
    rows = df.collect()
    ids = sorted({r.id for r in rows})
    k = max(r.component for r in rows)
    at = {(r.id, r.component): r for r in rows}
    white = np.array([[at[i, c].whitened for c in range(1, k + 1)] for i in ids])
    return ids, k, white, {i: at[i, 1] for i in ids}, [at[ids[0], c].explained for c in range(1, k + 1)]


def agree(got, want):
    signs = np.sign((got * want).sum(axis=0))
    return np.abs(got - want * signs).max()


def test_matches_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    data = (rng.standard_normal((90, 9)) * np.array([5, 4, 3, 2, 2, 1, 1, 0.5, 0.4]) + 3).astype(float)
    data[40:60] = data[0]  # a common vector
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(data)], "vec_id long, embedding array<double>")
    out = whiten_embeddings(df, "vec_id", "embedding", components=4)
    ids, k, white, first, explained = columns(out)
    x = [[math.floor(64 * v) + 1_000_000 for v in r] for r in data.tolist()]
    n, deviations, want, share = dense(x, 4)
    assert (ids, k, n) == (list(range(90)), 4, 70) and all(first[i].n == n for i in ids)
    assert [first[i].deviation for i in ids] == deviations
    assert agree(white, want) < 1e-10 and np.abs(np.array(explained) - share).max() < 1e-12
    assert first[0].identity_error < 1e-10 and out.select("identity_error").distinct().count() == 1


def test_floats_are_widened_first(spark):
    df = spark.createDataFrame([(1, [0.1, -0.1])], "id long, v array<float>")
    x = integer_vectors(df, "id", "v").first().x
    assert x == [math.floor(64 * float(np.float32(0.1))) + 1_000_000, math.floor(64 * float(np.float32(-0.1))) + 1_000_000]


def test_equal_eigenvalues_and_missing_rank(spark):
    """A cross (two equal eigenvalues, a third dimension without spread): the space closes early twice."""
    data = [(0, [1.0, 0.0, 7.0]), (1, [-1.0, 0.0, 7.0]), (2, [0.0, 1.0, 7.0]), (3, [0.0, -1.0, 7.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    ids, k, white, first, explained = columns(whiten_embeddings(df, "vec_id", "embedding"))
    assert k == 2 and np.allclose(explained, [0.5, 0.5])
    assert np.allclose(white.T @ white / 4, np.eye(2)) and first[0].identity_error < 1e-12


def test_more_dimensions_than_vectors(spark):
    rng = np.random.default_rng(5)
    data = rng.integers(-5, 6, (6, 30)).astype(float)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(data)], "vec_id long, embedding array<double>")
    ids, k, white, first, explained = columns(whiten_embeddings(df, "vec_id", "embedding"))
    n, deviations, want, share = dense([[math.floor(64 * v) + 1_000_000 for v in r] for r in data.tolist()], 16)
    assert k == 5 and agree(white, want) < 1e-9 and abs(sum(explained) - 1) < 1e-12
    assert [first[i].deviation for i in ids] == deviations


def test_bad_rows_repeated_rows_and_clashing_columns(spark):
    data = [(0, [0.5, -0.25], "a", 1), (1, [0.1, 0.7], "b", 1), (2, None, "c", 1), (3, [None, 1.0], "d", 1), (4, [math.nan, 1.0], "e", 1),
            (5, [math.inf, 1.0], "f", 1), (None, [1.0, 1.0], "g", 1), (1, [0.1, 0.7], "repeated", 1), (7, [2.0, -3.0], "h", 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, id string, component int")
    rows = whiten_embeddings(df, "vec_id", "embedding").collect()
    assert sorted((-1 if r.id is None else r.id, r.component) for r in rows) == sorted((i, c) for i in (-1, 0, 1, 1, 7) for c in (1, 2))
    assert {r.n for r in rows} == {4}


@pytest.mark.parametrize("vectors", [[], [[]], [[1.0, 2.0]], [[1.0, 2.0], [1.0, 2.0]], [None]])
def test_without_spread_there_are_no_components(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    out = whiten_embeddings(df, "vec_id", "embedding")
    assert out.columns[:2] == ["id", "component"] and out.count() == 0


def test_each_length_on_its_own(spark):
    data = [(0, [1.0]), (1, [2.0]), (2, [1.0, 5.0]), (3, [2.0, 1.0]), (4, [4.0, 4.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    rows = whiten_embeddings(df, "vec_id", "embedding").collect()
    assert sorted((r.id, r.component, r.n) for r in rows) == [(0, 1, 2), (1, 1, 2)] + [(i, c, 3) for i in (2, 3, 4) for c in (1, 2)]


def test_huge_entries_are_exact_or_null(spark):
    data = [(0, [2.0**30, 1.0]), (1, [-(2.0**30), 2.0]), (2, [3e38, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    rows = {r.id: r for r in whiten_embeddings(df, "vec_id", "embedding").collect() if r.component == 1}
    x = [[int(64 * 2.0**30) + 1_000_000, 1_000_064], [int(-64 * 2.0**30) + 1_000_000, 1_000_128], [2**40 + 1_000_000, 1_000_064]]
    want = dense(x, 2)[1]
    assert [rows[i].deviation for i in range(3)] == [w if w < 2**63 else None for w in want]


def test_fit_counts_each_vector_once(spark):
    df = spark.createDataFrame([(i, [float(i % 3)]) for i in range(30)], "id long, v array<double>")
    model = fit(integer_vectors(df, "id", "v"))
    assert model.n == 3 and model.sums == (3 * 1_000_000 + 64 * 3,)


def test_query_over_the_driver_table(spark, table):
    from assay.llm.queries import op13_whitening

    out = op13_whitening(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids, k, white, first, explained = columns(out.withColumnRenamed("vec_id", "id"))
    source = {r.vec_id: r.embedding for r in table("embeddings").collect()}
    n, deviations, want, share = dense([[math.floor(64 * float(np.float32(v))) + 1_000_000 for v in source[i]] for i in ids], 16)
    assert agree(white, want) < 1e-9 and [first[i].deviation for i in ids] == deviations and first[ids[0]].n == n
    assert np.abs(np.array(explained) / share - 1).max() < 1e-10
