import numpy as np
import pytest

from assay.llm.toxicity import Model, _fit_rows, fit, score, word_features


def test_words_and_stems():
    assert word_features("idiot###") == ["idiot", "idio~", "idiot~"]
    assert word_features("...") == word_features("4.0") == word_features("") == []


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(0)
    found, grades = [], []
    for _ in range(2000):
        bad = rng.integers(0, 7)
        found.append(tuple(sorted({*rng.choice(6, bad, replace=False).tolist(), *(6 + rng.choice(10, 4)).tolist()})))
        grades.append(min(3, (bad + 1) // 2))
    m = _fit_rows(np.array(grades), found, {str(i): i for i in range(16)}, 400, 1e-3)
    scores = np.array([m.weights[list(f)].sum() for f in found])
    above = m.probabilities(scores)
    assert (np.diff(m.thresholds) > 0).all() and (np.diff(above, axis=1) <= 0).all()
    assert np.abs(above.sum(axis=1) - grades).mean() < 0.25
    assert m.weights[:6].min() > 5 * np.abs(m.weights[6:]).max()


def test_gradient_matches_the_likelihood_by_thresholds_alone():
    """Without features the fitted thresholds give the grades' own shares."""
    grades = np.repeat([0, 1, 2, 3], [700, 150, 100, 50])
    m = _fit_rows(grades, [()] * len(grades), {}, 800, 1e-3)
    above = m.probabilities(np.zeros(1))[0]
    assert np.allclose(above, [0.3, 0.15, 0.05], atol=0.01)


@pytest.fixture(scope="module")
def split(spark):
    import os

    if not os.path.isdir("/root/testdata/sf0.1"):
        pytest.skip("driver test data not present")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")


def test_held_out_accuracy(split):
    docs, train, test = split
    got = score(docs, fit(docs, train)).join(test.withColumnRenamed("doc_id", "id"), "id").toPandas()
    flagged, toxic = got.p_toxic > 0.5, got.toxic == 1
    assert (flagged & toxic).sum() / toxic.sum() > 0.85  # a part of the toxic labels has no toxic word at all
    assert (flagged & ~toxic).sum() / (~toxic).sum() < 0.01
    assert got[toxic].severity.mean() > 1 > 0.1 > got[~toxic].severity.mean()


def test_edge_cases(spark, rows):
    docs = [(i, f"plain words number {'abcdefgh'[i % 8]} here") for i in range(60)]
    docs += [(100 + i, f"plain words number {'abcdefgh'[i % 8]} awful{'ly' * (i % 2)}") for i in range(30)]
    docs += [(200, None), (201, ""), (None, "Awful!!"), (202, "AWFUL " * 50_000), (0, "repeated id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS toxic", "3 AS grade")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, None, 1) for i in range(30)] +
                                   [(None, 1, 1), (200, 1, 1), (201, 1, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    m = fit(df, labels)
    got = {}
    for r in score(df, m).collect():
        got.setdefault(r.id, []).append(r)
    assert sum(map(len, got.values())) == len(docs)
    assert all(r[0].p_toxic > 0.5 for i, r in got.items() if i is None or i in (202, *range(100, 130)))
    assert all(x.p_toxic < 0.5 for i, r in got.items() if i is not None and i < 100 or i in (200, 201) for x in r)
    assert got[200][0].severity == got[201][0].severity
    assert score(df.limit(0), m).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        nothing = fit(df, few)
        assert isinstance(nothing, Model) and not nothing.features
        assert score(df, nothing).where("p_toxic > 0.5").count() == 0
