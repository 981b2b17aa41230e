"""op8_toxicity against plain Python: which features are chosen, that the fit minimises its loss, every score."""

import math
import os
import random
import unicodedata

import numpy as np
import pytest

from assay.llm.toxicity import GRADES, fit
from assay.llm.queries import op8_toxicity

SF = "/root/testdata/sf0.01"
STEMS = (4, 5, 6, 7)


def features_of(text):
    out = set()
    for word in (text or "").lower().split():
        run = ""
        for c in [*unicodedata.normalize("NFC", word), " "]:
            if c.isalpha() or unicodedata.category(c)[0] == "M":
                run += c
                continue
            if any(x.isalpha() for x in run):
                out |= {run, *[f"{run[:n]}~" for n in STEMS if len(run) >= n]}
            run = ""
    return out


def gain(n, toxic, rate):
    part = lambda k, expected: k * math.log(k / expected) if k else 0.0
    return 2 * (part(toxic, n * rate) + part(n - toxic, n * (1 - rate)))


@pytest.fixture(scope="module")
def fitted(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {}
    for r in labels.collect():
        if r.toxic is not None and r.doc_id in texts:
            known[texts[r.doc_id]] = max(known.get(texts[r.doc_id], 0), int(r.toxic != 0))
    return texts, known, fit(docs, labels)


def test_features_are_those_of_the_largest_gains(fitted):
    _, known, model = fitted
    rate, counts = sum(known.values()) / len(known), {}
    for text, toxic in known.items():
        for f in features_of(text):
            n, t = counts.get(f, (0, 0))
            counts[f] = n + 1, t + toxic
    floor = 2 * math.log(len(known)) + 1
    chosen = {f for f, (n, t) in counts.items() if t >= 3 and t > n * rate and gain(n, t, rate) > floor}
    assert chosen and set(model.features) == chosen
    order = [gain(*counts[f], rate) for f in model.features]
    assert all(a >= b - 1e-9 for a, b in zip(order, order[1:]))


def loss(rows, weights, thresholds, ridge=1e-3):
    total = 0.0
    edges = [-math.inf, *thresholds, math.inf]
    for found, grade in rows:
        s = sum(weights[i] for i in found)
        below = [0.0 if e == -math.inf else 1.0 if e == math.inf else 1 / (1 + math.exp(-(e - s))) for e in edges]
        total -= math.log(max(below[grade + 1] - below[grade], 1e-12))
    return total / len(rows) + ridge / 2 * sum(w * w for w in weights) / math.sqrt(len(weights))


def test_the_fit_is_near_the_least_loss(fitted):
    """No step along random directions lowers the loss by more than a trace."""
    _, known, model = fitted
    rows = [(sorted(model.features[f] for f in features_of(t) if f in model.features), toxic) for t, toxic in known.items()]
    broad = sorted(len(f) for f, toxic in rows if toxic)
    thirds = np.quantile(broad, [1 / 3, 2 / 3])
    rows = [(f, 1 + sum(len(f) > x for x in thirds) if toxic else 0) for f, toxic in rows]
    best = loss(rows, model.weights, model.thresholds)
    assert best < loss(rows, np.zeros_like(model.weights), model.thresholds) - 0.05
    rng = random.Random(0)
    for _ in range(20):
        for size in (0.01, 0.1):
            w = model.weights + size * np.array([rng.gauss(0, 1) for _ in model.weights])
            assert loss(rows, w, model.thresholds) > best - 0.01
            t = np.sort(model.thresholds + size * np.array([rng.gauss(0, 1) for _ in model.thresholds]))
            assert loss(rows, model.weights, t) > best - 0.01


def test_every_score_of_the_query(spark, fitted):
    texts, _, model = fitted
    rows = op8_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        s = sum(model.weights[model.features[f]] for f in features_of(texts[r.doc_id]) if f in model.features)
        above = [1.0, *[1 / (1 + math.exp(t - s)) for t in model.thresholds], 0.0]
        each = [a - b for a, b in zip(above, above[1:])]
        assert math.isclose(r.severity, sum(above[1:GRADES]), rel_tol=1e-9, abs_tol=1e-12) and math.isclose(r.p_toxic, above[1], rel_tol=1e-9)
        assert each[r.grade] >= max(each) - 1e-12 and r.toxic == (r.p_toxic > 0.5)
