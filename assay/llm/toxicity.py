"""Severity grades by cumulative-link ordinal regression over sparse text features.

P(grade <= j) = sigmoid(theta_j - w.x): one weight vector shared by all
ordered thresholds.  Features are the distinct words of a text (runs of letters and
marks, composed) and their first four to seven letters (inflected forms share
a stem).  The features worth a weight are chosen
by their association with the labels, counted in Spark; the weights are fitted
on the driver over a bounded sample of labelled rows; every document is scored.
The labels say toxic or not; toxic examples are graded by how broad their toxic
vocabulary is, in thirds.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import materialize
from assay.llm.words import sliced, word_table

#: Bounds of the fit: labelled rows sampled (by a hash of the id), and features kept.
MAX_LABELLED = 20_000
MAX_FEATURES = 4096

#: Grades: 0 not toxic; toxic examples are graded 1 to 3 by the thirds of their number of features.
GRADES = 4

#: Bytes of text whose features are counted at a time (every distinct word has several).
COUNTED_BYTES = 1 << 21
STEMS = (4, 5, 6, 7)

SCORE_SCHEMA = "id long, severity double, grade int, p_toxic double"


@dataclass(frozen=True)
class Model:
    """``features`` maps a feature to its place in ``weights``; ``thresholds`` ascend."""

    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1.. per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -500, 500)))


def word_features(word: str) -> list[str]:
    """The runs of letters and marks (composed, NFC) in a lower-case word, and their stems; none for numbers."""
    cores = [word]
    if not word.isalpha() or not word.isascii():
        word = unicodedata.normalize("NFC", word)
        cores = "".join(c if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for c in word).split(" ")
    return [f for core in dict.fromkeys(cores) if any(map(str.isalpha, core))
            for f in (core, *[f"{core[:n]}~" for n in STEMS if len(core) >= n])]


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def _document_features(texts: pa.Array, features: dict[str, int] | None):
    """Distinct (document, feature) pairs; with ``features`` None, all features found and their list."""
    sizes, places, distinct = word_table(_lower(texts))
    known: dict[str, int] = {} if features is None else features
    words, ids = [], []
    for at, word in enumerate(distinct.to_pylist()):
        for f in word_features(word):
            i = known.setdefault(f, len(known)) if features is None else known.get(f)
            if i is not None:
                words.append(at)
                ids.append(i)
    counts = np.bincount(np.array(words, dtype=np.int64), minlength=len(distinct))
    first = np.cumsum(counts) - counts
    of_doc = np.repeat(np.arange(len(sizes)), sizes)
    hits = np.flatnonzero(counts[places]) if len(places) else np.zeros(0, np.int64)
    per = counts[places[hits]] if len(hits) else np.zeros(0, np.int64)
    docs = np.repeat(of_doc[hits], per)
    ends = np.cumsum(per)
    within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - per, per)
    found = np.array(ids, dtype=np.int64)[np.repeat(first[places[hits]], per) + within] if len(hits) else np.zeros(0, np.int64)
    pairs = np.unique(docs * (len(known) + 1) + found)
    return pairs // (len(known) + 1), pairs % (len(known) + 1), known


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """``text, toxic`` (0 or 1) of about ``max_rows`` labelled documents at most, each text once; rows
    without a toxic label are no examples."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    chosen = chosen.select(F.col("doc_id").cast("long").alias("label_id"), (F.col("toxic") != 0).cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return (rows.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).where(F.col("text").isNotNull())
            .groupBy(F.xxhash64("text")).agg(F.max(F.struct("toxic", "text")).alias("r")).select("r.text", "r.toxic"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED, max_features: int = MAX_FEATURES,
        rounds: int = 400, ridge: float = 1e-3) -> Model:
    """Fit on a bounded sample of labelled documents.  Without examples, or without toxic ones, the model
    has no features and calls nothing toxic."""
    sample = materialize(labelled_sample(docs, labels, max_rows), "labelled")

    def count(batches):
        for batch in sliced(batches, limit=COUNTED_BYTES):
            doc, feature, names = _document_features(batch.column("text"), None)
            toxic = batch.column("toxic").to_numpy()[doc] > 0
            total, positive = Counter(feature.tolist()), Counter(feature[toxic].tolist())
            names = list(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in total], pa.string()), pa.array(list(total.values()), pa.int64()),
                 pa.array([positive[i] for i in total], pa.int64())], ["feature", "n", "toxic"])

    size, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    none = Model({}, np.zeros(0), np.full(GRADES - 1, 30.0) + np.arange(GRADES - 1))
    if not toxic or toxic == size:
        return none
    rate = toxic / size

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(F.lit(0.0))

    floor = 2 * np.log(size) + 1  # the more texts, the more features are tried: chance gains rise with them
    n, a = F.col("n"), F.col("toxic")
    gain = 2 * (part(a, n * rate) + part(n - a, n * (1 - rate)))  # G-test of the feature's share of toxic texts
    chosen = (sample.mapInArrow(count, "feature string, n long, toxic long").groupBy("feature")
              .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
              .where((a >= 3) & (a > n * rate)).withColumn("gain", gain).where(F.col("gain") > floor)
              .orderBy(F.desc("gain"), "feature").limit(max_features).select("feature").collect())
    features = {r.feature: i for i, r in enumerate(chosen)}
    if not features:
        return none

    def found(batches):
        for batch in sliced(batches):
            doc, feature, _ = _document_features(batch.column("text"), features)
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.ListArray.from_arrays(pa.array(cut), pa.array(feature.astype(np.int32)))],
                ["toxic", "features"])

    rows = sorted((r.toxic, tuple(r.features)) for r in sample.mapInArrow(found, "toxic int, features array<int>").collect())
    broad = np.array([len(f) for _, f in rows])
    is_toxic = np.array([t for t, _ in rows]) > 0
    thirds = np.quantile(broad[is_toxic], [1 / 3, 2 / 3])
    grades = np.where(is_toxic, 1 + (broad[:, None] > thirds).sum(axis=1), 0)
    return _fit_rows(grades, [f for _, f in rows], features, rounds, ridge)


def _fit_rows(grades: np.ndarray, found: list[tuple], features: dict[str, int], rounds: int, ridge: float) -> Model:
    """Full-batch Adam on the cumulative-link likelihood; thresholds ascend by positive steps."""
    doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
    feature = np.array([i for f in found for i in f], dtype=np.int64)
    size, m = len(grades), len(features)
    above = np.array([(grades >= j).mean() for j in range(1, GRADES)]).clip(1e-4, 1 - 1e-4)
    start = -np.log(above / (1 - above))
    params = np.concatenate([np.zeros(m), [start[0]], np.log(np.maximum(np.diff(start), 0.05))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    low, high = grades - 1, grades  # the grade lies between thresholds low and high
    for step in range(1, rounds + 1):
        w, theta = params[:m], _thresholds(params[m:])
        scores = np.bincount(doc, weights=w[feature], minlength=size)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            upper = 1 / (1 + np.exp(-np.clip(edge[high + 1] - scores, -500, 500)))
            lower = 1 / (1 + np.exp(-np.clip(edge[low + 1] - scores, -500, 500)))
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        grad_scores = (du - dl) / size  # of the negative log likelihood
        grad_w = np.bincount(feature, weights=grad_scores[doc], minlength=m) + ridge * w / m ** 0.5
        by_edge = (np.bincount(low + 1, weights=dl, minlength=GRADES + 1) - np.bincount(high + 1, weights=du, minlength=GRADES + 1)) / size
        grad_theta = by_edge[1:GRADES]
        steps = np.exp(params[m + 1:])
        grad_t = np.concatenate([[grad_theta.sum()], [grad_theta[j + 1:].sum() * steps[j] for j in range(GRADES - 2)]])
        grad = np.concatenate([grad_w, grad_t])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        params -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return Model(features, params[:m], _thresholds(params[m:]))


def _thresholds(t: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, severity, grade, p_toxic`` of every row: the expected grade, the likeliest grade, and
    P(grade >= 1), all from the whole text.

    Edge cases: a null text counts as empty and scores by the thresholds alone; null and repeated ids are
    kept; an empty table gives an empty table.  Other columns are not read.  The model's size is bounded
    by the fit's ``max_features``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in sliced(batches):
            doc, feature, _ = _document_features(batch.column("text"), m.features)
            scores = np.bincount(doc, weights=m.weights[feature], minlength=batch.num_rows)
            above = m.probabilities(scores)
            each = -np.diff(np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)),
                 pa.array(above[:, 0])], ["id", "severity", "grade", "p_toxic"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCORE_SCHEMA)


def reject(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose P(grade >= 1) is at most ``limit``.

    Edge cases: a null text counts as empty (and stays null); null and repeated ids and repeated rows are
    decided each by its own text; a tie with the limit stays; an empty table gives an empty table; other
    columns pass through, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in sliced(batches, text_col, keep_nulls=True):
            doc, feature, _ = _document_features(pc.fill_null(batch.column(batch.schema.get_field_index(text_col)), ""), m.features)
            above = m.probabilities(np.bincount(doc, weights=m.weights[feature], minlength=batch.num_rows))
            yield batch.filter(pa.array(above[:, 0] <= limit))

    return docs.mapInArrow(run, docs.schema)
