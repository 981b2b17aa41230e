"""The pipeline, stage by stage, each against a brute-force version on that stage's own input."""

import os
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from assay.llm import pii
from assay.llm.common import materialize
from assay.llm.simhash import simhash_groups
from assay.llm.toxicity import fit, score

sys.path.insert(0, os.path.dirname(__file__))
from test_line_dedup import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), "test-stage")
        out.append((name, before, docs))
    return out


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_stages_and_columns(outputs):
    assert [n for n, _, _ in outputs] == ["toxicity", "line_dedup", "near_duplicates", "private_data", "packing"]
    for _, _, after in outputs[:-1]:
        assert after.columns == P.COLUMNS
        assert all(r.n_chars == len(r.text) for r in after.collect())


def test_toxicity_rejects_what_the_model_calls_toxic_and_nothing_else(spark, outputs):
    _, before, after = outputs[0]
    model = fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.id for r in score(before, model).where("p_toxic <= 0.5").collect()}
    got = rows(after)
    assert set(got) == want and all(got[i] == r for i, r in rows(before).items() if i in want)
    assert len(want) < before.count()


def test_line_dedup(outputs):
    _, before, after = outputs[1]
    want = {i: t for i, t, _, _ in brute([(r.doc_id, r.text, r.source) for r in before.collect()])}
    assert {i: r["text"] for i, r in rows(after).items()} == want


def test_near_duplicates(outputs):
    _, before, after = outputs[2]
    groups = simhash_groups(before).collect()
    assert set(rows(after)) == {r.component_id for r in groups}
    assert all(rows(before)[i] == r for i, r in rows(after).items())


def test_private_data(spark, outputs):
    _, before, after = outputs[3]
    field = pii.train(before)
    want = {r.doc_id: pii.redacted(r.text, field) for r in before.collect()}
    assert {i: r["text"] for i, r in rows(after).items()} == want
    assert not any(pii.rule_spans(t) for t in want.values())


def test_packing(outputs):
    _, before, after = outputs[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 0] for r in before.collect()}
    got: dict = {}
    for r in after.collect():
        got.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in got.items()} == tokens
    filled = Counter()
    for r in after.collect():
        filled[r.sequence_id] += r.length
    assert all(n <= 1024 and (n == 1024 or n & (n - 1) == 0) for n in filled.values())


def test_run_is_the_stages_in_a_row(spark, outputs):
    got = P.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    a, b = (sorted(tuple(r[k] for k in key[:1] + key[4:]) for r in df.where("start = 0").collect()) for df in (got, outputs[-1][2]))
    assert a == b and np.array(a).size


def test_edge_cases(spark):
    docs = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id here at all", None, "s", 5), (3, "a b c", "en", None, 5),
            (3, "a b c", "en", None, 5), (4, "mail me: jo@mail.example.com", "en", "s", 1), (5, "w " * 50_000, "en", "t", 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS fp", "2 AS id")
    for empty in (False, True):
        now = df.limit(0) if empty else df
        for name, stage in P.STAGES:
            now = materialize(stage(spark, now, SF), f"edge-{name}")
        ids = {r.doc_id for r in now.collect()}
        assert ids == (set() if empty else {1, 3, 4, 5, None})  # 2 is as empty as 1
