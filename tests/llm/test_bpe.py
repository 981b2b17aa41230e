import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assay.llm.bpe import bpe_decode, bpe_encode, read_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def brute(library, docs):
    out = []
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                    hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(df):
    data = read_tokenizer(PATH)
    decoded = bpe_encode(df, data, decoded=True)
    if df.count() < 100:  # decoding stored ids gives the same texts
        apart = sorted((r.ids, r.text) for r in bpe_decode(bpe_encode(df, data), data).collect())
        assert apart == sorted((r.ids, r.text) for r in decoded.collect())
    return decoded.selectExpr("id AS doc_id", "CAST(size(ids) AS LONG) AS n_tokens", "ids_sha256", "sha2(text, 256) AS decoded_sha256")


def test_documents_match_the_library(table, rows, library):
    docs = table("documents").select("doc_id", "text")
    assert rows(ours(docs)) == brute(library, [tuple(r) for r in docs.collect()])


def test_edge_cases(spark, rows, library):
    odd = ["", None, " \t\n\x0b\x0c\r ", "A's B'S 'll x'tend 'T", "é ́x a b c\u0085d", "İI Σσς ΑΣ ß ﬁ",
           "<|startoftext|>hi<|endoftext|> <|endoftext|>", "x" * 30000, "日本語 テキスト 🙂🙂‍", "1234 5,6.7", "a\x00b \x1cc",
           "same words same words", "same words same words", "Å Å Å 각", "w " * 50000]
    docs = list(enumerate(odd)) + [(3, "repeated id"), (None, "no id"), (3, "repeated id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS ids", "'x' AS word")
    assert rows(ours(df)) == brute(library, docs)
    assert ours(df.limit(0)).count() == 0


def test_random_unicode(spark, rows, library):
    import random

    rng = random.Random(2)
    pool = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    docs = [(i, "".join(rng.choice(pool if rng.random() < 0.4 else " 'aBs\n\t1.,t") for _ in range(rng.randint(0, 60))))
            for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(ours(df)) == brute(library, docs)


def test_decode_of_unknown_and_null_ids(spark, rows, library):
    df = spark.createDataFrame([(1, [320, 10**6, 49407, -1]), (2, None), (3, [])], "id long, ids array<int>")
    got = dict((r.id, r.text) for r in bpe_decode(df, read_tokenizer(PATH)).collect())
    assert got == {1: library.decode([320, 10**6, 49407], skip_special_tokens=False), 2: None, 3: ""}
