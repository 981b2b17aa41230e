import hashlib
import random

import numpy as np

from assay.llm.lz_fingerprint import (SIGNATURE, as_text, compare_with_edits, from_text, likeness, lz_fingerprints, phrase_ends,
                                      signature)


def brute_phrases(text):
    """The phrases by a set of strings."""
    known, out, word = set(), [], ""
    for c in text:
        word += c
        if word not in known:
            known.add(word)
            out.append(word)
            word = ""
    return out + [word] * bool(word)


def test_phrases_and_their_hashes():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("abé🙂 ") for _ in range(rng.randint(0, 400)))
        ends = phrase_ends(text)
        got = [text[a:b] for a, b in zip([0, *ends], ends)]
        assert got == brute_phrases(text)
        if len(set(got)) <= SIGNATURE:  # equal phrases hash alike, different ones apart
            assert len(signature(text)) == len(set(got))


def test_likeness_is_exact_for_small_sets_and_close_for_large_ones():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (0, 5, 40, 200, 4000, 9000)]
    texts += [t[:len(t) * 3 // 4] + texts[-1][:len(t) // 4] for t in texts]
    for a in texts:
        for b in texts:
            x, y = set(brute_phrases(a)), set(brute_phrases(b))
            want = len(x & y) / len(x | y) if x | y else 1.0
            got = likeness(signature(a), signature(b))
            assert got == want if len(x | y) <= SIGNATURE else abs(got - want) < 0.2
            assert 0 <= got <= 1


def test_fingerprint_text_round_trip():
    sig = signature("some text, some more text")
    assert (from_text(as_text(sig)) == sig).all() and sig.dtype == np.uint32


def brute(docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    out = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        m = len(text) // 4
        edited = text[:len(text) - m] + following[:m]
        s, e, f = signature(text), signature(edited), signature(following)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(s), as_text(e), likeness(s, e), likeness(s, f)))
    return sorted(out, key=repr)


def test_documents(table, rows):
    docs = table("documents").select("doc_id", "text")
    got = rows(compare_with_edits(docs))
    assert got == brute([tuple(r) for r in docs.collect()])
    long = [r for r in got if r[1] > 400]
    assert sum(r[5] for r in long) / len(long) > 0.15 + sum(r[6] for r in long) / len(long)


def test_edge_cases(spark, rows):
    docs = [(1, "a" * 50_000), (2, None), (3, ""), (None, "no id"), (None, "another"), (7, "é🙂" * 9), (7, "abc"), (7, "abc"),
            (-5, "abcd"), (2**40, "the last document has the first after it")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS range", "2 AS kind", "3 AS id")
    assert rows(compare_with_edits(df)) == brute(docs)
    assert rows(lz_fingerprints(df)) == sorted(((i, as_text(signature(t or ""))) for i, t in docs), key=repr)
    assert rows(compare_with_edits(df.where("doc_id = 1"))) == brute(docs[:1])
    assert compare_with_edits(df.limit(0)).count() == 0
