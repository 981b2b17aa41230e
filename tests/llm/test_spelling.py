import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from assay.llm import spelling
from assay.llm.spelling import corpus_words, frequency_vectors, near_words, one_edit, variant_groups

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edits(a, b):
    """Levenshtein distance, by the textbook."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i, *row[1:]], row[0]
        for j, y in enumerate(b, 1):
            row[j], last = min(row[j] + 1, row[j - 1] + 1, last + (x != y)), row[j]
    return row[-1]


def brute_words(docs, min_chars=7, min_count=2):
    counts = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_chars:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def brute_groups(words, ratio=10):
    """Near words by all single edits over the words' own letters."""
    letters = sorted({c for w in words for c in w})
    forms, near_count = {}, {}
    for w, n in words.items():
        others = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters} | {
            w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        near = [v for v in others if v in words and v != w]
        near_count[w] = len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, near_count[w], words.get(forms[w])))
    return sorted(out, key=repr)


def made_words(seed, many, alphabet="abcdeé"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 11))) for _ in range(many)]
    out = {w: rng.choice([1, 3, 40, 900]) for w in base}
    for w in base:
        for _ in range(2):
            i = rng.randrange(len(w))
            out.setdefault(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1:]]), rng.choice([1, 2, 30]))
    return out


def test_query_over_the_driver_table(spark, table, rows):
    from assay.llm.queries import op12_spelling

    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    want = brute_groups(brute_words(docs))
    got = rows(op12_spelling(spark, "/root/testdata/sf0.001"), *COLUMNS)
    assert got == want and any(r[1] for r in want)


@pytest.mark.parametrize("least", [1, 7, 40, 2048])
def test_cells_of_any_size_give_the_same_groups(spark, rows, monkeypatch, least):
    """Cells down to single vectors, and (most = 1) vectors that are cut into blocks."""
    monkeypatch.setattr(spelling, "LEAST_WORDS", least)
    monkeypatch.setattr(spelling, "MOST_WORDS", least)
    words = made_words(1, 150) | {"abcdefg": 5, "gfedcba": 50, "bacdefg": 70, "abcdegf": 700}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(variant_groups(df), *COLUMNS) == brute_groups(words)


def test_chains_lead_to_the_last_form(spark, rows):
    words = {"abcdefgh"[:7] + c: 10**k for k, c in enumerate("wxyz")} | {"aaaaaaaaaa": 7}
    words = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "abcdefghijk": 10_000, "zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30}
    got = {r[0]: r for r in rows(variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")), *COLUMNS)}
    assert [got[w][2] for w in sorted(words)[:5]] == ["abcdefghijk"] * 5
    assert got["zzzzzzz"][1] == "zzzzzzx" and got["zzzzzzz"][4] == 2 and got["abcdefghijk"][1] is None


def test_letter_runs_and_slips(spark):
    docs = [(1, "Abcdefg ABCDEFG abcdefg1abcdefg Éabcdefg éabcdefg xÀÀÀÀÀÀ×÷"), (2, None), (None, "abcdefg abcdefgh abcdefgh"), (3, ""), (3, ""),
            (4, "z" * 100_000 + " " + "z" * 100_000), (5, "abcdefg " * 2000), (5, "abcdefg " * 2000), (6, "ab " * 50_000), (7, "a'bcdefgh-bcdefgh")]
    docs += [(i, "swimming holidays") for i in range(100, 400)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string")
    got = {r.word: r.n for r in corpus_words(df, "doc_id", "text").collect()}
    assert got == brute_words(docs) and any("swimming"[:i] + "swimming"[i + 1:] in got for i in range(8))


def test_empty_tables_and_words_without_neighbours(spark, rows):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variant_groups(corpus_words(empty, "doc_id", "text")).count() == 0
    one = spark.createDataFrame([("abcdefg", 2), (None, 9)], "word string, n long")
    assert rows(variant_groups(one), *COLUMNS) == [("abcdefg", None, "abcdefg", 2, 0, None)]


def test_near_pairs_against_the_distance():
    words = made_words(4, 60, "ab") | {"a": 1, "b": 2, "ab": 3, "ba": 4, "aab": 5, "": 6, "a" * 40: 1, "a" * 41: 1, "a" * 20 + "b" + "a" * 20: 9, "é" * 7: 1, "É" * 7: 1}
    order = sorted(words)
    counts = np.array([words[w] for w in order])
    who, number, best = near_words(order, counts, np.ones(len(order), dtype=bool))
    near = {w: [v for v in order if edits(w, v) == 1] for w in order}
    assert {order[i]: n for i, n in zip(who, number)} == {w: len(v) for w, v in near.items() if v}
    assert all(order[b] == min(near[order[i]], key=lambda v: (-words[v], v)) for i, b in zip(who, best))


def test_one_edit_and_budgets():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(2))
        assert one_edit(a, b) == (edits(a, b) == 1)
        if edits(a, b) == 1:
            d = np.subtract(*frequency_vectors([a, b]).astype(int))
            assert d[d > 0].sum() <= 1 and -d[d < 0].sum() <= 1


def test_ratio_must_exclude_cycles(spark):
    with pytest.raises(ValueError):
        variant_groups(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)
