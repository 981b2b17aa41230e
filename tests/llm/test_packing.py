import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assay.llm.bpe import read_tokenizer
from assay.llm.packing import curve_points, fast_encoder, hilbert_key, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(df, docs, length=1024):
    """Every token of every document lies in exactly one piece, sequences are gapless, and only ends of
    ranges are shorter than ``length`` (powers of two, so nothing is padded)."""
    library = Tokenizer.from_file(PATH)
    pieces = [r.asDict() for r in pack_documents(df, read_tokenizer(PATH), length=length).collect()]
    want = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in docs))
    parts = defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], dtype="<u4").tobytes())
        parts[p["sequence_id"]].append(p)
    for seq in parts.values():
        seq.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in seq] == np.cumsum([0] + [p["length"] for p in seq])[:-1].tolist()
        filled = sum(p["length"] for p in seq)
        assert filled == length or filled < length and filled & (filled - 1) == 0
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    by_doc = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        by_doc[p["doc_id"]].append(p)
    got = []
    for i, ps in by_doc.items():  # a document's pieces follow each other along the range
        now = []
        for p in ps:
            assert p["start"] == len(now)
            now += p["ids"]
            if len(now) == p["doc_tokens"]:
                got.append(now)
                now = []
        assert not now
    assert sorted(got) == want
    return pieces


def test_documents(table):
    df = table("documents")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (None, "no id"), (3, "a <|endoftext|> b"), (4, "word " * 30000), (5, "same"), (6, "same"),
            (6, "same again"), (7, "\n\n    x'll 1234́ 日本 🙂")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS bucket", "2 AS length", "3 AS start")
    check(df, docs)
    check(df, docs, length=64)
    assert pack_documents(df.limit(0), read_tokenizer(PATH)).count() == 0


def test_hilbert_key_walks_every_cell_by_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert_key(grid, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_copies_share_a_point_and_neighbours_are_alike():
    import pyarrow as pa

    base = [f"w{i}" for i in range(200)]
    near = base[:190] + [f"v{i}" for i in range(10)]
    far = [f"u{i}" for i in range(200)]
    p = curve_points(pa.array([" ".join(base), " ".join(base[::-1]), " ".join(near), " ".join(far)])).astype(int)
    assert (p[0] == p[1]).all() and np.abs(p[0] - p[2]).sum() < np.abs(p[0] - p[3]).sum()


def test_encoder_matches_the_library():
    import random

    library, encode, rng = Tokenizer.from_file(PATH), fast_encoder(read_tokenizer(PATH)), random.Random(4)
    pool = [chr(c) for c in range(1, 0x3000)] + list("🙂\U00020000")
    for _ in range(3000):
        s = "".join(rng.choice(pool if rng.random() < 0.4 else " 'aBs\n\t1.,t") for _ in range(rng.randint(0, 40)))
        assert encode(s).tolist() == library.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", [" ", "\n", "\t"])
def test_two_million_blanks_encode_as_the_library_does(blank):
    data = read_tokenizer(PATH)
    text = "before" + blank * 2_000_000 + "after"
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert fast_encoder(data)(text).tolist() == want
