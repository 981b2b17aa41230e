from collections import defaultdict

import xxhash

from assay.llm.common import connected_components
from assay.llm.simhash import BKTree, keep_one, links, shard_forest, simhash_groups


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, f in zip(ids, fps):
        least[root(f)] += [] if i is None else [i]
    return [min(least[root(f)], default=None) for f in fps]


def expected(docs):
    fps = [brute_fingerprint(t) for _, t in docs]
    comp = brute_components([i for i, _ in docs], fps, 2)
    return sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(docs, fps, comp)), key=repr)


def test_documents_match_brute_force(table, rows):
    docs = table("documents").select("doc_id", "text")
    assert rows(simhash_groups(docs)) == expected([tuple(r) for r in docs.collect()])


def test_edge_cases(spark, rows):
    docs = [(5, "A b C d"), (3, "a B c D"), (3, "a b c d"), (9, None), (8, ""), (7, " \n\t"), (1, "one two"),
            (None, "one two"), (None, "quite another text here"), (2, "x " * 40000 + "end"), (4, "é É ß"), (6, "é é ß")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS fingerprint", "3 AS id")
    assert rows(simhash_groups(df)) == expected(docs)
    assert simhash_groups(df.limit(0)).count() == 0


def test_keep_one_row_of_each_component(spark, rows):
    docs = [(5, "a b c d", "x"), (3, "A b c d", "y"), (3, "A b c d", "y"), (9, None, "z"), (8, "", "z"), (None, "quite another text", "n"),
            (None, "quite another text", "n"), (3, "some other words here now", "w"), (4, "some other words here now", "w")]
    df = spark.createDataFrame(docs, "doc_id long, text string, fp string")
    assert rows(keep_one(df)) == sorted([(3, "A b c d", "y"), (8, "", "z"), (None, "quite another text", "n"),
                                         (3, "some other words here now", "w")], key=repr)
    assert keep_one(df.limit(0)).count() == 0


def test_links_find_every_component_of_dense_and_chained_groups(spark, monkeypatch):
    import random

    import assay.llm.simhash as S

    monkeypatch.setattr(S, "SHARD_LIMIT", 16)  # so that crowded shards are sharded again
    rng = random.Random(5)
    base, fps = rng.getrandbits(64), set()
    for _ in range(150):
        f = base
        for _ in range(rng.randint(0, 3)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    chain = rng.getrandbits(64)
    for i in range(0, 60, 2):  # each two bits from the one before
        chain ^= 3 << i
        fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(50)} | {0, 2**64 - 1, 2**63}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    edges = links(spark.createDataFrame(signed, "fp long"), 2)
    labels = {r.node: r.component for r in connected_components(edges).collect()}
    got = defaultdict(set)
    for (s,) in signed:
        got[labels.get(s, s)].add(s)
    want = defaultdict(set)
    for (s,), c in zip(signed, brute_components([s for (s,) in signed], [s % 2**64 for (s,) in signed], 2)):
        want[c].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_bk_tree_and_forest():
    import random

    rng = random.Random(3)
    values = list({rng.getrandbits(8) for _ in range(120)})
    tree = BKTree(values[0])
    for v in values[1:]:
        tree.add(v)
    for q in range(256):
        assert sorted(tree.values[i] for i in tree.near(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)
    assert len(shard_forest(values, 8)) == len(values) - 1
