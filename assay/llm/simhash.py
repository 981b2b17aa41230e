"""SimHash near-duplicate groups with BK-trees.

Equal fingerprints are one node.  Two fingerprints at most ``max_bits`` apart
agree on at least two of ``max_bits + 2`` bands of bits, so fingerprints are
sharded by every pair of bands: any linked pair shares a shard.  In a shard a
BK-tree (children keyed by their Hamming distance to the parent) is searched
along the edges within the radius only; the shard returns a spanning forest
of its links, never its pairs.  Components of the forest edges are then
joined up by a distributed algorithm.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import connected_components, join_counted, materialize, packed
from assay.llm.words import sliced

#: Shards over this many fingerprints are sharded again by the bits on which they do not agree yet.
SHARD_LIMIT = 4096


def _words_fingerprint(text: bytes | None, shingle: int, digest) -> int:
    """The fingerprint of one text; ASCII letters and blanks only are treated specially."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    total, ones = len(words) - shingle + 1, np.zeros(64, dtype=np.int64)
    for start in range(0, total, 1 << 16):  # so many shingles at a time: memory does not grow with the text
        part = words[start:start + (1 << 16) + shingle - 1]
        grams = part if shingle == 1 else map(b" ".join, zip(*[part[i:] for i in range(shingle)]))
        hashes = np.array([digest(g, 42) for g in grams], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, hash, fp``: one row per row of ``docs``; ``fp`` is the 64-bit fingerprint as a (signed) long,
    ``hash`` a plain hash of the text, which tells rows of one id apart."""
    def run(batches):
        from xxhash import xxh64_intdigest

        for batch in sliced(batches, keep_nulls=True):
            fps = np.array([_words_fingerprint(t, shingle, xxh64_intdigest) for t in batch.column("text").to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), pa.array(fps.view(np.int64))], ["id", "hash", "fp"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit("null"))).alias("hash"),
                       text.cast("binary").alias("text")).mapInArrow(run, "id long, hash long, fp long")


class BKTree:
    """Children keyed by their Hamming distance to the parent."""

    def __init__(self, root: int):
        self.values, self.children = [root], [{}]

    def near(self, value: int, radius: int) -> list[int]:
        """Indexes of the values within ``radius``; only edges that can lead there are followed."""
        found, todo, values, children = [], [0], self.values, self.children
        while todo:
            node = todo.pop()
            d = (values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            kids = children[node]
            if kids:
                todo += [kids[e] for e in range(max(1, d - radius), d + radius + 1) if e in kids]
        return found

    def add(self, value: int) -> None:
        node = 0
        while True:
            d = (self.values[node] ^ value).bit_count()
            nxt = self.children[node].get(d)
            if nxt is None:
                self.children[node][d] = len(self.values)
                self.values.append(value)
                self.children.append({})
                return
            node = nxt


def shard_forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct values."""
    tree, parent, out = BKTree(values[0]), list(range(len(values))), []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values[1:], 1):
        for j in tree.near(value, radius):  # the tree's indexes are the values' own
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((value, values[j]))
        tree.add(value)
    return out


def _bands(bits: list[int], count: int) -> list[list[int]]:
    """``bits`` (positions) cut into ``count`` bands of nearly equal width."""
    edges = [round(i * len(bits) / count) for i in range(count + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:])]


def _taken(value: Column, bits: list[int]) -> Column:
    """The given bit positions of ``value`` as one number: runs of neighbouring bits are moved together."""
    out, low, at = F.lit(0).cast("long"), 0, 0
    while at < len(bits):
        end = at
        while end + 1 < len(bits) and bits[end + 1] == bits[end] + 1:
            end += 1
        width = end - at + 1
        piece = F.shiftrightunsigned(value, bits[at]).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        out, low, at = out.bitwiseOR(F.shiftleft(piece, low)), low + width, end + 1
    return out


def _sharded(nodes: DataFrame, pairs: list[tuple[str, list[int]]]) -> DataFrame:
    """Each fingerprint once per pair of bands, with the pair's name and the agreed bits."""
    keys = [F.struct(F.lit(name).alias("pair"), _taken(F.col("fp"), bits).alias("bits")) for name, bits in pairs]
    return nodes.select("fp", *[c for c in nodes.columns if c != "fp"], F.explode(F.array(*keys)).alias("k"))


def links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Forest edges ``a, b`` whose components are those of all links between the distinct ``fp`` of ``nodes``.

    Shards over ``SHARD_LIMIT`` fingerprints are sharded again by the same rule over the bits on which
    they may still differ, so the largest shard is bounded by the bits left, not by the table."""
    def forest(batches):
        held, at = [], None
        for batch in batches:
            keys = batch.column("key").to_pylist()
            fps = batch.column("fp").to_numpy().view(np.uint64).tolist()
            rows = []
            for key, fp in zip(keys, fps):
                if key != at:
                    rows += shard_forest(held, max_bits) if len(held) > 1 else []
                    held, at = [], key
                held.append(fp)
            yield _edges(rows)
        if len(held) > 1:
            yield _edges(shard_forest(held, max_bits))

    bands = _bands(list(range(64)), max_bits + 2)
    first = [(f"{i}-{j}", bands[i] + bands[j]) for i, j in combinations(range(max_bits + 2), 2)]
    level1 = _sharded(nodes.select("fp"), first).select("fp", F.col("k.pair").alias("pair"), F.col("k.bits").alias("bits"))
    sizes = level1.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = level1.join(materialize(sizes, "shards"), ["pair", "bits"])
    parts = [sized.where(F.col("n") <= SHARD_LIMIT).select("fp", F.xxhash64("pair", "bits").alias("key"))]
    large = sized.where(F.col("n") > SHARD_LIMIT)
    for name, taken in first:
        left = [b for b in range(64) if b not in taken]
        inner = _bands(left, max_bits + 2)
        second = [(f"{i}-{j}", sorted(inner[i] + inner[j])) for i, j in combinations(range(max_bits + 2), 2)]
        parts.append(_sharded(large.where(F.col("pair") == name), second)
                     .select("fp", F.xxhash64("pair", "bits", "k.pair", "k.bits").alias("key")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.repartition("key").sortWithinPartitions("key", "fp")
    return rows.mapInArrow(forest, "a long, b long").distinct()


def _edges(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(rows, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``id, hash, fp, component, least``: per row its fingerprint, its component (named by a fingerprint)
    and the component's smallest id."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "fp-nodes")
    labels = connected_components(links(nodes, max_bits))
    linked = nodes.join(labels, F.col("fp") == F.col("node"))
    ids = linked.groupBy("component").agg(F.min("least").alias("least"))
    linked = linked.select("fp", "n", "component").join(ids, "component").select("fp", "n", "component", "least")
    alone = nodes.join(labels, F.col("fp") == F.col("node"), "left_anti").select("fp", "n", F.col("fp").alias("component"), "least")
    return join_counted(fps, materialize(linked.unionByName(alone), "fp-components"), ["fp"], "n", fps.count()).drop("n")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``.

    Texts are lower-cased (A-Z), cut into words at ASCII blanks and into shingles of ``shingle`` words,
    repeats included.  Fingerprints that differ in at most ``max_bits`` bits are linked; a component's id
    is the smallest id among its rows.

    Edge cases: texts without words (null, empty or blank) have fingerprint zero and link like any other;
    texts with fewer words than a shingle have one shingle, the whole; rows repeating an id are rows like
    any other; null ids are ignored for the smallest id (a component of null ids alone has a null id); an
    empty table gives an empty table.  Other columns are not read.
    """
    return components(docs, id_col, text_col, shingle, max_bits).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Of each component of :func:`simhash_groups` one row of ``docs``, with all its columns: a row with
    the component's smallest id (of several texts with that id, the one with the smallest hash).

    Edge cases: as :func:`simhash_groups`; of rows that repeat both id and text one stays; a component of
    null ids alone keeps a row with a null id; an empty table gives an empty table.
    """
    found = components(docs, id_col, text_col, shingle, max_bits)
    keepers = (found.where(F.col("id").eqNullSafe(F.col("least"))).groupBy("component")
               .agg(F.min("hash").alias("hash"), F.first("least").alias("id"))
               .select(F.struct(F.col("id"), F.col("hash")).alias("_key")).distinct())
    rows = packed(docs)
    ident, text = (F.col("_row").getField(c) for c in (id_col, text_col))
    key = F.struct(ident.cast("long").alias("id"), F.xxhash64(F.coalesce(text.cast("string"), F.lit("null"))).alias("hash"))
    kept = rows.withColumn("_key", key).join(keepers, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
