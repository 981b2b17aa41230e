"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (each phrase is the longest known
phrase and one code point more), the set of phrases is hashed, and the
smallest hashes are the fingerprint.  The likeness of two fingerprints
estimates the share of common phrases, which is high where one text's
dictionary would compress the other.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import range_bounds, sampled, task_count
from assay.llm.words import sliced

#: Hashes kept per text, 32 bits each.  The likeness is exact up to so many phrases, an estimate with a
#: standard error of at most 0.05 beyond.
SIGNATURE = 128

# Odd multipliers of the phrase hash (the first with its inverse modulo 2**64).
BASE = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
INVERSE = pow(BASE, -1, 1 << 64)

COMPARED_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                   "near_edited double, near_next double")


class Phrases:
    """The phrases of a text that comes in parts.  The dictionary is a trie of (node, code point) pairs,
    so the time is linear in the text whatever the phrases' lengths."""

    def __init__(self):
        self.trie: dict[int, int] = {}
        self.ends: list[int] = []
        self.node = self.nodes = self.at = 0

    def copy(self) -> "Phrases":
        """The same state, to go on with another continuation."""
        out = Phrases()
        out.trie, out.ends = self.trie.copy(), self.ends.copy()
        out.node, out.nodes, out.at = self.node, self.nodes, self.at
        return out

    def feed(self, text: str) -> "Phrases":
        trie, node, nodes = self.trie, self.node, self.nodes
        get, add = trie.get, self.ends.append
        for i, c in enumerate(map(ord, text), self.at + 1):
            following = get(node + c)
            if following is None:
                nodes += 1 << 21  # above any code point
                trie[node + c] = nodes
                node = 0
                add(i)
            else:
                node = following
        self.node, self.nodes = node, nodes
        self.at += len(text)
        return self

    def closed(self) -> list[int]:
        """End of each phrase; the last phrase may be one that is known already."""
        return self.ends + [self.at] * bool(self.node)


def phrase_ends(text: str) -> list[int]:
    return Phrases().feed(text).closed()


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the hash base and of its inverse, as many as asked for so far."""

    up, down = _powers(BASE, 1), _powers(INVERSE, 1)

    @classmethod
    def of(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            size = 1 << (count - 1).bit_length()
            cls.up, cls.down = _powers(BASE, size), _powers(INVERSE, size)
        return cls.up[:count], cls.down[:count]


def signature(text: str, ends: list[int] | None = None) -> np.ndarray:
    """The smallest distinct 32-bit hashes of the text's phrases (which end at ``ends``), ascending."""
    if not text:
        return np.zeros(0, np.uint32)
    ends = np.array(phrase_ends(text) if ends is None else ends)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    up, down = _Powers.of(len(codes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * np.uint64(MIX) * up[:-1], dtype=np.uint64)])
    starts = np.concatenate([[0], ends[:-1]])
    h = (sums[ends] - sums[starts]) * down[starts]  # equal phrases have equal values wherever they stand
    h ^= h >> np.uint64(30)
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(27)
    h *= np.uint64(BASE)
    return np.unique((h >> np.uint64(32)).astype(np.uint32))[:SIGNATURE]


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common phrases among the smallest hashes of both (1 for two empty texts, 0 if one is empty)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:][both[1:] == both[:-1]]
    union = len(both) - len(twice)
    if union <= SIGNATURE:
        return len(twice) / union
    last = np.unique(both)[SIGNATURE - 1]
    return int((twice <= last).sum()) / SIGNATURE


def lz_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint``: one row per row of ``docs``; the fingerprint is the signature in hexadecimal.

    Edge cases: null and empty texts have an empty fingerprint; null and repeated ids are kept; an empty
    table gives an empty table.  Equal texts have equal fingerprints.  Other columns are not read.
    """
    def run(batches):
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([as_text(signature(t)) for t in batch.column("text").to_pylist()])],
                ["id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, fingerprint string")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Documents are ordered by id; the edited text has its last floor(n_chars / 4) code points replaced by
    the first as many (or all) of the next document's; after the last document comes the first.

    The table is dealt into ranges of ids; with each range travels one row more, the next range's first
    document, so no window spans the table.

    Edge cases: null texts count as empty; null ids come first; equal ids are ordered by text; a single
    document is its own next one; an empty table gives an empty table.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sample, share = sampled(rows, "id")
    found = sample.select("id", F.octet_length("text").alias("size")).where(F.col("id").isNotNull()).toPandas()
    ranges = task_count(spark, found["size"].sum() / share, 1 << 24)
    bounds = range_bounds(found["id"].to_numpy(), found["size"].to_numpy(dtype=float) + 64, ranges)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(bounds, ids[known].astype("int64").to_numpy(), side="right")
        return pd.Series(out)

    rows = rows.withColumn("range", range_of("id"))
    firsts = sorted((r["range"], None if r["nulls"] else r["least"]) for r in rows.groupBy("range").agg(
        F.min("id").alias("least"), F.max(F.col("id").isNull()).alias("nulls")).collect())  # one row per range
    following = [(firsts[i - 1][0], first) for i, (_, first) in enumerate(firsts)]
    wanted = F.broadcast(spark.createDataFrame(following, "range int, first long"))
    heads = (rows.drop("range").join(wanted, F.col("id").eqNullSafe(F.col("first"))).groupBy("range", "id")
             .agg(F.min("text").alias("text")))
    dealt = (rows.select("range", F.lit(0).alias("kind"), "id", "text")
             .unionByName(heads.select("range", F.lit(1).alias("kind"), "id", "text"))
             .repartitionById(ranges, "range").sortWithinPartitions("range", "kind", "id", "text"))

    def run(batches):
        before = None  # the row whose next one is awaited: id, text, signature, the phrases of the part that stays
        for batch in sliced(batches):
            out = []
            for kind, i, text in zip(batch.column("kind").to_pylist(), batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                stays = len(text) - len(text) // 4
                head = Phrases().feed(text[:stays])
                now = (i, text, signature(text, head.copy().feed(text[stays:]).closed()), head)
                if before is not None:
                    out.append(_compared(before, now))
                before = now if kind == 0 else None
            yield pa.RecordBatch.from_pylist(out, schema=_COMPARED)

    return dealt.mapInArrow(run, COMPARED_SCHEMA)


_COMPARED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(row: tuple, following: tuple) -> dict:
    """The text and its edited text begin alike, so the parse of that part serves both."""
    ident, text, sig, head = row
    cut = len(text) // 4
    tail = following[1][:cut]
    edited = text[:len(text) - cut] + tail
    changed = signature(edited, head.feed(tail).closed())
    return {"doc_id": ident, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": as_text(sig), "edited_fingerprint": as_text(changed), "near_edited": likeness(sig, changed),
            "near_next": likeness(sig, following[2])}
