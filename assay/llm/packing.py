"""Packing along a space-filling curve.

Each document's bag of hashed words is projected to a few dimensions; the
point's Hilbert key orders the corpus so that similar documents are
neighbours.  Documents are range-sorted by that key (equal keys by a hash of
the id, so a group of copies spreads over ranges) and packed, one range per
task, into full sequences: a document is cut where a sequence ends.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from assay.llm.bpe import loaded
from assay.llm.common import range_bounds, sampled, task_count
from assay.llm.words import sliced, word_table

DIMS, BITS = 4, 8

# Fixed value: the pattern by which the byte-level tokenizer splits a text.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of text that a worker keys, and that it encodes, at once: what it holds beside a batch of its input.
KEYED_BYTES, ENCODED_BYTES = 1 << 21, 1 << 20

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "offset long, ids array<int>")


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of non-negative integer coordinates (``bits`` bits each): Skilling's
    transform to the transposed index, then its bits interleaved."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo excess work, from the highest bit
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray encode
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_points(texts: pa.Array) -> np.ndarray:
    """Each text's hashed word vector projected to ``DIMS`` integer coordinates of ``BITS`` bits."""
    sizes, places, distinct = word_table(texts)
    hashes = np.array([xxh64_intdigest(w) for w in distinct.cast(pa.binary()).to_pylist()], dtype="<u8")
    signs = hashes.view("<i2").reshape(-1, DIMS) / 2.0**14  # the word's weight in each dimension
    ends = np.cumsum(sizes, dtype=np.int64)
    totals = np.zeros((len(sizes) + 1, DIMS))
    for d in range(DIMS):
        sums = np.concatenate([[0.0], np.cumsum(signs[:, d][places])]) if len(places) else np.zeros(1)
        totals[1:, d] = sums[ends]
    spread = np.diff(totals, axis=0) / np.sqrt(np.maximum(sizes, 1))[:, None]
    return np.clip((np.tanh(spread / 8) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


@functools.lru_cache(maxsize=4)
def fast_encoder(data: bytes):
    """Encodes as the tokenizers library does with the byte-level BPE file ``data``: through the same
    vocabulary as ranks, or through the library itself where a text holds a special token's string or a run
    of blanks that is too long for the other's pattern."""
    import tiktoken

    spec = json.loads(data)
    special = [t["content"] for t in spec.get("added_tokens", [])]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_byte = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        as_byte[chr(256 + i)] = b
    ranks = {bytes(as_byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    quick = tiktoken.Encoding("byte-bpe", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not any(s in text for s in special):
            try:
                return quick.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # a run of about a million blanks: more than the pattern's stack holds
                pass
        return np.array(loaded(data).encode(text, add_special_tokens=False).ids, dtype=np.int64)

    return encode


def pack_documents(docs: DataFrame, tokenizer: bytes, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, ids``.

    A document's tokens are its whole text's ids and then ``end_id``.  Every sequence is full, but for
    the end of a range, whose last tokens fill sequences of power-of-two lengths: nothing is padded.

    Edge cases: a null text counts as empty (one token, ``end_id``); null and repeated ids are kept, each
    row is a document; documents of any length are cut as often as needed; an empty table gives no
    pieces.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sample, share = sampled(rows, "id")
    found = sample.mapInArrow(_keyed(None), "bucket int, key long, id long, text string").select(
        "key", F.octet_length("text").alias("size")).toPandas()
    weights = found["size"].to_numpy(dtype=np.float64) + 64
    ranges = task_count(spark, weights.sum() / share, 1 << 25)
    bounds = range_bounds(found["key"].to_numpy(), weights, ranges)
    keyed = rows.mapInArrow(_keyed(bounds), "bucket int, key long, id long, text string")
    shared = spark.sparkContext.broadcast(tokenizer)

    def pack(batches):
        encode = fast_encoder(shared.value)
        bucket, sequence, held = None, 0, []  # held: (id, start, ids, tokens of the document) after the last full sequence
        for batch in sliced(batches, limit=ENCODED_BYTES):
            for b, i, text in zip(batch.column("bucket").to_pylist(), batch.column("id").to_pylist(),
                                  batch.column("text").to_pylist()):
                if b != bucket:
                    yield from _closed(held, bucket, sequence, length)
                    bucket, sequence, held = b, 0, []
                ids = np.append(encode(text), end_id).astype("<u4")
                held.append((i, 0, ids, len(ids)))
            full = sum(len(h[2]) for h in held) // length
            out, held = _cut(held, [length] * full, bucket, sequence)
            sequence += full
            yield _pieces(out)
        yield from _closed(held, bucket, sequence, length)

    return (keyed.repartitionById(ranges, "bucket").sortWithinPartitions("bucket", "key", "id")
            .mapInArrow(pack, PIECE_SCHEMA))


def _keyed(bounds: np.ndarray | None):
    """Adds a sort key (Hilbert key, then a hash of the id) and the range that it falls into."""
    def run(batches):
        for batch in sliced(batches, limit=KEYED_BYTES):
            curve = hilbert_key(curve_points(batch.column("text")), BITS)
            ties = np.array([xxh64_intdigest(repr(i)) >> 33 for i in batch.column("id").to_pylist()], dtype=np.int64)
            key = (curve << 31) | ties
            bucket = np.zeros(len(key)) if bounds is None else np.searchsorted(bounds, key, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(key), batch.column("id"),
                                              batch.column("text")], ["bucket", "key", "id", "text"])
    return run


def _cut(docs: list, lengths: list[int], bucket: int, sequence: int) -> tuple[list, list]:
    """Fill sequences of the given lengths from ``docs`` in order; the pieces, and what is left over."""
    out, at = [], 0
    docs = docs[::-1]
    for size in lengths:
        at = 0
        while at < size:
            i, start, ids, tokens = docs.pop()
            take = min(size - at, len(ids))
            out.append((i, start, take, zlib.crc32(ids[:take].tobytes()), tokens, (bucket << 40) + sequence, at, ids[:take]))
            if take < len(ids):
                docs.append((i, start + take, ids[take:], tokens))
            at += take
        sequence += 1
    return out, docs[::-1]


def _closed(held: list, bucket, sequence: int, length: int):
    left = sum(len(h[2]) for h in held)
    powers = []
    while left:
        powers.append(min(length, 1 << (left.bit_length() - 1)))
        left -= powers[-1]
    if powers:
        yield _pieces(_cut(held, powers, bucket, sequence)[0])


def _pieces(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 8
    ids = columns.pop()
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32) if len(ids) else np.zeros(0, np.int32)
    names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns],
                                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names)
