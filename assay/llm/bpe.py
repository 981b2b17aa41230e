"""BPE encoding through a table of distinct words, and decoding through an id-to-piece join.

ASCII blanks are boundaries of the tokenizer's own splitting and lose nothing
to its normaliser, so a text's ids are the ids of its words end to end.  The
words of each block of documents are made distinct, meet in one task per word
and are encoded there once each; the ids go back to the blocks and are joined
by position.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assay.llm.common import task_count
from assay.llm.words import PART_BYTES, block_rows, packed_numbers, runs, unpacked_numbers, unpacked_words, word_rows

#: Words laid out at a time in a block.
LAID_WORDS = 1 << 18


#: Tokens decoded at a time.
DECODE_TOKENS = 1 << 21


def read_tokenizer(path: str) -> bytes:
    """A tokenizer file's bytes, for the functions below; they are broadcast (a few MB, whatever the data)."""
    with open(path, "rb") as f:
        return f.read()


@functools.lru_cache(maxsize=4)
def loaded(data: bytes):
    """The tokenizer of a file's bytes, with the file's truncation and padding unused."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def bpe_encode(docs: DataFrame, tokenizer: bytes, id_col: str = "doc_id", text_col: str = "text",
               decoded: bool = False) -> DataFrame:
    """``id, ids, ids_sha256``: the token ids (array<int>) of every row's whole text, and the digest of the
    ids as little-endian unsigned 32-bit integers, as the tokenizers library encodes it with ``add_special_tokens=False``, truncation and padding unused.

    ``decoded`` adds ``text``, the ids decoded as by :func:`bpe_decode`, in the same tasks.

    For tokenizers whose splitting ends every piece at an ASCII blank and drops blanks (word-level BPE);
    the strings of special tokens must hold no blank.

    Edge cases: a null text counts as empty, an empty or blank text has no ids; null and repeated ids are
    kept, one row per input row; an empty table gives an empty table.  Other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    small = np.dtype("<u2" if len(json.loads(tokenizer)["model"]["vocab"]) < 60_000 else "<u4")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = task_count(spark, size, PART_BYTES)

    def encode(batches):  # a task has all rows of its part: each distinct word is encoded once
        tok, table = loaded(shared.value), {}
        for batch in batches:
            ids, sizes = [], []
            for data in batch.column("words").to_pylist():
                words = unpacked_words(data)
                fresh = [w for w in words if w not in table]
                for w, e in zip(fresh, tok.encode_batch(fresh, add_special_tokens=False)):
                    table[w] = np.array(e.ids, dtype=small).tobytes()
                found = [table[w] for w in words]
                sizes.append(packed_numbers(np.array([len(f) // small.itemsize for f in found])))
                ids.append(zstandard.ZstdCompressor(level=1).compress(b"".join(found)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("places"), pa.array(sizes, pa.binary()),
                                              pa.array(ids, pa.binary())], ["block", "places", "sizes", "ids"])

    def lay_out(key, words: pa.Table, blocks: pa.Table):
        pieces = pieces_of(shared.value) if decoded else None
        flat, places, lengths = [], [], []
        for row in words.to_pylist():
            places.append(unpacked_numbers(row["places"]))
            lengths.append(unpacked_numbers(row["sizes"]))
            flat.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(row["ids"]), dtype=small))
        flat, at, sizes = np.concatenate([*flat, np.zeros(0, small)]), np.concatenate([*places, []]).astype(np.int64), \
            np.concatenate([*lengths, []]).astype(np.int64)
        distinct = int(at.max()) + 1 if len(at) else 0
        length, start = np.zeros(distinct, np.int64), np.full(distinct, -1, np.int64)
        length[at], start[at] = sizes, np.cumsum(sizes) - sizes
        out = []
        for block in blocks.to_pylist():
            of_word, counts = unpacked_numbers(block["places"]), unpacked_numbers(block["sizes"])
            if len(of_word) and (of_word.max() >= distinct or start.min() < 0):
                raise RuntimeError("a block's words did not come back whole: its input changed between two reads")
            ends, first = np.cumsum(counts), 0
            while first < len(counts):  # so many words at a time: memory stays bounded
                a = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, a + LAID_WORDS, side="right")))
                mine = of_word[a:ends[last - 1]]
                per = length[mine]
                ids = flat[np.repeat(start[mine], per) + runs(per)].astype(np.int32)
                cuts = np.concatenate([[0], np.cumsum(per)])[np.concatenate([[0], ends[first:last] - a])].astype(np.int32)
                digest = [hashlib.sha256(ids[x:y].astype("<u4").tobytes()).hexdigest() for x, y in zip(cuts, cuts[1:])]
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids))
                columns = [pa.array(block["ids"][first:last], pa.int64()), lists, pa.array(digest, pa.string())]
                columns += [_joined(lists, pieces)] if decoded else []
                out.append(pa.RecordBatch.from_arrays(columns, ["id", "ids", "ids_sha256", "text"][:len(columns)]))
                first = last
        fields = [("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("text", pa.string())]
        return pa.Table.from_batches(out, pa.schema(fields[:4 if decoded else 3]))

    encoded = word_rows(rows, parts).repartitionById(parts, "part").mapInArrow(
        encode, "block long, places binary, sizes binary, ids binary")
    return (encoded.repartition(parts, "block").groupBy("block").cogroup(block_rows(rows).repartition(parts, "block").groupBy("block"))
            .applyInArrow(lay_out, "id long, ids array<int>, ids_sha256 string" + ", text string" * decoded))


def bpe_decode(encoded: DataFrame, tokenizer: bytes) -> DataFrame:
    """``id, ids, ids_sha256, text``: adds to ``encoded`` the text as the tokenizers library decodes it with
    ``skip_special_tokens=False`` where the file names no decoder: the pieces joined by blanks.

    The id-to-piece table is the vocabulary, whose size the file fixes: it is broadcast, and ids are
    joined to pieces by position in the tasks.  Null ids give a null text, no ids an empty one; an id
    that the vocabulary does not hold adds nothing, as in the library.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        pieces = pieces_of(shared.value)
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(), dtype=np.int64)
            start = 0
            while start < batch.num_rows:  # so many tokens at a time: memory stays bounded
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + DECODE_TOKENS, "right")))
                lists = batch.column("ids").slice(start, stop - start)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*part.columns, _joined(lists, pieces)], [*part.schema.names, "text"])
                start = stop

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("text", StringType())]))


@functools.lru_cache(maxsize=4)
def pieces_of(tokenizer: bytes) -> pa.Array:
    """The id-to-piece table of a tokenizer without a decoder."""
    if json.loads(tokenizer).get("decoder") is not None:
        raise ValueError("only tokenizers without a decoder are decoded here")
    vocabulary = loaded(tokenizer).get_vocab(with_added_tokens=True)
    by_id: list = [None] * (max(vocabulary.values(), default=-1) + 1)
    for piece, i in vocabulary.items():
        by_id[i] = piece
    return pa.array(by_id, pa.string())


def _joined(lists: pa.Array, pieces: pa.Array) -> pa.Array:
    """Each list's ids joined to their pieces, and the pieces joined by blanks."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy()
    known = (flat >= 0) & (flat < len(pieces))
    found = pieces.take(pa.array(np.where(known, flat, 0)))
    if not known.all() or found.null_count:  # unknown ids fall out
        good = known & ~found.is_null().to_numpy(zero_copy_only=False)
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[good], minlength=len(sizes))
        found = found.filter(pa.array(good))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), found), " ")
    return pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), text)
