"""Word tables of blocks of documents.

A block is a few documents of a scan task, bounded in bytes.  Its texts are
split at ASCII blanks into words; the block keeps its distinct words and, per
document, the positions of its words in that list.  Only distinct words
travel; results per word come back to their block and are laid out again by
position.  A block's key is a hash of its content, so a recomputed task makes
the same blocks, and a block whose words do not come back whole is an error,
never a silent loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from xxhash import xxh64_intdigest

#: Bytes of text in a block (a longer document is a block of its own), and bytes of all text per part of
#: the table of distinct words.
BLOCK_BYTES = 1 << 23
PART_BYTES = 1 << 24

BLOCK_SCHEMA = "block long, ids array<bigint>, sizes binary, places binary"
WORD_SCHEMA = "part int, block long, places binary, words binary"


def sliced(batches, column: str = "text", limit: int = BLOCK_BYTES, keep_nulls: bool = False) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``limit`` bytes of ``column`` (or one row), nulls made empty unless kept."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        if not keep_nulls:
            batch = batch.set_column(at, column, pc.fill_null(batch.column(at), ""))
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words per text, each word's place in the list of distinct words, and that list.  Words are the
    runs between ASCII blanks; blanks at the ends of a text add an empty word."""
    words = pc.ascii_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    return np.diff(words.offsets.to_numpy()), coded.indices.to_numpy(), coded.dictionary


def packed_numbers(values: np.ndarray) -> bytes:
    """Non-negative integers below 2**32 as byte planes, compressed (Zstandard)."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def packed_counts(values: np.ndarray) -> bytes:
    """Non-negative integers below 2**63 as byte planes, compressed: counts over a whole corpus."""
    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def packed_hashes(hashes: np.ndarray, parts: int) -> bytes:
    """Hashes that all leave the same remainder by ``parts``: their quotients as byte planes, compressed."""
    planes = (hashes // np.uint64(parts)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked_hashes(data: bytes) -> np.ndarray:
    """The quotients: as distinct as the hashes, among those of one remainder."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed_floats(values: np.ndarray) -> bytes:
    """32-bit floats as byte planes, compressed: neighbours share their signs and exponents."""
    planes = values.astype("<f4").ravel().view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked_floats(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<f4").ravel()


def packed_words(words: list[str]) -> bytes:
    """Words, which hold no line end, compressed."""
    return zstandard.ZstdCompressor(level=1).compress("\n".join(words).encode())


def unpacked_words(data: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(data).decode().split("\n")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _block(batch: pa.RecordBatch, lower: bool):
    """A block's key, sizes, places and distinct words, frequent words first (small places pack better)."""
    text = batch.column("text")
    sizes, places, distinct = word_table(pc.ascii_lower(text) if lower else text)
    order = np.argsort(-np.bincount(places, minlength=len(distinct)), kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    places, distinct = rank[places] if len(places) else places, distinct.take(pa.array(order))
    key = 0
    for part in (repr(batch.column("id").to_pylist()).encode(), sizes.tobytes(), places.tobytes(),
                 *[b for b in distinct.buffers() if b is not None]):
        key = xxh64_intdigest(part, key)
    return _signed(key), sizes, places, distinct


def block_rows(docs: DataFrame, lower: bool = False) -> DataFrame:
    """One row per block of ``docs`` (``id, text``): its documents' ids, word counts and words' places."""
    def run(batches):
        for batch in sliced(batches):
            key, sizes, places, _ = _block(batch, lower)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key]), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([packed_numbers(sizes)]), pa.array([packed_numbers(places)])], ["block", "ids", "sizes", "places"])

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def word_rows(docs: DataFrame, parts: int, lower: bool = False, classes: int = 0, pairs: bool = False) -> DataFrame:
    """The distinct words of each block of ``docs`` (``id, text``), dealt by a hash of the word into
    ``parts`` parts: one row per block and part, with the words and their places in the block.
    ``classes`` adds, for each class from 1 to ``classes``, how often each word stands in the documents
    whose column ``class`` is that number (other documents are not counted).  ``pairs`` adds rows of
    ``kind`` 2 (the others: 1) for the block's distinct :func:`word_pairs`, dealt by their hash: packed hashes in
    ``words``, numbers in ``places``, and in ``counts`` how often each stands in documents of a class."""
    def run(batches):
        for batch in sliced(batches):
            key, sizes, places, distinct = _block(batch, lower)
            hashed = word_hashes(distinct)
            part = (hashed % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            words, cuts = distinct.take(pa.array(order)).to_pylist(), np.searchsorted(part[order], np.arange(parts + 1))
            used = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
            columns = [pa.array(used, pa.int32()), pa.array([key] * len(used), pa.int64()),
                       pa.array([packed_numbers(order[cuts[p]:cuts[p + 1]]) for p in used], pa.binary()),
                       pa.array([packed_words(words[cuts[p]:cuts[p + 1]]) for p in used], pa.binary())]
            if classes:
                of_word = np.repeat(batch.column("class").to_numpy(), sizes)
                counts = np.bincount(of_word * len(distinct) + places, minlength=(classes + 1) * len(distinct))
                counts = counts.reshape(classes + 1, -1)[1:, order]
                columns.append(pa.array([packed_numbers(counts[:, cuts[p]:cuts[p + 1]].ravel()) for p in used], pa.binary()))
            if pairs:
                columns += [pa.nulls(len(used), pa.binary())] * (not classes) + [pa.array([1] * len(used), pa.int32())]
            names = ["part", "block", "places", "words", "counts", "kind"]
            yield pa.RecordBatch.from_arrays(columns, names[:len(columns)])
            if pairs:
                token = pc.binary_length(distinct).to_numpy() > 0
                of_doc, number, first, second = word_pairs(sizes, places, token)
                hashed = np.append(hashed, np.uint64(END_HASH))
                found = pair_hashes(hashed[first], hashed[second])
                times = np.bincount(number[(batch.column("class").to_numpy() > 0)[of_doc]], minlength=len(found))
                part = (found % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                used = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                some = [order[cuts[p]:cuts[p + 1]] for p in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([key] * len(used), pa.int64()),
                     pa.array([packed_numbers(o) for o in some], pa.binary()), pa.array([packed_hashes(found[o], parts) for o in some], pa.binary()),
                     pa.array([packed_numbers(times[o]) for o in some], pa.binary()), pa.array([2] * len(used), pa.int32())], names)

    return docs.mapInArrow(run, WORD_SCHEMA + ", counts binary" * bool(classes or pairs) + ", kind int" * pairs)


#: Words up to so many bytes are hashed together, eight bytes at a time; longer ones each by XXH64.
SHORT = 64


def word_hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word's bytes."""
    starts = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2] or b""
    text = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray(len(text) - 7, dtype="<u8", buffer=text, strides=(1,))  # the eight bytes from each place
    lengths, starts = np.diff(starts), starts[:-1]
    out = (lengths.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for place in range(0, SHORT, 8):
        some = np.flatnonzero((lengths > place) & (lengths <= SHORT))
        if len(some):
            left = np.minimum(lengths[some] - place, 8).astype(np.uint64)
            lane = eights[starts[some] + place] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - left) * np.uint64(8)))
            h = (out[some] ^ lane) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            out[some] = h ^ (h >> np.uint64(29))
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = xxh64_intdigest(text[starts[i]:starts[i] + lengths[i]].tobytes())
    return out


#: Stands for the hash of a text's end, and of what precedes its first word.
END_HASH = 0x8CB92BA72F3D8DD7


def word_pairs(sizes: np.ndarray, places: np.ndarray, token: np.ndarray):
    """The pairs of neighbours in a block whose texts stand end to end, each closed by an end (place
    ``len(token)``): the document and the pair's number per step, and each distinct pair's places.  A text's
    first word follows the end before it.  ``token`` says which distinct words count (the empty word is none)."""
    kept = token[places] if len(places) else np.zeros(0, dtype=bool)
    of_doc, end = np.repeat(np.arange(len(sizes)), sizes)[kept], len(token)
    lengths = np.bincount(of_doc, minlength=len(sizes)) + 1
    steps = np.full(int(lengths.sum()), end, dtype=np.int64)
    steps[np.arange(len(of_doc)) + of_doc] = places[kept]
    coded = pa.array(np.concatenate([[end], steps[:-1]]) * (end + 1) + steps).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    return np.repeat(np.arange(len(sizes)), lengths), coded.indices.to_numpy(), distinct // (end + 1), distinct % (end + 1)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    h = (first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + second
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def runs(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
