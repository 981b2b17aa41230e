"""Spelling variants among a corpus's words, by a frequency-vector trie.

A word's frequency vector counts its letters per letter group (``GROUPS``
groups, each count held at 15).  One inserted, deleted or replaced letter
changes the vector by a surplus and a deficit of at most one each, so the
words near a word lie in the leaves that a depth-first search of the trie of
vectors reaches with those two budgets; the words of a leaf are then verified
letter by letter.  A pair is searched from one side only: the side whose
vector is smaller at the first group where they differ (equal vectors: from
the smaller word), so its surplus always comes first.

The trie's top is cut into cells: prefixes of vectors that hold a bounded
number of words (a single vector that holds more is cut into blocks).  The
cells, whose number is bounded, are known to every task; each word is stored
in its own cell and sent as a query to every other cell that its budgets
reach.  Each cell's task builds the rest of the trie, searches it and returns
for each word its near words' number and the best of them, not the pairs.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import materialize, task_count
from assay.llm.words import runs, sliced

#: Letters that share a count; other code points share four more counts (code point modulo 4).
LETTERS = ("e", "n", "t", "a", "i", "o", "h", "r", "s", "u", "l", "c", "d", "fgj", "bmkq", "pwxyvz")
GROUPS = len(LETTERS) + 4
#: Counts are held at this (two held counts never differ by more than the true ones).
HELD = 15
#: Least and usual most words of a cell; a vocabulary of over 67 million words has larger cells, so that
#: there are never more than about CELLS * (HELD + 1) * GROUPS cells.
LEAST_WORDS, MOST_WORDS, CELLS = 2048, 16384, 4096
#: Pairs that a search holds at once.
HELD_PAIRS = 1 << 20
#: A word of the corpus has its first letters, or its last ones, in common with every near word.
HEAD, TAIL = 3, 4
#: Longer words are verified one pair at a time.
WIDTH = 32

WORDS_SCHEMA = "word string, n long"
CELL_SCHEMA = "part int, cell int, home boolean, words array<string>, counts array<long>"
NEAR_SCHEMA = "word string, n_near long, best_n long, best_word string"


def corpus_words(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 7, min_count: int = 2,
                 slip_every: int | None = 31) -> DataFrame:
    """``word, n``: the distinct words of at least ``min_chars`` code points and how often they occur, at
    least ``min_count`` times.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.  With ``slip_every``, a
    run loses the code point ``h % length`` where that number divides h, the CRC-32 of
    ``<id>:<lower-cased run>``: seeded typing slips, the same in every run of the job.

    Edge cases: null texts have no words, a null id is the empty text; repeated rows count each.
    """
    letters = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, min_chars))

    def run(batches):
        counts: dict[str, int] = {}
        held = 0
        for batch in sliced(batches):
            for i, text in zip(batch.column("id").to_pylist(), pc.ascii_lower(batch.column("text")).to_pylist()):
                seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                for w in letters.findall(text):
                    if slip_every and not (h := zlib.crc32(w.encode(), seed)) % slip_every:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < min_chars or not w:
                            continue
                    if w in counts:
                        counts[w] += 1
                    else:
                        counts[w] = 1
                        held += len(w) + 100
                if held > 1 << 24:
                    yield _counted(counts)
                    counts, held = {}, 0
        if counts:
            yield _counted(counts)

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(run, WORDS_SCHEMA).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _counted(counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words' code points, end to end, and each word's length."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), np.fromiter(map(len, words), np.int64, len(words))


def _group_table() -> np.ndarray:
    table = len(LETTERS) + np.arange(128) % 4
    for g, letters in enumerate(LETTERS):
        table[[ord(c) for c in letters]] = g
    return table


GROUP_OF = _group_table()


def frequency_vectors(words: list[str]) -> np.ndarray:
    """One row per word: its letters per group."""
    codes, lengths = _codes(words)
    group = np.where(codes < 128, GROUP_OF[np.minimum(codes, 127)], len(LETTERS) + codes % 4)
    flat = np.repeat(np.arange(len(words)), lengths) * GROUPS + group
    return np.minimum(np.bincount(flat, minlength=len(words) * GROUPS), HELD).astype(np.uint8).reshape(-1, GROUPS)


def with_vectors(words: DataFrame) -> DataFrame:
    """``word, n`` with ``vec``, the frequency vector as a text of one letter (a to p) per group."""
    def run(batches):
        for batch in batches:
            v = frequency_vectors(batch.column("word").to_pylist()) + ord("a")
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array([r.tobytes().decode() for r in v], pa.string())],
                                             ["word", "n", "vec"])

    return words.select("word", "n").mapInArrow(run, WORDS_SCHEMA + ", vec string")


def trie_cells(words: DataFrame, most: int) -> dict[str, int]:
    """Prefixes of vectors that cut the trie of ``words`` (``vec``) into cells, and their numbers of words:
    a prefix that holds more than ``most`` words is replaced by the longer ones below it."""
    cells: dict[str, int] = {}
    for depth in range(1, GROUPS + 1):
        below = words if depth == 1 else words.join(
            F.broadcast(words.sparkSession.createDataFrame([(p,) for p in large], "p string")),  # at most words / most
            F.substring("vec", 1, depth - 1) == F.col("p"), "left_semi")
        found = {r.p: r.n for r in below.groupBy(F.substring("vec", 1, depth).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        large = [p for p, n in found.items() if n > most and depth < GROUPS]
        cells |= {p: n for p, n in found.items() if p not in set(large)}
        if not large:
            break
    return cells


class _Trie:
    """A trie of the distinct rows of ``vectors`` (sorted); a node's children are looked up by count."""

    def __init__(self, vectors: np.ndarray):
        new = np.zeros(len(vectors), dtype=bool)
        new[:1] = True
        node = np.zeros(len(vectors), dtype=np.int64)
        self.children = []
        for k in range(vectors.shape[1]):
            new[1:] |= vectors[1:, k] != vectors[:-1, k]
            below = np.cumsum(new) - 1
            child = np.full((int(node[-1]) + 1 if len(node) else 1, HELD + 2), -1, dtype=np.int32)  # a last column without children
            child[node, vectors[:, k]] = below
            self.children.append(child)
            node = below

    def search(self, queries: np.ndarray):
        """Batches of (query, leaf, state) of all leaves within a query's budgets, depth first.  States: 0 the
        same vector, 1 a surplus, 2 a surplus and then a deficit (the other order is found from the leaf's side)."""
        stack = [(0, np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64), np.zeros(len(queries), dtype=np.int8))]
        while stack:
            k, q, node, state = stack.pop()
            if k == len(self.children):
                yield q, node, state
                continue
            if len(q) > HELD_PAIRS:
                half = len(q) // 2
                stack += [(k, q[:half], node[:half], state[:half]), (k, q[half:], node[half:], state[half:])]
                continue
            child, count = self.children[k], queries[q, k].astype(np.int64)
            found = []
            for mask, change, after in ((None, 0, None), (state == 0, 1, 1), (state == 1, -1, 2)):
                some = np.arange(len(q)) if mask is None else np.flatnonzero(mask)
                to = child[node[some], count[some] + change]
                some, to = some[to >= 0], to[to >= 0]
                found.append((q[some], to, state[some] if after is None else np.full(len(some), after, dtype=np.int8)))
            q, node, state = (np.concatenate(x) for x in zip(*found))
            if len(q):
                stack.append((k + 1, q, node, state))


class _Words:
    """Words in code-point order, with what verifying a pair looks at."""

    def __init__(self, words: list[str]):
        codes, self.length = _codes(words)
        self.words = words
        row, col = np.repeat(np.arange(len(words)), self.length), runs(self.length)
        back = np.repeat(self.length, self.length) - 1 - col
        self.left, self.right = (np.zeros((len(words), WIDTH), dtype=np.uint32) for _ in range(2))
        for to, at in ((self.left, col), (self.right, back)):
            inside = at < WIDTH
            to[row[inside], at[inside]] = codes[inside] + 1
        self.head, self.tail = (self._hashed(m, k) for m, k in ((self.left, HEAD), (self.right, TAIL)))

    @staticmethod
    def _hashed(matrix, k):
        out = np.zeros(len(matrix), dtype=np.uint64)
        for i in range(k):
            out = (out ^ matrix[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        return out

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words of each pair (two different words) differ by exactly one edit."""
        la, lb = self.length[a], self.length[b]
        longer = np.maximum(la, lb)
        ok = np.flatnonzero((np.abs(la - lb) <= 1) & ((longer < HEAD + TAIL) | (self.head[a] == self.head[b]) | (self.tail[a] == self.tail[b])))
        a, b, longer = a[ok], b[ok], longer[ok]
        out = np.zeros(len(la), dtype=bool)
        short = longer <= WIDTH
        first = (self.left[a[short]] != self.left[b[short]]).argmax(axis=1)  # letters in common at the front, at the end
        last = (self.right[a[short]] != self.right[b[short]]).argmax(axis=1)
        out[ok[short]] = first + last >= longer[short] - 1
        for i, x, y in zip(ok[~short], a[~short], b[~short]):
            out[i] = one_edit(self.words[x], self.words[y])
        return out


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # the longest common beginning, by halves
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)):] == b[low + 1:]


def _leaf_pairs(search, starts_a, counts_a, starts_b, counts_b):
    """Word pairs of (query vector, leaf, state) batches, at most about ``HELD_PAIRS`` at once."""
    for q, leaf, state in search:
        a0, na, b0, nb = starts_a[q], counts_a[q], starts_b[leaf], counts_b[leaf]
        step = np.maximum(1, HELD_PAIRS // nb)  # so many words of a query's vector in one piece
        pieces = -(-na // step)
        piece = runs(pieces)
        each = np.repeat(np.arange(len(q)), pieces)
        a0 = a0[each] + piece * step[each]
        na = np.minimum(step[each], na[each] - piece * step[each])
        b0, nb, state = b0[each], nb[each], state[each]
        ends = np.cumsum(na * nb)
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HELD_PAIRS, side="right")))
            size = (na * nb)[at:to]
            of, inside = np.repeat(np.arange(at, to), size), runs(size)
            yield a0[of] + inside // nb[of], b0[of] + inside % nb[of], state[of]
            at = to


def near_words(words: list[str], counts: np.ndarray, home: np.ndarray):
    """Per word with near words among the pairs searched here: its place in ``words`` (sorted, distinct),
    their number, and the place of the one that occurs most often (ties: the smallest word).  The pairs
    are those of a word of ``home`` and a word whose search reaches it."""
    vectors, of = np.unique(frequency_vectors(words), axis=0, return_inverse=True)
    of = of.ravel()
    by_vector = np.argsort(of, kind="stable")
    counts_a = np.bincount(of, minlength=len(vectors))
    starts_a = np.cumsum(counts_a) - counts_a
    at_home = np.flatnonzero(home)
    leaves = np.unique(of[at_home])
    by_leaf = at_home[np.argsort(of[at_home], kind="stable")]
    counts_b = np.bincount(np.searchsorted(leaves, of[at_home]), minlength=len(leaves))
    starts_b = np.cumsum(counts_b) - counts_b
    table, found = _Words(words), []
    for a, b, state in _leaf_pairs(_Trie(vectors[leaves]).search(vectors), starts_a, counts_a, starts_b, counts_b):
        a, b = by_vector[a], by_leaf[b]
        once = (state > 0) | (a < b)
        a, b = a[once], b[once]
        ok = table.near(a, b)
        found.append((a[ok], b[ok]))
    a, b = (np.concatenate([f[i] for f in found] or [np.zeros(0, dtype=np.int64)]) for i in (0, 1))
    word, other = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((other, -counts[other], word))
    word, other = word[order], other[order]
    who, first, number = np.unique(word, return_index=True, return_counts=True)
    return who, number, other[first]


def _routes(cells: dict[str, int], most: int):
    """Cell numbers: a cell's blocks follow each other; (first number, blocks) per prefix."""
    numbers, at = {}, 0
    for p in sorted(cells):
        blocks = -(-cells[p] // most)
        numbers[p] = (at, blocks)
        at += blocks
    return numbers, at


def _dealt(words: DataFrame, cells: dict[str, int], most: int, parts: int) -> DataFrame:
    """Each batch's words per cell that stores them or that their search reaches."""
    numbers, total = _routes(cells, most)
    part_of = np.zeros(total, dtype=np.int32)  # the largest cells first, each to the part with the fewest words
    heap = [(0, p) for p in range(parts)]
    for cell, size in sorted(((c, min(most, cells[p])) for p, (at, blocks) in numbers.items() for c in range(at, at + blocks)), key=lambda x: -x[1]):
        held, p = heapq.heappop(heap)
        part_of[cell] = p
        heapq.heappush(heap, (held + size, p))
    inner = {p[:k] for p in cells for k in range(len(p))}

    def reached(vec: str):
        """Cells that store the vector's words, and those that its search reaches (depth first)."""
        stack, out = [("", 0)], []
        while stack:
            p, state = stack.pop()
            if p in numbers:
                out.append((p, state == 0))
                continue
            if p not in inner:
                continue
            c = vec[len(p)]
            stack.append((p + c, state))
            if state == 0 and c < chr(ord("a") + HELD):
                stack.append((p + chr(ord(c) + 1), 1))
            elif state == 1 and c > "a":
                stack.append((p + chr(ord(c) - 1), 2))
        return out

    deepest = max(map(len, cells), default=0)

    def run(batches):
        known: dict[str, list] = {}  # by as much of a vector as the cells look at
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            sent: dict[tuple[int, bool], list[int]] = {}
            for i, vec in enumerate(batch.column("vec").to_pylist()):
                to = known.get(vec[:deepest])
                if to is None:
                    to = known[vec[:deepest]] = reached(vec)
                for p, home in to:
                    at, blocks = numbers[p]
                    own = at + zlib.crc32(words[i].encode("utf-8", "surrogatepass")) % blocks if home else -1
                    for cell in range(at, at + blocks):
                        sent.setdefault((cell, cell == own), []).append(i)
            if len(known) > 100_000:
                known.clear()
            keys = list(sent)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part_of[c]) for c, _ in keys], pa.int32()), pa.array([c for c, _ in keys], pa.int32()),
                 pa.array([h for _, h in keys], pa.bool_()), pa.array([[words[i] for i in sent[k]] for k in keys], pa.list_(pa.string())),
                 pa.array([counts[sent[k]] for k in keys], pa.list_(pa.int64()))], ["part", "cell", "home", "words", "counts"])

    return words.mapInArrow(run, CELL_SCHEMA)


def _searched(batches):
    """Search each cell (the rows come cell by cell)."""
    def done(rows):
        words = [w for _, ws, _ in rows for w in ws]
        counts = np.concatenate([c for _, _, c in rows])
        home = np.repeat([h for h, _, _ in rows], [len(ws) for _, ws, _ in rows])
        order = sorted(range(len(words)), key=words.__getitem__)
        words, counts, home = [words[i] for i in order], counts[order], home[order]
        who, number, best = near_words(words, counts, home)
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i in who], pa.string()), pa.array(number.astype(np.int64)),
                                           pa.array(counts[best].astype(np.int64)), pa.array([words[i] for i in best], pa.string())],
                                          ["word", "n_near", "best_n", "best_word"])

    cell, rows = None, []
    for batch in batches:
        for c, h, ws, ns in zip(batch.column("cell").to_pylist(), batch.column("home").to_pylist(), batch.column("words").to_pylist(),
                                batch.column("counts")):
            if c != cell and rows:
                yield done(rows)
                rows = []
            cell = c
            rows.append((h, ws, ns.values.to_numpy()))
    if rows:
        yield done(rows)


def near_table(words: DataFrame) -> DataFrame:
    """``word, n, n_near, best_n, best_word`` for ``words`` (``word`` distinct, ``n``): how many near words a
    word has (0: nulls follow) and the one of them that occurs most often (ties: the smallest)."""
    spark = words.sparkSession
    words = materialize(with_vectors(words), "words")
    total = words.count()
    most = max(LEAST_WORDS, min(total // 128, MOST_WORDS), total // CELLS)
    cells = trie_cells(words, most)
    parts = max(1, min(task_count(spark, total, MOST_WORDS), len(cells) // 2))
    found = (_dealt(words, cells, most, parts).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "cell")
             .select("cell", "home", "words", "counts").mapInArrow(_searched, NEAR_SCHEMA))
    none = F.lit(None)
    both = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("struct<m:bigint,w:string>").alias("b")).unionByName(
        found.select("word", none.cast("long").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("m"), F.col("best_word").alias("w")).alias("b")))
    return (both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("b").alias("b"))
            .select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best_word")))


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``words`` (``word`` distinct, ``n``).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point.  ``form`` is
    the near word that occurs most often (ties: the smallest in code-point order) if it occurs at least
    ``ratio`` times as often as the word, else null; ``root`` is where the forms lead to in the end.
    With ``ratio`` over 1 forms grow along the way, so they cannot come back.

    Edge cases: a word without near words has ``n_near`` 0 and is its own root; an empty table gives no
    rows; null words are left out; very long words are compared whole.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    near = near_table(words.where(F.col("word").isNotNull()))
    takes = F.col("best_n") >= F.lit(ratio) * F.col("n")
    forms = materialize(near.select("word", "n", "n_near", F.when(takes, F.col("best_word")).alias("form"),
                                    F.when(takes, F.col("best_n")).alias("form_n")), "forms")
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(64):  # each round doubles the way that is followed
        roots = materialize(roots, "roots")
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not roots.join(after, "root", "left_semi").limit(1).count():
            break
        roots = roots.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return (forms.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
