"""Personal data by fixed rules and a semi-Markov conditional random field.

The rules find the four kinds of spans as their patterns say.  Around digits
and at-signs the field then scores whole candidate segments by span features
(digit counts and groups, separators, checksums, the characters beside it) and
chooses boundaries and kinds jointly by dynamic programming over segments of
bounded length.  Its spans that touch no rule's span are added; the rules'
spans always stay.  The field is trained on the rules' own spans in a bounded
sample, and on written variants of them (no country sign, other separators).
"""

from __future__ import annotations

import ast
import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from assay.llm.words import sliced

# The kinds, in order, and the rules' patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGNAL = "[0-9@]"

#: Units (runs of letters, of digits, of blanks, or single characters) in a segment at most, and regions
#: per kind to train on at most.
MAX_UNITS = 16
KNOWN_CHARS = 64  # segments up to this length are looked up in a table of those just seen
TRAINING_REGIONS = 80

SPAN_SCHEMA = "id long, spans array<struct<kind:string,start:long,end:long,rule:boolean>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(number: str) -> bool:
    return len(number.lstrip("0")) <= 3 and int(number.lstrip("0") or 0) <= 255


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the rules' matches, sorted.  The e-mail pattern is matched from its
    at-signs backwards and an address pattern only from a number's start, which finds the same leftmost
    matches in linear time."""
    out, done = [], 0
    for m in EMAIL_DOMAIN.finditer(text):
        low = max(done, text.rfind("@", 0, m.start()) + 1)
        start = low + len(text[low:m.start()].rstrip(EMAIL_LOCAL))
        if start < m.start():
            out.append((start, 0, m.end()))
            done = m.end()
    for m in IP.finditer(text):
        if all(_small(p) for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------------------ the field
UNIT = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
WORD = re.compile(r"\S+")
MARK = re.compile("[0-9@]")
GAPS = frozenset(a + b for a in " \t\xa0" for b in ("", *" \t\xa0"))
NAMES = ("bias", "at", "local", "domain", "tld", "plus", "open", "area", "octets", "fours", "luhn", "no luhn", "letters",
         "other signs", "digits 7-9", "digits 10-11", "digits 12-13", "digits 14-16", "digits 17-19", "one group", "two groups",
         "three groups", "four groups", "more groups", "blanks", "hyphens", "dots", "mixed", "inside left", "inside right",
         "number left", "number right", "ends in a digit")
NUMBER = {n: i for i, n in enumerate(NAMES)}


def units_of(region: str) -> list[tuple[int, int]]:
    return [m.span() for m in UNIT.finditer(region)]


def segments(region: str, units: list[tuple[int, int]]) -> list[tuple[int, int, tuple[int, ...]]]:
    """Candidate segments ``(first unit, unit after, features)``: those that hold one at-sign, or 4 to 19
    digits and no at-sign, and neither start nor end with a blank."""
    out = []
    digits_of = [u[1] - u[0] if region[u[0]] in "0123456789" else 0 for u in units]
    blank = [region[u[0]].isspace() for u in units]
    for i in range(len(units)):
        if blank[i]:
            continue
        digits = ats = 0
        for j in range(i, min(len(units), i + MAX_UNITS)):
            digits += digits_of[j]
            ats += region[units[j][0]] == "@"
            if ats > 1 or digits > 40:
                break
            if not blank[j] and (ats or 4 <= digits <= 19):
                a, b = units[i][0], units[j][1]
                features = _features if b - a <= KNOWN_CHARS else _features.__wrapped__
                out.append((i, j + 1, features(region[max(0, a - 4):a], region[a:b], region[b:b + 4], digits, ats)))
    return out


@functools.lru_cache(maxsize=1 << 16)
def _features(before: str, s: str, after: str, digits: int, ats: int) -> tuple[int, ...]:
    """The features of the segment ``s`` with the four characters on either side of it."""
    on = ["bias"]
    on += ["inside left"] * before[-1:].isalnum() + ["inside right"] * after[:1].isalnum()
    left, right = before.rstrip(" -.()+"), after.lstrip(" -.()")  # at most three signs between
    on += ["number left"] * (left[-1:] in "0123456789" and left != "")
    on += ["number right"] * (right[:1] in "0123456789" and right != "")
    if ats:
        local, _, domain = s.partition("@")
        on.append("at")
        on += ["local"] * bool(re.fullmatch(r"[\w.%+-]+", local))
        on += ["domain"] * bool(re.fullmatch(r"[\w-]+(\.[\w-]+)+", domain))
        on += ["tld"] * bool(re.search(r"\.[^\W\d_]{2,}$", domain))
    else:
        groups = re.findall("[0-9]+", s)
        signs = set(re.sub(r"\w", "", s))
        on += ["plus"] * (s[0] == "+") + ["open"] * (s[0] == "(") + ["area"] * bool(re.search(r"\([0-9]{2,4}\)", s))
        on += ["octets"] * bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", s) and all(_small(g) for g in groups))
        on += ["fours"] * (len(groups) > 2 and all(len(g) == 4 for g in groups))
        if 14 <= digits <= 19:
            on.append("luhn" if luhn("".join(groups)) else "no luhn")
        on += ["letters"] * bool(re.search(r"[^\W\d_]|_", s)) + ["other signs"] * bool(signs - set(" .-()+"))
        for low, high in ((7, 9), (10, 11), (12, 13), (14, 16), (17, 19)):
            on += [f"digits {low}-{high}"] * (low <= digits <= high)
        on.append(("one group", "two groups", "three groups", "four groups", "more groups")[min(len(groups), 5) - 1])
        kinds = [n for n, c in (("blanks", " "), ("hyphens", "-"), ("dots", ".")) if c in signs]
        on += kinds + ["mixed"] * (len(kinds) > 1)
    on += ["ends in a digit"] * (s[-1] in "0123456789")
    return tuple(NUMBER[n] for n in on)


class Field:
    """Weights per kind and feature, and per pair of neighbouring labels (0 is outside, a single unit)."""

    def __init__(self):
        self.weights = np.zeros((len(KINDS), len(NAMES)))
        self.weights[:, 0] = -4.0
        self.follow = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def _scored(self, region: str):
        units = units_of(region)
        found = segments(region, units)
        known: dict[tuple, np.ndarray] = {}
        for _, _, f in found:
            if f not in known:
                known[f] = self.weights[:, list(f)].sum(axis=1)
        return units, found, [known[f] for _, _, f in found]

    def decode(self, region: str) -> list[tuple[int, int, int]]:
        """The best labelling's entities ``(start, kind, end)``."""
        units, found, scores = self._scored(region)
        if not found:
            return []
        n, y = len(units), len(KINDS) + 1
        ending: dict[int, list[int]] = {}
        for k, (_, j, _) in enumerate(found):
            ending.setdefault(j, []).append(k)
        best, back = np.full((n + 1, y), -np.inf), [[None] * y for _ in range(n + 1)]
        into, came = np.zeros((n + 1, y)), np.zeros((n + 1, y), dtype=int)
        best[0, 0] = 0
        for j in range(n + 1):
            if j:
                best[j, 0], back[j][0] = into[j - 1, 0], (j - 1, came[j - 1, 0])
                for k in ending.get(j, ()):
                    i = found[k][0]
                    for kind in range(1, y):
                        s = into[i, kind] + scores[k][kind - 1]
                        if s > best[j, kind]:
                            best[j, kind], back[j][kind] = s, (i, came[i, kind])
            steps = best[j][:, None] + self.follow
            came[j], into[j] = steps.argmax(axis=0), steps.max(axis=0)
        out, j, label = [], n, int(best[n].argmax())
        while j:
            i, before = back[j][label]
            if label:
                out.append((units[i][0], label - 1, units[j - 1][1]))
            j, label = i, int(before)
        return out[::-1]

    def gradient(self, region: str, truth: list[tuple[int, int, int]]):
        """Log likelihood of the true entities and its gradient by forward and backward sums."""
        units, found, scores = self._scored(region)
        n, y = len(units), len(KINDS) + 1
        alpha, beta = np.full((n + 1, y), -np.inf), np.full((n + 1, y), -np.inf)
        alpha[0, 0], beta[n] = 0, 0
        into = np.full((n + 1, y), -np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            ends: dict[int, list[int]] = {}
            starts: dict[int, list[int]] = {}
            for k, (i, j, _) in enumerate(found):
                ends.setdefault(j, []).append(k)
                starts.setdefault(i, []).append(k)
            for j in range(n + 1):
                if j:
                    alpha[j, 0] = into[j - 1, 0]
                    if j in ends:
                        alpha[j, 1:] = np.logaddexp.reduce([into[found[k][0], 1:] + scores[k] for k in ends[j]], axis=0)
                into[j] = np.logaddexp.reduce(alpha[j][:, None] + self.follow, axis=0)
            out = np.full((n + 1, y), -np.inf)  # what follows position i when the next label is y
            for i in range(n - 1, -1, -1):
                out[i, 0] = beta[i + 1, 0]
                if i in starts:
                    out[i, 1:] = np.logaddexp.reduce([scores[k] + beta[found[k][1], 1:] for k in starts[i]], axis=0)
                beta[i] = np.logaddexp.reduce(self.follow + out[i][None, :], axis=1)
            whole = np.logaddexp.reduce(alpha[n])
            g, t = np.zeros_like(self.weights), np.zeros_like(self.follow)
            value = -whole
            for k, (i, j, f) in enumerate(found):
                p = np.exp(into[i, 1:] + scores[k] + beta[j, 1:] - whole)
                for x in f:
                    g[:, x] -= p
            for i in range(n):
                t -= np.exp(alpha[i][:, None] + self.follow + out[i][None, :] - whole)
        where = {(units[i][0], units[j - 1][1]): k for k, (i, j, _) in enumerate(found)}
        at, before = 0, 0
        for start, kind, end in sorted(truth):
            k = where.get((start, end))
            if k is None:  # longer than a segment may be: no example
                return None
            i, j, f = found[k]
            while at < i:
                value += self.follow[before, 0]
                t[before, 0] += 1
                before, at = 0, at + 1
            value += self.follow[before, kind + 1] + scores[k][kind]
            t[before, kind + 1] += 1
            g[kind, list(f)] += 1
            before, at = kind + 1, j
        while at < n:
            value += self.follow[before, 0]
            t[before, 0] += 1
            before, at = 0, at + 1
        return value, g, t


def variants(region: str, truth: list[tuple[int, int, int]]) -> list[tuple[str, list]]:
    """Other ways to write a region's only entity: a phone number without its plus sign and country, or
    with dots; a card number in groups set apart by dots."""
    if len(truth) != 1:
        return []
    start, kind, end = truth[0]
    span, out = region[start:end], []
    if kind == 3 and re.match(r"\+[0-9]+ ", span):
        rest = span.partition(" ")[2]
        out = [rest, rest.replace("(", "").replace(") ", "-"), rest.replace("(", "").replace(") ", ".").replace("-", ".")]
    elif kind == 2 and span.isdigit() and len(span) == 16:
        out = [".".join(span[i:i + 4] for i in range(0, 16, 4))]
    return [(region[:start] + s + region[end:], [(start, kind, start + len(s))]) for s in out]


def regions(text: str) -> list[tuple[int, str]]:
    """The stretches of words with digits or at-signs, one or two blanks apart, with their places."""
    out: list[list[int]] = []
    for m in WORD.finditer(text):
        if MARK.search(text, m.start(), m.end()):
            if out and text[out[-1][1]:m.start()] in GAPS:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
    return [(a, text[a:b]) for a, b in out]


def _examples(text: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    rules, out = rule_spans(text), []
    for at, region in regions(text):
        if len(region) <= 200:
            inside = [(s - at, k, e - at) for s, k, e in rules if at <= s and e <= at + len(region)]
            if all(a[2] <= b[0] for a, b in zip(inside, inside[1:])):
                out.append((region, inside))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 12) -> Field:
    """A field fitted on at most ``TRAINING_REGIONS`` different regions per kind (and as many without a
    span): those with the smallest hashes among all documents, however these are laid out; without
    examples it adds nothing."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches):
        seen: dict[int, dict[tuple, int]] = {k: {} for k in range(-1, len(KINDS))}

        def least(kind):
            return sorted((h, r, t) for (r, t), h in seen[kind].items())[:TRAINING_REGIONS]

        for batch in sliced(batches):
            hit = pc.match_substring_regex(batch.column("text"), SIGNAL)
            for text in batch.column("text").filter(hit).to_pylist():
                for region, truth in _examples(text):
                    kind, key = truth[0][1] if truth else -1, (region, repr(truth))
                    if key not in seen[kind]:
                        seen[kind][key] = xxh64_intdigest("\n".join(key)) >> 1
                        if len(seen[kind]) > 50 * TRAINING_REGIONS:
                            seen[kind] = {(r, t): h for h, r, t in least(kind)}
        flat = [(k, *found) for k in seen for found in least(k)]
        columns = list(zip(*flat)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.string(), pa.string()))],
                                         ["kind", "hash", "region", "truth"])

    found = rows.mapInArrow(run, "kind int, hash long, region string, truth string").distinct()
    for part in (F.pmod("hash", F.lit(256)), F.lit(0)):  # a few rows of every task: the least of each part, then of all
        first = Window.partitionBy("kind", part).orderBy("hash", "region", "truth")
        found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= TRAINING_REGIONS)
    chosen = found.orderBy("kind", "place").collect()
    examples = [(r.region, [tuple(t) for t in ast.literal_eval(r.truth)]) for r in chosen]
    return fit(examples, rounds)


def fit(examples: list[tuple[str, list]], rounds: int = 12, ridge: float = 1e-3) -> Field:
    """Full-batch Adam on the conditional log likelihood of the examples and their variants."""
    field = Field()
    examples = examples + [v for e in examples[::2] for v in variants(*e)]
    if not any(t for _, t in examples):
        field.weights[:, 0] = -50.0
        return field
    rng, params = np.random.default_rng(0), [field.weights, field.follow]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), 20):
            made = [m for m in (field.gradient(*examples[i]) for i in order[at:at + 20]) if m is not None]
            if not made:
                continue
            step += 1
            for p, a, b, g in zip(params, first, second, (sum(m[1] for m in made), sum(m[2] for m in made))):
                g = ridge * p - g / len(made)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= 0.1 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return field


def all_spans(text: str, field: Field) -> list[tuple[int, int, int, bool]]:
    """``(start, kind, end, by rule)``: the rules' spans, and the field's that touch none of them."""
    rules = rule_spans(text)
    taken, out, k = sorted((s, e) for s, _, e in rules), [(*r, True) for r in rules], 0
    high = 0
    for at, region in regions(text):
        for s, kind, e in field.decode(region) if len(region) > 6 else ():
            s, e = s + at, e + at
            while k < len(taken) and taken[k][0] < e:
                high = max(high, taken[k][1])
                k += 1
            if high <= s:
                out.append((s, kind, e, False))
    return sorted(out)


def find_spans(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans``: per row the spans (kind, start, end in code points, end exclusive, and whether a rule
    found it) in order of start, then kind.

    Edge cases: a null text counts as empty and has no spans; null and repeated ids are kept; an empty
    table gives an empty table.  Texts without digits and at-signs are passed over by a vectorised test.
    Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in sliced(batches):
            hits = pc.match_substring_regex(batch.column("text"), SIGNAL).to_pylist()
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "rule": r} for s, k, e, r in all_spans(t, shared.value)] if hit else []
                     for hit, t in zip(hits, batch.column("text").to_pylist())]
            kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("rule", pa.bool_())])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(kind))], ["id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SPAN_SCHEMA)


def redact(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in angle brackets (of overlapping
    spans, the one that starts first, and of those the longest).

    Edge cases: null texts stay null, null and repeated ids and repeated rows stay as they are (every row
    is returned once); an empty table gives an empty table; other columns pass through, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in sliced(batches, text_col, keep_nulls=True):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at)
            hits = pc.fill_null(pc.match_substring_regex(texts, SIGNAL), False).to_pylist()
            new = [redacted(t, shared.value) if hit else t for hit, t in zip(hits, texts.to_pylist())]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def redacted(text: str, field: Field) -> str:
    out, at = [], 0
    for s, kind, e, _ in sorted(all_spans(text, field), key=lambda x: (x[0], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind].upper()}>"]
            at = e
        elif e > at:  # the rest of an overlapping span goes too
            at = e
    return "".join([*out, text[at:]])
