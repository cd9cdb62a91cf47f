"""Secret scan: rules, and a linear-chain conditional random field that tags tokens as secret begin, inside, outside.

The rules (`RULES`) find leftmost non-overlapping matches per kind; their spans always stay. The random
field learns from them: of all documents the distinct segments of `SEGMENT` tokens around the rules' values,
and the distinct ones from texts without a value, the `FIT_SEGMENTS` of each with the least hash. Its
features are a token's shape and length, the words and shapes around it, and how much of the file is
digits and assignments. Segments are learned again with other values and other words around them, so that
the field also finds values that no rule names. Tags are decoded by Viterbi over the runs of tokens that are
not outside beyond doubt (`SURE`), with the steps from and to the tokens around them; a decoded span of `SHORTEST` characters or more that touches no span of the rules is added
as kind `crf`.

Positions are code points of the text, ends exclusive. NULL and empty texts have no spans; equal texts
have equal spans; a corpus without any match of the rules adds none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

# The kinds of the rules in order, their patterns, the group and the least length it must have.
RULES = (
    (
        "assign",
        re.compile(
            r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"
            r"|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
            r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KINDS = ("assign", "access", "hex", "crf")

SEGMENT, FIT_SEGMENTS, ROUNDS, COPIES = 32, 3_000, 100, 2
SURE, SHORTEST, CAUTION = 6.0, 8, 0.0
BEGIN, INSIDE, OUTSIDE = range(3)

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[*range(33), 127]] = True
_DIGIT, _UPPER, _LOWER, _HEX = np.zeros((4, 256), bool)
_DIGIT[48:58] = _UPPER[65:91] = _LOWER[97:123] = _HEX[48:58] = _HEX[97:103] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MARK = np.full(256, 11, np.int64)
for _i, _c in enumerate(b"=:\"'.,/+-@#"):
    _MARK[_c] = _i
_LENGTHS = np.array([2, 3, 6, 10, 16, 24, 40])
_TURNS = np.array([1, 2, 4, 8])
_HASHED, _SHAPES = 1 << 12, 24
#: Where the values of each feature begin in the table of weights.
_SIZES = (_SHAPES * 8, 5 * 8, _HASHED, _HASHED, _HASHED, _HASHED, _SHAPES * _SHAPES, 16)
_BEGINS = np.concatenate(([0], np.cumsum(_SIZES)[:-1]))
N_FEATURES, N_WEIGHTS = len(_SIZES), sum(_SIZES)
#: The features that are words nearby.
_WORDS = (2, 3, 4, 5)
#: That of the shapes before and after.
_BESIDE = 6

_SHORT_HEX = re.compile(r"[0-9a-f]{24,}")


def rule_matches(text: str) -> list[tuple[int, int, int, int, int]]:
    """Start, kind's place in KINDS, end, and the span of the value, by start and kind; failing matches are dropped."""
    out = []
    for kind, (_, pattern, group, least) in enumerate(RULES):
        if kind == 0 and ":" not in text and "=" not in text or kind == 1 and "AKIA" not in text:
            continue
        # a run of hexadecimal digits is one match, so only the long ones need to be looked at
        found = _SHORT_HEX.finditer(text) if kind == 2 else pattern.finditer(text)
        for m in found:
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end(), m.start(group), m.end(group)))
    return sorted(out)


def _between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends] - total[starts]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the tokens, and the documents' offsets: words with digits and underscores, single marks."""
    word, border = _ALNUM[data], np.zeros(len(data) + 1, bool)
    border[offsets] = True
    mark = ~word & ~_SPACE[data]
    begins = mark | (word & ~(np.concatenate(([False], word[:-1])) & ~border[:-1]))
    stops = mark | (word & ~(np.concatenate((word[1:], [False])) & ~border[1:]))
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each token the places of its features in the table of weights."""
    n, length = len(starts), ends - starts
    digit, upper, lower, hexes = (_between(c[data], starts, ends) for c in (_DIGIT, _UPPER, _LOWER, _HEX))
    first = data[starts]
    turn = _DIGIT[data[1:]] != _DIGIT[data[:-1]]
    turns = _between(turn, starts, ends - 1)
    beyond = _between(data >= 128, starts, ends)
    shape = np.select(
        [
            ~_ALNUM[first],
            beyond > 0,
            lower == length,
            upper == length,
            (upper == 1) & _UPPER[first] & (lower == length - 1),
            digit == length,
            (hexes == length) & (digit > 0),
            (digit > 0) & (lower > 0) & (upper == 0),
            (digit > 0) & (upper > 0) & (lower == 0),
            (digit > 0) & (upper > 0),
            (upper > 0) & (lower > 0),
        ],
        [_MARK[first], 21, 12, 13, 14, 15, 16, 17, 18, 19, 20],
        22,
    )
    size = np.searchsorted(_LENGTHS, length, "right")
    prefix = common.prefix_hashes(_FOLD[data])
    word = (common.span_hashes(prefix, starts, ends) >> np.uint64(52)).astype(np.int64) | 1
    doc = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    low, high = firsts[:-1][doc], firsts[1:][doc]
    at = np.arange(n)

    def near(values: np.ndarray, step: int, none: int) -> np.ndarray:
        to = at + step
        return np.where((to >= low) & (to < high), values[np.clip(to, 0, n - 1)], none)

    per_doc = np.maximum(np.diff(firsts), 1)
    shares = [np.add.reduceat(np.append(v, 0), np.minimum(firsts[:-1], n)) * (np.diff(firsts) > 0) / per_doc for v in ((shape == 0).astype(int), (digit > 0).astype(int))]
    file = sum(np.searchsorted([0.002, 0.01, 0.05], s, "right") * 4**k for k, s in enumerate(shares))
    columns = [
        shape * 8 + size,
        np.searchsorted(_TURNS, turns, "right") * 8 + size,
        near(word, -1, 0),
        near(word, -2, 0),
        near(word, -3, 0),
        near(word, 1, 0),
        near(shape, -1, 23) * _SHAPES + near(shape, 1, 23),
        file[doc],
    ]
    return np.column_stack(columns) + _BEGINS


class Field:
    """Weights of the features for each tag, and of the steps from tag to tag."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def decode(self, emissions: np.ndarray, before: bool = False, after: bool = False) -> list[int]:
        """The best tags of one run of tokens by Viterbi; inside follows begin or inside only. `before` and
        `after` tell whether tokens that are outside stand there."""
        score, back = emissions[0] + [0, -np.inf, 0], []
        if before:
            score = score + self.steps[OUTSIDE]
        for e in emissions[1:]:
            all_ = score[:, None] + self.steps
            back.append(all_.argmax(axis=0))
            score = all_.max(axis=0) + e
        if after:
            score = score + self.steps[:, OUTSIDE]
        tags = [int(score.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]

    def spans(self, places: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int]]:
        """First and last token of each secret."""
        emissions = self.weights[places].sum(axis=1)
        emissions[:, OUTSIDE] += CAUTION
        open_ = emissions[:, OUTSIDE] - emissions[:, :OUTSIDE].max(axis=1) < SURE
        out = []
        borders = set(firsts.tolist())
        for a, b in zip(*(x.tolist() for x in common.runs(open_, firsts)), strict=True):
            tags = self.decode(emissions[a:b], a not in borders, b not in borders)
            begin = None
            for i, tag in enumerate([*tags, OUTSIDE]):
                if begin is not None and tag != INSIDE:
                    out.append((a + begin, a + i - 1))
                    begin = None
                if tag == BEGIN:
                    begin = i
        return out


def train(places: np.ndarray, tags: np.ndarray, mask: np.ndarray, rounds: int = ROUNDS, rate: float = 0.1, ridge: float = 1e-3) -> Field:
    """Likeliest weights for segments of equal length (padded where mask is 0), by gradient steps."""
    n, length = tags.shape
    weights, steps = np.zeros((N_WEIGHTS, 3)), np.zeros((3, 3))
    forbidden = np.zeros((3, 3))
    forbidden[OUTSIDE, INSIDE] = -1e4
    start = np.array([0, -1e4, 0])
    wanted = np.eye(3)[tags] * mask[..., None]
    wanted_steps = np.einsum("nti,ntj->ij", wanted[:, :-1], wanted[:, 1:])
    moments = [np.zeros_like(x) for x in (weights, weights, steps, steps)]

    def norm(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)

    flat = places.reshape(-1, N_FEATURES)
    for r in range(1, rounds + 1):
        e, t = weights[flat].sum(axis=1).reshape(n, length, 3), steps + forbidden
        forth, back = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        forth[:, 0] = e[:, 0] + start
        for i in range(1, length):
            new = norm(forth[:, i - 1, :, None] + t, 1) + e[:, i]
            forth[:, i] = np.where(mask[:, i, None] > 0, new, forth[:, i - 1])
        for i in range(length - 2, -1, -1):
            new = norm(t + (e[:, i + 1] + back[:, i + 1])[:, None, :], 2)
            back[:, i] = np.where(mask[:, i + 1, None] > 0, new, back[:, i + 1])
        total = norm(forth[:, -1], 1)
        p = np.exp(forth + back - total[:, None, None]) * mask[..., None]
        pair = forth[:, :-1, :, None] + t + (e[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pair = np.exp(pair) * mask[:, 1:, None, None]
        slope, slopes = ((wanted - p) / n).reshape(-1, 3), (wanted_steps - pair.sum(axis=(0, 1))) / n
        grad = np.zeros_like(weights)
        for f in range(N_FEATURES):
            for tag in range(3):
                grad[:, tag] += np.bincount(flat[:, f], slope[:, tag], N_WEIGHTS)
        for x, g, k in ((weights, grad - ridge * weights / 10, 0), (steps, slopes - ridge * steps / 10, 2)):
            moments[k] = 0.9 * moments[k] + 0.1 * g
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * g * g
            x += rate * (moments[k] / (1 - 0.9**r)) / (np.sqrt(moments[k + 1] / (1 - 0.99**r)) + 1e-6)
    return Field(weights, steps + forbidden)


class _Least:
    """The distinct segments with the least keys, `most` of them."""

    def __init__(self, most: int):
        self.most, self.bound, self.rows = most, 1 << 63, {}

    def add(self, places: np.ndarray, tags: np.ndarray) -> None:
        places, tags = places.astype(np.int32), tags.astype(np.int32)
        key = int.from_bytes(blake2b(places.tobytes() + tags.tobytes(), digest_size=8).digest(), "little", signed=True)
        if key < self.bound:
            self.rows[key] = places, tags
            if len(self.rows) > 2 * self.most:
                self.cut()

    def cut(self) -> None:
        kept = sorted(self.rows)[: self.most]
        if len(kept) == self.most and kept:
            self.bound = kept[-1]
        self.rows = {k: self.rows[k] for k in kept}


def _examples(most: int):
    """Segments around the values of the rules, and one from each text without any: of a task's distinct ones of
    either sort the `most` with the least keys, among which are its own of the least over all tasks."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {True: _Least(most), False: _Least(most)}
        for part in common.slices(batches):
            _add_examples(part, least)
        for secret, own in least.items():
            own.cut()
            for keys in np.array_split(np.array(list(own.rows), np.int64), -(-len(own.rows) // 1000) or 1):
                rows = [own.rows[k] for k in keys.tolist()]
                columns = [pa.array([secret] * len(rows), pa.bool_()), pa.array(keys)]
                columns += [pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["secret", "key", "places", "tags"])

    return of


def _add_examples(part: pa.RecordBatch, least: dict[bool, _Least]) -> None:
    data, offsets = common.utf8(part.column("text"))
    starts, ends, firsts = tokens(data, offsets)
    if not len(starts):
        return
    places = features(data, starts, ends, firsts)
    for i, text in enumerate(part.column("text").to_pylist()):
        a, b = int(firsts[i]), int(firsts[i + 1])
        if a == b:
            continue
        tags = np.full(b - a, OUTSIDE)
        raw = data[offsets[i] : offsets[i + 1]]
        found = rule_matches(text)
        if found and not text.isascii():
            chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # the bytes where characters begin
        for *_, value, end in found:
            low, high = (value, end) if text.isascii() else chars[[value, end]]
            first = int(np.searchsorted(starts[a:b], offsets[i] + low))
            last = int(np.searchsorted(ends[a:b], offsets[i] + high, "right"))
            if first < last:
                tags[first:last] = INSIDE
                tags[first] = BEGIN
        begins = np.flatnonzero(tags == BEGIN)
        middles = begins if len(begins) else [] if found else [int(raw.astype(np.int64).sum()) * 7919 % (b - a)]
        for m in middles:
            low = max(0, min(int(m) - SEGMENT // 2, b - a - SEGMENT))
            high = min(low + SEGMENT, b - a)
            own = tags[low:high].copy()
            if own[0] == INSIDE:
                own[0] = BEGIN
            least[bool(len(begins))].add(places[a + low : a + high].ravel(), own)


def fit(docs: DataFrame, fit_segments: int = FIT_SEGMENTS) -> Field | None:
    """The random field learned from the rules' matches; None where there are none."""
    # 2 * fit_segments rows at most, in one task: the driver gets the weights alone
    learned = examples(docs, fit_segments).repartition(1).mapInArrow(_trained, "weights binary, steps binary").collect()
    if not learned:
        return None
    return Field(np.frombuffer(learned[0]["weights"]).reshape(N_WEIGHTS, 3), np.frombuffer(learned[0]["steps"]).reshape(3, 3))


def examples(docs: DataFrame, fit_segments: int = FIT_SEGMENTS) -> DataFrame:
    """The distinct segments with and without a value that have the least keys, `fit_segments` of each."""
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_examples(fit_segments), "secret boolean, key long, places array<int>, tags array<int>")
    found = common.staged(found.dropDuplicates(["secret", "key"]))
    kinds = [found.filter(kind).orderBy("key").limit(fit_segments) for kind in ("secret", "not secret")]
    return kinds[0].union(kinds[1])


def padded(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, tags and mask of segments, by kind and key, at the same length."""
    rows = rows.sort_by([("secret", "descending"), ("key", "ascending")])
    n, (own, marks) = rows.num_rows, (rows.column(c).combine_chunks() for c in ("places", "tags"))
    places = np.zeros((n, SEGMENT, N_FEATURES), np.int64) + _BEGINS
    tags, mask = np.full((n, SEGMENT), OUTSIDE), np.zeros((n, SEGMENT))
    for i in range(n):
        tag = marks[i].values.to_numpy()
        places[i, : len(tag)] = own[i].values.to_numpy().reshape(len(tag), N_FEATURES)
        tags[i, : len(tag)], mask[i, : len(tag)] = tag, 1
    return places, tags, mask


def _random_values(random: np.random.Generator, n: int = 2_000) -> np.ndarray:
    """The features of shape and of turns between digits and letters of n random strings over usual alphabets."""
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = (digits + lower, digits + upper, digits + lower + upper, digits + "abcdef", digits + lower + upper + "_")
    tokens_ = ["".join(random.choice(list(alphabets[i % len(alphabets)]), random.integers(12, 49))) for i in range(n)]
    data, offsets = common.utf8(pa.array(tokens_, pa.string()))
    return features(data, offsets[:-1], offsets[1:], np.arange(n + 1))[:, :2]


def moved(places: np.ndarray, tags: np.ndarray, mask: np.ndarray, copies: int = COPIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments, and copies of those with a value in which other words stand around another random value,
    every second time between other shapes, too.

    So the field has to tell values by their shape and the marks beside them, too: learned from the rules'
    matches alone it would look for the rules' keywords and the corpus's kinds of values, and find what the
    rules find."""
    secret = np.flatnonzero((tags == BEGIN).any(axis=1))
    random = np.random.Generator(np.random.PCG64(11))
    every, shapes = [(places, tags, mask)], _random_values(random)
    for copy in range(copies):
        new = places[secret].copy()
        value = tags[secret] != OUTSIDE
        words = value & (new[..., 0] >= _BEGINS[0] + 12 * 8)  # tokens of letters and digits
        drawn = shapes[random.integers(0, len(shapes), value.shape)]
        new[..., :2] = np.where(words[..., None], drawn, new[..., :2])
        for c in _WORDS:
            other = random.integers(0, _HASHED // 2, value.shape) * 2 + 1 + _BEGINS[c]
            new[..., c] = np.where(value, other, new[..., c])
        if copy % 2:  # between words, or whatever marks
            beside = np.array([12, 14, 15, *range(11), 23])[random.integers(0, 15, (2, *value.shape))]
            new[..., _BESIDE] = np.where(value, beside[0] * _SHAPES + beside[1] + _BEGINS[_BESIDE], new[..., _BESIDE])
        every.append((new, tags[secret], mask[secret]))
    return tuple(np.concatenate(x) for x in zip(*every, strict=True))


def _trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The field of the segments, one row; none if no segment has a secret."""
    batches = list(batches)
    if not any(b.num_rows for b in batches):
        return
    places, tags, mask = padded(pa.Table.from_batches(batches))
    if not (tags == BEGIN).any():
        return
    field = train(*moved(places, tags, mask))
    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (field.weights, field.steps)], ["weights", "steps"])


def spans_of(column: pa.Array, field: Field | None) -> list[list[tuple[int, int, int]]]:
    """For each text the spans of rules and field: start, kind's place in KINDS, end; by start, then kind."""
    texts = [t or "" for t in column.to_pylist()]
    out = [[m[:3] for m in rule_matches(t)] for t in texts]
    if field is None:
        return out
    data, offsets = common.utf8(column)
    starts, ends, firsts = tokens(data, offsets)
    if not len(starts):
        return out
    for first, last in field.spans(features(data, starts, ends, firsts), firsts):
        i = int(np.searchsorted(firsts, first, "right")) - 1
        low, high = int(starts[first] - offsets[i]), int(ends[last] - offsets[i])
        if not texts[i].isascii():
            raw = data[offsets[i] : offsets[i + 1]]
            low, high = (int(((raw[:x] & 0xC0) != 0x80).sum()) for x in (low, high))
        if high - low >= SHORTEST and all(e <= low or s >= high for s, k, e in out[i] if k < 3):
            out[i].append((low, 3, high))
    return [sorted(spans) for spans in out]


def redacted_text(text: str, spans: list[tuple[int, int, int]], put: str) -> str:
    """The text with each maximal run of overlapping spans replaced."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], put]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scanned(docs: DataFrame, field: Field | None) -> DataFrame:
    """The documents with `secrets`: kind, start and end of each span, by start and then by order of KINDS."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<kind: string, start: long, end: long>>")
    def of(text: pa.Array) -> pa.Array:
        out = []
        for part in common.slices([pa.RecordBatch.from_arrays([text], ["text"])]):
            out += [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in spans_of(part.column(0), field)]
        return pa.array(out, kind)

    return docs.withColumn("secrets", of(F.col("text").cast("string")))


def redacted(docs: DataFrame, field: Field | None, put: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by `put` in `text`, and `n_chars` counted anew where it changed."""

    @F.arrow_udf("string")
    def of(text: pa.Array) -> pa.Array:
        out = []
        for part in common.slices([pa.RecordBatch.from_arrays([text], ["text"])]):
            for own, spans in zip(part.column(0).to_pylist(), spans_of(part.column(0), field), strict=True):
                out.append(redacted_text(own, spans, put) if spans else own)
        return pa.array(out, pa.string())

    name = common.fresh(docs, "_redacted")
    new = docs.withColumn(name, of(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        changed = ~F.col(name).eqNullSafe(F.col("text"))
        count = F.when(changed, F.length(name)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        new = new.withColumn("n_chars", count)
    return new.withColumn("text", F.col(name)).select(docs.columns)
