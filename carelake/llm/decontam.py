"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks.

* Terms are words, hashed to `TERMS` places. Document frequencies are counted over all documents.
* A randomised SVD gives the latent space: the TF-IDF passages of all documents (`FIT_DOCUMENTS` can bound
  them) and of all benchmark items are multiplied with a random matrix and back, in tasks whose sums
  Spark adds up by term; the orthonormal basis of the result has `RANK` directions. The benchmark, whose
  items must stay apart there, weighs `FAVOUR` times as much as the corpus.
* Every document is cut into windows, one each `STRIDE` words. For a benchmark segment (an item, or about
  `SEGMENT` words of a long one) of n words a window has `WINDOW` words and n more on either side, so that
  also a paraphrase with words put in lies inside one. Both are candidates if their product in the latent
  space is at least `LATENT` of what a window that contains the whole segment would have, and their product
  over all terms at least `NEAR` of it. `LATENT` is lower: what RANK directions leave out blurs that product.
* A candidate is a leak if the longest common subsequence of words covers `EXACT` of the segment, or
  `PARAPHRASE` of it and the item's answer, its last words, stands there word for word.
* Items of fewer than `LEAST` words are found where all their words stand in a row.

The benchmark is taken in blocks of about `BLOCK` segments, each searched against all documents; what is
broadcast is one block, its latent vectors and the basis. Defined results: NULL, empty and wordless texts
leak nothing, and items without a word are in no text. `found` has one row for each doc_id and item, NULL
ids being one id: rows that share an id share the longest match. `clean` judges every row by its own text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

TERMS, RANK = 1 << 14, 64
WINDOW, STRIDE, SEGMENT = 48, 16, 64
LATENT, NEAR, EXACT, PARAPHRASE, ANSWER, LEAST = 0.25, 0.45, 0.8, 0.6, 6, 5
#: How much more the benchmark weighs than the corpus in the choice of the latent space.
FAVOUR = 4.0
#: None: the space is learned from all documents; a number: from so many distinct texts.
FIT_DOCUMENTS: int | None = None
FIT_PARTITIONS, BLOCK = 8, 4096
_AT_ONCE = 1 << 18  # words that are sorted by their term at a time
_GROUPS, _PIECE = 1 << 10, 32  # groups that are summed at a time; words of a term in a group
_SEGMENTS = 512  # segments that are compared at a time
_CELLS = 1 << 17  # sums of blocks and segments that are added to at a time


def terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - int(math.log2(TERMS)))).astype(np.int64)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TERMS + 1, np.int64)
    for part in common.slices(batches):
        hashes, firsts = common.word_hashes(part.column("text"))
        doc = np.repeat(np.arange(part.num_rows), np.diff(firsts))
        total[:TERMS] += np.bincount(np.unique(doc * TERMS + terms(hashes)) % TERMS, minlength=TERMS)
        total[TERMS] += part.num_rows
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "n"])


def _passages(firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the blocks of `width` words, their documents, and the documents' offsets in blocks."""
    counts = -(-np.diff(firsts) // width)
    at = np.concatenate(([0], np.cumsum(counts)))
    doc = np.repeat(np.arange(len(counts)), counts)
    return firsts[:-1][doc] + (np.arange(len(doc)) - at[:-1][doc]) * width, doc, at


def _group_sums(rows: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each group the sum of the rows that `at` names from its start to its end. The first of all groups are
    added at once, then the second, and so on: whole rows, where `reduceat` steps through each column by itself."""
    out = np.zeros((len(starts), rows.shape[1]), rows.dtype)
    longest = np.argsort(starts - ends, kind="stable")  # the groups that go on are always the first ones
    for a in range(0, len(starts), _GROUPS):
        own = longest[a : a + _GROUPS]
        place, size = starts[own], (ends - starts)[own]
        sums = np.zeros((len(own), rows.shape[1]), rows.dtype)
        for j in range(int(size[0])):
            n = int(np.searchsorted(-size, -j, "left"))
            sums[:n] += rows.take(at[place[:n] + j], axis=0)
        out[own] = sums
    return out


def _products(idf: np.ndarray, random: np.ndarray):
    """The transposed passages times (passages times the random matrix), by term."""
    weighted = random * idf[:, None]

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((TERMS, random.shape[1])), False
        for part in common.slices(batches):
            hashes, firsts = common.word_hashes(part.column("text"))
            if not len(hashes):
                continue
            term, seen = terms(hashes), True
            starts, _, _ = _passages(firsts, WINDOW)
            sums = _group_sums(weighted, term, starts, np.append(starts[1:], len(term)))
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(term))))
            for a in range(0, len(term), _AT_ONCE):
                order = np.argsort(term[a : a + _AT_ONCE].astype(np.uint16), kind="stable")
                own, first = np.unique(term[a + order], return_index=True)
                pieces, of_term, _ = _passages(np.append(first, len(order)), _PIECE)
                parts = _group_sums(sums, passage[a + order], pieces, np.append(pieces[1:], len(order)))
                total[own] += np.add.reduceat(parts, np.searchsorted(of_term, np.arange(len(own)))) * idf[own, None]
        if seen:
            rows = [r.tobytes() for r in total.astype(np.float32)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS)), pa.array(rows, pa.binary())], ["term", "y"])

    return of


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in common.key_groups(batches, ["term"]):
        y = np.frombuffer(b"".join(rows.column("y").to_pylist()), np.float32).reshape(rows.num_rows, -1)
        term, first = np.unique(rows.column("term").to_numpy(), return_index=True)
        sums = [r.tobytes() for r in np.add.reduceat(y, first)]
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(sums, pa.binary())], ["term", "y"])


def _product(docs: DataFrame, idf: np.ndarray, random: np.ndarray) -> np.ndarray:
    parts = docs.mapInArrow(_products(idf, random), "term long, y binary").repartition("term").sortWithinPartitions("term")
    out = np.zeros((TERMS, random.shape[1]))
    for row in parts.mapInArrow(_added, "term long, y binary").collect():  # TERMS rows at most
        out[row["term"]] = np.frombuffer(row["y"], np.float32)
    size = np.linalg.norm(out)
    return out / size if size else out


@dataclass(frozen=True)
class Space:
    """Weights of the terms and the latent vectors of the weighted terms."""

    idf: np.ndarray
    vectors: np.ndarray


def fit(docs: DataFrame, benchmark: DataFrame) -> Space:
    texts = docs.select(F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS + 1)
    counts[[r["term"] for r in found]] = [r["n"] for r in found]
    idf = np.log((2 + counts[-1]) / (1 + counts[:-1])).astype(np.float32)  # never 0, not even for a word of all documents
    random = np.random.Generator(np.random.PCG64(7)).standard_normal((TERMS, RANK)).astype(np.float32)
    corpus = _product(texts if FIT_DOCUMENTS is None else sample(texts).repartition(FIT_PARTITIONS), idf, random)
    items = _product(benchmark.select(F.col("text").cast("string").alias("text")).repartition(FIT_PARTITIONS), idf, random)
    basis, _ = np.linalg.qr(corpus + FAVOUR * items)
    return Space(idf, (basis * idf[:, None]).astype(np.float32))


def sample(texts: DataFrame, most: int | None = None) -> DataFrame:
    """The distinct texts with the least hashes, `most` of them, or all; copies count once before any is chosen."""
    most = FIT_DOCUMENTS if most is None else most
    if most is None:
        return texts.filter("text IS NOT NULL").distinct()
    order = F.xxhash64(F.lit(7), "text")
    hashes = texts.filter("text IS NOT NULL").select(order.alias("h")).distinct()
    last = hashes.orderBy("h").limit(most).agg(F.max("h")).first()[0]
    chosen = texts.filter("text IS NOT NULL").withColumn("h", order).filter(F.col("h") <= F.lit(last).cast("long"))
    return chosen.groupBy("h").agg(F.first("text").alias("text")).select("text")


@dataclass(frozen=True)
class Segments:
    """A block of the benchmark: words and item of each segment, and the last words of the item or None."""

    words: list[list[int]]
    item: list[int]
    answer: list[list[int] | None]
    item_ids: list


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches):
        hashes, firsts = common.word_hashes(part.column("text"))
        ids, out = part.column("item_id"), {"at": [], "words": [], "answer": []}
        for i in range(part.num_rows):
            own = hashes[firsts[i] : firsts[i + 1]].view(np.int64)
            if len(own):
                pieces = np.array_split(own, -(-len(own) // SEGMENT))
                out["at"] += [i] * len(pieces)
                out["words"] += pieces
                out["answer"] += [None] * (len(pieces) - 1) + [own[-min(ANSWER, max(1, len(own) // 2)) :]]
        columns = [ids.take(pa.array(out["at"], pa.int64()))]
        columns += [pa.array(out[c], pa.list_(pa.int64())) for c in ("words", "answer")]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "answer"])


def blocks(benchmark: DataFrame) -> Iterator[Segments]:
    """The benchmark's segments in blocks of about BLOCK."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    cut = common.staged(items.mapInArrow(_segments, f"item_id {kind}, words array<long>, answer array<long>"))
    n = math.ceil(cut.count() / BLOCK)
    for b in range(n):
        rows = cut.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == b).sort("item_id", "words").collect()
        ids = list(dict.fromkeys(r["item_id"] for r in rows))
        at = {x: i for i, x in enumerate(ids)}
        yield Segments([r["words"] for r in rows], [at[r["item_id"]] for r in rows], [r["answer"] for r in rows], ids)


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence of a text and the n words whose places the masks hold."""
    full = (1 << n) - 1
    v = full
    for w in words:
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def contains(words: list[int], piece: list[int]) -> bool:
    n = len(piece)
    return any(words[i : i + n] == piece for i in range(len(words) - n + 1) if words[i] == piece[0])


def _once(term: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The terms; those that stand before among the same WINDOW words of their document are TERMS."""
    starts, _, _ = _passages(firsts, WINDOW)
    key = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(term)))) * TERMS + term
    out = np.full(len(term), TERMS)
    first = np.unique(key, return_index=True)[1]
    out[first] = term[first]
    return out


def _side_by_side(term: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The words of each block of STRIDE, filled up with a word of no weight."""
    at = starts[:, None] + np.arange(STRIDE)
    return np.where(at < np.append(starts[1:], len(term))[:, None], term.take(at, mode="clip"), TERMS)


class Search:
    """Finds the leaks of one block of segments in texts; made once in each task."""

    def __init__(self, space: Space, segments: Segments):
        self.space, self.segments = space, segments
        self.masks: list[dict[int, int]] = []
        queries = np.zeros((len(segments.words), RANK), np.float32)
        for i, words in enumerate(segments.words):
            masks: dict[int, int] = {}
            for j, w in enumerate(words):
                masks[w] = masks.get(w, 0) | 1 << j
            self.masks.append(masks)
            queries[i] = space.vectors[np.unique(terms(np.array(words).view(np.uint64)))].sum(axis=0)
        # a window that holds the segment has at least the segment's own square as its product with it
        self.queries = (queries / np.maximum((queries**2).sum(axis=1, keepdims=True), 1e-12)).T.copy()
        # one bit for each term that a segment has
        has = np.zeros((len(segments.words), TERMS), bool)
        for i, words in enumerate(segments.words):
            has[i, terms(np.array(words).view(np.uint64))] = True
        self.vectors = np.vstack([space.vectors, np.zeros((1, RANK), np.float32)])
        self.weights = space.idf**2
        self.least = np.array([NEAR * self.weights[h].sum() for h in has])
        self.has = np.packbits(has, axis=1, bitorder="little")
        # the weights in bytes, rounded up: what falls short with them falls short with the weights
        unit = max(float(self.weights.max()), 1e-30) / 255
        self.coarse = np.zeros((TERMS + 1, len(has)), np.uint8)
        self.coarse[:TERMS] = (has * np.ceil(self.weights / unit).clip(1, 255)).T
        self.coarse_least = np.floor(self.least / unit * (1 - 1e-5))
        # segments by the strides that their windows reach beyond WINDOW; a match has so many words at least
        self.sizes = np.array([len(words) for words in segments.words], np.int64)
        strides = -(-self.sizes // (2 * STRIDE)) * 2
        long = self.sizes >= LEAST
        every = [(int(k), np.flatnonzero(long & (strides == k))) for k in np.unique(strides[long])]
        self.reaches = [(k, own[a : a + _SEGMENTS]) for k, own in every for a in range(0, len(own), _SEGMENTS)]
        # short ones by the hash of all their words
        self.short: dict[int, dict[int, list[int]]] = {}
        for i in np.flatnonzero(~long).tolist():
            words = np.array(segments.words[i]).view(np.uint64)
            key = int(common.shingles(words, np.array([0, len(words)]), len(words))[0][0])
            self.short.setdefault(len(words), {}).setdefault(key, []).append(i)
        self.fewest = np.maximum(PARAPHRASE * self.sizes, LEAST)

    def candidates(self, term: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, ...]:
        """First words of the windows, their documents and segments."""
        starts, doc, at = _passages(firsts, STRIDE)
        sums = np.zeros((len(starts) + 1, RANK))
        words = _side_by_side(_once(term, firsts), starts)
        for a in range(0, len(starts), 1 << 11):
            sums[a + 1 : a + 1 + (1 << 11)] = self.vectors[words[a : a + (1 << 11)]].sum(axis=1)
        np.cumsum(sums, axis=0, out=sums)
        first, last, place, n = at[:-1][doc], at[1:][doc], np.arange(len(doc)), WINDOW // STRIDE
        rows, cols = [], []
        term = term.astype(np.int32)
        for reach, own in self.reaches:
            sums_ = self.coarse_sums(term, starts, own, reach)
            low, high = np.maximum(place - reach, first), np.minimum(place + n + reach, last)
            queries = self.queries[:, own]
            step = max(1, (1 << 22) // len(own))
            for a in range(0, len(starts), step):
                windows = (sums[high[a : a + step]] - sums[low[a : a + step]]).astype(np.float32)
                r, c = np.nonzero(windows @ queries >= LATENT)
                r = r + a
                heavy = sums_[high[r], c] - sums_[low[r], c] >= self.coarse_least[own[c]]
                r, c = r[heavy], own[c[heavy]]
                for x, y in zip(np.array_split(r, len(r) // 1_000 + 1), np.array_split(c, len(r) // 1_000 + 1), strict=True):
                    near = self.near(term, starts[x], firsts[:-1][doc[x]], firsts[1:][doc[x]], y)
                    rows.append(x[near])
                    cols.append(y[near])
        if not rows:
            return (np.zeros(0, np.int64),) * 3
        row, col = np.concatenate(rows), np.concatenate(cols)
        return starts[row], doc[row], col

    def coarse_sums(self, term: np.ndarray, starts: np.ndarray, segments: np.ndarray, reach: int) -> np.ndarray:
        """Running sums over the blocks of words of the coarse weights that they share with the segments. They wrap
        around; the difference over a window doesn't, for its words fit the type."""
        most = (WINDOW + 2 * STRIDE * reach) * 255
        out = np.zeros((len(starts) + 1, len(segments)), np.promote_types(np.min_scalar_type(most), np.uint16))
        words = np.ascontiguousarray(_side_by_side(term, starts).T)
        coarse = self.coarse.take(segments, axis=1)  # whole rows; an index would lay them out column by column
        step = max(1, _CELLS // len(segments))
        for a in range(0, len(starts), step):
            own = out[a + 1 : a + 1 + step]
            for w in words[:, a : a + step]:
                own += coarse.take(w, axis=0)
        return np.cumsum(out, axis=0, out=out)

    def near(self, term: np.ndarray, start: np.ndarray, first: np.ndarray, end: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Whether the terms that window and segment share are enough and carry enough of the segment's weight."""
        if not len(start):
            return np.zeros(0, bool)
        n = self.sizes[segment]
        low, high = np.maximum(start - n, first), np.minimum(start + WINDOW + n, end)
        at = low[:, None] + np.arange(WINDOW + 2 * n.max())
        own = term.take(at, mode="clip")
        shared = self.has.take((segment * (TERMS // 8))[:, None] + (own >> 3)) >> (own & 7).astype(np.uint8) & 1
        shared &= at < high[:, None]
        enough = np.flatnonzero(shared.sum(axis=1, dtype=np.int32) >= self.fewest[segment])
        out = np.zeros(len(start), bool)
        out[enough] = (self.weights[own[enough]] * shared[enough]).sum(axis=1) >= self.least[segment[enough]]
        return out

    def in_a_row(self, hashes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int]]:
        """Documents and short segments whose words stand there in a row."""
        for n, keys in self.short.items():
            grams, at = common.shingles(hashes, firsts, n)
            doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
            hit = np.flatnonzero(np.isin(grams, np.array(list(keys), np.uint64)))
            for d, g, i in zip(doc[hit].tolist(), grams[hit].tolist(), (hit - at[doc[hit]] + firsts[doc[hit]]).tolist(), strict=True):
                words = hashes[i : min(i + n, firsts[d + 1])].view(np.int64).tolist()
                for segment in keys[g]:
                    if words == list(self.segments.words[segment]):
                        yield d, segment

    def of(self, column: pa.Array) -> list[dict[int, tuple[int, int, bool]]]:
        """For each text the leaked items, each with its longest match: words matched, of how many, answer found."""
        hashes, firsts = common.word_hashes(column)
        found: list[dict[int, tuple[int, int, bool]]] = [{} for _ in range(len(column))]
        if not len(hashes) or not self.masks:
            return found
        for doc, segment in self.in_a_row(hashes, firsts):
            n = len(self.segments.words[segment])
            found[doc][self.segments.item[segment]] = (n, n, True)
        for start, doc, segment in zip(*(x.tolist() for x in self.candidates(terms(hashes), firsts)), strict=True):
            words = self.segments.words[segment]
            n, item = len(words), self.segments.item[segment]
            a, b = max(firsts[doc], start - n), min(firsts[doc + 1], start + WINDOW + n)
            text = hashes[a:b].view(np.int64).tolist()
            matched = common_subsequence(self.masks[segment], n, text)
            if matched < max(PARAPHRASE * n, LEAST):
                continue
            answer = self.segments.answer[segment]
            answered = answer is not None and contains(text, answer)
            if (matched >= EXACT * n or answered) and matched > found[doc].get(item, (0,))[0]:
                found[doc][item] = (matched, n, answered)
        return found


def leaks(docs: DataFrame, space: Space, segments: Segments, name: str = "leaks") -> DataFrame:
    """The documents with a column `name`: for each item found its place in the block, words matched, of how many, answer found."""

    @F.arrow_udf("array<struct<item: int, matched: int, words: int, answered: boolean>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = Search(space, segments)
        kind = pa.list_(pa.struct([("item", pa.int32()), ("matched", pa.int32()), ("words", pa.int32()), ("answered", pa.bool_())]))
        for text in batches:
            out = []
            for part in common.slices([pa.RecordBatch.from_arrays([text], ["text"])]):
                for own in search.of(part.column(0)):
                    out.append([{"item": i, "matched": m, "words": n, "answered": a} for i, (m, n, a) in sorted(own.items())])
            yield pa.array(out, kind)

    return docs.withColumn(name, of(F.col("text").cast("string")))


def found(docs: DataFrame, benchmark: DataFrame, space: Space | None = None) -> DataFrame:
    """doc_id, item_id, matched, words, answered: a row for each document and each item that leaked into it."""
    space, out = space or fit(docs, benchmark), None
    for block in blocks(benchmark):
        one = leaks(docs.select("doc_id", "text"), space, block)
        one = one.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
        names = docs.sparkSession.createDataFrame(list(enumerate(block.item_ids)), ["item", "item_id"])
        one = one.join(F.broadcast(names), "item").select("doc_id", "item_id", "matched", "words", "answered")
        out = one if out is None else out.union(one)
    if out is None:
        kind = benchmark.schema["item_id"].dataType.simpleString()
        id_kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {id_kind}, item_id {kind}, matched int, words int, answered boolean")
    pair = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "words", "answered")).alias("best"))
    return pair.select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame, space: Space | None = None) -> DataFrame:
    """The documents into which no item leaked, their columns as they were."""
    space, columns, name = space or fit(docs, benchmark), docs.columns, common.fresh(docs, "_leaks")
    for block in blocks(benchmark):
        docs = leaks(docs, space, block, name).filter(F.size(name) == 0).select(*columns)
    return docs
