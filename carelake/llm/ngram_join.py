"""N-gram Jaccard join by chosen paths.

Each text is the set of its five-word shingles. Texts with equal sets are joined by a digest of the set
and go on as one set with a number of copies. A set is embedded as `COORDINATES` MinHash values. A run
starts with all sets in one bucket; a bucket picks coordinates by a hash of its path, each with a
probability that gives 1 / `SPLIT` picks on average, and sends each set to one child for each pick, by
the set's value there. Buckets of one set end. Buckets of up to `BUCKET` sets are compared inside by
their MinHash values, larger ones split again; what is larger after `DEPTH` splits is compared in pairs
of blocks, so nothing is left out. The number of runs follows from the target recall (`runs`).

Sets whose MinHash values agree near the threshold are put into one candidate class. Inside each class
all pairs are checked exactly, on whole shingle sets, in pairs of blocks: a task counts the links of each
set and reports a spanning forest, so no pair of a group is ever a row.

Defined results: NULL, empty and wordless texts have no shingles and link to nothing; a text of fewer
than five words is one shingle; repeated rows are copies. Classes are the connected components of the
links and are named by their least document id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import common
from carelake.llm.components import components, stars

THRESHOLD, WORDS = 0.8, 5
COORDINATES, SPLIT, DEPTH, BUCKET = 64, 0.6, 4, 4000
RECALL = 0.9995
#: Sets of a candidate class that one block of the exact check holds.
BLOCK = 256
#: Standard deviations that the share of equal MinHash values may lie below the threshold.
SLACK = 4.0

_rng = np.random.Generator(np.random.PCG64(20))
_FACTORS = _rng.integers(0, 2**64, COORDINATES, np.uint64) | np.uint64(1)
_TERMS = _rng.integers(0, 2**64, COORDINATES, np.uint64)
_PICKS = _rng.integers(0, 2**64, COORDINATES, np.uint64)
_DIGESTS = _rng.integers(0, 2**64, 2, np.uint64)


def runs(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met with probability `recall`, however often its buckets split."""
    apart = 0.0  # the chance that two sets of one bucket share no path of so many splits
    for _ in range(DEPTH):
        apart = (1 - threshold / (SPLIT * COORDINATES) * (1 - apart)) ** COORDINATES
    return math.ceil(math.log(1 - recall) / math.log(apart))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and their offsets."""
    hashes, at = common.shingles(*common.word_hashes(column), WORDS)
    sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate(sets) if sets else hashes, np.concatenate(([0], np.cumsum(sizes)))


def sketches(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, two digests (2, n) and MinHash values (n, COORDINATES) of the texts' shingle sets."""
    values, at = shingle_sets(column)
    sizes, some = np.diff(at), np.flatnonzero(np.diff(at))
    digests, least = np.zeros((2, len(sizes)), np.uint64), np.zeros((len(sizes), COORDINATES), np.uint32)
    if len(some):
        for k in range(2):
            digests[k, some] = np.add.reduceat(common.mixed(values ^ _DIGESTS[k]), at[some])
        for i in range(COORDINATES):
            own = ((values * _FACTORS[i] + _TERMS[i]) >> np.uint64(32)).astype(np.uint32)
            least[some, i] = np.minimum.reduceat(own, at[some])
    return sizes, digests, least


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text, and k1 and k2: 128 bits of hash that stand for a row's id and text."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return docs.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(7), "text", "doc_id")})


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches):
        sizes, digests, least = sketches(part.column("text"))
        k1, k2 = part.column("k1").to_numpy(), part.column("k2").to_numpy()
        d1, d2 = (np.where(sizes > 0, d.view(np.int64), k) for d, k in zip(digests, (k1, k2), strict=True))
        width = 4 * COORDINATES
        sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(sizes), [None, pa.py_buffer(np.ascontiguousarray(least))])
        columns = [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(sizes), pa.array(d1), pa.array(d2), sketch.cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k1", "k2", "size", "d1", "d2", "sketch"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def _children(paths: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows and the paths of their children."""
    limit, at, found = np.uint64(int(2**64 / (SPLIT * COORDINATES))), [], []
    for i in range(COORDINATES):
        row = np.flatnonzero(common.mixed(paths ^ _PICKS[i]) < limit)
        at.append(row)
        found.append(common.mixed(paths[row] * np.uint64(3) + _PICKS[i]) ^ least[row, i].astype(np.uint64))
    return np.concatenate(at), common.mixed(np.concatenate(found))


def _first_paths(n_runs: int):
    roots = common.mixed(np.arange(1, n_runs + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, least = batch.column("set_id").to_numpy(), _matrix(batch.column("sketch"))
            for root in roots:
                at, paths = _children(np.full(len(ids), root), least)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(paths.view(np.int64))], ["set_id", "path"])

    return of


def _next_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, least = batch.column("set_id").to_numpy(), _matrix(batch.column("sketch"))
        at, paths = _children(batch.column("path").to_numpy().view(np.uint64), least)
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(paths.view(np.int64))], ["set_id", "path"])


def _in_blocks(rows: DataFrame, size, per_block: int, by: str) -> DataFrame:
    """Each row once for each pair of blocks that holds it: lo, hi and its own block."""
    n = F.ceil(size / per_block)
    own = rows.withColumn("own", F.pmod(F.xxhash64(F.lit(by), "set_id"), n)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return own.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))


def buckets(sets: DataFrame, n_runs: int) -> DataFrame:
    """set_id, bucket: all buckets that are to be compared inside."""
    out = None
    level = sets.select("set_id", "sketch").mapInArrow(_first_paths(n_runs), "set_id long, path long")
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        live = common.staged(level.join(sizes, "path").select("set_id", "path", "n"))
        small, large = live.filter(F.col("n") <= BUCKET), live.filter(F.col("n") > BUCKET)
        small = small.select("set_id", F.col("path").alias("bucket"))
        out = small if out is None else out.union(small)
        if large.isEmpty():
            return out
        if depth < DEPTH:
            level = large.select("set_id", "path").join(sets.select("set_id", "sketch"), "set_id")
            level = level.mapInArrow(_next_paths, "set_id long, path long")
    rest = _in_blocks(large, F.col("n"), BUCKET, "bucket")
    return out.union(rest.select("set_id", F.xxhash64("path", "lo", "hi").alias("bucket")))


def _alike(least_share: float):
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.key_groups(batches, ["bucket"]):
            bucket, set_ids = rows.column("bucket").to_numpy(), rows.column("set_id").to_numpy()
            least = _matrix(rows.column("sketch"))
            ids, place = np.unique(set_ids, return_inverse=True)
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            left = np.arange(len(bucket))
            for d in range(1, len(bucket)):
                left = left[left + d < len(bucket)]
                left = left[bucket[left] == bucket[left + d]]
                if not len(left):
                    break
                for part in np.array_split(left, len(left) // 20_000 + 1):
                    share = (least[part] == least[part + d]).mean(axis=1)
                    hit = part[share >= least_share]
                    a.append(place[hit])
                    b.append(place[hit + d])
            root = stars(ids, np.concatenate(a), np.concatenate(b))
            other = root != ids
            yield pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(root[other])], ["a", "b"])

    return of


def _common_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of the sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1  # a token of one set alone is in no intersection
    owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(token, kind="stable")
    owner, token, width = owner[order], token[order], 4096
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, (first, first + width))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], token[a:b] - first] = 1
        out += held @ held.T
    return out


def _checked(threshold: float):
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.key_groups(batches, ["class", "lo", "hi"]):
            keys = np.column_stack([rows.column(c).to_numpy() for c in ("class", "lo", "hi")])
            cuts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            ids, copies, own = (rows.column(c).to_numpy() for c in ("set_id", "copies", "own"))
            values, out = rows.column("shingles"), []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                sets = [np.frombuffer(v, np.uint64) for v in values[a:b].to_pylist()]
                sizes = np.array([len(s) for s in sets])
                both = _common_tokens(sets)
                linked = both >= threshold * (sizes[:, None] + sizes - both) - 1e-6
                np.fill_diagonal(linked, False)
                if keys[a, 1] != keys[a, 2]:
                    linked &= own[a:b, None] != own[a:b]
                root = stars(ids[a:b], *np.nonzero(linked))
                out.append((ids[a:b], linked @ copies[a:b], root))
            parts = [np.concatenate(p).astype(np.int64) for p in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, parts)), ["set_id", "links", "root"])

    return of


def _with_shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches):
        values, at = shingle_sets(part.column("text"))
        sets = pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("set_id"), sets], ["set_id", "shingles"])


def joined(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies, is_head and the row keys k1, k2 (see `with_keys`), one row per document.

    n_links counts the other documents with a similarity of `threshold` or more, n_copies those with the
    same shingles, the document itself included; is_head marks the row of a class with the least id, which is not NULL
    unless all are.
    """
    keyed = with_keys(docs)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 long, k2 long, size long, d1 long, d2 long, sketch binary"
    rows = common.staged(keyed.mapInArrow(_sketched, schema))
    sets = rows.filter("size > 0").groupBy("d1", "d2")
    sets = sets.agg(F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("head"), F.min("doc_id").alias("first_id"), F.first("sketch").alias("sketch"))
    sets = common.staged(sets.withColumn("set_id", F.monotonically_increasing_id()))

    share = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / COORDINATES)
    compared = buckets(sets, runs(threshold, recall)).join(sets.select("set_id", "sketch"), "set_id")
    compared = compared.repartition("bucket").sortWithinPartitions("bucket", "set_id")
    stars_found = components(compared.mapInArrow(_alike(share), "a long, b long"))
    members = stars_found.select(F.col("node").alias("set_id"), F.col("root").alias("class"))
    members = members.union(stars_found.select("root", "root").distinct())
    members = common.staged(members.join(sets.select("set_id", "copies", "head.k1", "head.k2"), "set_id"))

    # the same plan at every size: members grow with the corpus
    texts = keyed.join(members.select("set_id", "k1", "k2").hint("merge"), ["k1", "k2"]).select("set_id", "text")
    shingled = texts.mapInArrow(_with_shingles, "set_id long, shingles binary").dropDuplicates(["set_id"])
    sizes = members.groupBy("class").agg(F.count("*").alias("n"))
    blocks = _in_blocks(members.join(sizes, "class"), F.col("n"), BLOCK, "class")
    blocks = blocks.select("set_id", "class", "n", "copies", "own", "lo", "hi").join(shingled, "set_id")
    blocks = blocks.repartition("class", "lo", "hi").sortWithinPartitions("class", "lo", "hi", "set_id")
    checked = common.staged(blocks.mapInArrow(_checked(threshold), "set_id long, links long, root long"))

    roots = components(checked.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("set_id").agg(F.sum("links").alias("links"))
    named = sets.select("set_id", "d1", "d2", "copies", "first_id", "head").join(links, "set_id", "left")
    named = named.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.withColumn("root", F.coalesce("root", "set_id"))
    heads = named.groupBy("root").agg(F.min("first_id").alias("class_id"), F.min("head").alias("head"))
    named = named.drop("head").join(heads, "root").select("d1", "d2", "copies", "links", "class_id", "head")
    every = rows.select("doc_id", "k1", "k2", "d1", "d2").join(named, ["d1", "d2"], "left")
    first = (F.col("head.k1") == F.col("k1")) & (F.col("head.k2") == F.col("k2"))
    return every.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(first, F.lit(True)).alias("is_head"),
        "k1",
        "k2",
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One document of each class, the one with the least id, with all its columns; rows of equal id and text are one."""
    k1, k2 = common.fresh(docs, "_k1"), common.fresh(docs, "_k2")
    heads = joined(docs, threshold, recall).filter("is_head").select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    text = F.col("text").cast("string")
    keyed = docs.withColumns({k1: F.xxhash64("doc_id", text), k2: F.xxhash64(F.lit(7), text, "doc_id")})
    return keyed.join(heads, [k1, k2], "left_semi").dropDuplicates([k1, k2]).select(*docs.columns)
