"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are numpy counts over the bytes and words of the whole text. The trees are fitted on a
bounded sample of labelled documents (`max_rows`), with the statistics binned at their quantiles, and
kept as flat arrays in heap order: node i has the children 2i + 1 and 2i + 2, so scoring is one vector
step per level for all rows and all trees.

NULL and empty texts have the statistics of an empty text and are scored like any other. Columns `score`
and `predicted` of the input are replaced. Repeated rows score alike. Without labels of both kinds every
score is the share of label 1 among them, 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

NAMES = (
    "log_bytes log_words word_length word_length_spread upper digits white stops marks bars exclaims other"
    " beyond_ascii distinct_words top_word distinct_pairs lines distinct_lines line_words entropy"
).split()
#: Documents the trees are fitted on, at most: those first by a hash of the id.
MAX_ROWS = 20_000
#: Levels of a tree.
DEPTH = 4


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_LINE, _BYTE = _class("\n"), np.arange(256)
_CLASSES = (
    (_BYTE >= 65) & (_BYTE <= 90),
    _class("0123456789"),
    _class(" \t\r\n\v\f"),
    _class(".,;:?'\"()-"),
    _class("*#$%&"),
    _class("|"),
    _class("!"),
    _class("+/=<>[]{}@^_`~\\"),
    _BYTE >= 192,
)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text, in the order of NAMES."""
    data, offsets = common.utf8(column)
    lower, starts, ends, firsts = common.word_spans(column)
    prefix = common.prefix_hashes(lower)
    hashes, lengths = common.span_hashes(prefix, starts, ends), ends - starts
    pairs = common.mixed(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
    line_starts, line_ends = common.runs(~_LINE[data], offsets)
    lines = common.span_hashes(common.prefix_hashes(data), line_starts, line_ends)
    line_firsts = np.searchsorted(line_starts, offsets)

    n_bytes, n_words = np.diff(offsets), np.diff(firsts)
    size, words = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    mean = _sums(lengths, firsts) / words
    spread = np.sqrt(np.maximum(_sums(lengths.astype(float) ** 2, firsts) / words - mean**2, 0))
    shares = [_sums(c[data], offsets) / size for c in _CLASSES]
    distinct, top, distinct_pairs, distinct_lines, entropy = np.zeros((5, len(n_bytes)))
    for i in range(len(n_bytes)):
        if n_words[i]:
            _, counts = np.unique(hashes[firsts[i] : firsts[i + 1]], return_counts=True)
            distinct[i], top[i] = len(counts) / n_words[i], counts.max() / n_words[i]
        if n_words[i] > 1:
            own = pairs[firsts[i] : firsts[i + 1] - 1]
            distinct_pairs[i] = len(np.unique(own)) / len(own)
        own = lines[line_firsts[i] : line_firsts[i + 1]]
        distinct_lines[i] = len(np.unique(own)) / max(len(own), 1)
        counts = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=1)
        share = counts[counts > 0] / size[i]
        entropy[i] = -(share * np.log2(share)).sum()
    n_lines = np.diff(line_firsts)
    columns = [np.log1p(n_bytes), np.log1p(n_words), mean, spread, *shares, distinct, top, distinct_pairs]
    columns += [np.log1p(n_lines), distinct_lines, np.log1p(n_words / np.maximum(n_lines, 1)), entropy]
    return np.column_stack(columns)


@dataclass(frozen=True)
class Trees:
    """Node i of tree t sends rows with `x[feature] > threshold` to the right; `value` is of the last level."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        n, trees = len(x), np.arange(len(self.feature))
        node, rows = np.zeros((n, len(trees)), np.int64), np.arange(n)[:, None]
        inner = self.feature.shape[1]
        for _ in range(int(np.log2(inner + 1))):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        margin = self.prior + self.value[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = DEPTH, bins: int = 64, rate: float = 0.15, ridge: float = 1.0
) -> Trees:
    """Boosted trees for the log loss: each split is the best of the gradient histograms of all statistics."""
    inner, width = 2**depth - 1, x.shape[1] if x.ndim == 2 else len(NAMES)
    feature = np.zeros((trees, inner), np.int64)
    threshold, value = np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        # exp(-40) is 0 to 17 digits: the score is the share itself
        return Trees(0.0 if not len(y) else (40.0 if share else -40.0), feature, threshold, value)
    prior = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(width)])
    flat, margin, rows = binned + np.arange(width) * bins, np.full(len(y), prior), np.arange(len(y))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend, node = p - y, p * (1 - p), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * bins) + flat).ravel()
            shape = (count, width, bins)
            g = np.bincount(cell, np.repeat(slope, width), count * width * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(bend, width), count * width * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < 1) | (all_h - h < 1)] = 0
            for f in range(width):
                gain[:, f, len(cuts[f]) :] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            split = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            f, b = best // bins, best % bins
            feature[t, first : first + count] = np.where(split, f, 0)
            threshold[t, first : first + count] = [cuts[f[i]][b[i]] if split[i] else np.inf for i in range(count)]
            at = node - first
            node = 2 * node + 1 + (split[at] & (binned[rows, f[at]] > b[at]))
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        value[t] = -rate * g / (h + ridge)
        margin += value[t][leaf]
    return Trees(prior, feature, threshold, value)


def with_statistics(docs: DataFrame) -> DataFrame:
    @F.arrow_udf("array<double>")
    def of(text: pa.Array) -> pa.Array:
        out = [statistics(s.column(0)) for s in common.slices([pa.RecordBatch.from_arrays([text], ["text"])])]
        flat = np.concatenate(out).ravel() if out else np.zeros(0)
        return pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, len(NAMES), dtype=np.int32), flat)

    return docs.select("doc_id", of(F.col("text").cast("string")).alias("statistics"))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Trees:
    """Trees for `labels.quality`; of a document with several labels the mean counts, rounded."""
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    sample = (
        with_statistics(docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi"))
        .join(F.broadcast(known), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "statistics")
        .limit(max_rows)
        .select("label", "statistics")
    )
    # max_rows rows at most, in one task: the driver gets the trees alone
    learned = sample.repartition(1).mapInArrow(_learned, "prior double, feature binary, threshold binary, value binary").collect()
    if not learned:
        return fit_trees(np.zeros((0, len(NAMES))), np.zeros(0))
    row, shape = learned[0], (-1, 2**DEPTH - 1)
    return Trees(
        row["prior"],
        np.frombuffer(row["feature"], np.int64).reshape(shape),
        np.frombuffer(row["threshold"]).reshape(shape),
        np.frombuffer(row["value"]).reshape(-1, 2**DEPTH),
    )


def _learned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trees of the labelled rows, one row; none without rows."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    x = rows.column("statistics").combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES))
    y = rows.column("label").to_numpy()
    order = np.lexsort((*x.T, y))  # sums don't depend on the order in which rows came
    trees = fit_trees(x[order], y[order])
    arrays = [pa.array([trees.prior])] + [pa.array([a.tobytes()], pa.binary()) for a in (trees.feature, trees.threshold, trees.value)]
    yield pa.RecordBatch.from_arrays(arrays, ["prior", "feature", "threshold", "value"])


def score_of(text: Column, trees: Trees) -> Column:
    """The score of a text, 0 to 1; higher where label 1 is likelier."""

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        parts = common.slices([pa.RecordBatch.from_arrays([column], ["text"])])
        scores = [trees.score(statistics(s.column(0))) for s in parts]
        return pa.array(np.concatenate(scores) if scores else np.zeros(0))

    return of(text.cast("string"))


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """The documents with `score` (double, 0 to 1) and `predicted` (1 from a score of 0.5 on, else 0)."""
    return docs.withColumn("score", score_of(F.col("text"), trees)).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def kept(docs: DataFrame, trees: Trees) -> DataFrame:
    """The documents with a score of 0.5 or more, their columns as they were."""
    return docs.filter(score_of(F.col("text"), trees) >= 0.5)


def learnable(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from: two thirds by a checksum of the id."""
    return labels.filter(common.crc_bucket(F.col("doc_id"), 3) != 1)
