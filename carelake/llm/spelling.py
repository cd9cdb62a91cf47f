"""Spelling variants: words one code point apart, found through pairs of trie nodes.

The words of a vocabulary are put into a trie, and their reversals into another one; both tries' nodes are
numbered. A pair (node of a prefix, node of a suffix) of integers then says what stands before and after
one place of a word. Every word gives the pairs around each of its code points, as if that were skipped,
and the pairs around each gap, as if one were inserted there. Words differ in one replaced code point just
if they share a skipping pair; a word is another one less a code point just if its inserting pair is the
other's skipping pair. So equal pairs are exactly the near words, without any comparison of texts.

Numbering: words sorted in ranges share their path with the word before up to the common prefix and get
new numbers from there on; the paths at the ends of the ranges, one row for each, are joined on the driver.
A word's own number is that of its last node, which follows the order of code points. Pairs that hold a
node of one word only are left out, for nothing can be equal to them.

A pair has one inserting word at most and one skipping word for each letter. Their mutual bests and counts
are reduced inside the group, so pairs of words are never written. Where deleting any letter of a run gives
the same word, only the first of the run counts. Forms lead to more frequent words (twice at least), so
chains have no more than 63 links, and six doublings of the links reach every root.

Defined results: NULL texts have no words and a NULL id counts as the empty text; repeated rows count as
often as they occur; long runs cost in proportion to their length; an empty table gives an empty result.
Other columns than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

RUN = r"[A-Za-zÀ-ÿ]+"
TYPOS, SHORTEST, LEAST, RATIO = 97, 5, 3, 2
#: Nodes in an Arrow batch of paths, about.
_NODES = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(run: Column) -> Column:
    """A to Z in lower case, all other letters as they are."""
    ascii_ = F.octet_length(run) == F.length(run)
    return F.when(ascii_, F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def vocabulary(docs: DataFrame, typos: int | None = TYPOS, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word and n, its occurrences in all texts. With `typos`, runs whose digest it divides lose a letter."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select("doc", lowered(F.col("run")).alias("word"))
    if typos:
        words = words.select("word", F.crc32(F.concat("doc", F.lit(":"), "word").cast("binary")).alias("h"))
        place = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.col("word").substr(F.lit(1), place), F.col("word").substr(place + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % typos == 0, cut).otherwise(F.col("word")).alias("word"))
    words = words.filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted words of a range, numbered from 0, and how many of them another word may have, too."""
    part, path, top, before, held = TaskContext.get().partitionId(), [], 0, None, None
    rows: list[tuple] = []
    size = 0

    def batch():
        keys, nodes, shared, tops = zip(*rows, strict=True)
        arrays = [pa.array(keys, pa.string()), pa.array([part] * len(keys), pa.int32()), pa.array(nodes, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(shared, pa.int32()), pa.array(tops, pa.int64())], ["key", "part", "nodes", "shared", "top"])

    for word in (w for b in batches for w in b.column("key").to_pylist()):
        same = 0 if before is None else _common(before, word)
        if held:  # at the borders of the range, all nodes may be shared
            rows.append((held[0], held[1], max(held[2], same), held[3]))
        path = [*path[:same], *range(top, top + len(word) - same)]
        top += len(word) - same
        held = (word, np.array(path, np.int64), len(word) if before is None else same, top)
        before = word
        size += len(path)
        if size > _NODES and rows:
            yield batch()
            rows, size = [], 0
    if held:
        rows.append((held[0], held[1], len(held[0]), held[3]))
        yield batch()


def trie(keys: DataFrame) -> DataFrame:
    """key, nodes (of its prefixes of 1, 2, .. code points) and shared, for a table of distinct words `key`."""
    ranges = keys.select("key").repartitionByRange("key").sortWithinPartitions("key")
    local = common.staged(ranges.mapInArrow(_paths, "key string, part int, nodes array<long>, shared int, top long"))
    ends = local.groupBy("part").agg(F.min("key").alias("first"), F.max(F.struct("key", "nodes", "top")).alias("last")).orderBy("first")
    shifts, before, path, offset = [], "", [], 0
    for end in ends.collect():  # one row for each range
        same = path[: _common(before, end["first"])]
        shifts.append((end["part"], offset, same))
        before, path = end["last"]["key"], [same[x] if x < len(same) else offset + x for x in end["last"]["nodes"]]
        offset += end["last"]["top"]
    shifts = keys.sparkSession.createDataFrame(shifts, "part int, offset long, same array<long>")
    node = F.transform("nodes", lambda x: F.coalesce(F.get("same", x.cast("int")), F.col("offset") + x))
    return local.join(F.broadcast(shifts), "part").select("key", node.alias("nodes"), "shared")


def pairs(words: DataFrame) -> DataFrame:
    """before, after (nodes), id, n and kind for every place of the words (id, word, n, forward, backward, both shared lengths).

    Kind 0 has a gap at the place, 1 and 2 a code point that is skipped; 1, if it is equal to the one before it.
    """

    def node(nodes: str, depth: Column) -> Column:
        return F.when(depth == 0, F.lit(-1).cast("long")).otherwise(F.get(nodes, depth - 1))

    def around(skipped: int) -> DataFrame:
        least = F.greatest(F.lit(0), F.col("size") - skipped - F.col("backward_shared"))
        most = F.least(F.col("size") - skipped, F.col("forward_shared"))
        places = words.filter(least <= most).select("*", F.explode(F.sequence(least, most)).alias("at"))
        kind = F.when(F.get("repeats", F.col("at")), 1).otherwise(2) if skipped else F.lit(0)
        return places.select(
            node("forward", F.col("at")).alias("before"), node("backward", F.col("size") - F.col("at") - skipped).alias("after"), "id", "n", kind.alias("kind")
        )

    return around(0).unionByName(around(1))


def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds for each code point whether it is equal to the one before it."""
    for batch in batches:
        flags = [[i > 0 and c == word[i - 1] for i, c in enumerate(word)] for word in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags, pa.list_(pa.bool_()))], [*batch.schema.names, "repeats"])


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a pair: how many near words it has there, and the best of them."""
    for rows in common.key_groups(batches, ["before", "after"]):
        before, after, id_, n, kind = (rows.column(c).to_numpy() for c in ("before", "after", "id", "n", "kind"))
        new = np.concatenate(([True], (before[1:] != before[:-1]) | (after[1:] != after[:-1])))
        group = np.cumsum(new) - 1
        groups = int(group[-1]) + 1
        skipping = np.flatnonzero(kind > 0)
        order = skipping[np.lexsort((id_[skipping], -n[skipping], group[skipping]))]
        size = np.bincount(group[order], minlength=groups)
        start = np.cumsum(size) - size
        whole = np.concatenate((order, [-1, -1]))  # places of no word
        first = np.where(size > 0, whole[np.minimum(start, len(order))], -1)
        second = np.where(size > 1, whole[np.minimum(start + 1, len(order))], -1)
        gap = np.full(groups, -1)
        gap[group[kind == 0]] = np.flatnonzero(kind == 0)
        counted = np.bincount(group[kind == 2], minlength=groups)

        row = np.arange(len(group))
        found = np.where(kind == 0, counted[group], size[group] - 1 + ((kind == 2) & (gap[group] >= 0)))
        other = np.where(first[group] == row, second[group], first[group])
        short = np.where(kind == 0, -1, gap[group])
        best = np.where(other < 0, short, other)
        both = (other >= 0) & (short >= 0)
        better = (n[short] > n[other]) | ((n[short] == n[other]) & (id_[short] < id_[other]))
        best = np.where(both & better, short, best)
        hit = found > 0
        columns = (id_[hit], found[hit].astype(np.int64), n[best[hit]], id_[best[hit]])
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["id", "found", "best_n", "best"])


def roots(links: DataFrame) -> DataFrame:
    """id and root for links from `id` to `form`, whose chains have an end."""
    links = common.staged(links.select("id", F.col("form").alias("root")))
    while True:
        on = links.select(F.col("id").alias("root"), F.col("root").alias("further"))
        longer = links.join(on.hint("merge"), "root", "left")
        links = common.staged(longer.select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")))
        if not links.filter("went").limit(1).count():
            return links.select("id", "root")
        links = links.select("id", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n for a table of distinct words with their counts n.

    The form is the most frequent near word (the first in code-point order of equally frequent ones) if that is
    `ratio` times as frequent at least; the root is where forms lead to.
    """
    words = common.staged(words.select("word", "n"))
    forward = trie(words.select(F.col("word").alias("key"))).toDF("word", "forward", "forward_shared")
    backward = trie(words.select(F.reverse("word").alias("key"))).toDF("key", "backward", "backward_shared")
    joined = words.join(forward, "word").join(backward.withColumn("word", F.reverse("key")).drop("key"), "word")
    joined = joined.select("word", "n", F.get("forward", F.length("word") - 1).alias("id"), "forward", "forward_shared", "backward", "backward_shared", F.length("word").alias("size"))
    schema = f"{', '.join(f'{c} {t}' for c, t in joined.dtypes)}, repeats array<boolean>"
    joined = common.staged(joined.mapInArrow(_repeats, schema))
    grouped = pairs(joined).repartition("before", "after").sortWithinPartitions("before", "after")
    near = grouped.mapInArrow(_near, "id long, found long, best_n long, best long")
    near = near.groupBy("id").agg(F.sum("found").alias("n_near"), F.max(F.struct("best_n", (-F.col("best")).alias("best"))).alias("best"))
    near = near.select("id", "n_near", F.col("best.best_n").alias("form_n"), (-F.col("best.best")).alias("form"))
    known = joined.select("id", "word", "n")
    likely = F.col("form_n") >= ratio * F.col("n")
    out = known.join(near, "id", "left").withColumns({c: F.when(likely, F.col(c)) for c in ("form", "form_n")})
    out = common.staged(out.withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long"))))
    links = out.filter("form is not null").select("id", "form")
    ends = roots(links).join(known.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    forms = links.join(known.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form").select("id", "form_word")
    named = out.select("id", "word", "n", "n_near", "form_n").join(forms, "id", "left").join(ends, "id", "left")
    return named.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
