"""Mixing sources to target weights by pivotal dependent rounding.

A document's size is its number of words (runs of anything but ASCII white space). Sources in the order
of code points, NULL last, have the weights 5, 2, 1, repeating; they share 150 % of all sizes by weight,
but no source gets more than twice its size, and what is above is shared again. A document of a source
is then due target / source size copies: the whole part surely, the fraction as a probability.

Fractions are rounded in pairs: as many expected words as make one of the two fractions 0 or 1 move from
one document to the other, the direction drawn so that both keep their expectation. The sum of expected
words never changes. Documents of a source are dealt to blocks by a hash; each block is rounded in one
pass that holds one document at a time and hands on at most one fraction; these are combined block by
block in the same way until each source has one, which is rounded to the nearer side. What a source then
lacks or has too much is offered to its settled documents: the one that comes nearest to it is taken once
more or once less if that helps. A source's words thus miss its target by half a document at most.

Draws are hashes of the documents, so reruns agree. Defined results: NULL and empty texts have size 0 and
are taken 0 times; a NULL source is a source; repeated rows are documents of their own; without any words
every target is 0. Columns `size`, `source_size`, `target` and `taken` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import common

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents or fractions that one pass rounds.
BLOCK = 4096
_NEAR = 1e-9


def word_count(text):
    """Runs of characters other than blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, n, target for a table of source and size; the driver gets one row of sums at a time."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = common.numbered(totals, F.col("source").asc_nulls_last(), name="rank")
    weights = F.array(*map(F.lit, WEIGHTS))[(F.col("rank") % len(WEIGHTS)).cast("int")].cast("double")
    ranked = common.staged(ranked.withColumn("weight", weights))
    most, pool, level, full = F.col("source_size") * MOST, None, 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > most
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.count(F.when(above, 1)).alias("full"),
            F.sum(F.when(above, most).otherwise(0.0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        pool = SHARE * (row["all"] or 0)
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (pool - row["given"]) / row["weight"]
    return ranked.select("source", "source_size", "n", F.least(most, F.lit(level) * F.col("weight")).alias("target"))


def _draw(a: int, b: int) -> float:
    x = common.mixed(np.array([(a * 3 ^ b * 5) & (2**64 - 1)], np.uint64))[0]
    return int(x >> np.uint64(11)) / 2**53


def _rounded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source and block; part becomes 0 or 1, but for one row of a block at most."""
    held: dict | None = None
    for batch in batches:
        rows = batch.to_pylist()
        out: list[dict] = []
        for row in rows:
            if held and (held["source"] != row["source"] or held["block"] != row["block"]):
                out.append(held)
                held = None
            if row["size"] == 0 or not _NEAR < row["part"] < 1 - _NEAR:
                out.append(row | {"part": 0.0 if row["size"] == 0 else float(round(row["part"]))})
                continue
            if held is None:
                held = row
                continue
            a, b = held, row
            p, q = a["part"] * a["size"], b["part"] * b["size"]
            up, down = min(a["size"] - p, q), min(p, b["size"] - q)
            move = up if _draw(a["h"], b["h"]) * (up + down) < down else -down
            a["part"], b["part"] = (p + move) / a["size"], (q - move) / b["size"]
            held = None
            for one in (a, b):
                if _NEAR < one["part"] < 1 - _NEAR and held is None:
                    held = one
                else:
                    out.append(one | {"part": float(round(one["part"]))})
        if out:
            yield pa.RecordBatch.from_pylist(out, batch.schema)
        last = batch.schema
    if held:
        yield pa.RecordBatch.from_pylist([held], last)


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words that the mix takes, repeats counted."""
    sizes = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    sizes = common.staged(sizes.withColumn("row", F.monotonically_increasing_id()))
    each = targets(sizes)
    due = F.when(F.col("source_size") > 0, F.least(F.lit(MOST), F.col("target") / F.col("source_size"))).otherwise(0.0)
    rows = sizes.alias("d").join(each.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    rows = rows.select("d.*", "source_size", "target", "n", due.alias("due"))
    rows = rows.withColumns({"whole": F.floor("due"), "part": F.col("due") - F.floor("due"), "open": F.col("due") > F.floor("due"), "h": F.xxhash64("doc_id", "size", "d.source")})
    done, blocks = None, F.ceil(F.col("n") / BLOCK)
    while True:
        rows = rows.withColumns({"block": F.pmod(F.xxhash64("h", F.lit(11)), blocks), "n": blocks})
        rows = rows.repartition("source", "block")
        rows = rows.sortWithinPartitions("source", "block", F.desc("size"), "h", "row")
        rows = common.staged(rows.mapInArrow(_rounded, rows.schema))
        whole = rows.filter(F.col("part").isin(0.0, 1.0))
        done = whole if done is None else done.union(whole)
        rows = rows.filter(~F.col("part").isin(0.0, 1.0))
        if (rows.agg(F.max("n")).first()[0] or 1) == 1:
            break
    done = settled(done.union(rows.withColumn("part", F.round("part"))))
    return done.select("doc_id", "source", "size", "source_size", "target", "taken")


def settled(done: DataFrame) -> DataFrame:
    """The rows with `taken`, for each source one document moved if that brings its words nearer to the target."""
    done = done.withColumn("taken", (F.col("size") * (F.col("whole") + F.col("part"))).cast("long"))
    gaps = done.groupBy("source").agg((F.max("target") - F.sum("taken")).alias("gap")).withColumnRenamed("source", "_source")
    offered = done.join(gaps, F.col("source").eqNullSafe(F.col("_source")))
    left = F.abs(F.abs("gap") - F.col("size"))
    fits = F.col("open") & (F.col("part") == F.when(F.col("gap") > 0, 0.0).otherwise(1.0)) & (left < F.abs("gap"))
    moved = offered.filter(fits).groupBy("source").agg(F.min(F.struct(left.alias("left"), "h", "row")).alias("best"))
    moved = moved.select(F.col("best.row").alias("row"), F.lit(True).alias("moved"))
    turned = F.when(F.col("moved"), F.col("size") * F.when(F.col("part") == 0, 1).otherwise(-1)).otherwise(0)
    return done.join(moved, "row", "left").withColumn("taken", (F.col("taken") + turned).cast("long"))
