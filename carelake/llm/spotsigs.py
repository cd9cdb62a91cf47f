"""Document fingerprints by SpotSigs: chains of content words that follow common words.

A spot is a common word (`ANCHORS`); its signature is a hash of the anchor and the next `CHAIN` words that
are no anchors. The fingerprint of a text is the set of its signatures, written as its size and the sorted
signatures in hexadecimal. Texts without a whole chain use every word as an anchor; texts without a word
have the hash of the text itself as their only signature, and the empty text has none.

Likeness is the Jaccard similarity of two fingerprints. `likeness` takes a bound: sets whose sizes alone
rule it out, or whose merge cannot reach it any more, count as 0. Fingerprints fall into partitions by
size (`length_partition`) so that only those of one or two neighbouring partitions can reach the bound.

`with_next` puts each document beside its successor in the order of doc_id (NULL last, ties by a digest of
the text). Ids and digests alone are sorted first, and give the first document of each range; then every
range gets its documents, sorted, and behind them the first one of the range that follows. So texts are
shuffled once, none of them passes the driver, and nothing but the result is written.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

CHAIN = 2
# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from he in is it of on or that the this to was with you"
    " auf das dem den der die ein eine für im ist mit nicht sich und von zu"
    " au avec dans de des du elle est et la le les ne par pas pour que qui sur un une"
    " con del el en es las lo los no para por se su una y"
).split()


def _anchor_hashes() -> np.ndarray:
    hashes, _ = common.word_hashes(pa.array([" ".join(ANCHORS)]))
    return np.unique(hashes)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The sorted 32-bit signatures of each text."""
    hashes, firsts = common.word_hashes(pa.array(texts, pa.large_string()))
    anchor = np.isin(hashes, _anchor_hashes())
    doc = np.repeat(np.arange(len(texts)), np.diff(firsts))

    def chains(spots: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and signatures of the spots that have a whole chain."""
        at = np.searchsorted(content, spots, "right")
        whole = at + CHAIN <= len(content)
        spots, at = spots[whole], at[whole]
        whole = doc[content[at + CHAIN - 1]] == doc[spots]
        spots, at = spots[whole], at[whole]
        value = hashes[spots]
        for j in range(CHAIN):
            value = common.mixed(value * np.uint64(3) + hashes[content[at + j]])
        return doc[spots], (value >> np.uint64(32)).astype(np.uint32)

    where, value = chains(np.flatnonzero(anchor), np.flatnonzero(~anchor))
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
    cuts = np.searchsorted(where, np.arange(len(texts) + 1))
    for i, text in enumerate(texts):
        own = value[cuts[i] : cuts[i + 1]]
        if not len(own) and text:
            words = hashes[firsts[i] : firsts[i + 1]]
            if len(words):
                ahead = [np.append(words[j:], np.zeros(j, np.uint64)) for j in range(1, CHAIN + 1)]
                own = words
                for a in ahead:
                    own = common.mixed(own * np.uint64(3) + a[: len(own)])
                own = (own >> np.uint64(32)).astype(np.uint32)
            else:
                own = np.frombuffer(hashlib.sha256(text.encode()).digest()[:4], np.uint32)
        out[i] = np.unique(own)
    return out


def written(signatures: np.ndarray) -> str:
    return f"{len(signatures)}:{signatures.astype('>u4').tobytes().hex()}"


def length_partition(size: int, at_least: float) -> int:
    """Partition of a fingerprint; fingerprints two or more partitions apart have a likeness below the bound."""
    return math.floor(math.log(max(size, 1)) / -math.log(at_least))


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets, 0 where it is below the bound; two empty sets are alike."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(large):
        return 1.0
    if not len(small) or len(small) < at_least * len(large):
        return 0.0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    share = both / (len(a) + len(b) - both)
    return share if share >= at_least else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(texts: list[str], following: list[str]) -> dict[str, list]:
    """Fingerprints of texts and edited texts, and their likenesses to the edited and the following text."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    own, new, after = (fingerprints(x) for x in (texts, changed, following))
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": list(map(written, own)),
        "edited_fingerprint": list(map(written, new)),
        "near_edited": [likeness(a, b) for a, b in zip(own, new, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(own, after, strict=True)],
    }


_RESULT = {"n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}


def _compared(schema: pa.Schema):
    """All rows of sorted ranges are compared with the next row; the last of a range is there for that alone."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        for part in common.slices(batches):
            columns = [part.column(c).to_pylist() for c in ("doc_id", "text", "following")]
            ids, texts, following = (a + b for a, b in zip(held, columns, strict=True))
            own = [i for i in range(len(ids) - 1) if not following[i]]
            if own:
                found = compared([texts[i] for i in own], [texts[i + 1] for i in own])
                yield common.batch_of(schema, doc_id=[ids[i] for i in own], **found)
            held = (ids[-1:], texts[-1:], following[-1:])

    return of


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id and the results of `compared` for each document and the next, after the last the first."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    result = StructType([docs.schema["doc_id"]])
    for name, kind in _RESULT.items():
        result = result.add(name, kind)
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.col("doc_id").isNull().alias("none"), F.xxhash64(text).alias("tie"))
    order = ["none", "doc_id", "tie"]
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ids = rows.select(order).repartitionByRange(ranges, *order)
    firsts = sorted_ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*order)).alias("first")).select("first.*")
    bounds = sorted((r["none"], 0 if r["none"] else r["doc_id"], r["tie"]) for r in firsts.collect())  # one for each range
    if not bounds:
        return spark.createDataFrame([], result)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in order)
    table = json.dumps([dict(zip(order, (n, None if n else i, t))) for n, i, t in bounds], default=str)
    limits, key = F.from_json(F.lit(table), F.lit(f"array<struct<{kinds.replace(' ', ':')}>>".replace(",:", ","))), F.struct(*order)

    def further(at: Column, step: Column) -> Column:
        return F.when((at + step < len(bounds)) & (F.get(limits, at + step) <= key), at + step).otherwise(at)

    # the last range whose first key is not behind the row's, by halving steps
    steps = [1 << k for k in range(len(bounds).bit_length(), -1, -1)]
    placed = rows.withColumn("range", F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in order]
    wanted = [(n, None if n else i, t, (k - 1) % len(bounds)) for k, (n, i, t) in enumerate(bounds)]
    wanted = spark.createDataFrame(wanted, f"{kinds}, range int")
    heads = rows.alias("r").join(F.broadcast(wanted.alias("f")), on=same).select("r.*", "f.range")
    heads = heads.groupBy("range").agg(F.first("text").alias("text"))  # of rows alike one
    columns = ["doc_id", "text", "none", "tie", "range"]
    heads = heads.select(*(F.col(c) if c in heads.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns))
    every = placed.select(*columns, F.lit(False).alias("following")).union(heads.select("*", F.lit(True)))
    every = every.repartition("range").sortWithinPartitions("range", "following", *order)
    return every.select("doc_id", "text", "following").mapInArrow(_compared(to_arrow_schema(result)), result)
