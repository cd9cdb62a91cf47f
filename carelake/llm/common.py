"""What the corpus operators share: staged tables, slices of Arrow batches, words as numpy arrays.

Words are maximal runs of ASCII letters, ASCII digits and characters beyond ASCII in the lower-cased
text. Word and shingle hashes have 64 bits and are the same on every machine.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task, which bounds the memory of the numpy arrays; a longer
#: text is a slice of its own.
SLICE_BYTES = 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHINGLE = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    np.uint64,
)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; unset, a folder inside the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def staging_folder(spark: SparkSession) -> str:
    """Where this application stages its tables; to be deleted when the application is over."""
    return f"{shared_folder(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def staged(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again: a cut of the lineage that survives lost executors."""
    folder = f"{staging_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """The rows with their place, from 0, in the given order; ranges are numbered apart, then shifted."""
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranges = staged(ranges)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))  # one row for each shuffle partition
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.withColumn("_own", own).join(counts, "_range").withColumn(name, F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")


def crc_bucket(doc_id, n: int):
    """crc32 of the id as text, modulo n; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most SLICE_BYTES of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + SLICE_BYTES
            to = max(at + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the n + 1 offsets; NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, for i up to n."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n + 1, 2 * SLICE_BYTES), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """n + 1 sums of byte * base ** i modulo 2 ** 64, from which `span_hashes` takes the hash of any span."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True; a run ends with its document."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(len(inside) + 1, bool)
    border[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~border[:-1]
    after = np.concatenate((inside[1:], [False])) & ~border[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of all words, and the n + 1 offsets of the documents' words."""
    data, offsets = utf8(pc.utf8_lower(column))
    starts, ends = runs(_WORD[data], offsets)
    return data, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words and the n + 1 offsets of the documents' words."""
    data, starts, ends, firsts = word_spans(column)
    return span_hashes(prefix_hashes(data), starts, ends), firsts


def shingles(hashes: np.ndarray, firsts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k words from each word on, and their offsets; fewer than k words are one shingle."""
    counts = np.diff(firsts)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.concatenate(([0], np.cumsum(n)))
    doc = np.repeat(np.arange(len(counts)), n)
    start = firsts[:-1][doc] + np.arange(len(doc)) - at[:-1][doc]
    out, last = np.zeros(len(doc), np.uint64), firsts[1:][doc]
    for j in range(k if len(doc) else 0):
        word = np.where(start + j < last, hashes[np.minimum(start + j, len(hashes) - 1)], np.uint64(0))
        out = (out + word * _SHINGLE[j % 5]) * np.uint64(3) + np.uint64(j)
    return mixed(out), at


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def key_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by whole keys come in tables that never split the rows of one key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        last = [now.column(k)[-1] for k in keys]
        same = np.ones(now.num_rows, bool)
        for k, value in zip(keys, last, strict=True):
            same &= pc.equal(now.column(k), value).to_numpy(zero_copy_only=False)
        first = int(np.argmax(same))
        if first or (held and any(held[-1].column(k)[-1] != v for k, v in zip(keys, last, strict=True))):
            whole = [*held, *now.slice(0, first).to_batches()]
            if whole:
                yield pa.Table.from_batches(whole).combine_chunks()
            held = []
        held += now.slice(first).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
