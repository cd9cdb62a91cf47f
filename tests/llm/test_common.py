import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from carelake.llm import common
from carelake.llm.components import components


def test_words_and_shingles_are_those_of_the_text():
    column = pa.array(["One two, THREE four five six", None, "", "é É x", "one two"])
    hashes, firsts = common.word_hashes(column)
    assert np.diff(firsts).tolist() == [6, 0, 0, 3, 2]
    assert hashes[6] == hashes[7] and hashes[0] == hashes[9]
    values, at = common.shingles(hashes, firsts)
    assert np.diff(at).tolist() == [2, 0, 0, 1, 1]
    again = common.shingles(*common.word_hashes(pa.array(["zero one two three four five"])))[0]
    assert again[1] == values[0]


def test_slices_hold_all_rows():
    texts = ["a" * n for n in (10, 0, common.SLICE_BYTES * 2, 5, common.SLICE_BYTES - 1, 3)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(common.slices([batch, batch.slice(0, 0)]))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert len(parts) > 3


def test_key_groups_never_split_a_key():
    keys = [1, 1, 2, 2, 2, 3, 3, 3, 3, 4]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + 3])], ["k"]) for a in range(0, 10, 3)]
    groups = [t.column("k").to_pylist() for t in common.key_groups(batches, ["k"])]
    assert sum(groups, []) == keys
    assert all(not set(a) & set(b) for i, a in enumerate(groups) for b in groups[i + 1 :])


def test_numbered_counts_on_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(5)
    got = sorted((r["x"], r["place"]) for r in common.numbered(df, F.col("x"), name="place").collect())
    assert [p for _, p in got] == list(range(1000))


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 300), (7, 7), (500, 501), (501, 500)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, 200: 100, 300: 100, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
