import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import common, decontam, spotsigs
from tests.llm.data import ODD, odd_documents, prose, words


def test_next_document_and_edit(spark):
    r = random.Random(5)
    rows = [(i * 3, " the ".join(words(i, r.choice([0, 1, 7, 200])))) for i in range(150)] + [(1000, None), (1001, "é" * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = {x["doc_id"]: x for x in spotsigs.with_next(docs).collect()}
    assert len(out) == len(rows)
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert (out[i]["n_chars"], out[i]["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        own, new, following = (set(spotsigs.fingerprints([t])[0].tolist()) for t in (text, changed, after))
        assert out[i]["fingerprint"] == spotsigs.written(np.array(sorted(own), np.uint32))
        for name, other in (("near_edited", new), ("near_next", following)):
            assert out[i][name] == pytest.approx(len(own & other) / len(own | other) if own | other else 1.0)


def test_many_ranges_of_equal_ids(spark):
    """Results don't depend on the ranges, and no text is in the plan of the range partitioning."""
    rows = [(i // 3 if i % 17 else None, f"the text {i % 5} of some words and more") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "9", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(repr, spotsigs.with_next(docs).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def test_length_partitions_hold_all_likely_pairs():
    for a in range(1, 300):
        for b in range(a, 300):
            if a >= 0.8 * b:
                assert abs(spotsigs.length_partition(a, 0.8) - spotsigs.length_partition(b, 0.8)) <= 1


def test_fingerprints_take_odd_rows(spark):
    docs = odd_documents(spark)
    out = spotsigs.with_next(docs).collect()
    assert len(out) == len(ODD)
    assert len({r["fingerprint"] for r in out if r["doc_id"] == 904}) == 1
    assert spotsigs.with_next(docs.limit(0)).count() == 0
    one = spotsigs.with_next(docs.filter("doc_id = 905")).collect()
    assert [(r["near_next"], r["near_edited"]) for r in one] == [(1.0, 1.0)]


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def leaked(item, passage):
    """The definition: 80 % of the item in order, or 60 % and its last words."""
    matched, answer = subsequence(item, passage), item[-6:]
    answered = any(passage[i : i + 6] == answer for i in range(len(passage)))
    return matched >= 0.8 * len(item) or matched >= 0.6 * len(item) and answered


def test_planted_leaks_are_found_and_clean_documents_kept(spark):
    items = [(i, prose(5000 + i, 30 + i % 30)) for i in range(40)]
    r, rows, wanted = random.Random(2), [], {(i, i) for i in range(40)}
    for i in range(160):
        own = words(i, 400)
        if i < 40:  # whole items
            own[100:100] = items[i][1].split()
        elif i < 120:  # a sixth of the words replaced
            item = items[i % 40][1].split()
            own[100:100] = [w if r.random() > 1 / 6 else "changed" for w in item]
            if leaked(item, own[100 : 100 + len(item)]):
                wanted.add((i, i % 40))
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(x["doc_id"], x["item_id"]) for x in decontam.found(docs, benchmark).collect()}
    assert {(i, i) for i in range(40)} <= found <= {(i, i % 40) for i in range(120)}
    assert len(found & wanted) >= 0.9 * len(wanted) and len(wanted) > 60
    kept = {x["doc_id"] for x in decontam.clean(docs, benchmark).collect()}
    assert kept == set(range(160)) - {i for i, _ in found}


def leaks_of(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((x["doc_id"], x["item_id"]) for x in decontam.found(docs, benchmark).collect())
    return found, [x["doc_id"] for x in decontam.clean(docs, benchmark).collect()]


def test_no_verbatim_leak_is_lost(spark):
    item = prose(1, 20)
    # all words of the item are in all documents
    for n in (1, 6):
        rows = [(i, f"{prose(30, 40)} {item} {prose(40, 40)}") for i in range(n)]
        found, kept = leaks_of(spark, rows, [(9, item)])
        assert found == [(i, 9) for i in range(n)] and not kept
    # items of few words, in a row and with other marks between; not the same words in another order
    rows = [(1, f"{prose(5, 30)} Alpha, beta gamma-delta {prose(6, 30)}"), (2, "beta alpha gamma delta"), (3, "one"), (4, "alpha beta"), (5, None)]
    found, kept = leaks_of(spark, rows, [(1, "alpha beta gamma delta"), (2, "One!"), (3, "..."), (4, "delta epsilon")])
    assert found == [(1, 1), (3, 2)] and sorted(kept) == [2, 4, 5]
    # one row for each id and item, every row judged by its own text
    rows = [(50, item), (50, f"{item} {item}"), (50, "clean"), (None, item), (None, prose(77, 9)), (7, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert sorted(map(str, (x["doc_id"] for x in decontam.found(docs, benchmark).collect()))) == ["50", "None"]
    assert sorted(x["text"] for x in decontam.clean(docs, benchmark).collect()) == sorted(["clean", prose(77, 9), "clean"])


def test_the_sample_is_of_distinct_texts(spark):
    rows = [("copied",)] * 500 + [(prose(i, 5),) for i in range(60)] + [(None,)]
    texts = spark.createDataFrame(rows, "text string").repartition(5)
    assert decontam.sample(texts, 30).distinct().count() == decontam.sample(texts, 30).count() == 30
    assert decontam.sample(texts, 100).count() == 61 and decontam.sample(texts.limit(0), 5).count() == 0
    same = [sorted(r.text for r in decontam.sample(t, 30).collect()) for t in (texts, texts.repartition(2))]
    assert same[0] == same[1]


def test_a_smaller_sample_still_finds_paraphrases(spark, monkeypatch):
    monkeypatch.setattr(decontam, "FIT_DOCUMENTS", 40)
    items = [(i, prose(5000 + i, 30 + i % 30)) for i in range(40)]
    r, rows, wanted = random.Random(3), [], set()
    for i in range(400):
        own = words(i, 200)
        if i < 120:
            item = items[i % 40][1].split()
            own[100:100] = [w if r.random() > 1 / 6 else "changed" for w in item]
            if leaked(item, own[100 : 100 + len(item)]):
                wanted.add((i, i % 40))
        rows.append((i, " ".join(own)))
    found, _ = leaks_of(spark, rows, items)
    assert len(wanted) > 60 and len(set(found) & wanted) >= 0.9 * len(wanted)
    assert set(found) <= {(i, i % 40) for i in range(120)}


def test_leaks_take_odd_rows(spark):
    docs = odd_documents(spark)
    odd_items = [(None, None), (1, ""), (2, "one two"), (3, prose(7, 50)), (3, prose(7, 50))]
    benchmark = spark.createDataFrame(odd_items, "item_id long, text string")
    for items in (benchmark, benchmark.limit(0)):
        assert decontam.found(docs, items).count() == 0
        kept = decontam.clean(docs, items)
        assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert decontam.found(docs.limit(0), benchmark).count() == 0
    assert decontam.clean(docs.limit(0), benchmark).count() == 0


def test_paraphrases_spread_over_more_words_than_a_segment_has_are_found():
    r = random.Random(11)
    items = [words(7000 + i, 50 + i % 15) for i in range(40)]
    rows, wanted = [], set()
    for i in range(120):
        item, share = items[i % 40], r.uniform(0.6, 0.75)
        body = []
        for w in item[:-6]:
            body += [w] if r.random() < share else []
            while r.random() < 0.52:  # words put in
                body.append(r.choice(words(i, 50)))
        body += item[-6:]
        own = words(8000 + i, 300)
        own[150:150] = body
        rows.append(own)
        if len(body) <= 2 * len(item) and leaked(item, body):
            wanted.add((i, i % 40))
    hashed = [common.word_hashes(pa.array([" ".join(x)]))[0].view(np.int64).tolist() for x in items]
    texts = pa.array([" ".join(x) for x in rows])
    counts = np.zeros(decontam.TERMS + 1)
    for x in decontam._frequencies([pa.RecordBatch.from_arrays([texts], ["text"])]):
        counts[x.column(0).to_numpy()] = x.column(1).to_numpy()
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])).astype(np.float32)
    random_ = np.random.default_rng(2).standard_normal((decontam.TERMS, decontam.RANK)).astype(np.float32)
    sums = np.zeros((decontam.TERMS, decontam.RANK))
    for own in (texts, pa.array([" ".join(x) for x in items])):
        for x in decontam._products(idf, random_)([pa.RecordBatch.from_arrays([own], ["text"])]):
            y = np.frombuffer(b"".join(x.column("y").to_pylist()), np.float32).reshape(decontam.TERMS, -1)
            sums += y / np.linalg.norm(y) * (decontam.FAVOUR if own is not texts else 1)
    basis, _ = np.linalg.qr(sums)
    space = decontam.Space(idf, (basis * idf[:, None]).astype(np.float32))
    search = decontam.Search(space, decontam.Segments(hashed, list(range(40)), [x[-6:] for x in hashed], list(range(40))))
    found = {(i, item) for i, own in enumerate(search.of(texts)) for item in own}
    assert len(wanted) > 100 and wanted <= found


def test_the_space_is_learned_from_all_documents(spark, monkeypatch):
    """No document is left out by number: the 6,000 are those of the fit, each as often as it occurs."""
    rows = [(i, f"w{i} w{i % 7} common words", "x") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    seen = []
    product = decontam._product
    monkeypatch.setattr(decontam, "_product", lambda d, *rest: (seen.append(d.count()), product(d, *rest))[1])
    decontam.fit(docs, spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string"))
    assert seen == [6000, 1]


def test_group_sums_are_those_of_each_group_and_of_the_whole_product(monkeypatch):
    """The transposed passages times their product with the matrix, against dense matrices; groups of any size, in pieces."""
    rows = np.arange(24, dtype=np.float64).reshape(8, 3)
    at, starts, ends = np.array([1, 1, 7, 0, 5, 2, 2]), np.array([0, 1, 1, 4]), np.array([1, 1, 4, 7])
    wanted = [rows[at[a:b]].sum(axis=0) for a, b in zip(starts, ends, strict=True)]
    monkeypatch.setattr(decontam, "_GROUPS", 3)
    assert np.array_equal(decontam._group_sums(rows, at, starts, ends), wanted)
    assert decontam._group_sums(rows, at, starts[:0], ends[:0]).shape == (0, 3)
    texts = pa.array(["one two one " * 90, None, "", "two", " ".join(words(3, 130))])
    monkeypatch.setattr(decontam, "_AT_ONCE", 100)
    idf = np.linspace(1, 2, decontam.TERMS).astype(np.float32)
    matrix = np.random.default_rng(1).standard_normal((decontam.TERMS, 2)).astype(np.float32)
    hashes, firsts = common.word_hashes(texts)
    blocks, _, _ = decontam._passages(firsts, decontam.WINDOW)
    passages = np.zeros((len(blocks), decontam.TERMS))
    np.add.at(passages, (np.searchsorted(blocks, np.arange(len(hashes)), "right") - 1, decontam.terms(hashes)), 1)
    passages *= idf
    (got,) = decontam._products(idf, matrix)([pa.RecordBatch.from_arrays([texts], ["text"])])
    got = np.frombuffer(b"".join(got.column("y").to_pylist()), np.float32).reshape(decontam.TERMS, -1)
    assert np.allclose(got, passages.T @ (passages @ matrix), rtol=1e-4, atol=1e-2)


@pytest.mark.parametrize("n,longest", [(40, 64), (3, 400)])
def test_running_sums_may_wrap_but_sums_of_windows_are_right(monkeypatch, n, longest):
    monkeypatch.setattr(decontam, "_CELLS", 100)
    r = np.random.default_rng(5)
    segments = [r.integers(0, 1 << 63, longest).tolist() for _ in range(n)]
    space = decontam.Space(np.ones(decontam.TERMS, np.float32), r.random((decontam.TERMS, decontam.RANK)).astype(np.float32))
    search = decontam.Search(space, decontam.Segments(segments, list(range(n)), [None] * n, list(range(n))))
    # a text of nothing but words of segments, so that sums are as large as they get
    words = np.concatenate([np.array(segments[i % n]).view(np.uint64) for i in range(200)])
    term, starts = decontam.terms(words), np.arange(0, len(words), decontam.STRIDE)
    ((reach, own),) = search.reaches
    sums = search.coarse_sums(term.astype(np.int32), starts, own, reach)
    assert sums.dtype.itemsize <= (2 if longest <= decontam.SEGMENT else 4)
    whole = np.vstack([np.zeros((1, n), np.int64), np.cumsum(search.coarse[term][:, own].astype(np.int64), axis=0)])
    assert whole[-1].max() >= 1 << 16
    width = decontam.WINDOW // decontam.STRIDE + 2 * reach
    at = np.append(starts, len(term))
    for low in range(0, len(at) - width, 7):
        got = sums[low + width] - sums[low]
        assert np.array_equal(got, whole[at[low + width]] - whole[at[low]])
