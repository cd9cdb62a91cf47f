import random
import re

import pytest

from carelake.llm import ngram_join
from tests.llm.data import ODD, WORDS, odd_documents, prose, words


def sets(text):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def links(rows):
    own = [sets(t) for _, t in rows]
    return [{j for j, u in enumerate(own) if j != i and s and len(s & u) >= 0.8 * len(s | u) - 1e-9} for i, s in enumerate(own)]


def near_copies(n, base_words=120, most=2, seed=1):
    r, base, out = random.Random(seed), words(seed, base_words), []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, most)):
            w[r.randrange(len(w))] = r.choice(WORDS)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("bucket,block", [(4000, 256), (40, 32)])
def test_links_and_classes_against_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = near_copies(150) + near_copies(5, seed=2, most=6) + [" ".join(words(s, 90)) for s in range(50, 80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500 + i, texts[0].upper()) for i in range(20)]
    got = {r["doc_id"]: r for r in ngram_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wanted = links(rows)
    assert [got[i]["n_links"] for i, _ in rows] == [len(w) for w in wanted]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *(root[j] for j in w)]) for i, w in enumerate(wanted)]
    assert [got[i]["class_id"] for i, _ in rows] == [rows[k][0] for k in root]


def test_the_target_recall_sets_the_runs():
    assert ngram_join.runs(recall=0.9) < ngram_join.runs(recall=0.999) < ngram_join.runs(recall=0.9999)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = ngram_join.joined(docs).collect()
    assert len(out) == len(ODD)
    copies = [r for r in out if r["n_copies"] > 1]
    assert {r["doc_id"] for r in copies} == {904} and {r["n_links"] for r in copies} == {1}
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 1
    assert ngram_join.joined(docs.limit(0)).count() == 0


def test_the_head_has_an_id_if_any_row_has(spark):
    text = prose(3, 40)
    docs = spark.createDataFrame([(None, text), (6, text), (5, text), (None, prose(4, 40))], "doc_id long, text string")
    heads = [(r["doc_id"], r["class_id"]) for r in ngram_join.joined(docs).filter("is_head").collect()]
    assert sorted(heads, key=str) == [(5, 5), (None, None)]
    assert {r["doc_id"] for r in ngram_join.one_of_each(docs).collect()} == {5, None}
