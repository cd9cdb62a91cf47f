import hashlib
import random

import numpy as np
import pytest

from carelake.llm import suffix_dedup
from tests.llm.data import ODD, odd_documents, prose


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for x in raw:
        for i in range(len(x) - length + 1):
            seen[x[i : i + length]] = seen.get(x[i : i + length], 0) + 1
    out = []
    for x in raw:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        out.append((len(x), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    shared = [prose(1000 + k, 40) for k in range(4)]
    texts = [prose(i, 60) + " " + r.choice(shared)[r.randrange(30) :] + prose(i + 500, 30) for i in range(40)]
    texts += ["ab" * 150, "é" * 200, "a" * 59, "a" * 60, "a" * 61, texts[0], texts[0], texts[1][:200], None, ""]
    texts += [texts[2][:150] + str(k) + texts[2][150:] for k in range(60)]  # near copies: one large group of suffixes
    return texts


@pytest.mark.parametrize("length,reach,group", [(60, 20, 20_000), (60, 30, 5), (100, 7, 1)])
def test_against_brute_force(spark, length, reach, group):
    texts = corpus(length + reach)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = suffix_dedup.deduplicated(docs, length, reach, group).collect()
    got = {r["doc_id"]: (r["size"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = suffix_dedup.deduplicated(docs).collect()
    assert len(out) == len(ODD)
    assert all(r["n_removed"] == 0 for r in out)
    assert suffix_dedup.deduplicated(docs.limit(0)).count() == 0
