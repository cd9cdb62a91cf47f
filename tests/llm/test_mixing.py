import random
import re
from collections import defaultdict

from carelake.llm import mixing
from tests.llm.data import ODD, odd_documents


def wanted(sizes):
    """Targets by raising one level at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, full = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set()
    while left > 1e-9 and len(full) < len(order):
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        left = 0.0
        for s in open_:
            target[s] += share[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
    return target


def test_targets_and_taken(spark):
    r = random.Random(4)
    sources = ["b", "a", None, "ä", "A", "z"]
    rows = [(i, "w " * r.choice([0, 1, 3, 40, 300, 5000]), "b" if i % 3 else r.choice(sources)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = mixing.mixed(docs).collect()
    text = {i: (t, s) for i, t, s in rows}
    total, taken, most, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for row in out:
        t, s = text[row["doc_id"]]
        assert row["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", t))
        assert row["taken"] in (0, row["size"], 2 * row["size"])
        total[s] += row["size"]
        taken[s] += row["taken"]
        most[s] = max(most[s], row["size"])
        target[s] = row["target"]
    due = wanted(total)
    for s in total:
        assert abs(target[s] - due[s]) < 1e-6 * max(1, due[s])
        assert abs(taken[s] - target[s]) <= most[s] / 2 + 1
    again = {x["doc_id"]: x["taken"] for x in mixing.mixed(docs.repartition(7)).collect()}
    assert again == {x["doc_id"]: x["taken"] for x in out}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = mixing.mixed(docs).collect()
    assert len(out) == len(ODD)
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mixed(docs.filter("text is null")).collect()} == {0}
