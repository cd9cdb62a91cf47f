import numpy as np
from pyspark.sql import functions as F

from carelake.llm import langid, quality
from carelake.llm.queries import QUERIES
from tests.llm.data import ODD, odd_documents, prose


def test_quality_on_held_out_rows(spark):
    out = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = out.join(labels, "doc_id").filter("held_out and quality is not null").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    share = np.mean([r["quality"] for r in rows])
    assert len(rows) > 50 and right > max(share, 1 - share) + 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_tree_traversal_against_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.NAMES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.fit_trees(x, y, trees=20, depth=3)
    scores = trees.score(x)
    assert ((scores >= 0.5) == y).mean() > 0.95
    for i in range(0, 400, 37):
        margin = trees.prior
        for t in range(20):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(x[i, trees.feature[t, node]] > trees.threshold[t, node])
            margin += trees.value[t, node - 7]
        assert abs(scores[i] - 1 / (1 + np.exp(-margin))) < 1e-12


def test_quality_takes_odd_rows(spark):
    docs = odd_documents(spark)
    for labels in ([], [(904, 1), (906, 0), (None, 1), (901, None)], [(904, 1)]):
        known = spark.createDataFrame(labels, "doc_id long, quality int")
        trees = quality.fit(docs, known)
        out = quality.scored(docs, trees).collect()
        assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
        assert quality.kept(docs, trees).columns == docs.columns
        assert quality.scored(docs.limit(0), trees).count() == 0


def plain_profile(texts, size):
    counts = {}
    for text in texts:
        for n in (1, 2, 3):
            for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
                marked = f" {word} "
                for i in range(len(marked) - n + 1):
                    g = marked[i : i + n]
                    if g.strip():
                        counts[g] = counts.get(g, 0) + 1
    return counts, [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def test_language_on_held_out_rows(spark):
    out = QUERIES["op9_language"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = out.join(docs, "doc_id").filter("held_out and lang is not null and n > 200").collect()
    assert len(rows) > 50 and np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.9


def test_language_takes_odd_rows(spark):
    docs = odd_documents(spark)
    learned = spark.createDataFrame([("xx", prose(1, 300)), ("yy", "ж щ ю " * 50), (None, "q")], "lang string, text string")
    for profiles in (langid.fit(learned), langid.fit(learned.limit(0))):
        out = langid.identified(docs, profiles).collect()
        assert len(out) == len(ODD)
        for r in out:
            if not any(c.isalpha() for c in r["text"] or ""):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert langid.identified(docs.limit(0), profiles).count() == 0


def by_place(gram):
    """The order of n-grams of equal counts: by code points, shorter ones first."""
    return (0,) * (3 - len(gram)) + tuple(1 if c == " " else ord(c) + 1 for c in gram)


def plain_ranks(texts, size):
    counts, _ = plain_profile(texts, size)
    order = sorted(counts, key=lambda g: (-counts[g], by_place(g)))
    return {g: i for i, g in enumerate(order[:size])}


def test_out_of_place_distance_equals_plain_counting(spark):
    import random

    r, size = random.Random(12), 60
    letters = {"xx": "abcdefgh", "yy": "efghijkl", "zz": "ijklmnéa"}

    def text(lang):
        return " ".join("".join(r.choice(letters[lang]) for _ in range(r.randint(1, 7))).title() for _ in range(r.randint(1, 60)))

    learned = [(lang, text(lang)) for lang in letters for _ in range(30)]
    profiles = langid.fit(spark.createDataFrame(learned, "lang string, text string").repartition(4), size=size)
    ranks = {lang: plain_ranks([t for own, t in learned if own == lang], size) for lang in letters}
    asked = [text(lang) for lang in letters for _ in range(60)]
    out = langid.identified(spark.createDataFrame([(t,) for t in asked], "text string"), profiles).collect()
    for row in out:
        top = plain_ranks([row["text"]], size)
        apart = {lang: sum(abs(own[g] - i) if g in own else size for g, i in top.items()) for lang, own in ranks.items()}
        best = min(sorted(apart), key=apart.get)
        assert row["lang_pred"] == best
        assert abs(row["score"] - (1 - apart[best] / (size * len(top)))) < 1e-12
