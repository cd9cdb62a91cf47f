import random
import re
import zlib
from collections import Counter

from carelake.llm import spelling
from tests.llm.data import ODD, odd_documents


def typed(doc_id, text, typos=97):
    for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
        word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
        if h % typos == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=2):
    out, form = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (n, len(close))

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, k, counts[form[w]] if form[w] else 0) for w, (n, k) in out.items())


def found(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def test_variants_equal_brute_force(spark):
    r = random.Random(1)
    counts = Counter()
    # short alphabet: runs of one letter, ties, words that are prefixes and suffixes of others
    for _ in range(500):
        counts["".join(r.choice("aabé") for _ in range(r.randint(1, 7)))] = r.choice([1, 1, 2, 3, 4, 8, 16, 40])
    counts |= {"x" * n: 2**n for n in range(1, 14)}  # a chain of forms
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(6)
    want = brute(counts)
    assert found(spelling.variants(words)) == want
    assert max(len(w) for w, *_ in want) == 13 and ("xxxxx", "xxxxxx", "x" * 13, 32, 2, 64) in want


def test_numbers_of_nodes_do_not_depend_on_ranges(spark):
    r = random.Random(2)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(400)})
    keys = spark.createDataFrame([(w,) for w in words], "key string")
    rows = spelling.trie(keys.repartition(3)).collect()
    node = {}
    for row in rows:
        for d, x in enumerate(row["nodes"], 1):
            assert node.setdefault(row["key"][:d], x) == x
        others = max(len(spelling_common(row["key"], w)) for w in words if w != row["key"])
        assert row["shared"] >= others
    assert len(set(node.values())) == len(node)
    assert [node[w] for w in words] == sorted(node[w] for w in words)


def spelling_common(a, b):
    return a[: spelling._common(a, b)]


def test_vocabulary(spark):
    r = random.Random(3)
    letters = "abcdeÀéÿ×"
    pool = ["".join(r.choice(letters) for _ in range(r.randint(3, 8))) for _ in range(60)]
    rows = [(i if i % 9 else None, " ".join(r.choice([str.title, str.upper, str])(r.choice(pool)) for _ in range(80)) + r.choice([" 12ab_cd", " Ωabcdef", "İstanbul"])) for i in range(200)]
    rows += [(7, None), (8, ""), rows[0]]
    counts = Counter(w for i, t in rows for w in typed(i, t))
    want = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()} == want
    assert found(spelling.variants(spelling.vocabulary(df))) == brute(want)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    words = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    counts = Counter(w for i, t in ODD for w in typed(i, t))
    assert words == {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3} and words
    rare = spelling.vocabulary(docs.filter("doc_id IS NULL OR doc_id < 906"), least=1)
    assert ("alone", "", "alone", 1, 0, 0) in found(spelling.variants(rare))
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0


def test_long_runs(spark):
    long = "ab" * 10_000
    counts = {long: 10, long[1:]: 4, long + "c": 5, long[:9000] + "z" + long[9001:]: 1, "short": 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.variants(words)) == brute(counts)
