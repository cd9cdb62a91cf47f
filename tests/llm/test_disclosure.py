import math
import random
import re
from collections import defaultdict

import pytest

from carelake.llm import disclosure
from tests.llm.data import ODD, odd_documents, prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, match):
    d = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 9 <= len(d) <= 15


def base(text):
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m[0]):
                yield kind, m.start(), m.end()


def masked(text):
    card = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}"
    return re.sub("|".join([PLAIN["email"], PLAIN["ip"], card, PLAIN["phone"]]), " ", text)


def words(text):
    return re.findall(r"[^\W_]{2,}", masked(text).lower())


def brute(texts, context=100, support=3, share=0.9):
    """Spans of each text by plain loops over all texts."""
    texts = {t for t in texts if t}
    holds, near, total = defaultdict(set), defaultdict(set), len(texts)
    every = defaultdict(set)
    for t in texts:
        for w in set(words(t)):
            every[w].add(t)
        for kind, pattern in PLAIN.items():
            found = list(re.finditer(pattern, t))
            for i, m in enumerate(found):
                if not valid(kind, m[0]):
                    continue
                entity = (kind, m[0].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", m[0]))
                left = t[found[i - 1].end() if i else 0 : m.start()]
                right = t[m.end() : found[i + 1].start() if i + 1 < len(found) else len(t)]
                left = re.sub(r"^[^\W_]+", "", left[-context:]) if len(left) > context else left
                right = re.sub(r"[^\W_]+$", "", right[:context]) if len(right) > context else right
                holds[entity].add(t)
                for w in words(left + " " + right):
                    near[entity, w].add(t)
    terms = set()
    for (e, w), both in near.items():
        if len(both) >= support and w in every and len(holds[e]) < total:
            pmi = math.log(len(both) * total / (len(holds[e]) * len(every[w])))
            if pmi + 1e-9 >= share * math.log(total / len(holds[e])):
                terms.add(w)
    card = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}"
    mask = "|".join([PLAIN["email"], PLAIN["ip"], card, PLAIN["phone"]])
    out = {}
    for t in texts:
        found = [("term", m.start(), m.end()) for m in re.finditer(rf"(?:{mask})|[^\W_]+", t) if m[0].lower() in terms]
        out[t] = [*base(t), *found]
    return out, terms


def spans(row):
    return [(s["kind"], s["start"], s["end"]) for s in row["spans"]]


def corpus():
    r = random.Random(5)
    rows = []
    for i in range(300):
        text = prose(i, 60)
        if i % 10 == 0:
            who = i % 30
            text = f"{prose(i + 1000, 9)} Zarathustra{who} of Quxborough{who} wrote from mail{who}@host.example.com or +49 (30) 5550-0{who:02} {text}"
        if i % 25 == 0:
            text += " 4111 1111 1111 1111, 10.0.0.7 and 300.1.1.1, 4111 1111 1111 1112"
        if i % 60 == 3:
            text += f" as Zarathustra{r.choice([0, 10, 20])} said"
        rows.append((i, text))
    # copies are no evidence: the words beside this address are in one text only
    rows += [(1000 + i, f"{prose(7000, 30)} solitaryword once@copy.example.org {prose(7001, 30)}") for i in range(50)]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    rows += [(None, None), (1, ""), (2, "a@b.c%d@e.f, 1.2.3.4.5.6.7.8 and 0001.002.3.255 +1 2 3 4 5 6 7 8 9"), (3, "é𝄞 x@y.zz 𝄞 +12345678901")]
    want, terms = brute([t for _, t in rows])
    assert {"zarathustra0", "quxborough20"} <= terms and "solitaryword" not in terms
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = disclosure.scanned(df).collect()
    assert len(out) == len(rows)
    for row in out:
        assert spans(row) == want.get(row["text"], []), row["text"]
    # found where the entity is not
    assert any(s["kind"] == "term" for row in out for s in row["spans"] if row["doc_id"] in (3 + 60 * k for k in range(5)))


def test_terms_are_generalised_or_removed(spark):
    rows = [(i, f"Common commoners {prose(i, 20)}") for i in range(200)]
    rows += [(500 + i, f"{prose(900 + i, 5)} Comrade Xyzzy one@x.example.com {prose(300 + i, 5)}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in disclosure.sanitised(df).collect()}
    shown = {s["shown"] for s in out[500]["spans"]}
    assert {"com*", "", "[EMAIL]"} <= shown
    assert "com*  [EMAIL]" in out[500]["sanitised"] and "xyzzy" not in out[500]["sanitised"].lower()
    assert out[7]["sanitised"] == out[7]["text"] and out[7]["spans"] == []


def test_overlaps_are_cut_once(spark):
    df = spark.createDataFrame([(1, "call +4111111111111111 x"), (2, "a +411 1111 1111 1111 1 b 4111-1111-1111-1111")], "doc_id long, text string")
    for row in disclosure.sanitised(df).collect():
        assert not re.search("[0-9]", row["sanitised"]), row
        assert spans(row) == list(base(row["text"]))


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1.2." * 50_000, "+1" + " " * 100_000, "a.b@" * 50_000, "x@" + "a." * 100_000, "1-" * 100_000, "+1 " * 50_000, "7.7.7.7 " * 3_000])
def test_long_texts_take_linear_time(spark, text):
    out = disclosure.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    want = [(m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)] if "." in text and "@" not in text else None
    if want is not None:
        assert [s[1:] for s in spans(out[0]) if s[0] == "ip"] == want


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "'own' AS spans", "'own' AS sanitised", "1 AS _found")
    out = disclosure.sanitised(docs).collect()
    assert len(out) == len(ODD)
    assert all(r["spans"] == [] and r["sanitised"] == (r["text"] or "") and r["kind"] == "own" for r in out)
    assert disclosure.sanitised(docs.limit(0)).count() == 0


def test_runs_in_the_jvm(spark):
    df = spark.createDataFrame(corpus()[:20], "doc_id long, text string")
    plan = disclosure.scanned(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
