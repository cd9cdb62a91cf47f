import random
import re

import pyarrow as pa
import pytest

from carelake.llm import licenses, secret_scan
from tests.llm.data import ODD, odd_documents, prose

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24])


def planted(seed):
    r = random.Random(seed)
    secret = "".join(r.choice("0123456789abcdefABCDEFGHJK") for _ in range(32))
    forms = ["Token = '%s'", "api_key:%s", "passwd=%s;", "AKIA" + secret.upper()[:17], "%x" % r.getrandbits(160), "password: abc", "ſecret=%s"]
    form = forms[seed % len(forms)]
    return f"é{prose(seed, 60)} {form % secret if '%' in form else form} {prose(seed + 1, 40)}"


@pytest.fixture(scope="module")
def scanned(spark):
    docs = spark.createDataFrame([(i, planted(i)) for i in range(140)], "doc_id long, text string")
    field = secret_scan.fit(docs)
    return docs, field, secret_scan.scanned(docs, field).collect()


def test_base_spans_against_plain_patterns(scanned):
    for row in scanned[2]:
        got = [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in row["secrets"]]
        assert got == sorted(got)
        assert [s for s in got if s[1] < 3] == base(row["text"])
        own = [s for s in got if s[1] == 3]
        assert all(e <= a or s >= b for s, _, e in own for a, k, b in got if k < 3)


def test_redaction_leaves_no_secret_and_all_other_text(scanned):
    docs, field, found = scanned
    new = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs, field).collect()}
    for row in found:
        assert not base(new[row["doc_id"]].replace("[SECRET]", " "))
        spans = [(s["start"], 0, s["end"]) for s in row["secrets"]]
        assert new[row["doc_id"]] == secret_scan.redacted_text(row["text"], spans, "[SECRET]")
    assert sum(len(r["secrets"]) > 0 for r in found) >= 100


FORMS = ("client_credential = \"%s\"", "Authorization: Bearer %s", "pwd: %s", "ghp_%s", "auth_key=%s", "private-key: %s", "passphrase = '%s'")


@pytest.fixture(scope="module")
def field(spark):
    rows = [planted(i) for i in range(600)] + [prose(i, 150) for i in range(5000, 5600)]
    return secret_scan.fit(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4))


def test_the_field_finds_what_the_rules_do_not(field):
    r = random.Random(8)
    letters = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for form in FORMS:
        values = ["".join(r.choice(letters) for _ in range(r.randint(24, 40))) for _ in range(50)]
        texts = [f"{prose(i, 40)} {form % v} {prose(i + 99, 40)}" for i, v in enumerate(values)]
        assert not any(base(t) for t in texts)
        spans = secret_scan.spans_of(pa.array(texts), field)
        hit = sum(any(t[a:b].endswith(v) for a, _, b in own) for t, v, own in zip(texts, values, spans, strict=True))
        # a bare value between words that the field only knows from prose is hard to tell: see the README
        assert hit >= (5 if form.startswith("ghp_") else 40), (form, hit)
    clean = [f"{prose(i, 150)} call 555-0{i % 100:02} or write to someone.{i}@mail.example.com" for i in range(300)]
    assert sum(len(s) for s in secret_scan.spans_of(pa.array(clean), field)) <= 3


def test_runs_decode_like_the_whole_chain(field):
    """Viterbi over the runs that are not surely outside gives the tags of the best path of the whole text."""
    r = random.Random(9)
    texts = [planted(i) for i in range(100)] + [f"{prose(i, 30)} {FORMS[i % 7] % hex(r.getrandbits(130))} {prose(i, 9)}" for i in range(100)]
    for text in texts:
        data, offsets = secret_scan.common.utf8(pa.array([text]))
        starts, ends, firsts = secret_scan.tokens(data, offsets)
        places = secret_scan.features(data, starts, ends, firsts)
        emissions = field.weights[places].sum(axis=1)
        emissions[:, secret_scan.OUTSIDE] += secret_scan.CAUTION
        tags, whole = [*field.decode(emissions), secret_scan.OUTSIDE], []
        for i, tag in enumerate(tags[:-1]):
            if tag == secret_scan.BEGIN:
                end = next(j for j in range(i + 1, len(tags)) if tags[j] != secret_scan.INSIDE)
                whole.append((i, end - 1))
        assert field.spans(places, firsts) == whole


def test_viterbi_against_all_sequences():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    steps = rng.normal(size=(3, 3))
    steps[2, 1] = -1e4
    field = secret_scan.Field(np.zeros((1, 3)), steps)
    for _ in range(20):
        e = rng.normal(size=(6, 3)) * 2

        def score(tags):
            if tags[0] == 1:
                return -np.inf
            return sum(e[i, t] for i, t in enumerate(tags)) + sum(steps[a, b] for a, b in zip(tags, tags[1:]))

        assert field.decode(e) == list(max(itertools.product(range(3), repeat=6), key=score))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert secret_scan.fit(docs) is None and secret_scan.fit(docs.limit(0)) is None
    for field in (None, secret_scan.train(*_small())):
        out = secret_scan.redacted(docs, field)
        assert out.columns == docs.columns and out.count() == len(ODD)
        assert secret_scan.scanned(docs, field).count() == len(ODD)
    found = licenses.scanned(docs).collect()
    assert len(found) == len(ODD) and not any(r["licenses"] for r in found)
    assert licenses.scanned(docs.limit(0)).count() == 0


def _small():
    import numpy as np

    rng = np.random.default_rng(0)
    places = rng.integers(0, 8, (4, secret_scan.SEGMENT, secret_scan.N_FEATURES)) + secret_scan._BEGINS
    return places, np.full((4, secret_scan.SEGMENT), secret_scan.OUTSIDE), np.ones((4, secret_scan.SEGMENT)), 2


def test_licenses_are_found_by_their_own_texts(spark):
    names = [t.name for group in licenses.templates().values() for t in group]
    assert names and len(set(names)) == len(names)


def test_the_field_learns_from_distinct_segments(spark):
    seen = []

    def fit(docs, *most):
        seen.append(secret_scan.padded(secret_scan.examples(docs, *most).toArrow())[:2])

    rows = [planted(0)] * 200 + [planted(i) for i in range(1, 60)] + [prose(9, 80)] * 200 + [prose(i, 80) for i in range(10, 40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(6)
    fit(docs)
    places, tags = seen[0]
    assert len({p.tobytes() + t.tobytes() for p, t in zip(places, tags)}) == len(places)
    labelled = sum(bool((t == secret_scan.BEGIN).any()) for t in tags)
    assert labelled >= 40 and len(tags) - labelled >= 31
    # the bound is one of distinct segments, the same ones however the rows are dealt
    fit(docs, 20)
    fit(docs.repartition(2), 20)
    assert len(seen[1][0]) == 40 and (seen[1][0] == seen[2][0]).all() and (seen[1][1] == seen[2][1]).all()


def test_siblings_are_told_apart():
    texts = licenses.TEMPLATES | {f"{n}-text": licenses.pkgutil.get_data("carelake.llm", f"license_texts/{n}.txt").decode() for n in licenses.TEXTS}
    names = list(texts)
    around = [f"é{prose(i, 30)}. {texts[n]} {prose(i + 1, 30)}" for i, n in enumerate(names)]
    for name, text, own in zip(names, around, licenses.finds(pa.array(around)), strict=True):
        assert [f[0] for f in own] == [name]
        assert own[0][1] == 1.0
    # one after the other, each has its own find
    pairs = [("bsd-3-clause", "bsd-2-clause"), ("gpl-2.0-header", "gpl-3.0-header"), ("isc", "isc"), ("lgpl-2.1-header", "agpl-3.0-header")]
    after = [f"{texts[a]} {prose(3, 12)} {texts[b]}" for a, b in pairs]
    for pair, own in zip(pairs, licenses.finds(pa.array(after)), strict=True):
        assert [f[0] for f in own] == list(pair)
    many = licenses.finds(pa.array([f"{texts['mit']} {prose(5, 2)} " * 50 + f"{texts['isc']} " * 7]))[0]
    assert [f[0] for f in many] == ["mit"] * 50 + ["isc"] * 7
