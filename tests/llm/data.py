"""Texts for the corpus tests."""

import random

WORDS = ["".join(random.Random(i).choice("abcdefghijklmnop") for _ in range(3 + i % 6)) for i in range(3000)]


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return [r.choice(WORDS) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    return " ".join(words(seed, n))


#: Rows that every operator takes: NULLs, empty and long texts, repeated rows and ids.
ODD = [(None, None), (None, "alone without an id"), (900, None), (901, ""), (902, " \n\t"), (903, "..."), (904, "x"), (904, "x"), (905, "é" * 50), (906, prose(906, 30_000))]


def odd_documents(spark):
    """The odd rows with columns whose names operators use inside or return."""
    clashing = "k1 k2 key size digit whole score predicted lang_pred leaks _leaks secrets licenses taken target row h block n range kind _k1 _redacted _n"
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "s", None) for k, (i, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"'own' AS {c}" for c in clashing.split()))
