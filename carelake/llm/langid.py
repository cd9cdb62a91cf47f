"""Language identification by rank-order profiles of character n-grams (out-of-place distance).

A profile is the `size` most frequent n-grams (1 to 3 characters of the lower-cased letters, words marked
at both ends) of all learnable texts of a language. A document's own most frequent n-grams are compared
with each profile: the distance adds up how far each n-gram is out of place, `size` where the profile
lacks it. Ties in frequency go by code points, ties in distance to the language first by code point.

NULL texts and texts without a letter are `und` with score 0; so is every text when nothing could be
learned. Columns `lang_pred` and `score` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import common

SIZE = 300
#: Languages that a set of profiles may hold; more is an error. It bounds what the driver gets.
MAX_LANGUAGES = 1000
#: Distinct n-grams a task gathers before it hands them on.
_HELD = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the distinct n-grams, ascending, and their counts; an n-gram is three 21-bit places."""
    texts = pc.fill_null(pc.utf8_lower(column.cast(pa.large_string())), "").to_pylist()
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    letter = _letters()[points]
    keep = letter | np.concatenate(([True], letter[:-1]))  # of other characters only the first after a letter
    borders = np.concatenate(([0], np.cumsum(lengths + 1)))  # the line feeds around the texts
    keep[borders] = True
    places = np.where(letter, points, 0)[keep]
    first = (np.cumsum(keep) - 1)[borders]
    # each character becomes a digit of base n: 0 for none, 1 for the mark at a word's ends, then letters
    found = np.flatnonzero(np.bincount(places))
    digit = np.zeros(int(found[-1]) + 1, np.int64)
    digit[found] = np.arange(1, len(found) + 1)
    one, n = digit[places], len(found) + 1
    two = one[:-1] * n + one[1:]
    three = two[:-1] * n + one[2:]
    kind = np.int32 if n**3 < 2**31 else np.int64
    mark = one == 1
    two_ok, three_ok = ~(mark[:-1] & mark[1:]), ~mark[1:-1]
    value = np.concatenate(([0], found + 1))
    out = []
    for a, b in zip(first[:-1], first[1:] + 1, strict=True):
        codes = [one[a:b][~mark[a:b]], two[a : b - 1][two_ok[a : b - 1]], three[a : b - 2][three_ok[a : b - 2]]]
        codes, counts = np.unique(np.concatenate(codes).astype(kind), return_counts=True)
        codes = codes.astype(np.int64)
        out.append(((value[codes // (n * n)] << 42) | (value[codes // n % n] << 21) | value[codes % n], counts))
    return out


def counted(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all texts that have a language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(lists):
            codes, at = np.unique(np.concatenate([c for c, _ in lists]), return_inverse=True)
            return codes, np.bincount(at, np.concatenate([n for _, n in lists])).astype(np.int64)

        def out():
            for lang, lists in held.items():
                codes, n = merged(lists)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(n)], ["lang", "gram", "n"])

        for part in common.slices(batches):
            for lang, found in zip(part.column("lang").to_pylist(), grams(part.column("text")), strict=True):
                held.setdefault(lang, []).append(found)
            held = {lang: [merged(lists)] for lang, lists in held.items()}
            if sum(len(lists[0][0]) for lists in held.values()) > _HELD:
                yield from out()
                held = {}
        yield from out()

    texts = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    texts = texts.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Profiles:
    """Languages by code point; `rank[l, g]` is the place of n-gram g in profile l, `size` where it lacks."""

    langs: list[str]
    gram: np.ndarray
    rank: np.ndarray
    size: int

    def predict(self, codes: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = codes[np.lexsort((codes, -counts))[: self.size]]
        at = np.minimum(np.searchsorted(self.gram, top), len(self.gram) - 1)
        ranks = np.where(self.gram[at] == top, self.rank[:, at], self.size)
        apart = np.where(ranks < self.size, np.abs(ranks - np.arange(len(top))), self.size).sum(axis=1)
        best = int(apart.argmin())
        return self.langs[best], float(1 - apart[best] / (self.size * len(top)))


def fit(docs: DataFrame, size: int = SIZE, max_languages: int = MAX_LANGUAGES) -> Profiles:
    """The profiles of all languages of the documents; a whole count, no sample."""
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted(docs).withColumn("rank", F.row_number().over(first) - 1).filter(F.col("rank") < size)
    rows = ranked.select("lang", "gram", "rank").limit(max_languages * size + 1).collect()
    langs = sorted({r["lang"] for r in rows})
    if len(langs) > max_languages or len(rows) > max_languages * size:
        raise ValueError(f"more than {max_languages} languages")
    gram = np.unique(np.array([r["gram"] for r in rows], np.int64))
    rank, at = np.full((len(langs), len(gram)), size), {lang: i for i, lang in enumerate(langs)}
    for r in rows:
        rank[at[r["lang"]], np.searchsorted(gram, r["gram"])] = r["rank"]
    return Profiles(langs, gram, rank, size)


def identified(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The documents with `lang_pred` and `score`, 1 less the distance as a share of the greatest possible."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(text: pa.Array) -> pa.Array:
        found = [
            profiles.predict(*g)
            for s in common.slices([pa.RecordBatch.from_arrays([text], ["text"])])
            for g in grams(s.column(0))
        ]
        columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
        return pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

    found = docs.withColumn("lang_pred", of(F.col("text").cast("string")))
    return found.withColumn("score", F.col("lang_pred.score")).withColumn("lang_pred", F.col("lang_pred.lang_pred"))


def learnable(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from: three quarters by a checksum of the id."""
    return docs.filter(common.crc_bucket(F.col("doc_id"), 4) != 2)
