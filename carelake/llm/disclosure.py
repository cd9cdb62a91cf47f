"""Personal data, and the terms that give it away, by information-theoretic sanitisation.

Patterns find e-mail and IP addresses, cards and phone numbers. Their distinct values are the protected
entities. What stands near an entity may reveal it after it is cut out: a term t reveals an entity e by
their pointwise mutual information over the corpus,

    PMI(e; t) = log(n(e, t) * N / (n(e) * n(t)))       IC(e) = log(N / n(e))

with N distinct texts, n(e) and n(t) of them holding e or t, and n(e, t) holding t within `CONTEXT` code
points of e. PMI reaches IC where the term only ever occurs beside the entity. Terms with a PMI of at least
`DISCLOSURE` of the IC, seen together in at least `SUPPORT` distinct texts (fewer are no estimate), are
sanitised wherever they occur: generalised to their first `GENERAL` letters where some word that begins so is
too frequent to disclose (then PMI <= log(N / n(word)) is below the threshold), and else removed.

Everything is a DataFrame expression; no Python runs on executors. Matches, the gaps between them, and sums
of their lengths give all places in time proportional to the text. Texts are reduced to distinct ones first,
by two 64-bit digests, so copies count once and a large group of copies costs as much as one text. Words
are counted before they shuffle. Where sanitised terms occur is looked up by a join whose texts are first
thinned by a table of at most `BUCKETS` hash buckets, small enough to broadcast at any size of the corpus.

Defined results: NULL texts are empty, and empty ones have no spans; equal rows have equal results; columns
named `spans` or `sanitised` are replaced, others kept; an empty table gives an empty result. Very long texts
take time in proportion to their length, but `sanitised` also in proportion to its number of spans. Terms
are compared without regard to case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm import common

#: Possessive and bounded by what stands before, so that no text takes more than linear time or a deep
#: stack; the matches are those of the plain patterns. `\G` is the end of the match before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
TERM = len(PATTERNS)
_ADDRESS = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: What is not part of a term: the patterns, addresses with those that follow at once, cards with enough digits.
MASK = rf"(?<![A-Za-z0-9._%+-])(?:{_ADDRESS})++|{PATTERNS['ip']}|(?<![0-9])[0-9](?:[\x20-]?[0-9]){{12,}}+|{PATTERNS['phone']}"
WORD = r"[\p{L}\p{N}]{2,}"
_LETTER = r"[\p{L}\p{N}]"
CONTEXT, SUPPORT, DISCLOSURE, GENERAL = 100, 3, 0.9, 3
BUCKETS = 1 << 18
_KEYS = ["k1", "k2"]


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """k1, k2 and text of every distinct text that is not empty."""
    text = F.col("text").cast("string")
    return docs.select(*_keys(text), text.alias("text")).filter(F.length("text") > 0).groupBy(*_KEYS).agg(F.first("text").alias("text"))


def _words(text: Column) -> Column:
    """The words of a text in lower case, without those of personal data."""
    masked = F.when(text.rlike("@|[0-9]"), F.regexp_replace(text, MASK, " ")).otherwise(text)
    return F.regexp_extract_all(F.lower(masked), F.lit(WORD), F.lit(0))


def _pieces(text: Column, pattern: Column) -> Column:
    """The matches of a pattern, each with the text from the match before and that up to the next match."""
    matches, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    behind = F.zip_with(matches, gaps, lambda m, g: F.struct(m.alias("match"), g.alias("before")))
    every = F.zip_with(behind, F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))), lambda z, g: F.struct(z["match"].alias("match"), z["before"].alias("before"), g.alias("after")))
    return F.slice(every, 1, F.size(matches))


def _placed(pieces: DataFrame, *by: str) -> DataFrame:
    """Adds start and end, in code points, to rows with the size of the match and of the gap before it."""
    so_far = Window.partitionBy(*_KEYS, *by).orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return pieces.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number is right; the digits are given as text."""

    def add(total: Column, i: Column) -> Column:
        x = F.substr(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + (x % 10) + (x / 10).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def _mention(kind: str, context: int):
    def row(z: Column, j: Column) -> Column:
        match, before, after = z["match"], z["before"], z["after"]
        # words that the context cuts are left out
        left = F.when(F.length(before) > context, F.regexp_replace(F.right(before, F.lit(context)), f"^{_LETTER}+", "")).otherwise(before)
        right = F.when(F.length(after) > context, F.regexp_replace(F.left(after, F.lit(context)), f"{_LETTER}+$", "")).otherwise(after)
        value = F.lower(match) if kind in ("email", "ip") else F.regexp_replace(match, "[^0-9]", "")
        good = _valid(kind, match)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            j.alias("j"),
            F.length(before).alias("gap"),
            F.length(match).alias("size"),
            F.when(good, F.concat(F.lit(f"{kind}:"), value)).alias("entity"),
            F.when(good, F.array_distinct(_words(F.concat(left, F.lit(" "), right)))).alias("terms"),
        )

    return row


def mentions(texts: DataFrame, context: int = CONTEXT) -> DataFrame:
    """k1, k2, kind (its number), start, end, entity (kind and value) and terms, the words near it, of all personal data."""
    here = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    each = []
    for kind, pattern in PATTERNS.items():
        text = F.when(here.get(kind, F.col("text").rlike("[0-9]")), F.col("text")).otherwise("")
        each.append(F.transform(_pieces(text, F.lit(pattern)), _mention(kind, context)))
    rows = texts.select(*_KEYS, F.explode(F.concat(*each)).alias("m")).select(*_KEYS, "m.*")
    return _placed(rows, "kind").filter("entity IS NOT NULL").select(*_KEYS, "kind", "start", "end", "entity", "terms")


def disclosing(texts: DataFrame, found: DataFrame, support: int = SUPPORT, share: float = DISCLOSURE, general: int = GENERAL) -> DataFrame:
    """term and shown, what is to stand for it, for the terms that reveal an entity."""
    total = texts.count()
    entities = found.select(*_KEYS, "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    near = found.select(*_KEYS, "entity", F.explode("terms").alias("term")).distinct()
    near = near.groupBy("entity", "term").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= support)
    words = texts.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    words = common.staged(words.groupBy("term").agg(F.count("*").alias("n_t")))
    near = near.join(entities, "entity").join(words, "term")
    pmi = F.log(F.col("n_et") / F.col("n_e") * F.lit(total) / F.col("n_t"))
    ic = F.log(F.lit(float(total)) / F.col("n_e"))
    # an entity that is in all texts is no secret; the sum allows for rounding
    near = near.filter((F.col("n_e") < total) & (pmi + 1e-9 >= share * ic))
    least = near.groupBy("term").agg(F.min(ic).alias("ic"))
    begin = F.substring("term", 1, general)
    frequent = words.groupBy(begin.alias("begin")).agg(F.max("n_t").alias("most"))
    out = least.withColumn("begin", begin).join(frequent, "begin")
    hidden = (F.log(F.lit(float(total)) / F.col("most")) < share * F.col("ic")) & (F.length("term") > general)
    return out.select("term", F.when(hidden, F.concat("begin", F.lit("*"))).otherwise("").alias("shown"))


def _thinned(df: DataFrame, value: Column, wanted: DataFrame, wanted_value: Column) -> DataFrame:
    """The rows whose value may be among the wanted ones: some others remain, none of them is lost."""
    bucket = lambda v: F.pmod(F.xxhash64(v), F.lit(BUCKETS))
    buckets = wanted.select(bucket(wanted_value).alias("_bucket")).distinct()  # BUCKETS rows at most
    return df.withColumn("_bucket", bucket(value)).join(F.broadcast(buckets), "_bucket", "left_semi").drop("_bucket")


def occurrences(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """k1, k2, start, end and shown of every occurrence of the terms, in whatever text."""
    words = texts.select(*_KEYS, F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    held = _thinned(words, F.col("term"), terms, F.col("term")).join(terms.hint("merge"), "term")
    held = common.staged(held.groupBy(*_KEYS).agg(F.collect_list("term").alias("terms")))
    some = _thinned(texts, F.col("k1"), held, F.col("k1")).join(held.hint("merge"), _KEYS)
    # personal data is matched, too, so that no term is found inside of it
    pattern = F.concat(F.lit(rf"(?iu)(?:{MASK})|(?<!{_LETTER})(?:"), F.array_join("terms", "|"), F.lit(rf")(?!{_LETTER})"))

    def row(z: Column, j: Column) -> Column:
        return F.struct(j.alias("j"), F.length(z["before"]).alias("gap"), F.length(z["match"]).alias("size"), F.lower(z["match"]).alias("term"))

    some = some.withColumn("pattern", pattern)
    rows = some.select(*_KEYS, F.explode(F.transform(_pieces(F.col("text"), F.col("pattern")), row)).alias("m")).select(*_KEYS, "m.*")
    return _placed(rows).select(*_KEYS, "start", "end", "term").join(terms.hint("merge"), "term").drop("term")


def spans(docs: DataFrame, support: int = SUPPORT, share: float = DISCLOSURE) -> DataFrame:
    """k1, k2 and `spans` of every distinct text that has any: arrays of kind, start, end and shown, by kind, then start."""
    texts = common.staged(distinct_texts(docs))
    found = common.staged(mentions(texts))
    terms = common.staged(disclosing(texts, found, support, share))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    base = found.select(*_KEYS, "kind", "start", "end", F.get(names, F.col("kind")).alias("shown"))
    more = occurrences(texts, terms).select(*_KEYS, F.lit(TERM).alias("kind"), "start", "end", "shown")
    span = F.struct("kind", *(F.col(c).cast("long").alias(c) for c in ("start", "end")), "shown")
    return base.union(more).groupBy(*_KEYS).agg(F.array_sort(F.collect_list(span)).alias("spans"))


def scanned(docs: DataFrame, support: int = SUPPORT, share: float = DISCLOSURE) -> DataFrame:
    """The rows with `spans`, an array of kind, start, end and shown (what stands for it), by kind, then start."""
    named = F.transform("_found", lambda s: F.struct(F.get(F.array(*map(F.lit, KINDS)), s["kind"]).alias("kind"), s["start"], s["end"], s["shown"]))
    found = spans(docs, support, share).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_found"))
    own = [c for c in docs.columns if c.lower() not in ("spans", "_k1", "_k2", "_found")]
    k1, k2 = _keys(F.col("text").cast("string"))
    keyed = docs.select(*own, k1.alias("_k1"), k2.alias("_k2"))
    out = keyed.join(found.hint("merge"), ["_k1", "_k2"], "left").withColumn("_found", F.coalesce("_found", F.array().cast(found.schema["_found"].dataType)))
    return out.select(*own, named.alias("spans"))


def sanitised(docs: DataFrame, support: int = SUPPORT, share: float = DISCLOSURE) -> DataFrame:
    """The rows with `spans` and `sanitised`, the text with what is to stand for each span in its place."""
    out = scanned(docs, support, share)
    order = F.array_sort("spans", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).otherwise(1))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # where spans overlap, the later one only stands for what the one before leaves
    start = F.lit(0).cast("long")
    first = F.struct(start.alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, s: Column) -> Column:
        kept = F.substr(text, (done["at"] + 1).cast("int"), F.greatest(s["start"] - done["at"], F.lit(0)).cast("int"))
        shown = F.when(s["start"] >= done["at"], F.concat(kept, s["shown"])).otherwise("")
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["parts"], F.array(shown)).alias("parts"))

    def joined(done: Column) -> Column:
        return F.concat(F.array_join(done["parts"], ""), F.substr(text, (done["at"] + 1).cast("int"), F.length(text)))

    own = [c for c in out.columns if c.lower() != "sanitised"]
    return out.select(*own, F.aggregate(order, first, add, joined).alias("sanitised"))
