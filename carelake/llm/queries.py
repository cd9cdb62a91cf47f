"""The corpus queries: each applies one operator to its whole table with the operator's defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import centroids, chat, common, decontam, disclosure, langid, licenses, mixing, ngram_join, quality, secret_scan, spelling, spotsigs, suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is any."""

    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


@query(
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) < 5 THEN list_filter([array_to_string(w, ' ')], lambda s: s <> '')
            ELSE list_distinct(list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) END AS s
        FROM words
    ), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) * 10 >= 8 * (a.n + b.n - count(*))
    ), reached AS (
        SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
    ), digests AS (SELECT doc_id, list_sort(s) AS s FROM sets)
    SELECT d.doc_id, least(d.doc_id, coalesce(r.y, d.doc_id)) AS class_id, coalesce(l.n, 0) AS n_links, c.n AS n_copies
    FROM digests d
    LEFT JOIN (SELECT x, min(y) AS y FROM reached GROUP BY x) r ON r.x = d.doc_id
    LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) l ON l.x = d.doc_id
    JOIN (SELECT doc_id, CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY s) END AS n FROM digests) c
        ON c.doc_id = d.doc_id
    """
)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.joined(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "n_links", "n_copies")


@query()
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scanned(docs, secret_scan.fit(docs)).select("doc_id", "secrets")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).eqNullSafe)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS]
    digest = F.sha2(joined(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts[:3], digest, joined(F.col("secrets")).alias("spans"), counts[3])


@query(
    r"""
    WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    windows AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 800)) AS w FROM raw, range(0, n - 399) AS r(i) WHERE n >= 400),
    repeated AS (SELECT doc_id, i FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)),
    marked AS (
        SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM repeated
    ), numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
    spans AS (SELECT doc_id, k, min(i) AS low, max(i) + 400 AS high FROM numbered GROUP BY doc_id, k),
    before AS (SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS prior FROM spans),
    pieces AS (
        SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS tail,
            string_agg(substr(x, 2 * prior + 1, 2 * (low - prior)), '' ORDER BY low) AS kept
        FROM before JOIN raw USING (doc_id) GROUP BY doc_id
    )
    SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
        sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
    FROM raw LEFT JOIN pieces USING (doc_id)
    """
)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.deduplicated(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("size").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), marks AS (
        SELECT *, length(text) + length(regexp_replace(text, '[^\\<\[\]]', '', 'g')) AS escaped,
            CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 8
                ELSE 16 + length(role) + length(regexp_replace(role, '[^\\<\[\]]', '', 'g')) END AS around
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(3 + sum(escaped + around) AS BIGINT) AS formatted_chars,
        regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'o' END, ''
            ORDER BY turn NULLS LAST, role, text), 's?(ua)+') AS valid
    FROM marks GROUP BY conv_id
    """
)
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digests(chat.formatted(turns.union(added)))


@query()
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda f: f["license"])))
    spans = F.transform("licenses", lambda f: F.concat_ws(":", f["license"], f["start"], f["end"]))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"), F.array_join(spans, ",").alias("spans")
    )


@query()
def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_next(common.table(spark, sf_dir, "documents"))


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (common.table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontam.found(docs, benchmark)


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    trees = quality.fit(docs, quality.learnable(common.table(spark, sf_dir, "labels")))
    out = quality.scored(docs.select("doc_id", "text"), trees)
    held_out = (common.crc_bucket(F.col("doc_id"), 3) == 1).alias("held_out")
    return out.select("doc_id", held_out, "score", "predicted")


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = langid.identified(docs.select("doc_id", "text"), langid.fit(langid.learnable(docs)))
    held_out = (common.crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out")
    return out.select("doc_id", held_out, "lang_pred", "score")


def _clustering_sql() -> str:
    parts = [
        """v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, e FROM v
            ORDER BY sha256('2:' || vec_id) LIMIT 40)""",
    ]
    for r in range(6):
        parts.append(
            f"""a{r} AS MATERIALIZED (
            SELECT vec_id, v.e, min(list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) * 64 + k) AS best
            FROM v, c{r} c GROUP BY vec_id, v.e)"""
        )
        if r < 5:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
            SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
                SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM (
                    SELECT best % 64 AS k, i, sum(x) AS s, count(*) AS n
                    FROM (SELECT best, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{r}) GROUP BY best % 64, i
                ) GROUP BY k) m ON m.k = c.k)"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + """ SELECT vec_id, CAST(best % 64 AS INTEGER) AS cluster, CAST(best // 64 AS BIGINT) AS distance,
            CAST(sum(best // 64) OVER (PARTITION BY best % 64) AS BIGINT) AS cluster_inertia,
            CAST(sum(best // 64) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.e, ',')) AS centroid_sha256
        FROM a5 JOIN c5 ON c5.k = best % 64"""
    )


@query(_clustering_sql())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, found = centroids.clustered(common.table(spark, sf_dir, "embeddings"))
    return out.withColumn("centroid_sha256", centroids.digests(found))


@query(
    r"""
    WITH RECURSIVE step8 AS (
        SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
        FROM (SELECT unnest(range(256)) AS b)
    ), crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM step8),
    runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
    lowered AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM runs GROUP BY ALL
    ), hexed AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM lowered),
    hashed AS (
        SELECT w, n, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
        FROM hexed, crc
    ), typed AS (
        SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed
    ), words AS MATERIALIZED (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
    ), skips AS MATERIALIZED (
        SELECT word, n, unnest(range(length(word))) AS i, substr(word, 1, i) AS a, substr(word, i + 2) AS z FROM words
    ), near AS (
        SELECT x.word, y.word AS other, y.n AS m FROM skips x JOIN skips y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
        UNION SELECT x.word, w.word, w.n FROM skips x JOIN words w ON w.word = x.a || x.z
        UNION SELECT w.word, x.word, x.n FROM skips x JOIN words w ON w.word = x.a || x.z
    ), best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word),
    forms AS MATERIALIZED (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
        FROM words LEFT JOIN best USING (word)
    ), chain AS (
        SELECT word, word AS root, 0 AS steps FROM forms
        UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
    )
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word) USING (word)
    """
)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(common.table(spark, sf_dir, "documents")))


@query()
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.scanned(common.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "term")
    counts = [of(kind) for kind in disclosure.KINDS]
    return found.select("doc_id", *counts[:-1], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), counts[-1])
