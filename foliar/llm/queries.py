"""Registered queries of this package: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.llm import decontaminate, divergence, hard_negatives, html_text, language_id, line_dedup, minhash_dedup, mixing, pii, quality_rules, suffix_dedup, toxicity, warc
from foliar.llm._jobs import labelled_sample, narrow, read, stored

# Target shares of the mixture: languages of good quality, and what the labels call low quality.
TARGETS = {"en": 0.50, "de": 0.16, "es": 0.14, "fr": 0.16, "low": 0.04}


def _fold(by: int, fold: int):
    """Is a row in the held-out fold of its id?"""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(by)) == fold, F.lit(False))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")), detail=True)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stored(quality_rules.text_counts(read(spark, sf_dir, "documents")), "counts")
    rules = quality_rules.fit(counts, read(spark, sf_dir, "labels"))
    return quality_rules.judge(counts, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    texts, rates, domains = mixing.mix(docs, mixing.labelled_domains(docs, read(spark, sf_dir, "labels")), TARGETS)
    named = F.map_from_arrays(F.array(*[F.lit(d) for d in domains]).cast("array<string>"), F.transform("p", lambda x: F.round(x, 6)))
    best = F.array_max(F.transform(F.map_entries("m"), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))))["k"]
    return (
        texts.select("row", F.col("id").alias("doc_id"))
        .join(rates.withColumn("m", named), "row")
        .select("doc_id", "tokens", best.alias("domain"), "rate", mixing.copies().alias("copies"))
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    samples = language_id.dictionaries(narrow(docs.where(~_fold(3, 1)), id="doc_id", text="text", lang="lang"))
    return language_id.identify(docs, samples).select("doc_id", _fold(3, 1).alias("held_out"), "lang_pred", "score", "rejected")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = narrow(read(spark, sf_dir, "labels"), id="doc_id", toxic="toxic").where("toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    labelled = labelled_sample(narrow(docs.where(~_fold(4, 2)), id="doc_id", text="text"), labels, toxicity.SAMPLE_ROWS)
    scored = toxicity.score(docs, *toxicity.fit(labelled))
    return scored.select("doc_id", _fold(4, 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.round_trip(spark, pages)
    return records.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", F.round("similarity", 6).alias("similarity"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("id") % 100 == 0)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_line_dedup, op3_quality_rules, op4_html_extraction, op5_source_mixing,
        op6_minhash_near_dedup, op7_language_id, op8_toxicity, op9_warc, op10_decontamination, op11_personal_data, op12_hard_negatives, op13_source_divergence,
    )
}

SQL_TEXT: dict[str, str] = {
    "op9_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
        ), f AS (
            SELECT d, max(page_id) AS r FROM p WHERE n >= 1000 GROUP BY d
        )
        SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
               CASE WHEN f.r IS NULL OR f.r = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN f.r <> p.page_id THEN f.r END AS refers_to
        FROM p LEFT JOIN f ON p.d = f.d
    """,
    "op10_decontamination": """
        WITH RECURSIVE iw AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\v\\f\\r]+'), lambda w: w <> '') AS w FROM benchmark
        ), i AS (
            SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM iw WHERE len(w) > 0
        ), dw AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\v\\f\\r]+'), lambda w: w <> '') AS w FROM documents
        ), ish AS (
            SELECT item_id, n, k, h, count(*) AS c FROM (
                SELECT item_id, n, k, unnest([array_to_string(w[j:j + k - 1], ' ') for j in range(1, n - k + 2)]) AS h FROM i
            ) GROUP BY ALL
        ), ks AS (
            SELECT DISTINCT k FROM i
        ), dsh AS (
            SELECT doc_id, k, len(w) AS total, unnest(range(0, len(w) - k + 1)) AS p,
                   unnest([array_to_string(w[j:j + k - 1], ' ') for j in range(1, len(w) - k + 2)]) AS h
            FROM dw, ks WHERE len(w) >= k
        ), hit AS (
            SELECT d.doc_id, d.k, d.total, d.p, d.h, s.item_id, s.n, s.c FROM dsh d JOIN ish s ON d.k = s.k AND d.h = s.h
        ), win AS (
            SELECT doc_id, item_id, n, k, h, c, unnest(range(greatest(0, p - (n - k)), least(p, total - n) + 1)) AS s FROM hit
        ), both_counts AS (
            SELECT doc_id, item_id, n, k, s, sum(m) AS b FROM (
                SELECT doc_id, item_id, n, k, s, h, least(count(*), any_value(c)) AS m FROM win GROUP BY doc_id, item_id, n, k, s, h
            ) GROUP BY ALL
        ), best AS (
            SELECT *, b / (2 * (n - k + 1) - b) AS sim,
                   row_number() OVER (PARTITION BY doc_id, item_id ORDER BY b DESC, s) AS place
            FROM both_counts WHERE 175 * b >= 150 * (n - k + 1)
        )
        SELECT doc_id, item_id, s AS start_word, n AS n_words, round(sim, 6) AS similarity FROM best WHERE place = 1
    """,
    "op12_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), pos AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        ), neg AS (
            SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
            FROM pos p JOIN s ON s.anchor_id = p.anchor_id
            WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
        )
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5
    """,
    "op13_source_divergence": """
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
        ), t AS (
            SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
        ), kept AS (
            SELECT lang, term, count(*) AS nl FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
        ), lt AS (
            SELECT lang, count(*) AS v, sum(nl) AS total FROM kept GROUP BY lang
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), c AS (
            SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL
        ), gt AS (
            SELECT lang, source, sum(n) AS total FROM c JOIN kept USING (lang, term) GROUP BY ALL
        ), p AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (coalesce(gt.total, 0) + lt.v)::HUGEINT AS p,
                   1 + (1000000000 * (k.nl + 1)::HUGEINT) // (lt.total + lt.v)::HUGEINT AS q
            FROM g JOIN kept k ON g.lang = k.lang JOIN lt ON g.lang = lt.lang
            LEFT JOIN gt ON g.lang = gt.lang AND g.source = gt.source
            LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
        ), pair AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
}
