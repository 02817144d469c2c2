"""Mixing to target weights with soft membership, with DataFrame functions only.

A naive Bayes classifier over the most frequent words of a bounded labelled
sample gives every text posterior probabilities of the domains. Rates >= 0 are
fitted to all texts so that the expected tokens of a domain, the sum over texts
of rate * tokens * posterior, match its target share of the budget. This is
least squares, each domain's squared miss divided by its tokens at rate one,
solved by projected gradient steps scaled by 1 / tokens per text: with this
scaling a step of one is always stable (the step matrix has column sums of one)
and hits the targets at once where memberships are certain. A text's rate
depends on its own posterior and on the steps so far, so a step is one grouped
sum over a narrow stored table; the driver sees one number per domain.

Missing and empty texts have no tokens, the prior as posterior and take part
with a rate. Domains without labelled rows cannot be predicted; their share goes
to the others in proportion. Without any labelled row all rates are one. Rows
that repeat an id are texts of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import keyed, labelled_sample, narrow, stored
from foliar.session import small_table

SAMPLE_ROWS = 4_000
FEATURE_WORDS = 3_000
MAX_DOMAINS = 100
STEPS = 30
TOLERANCE = 1e-3
SEPARATOR = "[ \t\n\u000b\f\r]+"


def _words(text: str) -> Column:
    return F.explode(F.split(text, SEPARATOR)).alias("word")


def classifier(labelled: DataFrame, feature_words: int = FEATURE_WORDS) -> tuple[list[str], list[float], DataFrame]:
    """Domains, their log priors, and a table (word, p) with one log probability per domain, from rows (id, text, domain)."""
    spark = labelled.sparkSession
    sample = stored(labelled.where("domain is not null").select("id", "text", F.col("domain").cast("string").alias("domain")), "mix-sample")
    found = sample.groupBy("domain").count().orderBy("domain").limit(MAX_DOMAINS + 1).collect()
    if len(found) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    domains, total = [r["domain"] for r in found], sum(r["count"] for r in found)
    if not domains:
        return [], [], small_table(spark, "word string, p array<double>", [])
    # Repeated words of one text are one piece of evidence: count texts, not words.
    seen = sample.select("id", "domain", _words("text")).where("word <> ''").distinct()
    counts = seen.groupBy("word").agg(F.count("*").alias("n"), *[F.count_if(F.col("domain") == d).alias(f"c{i}") for i, d in enumerate(domains)])
    top = counts.orderBy(F.desc("n"), "word").limit(feature_words)
    size = {d: r["count"] for d, r in zip(domains, found)}
    table = top.select("word", F.array(*[F.log((F.col(f"c{i}") + 0.1) / (size[d] + 1.0)) for i, d in enumerate(domains)]).alias("p"))
    return domains, [math.log(size[d] / total) for d in domains], stored(table, "mix-words")


def posteriors(texts: DataFrame, domains: list[str], priors: list[float], table: DataFrame) -> DataFrame:
    """(row, tokens, p) for texts (row, text): tokens are words, p has one probability per domain."""
    each = texts.select("row", _words("text")).where("word <> ''")
    # ``table`` has at most FEATURE_WORDS rows.
    scored = each.join(F.broadcast(table), "word", "left").groupBy("row").agg(F.count("*").alias("tokens"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(len(domains))])
    logits = [F.coalesce(f"s{i}", F.lit(0.0)) + F.lit(prior) for i, prior in enumerate(priors)]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = texts.select("row").join(scored, "row", "left").select("row", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.array(*[F.exp(x - top) for x in logits]).alias("e"))
    whole = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return parts.withColumn("whole", whole).select("row", "tokens", F.transform("e", lambda x: x / F.col("whole")).alias("p"))


def rate(steps: list[list[float]]) -> Column:
    """A text's rate after the given steps: each takes its posterior-weighted part off, but not below zero."""
    out = F.lit(1.0)
    if not steps:
        return out
    table = F.array(*[F.array(*[F.lit(float(u)) for u in step]) for step in steps])
    dot = lambda u: F.aggregate(F.zip_with("p", u, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(table, out, lambda r, u: F.greatest(F.lit(0.0), r - dot(u)))


def fit_rates(members: DataFrame, goals: list[float], steps: int = STEPS, tolerance: float = TOLERANCE) -> list[list[float]]:
    """Projected gradient steps that bring the expected tokens of (tokens, p) to the goals."""
    n = len(goals)
    done: list[list[float]] = []
    size: list[float] | None = None
    for _ in range(steps + 1):
        weighted = members.select((rate(done) * F.col("tokens")).alias("w"), "p")
        got = weighted.agg(*[F.coalesce(F.sum(F.col("w") * F.col("p")[i]), F.lit(0.0)) for i in range(n)]).collect()[0]
        size = size or [max(float(x), 1e-9) for x in got]
        if all(abs(g - x) <= tolerance * max(g, 1e-9) for g, x in zip(goals, got)) or len(done) == steps:
            break
        done.append([(x - g) / s for x, g, s in zip(got, goals, size)])
    return done


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, list[str]]:
    """Keyed texts, one row (row, tokens, p, rate) per text, and the domains in the order of p.

    ``targets`` are shares per domain, ``budget`` the expected tokens of the
    mixture (by default as many as there are).
    """
    texts = keyed(docs, id_col, text_col)
    domains, priors, table = classifier(labelled)
    if not domains:
        each = texts.select("row", _words("text")).where("word <> ''").groupBy("row").agg(F.count("*").alias("tokens"))
        plain = texts.select("row").join(each, "row", "left").select("row", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.array().cast("array<double>").alias("p"), F.lit(1.0).alias("rate"))
        return texts, plain, []
    members = stored(posteriors(texts, domains, priors, table), "memberships")
    known = sum(max(targets.get(d, 0.0), 0.0) for d in domains)
    if known <= 0:
        raise ValueError("no domain found has a target")
    if budget is None:
        budget = float(members.agg(F.coalesce(F.sum("tokens"), F.lit(0))).collect()[0][0])
    steps = fit_rates(members, [budget * max(targets.get(d, 0.0), 0.0) / known for d in domains])
    return texts, members.withColumn("rate", rate(steps)), domains


def labelled_domains(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, text, domain) of at most ``sample_rows`` labelled texts: the language where quality is good, ``low`` where it is not."""
    known = narrow(labels, id="doc_id", quality="quality").where("quality is not null").groupBy("id").agg(F.min("quality").alias("quality"))
    texts = narrow(docs, id="doc_id", text="text", lang="lang")
    return labelled_sample(texts, known, sample_rows).select("id", "text", F.when(F.col("quality") == 0, F.lit("low")).otherwise(F.col("lang")).alias("domain"))


def copies(rate_col: str = "rate", row_col: str = "row") -> Column:
    """Whole copies of a text: the rate rounded up or down by the hash of its key, right on average."""
    return F.floor(F.col(rate_col) + F.pmod(F.xxhash64(row_col), F.lit(1 << 20)) / F.lit(float(1 << 20))).cast("long")
