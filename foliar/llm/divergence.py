"""Source divergence audit: how the word frequencies of each source differ from the other sources of its language.

Tokens come from one ``bytes.translate`` over the whole UTF-8 text, which lowers
A-Z and blanks every other ASCII byte that is not a letter, and one
``bytes.split``; bytes from 0x80 on belong to words. A ``Counter`` per document
gives term counts and document frequencies, summed within a task before they are
shuffled as sparse rows (lang, source, term, n, docs).

A language keeps the terms of at least ``MIN_DOCS`` of its documents, V of them.
A group is a (lang, source) that occurs; its smoothed rate of a kept term is
``p = 1 + floor(SCALE * (n + 1) / (N + V))``, N its occurrences of kept terms.
The divergence of p from q is ``floor((p - q)^2 / q)``.

Only terms that occur are rows. A term absent from a group has the group's own
constant rate, so a sum over all V terms is that of the constants for both, plus
what the terms of the one, of the other and of both together change; the first
two are sums over the distinct counts of a group. All of it is whole numbers.

Missing text, language and source read as ''. A row per document: rows that
repeat an id, or lack one, are documents of their own. An empty table has an
empty result; a group without terms has rows with the value of its constants
(0 if its language keeps no term). Exact for up to 9e15 occurrences in a group.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliar.llm._jobs import narrow, stored

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
FLUSH_TERMS = 400_000

_LETTERS = frozenset(range(0x41, 0x5B)) | frozenset(range(0x61, 0x7B)) | frozenset(range(0x80, 0x100))
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def _count(batches):
    """Rows (lang, source, term, n, docs) of one task; the empty term says that the group occurs."""
    sums: dict = defaultdict(dict)
    held = 0

    def rows():
        for (lang, source), terms in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                    pa.array(terms.keys(), pa.binary()).cast(pa.string(), safe=False),
                    pa.array([x[0] for x in terms.values()], pa.int64()), pa.array([x[1] for x in terms.values()], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for text, lang, source in zip(batch.column("text"), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
            own = sums[lang, source]
            before = len(own)
            own.setdefault(b"", [0, 0])[1] += 1
            for term, n in Counter(tokens(text.as_py() or b"")).items():
                cell = own.get(term)
                if cell is None:
                    own[term] = [n, 1]
                else:
                    cell[0] += n
                    cell[1] += 1
            held += len(own) - before
            if held > FLUSH_TERMS:
                yield from rows()
                sums.clear()
                held = 0
    yield from rows()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row (lang, source, term, n, docs) per group and term, and one per group with the empty term."""
    texts = narrow(docs, text=text_col, lang=lang_col, source=source_col)
    texts = texts.select(F.col("text").cast("binary").alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    counted = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _rate(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * n / total) for n <= total, three digits at a time so that no product passes 64 bits."""
    out, rest = F.lit(0).cast("long"), n
    for _ in range(3):
        rest = rest * F.lit(1000)
        out = out * F.lit(1000) + F.call_function("div", rest, total)
        rest = F.pmod(rest, total)
    return out + F.lit(1)


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank), see the module: part ``pair`` for other sources, ``term`` for words that stand out."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    # A term's count in its language; n_lang and n are 0 for no term, so the rows that only say a group occurs drop out.
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= min_docs).drop("docs")
    cells = stored(counts.where("term <> ''").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-counts")

    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = cells.select("lang", "term", "n_lang").distinct().groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    groups = counts.where("term = ''").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "v", "total_lang")])
    all_terms = F.col("total") + F.col("v")
    # Rate of a term that the group lacks; without kept terms there is none and every value is 0.
    groups = stored(groups.select("*", F.when(F.col("v") > 0, _rate(F.lit(1).cast("long"), F.greatest(all_terms, F.lit(1)))).otherwise(1).alias("absent")), "groups")

    rated = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "absent",
        _rate(F.col("n") + 1, all_terms).alias("p"),
        _rate(F.col("n_lang") + 1, F.col("total_lang") + F.col("v")).alias("q"),
    )
    place = Window.partitionBy("lang", "source")
    terms = (
        rated.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(place.orderBy(F.desc("value"), "item")))
        .where(F.col("rank") <= top_terms)
    )
    return terms.unionByName(_pairs(rated, groups))


def _pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select("lang", "source", "v", F.col("absent").alias("p0"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("q0"))
    pairs = a.join(b, "lang").where("source <> item")
    neither = _apart(F.col("p0"), F.col("q0"))

    # Terms of one side only count through the side's rate: one row per distinct rate of a group.
    rates = rated.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    ours = (
        rates.join(pairs.drop("v"), ["lang", "source"])
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("k") * (_apart(F.col("p"), F.col("q0")) - neither)).alias("more"))
    )
    theirs = (
        rates.withColumnRenamed("source", "item").withColumnRenamed("p", "q")
        .join(pairs.drop("v"), ["lang", "item"])
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("k") * (_apart(F.col("p0"), F.col("q")) - neither)).alias("more"))
    )

    # Terms of both sides: each two sources of a term meet once and give both directions.
    left = rated.select("lang", "term", F.col("source").alias("s1"), F.col("p").alias("p1"), F.col("absent").alias("z1"))
    right = rated.select("lang", "term", F.col("source").alias("s2"), F.col("p").alias("p2"), F.col("absent").alias("z2"))

    def both(p, pz, q, qz):
        p, pz, q, qz = (F.col(c) for c in (p, pz, q, qz))
        return F.sum(_apart(p, q) - _apart(p, qz) - _apart(pz, q) + _apart(pz, qz))

    met = left.join(right, ["lang", "term"]).where("s1 < s2").groupBy("lang", "s1", "s2").agg(both("p1", "z1", "p2", "z2").alias("there"), both("p2", "z2", "p1", "z1").alias("back"))
    way = F.explode(F.array(F.struct(F.col("s1").alias("source"), F.col("s2").alias("item"), F.col("there").alias("more")), F.struct(F.col("s2").alias("source"), F.col("s1").alias("item"), F.col("back").alias("more"))))
    met = met.select("lang", way.alias("w")).select("lang", "w.*")

    base = pairs.select("lang", "source", "item", (F.col("v") * neither).alias("more"))
    summed = base.unionByName(ours).unionByName(theirs).unionByName(met).groupBy("lang", "source", "item").agg(F.sum("more").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
