"""Source divergence against a plain dense count, and on awkward rows."""

import re
from collections import Counter, defaultdict

import pytest

pytest.importorskip("foliar.llm")

from foliar.llm import divergence  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"
_WORD = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def plain(rows, top=200):
    words = lambda t: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in _WORD.findall(t or "")]
    df, groups, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source, ws = lang or "", source or "", words(text)
        df[lang].update(set(ws))
        groups[lang, source].update(ws)
        total[lang].update(ws)
    out = []
    for lang in {k for k, _ in groups}:
        kept = [t for t, n in df[lang].items() if n >= 3]
        rate = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        rates = {s: rate(c) for (g, s), c in groups.items() if g == lang}
        q = rate(total[lang])
        f = lambda a, b: (a - b) ** 2 // b
        for s, p in rates.items():
            parts = {
                "pair": [(o, sum(f(p[t], r[t]) for t in kept)) for o, r in rates.items() if o != s],
                "term": [(t, f(p[t], q[t])) for t in kept if groups[lang, s][t] and p[t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, i) for i, (t, v) in enumerate(items, 1) if part == "pair" or i <= top]
    return sorted(out)


def got(spark, rows, **more):
    return sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA), **more).select("lang", "source", "part", "item", "value", "rank").collect())


def test_tokens_fold_only_ascii_and_keep_other_bytes():
    assert divergence.tokens("A1b\x00C_É\u00a0x\x7f[z]".encode()) == [b"a", b"b", b"c", "É\u00a0x".encode(), b"z"]


def test_counts_groups_and_ranks(spark):
    import random

    rng = random.Random(5)
    stock = ["Ab", "b", "cé", "d", "É", "zz", "y"]
    rows = [(i, " ".join(rng.choices(stock, weights=[9, 5, 3, 2, 2, 1, 1], k=rng.randint(0, 12))) + rng.choice([".", " 1", "\n"]), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", None]), "x", 1) for i in range(80)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, top_terms=2) == plain(rows, top=2)


def test_missing_values_empty_groups_ties_and_repeated_rows(spark):
    rows = [(1, "a b", "en", "s", "", 0)] * 3 + [(None, None, None, None, None, None), (2, "", "en", "t", "", 0), (3, "12 !", "en", "u", "", 0), (4, "a b", "fr", "s", "", 0)]
    assert got(spark, rows) == plain(rows)  # 'fr' keeps no term, so its only group has no row; the groups t and u have constants only


def test_source_without_kept_terms_in_a_language_without_any(spark):
    rows = [(1, "a", "fr", "s", "", 0), (2, "b", "fr", "t", "", 0)]
    assert got(spark, rows) == [("fr", "s", "pair", "t", 0, 1), ("fr", "t", "pair", "s", 0, 1)]


def test_empty_table_and_very_long_text(spark):
    assert got(spark, []) == []
    rows = [(i, "long word " * 200_000 + s, "en", s, "", 0) for i, s in enumerate("xyx")]
    assert got(spark, rows) == plain(rows)


def test_rates_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    n, total = 2_345_678_901_234_567, 8_999_999_999_999_999
    row = spark.range(1).select(divergence._rate(F.lit(n), F.lit(total)).alias("p")).first()
    assert row.p == 1 + 10**9 * n // total
