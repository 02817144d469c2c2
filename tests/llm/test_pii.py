"""Personal data: base patterns against the plain expressions, disclosing terms against plain counts."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

pytest.importorskip("foliar.llm")

from foliar.llm import pii  # noqa: E402

SCHEMA = "doc_id long, text string, row string, spans int, term string"


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def plain_spans(text):
    digits = lambda m: [c for c in m.group() if c in "0123456789"]
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), i, m.end(), kind) for i, (kind, rx, ok) in enumerate(kinds) for m in re.finditer(rx, text) if ok(m)]
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="@@..+-0123456789aZé_% ()\n", max_size=60))
@example("a@b@c.d.e@f.g a@b.-.c x@y..z")
@example("1.2.3.4.5.6.7.8 256.1.1.1 0000000255.1.1.1.9 1.2.3..4")
@example("4539 1488 0343 6467 +1 (499) 555-6503 4539148803436467-0 +49.30.1234567 +1 2")
@example("+4111111111111111111 a.4111-1111-1111-1111@x.y")
def test_base_spans_equal_the_plain_expressions(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("piece", ["a", "1", "1.", "@", "a@", "+", "+1", "1 ", "1-", "a@b.", ".", "+1 (", "a@b.c "])
def test_time_grows_with_the_length(piece):
    import time

    begin = time.time()
    spans = pii.base_spans(piece * 400_000)
    pii.term_spans(piece * 400_000, spans)
    assert time.time() - begin < 8


def plain_terms(texts, window=10, threshold=0.9, contexts=3):
    total, near, together, seen = Counter(), Counter(), Counter(), defaultdict(set)
    for text in texts:
        spans = plain_spans(text)
        terms = [m for m in re.finditer(r"[^\W_]{2,}", text) if not any(m.start() < e and s < m.end() for s, e, _ in spans)]
        total.update(m.group().lower() for m in terms)
        places = defaultdict(set)
        for s, e, kind in spans:
            name = (kind, text[s:e].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[s:e]))
            left = [i for i, m in enumerate(terms) if m.start() < s][-window:]
            right = [i for i, m in enumerate(terms) if m.start() >= e][:window]
            for i in left + right:
                seen[name, terms[i].group().lower()].add(tuple(terms[j].group().lower() for j in left + right))
            places[name].update(left + right)
        for name, at in places.items():
            near[name] += len(at)
            for i in at:
                together[name, terms[i].group().lower()] += 1
    n = sum(total.values())
    return {t for (e, t), k in together.items() if len(seen[e, t]) >= contexts and near[e] < n and math.log(n * k / (total[t] * near[e])) >= threshold * math.log(n / near[e])}


def corpus():
    import random

    rng = random.Random(9)
    common = [f"{a}{b}" for a in "abcdefgh" for b in "lmnop"]
    fill = lambda k: " ".join(rng.choices(common, k=k))
    texts = [fill(60) for _ in range(60)]
    for _ in range(6):
        texts.append(f"{fill(20)} Zanthor of Quillby wrote anna.b@mail.example.org {fill(30)}")
        texts.append(f"{fill(20)} call +1 (499) 555-6503 or 8.8.4.4 {fill(9)} al {fill(20)}")
    texts += [f"{fill(5)} Vexley a copied line bo@x.example.com {fill(2)}"] * 9 + [f"{fill(30)} ZANTHOR {fill(30)}", "zanthor", "", "quillby quillings quillest " * 30]
    return texts


def read_spans(text, written):
    return [(kind, text[int(a) : int(b)]) for kind, a, b in (s.split(":") for s in written.split(",") if s)]


def test_terms_that_give_entities_away(spark):
    texts = corpus()
    want = plain_terms(texts)
    assert "zanthor" in want and "vexley" not in want and "al" not in want
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)).collect()}
    for i, text in enumerate(texts):
        base = plain_spans(text)
        found = read_spans(text, rows[i].spans)
        assert [f"{kind}:{a}:{b}" for a, b, kind in base] == [s for s in rows[i].spans.split(",") if s and not s.startswith("term")]
        assert rows[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[2] == k for s in base) for k in ("email", "ip", "card", "phone")]
        places = [m.group() for m in re.finditer(r"[^\W_]{2,}", text) if m.group().lower() in want and not any(m.start() < e and s < m.end() for s, e, _ in base)]
        assert [t for kind, t in found if kind == "term"] == places and rows[i].n_terms == len(places)


def test_sanitised_text(spark):
    texts = corpus()
    cleaned = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert not any("zanthor" in t.lower() or "@" in t for t in cleaned.values())
    assert "*" in cleaned[texts.index("zanthor")] and cleaned[0] == texts[0]
    line = next(cleaned[i] for i, t in enumerate(texts) if "Zanthor of" in t)
    assert "wr* <email>" in line or "* <email>" in line


def test_missing_empty_repeated_rows_and_long_texts(spark):
    long = "word " * 300_000 + "a.b@c.de"
    rows = [(1, "a@b.cd", "", 0, ""), (1, "a@b.cd", "", 0, ""), (1, None, "", 0, ""), (None, "", "", 0, ""), (2, long, None, None, None)]
    got = sorted((str(r.doc_id), r.n_email, r.spans) for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted([("1", 1, "email:0:6"), ("1", 1, "email:0:6"), ("1", 0, ""), ("None", 0, ""), ("2", 1, f"email:1500000:{len(long)}")])
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.find(empty).collect() == [] and pii.sanitise(empty).collect() == []


def test_bitmap_lets_every_term_through(spark):
    terms = [f"wört{i}" for i in range(500)]
    bits = pii._Bits.of(spark.createDataFrame([(t,) for t in terms], "term string"))
    assert all(t in bits for t in terms) and sum(f"other{i}" in bits for i in range(5000)) < 500
