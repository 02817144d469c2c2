"""Personal data: base patterns, and terms that give a protected entity away by the company they keep.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers,
see ``base_spans``. Every distinct value of one is a protected entity e. The
corpus says how much a term t tells about it, in the sense of pointwise mutual
information over term places: with N places in the corpus, c_t of them the term t,
c_e of them within ``WINDOW`` terms of an occurrence of e, c_te of both kinds,

    IC(e) = log(N / c_e)        PMI(e; t) = log(N * c_te / (c_t * c_e)).

A term that stands nowhere but near e discloses all of it, PMI = IC. A term is
disclosing where PMI reaches ``THRESHOLD`` of IC for some entity, and the two
stand together in at least ``MIN_CONTEXTS`` different windows (copies of one
passage are one window). Disclosing terms are spans of kind ``term`` wherever
they stand, also in texts that do not hold the entity.

For the sanitised text a disclosing term is generalised to the longest of its
beginnings (``PREFIXES`` letters) that discloses none of the term's entities,
all terms that begin so counted together; without one it is removed. Base spans
become the name of their kind.

A term is a run of letters and digits of at least two characters, in small
letters; terms that touch a base span are not counted. All counts are over all
whole texts. Disclosing terms reach the tasks as a bitmap of hashes with a fixed
size bound; what it lets through is confirmed by an equi-join, so no table that
grows with the corpus is broadcast.

A missing text is empty and has no spans. Rows that repeat an id, or lack one,
are rows of their own. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliar.llm._jobs import keyed, stored

WINDOW = 10
THRESHOLD = 0.9
MIN_CONTEXTS = 3
PREFIXES = (2, 3, 4, 5)
FLUSH_TERMS = 400_000
MAX_BITS = 26  # the bitmap has at most 2^26 bits, 8 MB

# Order of kinds at one start.
KINDS = ("email", "ip", "card", "phone", "term")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]{2,}")


# --- one text ----------------------------------------------------------------------
def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        # The part before the sign is as long as its letters go back, but not into the match before.
        start = done + len(text[done:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _ips(text: str):
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            values = [p.lstrip("0") for p in four]
            if all(len(v) <= 3 and int(v or 0) <= 255 for v in values):
                yield start, end
            start = end + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind, in time that grows with the length of the text.

    Each kind is taken leftmost and without overlaps, by these patterns; a match that fails its test is dropped:
    email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at
    most 255; card ``[0-9]([\\x20-]?[0-9])+``, 14 to 19 digits that pass the Luhn sum; phone ``\\+[0-9][\\x20().0-9-]+[0-9]``,
    10 to 15 digits.
    """
    out = [(*s, "email") for s in _emails(text)] if "@" in text else []
    if "." in text:
        out += [(*s, "ip") for s in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def entity(kind: str, value: str) -> str:
    """The name of a protected value: the same address or number however it is written."""
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else f"{kind}:{''.join(c for c in value if c.isdigit())}"


def term_spans(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Places of the terms that no base span touches."""
    places = [m.span() for m in _TERM.finditer(text)]
    if not spans:
        return places
    starts = [s[0] for s in spans]
    reach = np.maximum.accumulate([s[1] for s in spans])  # spans of different kinds may overlap
    before = np.searchsorted(starts, [e for _, e in places], side="left") - 1
    return [p for p, i in zip(places, before) if i < 0 or reach[i] <= p[0]]


def company(text: str, spans: list[tuple[int, int, str]]) -> tuple[list, list]:
    """What stands near the entities of a text: (entity, term, context, n) and (entity, places).

    A place near several occurrences of one entity counts once. ``context`` is a hash of the terms of a window.
    """
    places = term_spans(text, spans)
    terms = [text[a:b].lower() for a, b in places]
    starts = [a for a, _ in places]
    near, together = {}, Counter()
    for start, end, kind in spans:
        name = entity(kind, text[start:end])
        left = int(np.searchsorted(starts, start))
        right = int(np.searchsorted(starts, end))
        window = range(max(0, left - WINDOW), min(len(terms), right + WINDOW))
        context = xxhash.xxh64_intdigest(" ".join(terms[i] for i in window)) >> 1
        have = near.setdefault(name, set())
        for i in window:
            if i not in have:
                have.add(i)
                together[name, terms[i], context] += 1
    return [(*k, n) for k, n in together.items()], [(k, len(v)) for k, v in near.items()]


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# --- tables ------------------------------------------------------------------------
_SPAN = "struct<start:long,place:int,end:long,kind:string,general:string>"
_BASE = f"n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans array<{_SPAN}>, together array<struct<entity:string,term:string,context:long,n:long>>, near array<struct<entity:string,n:long>>"


def base_table(texts: DataFrame) -> DataFrame:
    """One row per text: counts by kind, spans, and what stands near its entities."""
    schema = T.StructType([texts.schema["row"], texts.schema["id"], *T.StructType.fromDDL(_BASE)])
    arrow = to_arrow_schema(schema)

    def find(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                kinds = [s[2] for s in spans]
                together, near = company(text, spans) if spans else ([], [])
                rows.append(
                    [kinds.count(k) for k in KINDS[:4]]
                    + [hashlib.sha256(joined(spans).encode()).hexdigest()]
                    + [[(start, KINDS.index(kind), end, kind, None) for start, end, kind in spans], together, near]
                )
            columns = [pa.array(values, type=f.type) for values, f in zip(zip(*rows), list(arrow)[2:])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *columns], names=arrow.names)

    return texts.mapInArrow(find, schema)


def term_totals(texts: DataFrame) -> DataFrame:
    """(term, n) over all texts, terms that touch base spans left out; the empty term has the number of all places."""

    def count(batches):
        sums, total = Counter(), 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["term", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                found = [text[a:b] for a, b in term_spans(text, spans)] if spans else _TERM.findall(text or "")
                total += len(found)
                for term, n in Counter(found).items():
                    sums[term.lower()] += n
            if len(sums) > FLUSH_TERMS:
                yield rows()
                sums.clear()
        sums[""] += total
        yield rows()

    return texts.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


class _Bits:
    """A bitmap of term hashes of bounded size; ``in`` may say yes to a term that was not put in, never no to one that was."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.mask = words, (1 << bits) - 1

    def __contains__(self, term: str) -> bool:
        at = xxhash.xxh64_intdigest(term, seed=42) & self.mask
        return bool(self.words[at >> 6] >> np.uint64(at & 63) & np.uint64(1))

    @classmethod
    def of(cls, terms: DataFrame) -> _Bits:
        """Of the column ``term``; the driver sees words of the bitmap, at most 2^MAX_BITS / 64 of them."""
        bits = min(MAX_BITS, max(10, terms.count().bit_length() + 6))
        at = terms.select((F.xxhash64("term").bitwiseAND((1 << bits) - 1)).alias("at"))
        words = at.groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        found = words.toArrow()
        out = np.zeros(1 << (bits - 6), dtype=np.uint64)
        out[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.int64).view(np.uint64)
        return cls(out, bits)


def disclosing_terms(texts: DataFrame, base: DataFrame) -> DataFrame:
    """(term, general): terms to hide, and the beginning they may be generalised to, if any."""
    together = base.select(F.explode("together").alias("x")).select("x.*")
    pairs = together.groupBy("entity", "term").agg(F.sum("n").alias("c_te"), F.count_distinct("context").alias("contexts"))
    pairs = stored(pairs, "together")
    entities = base.select(F.explode("near").alias("x")).select("x.*").groupBy("entity").agg(F.sum("n").alias("c_e"))
    often = pairs.where(F.col("contexts") >= MIN_CONTEXTS)
    totals = stored(term_totals(texts), "term-totals")
    total = totals.where("term = ''").agg(F.sum("n").alias("n")).first().n or 0
    places = F.lit(total).cast("double")

    def disclosure(rows: DataFrame) -> DataFrame:
        """Rows whose PMI of entity and term (columns c_te, c_t, c_e) reaches the threshold."""
        ic = F.log(places / F.col("c_e"))
        pmi = F.log(places * F.col("c_te") / (F.col("c_t") * F.col("c_e").cast("double")))
        # An entity near every term of the corpus has nothing to give away.
        return rows.where(F.col("c_e") < total).where(pmi >= F.lit(THRESHOLD) * ic)

    known = often.join(totals.select("term", F.col("n").alias("c_t")), "term").join(entities, "entity")
    told = stored(disclosure(known).select("entity", "term", "c_e").distinct(), "disclosed")
    terms = told.select("term").distinct()

    # Beginnings of disclosing terms: what all terms with one of them say about the entity.
    size = F.explode(F.array(*map(F.lit, PREFIXES))).alias("k")
    begin = F.substring("term", F.lit(1), F.col("k"))
    tries = told.select("*", size).where(F.length("term") > F.col("k")).select("entity", "term", "c_e", begin.alias("general"), "k")
    wanted = tries.select("general").distinct()
    starts = lambda rows, *keys: rows.select("*", size).where(F.length("term") >= F.col("k")).select("*", begin.alias("general")).join(wanted, "general").groupBy("general", *keys)
    c_t = starts(totals.where("term <> ''")).agg(F.sum("n").alias("c_t"))
    c_te = starts(pairs, "entity").agg(F.sum("c_te").alias("c_te"))
    judged = tries.join(c_t, "general").join(c_te, ["general", "entity"])
    bad = disclosure(judged).select("term", "general").distinct()
    # A beginning serves if it gives none of the term's entities away; of several the longest says most.
    good = tries.select("term", "general", "k").distinct().join(bad, ["term", "general"], "left_anti")
    best = good.groupBy("term").agg(F.max(F.struct("k", "general"))["general"].alias("general"))
    return stored(terms.join(best, "term", "left"), "disclosing")


def disclosures(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, start, end, general): every place of a disclosing term outside base spans."""
    bits = _Bits.of(terms.select("term"))
    kind = texts.schema["row"].dataType.simpleString()

    def find(batches):
        passes: dict[str, bool] = {}

        def hit(term: str) -> bool:
            out = passes.get(term)
            if out is None:
                if len(passes) > FLUSH_TERMS:
                    passes.clear()
                out = passes[term] = term.lower() in bits
            return out

        for batch in batches:
            number, start, end, term = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if text and any(map(hit, set(_TERM.findall(text)))):
                    for a, b in term_spans(text, base_spans(text)):
                        if hit(text[a:b]):
                            number.append(i)
                            start.append(a)
                            end.append(b)
                            term.append(text[a:b].lower())
            rows = batch.column("row").take(pa.array(number, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows, pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(term, pa.string())], names=["row", "start", "end", "term"])

    places = texts.select("row", "text").mapInArrow(find, f"row {kind}, start long, end long, term string")
    return places.join(terms, "term").select("row", "start", "end", "general")


def _found(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts, and one row per text with its spans as structs (start, place of the kind, end, kind, general)."""
    texts = keyed(docs, id_col, text_col)
    base = stored(base_table(texts), "base")
    extra = disclosures(texts, disclosing_terms(texts, base))
    extra = extra.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("term")).alias("place"), "end", F.lit("term").alias("kind"), "general")).alias("extra"))
    rows = base.join(extra, "row", "left")
    return texts, rows.withColumn("all", F.array_sort(F.concat("spans", F.coalesce("extra", F.array().cast(f"array<{_SPAN}>")))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms), one row per text.

    Spans are written ``kind:start:end`` in code points, end exclusive, joined by commas, by start and then kind;
    ``base_sha256`` is the hash of those of the base kinds.
    """
    _, rows = _found(docs, id_col, text_col)
    written = F.array_join(F.transform("all", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.col(f"n_{k}") for k in KINDS[:4]]
    n_terms = F.size(F.filter("all", lambda s: s["kind"] == "term")).cast("long")
    return rows.select(F.col("id").alias(id_col), *counts, "base_sha256", written.alias("spans"), n_terms.alias("n_terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_col): texts with base spans named by kind (``<email>``), disclosing terms shortened (``ab*``) or removed (``*``).

    Where base spans overlap, the first one covers what it shares with the next.
    """
    texts, rows = _found(docs, id_col, text_col)

    def mark(s):
        shown = F.concat(F.coalesce(s["general"], F.lit("")), F.lit("*"))
        return F.when(s["kind"] == "term", shown).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))

    marks = rows.where(F.size("all") > 0).select("row", F.transform("all", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), mark(s).alias("mark"))).alias("marks"))
    both = texts.join(marks, "row", "left")
    kind = both.schema["id"].dataType.simpleString()

    def rewrite(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
                if text is None or not spans:
                    out.append(text)
                    continue
                parts, done = [], 0
                for s in spans:
                    if s["end"] <= done:
                        continue
                    parts += [text[done : max(done, s["start"])], s["mark"]]
                    done = s["end"]
                out.append("".join(parts) + text[done:])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["id", "text"])

    cleaned = both.select("id", "text", "marks").mapInArrow(rewrite, f"id {kind}, text string")
    return cleaned.select(F.col("id").alias(id_col), F.col("text").alias(text_col))

