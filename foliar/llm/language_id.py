"""Language identification by compression against one raw-content dictionary per language.

A text is compressed by zstandard once per language, each time with that
language's dictionary: raw sample text, not a trained one, both in lower case. The smallest size
wins; equal sizes go to the language first in order. With sizes in bits taken as
code lengths, ``score`` is the winner's share of 2^-bits, and a text is
``rejected`` where the runner-up is within ``min_margin`` of the winner's size.

Dictionaries hold texts of at most ``sample_rows`` labelled rows per language,
chosen by the hash of id and text, up to ``dictionary_bytes``: whole texts, of
one longer than an eighth of that room a piece from a place its hash names. Rows
alike in id and text count once, so repeated and missing ids change no bound. A
language has a dictionary as soon as it has one labelled text. A text
that is missing or has no letter is ``und`` with score 0; without any labelled
row every text is ``und``.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import narrow, share

SAMPLE_ROWS = 200
DICTIONARY_BYTES = 48 << 10
MAX_LANGUAGES = 100
LEVEL = 5
MIN_MATCH = 4  # short texts have few long matches
MIN_MARGIN = 0.01
UNKNOWN = "und"


def dictionaries(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Sample text per language from rows (id, text, lang)."""
    rows = labelled.where("lang is not null and text is not null and length(text) > 0")
    # Rows alike in id and text count once, however often they stand.
    rows = rows.withColumn("o", F.xxhash64("id", "text"))
    found = rows.groupBy("lang").agg(F.count_distinct("o").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    picked = F.lit(False)
    for r in found:
        picked = picked | ((F.col("lang") == r["lang"]) & share("o", r["n"], sample_rows))
    # Long texts would waste the room: of them a piece that surely fits (a character has four bytes at most).
    piece = max(dictionary_bytes // 32, 1)
    start = F.pmod(F.col("o"), F.greatest(F.length("text") - piece, F.lit(0)) + 1) + 1
    fits = F.octet_length("text") <= dictionary_bytes // 8
    text = F.when(fits, F.col("text")).otherwise(F.substring("text", start.cast("int"), F.lit(piece)))
    chosen = rows.where(picked).select("lang", "o", text.alias("text")).groupBy("lang", "o").agg(F.min("text").alias("text")).collect()
    out: dict[str, list[bytes]] = {}
    room: dict[str, int] = {}
    for r in sorted(chosen, key=lambda r: (r.lang, r.o, r.text)):
        text = r.text.lower().encode()
        if len(text) <= room.get(r.lang, dictionary_bytes):
            room[r.lang] = room.get(r.lang, dictionary_bytes) - len(text)
            out.setdefault(r.lang, []).append(text)
    return {lang: b"\n".join(parts) for lang, parts in sorted(out.items())}


def _predict(samples: dict[str, bytes], level: int, min_margin: float):
    def run(batches):
        langs = list(samples)
        params = zstandard.ZstdCompressionParameters.from_level(level, min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False)
        coders = []
        for text in samples.values():
            d = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            coders.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                if not langs or text is None or not any(map(str.isalpha, text)):
                    rows.append((UNKNOWN, 0.0, True))
                    continue
                data = text.lower().encode()
                sizes = [len(c.compress(data)) for c in coders]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                share = 1.0 / sum(2.0 ** max(-8 * (s - sizes[best]), -1000) for s in sizes)
                others = sorted(sizes)[1:2]
                rows.append((langs[best], share, bool(others) and others[0] - sizes[best] <= min_margin * sizes[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame, samples: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per text: (doc_id, lang_pred, score, rejected)."""
    texts = narrow(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(_predict(samples, level, min_margin), f"doc_id {kind}, lang_pred string, score double, rejected boolean")

