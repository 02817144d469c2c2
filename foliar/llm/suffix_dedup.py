"""Removal of repeated byte strings by prefix-free parsing.

Every byte that lies in a string of ``width`` bytes which also starts anywhere
else in the corpus (same text included) is removed.

Parse. A rolling hash over ``SEED`` bytes triggers phrases: the trigger of a
``width``-byte window is its leftmost smallest seed hash, and a phrase is the
run of windows with one trigger. Like phrases of any prefix-free parse they
overlap (here by width - 1 bytes) and depend on content alone, so repeated text
gives repeated phrases, and no phrase is a prefix of another one at the same
trigger. Every window, that is every corpus suffix cut at ``width`` bytes, lies
in exactly one phrase.

Dictionary and parse. Corpus order down to ``width`` bytes is wanted only to
find suffixes that are equal that far. The parse (phrase names in text order)
is grouped into the dictionary (distinct phrases with their frequency): all
suffixes of a phrase that occurs twice are repeated. A suffix of a phrase that
occurs once can only equal a suffix of another dictionary phrase with the same
trigger, at the same distance from it. These suffixes are ranked as a suffix
array is built by doubling, from a long common part outwards: first the part
that 16 neighbouring suffixes share, then, where that part is shared but what
surrounds it differs, the single suffixes. Equal rank is equal text (128-bit
names). A total order of the unequal suffixes is never needed and not built: it
would cost a global sort of one row per byte.

All steps group by names with map-side combine, so a passage that every text
holds is one row per task. Rows: about one per 170 bytes in the parse, and more
only for phrases at the edges of repeated passages.

Texts shorter than ``width`` bytes, empty and missing texts lose nothing. Rows
that repeat an id count as texts of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import keyed, stored
from foliar.llm._text import Rolling, blocks

WIDTH = 400
SEED = 64
STEP = 16  # suffixes ranked together by their common part
PIECE = 1 << 20  # longer texts are parsed in pieces whose windows do not overlap
_PLACE = np.uint64((1 << 24) - 1)


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(keys)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:n] = keys
    grid = full.reshape(-1, width)
    forward = np.minimum.accumulate(grid, axis=1).reshape(-1)
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def _phrases_of(data: np.ndarray, valid: np.ndarray, width: int):
    """(first window, last window, trigger, seed hash) of the phrases among the ``valid`` window starts."""
    seeds = Rolling(data).windows(SEED)
    keys = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
    trigger = (_smallest(keys, width - SEED + 1)[valid] & _PLACE).astype(np.int64)
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (valid[1:] != valid[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(valid)) - 1
    return valid[at], valid[last], trigger[at], seeds[trigger[at]]


def _parse(width: int):
    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            for block in blocks(batch.column(1)):
                for start in range(0, max(len(block.data), 1), PIECE):
                    data = block.data[start : start + PIECE + width - 1]
                    if len(data) < width:
                        continue
                    ends = block.offsets[1:] - start
                    x = np.arange(min(PIECE, len(data) - width + 1))
                    edges = np.clip(block.offsets - start, 0, len(x))
                    text = np.repeat(np.arange(block.rows), np.diff(edges))
                    valid = x[x + width <= ends[text]]
                    if not len(valid):
                        continue
                    low, high, trigger, seed = _phrases_of(data, valid, width)
                    owner = text[low]
                    base = block.offsets[owner] - start
                    raw = data.tobytes()
                    names = [xxhash.xxh3_128_digest(raw[a : b + width]) for a, b in zip(low.tolist(), high.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.take(pa.array(owner + block.first)),
                            pa.array(low - base),
                            pa.array(high - base),
                            pa.array(trigger - base),
                            pa.array(seed.view(np.int64)),
                            pa.array(names, type=pa.binary()),
                        ],
                        names=["row", "low", "high", "trigger", "seed", "name"],
                    )

    return run


def _cores(width: int):
    """Per phrase and run of STEP suffixes: the name of their common part and the bytes around it."""
    common = width - STEP + 1

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row, text, phrases in zip(*[batch.column(i) for i in range(3)]):
                text = memoryview(text.as_buffer()) if text.is_valid else b""
                row = row.as_py()
                for p in phrases.as_py():
                    t = p["trigger"]
                    far, near = t - p["low"], t - p["high"]
                    for d in range(near - near % STEP, far + 1, STEP):
                        first, last = max(d, near), min(d + STEP - 1, far)
                        core = xxhash.xxh3_128(text[t - d : t - d + common])
                        core.update(b"%d" % (d // STEP))
                        out[0].append(row)
                        out[1].append(t - d)
                        out[2].append(core.digest())
                        out[3].append(bytes(text[t - last : t - d]))
                        out[4].append(bytes(text[t - d + common : t - first + width]))
                        out[5].append(p["n"])
                if len(out[0]) > 20_000:
                    yield _core_rows(out, batch.schema.types[0])
                    out = [[], [], [], [], [], []]
            if out[0]:
                yield _core_rows(out, batch.schema.types[0])

    return run


def _core_rows(out, kind):
    kinds = [kind, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds)], names=["row", "at", "core", "before", "after", "n"])


def _cut(id_kind):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text")):
                spans, kept, sizes = [], [], []
                for i in range(block.rows):
                    data = block.data[block.offsets[i] : block.offsets[i + 1]]
                    found = batch.column("found")[block.first + i]
                    sizes.append(len(data))
                    if not found.is_valid or not len(found.values):
                        spans.append([])
                        kept.append(data.tobytes())
                        continue
                    edge = np.zeros(len(data) + 1, dtype=np.int64)
                    np.add.at(edge, found.values.field("start").to_numpy(), 1)
                    np.add.at(edge, found.values.field("end").to_numpy(), -1)
                    gone = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
                    turns = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])])
                    kept.append(data[~gone[1:-1]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(block.first, block.rows),
                        pa.array(sizes, type=pa.int64()),
                        pa.array(spans, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array(kept, type=pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per text: (doc_id, n_bytes, spans, kept).

    ``spans`` are the maximal removed byte ranges, ``kept`` the bytes left.
    """
    if width < SEED + STEP:
        raise ValueError(f"width must be at least {SEED + STEP}")
    texts = keyed(docs, id_col, text_col)
    row = texts.schema["row"].dataType.simpleString()
    kind = texts.schema["id"].dataType.simpleString()
    parse = stored(
        texts.select("row", F.col("text").cast("binary")).mapInArrow(_parse(width), f"row {row}, low long, high long, trigger long, seed long, name binary"),
        "parse",
    )
    dictionary = stored(parse.groupBy("name").agg(F.count("*").alias("n"), F.min("seed").alias("seed")), "dictionary")
    # Phrases that occur once, and all phrases they share a trigger text with.
    shared = dictionary.groupBy("seed").agg(F.count("*").alias("phrases"), F.min("n").alias("least")).where("phrases > 1 and least = 1").select("seed", F.lit(True).alias("near"))
    wanted = dictionary.join(shared, "seed", "left").where("n > 1 or near").select("name", "n", F.coalesce("near", F.lit(False)).alias("near"))
    marked = stored(parse.drop("seed").join(wanted, "name"), "marked")
    once = marked.where("near and n = 1").select("row", "low", "high", "trigger", "n")
    often = marked.where("near and n > 1").groupBy("name").agg(F.min(F.struct("row", "low", "high", "trigger", "n")).alias("p")).select("p.*")
    open_phrases = once.unionByName(often).groupBy("row").agg(F.collect_list(F.struct("low", "high", "trigger", "n")).alias("phrases"))
    cores = stored(
        texts.select("row", F.col("text").cast("binary").alias("text"))
        .join(open_phrases, "row")
        .mapInArrow(_cores(width), f"row {row}, at long, core binary, before binary, after binary, n long"),
        "cores",
    )
    whole = ["core", "before", "after"]
    ranked = stored(cores.groupBy(*whole).agg(F.sum("n").alias("n"), F.min("row").alias("row"), F.min("at").alias("at")), "ranks")
    # ``at`` is where the common part starts; ``before`` has one byte for each further suffix to the left of it.
    first_suffix = F.col("at") - F.length("before")
    last_end = F.col("at") + F.lit(width - STEP + 1) + F.length("after")
    repeated = cores.where("n = 1").join(ranked.where("n > 1").select(*whole), whole, "left_semi").select("row", first_suffix.alias("start"), last_end.alias("end"))
    several = ranked.groupBy("core").agg(F.count("*").alias("k")).where("k > 1").select("core")
    suffixes = ranked.join(several, "core", "left_semi").select(
        "core", "before", "after", "n", "row", "at", F.explode(F.sequence(F.lit(STEP - 1) - F.length("after"), F.length("before"))).alias("e")
    )
    suffixes = suffixes.select(
        "n",
        "row",
        (F.col("at") - F.col("e")).alias("start"),
        "core",
        F.expr("substring(before, length(before) - e + 1, e)").alias("before"),
        F.expr(f"substring(after, 1, {STEP - 1} - e)").alias("after"),
    )
    suffixes = stored(suffixes, "suffixes")
    equal = suffixes.groupBy(*whole).agg(F.sum("n").alias("m")).where("m > 1").select(*whole)
    edges = suffixes.where("n = 1").join(equal, whole, "left_semi").select("row", "start", (F.col("start") + width).alias("end"))
    full = marked.where("n > 1").select("row", F.col("low").alias("start"), (F.col("high") + width).alias("end"))
    found = full.unionByName(repeated).unionByName(edges).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    return (
        texts.select("row", "id", F.col("text").cast("binary").alias("text"))
        .join(found, "row", "left")
        .select("id", "text", "found")
        .mapInArrow(_cut(kind), f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    )


def digest(cleaned: DataFrame, detail: bool = False) -> DataFrame:
    """The report of ``remove_repeats``: sizes and the hash of what is left; with ``detail`` also the text left and the spans removed.

    A cut may fall inside a character; its bytes stand as U+FFFD in ``kept_text``, while the hash is over the bytes.
    """
    more = [
        F.call_function("make_valid_utf8", F.col("kept").cast("string")).alias("kept_text"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("removed_spans"),
    ]
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        *(more if detail else []),
    )
