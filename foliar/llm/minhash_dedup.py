"""Near duplicates by SuperMinHash signatures, banding, verification and union-find grouping.

A text's set is its distinct 5-word shingles (A-Z folded; a shorter text is one
shingle; a text without words has none). Two texts are linked where
100 * |A and B| >= 75 * |A or B|, confirmed on the full sets. A group is a
connected set of links, named by its smallest id.

SuperMinHash gives every shingle a random permutation of the signature's slots
and puts the value ``rank + fraction`` into the slot it reaches at that rank;
slots keep their minimum. The ranks of a shingle are correlated over the slots,
which lowers the variance of the estimate, and a text is done as soon as no
later rank can lower any slot: one to four ranks for texts of ordinary length.

With 60 bands of 6 slots a pair exactly at the threshold is missed with
probability (1 - 0.75^6)^60 = 8e-6, at 0.8 with 1e-8. Pairs whose signatures
differ in too many slots (4 bits of each are compared) are not confirmed on full
sets: the bound lies 4.5 deviations above what a pair at the threshold has.

Texts with equal sets are one class before anything is compared; the hot group
of copies is a grouped minimum. Links between classes are found per band by
``link_buckets``, which never multiplies a bucket out within a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.llm._jobs import among, groups, link_buckets, narrow, odd_ids, stored
from foliar.llm._text import blocks, mix, shingle_sets

SLOTS = 360
BAND_SLOTS = 6
SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
PLANES = 4
# Slots of a pair at 0.75 differ, as far as 4 bits show it, with probability 0.25 * 15 / 16: 84 of 360. SuperMinHash's
# deviation grows with the union (at 0.75 it holds 4/7 of both sets): 6.1 up to 360 shingles, 6.8 up to 1,000, 8 at most.
# (Shingles of both sets together, slots that may differ): 4.5 deviations each.
MAX_DIFFERENT = ((630, 112), (1750, 115))
MAX_DIFFERENT_OF_LARGE = 121
_TRACED_RANKS = 8


def super_minhash(h: np.ndarray, owner: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (texts, slots) of the distinct shingle hashes ``h``, where owner[i] is the text of h[i].

    Texts without shingles keep infinite slots.
    """
    sig = np.full((texts, slots), np.inf)
    flat = sig.reshape(-1)
    active = np.flatnonzero(np.bincount(owner, minlength=texts) > 0)
    picks: list[np.ndarray] = []
    perm = None
    for rank in range(slots):
        u = mix(h + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = rank + (u >> np.uint64(11)).astype(np.float64) * 2.0**-53
        pick = rank + ((mix(u) >> np.uint64(33)) * np.uint64(slots - rank) >> np.uint64(31)).astype(np.int64)
        if perm is None and rank == _TRACED_RANKS:
            # Few shingles are left, those of short texts: give them whole permutations.
            perm = np.tile(np.arange(slots, dtype=np.int32), (len(h), 1))
            rows = np.arange(len(h))
            for i, p in enumerate(picks):
                moved = perm[rows, p]
                perm[rows, p] = perm[:, i]
                perm[:, i] = moved
        if perm is None:
            slot = pick.copy()
            for i in range(rank - 1, -1, -1):
                slot[slot == picks[i]] = i
            picks.append(pick)
        else:
            rows = np.arange(len(h))
            slot = perm[rows, pick]
            perm[rows, pick] = perm[:, rank]
            perm[:, rank] = slot
        np.minimum.at(flat, owner * slots + slot, value)
        highest = sig[active].max(axis=1)
        going = highest > rank + 1
        if not going.all():
            active = active[going]
            if not len(active):
                break
            alive = np.zeros(texts, dtype=bool)
            alive[active] = True
            keep = alive[owner]
            h, owner = h[keep], owner[keep]
            picks = [p[keep] for p in picks]
            perm = perm[keep] if perm is not None else None
    return sig


def bands(sig: np.ndarray, width: int = BAND_SLOTS) -> np.ndarray:
    """Per text one 64-bit key per band of ``width`` slots; the band's number is part of the key."""
    bits = sig.view(np.uint64).reshape(len(sig), -1, width)
    keys = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]).copy()
    for j in range(width):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + bits[:, :, j])
    return keys.view(np.int64)


def planes(sig: np.ndarray) -> np.ndarray:
    """Per text the low PLANES bits of all hashed slots, one run of 64-bit words per bit."""
    low = mix(sig.view(np.uint64).reshape(-1)).reshape(sig.shape)
    width = -(-sig.shape[1] // 64) * 8
    out = np.zeros((len(sig), PLANES, width), dtype=np.uint8)
    for i in range(PLANES):
        packed = np.packbits(((low >> np.uint64(i)) & np.uint64(1)).astype(np.uint8), axis=1)
        out[:, i, : packed.shape[1]] = packed
    return out.reshape(len(sig), -1).view(np.int64)


def alike(x: Column, y: Column) -> Column:
    """May two texts (n_shingles and planes) reach the threshold?"""
    words = -(-SLOTS // 64)
    different = None
    for w in range(words):
        bits = None
        for i in range(PLANES):
            at = i * words + w
            other = x["low"][at].bitwiseXOR(y["low"][at])
            bits = other if bits is None else bits.bitwiseOR(other)
        different = F.bit_count(bits) if different is None else different + F.bit_count(bits)
    sized = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * THRESHOLD_PERCENT
    most = F.lit(MAX_DIFFERENT_OF_LARGE)
    for both, slots in reversed(MAX_DIFFERENT):
        most = F.when(x["n"] + y["n"] <= both, slots).otherwise(most)
    return sized & (different <= most)


def _signatures(batches):
    for batch in batches:
        ids = batch.column(0)
        for block in blocks(batch.column(1)):
            sets = shingle_sets(block, SHINGLE_WORDS)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            sig = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
            keys = bands(sig)
            low = planes(sig)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(block.first, block.rows),
                    pa.array(sizes),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.reshape(-1))),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, low.size + 1, low.shape[1], dtype=np.int32)), pa.array(low.reshape(-1))),
                ],
                names=["id", "n_shingles", "digest", "keys", "low"],
            )


def _sets(batches):
    for batch in batches:
        for block in blocks(batch.column(1)):
            sets = shingle_sets(block, SHINGLE_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.rows), pa.array([s.tobytes() for s in sets], type=pa.binary())], names=["id", "members"]
            )


def _confirmed(batches):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(large, small)
            at[at == len(large)] = 0
            both = int(np.count_nonzero(large[at] == small))
            keep.append(100 * both >= THRESHOLD_PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: (doc_id, n_shingles, component_id, kept), kept for the smallest id of each group.

    Missing and empty texts have no shingles and are linked with nothing. Rows
    without an id come back with a missing component and are kept; rows that
    repeat an id count as copies of one id, each with its own text's links.
    """
    texts = narrow(docs, id=id_col, text=text_col)
    if not odd_ids(texts):
        return _components(texts)
    rows = stored(texts.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "numbered")
    found = _components(rows.where("id is not null").select(F.col("row").alias("id"), "text")).select(F.col("doc_id").alias("row"), "n_shingles", "component_id")
    found = stored(found.join(rows.select("row", "id"), "row"), "row-components")
    # The rows of one id are a star of components; a component is named by its smallest id.
    of_id = found.where("n_shingles > 0").select("id", "component_id").distinct()
    stars = of_id.join(of_id.groupBy("id").agg(F.min("component_id").alias("low")), "id")
    roots = groups(stars.select("component_id", "low")).select(F.col("node").alias("component_id"), "root")
    rooted = of_id.join(roots, "component_id", "left").select("id", F.coalesce("root", "component_id").alias("root")).distinct()
    named = rooted.join(rooted.groupBy("root").agg(F.min("id").alias("name")), "root").select("id", "name")
    out = found.join(named, "id", "left").select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("name", "id").alias("component_id"))
    kind = texts.schema["id"].dataType.simpleString()
    nameless = rows.where("id is null").select("id", "text").mapInArrow(_signatures, f"id {kind}, n_shingles long, digest binary, keys array<long>, low array<long>")
    out = out.unionByName(nameless.select(F.col("id").alias("doc_id"), "n_shingles", F.col("id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _components(texts: DataFrame) -> DataFrame:
    """The same for texts (id, text) with an id of its own on every row."""
    kind = texts.schema["id"].dataType.simpleString()
    signed = stored(texts.mapInArrow(_signatures, f"id {kind}, n_shingles long, digest binary, keys array<long>, low array<long>"), "signatures")
    full = signed.where("digest is not null")
    classes = full.groupBy("digest").agg(F.min("id").alias("rep"))
    of_class = stored(full.select("id", "digest").join(classes, "digest").select("id", "rep"), "classes")
    heads = full.join(of_class.where("id = rep").select("id"), "id", "left_semi")
    facts = stored(heads.select(F.col("id").alias("node"), "keys", F.struct(F.col("n_shingles").alias("n"), "low").alias("sketch")), "class-signatures")

    def verify(pairs: DataFrame) -> DataFrame:
        close = stored(pairs, "close")
        wanted = close.select(F.col("a").alias("id")).unionByName(close.select(F.col("b").alias("id"))).distinct()
        sets = stored(among(texts, wanted, "id").mapInArrow(_sets, f"id {kind}, members binary"), "sets")
        first = sets.select(F.col("id").alias("a"), F.col("members").alias("set_a"))
        second = sets.select(F.col("id").alias("b"), F.col("members").alias("set_b"))
        return close.join(first, "a").join(second, "b").mapInArrow(_confirmed, f"a {kind}, b {kind}")

    roots = link_buckets(facts, alike, verify).select(F.col("node").alias("rep"), "root")
    named = of_class.join(roots, "rep", "left").select("id", F.coalesce("root", "rep").alias("component_id"))
    return (
        signed.select("id", "n_shingles")
        .join(named, "id", "left")
        .select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


