"""Hard-negative mining: anchors' scores against every row, bounded along a spanning tree of the anchors.

Each component x counts as floor(scale * x), a score is the whole-number inner
product of two rows. Anchors are put in blocks of at most ``BLOCK`` that lie
near each other; a block's minimum spanning tree is rooted at its middle. For a
row x, a child anchor c of the parent p has

    |<c, x> - <p, x>| <= |c - p| * |x|

so known scores, or known bounds, at the parent bound those at the child: the
root is scored against all rows, and down the tree only rows are rescored whose
bounds overlap what the anchor still looks for. Rows go through in chunks; what
the chunks before have found narrows it.

1. Positives: the first ``positives`` other rows of the anchor's label. A row is
   rescored if its upper bound reaches the last of the best found so far.
2. Negatives: for each positive the first ``negatives`` rows of another label
   with ``low * positive <= 100 * negative <= 100 * positive``. A row is rescored
   if its bounds overlap the window of one of the anchor's positives.

Higher scores come first, ties by smaller id, rows without id last. Rows are dealt
to (part of the rows) x (block of anchors); no task holds more than ``PART`` rows
and a block, whatever label or vector many rows share, and it hands on no more
than the best few rows of each anchor.

Rows with a missing label, a missing vector or a missing or non-finite component
take no part. A row without id can be a positive or a negative, never an anchor.
Rows that repeat an id are rows of their own. Where vectors differ in length,
components that one of them lacks count as 0. Scores must fit 64 bits, or the
job fails; where they pass 2^52 every pair is scored. An empty table, or one
without anchors or without another label, has an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliar.llm._jobs import narrow, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
BLOCK = 1024
PART = 65_536
CHUNK = 1024
NO_ID = np.iinfo(np.int64).max
NOTHING = np.iinfo(np.int64).min


# --- inside a task ------------------------------------------------------------------
def quantised(vectors, scale: float) -> np.ndarray:
    """Whole numbers as float64, one row per vector, short vectors filled with 0."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(out * scale)


def plant(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent (-1: root), edge length and depth of each point in the minimum spanning tree rooted nearest the mean."""
    n = len(points)
    squares = (points**2).sum(1)
    root = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    parent, depth = np.full(n, -1), np.zeros(n, dtype=np.int64)
    near, by = np.full(n, np.inf), np.full(n, root)
    out = np.ones(n, dtype=bool)
    new = root
    for _ in range(n):
        out[new] = False
        if new != root:
            parent[new], depth[new] = by[new], depth[by[new]] + 1
        gap = squares + squares[new] - 2 * (points @ points[new])
        closer = out & (gap < near)
        near[closer], by[closer] = gap[closer], new
        new = int(np.argmin(np.where(out, near, np.inf)))
    edge = np.zeros(n)
    child = parent >= 0
    edge[child] = np.sqrt(((points[child] - points[parent[child]]) ** 2).sum(1))
    return parent, edge, depth


class Scorer:
    """Exact scores of anchors against one chunk of rows, and bounds of them from parent to child."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        width = max(anchors.shape[1], rows.shape[1])
        self.a, self.x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, rows))
        self.norm_a, self.norm = (np.sqrt((m**2).sum(1)) for m in (self.a, self.x))
        # Below 2^52 every partial sum is a whole number that float64 holds.
        self.large = self.norm_a.max(initial=0) * self.norm.max(initial=0) >= 2.0**52
        self.rescored = 0

    def dense(self, at: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Scores of the pairs in ``need`` (anchors ``at`` x rows); what else the array holds is not used."""
        self.rescored += int(need.sum())
        if self.large:
            whole = [[int(v) for v in row] for row in self.x]
            out = np.zeros(need.shape, dtype=np.int64)
            for i, j in zip(*np.nonzero(need)):
                out[i, j] = sum(int(v) * w for v, w in zip(self.a[at[i]], whole[j]))  # fails beyond 64 bits
            return out
        if need.mean() > 0.05:
            return (self.a[at] @ self.x.T).astype(np.int64)
        out = np.zeros(need.shape, dtype=np.int64)
        i, j = np.nonzero(need)
        for k in range(0, len(i), 65_536):
            s = slice(k, k + 65_536)
            out[i[s], j[s]] = np.einsum("ij,ij->i", self.a[at[i[s]]], self.x[j[s]])
        return out

    def walk(self, parent: np.ndarray, edge: np.ndarray, depth: np.ndarray, wanted):
        """Per depth (anchors, pairs scored, scores); ``wanted(anchors, low, high)`` says which pairs to score."""
        low = np.zeros((len(parent), len(self.x)))
        high = np.zeros_like(low)
        for level in range(int(depth.max(initial=-1)) + 1):
            at = np.flatnonzero(depth == level)
            if level and not self.large:
                reach = edge[at][:, None] * self.norm + 1e-9 * (edge[at] + self.norm_a[at])[:, None] * self.norm
                low[at], high[at] = low[parent[at]] - reach, high[parent[at]] + reach
                need = wanted(at, low[at], high[at])
            elif self.large:
                need = wanted(at, np.full((len(at), len(self.x)), -np.inf), np.full((len(at), len(self.x)), np.inf))
            else:
                need = np.ones((len(at), len(self.x)), dtype=bool)
            scores = self.dense(at, need)
            low[at], high[at] = np.where(need, scores, low[at]), np.where(need, scores, high[at])
            yield at, need, scores


class Best:
    """The first ``k`` candidates of each of ``n`` keys: by score downwards, then by id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.key, self.score, self.id, self.row = (np.zeros(0, dtype=np.int64) for _ in range(4))
        self.last = np.full(n, NOTHING)

    def add(self, key, score, ids, row) -> None:
        key, score, ids, row = (np.concatenate([a, b]) for a, b in ((self.key, key), (self.score, score), (self.id, ids), (self.row, row)))
        order = np.lexsort((row, ids, -score, key))
        key, score, ids, row = key[order], score[order], ids[order], row[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        place = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        keep = place < self.k
        full = place == self.k - 1
        self.last[key[full]] = score[full]
        self.key, self.score, self.id, self.row = key[keep], score[keep], ids[keep], row[keep]


def _chunks(rows: pd.DataFrame, scale: float):
    ids, number, label = (rows[c].to_numpy(np.int64) for c in ("id", "row", "label"))
    for i in range(0, len(rows), CHUNK):
        s = slice(i, i + CHUNK)
        yield quantised(rows["vec"].iloc[s].to_numpy(), scale), ids[s], number[s], label[s]


def find_positives(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, scale: float) -> tuple[Best, int]:
    a = quantised(anchors["vec"].to_numpy(), scale)
    tree = [anchors[c].to_numpy() for c in ("parent", "edge", "depth")]
    own, own_label = anchors["row"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
    best, scored = Best(len(a), k), 0
    for x, ids, number, label in _chunks(rows, scale):
        job = Scorer(a, x)
        fits = (own_label[:, None] == label) & (own[:, None] != number)
        found = []
        for at, need, scores in job.walk(*tree, lambda at, low, high: fits[at] & (high >= best.last[at][:, None])):  # noqa: B023
            i, j = np.nonzero(need & fits[at] & (scores >= best.last[at][:, None]))
            found.append((at[i], scores[i, j], ids[j], number[j]))
        best.add(*(np.concatenate(c) for c in zip(*found)))
        scored += job.rescored
    return best, scored


def find_negatives(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, low_percent: int, scale: float) -> tuple[Best, int]:
    """Keys of the result are anchor * slots + slot of the positive."""
    a = quantised(anchors["vec"].to_numpy(), scale)
    tree = [anchors[c].to_numpy() for c in ("parent", "edge", "depth")]
    own_label = anchors["label"].to_numpy(np.int64)
    slots = max(map(len, anchors["scores"]))
    floor, top = np.full((len(a), slots), NO_ID), np.full((len(a), slots), NOTHING)  # nothing lies in an empty slot
    for i, scores in enumerate(anchors["scores"]):
        for j, s in enumerate(int(s) for s in scores):
            floor[i, j], top[i, j] = -((-low_percent * s) // 100), s
    best, scored = Best(len(a) * slots, k), 0
    for x, ids, number, label in _chunks(rows, scale):
        job = Scorer(a, x)
        fits = own_label[:, None] != label
        least = np.maximum(floor, best.last.reshape(floor.shape))

        def wanted(at, low, high):
            out = np.zeros(low.shape, dtype=bool)
            for j in range(slots):
                out |= (high >= least[at, j][:, None]) & (low <= top[at, j][:, None])  # noqa: B023
            return out & fits[at]  # noqa: B023

        found = []
        for at, need, scores in job.walk(*tree, wanted):
            need = need & fits[at]
            for j in range(slots):
                i, r = np.nonzero(need & (scores >= least[at, j][:, None]) & (scores <= top[at, j][:, None]))
                found.append((at[i] * slots + j, scores[i, r], ids[r], number[r]))
        best.add(*(np.concatenate(c) for c in zip(*found)))
        scored += job.rescored
    return best, scored


def _rows_out(best: Best, anchors: pd.DataFrame, slots: int) -> pd.DataFrame:
    return pd.DataFrame({"anchor": anchors["row"].to_numpy()[best.key // slots], "slot": (best.key % slots).astype(np.int32), "score": best.score, "id": best.id})


# --- on Spark -----------------------------------------------------------------------
def usable_rows(table: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, vec, label) of the rows that take part; a missing id is NO_ID here."""
    rows = narrow(table, id=id_col, vec=vec_col, label=label_col)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("d"), "vec", F.col("label").cast("long").alias("label"))
    bad = F.exists("d", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull()).where(~bad).select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "vec", "label")


def _planted(anchors: DataFrame, scale: float) -> DataFrame:
    """(block, row, id, label, vec, parent, edge, depth): blocks of at most BLOCK anchors near each other, each with its tree."""
    count = anchors.count()
    signs = F.transform(F.slice("vec", 1, 24), lambda x: F.when(x > 0, "1").otherwise("0"))
    # Neighbours by the signs of their first components; rows that agree in all of them are split by their number.
    near = anchors.withColumn("code", F.array_join(signs, "")).repartitionByRange(max(1, -(-count // BLOCK)), "code", "row").sortWithinPartitions("code", "row").drop("code")
    near = stored(near.withColumn("at", F.monotonically_increasing_id()), "anchors")
    # The number of a row counts from 0 in its partition: no block is larger than BLOCK however uneven the ranges are.
    near = near.withColumn("block", F.expr(f"shiftright(at, 33) * {1 << 24} + (at & {(1 << 33) - 1}) div {BLOCK}"))

    def tree(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at", ignore_index=True)
        parent, edge, depth = plant(quantised(block["vec"].to_numpy(), scale))
        return block.assign(parent=parent, edge=edge, depth=depth, at=np.arange(len(block)))

    schema = "row long, id long, label long, vec array<float>, at long, block long, parent long, edge double, depth long"
    schema = schema.replace("array<float>", anchors.schema["vec"].dataType.simpleString())
    return stored(near.select("row", "id", "label", "vec", "at", "block").groupBy("block").applyInPandas(tree, schema), "trees")


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def mine(
    table: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT, scale: float = SCALE,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score), see the module.

    ``is_anchor`` is a condition on ``id``, the row's id.
    """
    rows = stored(usable_rows(table, id_col, vec_col, label_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    trees = _planted(rows.where(F.coalesce(is_anchor, F.lit(False)) & (F.col("id") != NO_ID)), scale)
    blocks = [r.block for r in trees.select("block").distinct().collect()]  # one number per BLOCK anchors
    count = rows.count()
    parts = max(-(-count // PART), min(table.sparkSession.sparkContext.defaultParallelism, -(-count // (2 * CHUNK))), 1)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts))).withColumn("block", F.explode(F.array(*map(F.lit, blocks)).cast("array<long>")))
    dealt = dealt.groupBy("part", "block")
    found_schema = "anchor long, slot int, score long, id long"

    def to_parts(anchors: DataFrame) -> object:
        return anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).groupBy("part", "block")

    def best_positives(some: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(anchors):
            return pd.DataFrame({"anchor": [], "slot": [], "score": [], "id": []})
        anchors = anchors.sort_values("at", ignore_index=True)
        return _rows_out(find_positives(some, anchors, positives, scale)[0], anchors, 1)

    def best_negatives(some: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(anchors) or not anchors["scores"].map(len).any():
            return pd.DataFrame({"anchor": [], "slot": [], "score": [], "id": []})
        anchors = anchors.sort_values("at", ignore_index=True)
        slots = max(map(len, anchors["scores"]))
        return _rows_out(find_negatives(some, anchors, negatives, low_percent, scale)[0], anchors, slots)

    near = dealt.cogroup(to_parts(trees)).applyInPandas(best_positives, found_schema)
    near = stored(_first(near, ["anchor"], positives).select("anchor", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    aimed = trees.join(scores, trees["row"] == scores["anchor"], "left").drop("anchor").withColumn("scores", F.coalesce("scores", F.array().cast("array<long>")))
    hard = _first(dealt.cogroup(to_parts(aimed)).applyInPandas(best_negatives, found_schema), ["anchor", "slot"], negatives)
    named = hard.join(near, ["anchor", "slot"]).join(trees.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    given = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return named.select("anchor_id", given("positive_id").alias("positive_id"), F.col("place").alias("rank"), given("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
