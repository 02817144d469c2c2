"""Row numbers, fill-down and other operators that depend on row order.

A window sorts each of its groups inside one task, so groups are cut into
ordered segments: rows are range-partitioned by group
and order and stored once with their segment and position, each segment is
worked on by itself, and a small table with one row per group and segment
carries the running state from one segment to the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliar.operators.joins import join
from foliar.session import materialize, small_table

_LOW33 = (1 << 33) - 1


def _positions(df: DataFrame) -> DataFrame:
    """Store rows with their partition and place in it, both read off Spark's row id."""
    row = F.col("__row")
    out = df.withColumn("__row", F.monotonically_increasing_id()).withColumns(
        {"__seg": F.shiftright(row, 33), "__pos": row.bitwiseAND(F.lit(_LOW33))}
    )
    return materialize(out.drop("__row"), "segments", "zstd")


def segments(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in global order with ``__seg`` (ordered partition) and ``__pos`` (place in it).

    Rows that tie on the whole order are spread by a row tag, so no run of
    copies is forced into one partition. The result is stored, hence stable.
    """
    tagged = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*order, "__tie"]
    return _positions(tagged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie"))


def _offset_rows(seg: DataFrame, name: str, start: int) -> DataFrame:
    """Position within the segment plus the rows of all earlier segments.

    The driver sees one count per partition; no task sees more than one
    partition.
    """
    counts = sorted((r["__seg"], r["n"]) for r in seg.groupBy("__seg").agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = accumulate((n for _, n in counts), initial=start)
    rows = [(s, first) for (s, _), first in zip(counts, firsts)]
    offsets = small_table(seg.sparkSession, "__oseg bigint, __first bigint", rows)
    return (
        seg.join(F.broadcast(offsets), F.col("__seg") == F.col("__oseg"))
        .withColumn(name, F.col("__first") + F.col("__pos"))
        .drop("__seg", "__pos", "__oseg", "__first")
    )


def row_number_global(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers over the whole table in the given order."""
    return _offset_rows(segments(df, order), name, start)


def row_number_any(df: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in no particular order: one pass, no shuffle, stored."""
    return _offset_rows(_positions(df), name, start)


def row_number_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """Numbers from 1 within each group, in the given order."""
    group = list(group)
    seg = segments(df, [*group, *order])
    state = seg.groupBy(*group, "__seg").agg(F.min("__pos").alias("__min"), F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*group).orderBy("__seg").rowsBetween(W.unboundedPreceding, -1)
    state = state.withColumn("__carry", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    out = join(seg, state, [*group, "__seg"], "inner")
    number = F.col("__pos") - F.col("__min") + F.col("__carry") + 1
    return out.withColumn(name, number).drop("__seg", "__pos", "__min", "__carry")


def fill_down(df: DataFrame, value: str, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Carry the last present value forward within each group."""
    group = list(group)
    seg = segments(df, [*group, *order])
    present = F.when(F.col(value).isNotNull(), F.col("__pos"))
    state = seg.groupBy(*group, "__seg").agg(F.max_by(value, present).alias("__last"))
    before = W.partitionBy(*group).orderBy("__seg").rowsBetween(W.unboundedPreceding, -1)
    state = state.withColumn("__carry", F.last("__last", ignorenulls=True).over(before)).drop("__last")
    inside = W.partitionBy(*group, "__seg").orderBy("__pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = seg.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    out = join(local, state, [*group, "__seg"], "left")
    return out.withColumn(value, F.coalesce(value, "__carry")).drop("__seg", "__pos", "__carry").select(*df.columns)


def block_label(number: Column | str, size: int, blocks: int) -> Column:
    """Repeating label 1..blocks, each for ``size`` consecutive row numbers."""
    number = F.col(number) if isinstance(number, str) else number
    return (F.floor((number - 1) / size) % blocks + 1).cast("long")


def head_tail(df: DataFrame, group: Sequence[str], order: str, k: int = 6) -> DataFrame:
    """First and last ``k`` rows of each group, with the end they come from.

    The rank filter is applied before the shuffle too, so each task passes on
    at most ``k`` rows of a group.
    """

    def end(label: str, key: Column) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*group).orderBy(key))
        return df.withColumn("__rk", rank).where(F.col("__rk") <= k).drop("__rk").withColumn("part", F.lit(label))

    return end("head", F.col(order).asc()).unionByName(end("tail", F.col(order).desc()))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)
