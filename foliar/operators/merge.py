"""Insert-if-absent merges, surrogate ids and cascading deletes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from foliar.operators.aggregate import duplicate_keys, require_unique
from foliar.operators.joins import join
from foliar.operators.ordered import row_number_any, row_number_global
from foliar.schema import children_of
from foliar.session import materialize


@dataclass(frozen=True)
class Merge:
    """Result of a merge: the new rows alone and the table with them."""

    inserted: DataFrame
    table: DataFrame


def assign_ids(df: DataFrame, order: Sequence[Column | str], name: str, after: int = 0) -> DataFrame:
    """Contiguous ids above ``after``, in the given order."""
    return row_number_global(df, order, name, start=after + 1)


def max_id(df: DataFrame, id_col: str) -> int:
    top = df.agg(F.max(id_col).alias("m")).first()["m"]
    return 0 if top is None else int(top)


def absent_rows(target: DataFrame, values: DataFrame, by: Sequence[str], unique: bool = False) -> DataFrame:
    """Input rows whose key the target lacks; missing key parts match each other.

    A present key blocks all of its incoming rows. Only the key columns of the
    target are read, and reduced to distinct keys unless they are ``unique``.
    """
    return join(values, target.select(*by), list(by), "anti", unique_right=unique)


def one_per_key(values: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """First row of each key by ``order``; combined before the shuffle."""
    rest = [c for c in values.columns if c not in by]
    picked = F.min_by(F.struct(*values.columns), order).alias("__row")
    return values.groupBy(*by).agg(picked).select(*by, *[F.col(f"__row.{c}").alias(c) for c in rest])


def insert_if_absent(
    target: DataFrame,
    values: DataFrame,
    by: Sequence[str],
    id_col: str | None = None,
    on_duplicate: str = "keep_all",
    order: Sequence[str] | None = None,
    unique: bool = False,
    last_id: int | None = None,
) -> Merge:
    """Add the rows of ``values`` whose key is not in ``target``.

    Columns the target lacks are dropped and missing ones filled with nulls.
    Rows that repeat a key inside the batch are all kept, reduced to the first,
    or refused, by ``on_duplicate`` (keep_all, first, error). With ``id_col``
    new rows get contiguous ids above the largest present one, in ``order``
    where one is given; without it they are numbered in one pass. ``unique``
    says that the target holds each key once; ``last_id`` is the largest id
    where ``target`` is only a part of the table.
    """
    by = list(by)
    types = {f.name: f.dataType for f in target.schema.fields}
    known = [c for c in target.columns if c in values.columns and c != id_col]
    batch = values.select(*[F.col(c).cast(types[c]).alias(c) for c in known])
    new = absent_rows(target, batch, by, unique)
    if on_duplicate not in ("keep_all", "first", "error"):
        raise ValueError(on_duplicate)
    if on_duplicate == "first":
        new = one_per_key(new, by, F.struct(*known))
    if id_col is not None:
        start = (max_id(target, id_col) if last_id is None else last_id) + 1
        new = row_number_global(new, order, id_col, start) if order else row_number_any(new, id_col, start)
    # Numbered rows are stored by now, so the check does not run the batch again.
    if on_duplicate == "error" and not duplicate_keys(new, by).isEmpty():
        raise ValueError(f"the batch repeats keys of {by}")
    filled = [F.col(c) if c in new.columns else F.lit(None).cast(types[c]).alias(c) for c in target.columns]
    inserted = new.select(*filled)
    return Merge(inserted, target.unionByName(inserted))


def with_ids(
    values: DataFrame, table: DataFrame, by: Sequence[str], id_col: str, unique: bool = False
) -> DataFrame:
    """Input rows, with all their columns, and the id of their key in ``table``.

    The key must be unique in the table; ``unique`` says that it is known to be.
    """
    keys = table.select(*by, id_col)
    if not unique:
        require_unique(keys, by)
    return join(values, keys, list(by), "left")


@dataclass(frozen=True)
class Tee:
    """The input, stored; the side output, written; and the rows of both, counted as they were written."""

    main: DataFrame
    side: DataFrame
    n_main: int
    n_side: int


def tee(df: DataFrame, side: Callable[[DataFrame], DataFrame], path: str) -> Tee:
    """Write ``side(df)`` to ``path`` and go on with ``df``; the plan of ``df`` runs once."""
    counted, beside = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("n")
    main = materialize(df.observe(counted, rows), "tee")
    out = side(main)
    out.observe(beside, rows).write.parquet(path)
    return Tee(main, df.sparkSession.read.schema(out.schema).parquet(path), counted.get["n"], beside.get["n"])


def cascade_delete(
    tables: dict[str, DataFrame], table: str, condition: Column
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Surviving and removed rows of each table after a delete that cascades.

    Rows of ``table`` that meet the condition go, and level by level every row
    that references a removed key. Rows without a reference stay. The removed
    keys of a level are stored once, so no level runs those above it again.
    """
    hit = F.coalesce(condition, F.lit(False))
    removed = {table: tables[table].where(hit)}
    left = {table: tables[table].where(~hit)}
    queue = [table]
    while queue:
        parent = queue.pop(0)
        for child, column in children_of(parent):
            if child not in tables or column not in removed[parent].columns:
                continue
            keys = removed_keys(removed[parent], column)
            base = left.get(child, tables[child])
            gone = join(base, keys, [column], "semi", null_safe=False, unique_right=True)
            removed[child] = removed[child].unionByName(gone) if child in removed else gone
            left[child] = join(base, keys, [column], "anti", null_safe=False, unique_right=True)
            if child not in queue:
                queue.append(child)
    return {**tables, **left}, removed


def removed_keys(removed: DataFrame, column: str) -> DataFrame:
    """Distinct present keys of removed rows, stored."""
    return materialize(removed.select(column).where(F.col(column).isNotNull()).distinct(), "removed-keys")
