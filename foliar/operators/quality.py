"""Constraint audits and assertions, driven by the catalog description."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliar.functions.nulls import col
from foliar.operators.joins import join
from foliar.schema import STORED


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def audit_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated unique keys per table; keys with a missing part cannot repeat."""
    parts = []
    for name, df in tables.items():
        for key in STORED[name].unique:
            present = reduce(lambda a, b: a & b, [col(c).isNotNull() for c in key])
            n = df.where(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            parts.append(
                n.agg(
                    F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_extra_rows")
                ).select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "n_keys", "n_extra_rows")
            )
    return _stack(parts)


def key_ledger(tables: dict[str, DataFrame]) -> tuple[DataFrame, list[tuple[str, str, str, int, int]]]:
    """One row (key, known, n_0, n_1, ...) per key value of all references, and the references.

    Every table is read once and gives its own keys and those it refers to;
    all of them meet in one grouping. ``key`` is the number of the parent's
    column, a colon and the value. ``known`` says that the parent has the key,
    ``n_i`` how many rows refer to it through the parent's i-th reference. A
    reference is (table, column, parent, number, i). Counts are combined before
    the shuffle, so a hot key is a few rows; a task holds one such row per key,
    so the row is kept short.
    """
    named = [(name, column, parent) for name in tables for column, parent in STORED[name].refs if parent in tables]
    owners = list(dict.fromkeys((parent, column) for _, column, parent in named))
    slots = [sum(named[j][1:] == named[i][1:] for j in range(i)) for i in range(len(named))]
    refs = [(*ref, owners.index((ref[2], ref[1])), slot) for ref, slot in zip(named, slots)]

    def entry(column: str, number: int, slot: int):
        return F.struct(F.concat(F.lit(f"{number}:"), F.col(column).cast("string")).alias("key"), F.lit(slot).alias("slot"))

    parts = []
    for name, df in tables.items():
        entries = [entry(column, number, slot) for child, column, _, number, slot in refs if child == name]
        entries += [entry(column, number, -1) for number, (parent, column) in enumerate(owners) if parent == name]
        if entries:
            parts.append(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("key is not null"))
    counts = [F.count_if(F.col("slot") == i).alias(f"n_{i}") for i in range(max(slots) + 1)]
    return _stack(parts).groupBy("key").agg(F.bool_or(F.col("slot") < 0).alias("known"), *counts), refs


def audit_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose reference has no parent, per table and column; each table is read once."""
    ledger, refs = key_ledger(tables)
    sums = []
    for i, (_, _, _, number, slot) in enumerate(refs):
        n = F.when(F.startswith("key", F.lit(f"{number}:")), F.col(f"n_{slot}"))
        sums += [F.coalesce(F.sum(n), F.lit(0)).alias(f"rows_{i}"), F.count_if(n > 0).alias(f"keys_{i}")]
    lines = [
        F.struct(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent"),
            F.col(f"rows_{i}").alias("n_rows"), F.col(f"keys_{i}").alias("n_keys"),
        )
        for i, (name, column, parent, _, _) in enumerate(refs)
    ]
    return ledger.where("not known").agg(*sums).select(F.inline(F.array(*lines)))


def audit_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing values in required columns, one scan per table."""
    parts = []
    for name, df in tables.items():
        required = STORED[name].not_null
        if not required:
            continue
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        parts.append(
            counts.unpivot([], list(required), "column_name", "n_null").select(
                F.lit(name).alias("table_name"), "column_name", "n_null"
            )
        )
    return _stack(parts)


def audit_positive(tables: dict[str, DataFrame]) -> DataFrame:
    """Values that break a ``> 0`` check; missing values pass."""
    parts = []
    for name, df in tables.items():
        for column in STORED[name].positive:
            parts.append(
                df.agg(F.count_if(F.col(column) <= 0).alias("n_bad")).select(
                    F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "n_bad"
                )
            )
    return _stack(parts)


def spectrum_contract(df: DataFrame, wavelength: str = "wavelength") -> DataFrame:
    """Check that a spectrum table has a wavelength, is numeric, and put the wavelength first."""
    if wavelength not in df.columns:
        raise ValueError(f"a spectrum table needs a {wavelength} column")
    text = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    if text:
        raise ValueError(f"not numeric: {text}")
    return df.select(wavelength, *[c for c in df.columns if c != wavelength])


def counts_match(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct counts of two keys side by side, with whether they agree."""
    a = left.select(F.lit("left").alias("side"), F.col(left_key).cast("string").alias("k")).distinct()
    b = right.select(F.lit("right").alias("side"), F.col(right_key).cast("string").alias("k")).distinct()
    return (
        a.unionByName(b)
        .agg(
            F.count_if((F.col("side") == "left") & F.col("k").isNotNull()).alias("n_left"),
            F.count_if((F.col("side") == "right") & F.col("k").isNotNull()).alias("n_right"),
        )
        .withColumn("matches", F.col("n_left") == F.col("n_right"))
    )


def require_counts_match(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> None:
    row = counts_match(left, left_key, right, right_key).first()
    if not row["matches"]:
        raise ValueError(f"{row['n_left']} {left_key} against {row['n_right']} {right_key}")


def unresolved_codes(df: DataFrame, code: str, known: DataFrame, *group: str) -> DataFrame:
    """Distinct codes that the dictionary lacks, with the given context columns."""
    open_codes = df.where(F.col(code).isNotNull()).select(*group, code).distinct()
    keys = [c for c in (*group, code) if c in known.columns]
    return join(open_codes, known.select(*keys), keys, "anti", null_safe=False)
