"""Unit factors and unit labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.functions.nulls import col, matches
from foliar.session import small_table

# Multiply by the factor to go from the first unit to the second.
FACTORS: dict[tuple[str, str], float] = {
    ("ug cm-2", "kg m-2"): 1e-5,
    ("g cm-2", "kg m-2"): 10.0,
    ("g m-2", "kg m-2"): 1e-3,
    ("mg m-2", "kg m-2"): 1e-6,
    ("mg g-1", "percent"): 0.1,
    ("bar", "Pa"): 1e5,
}


def convert(c: Column | str, unit: str, to: str) -> Column:
    """Multiply by the factor between two known units."""
    return col(c) * F.lit(FACTORS[(unit, to)])


def convert_columns(df: DataFrame, columns: Sequence[str], unit: str, to: str) -> DataFrame:
    return df.withColumns({c: convert(c, unit, to) for c in columns})


def factor_table(spark) -> DataFrame:
    """The factors as a table, for long trait data that carries its own unit column."""
    rows = [(u, t, f) for (u, t), f in FACTORS.items()]
    return small_table(spark, "unit string, to_unit string, factor double", rows)


def convert_long(df: DataFrame, value: str, unit: str, to_unit: str) -> DataFrame:
    """Convert long data whose rows name their unit and wanted unit.

    The factor table has one row per known pair, so the broadcast is of fixed
    size. Pairs that are not listed leave the value missing.
    """
    factors = F.broadcast(
        factor_table(df.sparkSession).select(
            F.col("unit").alias("__unit"), F.col("to_unit").alias("__to"), F.col("factor").alias("__factor")
        )
    )
    cond = (F.col(unit) == F.col("__unit")) & (F.col(to_unit) == F.col("__to"))
    same = F.col(unit) == F.col(to_unit)
    return (
        df.join(factors, cond, "left")
        .withColumn(value, F.when(same, F.col(value)).otherwise(F.col(value) * F.col("__factor")))
        .drop("__unit", "__to", "__factor")
    )


def label(c: Column | str, rules: Sequence[tuple[str, str]], last_wins: bool = False) -> Column:
    """A label by name pattern, from ordered (pattern, label) rules.

    With ``last_wins`` later rules overwrite earlier ones, otherwise the first
    match decides. No match gives a missing label.
    """
    ordered = list(reversed(rules)) if last_wins else list(rules)
    out = None
    for pattern, text in ordered:
        hit = matches(c, pattern)
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out
