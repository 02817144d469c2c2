"""Row filters that recur in the loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.functions.nulls import col, matches, not_in

# Words that mark a target as something other than a leaf.
NON_LEAF = "(?i)(canopy|bare|ground|dirt|road|litter|cwd|soil)"


def leaf_only(df: DataFrame, name: str, pattern: str = NON_LEAF) -> DataFrame:
    """Drop non-leaf targets; rows without a name are dropped too."""
    return df.where(~F.col(name).rlike(pattern))


def exclude(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Drop listed values and keep missing ones."""
    return df.where(not_in(name, values))


def exclude_pair(df: DataFrame, **pair) -> DataFrame:
    """Drop rows that match all given values; an undecided comparison drops the row as well."""
    cond: Column | None = None
    for name, value in pair.items():
        test = F.col(name) == F.lit(value)
        cond = test if cond is None else cond & test
    return df.where(~cond)


def route(name: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Class by the first matching pattern; missing for an unknown name."""
    out = None
    for pattern, label in rules:
        hit = matches(col(name), pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def uncommented(df: DataFrame, comment: str) -> DataFrame:
    """Rows whose comment is the empty text."""
    return df.where(F.col(comment) == "")
