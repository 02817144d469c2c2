"""Sentinels, retyping and derived numeric columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliar.functions.nulls import col, is_true


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def sentinel_below(c: Column | str, sentinel: float = -999.0) -> Column:
    """Numbers at or below ``sentinel + 1`` become missing."""
    return F.when(is_true(col(c) <= sentinel + 1), None).otherwise(col(c))


def drop_sentinels(df: DataFrame, sentinel: float = -999.0, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`sentinel_below` to every numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return df.withColumns({c: sentinel_below(c, sentinel) for c in names})


def sentinel_equal(c: Column | str, value) -> Column:
    """One exact value becomes missing."""
    return F.nullif(col(c), F.lit(value))


def negative_to_null(c: Column | str) -> Column:
    return F.when(col(c) < 0, None).otherwise(col(c))


def retype(df: DataFrame, columns: Iterable[str], dtype: str) -> DataFrame:
    """Cast columns; text that does not parse becomes missing."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in columns})


def replicate_mean(a: Column | str, b: Column | str) -> Column:
    """Mean of two replicates; the one that is present where the other is missing."""
    a, b = col(a), col(b)
    return F.when(a.isNotNull() & b.isNotNull(), 0.5 * (a + b)).otherwise(F.coalesce(a, b))


def both_mean(a: Column | str, b: Column | str) -> Column:
    """Mean of two replicates, missing where either one is."""
    return 0.5 * (col(a) + col(b))


def dms_to_decimal(deg: Column | str, minutes: Column | str, seconds: Column | str) -> Column:
    """Degrees, minutes and seconds as decimal degrees; the sign comes from the degrees."""
    deg = col(deg)
    size = F.abs(deg) + col(minutes) / F.lit(60.0) + col(seconds) / F.lit(3600.0)
    return F.when(deg < 0, -size).otherwise(size)
