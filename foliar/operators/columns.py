"""Choosing, renaming and mapping columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.functions.clean import numeric_columns


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def with_pattern(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def select_prefix(df: DataFrame, keep: Iterable[str], prefix: str) -> DataFrame:
    return df.select(*keep, *[f"`{c}`" for c in with_prefix(df, prefix)])


def select_pattern(df: DataFrame, keep: Iterable[str], pattern: str) -> DataFrame:
    return df.select(*keep, *[f"`{c}`" for c in with_pattern(df, pattern)])


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*with_prefix(df, prefix))


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop the columns of a sheet that carry no header."""
    return df.select(*[f"`{c}`" for c in df.columns if c.strip() and not re.fullmatch(r"_c\d+", c)])


def canonical(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Known columns only, in their canonical order."""
    return df.select(*[c for c in columns if c in df.columns])


def map_columns(df: DataFrame, columns: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in columns})


def map_numeric(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    return map_columns(df, numeric_columns(df), fn)
