"""Counts, means, collapsing and uniqueness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.functions.clean import numeric_columns


def count_sorted(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key, most frequent first, ties in key order."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *keys)


def collapse_duplicates(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key: mean of numbers, first other value by ``order``."""
    numeric = set(numeric_columns(df))
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.avg(c).alias(c) if c in numeric else F.min_by(c, order).alias(c) for c in rest]
    if not aggs:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise if a key repeats."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicates found for {list(keys)}")
    return df


def group_mean_by_rows(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Replace ``date`` by its group's mean day on every row.

    The mean is pre-aggregated and joined back, so no group is collected and a
    hot group is split by the skew join.
    """
    from foliar.operators.joins import join

    mean = df.groupBy(*keys).agg(F.floor(F.avg(F.unix_date(date))).cast("int").alias("__day"))
    out = join(df, mean, list(keys), "left")
    return out.withColumn(date, F.date_from_unix_date("__day")).drop("__day")


def wavelength_extent(spectra: DataFrame, spectrum: Sequence[str], wavelength: str) -> DataFrame:
    """First and last whole wavelength inside each spectrum."""
    return spectra.groupBy(*spectrum).agg(
        F.ceil(F.min(wavelength)).alias("min_wavelength"), F.floor(F.max(wavelength)).alias("max_wavelength")
    )
