"""Wide, long and packed forms of spectra and traits."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.operators.joins import join


def band_columns(df: DataFrame, pattern: str = r"^Wave_(\d+(?:\.\d+)?)$") -> list[tuple[str, float]]:
    """(column, wavelength) for the columns whose name holds a wavelength."""
    found = ((c, re.match(pattern, c)) for c in df.columns)
    return [(c, float(m.group(1))) for c, m in found if m]


def wide_to_long(
    df: DataFrame, ids: Sequence[str], pattern: str = r"^Wave_(\d+(?:\.\d+)?)$", value: str = "spectravalue"
) -> DataFrame:
    """One row per sample and wavelength from one column per wavelength.

    The columns are packed into one array and exploded with their position,
    which keeps the plan small for thousands of columns.
    """
    bands = band_columns(df, pattern)
    grid = F.array(*[F.lit(w) for _, w in bands])
    values = F.array(*[F.col(f"`{c}`").cast("double") for c, _ in bands])
    return df.select(*ids, F.posexplode(values).alias("__pos", value)).select(
        *ids, F.get(grid, F.col("__pos")).alias("wavelength"), value
    )


def wide_to_packed(df: DataFrame, ids: Sequence[str], pattern: str = r"^Wave_(\d+(?:\.\d+)?)$") -> DataFrame:
    """One row per spectrum with its wavelengths and values as arrays, from one column per wavelength; no shuffle."""
    bands = band_columns(df, pattern)
    return df.select(
        *ids,
        F.array(*[F.lit(w) for _, w in bands]).alias("wavelengths"),
        F.array(*[F.col(f"`{c}`").cast("double") for c, _ in bands]).alias("spectravalues"),
    )


def names_to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, drop_null: bool = False
) -> DataFrame:
    """One row per id and column name, such as samples laid out as columns."""
    labels = F.array(*[F.lit(c) for c in columns])
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    out = df.select(*ids, F.posexplode(values).alias("__pos", value)).select(
        *ids, F.get(labels, F.col("__pos")).alias(name), value
    )
    return out.where(F.col(value).isNotNull()) if drop_null else out


def melt(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, drop_null: bool
) -> DataFrame:
    """Entity-attribute-value rows; missing values dropped or kept as asked."""
    out = df.unpivot(list(ids), list(columns), name, value)
    return out.where(F.col(value).isNotNull()) if drop_null else out


def pivot(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence) -> DataFrame:
    """One column per listed name; names not listed are left out. Two values of one key and name are an error."""
    repeated = F.raise_error(F.lit(f"{value} repeats within a key and {name}")).cast(df.schema[value].dataType)
    return df.groupBy(*keys).pivot(name, list(values)).agg(F.when(F.count(value) > 1, repeated).otherwise(F.max(value)))


def stack_pairs(df: DataFrame, ids: Sequence[str], pairs: dict[str, str], name: str, value: str) -> DataFrame:
    """Two measured columns of one row as labelled rows, label -> column."""
    rows = F.array(*[F.struct(F.lit(k).alias(name), F.col(c).alias(value)) for k, c in pairs.items()])
    return df.select(*ids, F.inline(rows))


def pack(
    df: DataFrame,
    spectrum: Sequence[str],
    wavelength: str = "wavelength",
    value: str = "spectravalue",
    unique: bool = False,
) -> DataFrame:
    """One row per spectrum with sorted wavelength and value arrays.

    Repeated wavelengths are averaged first, with map-side combine, so copies
    of a spectrum do not pile up in one group and an array is no longer than
    the instrument's grid. ``unique`` skips that step, and its shuffle, for
    points that an audit has shown to be unique.
    """
    points = df if unique else df.groupBy(*spectrum, wavelength).agg(F.avg(value).alias(value))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(wavelength).alias("w"), F.col(value).alias("v"))))
    return (
        points.groupBy(*spectrum)
        .agg(pairs.alias("__p"))
        .select(*spectrum, F.col("__p.w").alias("wavelengths"), F.col("__p.v").alias("spectravalues"))
    )


def unpack(df: DataFrame, spectrum: Sequence[str], wavelengths="wavelengths", values="spectravalues") -> DataFrame:
    """Long rows from packed arrays; no shuffle."""
    zipped = F.arrays_zip(F.col(wavelengths).alias("wavelength"), F.col(values).alias("spectravalue"))
    return df.select(*spectrum, F.inline(zipped))


def scale_packed(values: Column | str, factor: float) -> Column:
    """Every value of a packed spectrum times ``factor``."""
    return F.transform(values, lambda v: v * F.lit(factor))


def scale_bands(df: DataFrame, factor: float, prefix: str = "Wave_") -> DataFrame:
    """Every wavelength column times ``factor``."""
    return df.withColumns({c: F.col(f"`{c}`") * F.lit(factor) for c in df.columns if c.startswith(prefix)})


def wavelength_lookup(df: DataFrame, wavelengths: Sequence[float] | DataFrame) -> DataFrame:
    """Rows at the given wavelengths, from a short list or a table."""
    if isinstance(wavelengths, DataFrame):
        return join(df, wavelengths, ["wavelength"], "semi", null_safe=False)
    return df.where(F.col("wavelength").isin(list(wavelengths)))
