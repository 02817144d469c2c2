"""Resampling of packed spectra to a whole-number wavelength grid."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliar.operators.reshape import pack, unpack

_GRID = T.StructType(
    [T.StructField("first", T.LongType()), T.StructField("values", T.ArrayType(T.DoubleType()))]
)

# One corrupt wavelength must not make a grid that fills a task's memory.
MAX_GRID = 1_000_000


def spline_coefficients(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes at the left ends and sixths of the second derivatives, row by row.

    ``x`` and ``y`` hold one spectrum per row, all with the same number of
    sorted, distinct points (two or more); the solve runs over all rows at
    once. The end pieces are cubics through the outer four points (Forsythe,
    Malcolm and Moler 1977); with fewer points these terms drop out and the
    curve is a line or a parabola.
    """
    n = x.shape[1]
    h = np.diff(x, axis=1)
    d = np.diff(y, axis=1) / h
    s = np.zeros_like(x)
    if n > 2:
        diag = np.empty_like(x)
        rhs = np.zeros_like(x)
        diag[:, 0], diag[:, -1] = -h[:, 0], -h[:, -1]
        diag[:, 1:-1] = 2.0 * (h[:, :-1] + h[:, 1:])
        rhs[:, 1:-1] = np.diff(d, axis=1)
        if n > 3:
            second = np.diff(d, axis=1) / (x[:, 2:] - x[:, :-2])
            third = np.diff(second, axis=1) / (x[:, 3:] - x[:, :-3])
            rhs[:, 0] = h[:, 0] ** 2 * third[:, 0]
            rhs[:, -1] = -(h[:, -1] ** 2) * third[:, -1]
        for i in range(1, n):
            w = h[:, i - 1] / diag[:, i - 1]
            diag[:, i] -= w * h[:, i - 1]
            rhs[:, i] -= w * rhs[:, i - 1]
        s[:, -1] = rhs[:, -1] / diag[:, -1]
        for i in range(n - 2, -1, -1):
            s[:, i] = (rhs[:, i] - h[:, i] * s[:, i + 1]) / diag[:, i]
    return d - h * (s[:, 1:] + 2.0 * s[:, :-1]), s


def spline_at(x: np.ndarray, y: np.ndarray, xout: np.ndarray) -> np.ndarray:
    """One spectrum's spline at ``xout``."""
    if len(x) == 1:
        return np.full(len(xout), y[0])
    b, s = spline_coefficients(x[None, :], y[None, :])
    return _evaluate(x, y, b[0], s[0], xout)


def _evaluate(x, y, b, s, xout):
    h = np.diff(x)
    k = np.clip(np.searchsorted(x, xout, side="right") - 1, 0, len(x) - 2)
    t = xout - x[k]
    return y[k] + t * (b[k] + t * (3.0 * s[k] + t * (s[k + 1] - s[k]) / h[k]))


@F.pandas_udf(_GRID)
def _on_grid(wavelengths: pd.Series, values: pd.Series) -> pd.DataFrame:
    """Spectra of one batch, solved together for each number of points."""
    lengths = wavelengths.map(len).to_numpy()
    firsts: list = [None] * len(lengths)
    out: list = [None] * len(lengths)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        x = np.stack([np.asarray(wavelengths.iloc[i], dtype=float) for i in rows])
        y = np.stack([np.asarray(values.iloc[i], dtype=float) for i in rows])
        b, s = spline_coefficients(x, y) if n > 1 else (None, None)
        for j, i in enumerate(rows):
            low, high = int(np.ceil(x[j, 0])), int(np.floor(x[j, -1]))
            if high - low >= MAX_GRID:
                raise ValueError(f"wavelengths from {x[j, 0]} to {x[j, -1]} span more than {MAX_GRID} grid points")
            grid = np.arange(low, high + 1, dtype=float)
            firsts[i] = low
            out[i] = np.full(len(grid), y[j, 0]) if n == 1 else _evaluate(x[j], y[j], b[j], s[j], grid)
    return pd.DataFrame({"first": firsts, "values": out})


def resample_to_packed(df: DataFrame, spectrum: Sequence[str], value_columns: dict[str, str]) -> DataFrame:
    """Spectra on the whole-number grid, one row each, from packed, sorted spectra.

    ``value_columns`` maps a spectrum kind to its array column; all kinds share
    ``wavelengths``. There is no shuffle: each spectrum is one row and passes
    through the interpolation in Arrow batches.
    """
    kinds = [
        F.struct(F.lit(kind).alias("spectratype"), F.col(c).alias("values")) for kind, c in value_columns.items()
    ]
    one = df.select(*spectrum, "wavelengths", F.inline(F.array(*kinds)))
    grid = one.where(F.size("wavelengths") > 0).select(
        *spectrum, "spectratype", _on_grid("wavelengths", "values").alias("g")
    )
    first = F.col("g.first")
    wavelengths = F.transform("g.values", lambda _, i: (first + i).cast("double"))
    return grid.select(*spectrum, "spectratype", wavelengths.alias("wavelengths"), F.col("g.values").alias("spectravalues"))


def resample_packed(df: DataFrame, spectrum: Sequence[str], value_columns: dict[str, str]) -> DataFrame:
    """Long rows on the whole-number grid from packed, sorted spectra."""
    return unpack(resample_to_packed(df, spectrum, value_columns), [*spectrum, "spectratype"])


def resample_long(df: DataFrame, spectrum: Sequence[str], spectratype: str) -> DataFrame:
    """Resample long spectra: points without a value are left out, repeats averaged."""
    clean = df.where(F.col("wavelength").isNotNull() & F.col("spectravalue").isNotNull())
    return resample_packed(pack(clean, spectrum), spectrum, {spectratype: "spectravalues"})
