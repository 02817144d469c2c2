"""Column functions that follow the source data's missing-value rules.

The raw tables were written for tools in which a missing value matches itself
in joins and shows up as the text ``NA`` in built keys. Spark's defaults
differ, so these rules are spelled out here once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def paste_na(sep: str, *cols: Column | str) -> Column:
    """Join values with ``sep``; a missing part becomes the text ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("NA")) for c in cols])


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice that stays missing where the condition is missing."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), None).when(cond, yes).otherwise(no)


def is_true(cond: Column) -> Column:
    """A missing condition counts as false."""
    return F.coalesce(cond, F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Exclusion that keeps missing values."""
    return ~is_true(col(c).isin(list(values)))


def matches(c: Column | str, pattern: str) -> Column:
    """Regular-expression test; missing text does not match."""
    return is_true(col(c).rlike(pattern))


def extract(c: Column | str, pattern: str, group: int = 0) -> Column:
    """Matched text, missing where the pattern or the group matches nothing."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def _literal_map(mapping: Mapping) -> Column:
    parts = []
    for key, value in mapping.items():
        parts += [F.lit(key), F.lit(value).cast("string") if value is None else F.lit(value)]
    return F.create_map(*parts)


def recode_lookup(c: Column | str, mapping: Mapping) -> Column:
    """Dictionary lookup; values outside the dictionary become missing."""
    return F.element_at(_literal_map(mapping), col(c))


def recode_keep(c: Column | str, mapping: Mapping) -> Column:
    """Replace the listed values and keep all others."""
    known = col(c).isin(list(mapping))
    return F.when(is_true(known), recode_lookup(c, mapping)).otherwise(col(c))


def update_where(c: Column | str, cond: Column, value) -> Column:
    """Assign ``value`` where the condition holds; a missing condition changes nothing."""
    value = value if isinstance(value, Column) else F.lit(value)
    return F.when(is_true(cond), value).otherwise(col(c))


def strict_mean(c: Column | str) -> Column:
    """Mean that is missing as soon as one value of the group is missing."""
    return F.when(F.count(col(c)) == F.count(F.lit(1)), F.avg(col(c)))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that is missing for a zero denominator."""
    return F.try_divide(col(num), col(den))
