"""Joins with the source data's key rules.

In-memory style joins match missing keys with each other and take all shared
column names as keys. Every operator here plans as an equi-join, so Spark
partitions by key; the forms avoid join types whose skew Spark cannot split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.operators.aggregate import require_unique


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names both sides have, in left order."""
    return [c for c in left.columns if c in right.columns]


def _prefixed(right: DataFrame, on: Sequence[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"__r_{k}" for k in on})


def _condition(on: Sequence[str], null_safe: bool) -> Column:
    def one(k: str) -> Column:
        left, right = F.col(k), F.col(f"__r_{k}")
        return left.eqNullSafe(right) if null_safe else left == right

    return reduce(lambda a, b: a & b, [one(k) for k in on])


def join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | None = None,
    how: str = "left",
    null_safe: bool = True,
    unique_right: bool = False,
) -> DataFrame:
    """Equi-join on ``on`` (default: all shared names); missing keys match each other.

    Left columns come first and keys appear once. ``how`` is inner, left,
    right, full, semi or anti. Right is a left join read the other way round;
    full is one inner join (see ``_full``), which adaptive execution can split
    on a hot key of either side, unlike an outer join on both sides.
    Semi and anti joins reduce the right side to distinct keys before it is
    shuffled, so its hot keys weigh nothing; ``unique_right`` says that the keys
    are distinct already.
    """
    on = list(on) if on is not None else shared_columns(left, right)
    if not on:
        raise ValueError("the tables share no column to join on")
    clash = set(left.columns) & set(right.columns) - set(on)
    if clash and how not in ("semi", "anti"):
        raise ValueError(f"both sides carry {sorted(clash)}; rename or name the keys")
    other = _prefixed(right, on)
    r_keys = [f"__r_{k}" for k in on]
    cond = _condition(on, null_safe)
    if how in ("semi", "anti"):
        keys = other.select(*r_keys)
        return left.join(keys if unique_right else keys.distinct(), cond, f"left_{how}")
    if how in ("inner", "left"):
        return left.join(other, cond, how).drop(*r_keys)
    order = [*left.columns, *[c for c in right.columns if c not in on]]
    if how == "right":
        return join(right, left, on, "left", null_safe).select(*order)
    if how == "full":
        return _full(left, right, on, null_safe).select(*order)
    raise ValueError(f"unknown join type {how}")


def _full(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool) -> DataFrame:
    """Full join as one inner join: each side first gets a blank row per key that only the other side has.

    The keys of both sides are grouped once, with map-side combine; a blank row
    meets just the rows that would stay without a partner. Every input is read
    twice, once for its keys only. Where missing keys do not match, rows with
    one are told apart by their side.
    """
    sides = ((left, 1), (right, 2))
    if not null_safe:
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
        sides = tuple((df.withColumn("__apart", F.when(missing, side).otherwise(0)), side) for df, side in sides)
        on = [*on, "__apart"]
    (left, _), (right, _) = sides
    keys = reduce(lambda a, b: a.unionByName(b), [df.select(*on, F.lit(side).alias("__sides")) for df, side in sides])
    held = keys.groupBy(*on).agg(F.bit_or("__sides").alias("__sides"))
    blank = [held.where(F.col("__sides") == side).select(*on) for side in (2, 1)]
    left, right = (df.unionByName(rows, allowMissingColumns=True) for df, rows in zip((left, right), blank))
    return join(left, right, on, "inner")


# Left and right rows of a cell of spread_join, about: some eight million pairs; rows and pairs of a task; most tasks.
CELL_LEFT, CELL_RIGHT = 8192, 1024
TASK_PAIRS, MOST_TASKS = 1 << 21, 4096


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], cell: tuple[int, int] = (CELL_LEFT, CELL_RIGHT)) -> DataFrame:
    """Left join on keys that both sides repeat; missing keys match each other.

    The pairs of one key grow with the product of its rows, however small the
    tables are, so the work is dealt out by pairs and not by bytes: rows are
    counted per key, the left rows of a key are cut into blocks by their hash,
    so are the right ones, and every pair of blocks is a cell of its own. A row
    is copied once per block of the other side. Left rows without a partner are
    added unpaired. The driver sees the number of pairs, which sets the number of tasks.
    """
    on = list(on)
    rest = [c for c in right.columns if c not in on]
    count = F.count_if(F.col("__left")).alias("__n_left"), F.count_if(~F.col("__left")).alias("__n_right")
    sides = left.select(*on, F.lit(True).alias("__left")).unionByName(right.select(*on, F.lit(False).alias("__left")))
    sizes = sides.groupBy(*on).agg(*count)

    def blocks(n: str, size: int) -> Column:
        return F.ceil(F.col(n) / F.lit(size))

    def all_of(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    sized = join(left, sizes, on, "inner")
    alone = sized.where("__n_right = 0").select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rest])
    rows, columns = blocks("__n_left", cell[0]), blocks("__n_right", cell[1])
    dealt = sized.where("__n_right > 0").withColumn("__row", F.pmod(F.xxhash64(*left.columns), rows)).withColumn("__column", all_of(columns))
    other = join(right, sizes.where("__n_left > 0"), on, "inner").withColumn("__column", F.pmod(F.xxhash64(*right.columns), columns)).withColumn("__row", all_of(rows))
    pairs = F.col("__n_left") * (F.col("__n_right") + 1)
    tasks = min(MOST_TASKS, 1 + (sizes.agg(F.sum(pairs).alias("n")).first()["n"] or 0) // TASK_PAIRS)

    def dealt_out(df: DataFrame) -> DataFrame:
        # One struct a cell; missing parts of structs are equal.
        cell_of = F.struct(*on, "__row", "__column").alias("__cell")
        return df.select(cell_of, *[c for c in df.columns if c in left.columns or c in rest]).repartition(tasks, "__cell")

    paired = join(dealt_out(dealt), dealt_out(other).drop(*on), ["__cell"], "inner", null_safe=False)
    return paired.select(*left.columns, *rest).unionByName(alone)


def full_join_unique(tables: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full join of any number of tables that are unique on ``on``.

    The padded union is grouped by key once: one shuffle for the whole chain
    with map-side combine, and missing keys form one group. The caller makes
    each table unique on the key, as after collapsing duplicates.
    """
    padded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    values = [c for c in padded.columns if c not in on]
    return padded.groupBy(*on).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def update_join(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` of the rows whose key is in ``right``, also with missing values."""
    require_unique(right, on)
    source = right.select(
        *on, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit")
    )
    out = join(left, source, on, "left")
    hit = F.col("__hit").isNotNull()
    return out.withColumns(
        {c: F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)) for c in columns}
    ).drop("__hit", *[f"__new_{c}" for c in columns])


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table to every row."""
    rows = one_row.take(2)
    if len(rows) != 1:
        raise ValueError("expected exactly one row to attach")
    types = {f.name: f.dataType for f in one_row.schema.fields}
    return df.withColumns({k: F.lit(v).cast(types[k]) for k, v in rows[0].asDict().items()})


def resolve_species(df: DataFrame, species_dict: DataFrame, project: str | None = None) -> DataFrame:
    """Add ``speciescode`` by data code within a project; unknown codes stay missing."""
    codes = species_dict.select("speciesdatacode", "projectcode", "speciescode")
    if project is not None:
        codes = codes.where(F.col("projectcode") == project).drop("projectcode")
        return join(df, codes, ["speciesdatacode"], "left")
    return join(df, codes, ["speciesdatacode", "projectcode"], "left")


def keep_common_wavelengths(spectra: DataFrame, spectrum: str, wavelength: str) -> DataFrame:
    """Rows whose wavelength occurs in every spectrum: the inner fold over all spectra.

    Counting distinct spectra per wavelength replaces the chain of inner joins.
    """
    pairs = spectra.select(spectrum, wavelength).distinct()
    total = pairs.select(spectrum).distinct().agg(F.count(F.lit(1)).alias("__total"))
    per_wl = pairs.groupBy(wavelength).agg(F.count(F.lit(1)).alias("__n"))
    n = total.first()["__total"]
    common = per_wl.where(F.col("__n") == n).select(wavelength)
    return join(spectra, common, [wavelength], "semi")
