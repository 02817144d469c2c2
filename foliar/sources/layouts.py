"""Files whose meaning depends on the place of a line or a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.functions.nulls import is_true
from foliar.operators.joins import join
from foliar.operators.ordered import fill_down, row_number_global, row_number_in_group


def sectioned(
    lines: DataFrame, names: Sequence[str], group: Sequence[str], order: Sequence[str], value: str = "value"
) -> DataFrame:
    """Rows under section headers, with the header's label as ``info``.

    A line whose first field is not a number is a header; all of its fields
    must repeat one label. The label is carried down to the next header.
    """
    parts = F.split(F.trim(value), r"\s+")
    rows = lines.select(*group, *order, parts.alias("__f")).where(F.get("__f", F.lit(0)) != "")
    header = F.get("__f", F.lit(0)).try_cast("double").isNull()
    labels = F.array_distinct("__f")
    mixed = rows.where(header & (F.size(labels) != 1))
    if not mixed.isEmpty():
        raise ValueError("a section header carries more than one label")
    marked = rows.withColumn("info", F.when(header, F.get(labels, F.lit(0)))).withColumn("__h", header)
    filled = fill_down(marked, "info", group, order)
    columns = [F.get("__f", F.lit(i)).try_cast("double").alias(n) for i, n in enumerate(names)]
    return filled.where(~F.col("__h")).select(*group, *order, "info", *columns)


def ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a column with their rank in sorted order, from 1."""
    return row_number_global(df.select(column).distinct(), [column], name)


def bind_columns(
    lines: DataFrame, samples: DataFrame, day: str, sample: str, order: Sequence[str], sep: str = ","
) -> DataFrame:
    """Long spectra from headerless matrices whose columns follow a sample list.

    The n-th file in name order belongs to the n-th day; after the wavelength,
    the k-th column of a file belongs to the k-th sample of its day. Rows at
    wavelength 0 and missing cells are dropped, blank lines passed over. As many
    files as days are demanded, and on every line one cell per sample of the day.
    """
    files = ranked(lines, "file", "__rank")
    days = ranked(samples, day, "__rank")
    if files.count() != days.count():
        raise ValueError("there are not as many files as days")
    placed = join(lines, join(files, days, ["__rank"], "inner").drop("__rank"), ["file"], "inner")
    parts = F.split(F.trim("value"), sep)
    # Split once per line, below the explode.
    split = placed.where(F.trim("value") != "").select(day, parts.alias("__cells"))
    width, missing = (F.size("__cells") - 1).cast("long"), F.lit(None).cast("long")
    sizes = split.select(day, width.alias("__w"), missing.alias("__n")).unionByName(samples.groupBy(day).agg(missing.alias("__w"), F.count(F.lit(1)).alias("__n")))
    sizes = sizes.groupBy(day).agg(F.min("__w").alias("__low"), F.max("__w").alias("__high"), F.sum("__n").alias("__n"))
    unlike = sizes.where(~(F.col("__low").eqNullSafe(F.col("__n")) & F.col("__high").eqNullSafe(F.col("__n")))).select(day).limit(5).collect()
    if unlike:
        raise ValueError(f"not as many cells as samples on days {sorted(str(r[day]) for r in unlike)}")
    split = split.select(day, F.get("__cells", F.lit(0)).try_cast("double").alias("wavelength"), "__cells")
    cells = (
        split.select(day, "wavelength", F.posexplode("__cells"))
        .where((F.col("pos") > 0) & ~is_true(F.col("wavelength") == 0))
        .select(
            day, "wavelength", F.col("pos").cast("long").alias("__k"), F.col("col").try_cast("double").alias("spectravalue")
        )
        .where(F.col("spectravalue").isNotNull())
    )
    listed = row_number_in_group(samples.select(day, sample, *[c for c in order if c != sample]), [day], order, "__k")
    return join(cells, listed.select(day, "__k", sample), [day, "__k"], "inner").select(
        sample, "wavelength", "spectravalue"
    )


def header_to_long(
    lines: DataFrame, key: str, name: str, value: str, skip: Sequence[str] = (), sep: str = r"[,\s]+"
) -> DataFrame:
    """Long rows from files with one column per sample, each file with its own header.

    All files are scanned at once: the first line of a file names its columns
    and is joined back to the file's other lines. A header without the key and
    a line of another width are errors; blank lines are passed over.
    """
    first = lines.groupBy("file").agg(F.min(F.struct("block", "row", "value")).alias("__first"))
    first = first.select("file", F.col("__first.value").alias("__head"), F.struct("__first.block", "__first.row").alias("__place"))
    body = join(lines, first, ["file"], "inner").where((F.struct("block", "row") != F.col("__place")) & (F.trim("value") != ""))
    names, cells = F.split(F.trim("__head"), sep), F.split(F.trim("value"), sep)
    at = F.array_position(names, key).cast("int") - 1
    # Split once per line, below the explode.
    split = body.select("file", names.alias("__names"), cells.alias("__cells"), at.alias("__at"))
    unlike = split.where((F.col("__at") < 0) | (F.size("__names") != F.size("__cells"))).select("file").limit(5).collect()
    if unlike:
        raise ValueError(f"no column {key!r} or lines of another width in {sorted({r['file'] for r in unlike})}")
    split = split.select("file", F.get("__cells", F.col("__at")).try_cast("double").alias(key), "__names", "__cells")
    cell = split.select("file", key, "__names", F.posexplode("__cells")).select("file", key, F.get("__names", F.col("pos")).alias(name), F.col("col").try_cast("double").alias(value))
    return cell.where(~F.col(name).isin(key, *skip))
