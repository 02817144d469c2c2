"""Folders of delimited files with headers of their own: one scan, typed by name, with a ledger of what was read.

The lines of all files are read at once and split once. Files that share a
header share a layout, so places of columns are looked up once per layout and
not per file or line. ``table``, ``packed`` and ``long`` read the same stored
lines; ``ledger`` says for every file how many lines and cells it had, how many
were missing and how many were refused, because they are no number where one
is declared. Files of no bytes are not seen by Spark and not in the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.operators.joins import join
from foliar.session import materialize
from foliar.sources.files import read_lines

MISSING = ("", "NA", "NaN", "#N/A")
PLACE = ["file", "block", "row"]


def file_name(path: str | Column = "file") -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def cells_of(value: Column, sep: str) -> Column:
    """Fields of a line: quoted ones may hold the separator and doubled quotes."""
    plain = F.split(value, sep)
    # Only lines with quotes look ahead for them.
    quoted = F.split(value, f'(?:{sep})(?=(?:[^"]*"[^"]*")*[^"]*$)')
    bare = F.transform(quoted, lambda c: F.when(c.rlike('^".*"$'), F.regexp_replace(F.substr(c, F.lit(2), F.length(c) - 2), '""', '"')).otherwise(c))
    return F.transform(F.when(F.contains(value, F.lit('"')), bare).otherwise(plain), lambda c: F.trim(c))


def present(cell: Column) -> Column:
    """A cell's text, missing where it says so."""
    return F.when(~cell.isin(*MISSING), cell)


@dataclass(frozen=True)
class Folder:
    """Split lines (file, block, row, layout, cells), the names of each layout and the files."""

    lines: DataFrame
    layouts: DataFrame  # layout, names
    files: DataFrame  # file, name, path, bytes; the path is the one below the folder

    def _with(self, **per_layout: Column) -> DataFrame:
        """Lines with columns computed from the names of their layout."""
        return join(self.lines, self.layouts.select("layout", *[c.alias(n) for n, c in per_layout.items()]), ["layout"], "inner", null_safe=False)

    def require(self, names: Sequence[str]) -> Folder:
        """Every header must have the columns."""
        lacking = self.layouts.where(~F.forall(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains("names", n)))
        heads = lacking.select(F.slice("names", 1, 8).alias("names")).limit(3).collect()
        if heads:
            raise ValueError(f"headers without {list(names)}: {[r.names for r in heads]}")
        return self

    def table(self, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
        """Typed columns by name; a column that a file lacks is missing there, and so is a cell that does not fit its type."""
        at = {f"__{i}": F.array_position("names", name).cast("int") - 1 for i, name in enumerate(columns)}
        cell = lambda i: present(F.get("cells", F.when(F.col(f"__{i}") >= 0, F.col(f"__{i}"))))
        return self._with(**at).select(*keep, *[cell(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(columns.items())])

    def packed(self, prefix: str, columns: Mapping[str, str] | None = None, keep: Sequence[str] = PLACE) -> DataFrame:
        """One row per line: its spectrum from the columns named ``prefix`` and a wavelength, as arrays, and typed columns."""
        columns = columns or {}
        places = F.filter(F.transform("names", lambda n, i: F.struct(F.when(F.startswith(n, F.lit(prefix)), F.substr(n, F.lit(len(prefix) + 1))).try_cast("double").alias("w"), i.alias("i"))), lambda s: s["w"].isNotNull())
        at = {f"__{i}": F.array_position("names", name).cast("int") - 1 for i, name in enumerate(columns)}
        rows = self._with(__bands=places, **at)
        cell = lambda i: present(F.get("cells", F.when(F.col(f"__{i}") >= 0, F.col(f"__{i}"))))
        values = F.transform("__bands", lambda b: present(F.get("cells", b["i"])).try_cast("double"))
        return rows.select(*keep, *[cell(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(columns.items())], F.col("__bands.w").alias("wavelengths"), values.alias("spectravalues"))

    def long(self, key: str, name: str, value: str, skip: Sequence[str] = ()) -> DataFrame:
        """(file, key, name, value) from files with one column per sample; missing cells and cells that are no number have no value."""
        self.require([key])
        rows = self._with(__names=F.col("names"), __at=F.array_position("names", key).cast("int") - 1)
        number = present(F.get("cells", F.col("__at"))).try_cast("double").alias(key)
        cells = rows.select("file", number, "__names", F.posexplode("cells")).select("file", key, F.get("__names", F.col("pos")).alias(name), present(F.col("col")).try_cast("double").alias(value))
        return cells.where(F.col(name).isNotNull() & ~F.col(name).isin(key, *skip))

    def ledger(self, source: str, numeric: Sequence[str] | str | None = None) -> DataFrame:
        """(source, path, bytes, lines, wrong_width, cells, missing, refused) per file.

        ``numeric`` lists the columns that hold numbers, or is a regex of them; without it all cells are to be
        numbers, and lines of a layout without names have no width.
        """
        if numeric is None:
            wanted = lambda n: F.lit(True)
        elif isinstance(numeric, str):
            wanted = lambda n: n.rlike(numeric)
        else:
            wanted = lambda n: n.isin(*numeric)
        places = F.filter(F.transform("names", lambda n, i: F.when(wanted(n), i)), lambda i: i.isNotNull())
        rows = self._with(__numeric=places, __width=F.size("names"))
        odd = lambda c: present(c).isNotNull() & present(c).try_cast("double").isNull()
        refused = F.size(F.filter("cells", odd) if numeric is None else F.filter("__numeric", lambda i: odd(F.get("cells", i))))
        missing = F.size(F.filter("cells", lambda c: present(c).isNull()))
        counts = {"lines": F.lit(1), "wrong_width": ((F.col("__width") > 0) & (F.size("cells") != F.col("__width"))).cast("int"), "cells": F.size("cells"), "missing": missing, "refused": refused}
        sums = list(counts)
        counted = rows.select("file", *[c.alias(f"__{n}") for n, c in counts.items()]).groupBy("file").agg(*[F.sum(f"__{n}").alias(n) for n in sums])
        listed = join(self.files, counted, ["file"], "left", null_safe=False)
        return listed.select(F.lit(source).alias("source"), "path", "bytes", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums])


def _below(root: str) -> Column:
    """Path below the folder, with a slash before it."""
    tail = root.split("://")[-1].rstrip("/")
    at = F.locate(tail, F.col("file"))
    return F.when(at > 0, F.substr("file", at + len(tail))).otherwise(F.col("file"))


def read_folder(
    spark: SparkSession, root: str, name: str | None = None, exclude: str | None = None, sep: str = r"[,\s]+",
    names: Sequence[str] | None = None, pattern: str | None = None, name_of: Callable[[str], Column] = file_name,
) -> Folder:
    """All files below ``root`` in one scan, split and stored.

    ``name`` is a regex on the file's name, ``exclude`` one on the path below
    the folder and ``pattern`` a glob on the name that already the listing
    applies. ``name_of`` says what a file's name is, by default the last part of
    its path; a folder written by Spark may hold it in a partition. The first
    line of a file names its columns unless ``names`` gives them. Blank lines
    are passed over; a line of another width keeps its cells, by place, and is
    counted in the ledger.
    """

    def kept(df: DataFrame) -> DataFrame:
        df = df.where(name_of("file").rlike(name)) if name else df
        return df.where(~_below(root).rlike(exclude)) if exclude else df

    lines = kept(read_lines(spark, root, pattern))
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        listing = listing.option("pathGlobFilter", pattern)
    files = kept(listing.load(root).select(F.col("path").alias("file"), F.col("length").alias("bytes")))
    files = files.select("file", name_of("file").alias("name"), _below(root).alias("path"), "bytes")
    full = F.trim("value") != ""
    if names is not None:
        body = lines.where(full).withColumn("layout", F.lit(0).cast("long"))
        layouts = spark.range(1).select(F.lit(0).cast("long").alias("layout"), F.array(*[F.lit(n) for n in names]).cast("array<string>").alias("names"))
    else:
        first = lines.where(full).groupBy("file").agg(F.min(F.struct("block", "row", "value")).alias("__first"))
        head = F.regexp_replace("__first.value", "^﻿", "")
        first = materialize(first.select("file", head.alias("__head"), F.xxhash64(head).alias("layout"), F.struct("__first.block", "__first.row").alias("__place")), "headers")
        layouts = first.groupBy("layout").agg(F.min("__head").alias("__head"), F.max("__head").alias("__other"))
        layouts = materialize(layouts.select("layout", cells_of(F.trim("__head"), sep).alias("names"), (F.col("__head") != F.col("__other")).alias("__clash")), "layouts")
        repeated = layouts.where(F.col("__clash") | (F.size(F.array_distinct("names")) != F.size("names"))).select("names").limit(1).collect()
        if repeated:
            raise ValueError(f"a header repeats a column: {repeated[0].names[:20]}")
        layouts = layouts.drop("__clash")
        body = join(lines, first.drop("__head"), ["file"], "inner", null_safe=False)
        body = body.where(full & (F.struct("block", "row") != F.col("__place")))
    split = body.select(*PLACE, "layout", cells_of(F.trim("value"), sep).alias("cells"))
    return Folder(materialize(split, "folder-lines"), layouts, files)


def require_files(listed: DataFrame, column: str, folder: Folder) -> None:
    """Every listed file name must be a file of the folder."""
    have = folder.files.select(F.col("name").alias(column)).distinct()
    lost = join(listed.select(column).where(F.col(column).isNotNull()).distinct(), have, [column], "anti", null_safe=False, unique_right=True)
    names = [r[column] for r in lost.limit(5).collect()]
    if names:
        raise ValueError(f"listed files that are not there: {names}")
