"""Delimited files: one distributed scan per folder, never a loop over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions.nulls import is_true


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str,
    header: bool = True,
    sep: str = ",",
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Typed scan with ``NA`` as missing.

    Columns are found by the declared order, so each folder holds one layout.
    ``pattern`` is a file-name glob.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("nullValue", "NA")
        .option("enforceSchema", "true")
        .option("recursiveFileLookup", recursive)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path if isinstance(path, str) else list(path))


def with_file(df: DataFrame, name: str = "fname", full: bool = False) -> DataFrame:
    """Keep the source file's name, or its whole path, as a column."""
    return df.select("*", F.col("_metadata.file_path" if full else "_metadata.file_name").alias(name))


def read_tree(
    spark: SparkSession, root: str, file_name: str, schema: str, exclude: str | None = None, header: bool = True
) -> DataFrame:
    """All files of one name below ``root``, with their path; ``exclude`` is a regex on the path."""
    df = with_file(read_csv(spark, root, schema, header=header, pattern=file_name, recursive=True), "file_path", True)
    return df.where(~F.col("file_path").rlike(exclude)) if exclude else df


def read_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Text lines with file, and (block, row) as their order within the file."""
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def split_fields(lines: DataFrame, names: Sequence[str], dtype: str = "double", sep: str = r"\s+") -> DataFrame:
    """Columns from separated text; fields that do not parse become missing."""
    parts = F.split(F.trim("value"), sep)
    columns = [F.get(parts, F.lit(i)).try_cast(dtype).alias(c) for i, c in enumerate(names)]
    keep = [c for c in lines.columns if c != "value"]
    return lines.where(F.trim("value") != "").select(*keep, *columns)


def read_delimited(
    spark: SparkSession, path: str, names: Sequence[str], dtype: str = "double", pattern: str | None = None
) -> DataFrame:
    """Headerless columns separated by blanks or tabs, with the file they come from."""
    return split_fields(read_lines(spark, path, pattern), names, dtype).drop("block", "row")


def drop_header_lines(lines: DataFrame, names: Sequence[str], sep: str = r"\s+") -> DataFrame:
    """Drop lines that only repeat the column names."""
    parts = F.split(F.trim("value"), sep)
    return lines.where(~is_true(parts == F.array(*[F.lit(n) for n in names])))
