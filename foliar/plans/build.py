"""Build a whole catalog: reset, reference tables, projects, audits and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliar.operators import quality
from foliar.plans import reference_data
from foliar.plans.batch import Batch, load_all
from foliar.plans.report import REPORTS
from foliar.sources.catalog import Catalog


def build_catalog(
    catalog: Catalog,
    reference: dict[str, DataFrame],
    projects: Iterable[Callable[[DataFrame], Batch]],
) -> Catalog:
    """Fill an empty catalog.

    ``reference`` has projects, species, dictionary and attributes. Each
    project is a function of the loaded species dictionary. All projects'
    dimension rows go into one merge per table, their facts side by side.
    """
    catalog.reset()
    reference_data.load(catalog, **reference)
    dictionary = catalog.table("species_dict")
    load_all(catalog, [project(dictionary) for project in projects])
    return catalog


def audits(catalog: Catalog) -> dict[str, DataFrame]:
    tables = {name: df for name, df in catalog.tables().items() if name != "species_attributes"} | catalog.links()
    return {
        "unique": quality.audit_unique(tables),
        "orphans": quality.audit_orphans(tables),
        "not_null": quality.audit_not_null(tables),
        "positive": quality.audit_positive(tables),
    }


def export(tables: dict[str, DataFrame], folder: str) -> None:
    """Write report tables as CSV folders with a header."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}")


def export_together(tables: dict[str, DataFrame], folder: str) -> None:
    """Write all report tables in one job: JSON lines, one folder ``report=<name>`` each with the report's own columns."""
    lines = [df.select(F.lit(name).alias("report"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")) for name, df in tables.items()]
    reduce(lambda a, b: a.unionByName(b), lines).write.mode("overwrite").partitionBy("report").text(folder)


def read_export(spark: SparkSession, folder: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """The exported reports under their schemas."""
    lines = spark.read.schema("value string, report string").text(folder)
    return {name: lines.where(F.col("report") == name).select(F.from_json("value", schema).alias("r")).select("r.*") for name, schema in schemas.items()}


def reports(catalog: Catalog) -> dict[str, DataFrame]:
    tables = catalog.tables()
    return {name: report(tables) for name, report in REPORTS.items()}
