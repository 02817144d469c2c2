"""nasa_hyspiri: averaged spectra of many field campaigns, described by coded names and paths."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions import parse
from foliar.functions.nulls import extract, paste_na, ratio, recode_keep, recode_lookup
from foliar.operators import columns, filters
from foliar.operators.aggregate import group_mean_by_rows
from foliar.operators.joins import join
from foliar.operators.ordered import row_number_global
from foliar.operators.reshape import melt, wide_to_packed
from foliar.plans.batch import Batch, Contact, project_row, rows, stored
from foliar.sources.catalog import PACKED
from foliar.sources.folder import PLACE, file_name, read_folder

PROJECT = "nasa_hyspiri"

# Project row, file name, crop names by species code, site names by code.
PROJECT_ROW = (PROJECT, "NASA HyspIRI field campaign")
FILE_NAME, EXCLUDED_PATH = "Averaged_Spectra.csv", "(?i)canopy"
SPECIES = {
    "ImmatureOat": "AVENA",
    "ImmatureOats": "AVENA",
    "MatureOat": "AVENA",
    "Almond": "PRDU",
    "CAAN4sweet": "CAAN4",
    "CAAN": "CAAN4",
    "MandarinOrange": "CIRE3",
    "OrangeTree": "CITRU2",
    "Peach": "PRPE3",
    "LemonTree": "CILI5",
    "Grape": "VITIS",
    "OakMistletoe": "PHLE14",
    "NPV": None,
}
SITES = {"Kingsburg": "KING", "Shafter": "SHAF", "Russell Ranch": "RR"}
SUNSHADE = {"B": "shade", "M": "shade", "T": "sun"}
TRAITS = {"Perc_C": "leaf_C_pct_mass", "Perc_N": "leaf_N_pct_mass", "Perc_H": "leaf_H_pct_mass"}


def describe(spectra: DataFrame) -> DataFrame:
    """Sample columns of each spectrum from its name and the path of its file."""
    folder = F.regexp_replace("file_path", "/[Pp]rocessed.*$", "")
    df = spectra.withColumn("folder", folder)
    df = df.withColumns(
        {
            "Campaign": extract("folder", r"(?<=/)\p{Alpha}+\d{4}(?=/)"),
            "collectiondate": parse.campaign_date("folder"),
        }
    )
    df = df.withColumn("year", parse.year_of("collectiondate", "folder"))
    df = df.withColumns(parse.coded_name("Spectra"))
    df = df.where(F.col("Sample_Name").isNotNull()).withColumns(
        {"speciescode": recode_keep("species", SPECIES), "plot": parse.plot_label("plot")}
    )
    project = F.lit(PROJECT)
    df = df.withColumns(
        {
            "projectcode": project,
            "samplecode": parse.samplecode(project, paste_na("_", "Sample_Name", "Campaign"), "year"),
            "sitecode": parse.dotted(project, "site"),
            "sunshade": recode_lookup("CanopyPosition", SUNSHADE),
        }
    )
    df = df.withColumn("plotcode", parse.dotted("sitecode", "plot"))
    return group_mean_by_rows(df, ["samplecode"], "collectiondate")


def from_folder(
    spark: SparkSession, root: str, gps: DataFrame, chn: DataFrame, contact: Contact = Contact(), name_of: Callable[[str], Column] = file_name
) -> Batch:
    """Every file of the one name below ``root``, whatever its campaign's columns, but those of canopies."""
    files = read_folder(spark, root, f"^{re.escape(FILE_NAME)}$", EXCLUDED_PATH, sep=",", name_of=name_of).require(["Spectra"])
    lines = files.packed("Wave_", {"Spectra": "string"})
    paths = files.files.select("file", F.col("path").alias("file_path"))
    batch = build(join(lines, paths, ["file"], "inner", null_safe=False), gps, chn, PLACE, contact)
    batch.ledger = files.ledger("spectra", "^Wave_")
    return batch


def build(
    spectra_raw: DataFrame, gps: DataFrame, chn: DataFrame, order: list[str], contact: Contact = Contact()
) -> Batch:
    """``spectra_raw`` has Spectra, file_path, the ``order`` columns and Wave_ columns or packed spectra.

    The order columns (file and line) identify a row. Only the narrow columns
    are sorted and numbered; the wavelength columns meet them once, by row.
    """
    spark = spectra_raw.sparkSession
    leaves = filters.leaf_only(spectra_raw, "Spectra")
    if "wavelengths" not in leaves.columns:
        leaves = wide_to_packed(leaves, [c for c in leaves.columns if not c.startswith("Wave_")])
    numbered = row_number_global(leaves.drop(*PACKED), order, "specnum")
    described = stored(describe(numbered), "hyspiri-samples")
    samples = described.select("samplecode", "projectcode", "year", "plotcode", "speciescode", "collectiondate").distinct()
    means = gps.groupBy("Site").agg(F.avg("Latitude").alias("latitude"), F.avg("Longitude").alias("longitude"))
    located = means.select(
        parse.dotted(F.lit(PROJECT), recode_keep("Site", SITES)).alias("sitecode"), "latitude", "longitude"
    )
    conditions = melt(
        described.select("samplecode", "CanopyPosition", "sunshade"), ["samplecode"], ["CanopyPosition", "sunshade"],
        "condition", "conditionvalue", drop_null=True,
    ).distinct()
    info = described.select(
        *order, "samplecode", "spectratype", F.concat_ws(" ", "specnum", "Spectra").alias("spectracomment")
    )
    packed = join(leaves.select(*order, *PACKED), info, order, "inner").drop(*order)
    analysed = columns.rename(chn.withColumnRenamed("Sample_Year", "year"), TRAITS)
    # Fan-out is wanted: one analysis belongs to every campaign's sample of that name and year.
    coded = join(
        analysed, described.select("Sample_Name", "year", "samplecode").distinct(), ["Sample_Name", "year"], "inner"
    ).withColumn("leaf_CN_ratio_mass", ratio("leaf_C_pct_mass", "leaf_N_pct_mass"))
    traits = melt(coded, ["samplecode"], columns.with_prefix(coded, "leaf_"), "trait", "traitvalue", drop_null=True)
    return Batch(
        projects=project_row(spark, *PROJECT_ROW, contact=contact),
        sites=described.select("sitecode").distinct(),
        plots=join(described.select("sitecode", "plotcode").distinct(), located, ["sitecode"], "left"),
        samples=samples,
        conditions=conditions,
        condition_info=rows(spark, "condition string", ("CanopyPosition",), ("sunshade",)),
        spectra_info=info.drop(*order),
        packed=packed,
        traits=traits,
        trait_info=traits.select("trait").distinct(),
    )
