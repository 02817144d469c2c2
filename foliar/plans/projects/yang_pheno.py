"""yang_pheno: one trait sheet per trait and headerless spectra matrices by day of year."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import paste_na, recode_lookup
from foliar.operators import columns
from foliar.operators.joins import resolve_species
from foliar.operators.quality import require_counts_match
from foliar.operators.reshape import melt, names_to_long, pivot
from foliar.plans.batch import Batch, rows, stored, units_of
from foliar.sources.folder import read_folder
from foliar.sources.layouts import bind_columns

PROJECT = "yang_pheno"

# Catalog trait and its sheet, sites, species by barcode prefix.
SHEETS = {
    "leaf_chla_per_area": "Chla",
    "leaf_chlb_per_area": "Chlb",
    "leaf_chltot_per_area": "TotChl",
    "leaf_mass_per_area": "LMA",
    "leaf_cartot_per_area": "Car",
    "leaf_C_pct_mass": "TotC",
    "leaf_N_pct_mass": "TotN",
}
PIGMENTS = ["leaf_chla_per_area", "leaf_chlb_per_area", "leaf_chltot_per_area", "leaf_cartot_per_area"]
SITES = [
    ("yang_pheno.MV", "Martha's Vineyard, MA, USA", 41.362, -70.578),
    ("yang_pheno.HF", "Harvard Forest, Petersham, MA, USA", 42.531, -72.190),
]
SPECIES = {"RO": "Quercus rubra", "RM": "Acer rubrum", "YB": "Betula alleghaniensis"}
FOLDERS = {
    (2011, "MV"): {"reflectance": "2011-MV"},
    (2012, "HF"): {"reflectance": "2012_HF/ref", "transmittance": "2012_HF/tra"},
}
ONE_SPECIES = {"MV": "Quercus rubra"}
UNIT_RULES = [("_pct_mass", "%"), ("_per_area", "kg m-2")]


def leaf_order(sheets: Mapping[str, DataFrame]) -> list[str]:
    """Leaf barcodes in the order in which the sheets first name them."""
    seen: dict[str, None] = {}
    for trait, sheet in SHEETS.items():
        if sheet in sheets:
            seen.update(dict.fromkeys(columns.drop_unnamed(sheets[sheet]).columns[1:]))
    return list(seen)


def traits_by_leaf(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per day and barcode with a column per trait; days that are no number are dropped."""
    parts = []
    for trait, sheet in SHEETS.items():
        df = columns.drop_unnamed(sheets[sheet])
        day, *leaves = df.columns
        df = clean.retype(df.withColumnRenamed(day, "DOY"), ["DOY", *leaves], "double").where(F.col("DOY").isNotNull())
        parts.append(names_to_long(df, ["DOY"], leaves, "barcode", "traitvalue").withColumn("trait", F.lit(trait)))
    long = reduce(lambda a, b: a.unionByName(b), parts)
    return pivot(long, ["DOY", "barcode"], "trait", "traitvalue", list(SHEETS))


def describe(leaves: DataFrame, site: str, year: int, order: list[str]) -> DataFrame:
    prefix = F.regexp_replace("barcode", "(RO|RM|YB).*", "$1")
    species = F.lit(ONE_SPECIES[site]) if site in ONE_SPECIES else recode_lookup(prefix, SPECIES)
    day = F.col("DOY").cast("int")
    code = F.lit(PROJECT)
    return leaves.withColumns(
        {
            "projectcode": code,
            "year": F.lit(year),
            "sitecode": parse.dotted(code, F.lit(site)),
            "samplecode": parse.samplecode(code, paste_na("_", "barcode", day), F.lit(year)),
            "collectiondate": parse.doy_to_date(F.lit(year), day),
            "speciesdatacode": species,
            "sunshade": parse.sunshade_by_letter("barcode"),
            # Place of the leaf among the sheet columns: the matrices follow it.
            "leaf_no": F.array_position(F.array(*[F.lit(c) for c in order]), F.col("barcode")),
        }
    ).withColumn("plotcode", F.col("sitecode"))


def spectra(lines: DataFrame, samples: DataFrame, kind: str) -> DataFrame:
    """Bind one folder's matrices to the samples of their days; one file per day is required."""
    require_counts_match(lines, "file", samples, "DOY")
    listed = samples.select("DOY", "samplecode", "leaf_no")
    return bind_columns(lines, listed, "DOY", "samplecode", ["leaf_no"]).withColumn("spectratype", F.lit(kind))


def from_folder(
    spark: SparkSession, root: str, sheets: Mapping[str, DataFrame], species_dict: DataFrame, site: str, year: int
) -> Batch:
    """Matrices below ``2011-MV``, or ``2012_HF/ref`` and ``2012_HF/tra``; the sheets come as tables."""
    kinds = {k: read_folder(spark, f"{root.rstrip('/')}/{p}", sep=",", names=[]) for k, p in FOLDERS[year, site].items()}
    lines = {k: f.lines.select("file", F.array_join("cells", ",").alias("value")) for k, f in kinds.items()}
    batch = build(sheets, lines, species_dict, site, year)
    batch.ledger = reduce(lambda a, b: a.unionByName(b), [f.ledger(k) for k, f in kinds.items()])
    return batch


def build(
    sheets: Mapping[str, DataFrame],
    matrices: Mapping[str, DataFrame],
    species_dict: DataFrame,
    site: str,
    year: int,
) -> Batch:
    """``matrices`` maps reflectance, and transmittance where measured, to the lines of its files."""
    spark = species_dict.sparkSession
    order = leaf_order(sheets)
    leaves = stored(describe(traits_by_leaf(sheets), site, year, order), "pheno-leaves")
    samples = resolve_species(
        leaves.select("samplecode", "projectcode", "plotcode", "speciesdatacode", "year", "collectiondate").distinct(),
        species_dict, PROJECT,
    ).drop("speciesdatacode")
    points = stored(
        reduce(lambda a, b: a.unionByName(b), [spectra(lines, leaves, kind) for kind, lines in matrices.items()]),
        "pheno-spectra",
    )
    trait_cols = list(SHEETS)
    in_units = units.convert_columns(leaves.select("samplecode", *trait_cols), PIGMENTS, "ug cm-2", "kg m-2")
    in_units = units.convert_columns(in_units, ["leaf_mass_per_area"], "g m-2", "kg m-2")
    traits = melt(in_units, ["samplecode"], trait_cols, "trait", "traitvalue", drop_null=True)
    return Batch(
        sites=rows(spark, "sitecode string, sitedescription string", *[s[:2] for s in SITES]),
        plots=rows(
            spark, "sitecode string, plotcode string, latitude double, longitude double",
            *[(code, code, lat, lon) for code, _, lat, lon in SITES],
        ),
        samples=samples,
        conditions=leaves.select(
            "samplecode", F.lit("sunshade").alias("condition"), F.col("sunshade").alias("conditionvalue")
        ).distinct(),
        condition_info=rows(spark, "condition string", ("sunshade",)),
        spectra_info=points.select("samplecode", "spectratype").distinct(),
        spectra=points,
        traits=traits,
        trait_info=units_of(traits, UNIT_RULES),
    )
