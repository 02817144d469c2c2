"""ngee_tropics: water potentials and wide spectra of two sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import recode_keep
from foliar.operators import columns, filters
from foliar.operators.joins import join, resolve_species
from foliar.operators.reshape import melt, wide_to_packed
from foliar.plans.batch import Batch, rows, stored, units_of, when_missing

PROJECT, YEAR = "ngee_tropics", 2016

# A spectrum assigned to the wrong site, site coordinates, labels.
WRONG = {"Spectra": "BNL11815", "Site": "PNM"}
PLACES = [
    ("ngee_tropics.NA", None, None),
    ("ngee_tropics.PNM", 9.25, -79.99),
    ("ngee_tropics.SanLorenzo", 9.25, -79.99),
]
SUNSHADE = {"sunlit": "sun", "understory": "shade"}
SUNSHADE_TEXT = (
    'Whether leaf is sunlit (sun; same as canopyposition "top") or shaded (shade; same as canopyposition "mid" or "bot")'
)


def chemistry(raw: DataFrame) -> DataFrame:
    df = columns.map_numeric(raw, lambda c: clean.sentinel_equal(c, -9999))
    return df.select(
        F.col("Barcode").alias("SampleName"),
        F.col("Species").alias("speciesdatacode"),
        F.col("Canopy_position").alias("canopyposition"),
        units.convert("LWP_bar", "bar", "Pa").alias("leaf_water_potential"),
    )


def spectra_table(raw: DataFrame) -> DataFrame:
    kept = filters.exclude_pair(raw, **WRONG)
    return kept.withColumns(
        {
            "collectiondate": parse.parse_date("Date", "%Y%m%d"),
            "sitecode": parse.dotted(F.lit(PROJECT), "Site"),
            "SampleName": F.col("Spectra"),
        }
    ).drop("Date", "Site", "Spectra")


def build(chem_raw: DataFrame, spectra_raw: DataFrame, species_dict: DataFrame) -> Batch:
    spark = chem_raw.sparkSession
    chem, wide = chemistry(chem_raw), spectra_table(spectra_raw)
    described = wide.select("SampleName", "sitecode", "collectiondate")
    both = join(chem.select("SampleName", "speciesdatacode"), described, ["SampleName"], "full")
    both = both.withColumns(
        {
            "projectcode": F.lit(PROJECT),
            "year": F.lit(YEAR),
            "samplecode": parse.samplecode(F.lit(PROJECT), "SampleName", F.lit(YEAR)),
            "sitecode": when_missing("sitecode", parse.dotted(F.lit(PROJECT), F.lit(None))),
        }
    )
    both = resolve_species(both.withColumn("plotcode", F.col("sitecode")), species_dict, PROJECT)
    samples = stored(both, "tropics-samples")
    code = parse.samplecode(F.lit(PROJECT), "SampleName", F.lit(YEAR)).alias("samplecode")
    traits = melt(chem.select(code, "leaf_water_potential"), ["samplecode"], ["leaf_water_potential"], "trait", "traitvalue", True)
    conditions = chem.select(
        code, F.lit("sunshade").alias("condition"), recode_keep("canopyposition", SUNSHADE).alias("conditionvalue")
    ).distinct()
    places = rows(spark, "sitecode string, latitude double, longitude double", *PLACES)
    kind = F.lit("reflectance").alias("spectratype")
    instruments = wide.select(F.col("Instrument").alias("instrumentname")).where("instrumentname is not null").distinct()
    return Batch(
        sites=samples.select("sitecode").distinct(),
        plots=join(samples.select("sitecode", "plotcode").distinct(), places, ["sitecode"], "left"),
        samples=samples.select("samplecode", "projectcode", "year", "collectiondate", "plotcode", "speciescode"),
        condition_info=rows(spark, "condition string, conditiondescription string", ("sunshade", SUNSHADE_TEXT)),
        conditions=conditions,
        methods=instruments.withColumn("specmethodcomment", F.lit("NGEE Tropics")),
        match=("instrumentname",),
        spectra_info=wide.select(code, F.col("Instrument").alias("instrumentname"), kind),
        packed=wide_to_packed(wide.withColumn("samplecode", code), ["samplecode"]).select("*", kind),
        traits=traits,
        trait_info=units_of(traits, [("^leaf_water_potential$", "Pa")]),
    )
