"""wu_brazil: one transposed spectra table and one trait table with coded conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.functions import clean, parse
from foliar.functions.nulls import ratio, recode_lookup
from foliar.operators.reshape import melt, names_to_long
from foliar.plans.batch import Batch, Contact, one_site, project_row, rows, stored

PROJECT, SITE = "wu_brazil", "wu_brazil.Brazil"

# Project row, code lists and the instrument.
PROJECT_ROW = (PROJECT, "Wu et al. 2016 New Phytologist Brazil canopy traits study", "10.1111/nph.14051")
POSITION = {3: "T", 2: "M", 1: "B"}
COMPLETE = {1: "complete", 2: "non-complete"}
AGE = {1: "young", 2: "mature", 3: "old"}
CONDITIONS = ["CompleteLeaf", "LeafAge", "sunshade"]
METHOD = (
    "ASD FieldSpec Pro",
    350.0,
    2500.0,
    "1.4nm visible, 2.2nm NIR, 2.3nm SWIR, interpolated to 1nm; Analytical Spectra Devices, ASD, Boulder, CO, USA",
    "Spectralon ratio",
    "Chavana-Bryant et al. 2016; doi:10.1111/nph.13853",
)


def _code(leaf: str):
    """No year is known, so the code ends in ``NA``."""
    return parse.samplecode(F.lit(PROJECT), leaf, F.lit(None))


def spectra(raw: DataFrame) -> DataFrame:
    leaves = [c for c in raw.columns if c != "Wavelength"]
    wide = raw.withColumn("wavelength_nm", F.replace("Wavelength", F.lit(" nm"), F.lit("")).try_cast("double"))
    long = names_to_long(wide, ["wavelength_nm"], leaves, "leaf", "spectravalue")
    return long.select(
        _code("leaf").alias("samplecode"),
        F.lit("reflectance").alias("spectratype"),
        F.col("wavelength_nm").alias("wavelength"),
        "spectravalue",
    )


def traits_and_conditions(raw: DataFrame) -> DataFrame:
    position = recode_lookup("Light_Environment", POSITION)
    mass = ratio(F.lit(1.0), "SLA_m2_kg")
    return raw.select(
        _code("Leaf_Number").alias("samplecode"),
        mass.alias("leaf_mass_per_area"),
        (F.col("Water_Perc") * mass).alias("leaf_water_thickness"),
        recode_lookup("Complete_Leaf", COMPLETE).alias("CompleteLeaf"),
        recode_lookup("Leaf_Age", AGE).alias("LeafAge"),
        parse.sunshade_by_position(position).alias("sunshade"),
    )


def build(spectra_raw: DataFrame, traits_raw: DataFrame, contact: Contact = Contact()) -> Batch:
    spark = spectra_raw.sparkSession
    points = stored(spectra(spectra_raw), "brazil-spectra")
    leaf = traits_and_conditions(traits_raw)
    place = spark.range(1).select(
        clean.dms_to_decimal(F.lit(-2), F.lit(51), F.lit(0)).alias("lat"),
        clean.dms_to_decimal(F.lit(-54), F.lit(58), F.lit(0)).alias("lon"),
    ).first()
    sites, plots = one_site(spark, SITE, None, place["lat"], place["lon"])
    measured = points.select("samplecode", "spectratype").distinct()
    codes = leaf.select("samplecode").unionByName(measured.select("samplecode")).distinct()
    traits = melt(leaf, ["samplecode"], ["leaf_mass_per_area", "leaf_water_thickness"], "trait", "traitvalue", drop_null=False)
    return Batch(
        projects=project_row(spark, *PROJECT_ROW, contact=contact),
        sites=sites,
        plots=plots,
        samples=codes.select("samplecode", F.lit(PROJECT).alias("projectcode"), F.lit(SITE).alias("plotcode")),
        methods=rows(
            spark,
            "instrumentname string, minwavelength double, maxwavelength double, instrumentcomment string, "
            "calibration string, specmethodcomment string",
            METHOD,
        ),
        spectra_info=measured,
        spectra=points,
        conditions=melt(leaf, ["samplecode"], CONDITIONS, "condition", "conditionvalue", drop_null=False),
        condition_info=rows(spark, "condition string", *[(c,) for c in CONDITIONS]),
        traits=traits,
        trait_info=traits.select("trait").distinct(),
    )
