"""foster_beetle: one wide table with a column per wavelength."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.functions import clean, parse
from foliar.functions.nulls import paste_na, recode_keep
from foliar.operators.reshape import melt, wide_to_packed
from foliar.plans.batch import Batch, Contact, one_site, project_row, rows

PROJECT, SITE = "foster_beetle", "foster_beetle.MP"
KIND = "continuum-removed reflectance"

# Project, site, instrument and condition descriptions.
PROJECT_ROW = (
    PROJECT,
    "Foster et al. 2017 (FEM) bark beetle spectra study",
    "10.1016/j.foreco.2016.11.004",
)
SITE_TEXT = (
    "Monarch Pass, Sawatch Range, Grand Mesa-Uncompahgre-Gunnison National Forests, Salida, CO"
)
METHOD = ("ASD FieldSpec Pro", "Leaf clip", "Foster et al. (2017) FEM")
CONDITION = (
    "bark_beetle_infested",
    "Tree infested (yes/no) by spruce beetle (Dendroctonus rufipennis (Kirby))",
    "See Foster et al. (2017) FME",
)


def build(raw: DataFrame, contact: Contact = Contact()) -> Batch:
    spark = raw.sparkSession
    code = parse.samplecode(F.lit(PROJECT), paste_na("_", "TREEID", "Height"), F.lit(2014))
    wide = raw.withColumn("samplecode", code)
    place = spark.range(1).select(
        clean.dms_to_decimal(F.lit(38), F.lit(30), F.lit(10.08)).alias("lat"),
        clean.dms_to_decimal(F.lit(-106), F.lit(20), F.lit(8.1594)).alias("lon"),
    ).first()
    sites, plots = one_site(spark, SITE, SITE_TEXT, place["lat"], place["lon"])
    samples = wide.select(
        "samplecode",
        F.lit(PROJECT).alias("projectcode"),
        F.lit(2014).alias("year"),
        F.lit("2014-09-05").cast("date").alias("collectiondate"),
        F.lit(SITE).alias("plotcode"),
        F.lit("PIEN").alias("speciescode"),
    )
    values = wide.select(
        "samplecode",
        recode_keep("Infested", {"Y": "yes", "N": "no"}).alias("bark_beetle_infested"),
        recode_keep("Height", {"H": "M", "L": "B"}).alias("CanopyPosition"),
        F.lit("shade").alias("sunshade"),
    )
    conditions = melt(
        values, ["samplecode"], ["bark_beetle_infested", "CanopyPosition", "sunshade"],
        "condition", "conditionvalue", drop_null=True,
    )
    described = rows(spark, "condition string, conditiondescription string, conditioncomment string", CONDITION)
    # The other two conditions are shared with later projects and need a row as well.
    others = rows(spark, "condition string", ("CanopyPosition",), ("sunshade",))
    kind = F.lit(KIND).alias("spectratype")
    return Batch(
        projects=project_row(spark, *PROJECT_ROW, contact=contact),
        sites=sites,
        plots=plots,
        samples=samples,
        conditions=conditions,
        condition_info=described.unionByName(others, allowMissingColumns=True),
        methods=rows(spark, "instrumentname string, apparatus string, specmethodcomment string", METHOD),
        spectra_info=wide.select("samplecode", kind),
        packed=wide_to_packed(wide, ["samplecode"], r"^(\d+)$").select("*", kind),
    )
