"""divittorio_conifer: needle spectra per file and one sectioned pigment file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions import parse, units
from foliar.functions.nulls import paste_na, recode_lookup, update_where
from foliar.operators import columns
from foliar.operators.joins import join
from foliar.operators.ordered import block_label, row_number_in_group
from foliar.operators.reshape import melt, pack, stack_pairs
from foliar.operators.resample import resample_to_packed
from foliar.plans.batch import Batch, rows, stored
from foliar.sources.files import drop_header_lines, read_lines
from foliar.sources.folder import read_folder
from foliar.sources.layouts import sectioned

PROJECT, YEAR = "divittorio_conifer", 2009

# The top-of-needle files in use, and those that are repeats.
FOLDERS = (
    "sgf_oz", "sgf_gr", "sgf_wf",
    "sqa_t1", "sqa_t2", "sqa_t3", "sqa_t4", "sqa_gr", "sqa_wf", "sqa_scale", "sqa_suck",
    "qcy_gr", "qcy_wf", "qcy_t1", "qcy_t2", "qcy_t3", "qcy_t4",
)
FILE_PATTERN = "_top_.*.txt"
REPEATS = "_[12]d_"
FILE_PARTS = r"(^\p{Alpha}+)_(\p{Alnum}+)_top_s(\p{Digit}+$)"
# Pigment columns, site and condition codes, species and coordinates.
PIGMENTS = {
    "chla": "leaf_chla_per_area",
    "chlb": "leaf_chlb_per_area",
    "tchl": "leaf_chltot_per_area",
    "carot": "leaf_cartot_per_area",
}
SPECTRA_SITES = {"qcy": "Plumas National Forest", "sgf": "Giant Forest", "sqa": "Mineral King"}
PIGMENT_SITES = {"pnf": "Plumas National Forest", "gf": "Giant Forest", "mk": "Mineral King"}
CONDITIONS = {
    "oz": "ozone",
    "oz1": "ozone",
    "oz2": "ozone",
    "gr": "green",
    "wf": "winter_fleck",
    "scale": "scale_insect",
    "suck": "sucking_insect",
    "rand": "random",
    "t1": "1",
    "t2": "2",
    "t3": "3",
    "t4": "4",
}
SPECIES = {"Plumas National Forest": "PIPO", "Mineral King": "PIPO", "Giant Forest": "PIJE"}
PLACES = [
    ("Giant Forest", 36.58, -118.77),
    ("Plumas National Forest", 39.78, -120.98),
    ("Mineral King", 36.45, -118.59),
]
CONDITION_TEXT = (
    'Needle damage condition. "green" indicates healthy needles. '
    'See "Di Vittorio 2009 J. Environ. Qual." for more info.'
)


def wanted_files(points: DataFrame, path: str = "specfile") -> DataFrame:
    """Points of the top-of-needle files in the listed folders, without repeats."""
    folder = F.element_at(F.split(path, "/"), -2)
    name = F.element_at(F.split(path, "/"), -1)
    return points.where(folder.isin(*FOLDERS) & name.rlike(FILE_PATTERN) & ~F.col(path).rlike(REPEATS))


def file_samples(files: DataFrame) -> DataFrame:
    """Site, condition, tree and spectrum number from the file names."""
    df = files.withColumn("raw", parse.base_name("specfile"))
    df = df.withColumns(parse.file_name_parts("raw", FILE_PARTS, {"file_site": 1, "file_cond": 2, "file_num": 3}))
    df = df.withColumns(
        {
            "Site": recode_lookup("file_site", SPECTRA_SITES),
            "OtherCondition": recode_lookup("file_cond", CONDITIONS),
            "specnum": F.col("file_num").try_cast("long"),
        }
    )
    df = df.withColumn("treenum", F.col("OtherCondition").try_cast("long"))
    df = df.withColumn("OtherCondition", update_where("OtherCondition", F.col("OtherCondition").isin("1", "2", "3", "4"), "random"))
    ozone = (F.col("Site") == "Giant Forest") & (F.col("OtherCondition") == "ozone")
    tree = F.when(F.col("specnum") <= 25, 1).otherwise(2).cast("long")
    df = df.withColumn("treenum", update_where("treenum", ozone & F.col("specnum").isNotNull(), tree))
    # The two ozone trees are numbered anew, in file order.
    numbered = row_number_in_group(df.withColumn("__oz", F.coalesce(ozone, F.lit(False))), ["__oz", "treenum"], ["specfile"], "__n")
    renumbered = update_where("specnum", F.col("__oz"), F.col("__n"))
    return numbered.withColumn("specnum", renumbered).select(
        "specfile", "file_site", "file_cond", "Site", "OtherCondition", "treenum", "specnum"
    )


def pigment_samples(lines: DataFrame) -> DataFrame:
    """Pigments by section; trees and spectrum numbers follow the order of the lines."""
    names = list(PIGMENTS)
    order = ["block", "row"]
    df = sectioned(drop_header_lines(lines, names), names, ["file"], order)
    df = columns.rename(df, PIGMENTS).withColumns(
        {"rawsite": F.regexp_replace("info", "(.*)-(.*)", "$1"), "rawcond": F.regexp_replace("info", "(.*)-(.*)", "$2")}
    )
    df = df.withColumns(
        {"Site": recode_lookup("rawsite", PIGMENT_SITES), "OtherCondition": recode_lookup("rawcond", CONDITIONS)}
    )
    random = F.coalesce(F.col("OtherCondition") == "random", F.lit(False))
    df = row_number_in_group(df.withColumn("__random", random), ["__random"], order, "__k")
    tree = F.when(F.col("rawcond") == "oz1", 1).when(F.col("rawcond") == "oz2", 2).cast("long")
    df = df.withColumn("treenum", F.when(F.col("__random"), block_label("__k", 32, 4)).otherwise(tree))
    df = row_number_in_group(df, ["info", "treenum"], order, "specnum")
    return df.drop("__random", "__k", "file", *order)


def from_folder(spark: SparkSession, root: str, pigments: str = "all_pig.txt") -> Batch:
    """Three-column files without header in the listed folders, and the sectioned pigment file."""
    columns_ = ["wavelength", "reflectance", "transmittance"]
    files = read_folder(spark, root, FILE_PATTERN, REPEATS, names=columns_)
    points = files.table(dict.fromkeys(columns_, "double"), keep=["file"]).withColumnRenamed("file", "specfile")
    batch = build(points, read_lines(spark, root, pigments))
    batch.ledger = files.ledger("spectra")
    return batch


def build(points: DataFrame, pigment_lines: DataFrame) -> Batch:
    """``points`` has specfile, wavelength, reflectance and transmittance."""
    spark = points.sparkSession
    used = wanted_files(points)
    files = file_samples(used.select("specfile").distinct())
    chem = pigment_samples(pigment_lines)
    both = join(files, chem, ["Site", "OtherCondition", "treenum", "specnum"], "full")
    # Rows known from one side only still get a site, condition, project and year.
    both = both.withColumns(
        {
            "rawsite": F.coalesce("rawsite", "file_site"),
            "rawcond": F.coalesce("rawcond", "file_cond"),
            "projectcode": F.lit(PROJECT),
            "year": F.lit(YEAR),
        }
    )
    name = paste_na("-", "rawsite", "rawcond", "treenum", "specnum")
    both = units.convert_columns(both, list(PIGMENTS.values()), "ug cm-2", "kg m-2").withColumns(
        {
            "samplecode": parse.samplecode("projectcode", name, "year"),
            "speciescode": recode_lookup("Site", SPECIES),
            "sitecode": parse.dotted("projectcode", "rawsite"),
        }
    )
    samples = stored(both.withColumn("plotcode", F.col("sitecode")), "conifer-samples")
    sites = samples.select("sitecode", F.col("Site").alias("sitedescription")).distinct()
    places = rows(spark, "sitedescription string, latitude double, longitude double", *PLACES)
    plots = join(sites, places, ["sitedescription"], "left").select(
        "sitecode", F.col("sitecode").alias("plotcode"), F.col("sitedescription").alias("plotdescription"),
        "latitude", "longitude",
    )
    traits = melt(samples, ["samplecode"], list(PIGMENTS.values()), "trait", "traitvalue", drop_null=True)
    conditions = samples.where(F.col("OtherCondition").isNotNull()).select(
        "samplecode", F.lit("dv_needle_condition").alias("condition"), F.col("OtherCondition").alias("conditionvalue")
    )
    kinds = {"reflectance": "reflectance", "transmittance": "transmittance"}
    long = stack_pairs(used, ["specfile", "wavelength"], kinds, "kind", "spectravalue")
    long = long.where(F.col("wavelength").isNotNull() & F.col("spectravalue").isNotNull())
    packed = pack(long, ["specfile", "kind"])
    grid = resample_to_packed(packed, ["specfile", "kind"], {"": "spectravalues"}).select(
        "specfile", F.col("kind").alias("spectratype"), "wavelengths", "spectravalues"
    )
    spectra = stored(
        join(grid, samples.where(F.col("specfile").isNotNull()).select("specfile", "samplecode"), ["specfile"], "inner"),
        "conifer-spectra",
    )
    return Batch(
        sites=sites,
        plots=plots,
        samples=samples.select("samplecode", "speciescode", "plotcode", "projectcode", "year"),
        spectra_info=spectra.select("samplecode", "spectratype").distinct(),
        packed=spectra.drop("specfile"),
        traits=traits,
        trait_info=traits.select("trait").distinct().withColumn("unit", F.lit("kg m-2")),
        conditions=conditions,
        condition_info=rows(
            spark, "condition string, conditiondescription string", ("dv_needle_condition", CONDITION_TEXT)
        ),
    )
