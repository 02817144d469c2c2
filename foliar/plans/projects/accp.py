"""accp: leaf chemistry files and transposed spectra files of fresh, dry and powdered leaves."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import matches, recode_keep, update_where
from foliar.operators import columns, filters
from foliar.operators.joins import join
from foliar.operators.reshape import melt
from foliar.plans.batch import Batch, rows, stored, units_of
from foliar.sources.folder import file_name, read_folder
from foliar.sources.layouts import header_to_long

PROJECT = "accp"

# File columns and their catalog names.
NAMES = {
    "sampleid": "samplename",
    "species": "speciescode",
    "cell": "leaf_cellulose_pct_mass",
    "lignin": "leaf_lignin_pct_mass",
    "carbon": "leaf_C_pct_mass",
    "hydrogen": "leaf_H_pct_mass",
    "nitrogen": "leaf_N_pct_mass",
    "chloro_a": "leaf_chla_mass",
    "chloro_b": "leaf_chlb_mass",
    "npolar": "leaf_nonpolar_pct_mass",
    "polar": "leaf_polar_pct_mass",
    "water_th": "leaf_water_thickness",
    "lutein": "leaf_lutein_mass",
    "neoxanth": "leaf_neoxanthin_mass",
    "beta_car": "leaf_betacarotene_mass",
}
# Preparation and kind by file name, rejected samples, corrected species codes.
PREPARATIONS = [("_d_sp.dat", "dry"), ("_f_sp.dat", "fresh"), ("_p_sp.dat", "powder")]
REJECTED = ["92CWS61BA2A", "92CWS7FRN", "92HFS19RO4"]
SPECIES_FIXES = {"USNEA": "USNEA2", "POGR": "POSE"}
# Sites with description and coordinates.
SITES = [
    ("accp.HF", "Harvard Forest, Petersham, MA", 42.4950, -71.7981),
    ("accp.BHI", "Blackhawk Island, WI", 43.6333, -89.7583),
    ("accp.HOW", "Howland, ME", 45.2222, -68.7356),
    ("accp.GAIN", "Gainesville, FL", 29.7000, -82.1667),
    ("accp.JR", "Jasper Ridge, CA", 37.4111, -121.7631),
    ("accp.RICE", "Dunnigan and Pleasant Grove, CA", (38.9167 + 38.7292) / 2, (-120.1122 - 120.4581) / 2),
]
METHODS = [
    ("NIRS 6500 laboratory spectrometer", "ACCP measurement of wet and dry leaves", "leaf"),
    ("ACCP field spectrometer", "ACCP measurement of seedlings in field", "seedling"),
]


def chemistry(files: Sequence[DataFrame]) -> DataFrame:
    """All chemistry files under one set of columns, in catalog units."""
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), files)
    chem = clean.drop_sentinels(columns.rename(raw, NAMES))
    per_mass = [c for c in chem.columns if c.startswith("leaf_") and c.endswith("_mass") and "_pct_" not in c]
    chem = units.convert_columns(chem, per_mass, "mg g-1", "percent")
    if "leaf_water_thickness" in chem.columns:
        chem = units.convert_columns(chem, ["leaf_water_thickness"], "g cm-2", "kg m-2")
    return columns.rename(chem, {c: c.replace("_mass", "_pct_mass") for c in per_mass})


def spectra(lines: DataFrame) -> DataFrame:
    """Long spectra of all known files; -1 stands for a missing value."""
    long = header_to_long(lines, key="wavelength", skip=("band",), name="samplename", value="spectravalue")
    return described(long.withColumn("fname", file_name()).drop("file"))


def described(long: DataFrame) -> DataFrame:
    """Points (fname, wavelength, samplename, spectravalue) of known files, with kind and preparation."""
    kind = F.when(matches("fname", "jr_f_sp.dat"), "reflectance").otherwise("pseudo-absorbance")
    long = long.withColumns({"sampleprep": filters.route("fname", PREPARATIONS), "spectratype": kind})
    kept = long.where(F.col("sampleprep").isNotNull() & (F.col("spectravalue") > -0.5))
    kept = kept.withColumn("samplename", F.replace("samplename", F.lit("BH"), F.lit("BHI")))
    kept = filters.exclude(kept, "samplename", REJECTED)
    suffixed = F.concat_ws("_", "samplename", "sampleprep")
    return kept.withColumn("samplename", update_where("samplename", matches("fname", "^(map|df)_"), suffixed))


def all_samples(points: DataFrame, chem: DataFrame) -> DataFrame:
    """Measured and analysed samples together, with their codes."""
    measured = points.select("samplename", "sampleprep", "spectratype", "fname").distinct()
    both = join(measured, chem, ["samplename"], "full").withColumn("plot_id", F.col("plot_id").cast("string"))
    for prefix, site, species in (("^map_", "SaplingACMA3", "ACMA3"), ("^df_", "SaplingPSME", "PSME")):
        hit = matches("fname", prefix)
        both = both.withColumns(
            {
                "site_id": update_where("site_id", hit, site),
                "speciescode": update_where("speciescode", hit, species),
                "plot_id": update_where("plot_id", hit, F.lit(None)),
            }
        )
    both = both.withColumn("collectiondate", parse.parse_date("colldate", "%y%m%d"))
    both = both.withColumns({"year": F.year("collectiondate"), "projectcode": F.lit(PROJECT)})
    both = both.withColumns(
        {
            "samplecode": parse.samplecode("projectcode", "samplename", "year"),
            "sitecode": parse.dotted("projectcode", "site_id"),
            "speciescode": recode_keep("speciescode", SPECIES_FIXES),
        }
    )
    # Saplings were measured in the field, all other leaves in the laboratory.
    tag = F.when(matches("site_id", "^Sapling"), "seedling").otherwise("leaf")
    return both.withColumns({"plotcode": parse.dotted("sitecode", "plot_id"), "method_tag": tag})


def from_folder(spark: SparkSession, root: str, name_of: Callable[[str], Column] = file_name) -> Batch:
    """Chemistry files below ``leafchem``, spectra files below ``leafspec``, each with a header of its own."""
    numbers = [c for c in NAMES if c not in ("sampleid", "species")]
    chem_files = read_folder(spark, f"{root.rstrip('/')}/leafchem", "chem[.]dat$", name_of=name_of).require(["sampleid"])
    texts = dict.fromkeys(("sampleid", "species", "site_id", "plot_id", "colldate"), "string")
    chem = chem_files.table({**texts, **dict.fromkeys([*numbers, "leaf_wgt"], "double")})
    files = read_folder(spark, f"{root.rstrip('/')}/leafspec", "sp[.]dat$", name_of=name_of)
    points = files.long("wavelength", "samplename", "spectravalue", ["band"]).withColumn("fname", name_of("file")).drop("file")
    batch = _build([chem], described(points))
    batch.ledger = chem_files.ledger("chemistry", numbers).unionByName(files.ledger("spectra"))
    return batch


def build(chem_files: Sequence[DataFrame], spectra_lines: DataFrame) -> Batch:
    return _build(chem_files, spectra(spectra_lines))


def _build(chem_files: Sequence[DataFrame], known: DataFrame) -> Batch:
    spark = known.sparkSession
    points = stored(known, "accp-spectra")
    samples = stored(all_samples(points, chemistry(chem_files)), "accp-samples")
    places = rows(spark, "sitecode string, sitedescription string, latitude double, longitude double", *SITES)
    traits = melt(
        samples, ["samplecode"], [c for c in columns.with_prefix(samples, "leaf_") if c != "leaf_wgt"],
        "trait", "traitvalue", drop_null=True,
    ).distinct()
    info = samples.where(F.col("fname").isNotNull()).select("samplecode", "spectratype", "sampleprep", "method_tag").distinct()
    codes = samples.where(F.col("fname").isNotNull()).select("samplecode", "samplename", "spectratype", "sampleprep").distinct()
    return Batch(
        sites=join(samples.select("sitecode").distinct(), places.drop("latitude", "longitude"), how="left"),
        plots=join(samples.select("plotcode", "sitecode").distinct(), places.drop("sitedescription"), how="left"),
        samples=samples.select("samplecode", "projectcode", "year", "collectiondate", "plotcode", "speciescode").distinct(),
        spectra_info=info,
        spectra=join(points, codes, ["samplename", "spectratype", "sampleprep"], "inner").select(
            "samplecode", "spectratype", "sampleprep", "wavelength", "spectravalue"
        ),
        traits=traits,
        trait_info=units_of(traits, [("_pct", "%"), ("^leaf_water_thickness$", "kg m-2")], last_wins=True),
        methods=rows(spark, "instrumentname string, specmethodcomment string, method_tag string", *METHODS),
        match=("method_tag",),
    )
