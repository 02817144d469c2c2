"""angers and lopex: one chemistry table and one two-column file per spectrum."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import matches, ratio, update_where
from foliar.operators import columns
from foliar.operators.joins import join, resolve_species
from foliar.operators.ordered import fill_down, row_number_global
from foliar.operators.reshape import melt, stack_pairs
from foliar.plans.batch import Batch, one_site, rows, stored, units_of
from foliar.sources.folder import file_name, read_folder, require_files

# Unit labels by trait name; later rules overwrite earlier ones.
UNIT_RULES = [("_pct", "%"), ("_area|_thickness", "kg m-2"), ("ratio", "unitless")]
PIGMENTS = {
    "C_a": "leaf_chla_per_area",
    "C_b": "leaf_chlb_per_area",
    "C_ab": "leaf_chltot_per_area",
    "C_car": "leaf_cartot_per_area",
}
STRUCTURE = {"EWT": "leaf_water_thickness", "LMA": "leaf_mass_per_area"}

# Columns of the chemistry files.
OPTICS_TEXTS = {"Latin Name": "string", "Refl_file": "string", "Trans_file": "string"}
OPTICS_NUMBERS = ["C_a", "C_b", "C_ab", "C_car", "C_anth", "EWT", "LMA"]
LOPEX_NUMBERS = [
    "C_C", "C_H", "C_O", "C_N", "C_prot1", "C_prot2", "C_cell1", "C_cell2", "C_lign1", "C_lign2", "C_star1", "C_star2",
]


def file_spectra(points: DataFrame, chem: DataFrame) -> DataFrame:
    """Points of every listed file, labelled with its sample and kind."""
    pairs = {"reflectance": "Refl_file", "transmittance": "Trans_file"}
    listed = stack_pairs(chem, ["samplecode"], pairs, "spectratype", "fname").distinct()
    return join(points, listed, ["fname"], "inner").select(
        "samplecode", "spectratype", "fname", "wavelength", "spectravalue"
    )


def _catalog_units(chem: DataFrame, pigments: dict[str, str]) -> DataFrame:
    chem = chem.withColumns({new: units.convert(old, "ug cm-2", "kg m-2") for old, new in pigments.items()})
    return chem.withColumns({new: units.convert(old, "g cm-2", "kg m-2") for old, new in STRUCTURE.items()})


def _batch(chem: DataFrame, points: DataFrame, species_dict: DataFrame, place, methods: DataFrame | None) -> Batch:
    spectra = stored(file_spectra(points, chem), "file-spectra")
    measured = spectra.select("samplecode").distinct()
    analysed = chem.select("samplecode", "projectcode", "year", "sitecode", "plotcode", "speciesdatacode").distinct()
    resolved = resolve_species(analysed, species_dict).drop("speciesdatacode")
    traits = melt(chem, ["samplecode"], columns.with_prefix(chem, "leaf_"), "trait", "traitvalue", drop_null=True)
    sites, plots = place
    return Batch(
        sites=sites,
        plots=plots,
        samples=join(measured, resolved, ["samplecode"], "full"),
        spectra_info=spectra.select("samplecode", "spectratype").distinct(),
        spectra=spectra.drop("fname"),
        traits=traits,
        trait_info=units_of(traits, UNIT_RULES, last_wins=True),
        methods=methods,
    )


def _optics_folder(
    spark: SparkSession, root: str, chem_file: str, columns_: dict[str, str], name_of: Callable[[str], Column]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chemistry rows in file order, points of the spectrum files, and the ledger. Every listed file must be there."""
    table = read_folder(spark, root, f"^{re.escape(chem_file)}$", sep=",", name_of=name_of).require(["Latin Name", "Refl_file", "Trans_file"])
    chem = stored(table.table(columns_, keep=["block", "row"]), "optics-chem")
    files = read_folder(spark, f"{root.rstrip('/')}/spec", names=["wavelength", "spectravalue"], name_of=name_of)
    listed = chem.select(F.explode(F.array("Refl_file", "Trans_file")).alias("fname"))
    require_files(listed, "fname", files)
    points = files.table({"wavelength": "double", "spectravalue": "double"}, keep=["file"]).withColumn("fname", name_of("file")).drop("file")
    numbers = [c for c, kind in columns_.items() if kind == "double"]
    return chem, points, table.ledger("chemistry", numbers).unionByName(files.ledger("spectra"))


def angers_from_folder(spark: SparkSession, root: str, species_dict: DataFrame, chem_file: str = "LDB_angers2003.csv", name_of: Callable[[str], Column] = file_name) -> Batch:
    """The chemistry file and, below ``spec``, one two-column file per spectrum."""
    chem, points, ledger = _optics_folder(spark, root, chem_file, {**OPTICS_TEXTS, **dict.fromkeys(OPTICS_NUMBERS, "double")}, name_of)
    batch = angers(chem.drop("block", "row"), points, species_dict)
    batch.ledger = ledger
    return batch


def lopex_from_folder(spark: SparkSession, root: str, species_dict: DataFrame, chem_file: str = "LDB_lopex1993.csv", name_of: Callable[[str], Column] = file_name) -> Batch:
    """As angers; the order of the chemistry file's lines names the samples."""
    numbers = dict.fromkeys([*OPTICS_NUMBERS, *LOPEX_NUMBERS], "double")
    chem, points, ledger = _optics_folder(spark, root, chem_file, {**OPTICS_TEXTS, "Plant Type": "string", "English Name": "string", **numbers}, name_of)
    batch = lopex(row_number_global(chem, ["block", "row"], "line").drop("block", "row"), points, species_dict)
    batch.ledger = ledger
    return batch


def angers(chem_raw: DataFrame, points: DataFrame, species_dict: DataFrame) -> Batch:
    """``points`` has fname, wavelength and spectravalue of all spectrum files."""
    spark = chem_raw.sparkSession
    site = "angers.INRA"
    chem = clean.drop_sentinels(chem_raw.withColumnRenamed("Latin Name", "speciesdatacode"))
    chem = _catalog_units(chem, {**PIGMENTS, "C_anth": "leaf_anthocyanin_per_area"})
    number = F.regexp_replace("Refl_file", r"an03r(.{4})[.]txt", "$1")
    name = F.concat_ws("_", parse.abbreviate("speciesdatacode"), number)
    chem = chem.withColumns(
        {"projectcode": F.lit("angers"), "year": F.lit(2003), "sitecode": F.lit(site), "plotcode": F.lit(site)}
    ).withColumn("samplecode", parse.samplecode("projectcode", name, "year"))
    place = one_site(spark, site, "INRA Centra in Angers, France", 47.47, -0.56)
    return _batch(stored(chem, "angers-chem"), points, species_dict, place, None)


def lopex_samples(chem_raw: DataFrame, line: str) -> DataFrame:
    """Sample names from filled-down species names and the line number.

    ``line`` orders the rows as in the file; the table has one constant group.
    """
    chem = chem_raw.withColumnRenamed("Latin Name", "speciesdatacode").drop("Plant Type", "English Name")
    chem = columns.map_columns(chem, [c for c in clean.numeric_columns(chem) if c != line], lambda c: clean.sentinel_equal(c, -999))
    chem = chem.withColumns(
        {"speciesdatacode": clean.sentinel_equal("speciesdatacode", ""), "projectcode": F.lit("lopex"), "year": F.lit(1993)}
    )
    chem = row_number_global(fill_down(chem, "speciesdatacode", ["projectcode"], [line]), [line], "__n")
    name = parse.leaf_name(parse.abbreviate("speciesdatacode", parse.HYBRID_BINOMIAL), "__n")
    grape = matches("speciesdatacode", "Vitis vinifera.*Sylvestris")
    chem = chem.withColumn("samplename", name).drop("__n")
    renamed = F.replace("samplename", F.lit("Vit-vin_"), F.lit("Vit-vin-syl_"))
    chem = chem.withColumn("samplename", update_where("samplename", grape, renamed))
    return chem.withColumn("samplecode", parse.samplecode("projectcode", "samplename", "year"))


def lopex(chem_raw: DataFrame, points: DataFrame, species_dict: DataFrame, line: str = "line") -> Batch:
    spark = chem_raw.sparkSession
    site = "lopex.ispra"
    chem = lopex_samples(chem_raw, line).withColumns({"sitecode": F.lit(site), "plotcode": F.lit(site)})
    chem = columns.rename(
        chem, {"C_C": "leaf_C_pct_mass", "C_H": "leaf_H_pct_mass", "C_O": "leaf_O_pct_mass", "C_N": "leaf_N_pct_mass"}
    )
    chem = _catalog_units(chem, {**PIGMENTS, "C_anth": "leaf_anth_per_area"})
    chem = chem.withColumns(
        {
            "leaf_CN_ratio_mass": ratio("leaf_C_pct_mass", "leaf_N_pct_mass"),
            "leaf_protein_pct_mass": clean.both_mean("C_prot1", "C_prot2"),
            "leaf_cellulose_pct_mass": clean.both_mean("C_cell1", "C_cell2"),
            "leaf_lignin_pct_mass": clean.both_mean("C_lign1", "C_lign2"),
            "leaf_starch_pct_mass": clean.replicate_mean("C_star1", "C_star2"),
        }
    )
    # The spectrophotometer set-up.
    methods = rows(
        spark,
        "instrumentname string, apparatus string, calibration string, specmethodcomment string",
        (
            "Perkin Elmer Lambda 19 double-beam spectrophotometer (BaSO4 integrating sphere)",
            "Integrating sphere",
            "Spectralon ratio",
            "See http://teledetection.ipgp.jussieu.fr/opticleaf/lopex.htm#spectral for more info",
        ),
    )
    place = one_site(spark, site, "Joint Research Center, Ispra, Italy", 45.803, 8.630)
    return _batch(stored(chem, "lopex-chem"), points, species_dict, place, methods)
