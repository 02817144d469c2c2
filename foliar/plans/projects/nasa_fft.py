"""nasa_fft: wide reflectance and transmittance tables and four trait tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import extract
from foliar.operators import columns, filters
from foliar.operators.aggregate import collapse_duplicates, require_unique
from foliar.operators.joins import full_join_unique, join, resolve_species
from foliar.operators.reshape import melt, wide_to_packed
from foliar.plans.batch import Batch, rows, stored, units_of, when_missing

PROJECT = "nasa_fft"

# Column names by kind of table.
SAMPLE_NAMES = {
    "Sample_Name": "SampleName",
    "Sample_Year": "year",
    "Height": "CanopyPosition",
    "Site": "sitecode",
    "Plot": "plotcode",
    "Species": "speciesdatacode",
}
KEY_NAMES = {
    "SAMPLE_NAME": "SampleName",
    "SAMPLE_YEAR": "year",
    "SPECIES": "speciesdatacode",
    "Sample_Name": "SampleName",
    "Sample_Year": "year",
    "Species": "speciesdatacode",
}
TRAIT_NAMES = {
    "Perc_C": "leaf_C_pct_mass",
    "Perc_N": "leaf_N_pct_mass",
    "CNRatio": "leaf_CN_ratio_mass",
    "CELL_PERC_DW": "leaf_cellulose_pct_mass",
    "ADL_PERC_DW": "leaf_lignin_pct_mass",
    "ADF_PERC_DW": "leaf_fiber_pct_mass",
    "SAMPLE_dN15": "leaf_dN15",
}
KEYS = ["SampleName", "year", "speciesdatacode"]
# Unit labels (first match decides), conditions and set-ups.
UNIT_RULES = [("pct_mass", "%"), ("_per_area|thickness", "kg m-2"), ("_ratio", "unitless")]
CONDITIONS = [
    ("CanopyPosition", "Position in canopy (bottom, middle, top)"),
    ("NeedleOldNew", "Whether needles are newly grown (new; age < 1) or not (old; age > 1)"),
    ("NeedleAge", "Needle age in years"),
]
METHODS = [
    ("ASD FieldSpec 3", "reflectance", "Leaf clip", "Spectralon ratio"),
    ("ASD FieldSpec 3", "transmittance", "Integrating sphere", None),
]


def _coded(raw: DataFrame) -> DataFrame:
    df = columns.rename(raw, SAMPLE_NAMES)
    return df.withColumn("samplecode", parse.samplecode(F.lit(PROJECT), "SampleName", "year"))


def _sample_columns(df: DataFrame) -> DataFrame:
    keep = ["samplecode", "SampleName", "year", "sitecode", "plotcode", "speciesdatacode", "CanopyPosition"]
    return df.select(*keep, *[c.alias(k) for k, c in parse.needle_age("Age").items()])


def trait_table(raw: DataFrame, values: list[str], order: Column, comment: str | None = None) -> DataFrame:
    """One row per sample key: uncommented rows, repeats averaged."""
    df = filters.uncommented(raw, comment) if comment else raw
    df = columns.rename(df, KEY_NAMES).select(*KEYS, *values)
    return collapse_duplicates(df, KEYS, order)


def traits_by_sample(d15n: DataFrame, lignin: DataFrame, cn: DataFrame, lma: DataFrame) -> DataFrame:
    """The four trait tables side by side, in catalog units."""
    lma = lma.withColumns({c: clean.negative_to_null(c) for c in ("EWT_g_cm2", "LMA_g_DW_m2")})
    any_row = F.lit(0)
    tables = [
        trait_table(d15n, ["SAMPLE_dN15"], any_row, "COMMENTS"),
        trait_table(lignin, ["ADF_PERC_DW", "ADL_PERC_DW", "CELL_PERC_DW"], any_row, "COMMENTS"),
        trait_table(cn, ["Perc_N", "Perc_C", "CNRatio"], any_row),
        trait_table(lma, ["EWT_g_cm2", "LMA_g_DW_m2"], any_row),
    ]
    df = columns.rename(full_join_unique(tables, KEYS), TRAIT_NAMES).withColumns(
        {
            "leaf_water_thickness": units.convert("EWT_g_cm2", "g cm-2", "kg m-2"),
            "leaf_mass_per_area": units.convert("LMA_g_DW_m2", "g m-2", "kg m-2"),
            "samplecode": parse.samplecode(F.lit(PROJECT), "SampleName", "year"),
        }
    )
    return df.drop("EWT_g_cm2", "LMA_g_DW_m2")


def all_samples(refl: DataFrame, trans: DataFrame, traits: DataFrame, species_dict: DataFrame) -> DataFrame:
    """Samples of both spectra tables and of the trait tables, with their codes.

    Samples measured in transmittance only are added, not lost.
    """
    r, t = _sample_columns(refl), _sample_columns(trans)
    measured = r.unionByName(join(t, r.select("samplecode"), ["samplecode"], "anti"))
    both = join(measured, traits.select("samplecode", *KEYS), ["samplecode", *KEYS], "full")
    both = resolve_species(both, species_dict, PROJECT)
    both = both.withColumn("plotcode", when_missing("plotcode", extract("SampleName", r"^\p{Alnum}+")))
    both = both.withColumn("sitecode", when_missing("sitecode", extract("plotcode", r"^\p{Alpha}+")))
    project = F.lit(PROJECT)
    return both.withColumns(
        {
            "projectcode": project,
            "sitecode": parse.dotted(project, "sitecode"),
            "plotcode": parse.dotted(project, "plotcode"),
        }
    )


def build(
    refl_raw: DataFrame,
    trans_raw: DataFrame,
    d15n: DataFrame,
    lignin: DataFrame,
    cn: DataFrame,
    lma: DataFrame,
    plots_raw: DataFrame,
    species_dict: DataFrame,
) -> Batch:
    spark = refl_raw.sparkSession
    refl, trans = _coded(refl_raw), _coded(trans_raw)
    require_unique(refl.select("samplecode"), ["samplecode"])
    by_sample = stored(traits_by_sample(d15n, lignin, cn, lma), "fft-traits")
    samples = stored(all_samples(refl, trans, by_sample, species_dict), "fft-samples")
    project = F.lit(PROJECT)
    located = plots_raw.select("PLOT", "SITE", "LAT", "LON").distinct().select(
        parse.dotted(project, "SITE").alias("sitecode"),
        parse.dotted(project, "PLOT").alias("plotcode"),
        F.col("LAT").alias("latitude"),
        F.col("LON").alias("longitude"),
    )
    wanted = samples.select("sitecode", "plotcode").distinct()
    age = F.format_string("%.0f", "NeedleAge")
    values = samples.select("samplecode", "CanopyPosition", "NeedleOldNew", F.when(F.col("NeedleAge").isNotNull(), age).alias("NeedleAge"))
    traits = melt(
        by_sample, ["samplecode"], columns.with_prefix(by_sample, "leaf"), "trait", "traitvalue", drop_null=True
    )
    kinds = [
        wide_to_packed(df, ["samplecode"]).withColumn("spectratype", F.lit(kind))
        for kind, df in (("reflectance", refl), ("transmittance", trans))
    ]
    info = [
        df.select("samplecode").distinct().withColumn("spectratype", F.lit(kind))
        for kind, df in (("reflectance", refl), ("transmittance", trans))
    ]
    return Batch(
        sites=samples.select("sitecode").distinct(),
        plots=join(located, wanted, ["sitecode", "plotcode"], "right"),
        samples=samples.select("samplecode", "projectcode", "year", "plotcode", "speciescode"),
        condition_info=rows(spark, "condition string, conditiondescription string", *CONDITIONS),
        conditions=melt(
            values, ["samplecode"], ["CanopyPosition", "NeedleOldNew", "NeedleAge"],
            "condition", "conditionvalue", drop_null=True,
        ),
        methods=rows(spark, "instrumentname string, spectratype string, apparatus string, calibration string", *METHODS),
        match=("spectratype",),
        spectra_info=info[0].unionByName(info[1]),
        packed=kinds[0].unionByName(kinds[1]),
        traits=traits,
        trait_info=units_of(traits, UNIT_RULES),
    )
