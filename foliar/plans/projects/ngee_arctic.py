"""ngee_arctic: yearly spectra tables and several trait tables that complete each other."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import strict_mean, update_where
from foliar.operators import columns
from foliar.operators.aggregate import require_unique
from foliar.operators.joins import full_join_unique, join, resolve_species, update_join
from foliar.operators.ordered import row_number_in_group
from foliar.operators.reshape import melt, scale_bands, wide_to_packed
from foliar.plans.batch import Batch, stored, units_of, when_missing

PROJECT, BARROW, SEWARD = "ngee_arctic", "ngee_arctic.Barrow", "ngee_arctic.Seward_Kougarok"

# Source -> (sample column, year, site); the first prefixes a number.
SPECTRA = {
    "2013": ("Sample_ID", 2013, BARROW),
    "2014": ("Spectra", 2014, BARROW),
    "2015": ("Sample_Barcode", 2015, BARROW),
    "2016b": ("Sample_Barcode", 2016, BARROW),
    "2016s": ("BNL_Barcode", 2016, SEWARD),
}
BARROW_LATITUDE, BARROW_LONGITUDE = 71.275764, -156.641386
PERCENT = 0.01
# Unit labels, first match decides.
UNIT_RULES = [("_per_area", "kg m-2"), ("_pct_mass", "%"), ("ratio", "unitless"), ("^leaf_area$", "m2")]
PIGMENTS = ["leaf_chla_per_area", "leaf_chlb_per_area", "leaf_chltot_per_area"]
SAMPLE_KEYS = ["SampleName", "year", "sitecode"]


def _grams(c: str):
    return units.convert(c, "g m-2", "kg m-2")


def spectra_tables(raw: Mapping[str, DataFrame]) -> DataFrame:
    """All years under one set of columns, spectra as fractions."""
    parts = []
    for key, (sample, year, site) in SPECTRA.items():
        if key not in raw:
            continue
        name = F.concat(F.lit("BNL"), F.col(sample)) if key == "2013" else F.col(sample).cast("string")
        part = scale_bands(raw[key], PERCENT).withColumns(
            {"SampleName": name, "year": F.lit(year), "sitecode": F.lit(site)}
        )
        keep = [*SAMPLE_KEYS, "Spectrometer_GPS_Lat", "Spectrometer_GPS_Long"]
        parts.append(part.select(*[c for c in keep if c in part.columns], *columns.with_prefix(part, "Wave_")))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.withColumn("samplecode", parse.samplecode(F.lit(PROJECT), "SampleName", "year"))


def plot_codes(samples: DataFrame) -> DataFrame:
    """Number the distinct coordinates of each site; samples without coordinates share one plot."""
    places = samples.where(F.col("latitude").isNotNull()).select("sitecode", "latitude", "longitude").distinct()
    numbered = row_number_in_group(places, ["sitecode"], ["latitude", "longitude"], "__plot")
    df = join(samples, numbered, ["sitecode", "latitude", "longitude"], "left")
    return df.withColumn("plotcode", parse.dotted("sitecode", "__plot")).drop("__plot")


def traits_main(raw: DataFrame) -> DataFrame:
    """Carbon, nitrogen and leaf mass of 2012 to 2015."""
    df = columns.drop_unnamed(raw).where(F.col("Sample_ID").isNotNull())
    df = columns.map_numeric(df, lambda c: clean.sentinel_equal(c, -9999))
    date = parse.parse_date("Measurement_Date", "%Y%m%d")
    return df.select(
        F.col("Sample_ID").alias("SampleName"),
        F.year(date).alias("year"),
        date.alias("collectiondate"),
        F.lit(BARROW).alias("sitecode"),
        F.col("USDA_Species_Code").alias("speciesdatacode"),
        F.col("Perc_C").alias("leaf_C_pct_mass"),
        F.col("Perc_N").alias("leaf_N_pct_mass"),
        F.col("CN_ratio").alias("leaf_CN_ratio_mass"),
        _grams("LMA_gDW_m2").alias("leaf_mass_per_area"),
        _grams("N_area_gDW_m2").alias("leaf_N_per_area"),
        _grams("C_area_gDW_m2").alias("leaf_C_per_area"),
    )


def pigments_2015(raw: DataFrame) -> DataFrame:
    def mg(c: str):
        return units.convert(c, "mg m-2", "kg m-2")

    return raw.select(
        F.col("Barcode").alias("SampleName"),
        F.lit(2015).alias("year"),
        F.lit(BARROW).alias("sitecode"),
        F.col("Total_area_m2").alias("leaf_area"),
        mg("Chl_a_mg_m2").alias("leaf_chla_per_area"),
        mg("Chl_b_mg_m2").alias("leaf_chlb_per_area"),
        mg("Chl_a_plus_b_mg_m2").alias("leaf_chltot_per_area"),
        mg("Tot_Car_mg_m2").alias("leaf_cartot_per_area"),
    )


def pigments_2013(raw: DataFrame) -> DataFrame:
    """Chlorophyll measured with the 2013 spectra, by sample name."""
    a, b = _grams("Chl_a_g_m2"), _grams("Chl_b_g_m2")
    return raw.select(
        F.concat(F.lit("BNL"), F.col("Sample_ID")).alias("SampleName"),
        a.alias("leaf_chla_per_area"),
        b.alias("leaf_chlb_per_area"),
        (a + b).alias("leaf_chltot_per_area"),
    )


def traits_2016(seward: DataFrame, barrow: DataFrame, chn: DataFrame) -> DataFrame:
    """Leaf mass of both sites and carbon and nitrogen of one, by sample and species."""
    date = parse.parse_date("Measurement_Date", "%Y%m%d").alias("collectiondate")
    named = F.concat(F.lit("BNL"), F.col("Sample_Barcode")).alias("SampleName")
    year, mass = F.lit(2016).alias("year"), _grams("LMA_gDW_m2").alias("leaf_mass_per_area")
    keys = [*SAMPLE_KEYS, "speciesdatacode"]
    tables = [
        seward.select(
            named, year, parse.dotted(F.lit(PROJECT), "Site").alias("sitecode"),
            F.col("USDA_Species_Code").alias("speciesdatacode"), date, mass,
        ),
        barrow.select(named, year, F.lit(BARROW).alias("sitecode"), F.col("Species").alias("speciesdatacode"), date, mass),
        chn.select(
            F.col("Sample_Barcode").alias("SampleName"), year, F.lit(BARROW).alias("sitecode"),
            F.col("USDA_Species_Code").alias("speciesdatacode"), F.col("Perc_C").alias("leaf_C_pct_mass"),
            F.col("Perc_N").alias("leaf_N_pct_mass"), F.col("CN_ratio").alias("leaf_CN_ratio_mass"),
        ),
    ]
    return full_join_unique([require_unique(t, keys) for t in tables], keys)


def all_traits(raw: Mapping[str, DataFrame]) -> DataFrame:
    main = traits_main(raw["traits_main"])
    other = join(main, pigments_2015(raw["pigments"]), SAMPLE_KEYS, "full").where(F.col("year").isNotNull())
    late = traits_2016(raw["seward_2016_lma"], raw["barrow_2016_lma"], raw["barrow_2016_chn"])
    both = late.unionByName(other, allowMissingColumns=True)
    return update_join(both, pigments_2013(raw["2013"]), ["SampleName"], PIGMENTS)


def build(raw: Mapping[str, DataFrame], species_dict: DataFrame) -> Batch:
    """``raw`` holds the spectra tables by the keys of SPECTRA and the trait tables by name."""
    spectra_wide = spectra_tables(raw)
    measured = plot_codes(
        spectra_wide.select(
            *SAMPLE_KEYS, F.col("Spectrometer_GPS_Lat").alias("latitude"), F.col("Spectrometer_GPS_Long").alias("longitude")
        )
    )
    traits_full = stored(all_traits(raw), "arctic-traits")
    analysed = traits_full.select(*[c for c in traits_full.columns if not c.startswith("leaf_")])
    both = resolve_species(join(measured, analysed, SAMPLE_KEYS, "full"), species_dict, PROJECT)
    no_plot = parse.dotted("sitecode", F.lit(None))
    samples = stored(
        both.withColumns(
            {
                "projectcode": F.lit(PROJECT),
                "samplecode": parse.samplecode(F.lit(PROJECT), "SampleName", "year"),
                "plotcode": when_missing("plotcode", no_plot),
            }
        ),
        "arctic-samples",
    )
    plots = samples.groupBy("sitecode", "plotcode").agg(
        strict_mean("latitude").alias("latitude"), strict_mean("longitude").alias("longitude")
    )
    at_barrow = F.col("sitecode") == BARROW
    plots = plots.withColumns(
        {
            "latitude": update_where("latitude", at_barrow & F.col("latitude").isNull(), BARROW_LATITUDE),
            "longitude": update_where("longitude", at_barrow & F.col("longitude").isNull(), BARROW_LONGITUDE),
        }
    )
    coded = traits_full.withColumn("samplecode", parse.samplecode(F.lit(PROJECT), "SampleName", "year"))
    traits = melt(coded, ["samplecode"], columns.with_prefix(coded, "leaf_"), "trait", "traitvalue", drop_null=True)
    kind = F.lit("reflectance").alias("spectratype")
    return Batch(
        sites=samples.select("sitecode").distinct(),
        plots=plots,
        samples=samples.select("samplecode", "projectcode", "year", "collectiondate", "plotcode", "speciescode"),
        spectra_info=spectra_wide.select("samplecode", kind).distinct(),
        packed=wide_to_packed(spectra_wide, ["samplecode"]).select("*", kind),
        traits=traits,
        trait_info=units_of(traits, UNIT_RULES),
    )
