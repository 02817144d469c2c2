"""Coverage and data-quality reports over the catalog.

Each report takes the catalog's tables by name and returns a lazy DataFrame.
Joins here follow database rules: a missing key matches nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.operators.aggregate import count_sorted
from foliar.operators.joins import join
from foliar.operators.ordered import top_k

Tables = dict[str, DataFrame]

# The attributes whose distributions are reported.
ATTRIBUTES = ("growth_form", "ps_type", "myco_asso", "shade_tolerance")


def _samples(t: Tables, *columns: str) -> DataFrame:
    return t["samples"].select(*columns)


def spectra_by_project(t: Tables) -> DataFrame:
    spectra = t["spectra_info"].select("samplecode", "spectratype")
    paired = join(_samples(t, "samplecode", "projectcode"), spectra, ["samplecode"], "inner", null_safe=False)
    return count_sorted(paired, "projectcode", "spectratype")


def samples_by_project(t: Tables) -> DataFrame:
    return count_sorted(t["samples"], "projectcode")


def pairs_by_project(t: Tables) -> DataFrame:
    """Spectra of samples that have any trait, by project."""
    paired = join(
        _samples(t, "samplecode", "projectcode"),
        t["spectra_info"].select("samplecode"),
        ["samplecode"],
        "inner",
        null_safe=False,
    )
    return count_sorted(join(paired, t["trait_data"], ["samplecode"], "semi", null_safe=False), "projectcode")


def pairs_by_trait(t: Tables) -> DataFrame:
    """Every spectrum paired with every trait row of its sample, counted by trait.

    Spectra and samples are counted per sample code before the join and a trait
    row weighs their product, so the pairs themselves are never built.
    """
    n_spectra = t["spectra_info"].groupBy("samplecode").agg(F.count(F.lit(1)).alias("n_spectra"))
    n_samples = t["samples"].groupBy("samplecode").agg(F.count(F.lit(1)).alias("n_samples"))
    weights = join(n_spectra, n_samples, ["samplecode"], "inner", False)
    weights = weights.select("samplecode", (F.col("n_spectra") * F.col("n_samples")).alias("pairs"))
    rows = join(t["trait_data"].select("samplecode", "trait"), weights, ["samplecode"], "inner", False)
    return rows.groupBy("trait").agg(F.sum("pairs").alias("n")).orderBy(F.desc("n"), "trait")


def by_location(t: Tables) -> DataFrame:
    """Mean coordinates and number of samples by site and project.

    Samples are counted per plot first; the means weigh plots by samples.
    """
    per_plot = t["samples"].groupBy("plotcode", "projectcode").agg(F.count(F.lit(1)).alias("k"))
    plots = t["plots"].select("plotcode", "sitecode", "latitude", "longitude")
    placed = join(per_plot, plots, ["plotcode"], "left", null_safe=False)

    def weighted(c: str):
        return F.try_divide(F.sum(F.col(c) * F.col("k")), F.sum(F.when(F.col(c).isNotNull(), F.col("k"))))

    return placed.groupBy("sitecode", "projectcode").agg(
        weighted("latitude").alias("mean_lat"), weighted("longitude").alias("mean_lon"), F.sum("k").alias("nsamp")
    )


def coordinate_range(locations: DataFrame) -> DataFrame:
    """Whole-degree bounds of the site means, ties to the even degree."""
    return locations.agg(
        F.bround(F.min("mean_lon")).alias("lon_min"),
        F.bround(F.max("mean_lon")).alias("lon_max"),
        F.bround(F.min("mean_lat")).alias("lat_min"),
        F.bround(F.max("mean_lat")).alias("lat_max"),
    )


def samples_by_species(t: Tables) -> DataFrame:
    counts = t["samples"].groupBy("speciescode").agg(F.count(F.lit(1)).alias("n"))
    return join(counts, t["species"].select("speciescode", "scientificname"), ["speciescode"], "left", null_safe=False)


def top_species(t: Tables, k: int = 20) -> DataFrame:
    top = top_k(samples_by_species(t), k, F.desc("n"), F.col("speciescode").asc_nulls_last())
    return top.select("speciescode", "scientificname", "n")


def attribute_distribution(t: Tables) -> DataFrame:
    """Samples per value of each species attribute; species without attributes count as missing."""
    counts = t["samples"].groupBy("speciescode").agg(F.count(F.lit(1)).alias("k"))
    rows = join(
        counts, t["species_attributes"].select("speciescode", *ATTRIBUTES), ["speciescode"], "left", null_safe=False
    )
    long = rows.unpivot(["k"], list(ATTRIBUTES), "attribute", "value")
    return long.groupBy("attribute", "value").agg(F.sum("k").alias("n")).orderBy("attribute", F.desc("n"), "value")


def missing_coordinates(t: Tables) -> DataFrame:
    plots = t["plots"].where(F.col("latitude").isNull() | F.col("longitude").isNull()).select("plotcode", "sitecode")
    hit = join(_samples(t, "plotcode"), plots, ["plotcode"], "inner", null_safe=False)
    return count_sorted(hit, "sitecode")


def missing_species(t: Tables) -> DataFrame:
    return count_sorted(t["samples"].where(F.col("speciescode").isNull()), "projectcode")


def without_spectra(t: Tables) -> DataFrame:
    left = join(
        _samples(t, "samplecode", "projectcode"), t["spectra_info"], ["samplecode"], "anti", null_safe=False
    )
    return count_sorted(left, "projectcode")


def site_sanity(t: Tables) -> DataFrame:
    """Samples per site and year, and how many of them lack a species."""
    per_plot = (
        t["samples"]
        .groupBy("plotcode", "year")
        .agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("speciescode").isNull()).alias("m"))
    )
    placed = join(per_plot, t["plots"].select("plotcode", "sitecode"), ["plotcode"], "left", null_safe=False)
    return placed.groupBy("sitecode", "year").agg(F.sum("k").alias("n"), F.sum("m").alias("n_no_species"))


REPORTS = {
    "spectra_by_project": spectra_by_project,
    "samples_by_project": samples_by_project,
    "pairs_by_project": pairs_by_project,
    "pairs_by_trait": pairs_by_trait,
    "by_location": by_location,
    "top_species": top_species,
    "attribute_distribution": attribute_distribution,
    "missing_coordinates": missing_coordinates,
    "missing_species": missing_species,
    "without_spectra": without_spectra,
    "site_sanity": site_sanity,
}
