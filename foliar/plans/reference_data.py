"""Reference tables: projects, species, species dictionary, species attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliar.functions.nulls import recode_keep
from foliar.functions.parse import accepted_name, scientific_parts
from foliar.operators.joins import join, spread_join
from foliar.session import side_by_side
from foliar.sources.catalog import Catalog

# Declared layouts of the reference files.
PROJECTS_CSV = (
    "projectcode string, projectdescription string, affiliation string, pointofcontact string, email string, "
    "projectcomment string"
)
DICTIONARY_CSV = (
    "RawSpecies string, ScientificName string, SpeciesCode string, Database_ID string, Project string, "
    "old_scientific string, SpeciesScientific string"
)
OTHER_SPECIES_CSV = (
    "code string, codetype string, scientificname string, genus string, species string, variety string, subspecies string"
)
ATTRIBUTES_CSV = (
    "speciescode string, scientific_name string, family string, growth_form string, leaf_type string, "
    "myco_asso string, phenology string, ps_type string, nitrogen_fixer boolean, shade_tolerance string, "
    "shade_tolerance_numeric double, shade_reference string, myco_reference string"
)

# Columns of the plant database and their catalog names.
USDA_NAMES = {
    "Symbol": "code",
    "Genus": "genus",
    "Species": "species",
    "Subspecies": "subspecies",
    "Variety": "variety",
    "Subvariety": "subvariety",
    "Forma": "forma",
    "Family": "family",
    "Genera_Binomial_Author": "authority",
    "Scientific_Name_x": "scientificname",
}

# Uncertain, mixed and arbutoid associations by the group they are counted in.
MYCORRHIZA = {
    "ECM?": "ECM",
    "AM?": "AM",
    "EITHER": "AM + ECM",
    "ABM": "ECM",
    "ABM, ECM": "ECM",
}


TRY_ID = "tryspeciesid"


def usda_species(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(a).alias(b) for a, b in USDA_NAMES.items()]).withColumn("codetype", F.lit("USDA_Plants"))


def _named(usda: DataFrame, try_names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the match under one name."""
    named = usda.withColumn("accepted_name", accepted_name("genus", "species", "scientificname"))
    return named, try_names.select(F.col("AccSpeciesName").alias("accepted_name"), F.col("AccSpeciesID").alias("tryspeciesid"))


def match_species(usda: DataFrame, try_names: DataFrame) -> DataFrame:
    """Every plant-database row with the trait-database id of its accepted name.

    A name with several ids keeps one row per id.
    """
    return spread_join(*_named(usda, try_names), ["accepted_name"])


def match_rate(usda: DataFrame, try_names: DataFrame) -> DataFrame:
    """Matched and total rows of ``match_species`` and the percentage.

    Its rows are counted by name, as products, and never built.
    """
    named, ids = _named(usda, try_names)
    n_ids = ids.groupBy("accepted_name").agg(F.count("tryspeciesid").alias("n_ids"), F.count(F.lit(1)).alias("n_rows"))
    per = join(named.groupBy("accepted_name").agg(F.count(F.lit(1)).alias("n")), n_ids, ["accepted_name"], "left")

    def total(each: Column) -> Column:
        return F.coalesce(F.sum(F.col("n") * each), F.lit(0))

    counts = per.agg(total(F.coalesce("n_ids", F.lit(0))).alias("n_match"), total(F.coalesce("n_rows", F.lit(1))).alias("n_total"))
    return counts.withColumn("pct_match", 100.0 * F.try_divide("n_match", "n_total"))


def backbone(usda_raw: DataFrame, try_names: DataFrame) -> DataFrame:
    return match_species(usda_species(usda_raw), try_names).drop("accepted_name")


def other_species(dictionary: DataFrame) -> DataFrame:
    """Dictionary species from the second name source, with their name parts."""
    rows = dictionary.where(F.col("Database_ID") == "ThePlantList").select(
        F.col("SpeciesCode").alias("code"),
        F.col("Database_ID").alias("codetype"),
        F.col("ScientificName").alias("scientificname"),
    )
    return rows.withColumns(scientific_parts("scientificname"))


def species_rows(backbone_rows: DataFrame, other: DataFrame) -> DataFrame:
    """Both species sources under one set of columns."""
    both = backbone_rows.unionByName(other, allowMissingColumns=True)
    return both.withColumnsRenamed({"code": "speciescode", "codetype": "speciescodetype"})


def species_of(rows: DataFrame) -> DataFrame:
    """One row per species code, with the least of its trait-database ids; the links keep all of them.

    Rows that differ in more than that id, and rows that repeat as a whole, stay
    apart, so the load refuses them.
    """
    if TRY_ID not in rows.columns:
        return rows
    names = [c for c in rows.columns if c != TRY_ID]
    least = rows.groupBy(*names, TRY_ID).agg(F.count(F.lit(1)).alias("__n"))
    least = least.groupBy(*names).agg(F.min(TRY_ID).alias(TRY_ID), F.max("__n").alias("__n"))
    times = F.sequence(F.lit(1).cast("long"), F.col("__n"))
    return least.withColumn("__n", F.explode(times)).select(*rows.columns)


def species_links(rows: DataFrame) -> DataFrame:
    """Every pair of species code and trait-database id."""
    if TRY_ID not in rows.columns:
        return rows.select("speciescode", F.lit(None).cast("long").alias(TRY_ID)).limit(0)
    return rows.select("speciescode", F.col(TRY_ID).cast("long").alias(TRY_ID)).where(F.col("speciescode").isNotNull() & F.col(TRY_ID).isNotNull()).distinct()


def dictionary_rows(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(
        F.col("RawSpecies").alias("speciesdatacode"),
        F.lower("Project").alias("projectcode"),
        F.col("SpeciesCode").alias("speciescode"),
    )


def attribute_rows(attributes: DataFrame) -> DataFrame:
    return attributes.withColumns(
        {"myco_asso": recode_keep("myco_asso", MYCORRHIZA), "shade_tolerance": F.lower("shade_tolerance")}
    ).drop("scientific_name", "family")


def load(
    catalog: Catalog, projects: DataFrame, species: DataFrame, dictionary: DataFrame, attributes: DataFrame
) -> None:
    """Fill the reference tables, parents first; rerunning adds nothing.

    A species with several ids in the trait database is one row of ``species``
    and one row of ``species_try`` per id.
    """
    side_by_side(
        lambda: catalog.add("projects", projects, ["projectcode"]),
        lambda: catalog.add("species", species_of(species), ["speciescode"]),
        lambda: catalog.replace("species_attributes", attribute_rows(attributes)),
    )
    side_by_side(
        lambda: catalog.add("species_dict", dictionary_rows(dictionary), ["speciesdatacode", "projectcode"]),
        lambda: catalog.add("species_try", species_links(species), ["speciescode", TRY_ID]),
    )
