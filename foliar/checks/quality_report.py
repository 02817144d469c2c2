"""Audits, assertions, reports, resampling and whole loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.checks.analog import Views
from foliar.checks.registry import SQL_TEXT, check
from foliar.functions.nulls import update_where
from foliar.operators import quality
from foliar.operators.resample import resample_packed
from foliar.plans import report
from foliar.plans.build import export_together, read_export
from foliar.session import scratch_path

_CATALOG_VIEWS = ("species", "species_dict", "spectra_info", "spectra_points", "trait_data")


def _unique_sql(table: str, source: str, *key: str) -> str:
    cols = ", ".join(key)
    present = " and ".join(f"{k} is not null" for k in key)
    return (
        f"select '{table}' table_name, '{','.join(key)}' key_columns, count(*) n_keys, "
        f"cast(coalesce(sum(n - 1), 0) as bigint) n_extra_rows from (select count(*) n from {source} where {present} "
        f"group by {cols} having count(*) > 1)"
    )


def _orphan_sql(table: str, source: str, column: str, parent: str, parent_source: str) -> str:
    return (
        f"select '{table}' table_name, '{column}' column_name, '{parent}' parent, count(*) n_rows, "
        f"count(distinct {column}) n_keys from {source} c where {column} is not null and not exists "
        f"(select 1 from {parent_source} p where p.{column} = c.{column})"
    )


def _audit_tables(v: Views) -> dict[str, DataFrame]:
    """The catalog with gaps: some plots, attributes and missing codes taken out."""
    names = ("projects", "sites", "plots", "species", "species_dict", "samples", "spectra_info", "spectra_data", "trait_data")
    t = v.catalog(*names)
    t["plots"] = t["plots"].where("latitude is not null")
    t["species_dict"] = t["species_dict"].withColumn(
        "speciescode", update_where("speciescode", F.col("projectcode") == "asia", F.concat("speciescode", F.lit("?")))
    )
    t["spectra_info"] = t["spectra_info"].withColumn(
        "samplecode", F.when(F.col("spectratype") != "transmittance", F.col("samplecode"))
    )
    return t


_GAPS = (
    "with aplots as (select * from plots where latitude is not null), "
    "adict as (select speciesdatacode, projectcode, case when projectcode = 'asia' then speciescode || '?' else "
    "speciescode end speciescode from species_dict), "
    "ainfo as (select spectraid, case when spectratype <> 'transmittance' then samplecode end samplecode from spectra_info) "
)


@check(
    _GAPS + " union all ".join(
        [
            _unique_sql("projects", "projects", "projectcode"),
            _unique_sql("sites", "sites", "sitecode"),
            _unique_sql("plots", "aplots", "plotcode"),
            _unique_sql("species", "species", "speciescode"),
            _unique_sql("species_dict", "adict", "speciesdatacode", "projectcode"),
            _unique_sql("samples", "samples", "samplecode"),
            _unique_sql("spectra_data", "spectra_points", "spectraid", "wavelength"),
        ]
    ),
    *_CATALOG_VIEWS,
)
def audit_unique(v: Views) -> DataFrame:
    return quality.audit_unique(_audit_tables(v))


@check(
    _GAPS + " union all ".join(
        [
            _orphan_sql("plots", "aplots", "sitecode", "sites", "sites"),
            _orphan_sql("species_dict", "adict", "projectcode", "projects", "projects"),
            _orphan_sql("species_dict", "adict", "speciescode", "species", "species"),
            _orphan_sql("samples", "samples", "projectcode", "projects", "projects"),
            _orphan_sql("samples", "samples", "plotcode", "plots", "aplots"),
            _orphan_sql("samples", "samples", "speciescode", "species", "species"),
            _orphan_sql("spectra_info", "ainfo", "samplecode", "samples", "samples"),
            _orphan_sql("spectra_data", "spectra_points", "spectraid", "spectra_info", "ainfo"),
            _orphan_sql("trait_data", "trait_data", "samplecode", "samples", "samples"),
        ]
    ),
    *_CATALOG_VIEWS,
)
def audit_orphans(v: Views) -> DataFrame:
    tables = _audit_tables(v)
    tables["spectra_info"] = tables["spectra_info"].withColumn("specmethodid", F.lit(None).cast("long"))
    return quality.audit_orphans(tables)


@check(
    _GAPS + "select 'spectra_info' table_name, 'samplecode' column_name, cast(count_if(samplecode is null) as bigint) n_null from ainfo "
    "union all select 'spectra_data', 'spectraid', cast(count_if(spectraid is null) as bigint) from spectra_points "
    "union all select 'trait_data', 'samplecode', cast(count_if(samplecode is null) as bigint) from trait_data",
    *_CATALOG_VIEWS,
)
def audit_not_null(v: Views) -> DataFrame:
    return quality.audit_not_null(_audit_tables(v))


@check(
    "select 'spectra_data' table_name, 'wavelength' column_name, cast(count_if(wavelength <= 0) as bigint) n_bad from spectra_points",
    "spectra_points",
)
def audit_check(v: Views) -> DataFrame:
    return quality.audit_positive(_audit_tables(v))


@check(
    "select wavelength, spectraid, spectravalue from spectra_data", "spectra_data"
)
def spectrum_contract(v: Views) -> DataFrame:
    return quality.spectrum_contract(v.spectra_data())


@check(
    "select a n_left, b n_right, a = b matches from (select (select count(distinct c_nationkey) from customer) a, "
    "(select count(distinct s_nationkey) from supplier) b)"
)
def assert_counts_match(v: Views) -> DataFrame:
    return quality.counts_match(v.raw("customer"), "c_nationkey", v.raw("supplier"), "s_nationkey")


@check(
    "with codes as (select distinct projectcode, case when year >= 2000 then 'Brand#' || right(cast(year as varchar), 2) "
    "else 'Brand#' || right(cast(year as varchar), 1) end speciesdatacode from samples) "
    "select projectcode, speciesdatacode from codes where (projectcode, speciesdatacode) not in "
    "(select projectcode, speciesdatacode from species_dict)",
    "samples", "species_dict",
)
def unresolved_species(v: Views) -> DataFrame:
    year = F.col("year").cast("string")
    code = F.when(F.col("year") >= 2000, F.right(year, F.lit(2))).otherwise(F.right(year, F.lit(1)))
    s = v.samples().select("projectcode", F.concat(F.lit("Brand#"), code).alias("speciesdatacode"))
    return quality.unresolved_codes(s, "speciesdatacode", v.species_dict(), "projectcode")


# --- reports --------------------------------------------------------------------------
@check(
    "select projectcode, spectratype, count(*) n from samples join spectra_info using (samplecode) group by 1, 2",
    "spectra_info",
)
def report_spectra_by_project(v: Views) -> DataFrame:
    return report.spectra_by_project(v.catalog("samples", "spectra_info"))


@check("select projectcode, count(*) n from samples group by 1", "samples")
def report_samples_by_project(v: Views) -> DataFrame:
    return report.samples_by_project(v.catalog("samples"))


@check(
    "select projectcode, count(*) n from samples join spectra_info using (samplecode) where samplecode in "
    "(select samplecode from trait_data) group by 1",
    "spectra_info", "trait_data",
)
def report_pairs_by_project(v: Views) -> DataFrame:
    return report.pairs_by_project(v.catalog("samples", "spectra_info", "trait_data"))


@check(
    "select trait, count(*) n from samples join spectra_info using (samplecode) join trait_data using (samplecode) group by 1",
    "spectra_info", "trait_data",
)
def report_pairs_by_trait(v: Views) -> DataFrame:
    return report.pairs_by_trait(v.catalog("samples", "spectra_info", "trait_data"))


_LOCATION = (
    "select p.sitecode, s.projectcode, avg(latitude) mean_lat, avg(longitude) mean_lon, count(*) nsamp "
    "from samples s left join plots p on p.plotcode = s.plotcode group by 1, 2"
)


@check(
    f"select sitecode, projectcode, round(mean_lat, 9) mean_lat, round(mean_lon, 9) mean_lon, nsamp from ({_LOCATION})",
    "samples",
)
def report_by_location(v: Views) -> DataFrame:
    out = report.by_location(v.catalog("samples", "plots"))
    return out.withColumns({c: F.round(c, 9) for c in ("mean_lat", "mean_lon")})


@check(
    "select round_even(min(mean_lon), 0) lon_min, round_even(max(mean_lon), 0) lon_max, "
    f"round_even(min(mean_lat), 0) lat_min, round_even(max(mean_lat), 0) lat_max from ({_LOCATION})",
    "samples",
)
def coordinate_range(v: Views) -> DataFrame:
    return report.coordinate_range(report.by_location(v.catalog("samples", "plots")))


@check(
    "select c.speciescode, scientificname, n from (select speciescode, count(*) n from samples group by 1) c "
    "left join species s on s.speciescode = c.speciescode order by n desc, c.speciescode nulls last limit 20",
    "samples", "species",
)
def top20_species(v: Views) -> DataFrame:
    return report.top_species(v.catalog("samples", "species"), 20)


@check(
    "with r as (select a.* from samples s left join species_attributes a on a.speciescode = s.speciescode) "
    + " union all ".join(
        f"select '{a}' as attribute, {a} as value, count(*) n from r group by {a}" for a in report.ATTRIBUTES
    ),
    "samples", "species_attributes",
)
def report_attribute_distribution(v: Views) -> DataFrame:
    return report.attribute_distribution(v.catalog("samples", "species_attributes"))


@check(
    "select sitecode, count(*) n from samples s join plots p using (plotcode) where latitude is null or longitude is null "
    "group by 1",
    "samples",
)
def report_missing_coords(v: Views) -> DataFrame:
    return report.missing_coordinates(v.catalog("samples", "plots"))


@check("select projectcode, count(*) n from samples where speciescode is null group by 1", "samples")
def report_missing_species(v: Views) -> DataFrame:
    return report.missing_species(v.catalog("samples"))


@check(
    "select projectcode, count(*) n from samples where samplecode not in (select samplecode from spectra_info) group by 1",
    "spectra_info",
)
def report_no_spectra(v: Views) -> DataFrame:
    return report.without_spectra(v.catalog("samples", "spectra_info"))


@check(
    "select sitecode, year, count(*) n, cast(count_if(speciescode is null) as bigint) n_no_species from samples s join plots p "
    "using (plotcode) group by 1, 2",
    "samples",
)
def report_site_sanity(v: Views) -> DataFrame:
    return report.site_sanity(v.catalog("samples", "plots"))


# Report -> its check, its key columns and its count.
_EXPORTED = {
    "spectra_by_project": ("report_spectra_by_project", ("projectcode", "spectratype"), "n"),
    "samples_by_project": ("report_samples_by_project", ("projectcode",), "n"),
    "pairs_by_project": ("report_pairs_by_project", ("projectcode",), "n"),
    "pairs_by_trait": ("report_pairs_by_trait", ("trait",), "n"),
    "by_location": ("report_by_location", ("sitecode", "projectcode"), "nsamp"),
    "top_species": ("top20_species", ("speciescode", "scientificname"), "n"),
    "attribute_distribution": ("report_attribute_distribution", ("attribute", "value"), "n"),
    "missing_coordinates": ("report_missing_coords", ("sitecode",), "n"),
    "missing_species": ("report_missing_species", ("projectcode",), "n"),
    "without_spectra": ("report_no_spectra", ("projectcode",), "n"),
    "site_sanity": ("report_site_sanity", ("sitecode", "year"), "n"),
}


def _export_sql() -> str:
    def one(name: str) -> str:
        query, keys, n = _EXPORTED[name]
        k = [f"cast({c} as varchar)" for c in keys] + ["null"] * (2 - len(keys))
        return f"select '{name}' report, {k[0]} k1, {k[1]} k2, cast({n} as bigint) n from ({SQL_TEXT[query]})"

    return " union all ".join(map(one, _EXPORTED))


@check(_export_sql())
def report_export(v: Views) -> DataFrame:
    """All reports written in one job and read back."""
    tables = v.catalog()
    made = {name: fn(tables) for name, fn in report.REPORTS.items()}
    folder = scratch_path(v.spark, "reports")
    export_together(made, folder)
    parts = []
    for name, df in read_export(v.spark, folder, {n: df.schema for n, df in made.items()}).items():
        _, keys, n = _EXPORTED[name]
        k = [F.col(c).cast("string") for c in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
        parts.append(df.select(F.lit(name).alias("report"), k[0].alias("k1"), k[1].alias("k2"), F.col(n).cast("long").alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- resampling --------------------------------------------------------------------------
@check(
    "with pts as (select vec_id, label, unnest(range(1, len(embedding) + 1)) i, embedding from embeddings), "
    "w as (select vec_id, label, 350.3 + 10 * (i - 1) + 4 * abs(cast(embedding[i] as double)) x from pts), "
    "e as (select vec_id, label, cast(ceil(min(x)) as bigint) lo, cast(floor(max(x)) as bigint) hi from w group by 1, 2), "
    "g as (select vec_id, label, (unnest(range(lo, hi + 1)) - 650) / 307.0::double u, lo, hi from e), "
    "y as (select vec_id, lo, hi, u * u * u - label * u * u + 0.5 * u + 1 y from g), "
    "z as (select vec_id, lo, hi, 'reflectance' spectratype, y from y union all "
    "select vec_id, lo, hi, 'transmittance', 1 - 2 * y from y) "
    "select vec_id spectraid, spectratype, count(*) n, cast(min(lo) as double) first_wl, cast(max(hi) as double) last_wl, "
    "round(sum(y), 5) total, round(sum(y * y), 5) squares from z group by 1, 2"
)
def resample_spline(v: Views) -> DataFrame:
    x = F.transform("embedding", lambda e, i: F.lit(350.3) + 10 * i + 4 * F.abs(e.cast("double")))
    label = F.col("label")

    def cubic(w):
        u = (w - 650) / F.lit(307.0)
        return u * u * u - label * u * u + 0.5 * u + 1

    packed = v.raw("embeddings").select(F.col("vec_id").alias("spectraid"), x.alias("wavelengths"), "label").select(
        "spectraid",
        "wavelengths",
        F.transform("wavelengths", cubic).alias("r"),
        F.transform("wavelengths", lambda w: 1 - 2 * cubic(w)).alias("t"),
    )
    long = resample_packed(packed, ["spectraid"], {"reflectance": "r", "transmittance": "t"})
    return long.groupBy("spectraid", "spectratype").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("wavelength").alias("first_wl"),
        F.max("wavelength").alias("last_wl"),
        F.round(F.sum("spectravalue"), 5).alias("total"),
        F.round(F.sum(F.col("spectravalue") * F.col("spectravalue")), 5).alias("squares"),
    )
