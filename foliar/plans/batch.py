"""What a project contributes to the catalog, and how it is loaded.

Every project turns its raw tables into one :class:`Batch` of lazy tables; one
loader merges any batch, parents before children.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions.units import label
from foliar.operators.aggregate import duplicate_keys
from foliar.operators.joins import attach_row, join
from foliar.operators.merge import one_per_key, with_ids
from foliar.operators.reshape import pack, unpack
from foliar.session import materialize, side_by_side, small_table
from foliar.sources.catalog import PACKED, SPECTRUM_KEY, Catalog

METHOD_KEY = ["instrumentid", "apparatus", "calibration", "specmethodcomment"]
INSTRUMENT = ["instrumentname", "minwavelength", "maxwavelength", "instrumentcomment"]


@dataclass
class Batch:
    """Catalog rows of one project, without ids.

    ``spectra`` is long and carries the key columns of its spectrum; a project
    whose rows are whole spectra gives them as ``packed`` instead (wavelengths
    and values as arrays), and ``spectra`` is read off that.
    ``methods`` has one row per instrument set-up; its ``match`` columns say
    which spectra used it (none: all of them). Where the points do not carry
    their spectrum's key, ``spectrum`` names the column that leads from
    ``spectra`` to one row of ``spectra_info``.
    """

    sites: DataFrame
    plots: DataFrame
    samples: DataFrame
    spectra_info: DataFrame
    spectra: DataFrame | None = None
    traits: DataFrame | None = None
    trait_info: DataFrame | None = None
    conditions: DataFrame | None = None
    condition_info: DataFrame | None = None
    methods: DataFrame | None = None
    match: tuple[str, ...] = ()
    projects: DataFrame | None = None
    packed: DataFrame | None = None
    spectrum: str | None = None
    ledger: DataFrame | None = None  # what was read of each file, for batches from folders

    def __post_init__(self) -> None:
        if self.spectra is None and self.packed is not None:
            self.spectra = unpack(self.packed, [c for c in self.packed.columns if c not in PACKED])

    def tables(self) -> dict[str, DataFrame]:
        return {k: v for k, v in vars(self).items() if isinstance(v, DataFrame) and k not in ("packed", "ledger")}

    def packed_spectra(self) -> DataFrame:
        """One row per spectrum with its whole key."""
        if self.packed is not None:
            return filled(self.packed, SPECTRUM_KEY)
        if self.spectrum is not None:
            # Packed by the short column first: the key meets a spectrum once, not each of its points.
            owner = filled(self.spectra_info, SPECTRUM_KEY).select(self.spectrum, *SPECTRUM_KEY)
            return join(pack(self.spectra, [self.spectrum]), owner, [self.spectrum], "inner", null_safe=False)
        return pack(filled(self.spectra, SPECTRUM_KEY), SPECTRUM_KEY)


def rows(spark: SparkSession, schema: str, *values: tuple) -> DataFrame:
    """A small fixed table."""
    return small_table(spark, schema, values)


@dataclass(frozen=True)
class Contact:
    """Contact details of a project, given by whoever runs the load."""

    name: str | None = None
    email: str | None = None


def project_row(
    spark: SparkSession, code: str, description: str, doi: str | None = None, contact: Contact = Contact()
) -> DataFrame:
    return rows(
        spark,
        "projectcode string, projectdescription string, doi string, pointofcontact string, email string",
        (code, description, doi, contact.name, contact.email),
    )


def filled(df: DataFrame, columns: list[str], dtype: str = "string") -> DataFrame:
    """Add the columns ``df`` lacks as missing values."""
    return df.withColumns({c: F.lit(None).cast(dtype) for c in columns if c not in df.columns})


def units_of(traits: DataFrame, rules: list[tuple[str, str]], last_wins: bool = False) -> DataFrame:
    """One row per trait with its unit label."""
    return traits.select("trait").distinct().withColumn("unit", label("trait", rules, last_wins))


def one_site(spark: SparkSession, code: str, description: str | None, lat: float, lon: float) -> tuple[DataFrame, DataFrame]:
    """Site and plot rows of a project with a single place."""
    sites = rows(spark, "sitecode string, sitedescription string", (code, description))
    plots = rows(
        spark,
        "plotcode string, sitecode string, plotdescription string, latitude double, longitude double",
        (code, code, description, lat, lon),
    )
    return sites, plots


# Dimension tables that projects share: catalog table, field of the batch, key.
SHARED = [
    ("projects", "projects", "projectcode"),
    ("sites", "sites", "sitecode"),
    ("plots", "plots", "plotcode"),
    ("sample_condition_info", "condition_info", "condition"),
    ("trait_info", "trait_info", "trait"),
]


def first_of(parts: Sequence[DataFrame], by: list[str]) -> DataFrame:
    """One row per key of several tables, from the first table that has it; a key that repeats within one is an error."""
    tagged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("__from", F.lit(i)) for i, p in enumerate(parts)])
    tagged = materialize(tagged, "candidates")
    if not duplicate_keys(tagged, [*by, "__from"]).isEmpty():
        raise ValueError(f"a batch repeats keys of {by}")
    columns = [c for c in tagged.columns if c != "__from"]
    return one_per_key(tagged, by, F.col("__from")).select(*columns)


def _merge_methods(catalog: Catalog, batches: Sequence[Batch]) -> None:
    """Instruments of all batches in one merge, then all set-ups in one."""
    with_methods = [b.methods for b in batches if b.methods is not None]
    if not with_methods:
        return
    names = [m.select(*[c for c in INSTRUMENT if c in m.columns]).distinct() for m in with_methods]
    catalog.add("instruments", first_of(names, ["instrumentname"]), ["instrumentname"])
    ids = catalog.table("instruments").select("instrumentname", "instrumentid")
    methods = [filled(join(m.drop("instrumentid"), ids, ["instrumentname"], "left"), METHOD_KEY[1:]).select(*METHOD_KEY) for m in with_methods]
    catalog.add("specmethods", first_of(methods, METHOD_KEY), METHOD_KEY)


def _with_method(catalog: Catalog, b: Batch) -> DataFrame:
    info = b.spectra_info
    if b.methods is None:
        return info
    ids = catalog.table("instruments").select("instrumentname", "instrumentid")
    methods = filled(join(b.methods, ids, ["instrumentname"], "left"), METHOD_KEY[1:])
    # A handful of set-ups: joined by their match columns, or attached if there is only one.
    wanted = with_ids(methods.select(*METHOD_KEY, *b.match), catalog.table("specmethods"), METHOD_KEY, "specmethodid").select(*b.match, "specmethodid")
    if b.match:
        return join(info, wanted, list(b.match), "left")
    return attach_row(info, wanted)


def _load_facts(catalog: Catalog, b: Batch) -> None:
    def add(name: str, df: DataFrame | None, by: list[str]):
        return lambda: None if df is None else catalog.add(name, df, by, "keep_all")

    catalog.add("samples", b.samples, ["samplecode"])
    side_by_side(
        lambda: catalog.add_packed(b.packed_spectra(), filled(_with_method(catalog, b), SPECTRUM_KEY)),
        add("sample_condition", b.conditions, ["samplecode", "condition"]),
        add("trait_data", b.traits, ["samplecode", "trait"]),
    )


def load_all(catalog: Catalog, batches: Sequence[Batch]) -> None:
    """Merge batches into the catalog, parents first; loading them again adds nothing.

    The dimension rows of all batches are merged at once, one merge per table;
    of a row that several projects give, the first project's is kept. Facts lie
    by project and are loaded two projects side by side, which bounds the plans
    in the driver whatever the number of projects.
    """
    merges = []
    for table, field, key in SHARED:
        parts = [df for b in batches if (df := getattr(b, field)) is not None]
        if parts:
            merges.append(partial(lambda table, parts, key: catalog.add(table, first_of(parts, [key]), [key]), table, parts, key))
    side_by_side(*merges, partial(_merge_methods, catalog, batches))
    side_by_side(*[partial(_load_facts, catalog, b) for b in batches], at_once=2)


def load(catalog: Catalog, b: Batch) -> None:
    """Merge one batch."""
    load_all(catalog, [b])


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a shared intermediate once; several tables are read from it."""
    return materialize(df, label, "zstd")


def when_missing(c: str, value: Column) -> Column:
    return F.when(F.col(c).isNull(), value).otherwise(F.col(c))
