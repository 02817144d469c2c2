"""Catalog tables: columns, keys, references and checks.

One description drives the empty catalog, the merges, the cascading delete and
the audits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class Table:
    """Columns and constraints of one catalog table."""

    name: str
    ddl: str
    key: str | None = None
    unique: tuple[tuple[str, ...], ...] = ()
    refs: tuple[tuple[str, str], ...] = ()  # (column, parent table); same column name in both
    not_null: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    by_project: bool = False  # a fact: stored in one folder per project

    @property
    def schema(self) -> T.StructType:
        fields = (part.split() for part in self.ddl.split(","))
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# The catalog's tables, columns, keys and references.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "projects",
            "projectid bigint, projectcode string, projectdescription string, "
            "pointofcontact string, email string, doi string, projectcomment string",
            key="projectid",
            unique=(("projectcode",),),
        ),
        Table(
            "sites",
            "siteid bigint, sitecode string, sitedescription string, sitecomment string",
            key="siteid",
            unique=(("sitecode",),),
        ),
        Table(
            "plots",
            "plotid bigint, sitecode string, plotcode string, plotdescription string, "
            "latitude double, longitude double, plotcomment string",
            key="plotid",
            unique=(("plotcode",),),
            refs=(("sitecode", "sites"),),
        ),
        Table(
            "species",
            "speciesid bigint, speciescode string, speciescodetype string, scientificname string, "
            "genus string, species string, subspecies string, variety string, subvariety string, "
            "forma string, family string, authority string, tryspeciesid bigint, speciescomment string",
            key="speciesid",
            unique=(("speciescode",),),
        ),
        Table(
            "species_dict",
            "speciesdictid bigint, speciesdatacode string, projectcode string, speciescode string, "
            "speciesdictcomment string",
            key="speciesdictid",
            unique=(("speciesdatacode", "projectcode"),),
            refs=(("projectcode", "projects"), ("speciescode", "species")),
        ),
        Table(
            "samples",
            "sampleid bigint, samplecode string, projectcode string, year int, collectiondate date, "
            "plotcode string, speciescode string",
            key="sampleid",
            unique=(("samplecode",),),
            refs=(("projectcode", "projects"), ("plotcode", "plots"), ("speciescode", "species")),
            by_project=True,
        ),
        Table(
            "sample_condition_info",
            "conditionid bigint, condition string, conditiondescription string, conditioncomment string",
            key="conditionid",
            unique=(("condition",),),
        ),
        Table(
            "sample_condition",
            "conditiondataid bigint, samplecode string, condition string, conditionvalue string, "
            "conditionvaluecomment string",
            key="conditiondataid",
            refs=(("samplecode", "samples"), ("condition", "sample_condition_info")),
            by_project=True,
        ),
        Table(
            "instruments",
            "instrumentid bigint, instrumentname string, minwavelength double, maxwavelength double, "
            "spectralresolution double, instrumentcomment string",
            key="instrumentid",
            unique=(("instrumentname",),),
        ),
        Table(
            "specmethods",
            "specmethodid bigint, instrumentid bigint, apparatus string, calibration string, "
            "specmethodcomment string",
            key="specmethodid",
            refs=(("instrumentid", "instruments"),),
        ),
        Table(
            "spectra_info",
            "spectraid bigint, samplecode string, spectratype string, specmethodid bigint, "
            "sampleprep string, spectracomment string",
            key="spectraid",
            refs=(("samplecode", "samples"), ("specmethodid", "specmethods")),
            not_null=("samplecode",),
            by_project=True,
        ),
        Table(
            "spectra_data",
            "spectradataid bigint, spectraid bigint, wavelength double, spectravalue double",
            key="spectradataid",
            unique=(("spectraid", "wavelength"),),
            refs=(("spectraid", "spectra_info"),),
            not_null=("spectraid",),
            positive=("wavelength",),
            by_project=True,
        ),
        Table(
            "trait_info",
            "traitid bigint, trait string, traitdescription string, unit string, traitinfocomment string",
            key="traitid",
            unique=(("trait",),),
        ),
        Table(
            "trait_data",
            "traitdataid bigint, samplecode string, trait string, traitvalue double, traitdatacomment string",
            key="traitdataid",
            refs=(("samplecode", "samples"), ("trait", "trait_info")),
            not_null=("samplecode",),
            by_project=True,
        ),
        Table(
            "species_attributes",
            "speciescode string, growth_form string, leaf_type string, myco_asso string, phenology string, "
            "ps_type string, nitrogen_fixer boolean, shade_tolerance string, shade_tolerance_numeric double, "
            "shade_reference string, myco_reference string",
        ),
    )
}


# Link tables beside the fixed ones: what a catalog row has several of.
LINKS: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "species_try",
            "speciestryid bigint, speciescode string, tryspeciesid bigint",
            key="speciestryid",
            unique=(("speciescode", "tryspeciesid"),),
            refs=(("speciescode", "species"),),
            not_null=("speciescode", "tryspeciesid"),
        ),
    )
}

STORED = {**TABLES, **LINKS}


def children_of(parent: str) -> list[tuple[str, str]]:
    """(table, column) pairs that reference ``parent``."""
    return [(t.name, col) for t in STORED.values() for col, ref in t.refs if ref == parent]
