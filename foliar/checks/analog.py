"""Catalog-shaped views over the given test tables, in Spark and in SQL.

Each view exists twice under one name: a DataFrame and the text of a common
table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.functions.nulls import paste_na
from foliar.operators.joins import join
from foliar.operators.reshape import melt, unpack
from foliar.session import materialize

BANDS = 64
FIRST_BAND, BAND_STEP = 350, 10
PROJECTS = ("africa", "america", "asia", "europe", "middle_east")
TRAITS = ("leaf_quantity", "leaf_price", "leaf_tax")


class Views:
    """Lazy views over one data folder."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf}/{name}.parquet")
        return self._raw[name]

    def keep(self, name: str) -> None:
        """Store a view once for all the views that build on it."""
        kept = materialize(getattr(self, name)(), name, "zstd")
        setattr(self, name, lambda: kept)

    def projects(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("long").alias("projectid"),
            F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("projectcode"),
            F.col("r_name").alias("projectdescription"),
        )

    def sites(self) -> DataFrame:
        n = self.raw("nation").withColumn("projectid", F.col("n_regionkey").cast("long"))
        return join(n, self.projects().select("projectid", "projectcode"), ["projectid"], "inner", False).select(
            F.col("n_nationkey").cast("long").alias("siteid"),
            F.concat_ws(".", "projectcode", "n_name").alias("sitecode"),
            F.col("n_name").alias("sitedescription"),
            "projectcode",
        )

    def plots(self) -> DataFrame:
        c = self.raw("customer").withColumn("siteid", F.col("c_nationkey").cast("long"))
        bal = F.col("c_acctbal")
        return join(c, self.sites(), ["siteid"], "inner", False).select(
            F.col("c_custkey").alias("plotid"),
            "sitecode",
            F.concat_ws(".", "sitecode", F.col("c_custkey").cast("string")).alias("plotcode"),
            F.when(bal >= 0, bal / 100).alias("latitude"),
            F.when(bal <= 9000, -bal / 100).alias("longitude"),
            "projectcode",
        )

    def species(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("speciesid"),
            F.concat(F.lit("SP"), F.col("p_partkey").cast("string")).alias("speciescode"),
            F.col("p_name").alias("scientificname"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("genus"),
            F.split_part("p_name", F.lit(" "), F.lit(2)).alias("species"),
        )

    def attributes_of(self, part: DataFrame) -> DataFrame:
        return part.select(
            F.concat(F.lit("SP"), F.col("p_partkey").cast("string")).alias("speciescode"),
            F.col("p_type").alias("growth_form"),
            F.when(F.col("p_size") < 30, "C3").when(F.col("p_size") < 45, "C4").alias("ps_type"),
            F.split_part("p_name", F.lit(" "), F.lit(1)).alias("myco_asso"),
            F.lower("p_brand").alias("shade_tolerance"),
        )

    def species_attributes(self) -> DataFrame:
        """Attributes of the larger parts only, as its SQL has it, so reports meet species without any."""
        return self.attributes_of(self.raw("part").where("p_size >= 10"))

    def species_dict(self) -> DataFrame:
        """Brand codes by project, through the parts each project's suppliers ship."""
        supplier = self.raw("supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("siteid"))
        by_supplier = join(supplier, self.sites().select("siteid", "projectcode"), ["siteid"], "inner", False)
        shipped = self.raw("lineitem").select(
            F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")
        )
        pairs = join(shipped.distinct(), by_supplier, ["s_suppkey"], "inner", False)
        parts = join(pairs, self.raw("part").select("p_partkey", "p_brand"), ["p_partkey"], "inner", False)
        return (
            parts.groupBy(F.col("p_brand").alias("speciesdatacode"), "projectcode")
            .agg(F.min("p_partkey").alias("p"))
            .select("speciesdatacode", "projectcode", F.concat(F.lit("SP"), F.col("p").cast("string")).alias("speciescode"))
        )

    def samples(self) -> DataFrame:
        plots = self.plots().select(F.col("plotid").alias("o_custkey"), "plotcode", "projectcode")
        year = F.year("o_orderdate")
        return join(self.raw("orders"), plots, ["o_custkey"], "inner", False).select(
            F.col("o_orderkey").alias("sampleid"),
            paste_na("|", "projectcode", "o_orderkey", year).alias("samplecode"),
            "projectcode",
            year.cast("long").alias("year"),
            F.to_date("o_orderdate").alias("collectiondate"),
            "plotcode",
            F.when(
                F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit("SP"), F.col("o_custkey").cast("string"))
            ).alias("speciescode"),
        )

    def instruments(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("instrumentid"), F.col("s_name").alias("instrumentname")
        )

    def _spectraid(self) -> Column:
        flag = F.col("l_returnflag")
        code = F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)
        return F.col("l_orderkey") * 4 + code

    def _kind(self) -> Column:
        flag = F.col("l_returnflag")
        return F.when(flag == "A", "reflectance").when(flag == "N", "transmittance").otherwise("pseudo-absorbance")

    def spectra_info(self) -> DataFrame:
        s = self.samples().select(F.col("sampleid").alias("l_orderkey"), "samplecode")
        kinds = self.raw("lineitem").select("l_orderkey", "l_returnflag").distinct()
        return join(kinds, s, ["l_orderkey"], "inner", False).select(
            self._spectraid().alias("spectraid"), "samplecode", self._kind().alias("spectratype")
        )

    def spectra_points(self) -> DataFrame:
        """Catalog-sized fact: one point per line item; keys repeat on purpose."""
        return self.raw("lineitem").select(
            self._spectraid().alias("spectraid"),
            (F.col("l_linenumber") * 10 - 10).cast("double").alias("wavelength"),
            F.col("l_discount").alias("spectravalue"),
        )

    def spectra_packed(self) -> DataFrame:
        """One spectrum per vector, with its label."""
        return self.raw("embeddings").select(
            F.col("vec_id").alias("spectraid"),
            "label",
            F.transform("embedding", lambda v, i: (F.lit(FIRST_BAND) + i * BAND_STEP).cast("double")).alias("wavelengths"),
            F.transform("embedding", lambda v: v.cast("double")).alias("spectravalues"),
        )

    def spectra_data(self) -> DataFrame:
        """Long spectra from the vectors."""
        return unpack(self.spectra_packed(), ["spectraid"])

    def spectra_wide(self) -> DataFrame:
        bands = [
            F.get("embedding", F.lit(i)).cast("double").alias(f"Wave_{FIRST_BAND + BAND_STEP * i}") for i in range(BANDS)
        ]
        return self.raw("embeddings").select(F.col("vec_id").alias("spectraid"), "label", *bands)

    def trait_wide(self) -> DataFrame:
        agg = (
            self.raw("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.sum("l_quantity").alias("leaf_quantity"),
                F.round(F.sum("l_extendedprice"), 2).alias("leaf_price"),
                F.round(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_tax"))), 6).alias("leaf_tax"),
            )
        )
        s = self.samples().select(F.col("sampleid").alias("l_orderkey"), "samplecode", "projectcode")
        return join(agg, s, ["l_orderkey"], "inner", False).select("samplecode", "projectcode", *TRAITS)

    def trait_data(self) -> DataFrame:
        return melt(self.trait_wide(), ["samplecode"], TRAITS, "trait", "traitvalue", drop_null=True)

    def trait_info(self) -> DataFrame:
        return self.trait_data().select("trait").distinct()

    def conditions(self) -> DataFrame:
        rows = (
            self.raw("lineitem")
            .select(
                "l_orderkey",
                "l_linestatus",
                F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("l_returnflag"),
            )
            .distinct()
        )
        return melt(rows, ["l_orderkey"], ["l_linestatus", "l_returnflag"], "condition", "conditionvalue", drop_null=False)

    def catalog(self, *names: str) -> dict[str, DataFrame]:
        """The named catalog tables, or all of them."""
        tables = {
            "projects": self.projects,
            "sites": lambda: self.sites().drop("projectcode"),
            "plots": lambda: self.plots().drop("projectcode"),
            "species": self.species,
            "species_dict": self.species_dict,
            "species_attributes": self.species_attributes,
            "samples": self.samples,
            "instruments": self.instruments,
            "spectra_info": self.spectra_info,
            "spectra_data": self.spectra_points,
            "trait_info": self.trait_info,
            "trait_data": self.trait_data,
        }
        return {name: tables[name]() for name in names or tables}


_SPECTRAID = "l_orderkey * 4 + case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end"

# name -> (views it needs, body)
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "projects": (
        (),
        "select cast(r_regionkey as bigint) projectid, lower(replace(r_name, ' ', '_')) projectcode, "
        "r_name projectdescription from region",
    ),
    "sites": (
        ("projects",),
        "select cast(n_nationkey as bigint) siteid, projectcode || '.' || n_name sitecode, n_name sitedescription, "
        "projectcode from nation join projects on projectid = n_regionkey",
    ),
    "plots": (
        ("sites",),
        "select c_custkey plotid, sitecode, sitecode || '.' || c_custkey plotcode, "
        "case when c_acctbal >= 0 then c_acctbal / 100 end latitude, "
        "case when c_acctbal <= 9000 then -c_acctbal / 100 end longitude, projectcode "
        "from customer join sites on siteid = c_nationkey",
    ),
    "species": (
        (),
        "select p_partkey speciesid, 'SP' || p_partkey speciescode, p_name scientificname, "
        "split_part(p_name, ' ', 1) genus, split_part(p_name, ' ', 2) species from part",
    ),
    "species_attributes": (
        (),
        "select 'SP' || p_partkey speciescode, p_type growth_form, "
        "case when p_size < 30 then 'C3' when p_size < 45 then 'C4' end ps_type, "
        "split_part(p_name, ' ', 1) myco_asso, lower(p_brand) shade_tolerance from part where p_size >= 10",
    ),
    "species_dict": (
        ("sites",),
        "select p_brand speciesdatacode, projectcode, 'SP' || min(p_partkey) speciescode "
        "from lineitem join supplier on s_suppkey = l_suppkey join sites on siteid = s_nationkey "
        "join part on p_partkey = l_partkey group by p_brand, projectcode",
    ),
    "samples": (
        ("plots",),
        "select o_orderkey sampleid, projectcode || '|' || o_orderkey || '|' || year(o_orderdate) samplecode, "
        "projectcode, cast(year(o_orderdate) as bigint) as year, cast(o_orderdate as date) collectiondate, plotcode, "
        "case when o_orderpriority <> '4-NOT SPECIFIED' then 'SP' || o_custkey end speciescode "
        "from orders join plots on plotid = o_custkey",
    ),
    "spectra_info": (
        ("samples",),
        f"select distinct {_SPECTRAID} spectraid, samplecode, case l_returnflag when 'A' then 'reflectance' "
        "when 'N' then 'transmittance' else 'pseudo-absorbance' end spectratype "
        "from lineitem join samples on sampleid = l_orderkey",
    ),
    "spectra_points": (
        (),
        f"select {_SPECTRAID} spectraid, cast(l_linenumber * 10 - 10 as double) wavelength, "
        "l_discount spectravalue from lineitem",
    ),
    "spectra_data": (
        (),
        "select vec_id spectraid, cast(350 + 10 * (i - 1) as double) wavelength, "
        "cast(embedding[i] as double) spectravalue "
        "from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) i from embeddings)",
    ),
    "trait_wide": (
        ("samples",),
        "select samplecode, projectcode, leaf_quantity, leaf_price, leaf_tax from (select l_orderkey, "
        "sum(l_quantity) leaf_quantity, round(sum(l_extendedprice), 2) leaf_price, "
        "round(sum(case when l_returnflag = 'R' then l_tax end), 6) leaf_tax from lineitem group by l_orderkey) "
        "join samples on sampleid = l_orderkey",
    ),
    "trait_data": (
        ("trait_wide",),
        "select samplecode, 'leaf_quantity' trait, leaf_quantity traitvalue from trait_wide "
        "where leaf_quantity is not null union all select samplecode, 'leaf_price', leaf_price from trait_wide "
        "where leaf_price is not null union all select samplecode, 'leaf_tax', leaf_tax from trait_wide "
        "where leaf_tax is not null",
    ),
    "conditions": (
        (),
        "select l_orderkey, 'l_linestatus' as condition, l_linestatus conditionvalue from (select distinct l_orderkey, "
        "l_linestatus, case when l_tax > 0 then l_returnflag end l_returnflag from lineitem) union all "
        "select l_orderkey, 'l_returnflag', l_returnflag from (select distinct l_orderkey, l_linestatus, "
        "case when l_tax > 0 then l_returnflag end l_returnflag from lineitem)",
    ),
}


def with_views(query: str, *names: str) -> str:
    """Prefix ``query`` with the named views and those they build on."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in SQL[name][0]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    ctes = ",\n".join(f"{n} as ({SQL[n][1]})" for n in ordered)
    if not ctes:
        return query
    rest = query.removeprefix("with ").removeprefix(", ")
    return f"with {ctes}" + (f"\n{query}" if rest == query else f",\n{rest}")
