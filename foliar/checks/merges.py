"""Merges, surrogate ids, replace, reset and cascading delete."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.checks.analog import Views
from foliar.checks.registry import check
from foliar.operators.merge import Tee, absent_rows, assign_ids, insert_if_absent, tee, with_ids
from foliar.operators.ordered import row_number_global
from foliar.operators.reshape import unpack
from foliar.schema import TABLES
from foliar.session import materialize, scratch_path, side_by_side, small_table
from foliar.sources.catalog import Catalog

_MERGED = (
    "with t as (select o_orderkey + 1 orderid, o_orderkey, o_totalprice from orders where o_orderstatus <> 'P'), "
    "new as (select (select max(orderid) from t) + row_number() over (order by o_orderkey) orderid, o_orderkey, "
    "2 * o_totalprice o_totalprice from orders where o_orderkey not in (select o_orderkey from t)), "
    "merged as (select * from t union all select * from new) "
)


def _order_merge(v: Views):
    orders = v.raw("orders")
    target = orders.where("o_orderstatus <> 'P'").select(
        (F.col("o_orderkey") + 1).alias("orderid"), "o_orderkey", "o_totalprice"
    )
    batch = orders.select("o_orderkey", (2 * F.col("o_totalprice")).alias("o_totalprice"), "o_orderpriority")
    return batch, insert_if_absent(target, batch, ["o_orderkey"], "orderid", "error", order=["o_orderkey"])


@check(_MERGED + "select orderid, o_orderkey, o_totalprice from merged")
def merge_insert_if_absent(v: Views) -> DataFrame:
    return _order_merge(v)[1].table


@check(_MERGED + "select o.o_orderkey, o_orderpriority, orderid from orders o join merged m using (o_orderkey)")
def merge_return_ids(v: Views) -> DataFrame:
    batch, merged = _order_merge(v)
    return with_ids(batch, merged.table, ["o_orderkey"], "orderid").select("o_orderkey", "o_orderpriority", "orderid")


@check(
    "with k as (select distinct o_custkey, nullif(o_orderpriority, '5-LOW') calibration, "
    "o_orderstatus = 'F' present from orders), "
    "t0 as (select distinct o_custkey, calibration from k where present), "
    "t as (select row_number() over (order by o_custkey, calibration nulls first) methodid, * from t0), "
    "b as (select distinct o_custkey, calibration from k), "
    "new as (select (select max(methodid) from t) + row_number() over (order by o_custkey, calibration nulls first) "
    "methodid, o_custkey, calibration from b where not exists (select 1 from t where t.o_custkey = b.o_custkey and "
    "t.calibration is not distinct from b.calibration)) select * from t union all select * from new"
)
def merge_composite_key(v: Views) -> DataFrame:
    keys = v.raw("orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("calibration"), "o_orderstatus"
    )
    by = ["o_custkey", "calibration"]
    target = assign_ids(keys.where("o_orderstatus = 'F'").select(*by).distinct(), by, "methodid")
    merged = insert_if_absent(target.select("methodid", *by), keys.select(*by).distinct(), by, "methodid", "error", order=by)
    return merged.table


_APPENDED = (
    "with lab as (select vec_id spectraid, label from embeddings), "
    "t as (select s.* from spectra_data s join lab using (spectraid) where label < 5 and wavelength < 600) "
    "select * from t union all select spectraid, wavelength, spectravalue + 1 from spectra_data "
    "where spectraid not in (select spectraid from t)"
)


def _batches(packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spectra of the lower labels cut short, and all of them with other values."""
    short = F.filter("wavelengths", lambda w: w < 600)
    low = packed.where("label < 5").withColumn("wavelengths", short).withColumn("spectravalues", F.slice("spectravalues", 1, F.size(short)))
    return low, packed.withColumn("spectravalues", F.transform("spectravalues", lambda x: x + 1))


@check(_APPENDED, "spectra_data")
def append_spectra(v: Views) -> DataFrame:
    """Decided on one row per spectrum; the points are unpacked last."""
    target, batch = _batches(v.spectra_packed())
    return unpack(target.unionByName(absent_rows(target, batch, ["spectraid"])), ["spectraid"])


@check(_APPENDED, "spectra_data")
def append_spectra_to_catalog(v: Views) -> DataFrame:
    catalog = Catalog(v.spark, scratch_path(v.spark, "catalog"))
    # The vector's number is the sample's name, so it can be told from the id that the catalog gives.
    named = v.spectra_packed().select(
        F.concat(F.lit("vectors|"), "spectraid").alias("samplecode"), F.lit("reflectance").alias("spectratype"),
        *[F.lit(None).cast("string").alias(c) for c in ("sampleprep", "spectracomment")],
        "label", "wavelengths", "spectravalues",
    )
    for batch in _batches(named):
        catalog.add_packed(batch, batch.drop("label", "wavelengths", "spectravalues"))
    owner = catalog.table("spectra_info").select("spectraid", F.split_part("samplecode", F.lit("|"), F.lit(2)).cast("long").alias("vector"))
    points = catalog.table("spectra_data").join(owner, "spectraid")
    return points.select(F.col("vector").alias("spectraid"), "wavelength", "spectravalue")


@check(
    "select t.samplecode, trait, case when o_orderstatus = 'F' then traitvalue else 2 * traitvalue end traitvalue "
    "from trait_data t join samples using (samplecode) join orders on o_orderkey = sampleid",
    "trait_data",
)
def merge_facts(v: Views) -> DataFrame:
    """Finished orders first, then all with other values: a merge adds absent (sample, trait) rows, project by project."""
    catalog = Catalog(v.spark, scratch_path(v.spark, "catalog"))
    status = v.samples().join(v.raw("orders").select(F.col("o_orderkey").alias("sampleid"), "o_orderstatus"), "sampleid").select("samplecode", "o_orderstatus")
    traits = v.trait_data().join(status, "samplecode")
    by = ["samplecode", "trait"]
    catalog.add("trait_data", traits.where("o_orderstatus = 'F'").drop("o_orderstatus"), by)
    catalog.add("trait_data", traits.drop("o_orderstatus").withColumn("traitvalue", 2 * F.col("traitvalue")), by)
    return catalog.table("trait_data").select("samplecode", "trait", "traitvalue")


@check("select speciescode, upper(scientificname) scientificname from species", "species")
def replace_table(v: Views) -> DataFrame:
    catalog = Catalog(v.spark, scratch_path(v.spark, "catalog"))
    catalog.replace("species", v.species())
    catalog.replace("species", catalog.table("species").withColumn("scientificname", F.upper("scientificname")))
    return catalog.table("species").select("speciescode", "scientificname")


_CASCADE = ("projects", "species_dict", "samples", "spectra_info", "spectra_data", "trait_data")
_ANALOG_COUNTS = {
    "projects": "projects", "sites": "sites", "plots": "plots", "species": "species", "species_dict": "species_dict",
    "species_attributes": "species_attributes", "samples": "samples", "instruments": "supplier",
    "spectra_info": "spectra_info", "spectra_data": "lineitem",
    "trait_info": "(select distinct trait from trait_data)", "trait_data": "trait_data",
}


@check(
    " union all ".join(
        f"select '{name}' table_name, {len(t.columns)} n_columns, "
        + (f"count(*) rows_before, 0 rows_after from {_ANALOG_COUNTS[name]}" if name in _ANALOG_COUNTS else "0, 0")
        for name, t in TABLES.items()
    ),
    "species", "species_dict", "species_attributes", "spectra_info", "trait_data",
)
def empty_catalog_schema(v: Views) -> DataFrame:
    catalog = Catalog(v.spark, scratch_path(v.spark, "catalog"))
    tables = v.catalog()
    points = tables.pop("spectra_data")
    side_by_side(*[partial(catalog.replace, name, df) for name, df in tables.items()])
    catalog.replace("spectra_data", points)  # after its spectra, whose projects it takes

    def count(df: DataFrame, name: str, column: str) -> DataFrame:
        n = df.agg(F.count(F.lit(1)).alias("n"))
        return n.select(F.lit(name).alias("table_name"), F.lit(column).alias("phase"), "n")

    def counts(phase: str) -> DataFrame:
        one = [count(df, name, phase) for name, df in catalog.tables().items()]
        return materialize(reduce(lambda a, b: a.unionByName(b), one), "counts")

    before = counts("before")
    catalog.reset()
    columns = small_table(v.spark, "table_name string, n_columns int", [(n, len(catalog.table(n).columns)) for n in TABLES])
    by_table = before.unionByName(counts("after")).groupBy("table_name").agg(
        F.sum(F.when(F.col("phase") == "before", F.col("n"))).alias("rows_before"),
        F.sum(F.when(F.col("phase") == "after", F.col("n"))).alias("rows_after").cast("int"),
    )
    return by_table.join(F.broadcast(columns), "table_name").select("table_name", "n_columns", "rows_before", "rows_after")


@check("select o_custkey, row_number() over (order by o_custkey) id from (select distinct o_custkey from orders)")
def assign_surrogate_ids(v: Views) -> DataFrame:
    return assign_ids(v.raw("orders").select("o_custkey").distinct(), ["o_custkey"], "id")


@check(
    "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) specnum from orders",
    name="row_number_global",
)
def row_number_global_check(v: Views) -> DataFrame:
    rows = v.raw("orders").select("o_orderkey", "o_orderdate")
    return row_number_global(rows, ["o_orderdate", "o_orderkey"], "specnum").select("o_orderkey", "specnum")


@check(
    "with gone as (select * from samples where projectcode = 'asia'), "
    "gspec as (select spectraid from spectra_info where samplecode in (select samplecode from gone)) "
    "select 'projects' table_name, cast(count_if(projectcode <> 'asia') as bigint) n_left, cast(count_if(projectcode = 'asia') as bigint) n_removed "
    "from projects union all "
    "select 'species_dict', cast(count_if(projectcode <> 'asia') as bigint), cast(count_if(projectcode = 'asia') as bigint) from species_dict union all "
    "select 'samples', cast(count_if(projectcode <> 'asia') as bigint), cast(count_if(projectcode = 'asia') as bigint) from samples union all "
    "select 'spectra_info', cast(count_if(samplecode not in (select samplecode from gone)) as bigint), "
    "cast(count_if(samplecode in (select samplecode from gone)) as bigint) from spectra_info union all "
    "select 'spectra_data', cast(count_if(spectraid not in (select spectraid from gspec)) as bigint), "
    "cast(count_if(spectraid in (select spectraid from gspec)) as bigint) from spectra_points union all "
    "select 'trait_data', cast(count_if(samplecode not in (select samplecode from gone)) as bigint), "
    "cast(count_if(samplecode in (select samplecode from gone)) as bigint) from trait_data",
    "species_dict", "spectra_info", "spectra_points", "trait_data", name="cascade_delete",
)
def cascade_delete_check(v: Views) -> DataFrame:
    catalog = Catalog(v.spark, scratch_path(v.spark, "catalog"))
    tables = v.catalog(*_CASCADE)
    points = tables.pop("spectra_data")
    side_by_side(*[partial(catalog.replace, name, df) for name, df in tables.items()])
    catalog.replace("spectra_data", points)  # after its spectra, whose projects it takes

    def counts(phase: str) -> DataFrame:
        one = [catalog.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), F.lit(phase).alias("phase"), "n") for n in _CASCADE]
        return materialize(reduce(lambda x, y: x.unionByName(y), one), "counts")

    before = counts("before")
    catalog.delete("projects", F.col("projectcode") == "asia")
    both = before.unionByName(counts("after")).groupBy("table_name").pivot("phase", ["before", "after"]).agg(F.first("n"))
    return both.select("table_name", F.col("after").alias("n_left"), (F.col("before") - F.col("after")).alias("n_removed"))


def _tee_customers(v: Views) -> Tee:
    def pairs(df: DataFrame) -> DataFrame:
        return df.select("c_mktsegment", F.col("c_nationkey").cast("long").alias("c_nationkey")).distinct()

    return tee(v.raw("customer"), pairs, scratch_path(v.spark, "side"))


@check("select distinct c_mktsegment, cast(c_nationkey as bigint) c_nationkey from customer")
def tee_distinct(v: Views) -> DataFrame:
    return _tee_customers(v).side


@check(
    "with side as (select distinct c_mktsegment, c_nationkey from customer) "
    "select 'main' output, c_mktsegment, count(*) n, (select count(*) from customer) n_output from customer group by 2 union all "
    "select 'side', c_mktsegment, count(*), (select count(*) from side) from side group by 2"
)
def tee_outputs(v: Views) -> DataFrame:
    """Both outputs by segment, with the counts taken on the way."""
    t = _tee_customers(v)
    parts = [(t.main, "main", t.n_main), (t.side, "side", t.n_side)]
    shown = [df.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("output"), "c_mktsegment", "n", F.lit(n).cast("long").alias("n_output")) for df, name, n in parts]
    return shown[0].unionByName(shown[1])
