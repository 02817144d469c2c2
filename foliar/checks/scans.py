"""Sources: files are written from the given tables to a fresh folder, then scanned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.checks.analog import Views
from foliar.checks.registry import check
from foliar.functions.nulls import extract
from foliar.operators.aggregate import count_sorted
from foliar.operators.columns import drop_unnamed
from foliar.operators.joins import join
from foliar.operators.ordered import row_number_in_group
from foliar.session import scratch_path, small_table
from foliar.sources.catalog import Catalog
from foliar.sources.files import read_csv, read_delimited, read_tree, with_file
from foliar.sources.layouts import bind_columns, ranked, sectioned


@check(
    "select c_custkey, c_name, cast(c_nationkey as bigint) c_nationkey, "
    "case when c_acctbal >= 0 then c_acctbal end c_acctbal, c_mktsegment from customer"
)
def scan_csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "csv")
    rows = v.raw("customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    rows.write.option("header", True).option("nullValue", "NA").csv(path)
    return read_csv(
        v.spark, path, "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string"
    )


@check(
    "select cast(l_orderkey as double) l_orderkey, cast(l_linenumber as double) l_linenumber, l_quantity, "
    "case when l_returnflag <> 'N' then l_discount end l_discount from lineitem"
)
def scan_delimited_text(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "text")
    discount = F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_discount").cast("string"))
    line = F.concat_ws("\t", "l_orderkey", "l_linenumber", F.concat(F.lit("  "), F.col("l_quantity")), discount)
    v.raw("lineitem").select(line.alias("value")).write.text(path)
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"]
    return read_delimited(v.spark, path, names).select(*names)


@check("select c_custkey, c_acctbal, c_mktsegment source_name from customer")
def multi_file_scan(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "files")
    v.raw("customer").select("c_custkey", "c_acctbal", "c_mktsegment").write.partitionBy("c_mktsegment").csv(path)
    scan = read_csv(v.spark, path, "c_custkey bigint, c_acctbal double", header=False, pattern="*.csv", recursive=True)
    return with_file(scan, "path", full=True).select(
        "c_custkey", "c_acctbal", extract("path", "c_mktsegment=([A-Z]+)", 1).alias("source_name")
    )


@check("select o_orderkey, o_totalprice, o_orderstatus folder from orders where o_orderstatus <> 'P'")
def recursive_scan_exclude(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "tree")
    v.raw("orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").csv(path)
    schema = "o_orderkey bigint, o_totalprice double"
    scan = read_tree(v.spark, path, "part-*.csv", schema, exclude="(?i)orderstatus=p", header=False)
    return scan.select("o_orderkey", "o_totalprice", extract("file_path", "orderstatus=([A-Z])", 1).alias("folder"))


@check("select samplecode, projectcode, year, speciescode from samples", "samples")
def catalog_scan(v: Views) -> DataFrame:
    catalog = Catalog(v.spark, scratch_path(v.spark, "catalog"))
    catalog.replace("samples", v.samples())
    return catalog.table("samples").select("samplecode", "projectcode", F.col("year").cast("long").alias("year"), "speciescode")


@check(
    "select habitat, count(*) n from customer join (values ('BUILDING', 'urban'), ('MACHINERY', 'urban'), "
    "('FURNITURE', 'forest'), ('HOUSEHOLD', 'garden'), ('AUTOMOBILE', 'road')) t(c_mktsegment, habitat) using (c_mktsegment) group by habitat"
)
def inline_table_join(v: Views) -> DataFrame:
    rows = [("BUILDING", "urban"), ("MACHINERY", "urban"), ("FURNITURE", "forest"), ("HOUSEHOLD", "garden"), ("AUTOMOBILE", "road")]
    table = small_table(v.spark, "c_mktsegment string, habitat string", rows)
    return count_sorted(join(v.raw("customer"), table, ["c_mktsegment"], "inner"), "habitat")


@check("select p_partkey, p_name from part")
def select_named_columns(v: Views) -> DataFrame:
    sheet = v.raw("part").select("p_partkey", "p_name", F.col("p_size").alias("_c2"), F.col("p_type").alias(" "))
    return drop_unnamed(sheet)


@check(
    "select cast(n_regionkey as bigint) region, n_name info, cast(c_custkey as double) custkey, c_acctbal acctbal "
    "from customer join nation on n_nationkey = c_nationkey"
)
def sectioned_file(v: Views) -> DataFrame:
    nation = v.raw("nation").select(
        F.col("n_regionkey").cast("long").alias("region"), F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    head = nation.select(
        "region", F.col("c_nationkey").alias("a"), F.lit(0).alias("b"), F.lit(0).cast("long").alias("c"),
        F.concat_ws(" ", "n_name", "n_name").alias("value"),
    )
    body = join(v.raw("customer"), nation, ["c_nationkey"], "inner").select(
        "region", F.col("c_nationkey").alias("a"), F.lit(1).alias("b"), F.col("c_custkey").alias("c"),
        F.concat_ws(" ", "c_custkey", "c_acctbal").alias("value"),
    )
    out = sectioned(head.unionByName(body), ["custkey", "acctbal"], ["region"], ["a", "b", "c"])
    return out.select("region", "info", "custkey", "acctbal")


@check(
    "with files as (select floor(label / 2) f, vec_id, embedding, row_number() over (partition by floor(label / 2) order by vec_id) rn "
    "from embeddings), wide as (select max(len(embedding)) w from embeddings), "
    "fr as (select f, row_number() over (order by f) r from (select distinct f from files)), "
    "dr as (select d, n, row_number() over (order by d) r from (select c_mktsegment d, count(*) n from customer group by 1)), "
    "placed as (select d, vec_id + 1 wavelength, embedding, rn % ((n - 1) // w + 1) b from files join fr using (f) join dr using (r), wide), "
    "cells as (select d, b, wavelength, i, cast(embedding[i] as double) val from (select *, unnest(range(1, len(embedding) + 1)) i from placed)), "
    "listed as (select c_custkey, c_mktsegment d, row_number() over (partition by c_mktsegment order by c_custkey) - 1 k from customer), "
    "cols as (select c_custkey, d, k // w b, k % w + 1 i from listed, wide) "
    "select c_custkey, count(*) n_points, cast(sum(wavelength) as double) wl_sum, round(sum(val), 4) value_sum "
    "from cells join cols using (d, b, i) group by c_custkey"
)
def positional_header_join(v: Views) -> DataFrame:
    # Days of as many customers as an embedding has values; a segment's vectors are dealt to its days, so each customer
    # has a column of one matrix and each vector is a line of one.
    vectors = v.raw("embeddings").withColumn("f", F.floor(F.col("label") / 2))
    wide = vectors.agg(F.max(F.size("embedding"))).first()[0]
    listed = row_number_in_group(v.raw("customer").select("c_mktsegment", "c_custkey"), ["c_mktsegment"], ["c_custkey"], "k")
    listed = listed.withColumn("block", F.floor((F.col("k") - 1) / wide))
    sizes = listed.groupBy("c_mktsegment", "block").agg(F.count(F.lit(1)).cast("int").alias("n"))
    segments = sizes.groupBy("c_mktsegment").agg(F.max("block").alias("last"))
    segments = join(ranked(segments, "c_mktsegment", "r"), segments, ["c_mktsegment"], "inner")
    dealt = row_number_in_group(vectors.select("f", "vec_id"), ["f"], ["vec_id"], "rn")
    dealt = join(join(dealt, ranked(vectors, "f", "r"), ["f"], "inner"), segments, ["r"], "inner")
    dealt = dealt.withColumn("block", F.col("rn") % (F.col("last") + 1)).select("vec_id", "f", "c_mktsegment", "block")
    placed = join(join(dealt, sizes, ["c_mktsegment", "block"], "inner"), vectors.select("vec_id", "embedding"), ["vec_id"], "inner")
    cells = F.transform(F.slice("embedding", 1, F.col("n")), lambda x: x.cast("double").cast("string"))
    number = F.lpad(F.col("block").cast("string"), 9, "0")
    file = F.concat(F.lit("matrix_"), F.col("f").cast("string"), F.lit("_"), number, F.lit(".csv")).alias("file")
    lines = placed.select(file, F.concat_ws(",", (F.col("vec_id") + 1).cast("string"), F.array_join(cells, ",")).alias("value"))
    samples = listed.select(F.concat_ws("_", "c_mktsegment", number).alias("day"), "c_custkey")
    long = bind_columns(lines, samples, "day", "c_custkey", ["c_custkey"])
    return long.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sum("wavelength").alias("wl_sum"),
        F.round(F.sum("spectravalue"), 4).alias("value_sum"),
    )
