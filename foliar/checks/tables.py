"""Columns, filters, joins, aggregates, order-dependent operators and reshapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.checks.analog import BANDS, TRAITS, Views
from foliar.checks.registry import check
from foliar.functions.nulls import strict_mean, update_where
from foliar.operators import aggregate, columns, filters, joins, ordered, reshape
from foliar.plans.reference_data import match_rate, match_species


# --- columns --------------------------------------------------------------------
@check("select o_orderkey samplename, o_custkey plot, o_totalprice traitvalue, 2014 as year from orders")
def select_rename(v: Views) -> DataFrame:
    return v.raw("orders").select(
        F.col("o_orderkey").alias("samplename"),
        F.col("o_custkey").alias("plot"),
        F.col("o_totalprice").alias("traitvalue"),
        F.lit(2014).alias("year"),
    )


@check("select p_partkey speciesid, p_name speciesdatacode, p_brand family, p_size from part")
def dict_rename(v: Views) -> DataFrame:
    df = v.raw("part").select("p_partkey", "p_name", "p_brand", "p_size")
    names = {"p_partkey": "speciesid", "p_name": "speciesdatacode", "p_brand": "family", "absent": "ignored"}
    return columns.rename(df, names)


@check("select samplecode, leaf_quantity, leaf_price, leaf_tax from trait_wide", "trait_wide")
def select_prefix(v: Views) -> DataFrame:
    return columns.select_prefix(v.trait_wide(), ["samplecode"], "leaf_")


@check("select vec_id id, cast(embedding[1] as double) \"350\", cast(embedding[64] as double) \"980\" from embeddings")
def select_regex(v: Views) -> DataFrame:
    wide = v.raw("embeddings").select(
        F.col("vec_id").alias("id"),
        F.get("embedding", F.lit(0)).cast("double").alias("350"),
        F.get("embedding", F.lit(BANDS - 1)).cast("double").alias("980"),
        "label",
    )
    return columns.select_pattern(wide, ["id"], r"^\d+$")


@check("select c_custkey, c_name, c_mktsegment from customer")
def drop_columns(v: Views) -> DataFrame:
    return v.raw("customer").drop("c_nationkey", "c_acctbal")


@check("select samplecode, projectcode, plotcode, speciescode from samples", "samples")
def canonical_columns(v: Views) -> DataFrame:
    known = ["samplecode", "absent", "projectcode", "plotcode", "speciescode"]
    return columns.canonical(v.samples().select("speciescode", "plotcode", "samplecode", "projectcode", "year"), known)


@check(
    "select p_partkey * 2 p_partkey, p_name, p_size * 2 p_size, p_retailprice * 2 p_retailprice from part"
)
def map_numeric_columns(v: Views) -> DataFrame:
    df = v.raw("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return columns.map_numeric(df, lambda c: c * 2)


@check(
    "select o_orderkey, case when o_orderpriority = '5-LOW' then 'SaplingACMA3' "
    "when o_orderstatus = 'F' then 'SaplingPSME' else nullif(o_orderstatus, 'P') end site_id from orders"
)
def conditional_update(v: Views) -> DataFrame:
    df = v.raw("orders").withColumn("site_id", F.nullif("o_orderstatus", F.lit("P")))
    df = df.withColumn("site_id", update_where("site_id", F.col("site_id") == "F", "SaplingPSME"))
    df = df.withColumn("site_id", update_where("site_id", F.col("o_orderpriority") == "5-LOW", "SaplingACMA3"))
    return df.select("o_orderkey", "site_id")


# --- filters ----------------------------------------------------------------------
@check("select spectraid, wavelength, spectravalue from spectra_data where spectravalue > -0.05", "spectra_data")
def filter_threshold(v: Views) -> DataFrame:
    return v.spectra_data().where("spectravalue > -0.05")


@check("select plotcode, latitude, longitude from plots where latitude is null or longitude is null", "plots")
def filter_nulls(v: Views) -> DataFrame:
    plots = v.plots().select("plotcode", "latitude", "longitude")
    return plots.where(F.col("latitude").isNull() | F.col("longitude").isNull())


@check(
    "select o_orderkey, spectra, site from (select o_orderkey, nullif(o_orderpriority, '1-URGENT') spectra, "
    "nullif(o_orderstatus, 'P') site from orders) where not (spectra = '5-LOW' and site = 'F')"
)
def filter_not_and(v: Views) -> DataFrame:
    df = v.raw("orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("spectra"),
        F.nullif("o_orderstatus", F.lit("P")).alias("site"),
    )
    return filters.exclude_pair(df, spectra="5-LOW", site="F")


@check(
    "select o_orderkey, nullif(o_orderstatus, 'P') status from orders where o_orderstatus <> 'F'"
)
def filter_not_in(v: Views) -> DataFrame:
    df = v.raw("orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return filters.exclude(df, "status", ["F", "X"])


@check("select p_partkey, p_name from part where not regexp_matches(lower(p_name), '(ring|bolt|red|soil)')")
def filter_regex_exclude(v: Views) -> DataFrame:
    return filters.leaf_only(v.raw("part").select("p_partkey", "p_name"), "p_name", "(?i)(RING|Bolt|red|soil)")


@check(
    "select p_partkey, case when p_type like 'ECON%' then 'dry' when p_type like '%AL%' then 'fresh' "
    "when regexp_matches(p_type, 'M$') then 'powder' end prep from part"
)
def classify_by_pattern(v: Views) -> DataFrame:
    rules = [("^ECON", "dry"), ("AL", "fresh"), ("M$", "powder")]
    return v.raw("part").select("p_partkey", filters.route("p_type", rules).alias("prep"))


@check("select event_id, event_type from events where event_type <> 'error'")
def filter_empty_string(v: Views) -> DataFrame:
    comment = F.when(F.col("event_type") == "error", F.col("props")).otherwise("")
    return filters.uncommented(v.raw("events").withColumn("comments", comment), "comments").select("event_id", "event_type")


@check(
    "select spectraid, wavelength, spectravalue from spectra_data where wavelength in (350, 500, 980) or wavelength in "
    "(select distinct cast(400 + 10 * l_linenumber as double) from lineitem)",
    "spectra_data",
)
def wavelength_lookup(v: Views) -> DataFrame:
    spectra = v.spectra_data()
    wanted = v.raw("lineitem").select((F.lit(400) + 10 * F.col("l_linenumber")).cast("double").alias("wavelength"))
    listed = reshape.wavelength_lookup(spectra, [350.0, 500.0, 980.0])
    rest = spectra.where(~F.col("wavelength").isin(350.0, 500.0, 980.0))
    return listed.unionByName(reshape.wavelength_lookup(rest, wanted.distinct()))


# --- joins --------------------------------------------------------------------------
@check(
    "select samplecode, s.projectcode, latitude, longitude, sitecode from samples s left join plots p "
    "on s.plotcode = p.plotcode",
    "samples",
)
def left_join_dim(v: Views) -> DataFrame:
    s = v.samples().select("samplecode", "projectcode", "plotcode")
    plots = v.plots().select("plotcode", "latitude", "longitude", "sitecode")
    return joins.join(s, plots, how="left").drop("plotcode")


@check(
    "select samplecode, projectcode, spectraid, spectratype from samples join spectra_info using (samplecode)",
    "spectra_info",
)
def inner_join_samples_spectra(v: Views) -> DataFrame:
    return joins.join(v.samples().select("samplecode", "projectcode"), v.spectra_info(), how="inner")


@check(
    "with a as (select case when c_nationkey < 15 then nullif(c_nationkey, 0) else 100 + c_nationkey end k, count(*) n_cust "
    "from customer group by 1), b as (select case when s_nationkey between 5 and 12 then 200 + s_nationkey else "
    "nullif(s_nationkey, 0) end k, count(*) n_supp from supplier group by 1) select coalesce(a.k, b.k) k, n_cust, n_supp from a full join b on a.k is not distinct from b.k"
)
def full_outer_natural(v: Views) -> DataFrame:
    # Keys of one side only: some nations have other numbers on each side.
    c, s = F.col("c_nationkey"), F.col("s_nationkey")
    a = v.raw("customer").select(F.when(c < 15, F.nullif(c, F.lit(0))).otherwise(100 + c).alias("k"))
    b = v.raw("supplier").select(F.when(s.between(5, 12), 200 + s).otherwise(F.nullif(s, F.lit(0))).alias("k"))
    left = a.groupBy("k").agg(F.count(F.lit(1)).alias("n_cust"))
    right = b.groupBy("k").agg(F.count(F.lit(1)).alias("n_supp"))
    return joins.join(left, right, how="full")


@check(
    "with a as (select case when o_orderstatus = 'F' then o_custkey else o_custkey + 1000000000 end k, count(*) n_f from orders group by 1), "
    "b as (select case when o_orderpriority = '1-URGENT' then o_custkey else o_custkey + 2000000000 end k, max(o_totalprice) max_p "
    "from orders group by 1), c as (select case when o_orderstatus = 'O' then o_custkey else o_custkey + 3000000000 end k, "
    "min(o_totalprice) min_o from orders group by 1), "
    "d as (select case when c_acctbal < 0 then c_custkey else c_custkey + 4000000000 end k, c_acctbal bal from customer) "
    "select coalesce(a.k, b.k, c.k, d.k) k, n_f, max_p, min_o, bal from a full join b on a.k = b.k "
    "full join c on c.k = coalesce(a.k, b.k) full join d on d.k = coalesce(a.k, b.k, c.k)"
)
def multiway_full_join(v: Views) -> DataFrame:
    o = v.raw("orders")

    def key(shared, name: str, side: int):
        """Rows that are not shared have keys of their side only."""
        return F.when(shared, F.col(name)).otherwise(F.col(name) + F.lit(side * 1_000_000_000)).alias("k")

    a = o.groupBy(key(F.col("o_orderstatus") == "F", "o_custkey", 1)).agg(F.count(F.lit(1)).alias("n_f"))
    b = o.groupBy(key(F.col("o_orderpriority") == "1-URGENT", "o_custkey", 2)).agg(F.max("o_totalprice").alias("max_p"))
    c = o.groupBy(key(F.col("o_orderstatus") == "O", "o_custkey", 3)).agg(F.min("o_totalprice").alias("min_o"))
    d = v.raw("customer").select(key(F.col("c_acctbal") < 0, "c_custkey", 4), F.col("c_acctbal").alias("bal"))
    return joins.full_join_unique([a, b, c, d], ["k"])


@check(
    "select w.plotcode, w.projectcode, latitude, longitude from (select plotcode || case when latitude > 40 then '' else "
    "'.low' end plotcode, latitude, longitude from plots) p right join (select distinct plotcode, projectcode from samples) w on w.plotcode = p.plotcode",
    "samples",
)
def right_join_plots(v: Views) -> DataFrame:
    # Other plots have codes that no sample names.
    code = F.concat("plotcode", F.when(F.col("latitude") > 40, "").otherwise(".low"))
    located = v.plots().select(code.alias("plotcode"), "latitude", "longitude")
    wanted = v.samples().select("plotcode", "projectcode").distinct()
    return joins.join(located, wanted, ["plotcode"], "right")


@check(
    "select samplecode, projectcode from samples where samplecode in (select samplecode from trait_data "
    "where trait = 'leaf_tax')",
    "trait_data",
)
def semi_join_traits(v: Views) -> DataFrame:
    traits = v.trait_data().where("trait = 'leaf_tax'")
    return joins.join(v.samples().select("samplecode", "projectcode"), traits, how="semi", null_safe=False)


@check(
    "select samplecode, projectcode from samples where samplecode not in (select samplecode from spectra_info)",
    "spectra_info",
)
def anti_join_no_spectra(v: Views) -> DataFrame:
    return joins.join(v.samples().select("samplecode", "projectcode"), v.spectra_info(), how="anti", null_safe=False)


@check(
    "with a as (select nullif(c_nationkey, 0) k, c_mktsegment seg, count(*) n from customer group by 1, 2), "
    "b as (select nullif(s_nationkey, 0) k, count(*) m from supplier group by 1) "
    "select a.k, seg, n, m from a join b on a.k is not distinct from b.k"
)
def null_safe_join(v: Views) -> DataFrame:
    a = v.raw("customer").groupBy(
        F.nullif("c_nationkey", F.lit(0)).alias("k"), F.col("c_mktsegment").alias("seg")
    ).agg(F.count(F.lit(1)).alias("n"))
    b = v.raw("supplier").groupBy(F.nullif("s_nationkey", F.lit(0)).alias("k")).agg(F.count(F.lit(1)).alias("m"))
    return joins.join(a, b, ["k"], "inner")


_LABEL_MEANS = (
    "m as (select label, wavelength, avg(spectravalue) a from spectra_data join (select vec_id spectraid, label "
    "from embeddings) using (spectraid) group by 1, 2)"
)


@check(
    f"with {_LABEL_MEANS}, kept as (select label, wavelength + case when a > -0.05 then 0 else 0.1 * (label + 1) end wavelength, a from m), "
    "w as (select wavelength from kept group by 1 having count(*) = (select count(distinct label) from kept)) "
    "select wavelength, " + ", ".join(f"round(max(case when label = {i} then a end), 6) spec_{i}" for i in range(10))
    + " from kept where wavelength in (select wavelength from w) group by wavelength",
    "spectra_data",
)
def fold_merge_wavelength(v: Views) -> DataFrame:
    labels = v.raw("embeddings").select(F.col("vec_id").alias("spectraid"), "label")
    means = joins.join(v.spectra_data(), labels, ["spectraid"], "inner").groupBy("label", "wavelength").agg(
        F.avg("spectravalue").alias("a")
    )
    # Low means move to wavelengths that their label alone has.
    moved = F.col("wavelength") + F.when(F.col("a") > -0.05, 0.0).otherwise(0.1 * (F.col("label") + 1))
    kept = joins.keep_common_wavelengths(means.withColumn("wavelength", moved), "label", "wavelength")
    wide = reshape.pivot(kept, ["wavelength"], "label", "a", range(10))
    return wide.select("wavelength", *[F.round(F.col(str(i)), 6).alias(f"spec_{i}") for i in range(10)])


_BACKBONE = (
    "with usda as (select 'SP' || p_partkey code, case when p_type = 'SMALL' then null else split_part(p_name, ' ', 1) "
    "end genus, case when p_type = 'ECONOMY' then '' else split_part(p_name, ' ', 2) end species, "
    "p_name || ' L.' scientificname from part), "
    "u as (select code, genus, species, case when genus is not null and species is not null and species <> '' then "
    "genus || ' ' || species when genus is not null then genus || ' sp' "
    "else regexp_replace(scientificname, '(^[[:alpha:]]+ [[:alpha:]]+).*', '\\1') end acc from usda), "
    "t as (select 'SP' || p_partkey k, p_name acc, p_partkey tryspeciesid from part where p_size > 40 and p_type = 'SMALL') "
)


def _usda(v: Views) -> DataFrame:
    part = v.raw("part")
    return part.select(
        F.concat(F.lit("SP"), F.col("p_partkey")).alias("code"),
        F.when(F.col("p_type") != "SMALL", F.split_part("p_name", F.lit(" "), F.lit(1))).alias("genus"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("species"),
        F.concat("p_name", F.lit(" L.")).alias("scientificname"),
    )


def _try_names(v: Views) -> DataFrame:
    return v.raw("part").where("p_size > 40 and p_type = 'SMALL'").select(
        F.col("p_name").alias("AccSpeciesName"), F.col("p_partkey").alias("AccSpeciesID")
    )


@check(
    _BACKBONE + "select code, u.acc accepted_name, tryspeciesid from u left join t on u.acc is not distinct from t.acc"
)
def species_match(v: Views) -> DataFrame:
    return match_species(_usda(v), _try_names(v)).select("code", "accepted_name", "tryspeciesid")


@check(
    _BACKBONE + "select count(tryspeciesid) n_match, count(*) n_total, round(100.0 * count(tryspeciesid) / count(*), 4) "
    "pct_match from u left join t on u.acc is not distinct from t.acc"
)
def species_match_rate(v: Views) -> DataFrame:
    return match_rate(_usda(v), _try_names(v)).withColumn("pct_match", F.round("pct_match", 4))


@check(
    "with r as (select case when count(*) >= 8 then o_custkey else -o_custkey end o_custkey, case when count(*) >= 12 then null else "
    "max(o_totalprice) end newval from orders group by orders.o_custkey) "
    "select c_custkey, case when o_custkey is not null then newval else c_acctbal end c_acctbal, c_mktsegment "
    "from customer left join r on o_custkey = c_custkey"
)
def update_join(v: Views) -> DataFrame:
    per = v.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
    )
    # Customers with fewer orders have numbers that the base lacks.
    key = F.when(F.col("n") >= 8, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("c_custkey")
    source = per.select(key, F.when(F.col("n") < 12, F.col("top")).alias("c_acctbal"))
    base = v.raw("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return joins.update_join(base, source, ["c_custkey"], ["c_acctbal"])


@check(
    "select samplecode, s.projectcode, s.code, speciescode from (select samplecode, projectcode, "
    "'Brand#' || right(split_part(samplecode, '|', 3), 1) code from samples) s left join species_dict d "
    "on d.speciesdatacode = s.code and d.projectcode = s.projectcode",
    "samples", "species_dict",
)
def resolve_species(v: Views) -> DataFrame:
    code = F.concat(F.lit("Brand#"), F.right(F.split_part("samplecode", F.lit("|"), F.lit(3)), F.lit(1)))
    s = v.samples().select("samplecode", "projectcode", code.alias("speciesdatacode"))
    return joins.resolve_species(s, v.species_dict()).withColumnRenamed("speciesdatacode", "code")


@check(
    "select vec_id, label, (select max(s_suppkey) from supplier) specmethodid, "
    "(select round(avg(s_acctbal), 4) from supplier) calibration from embeddings"
)
def attach_scalar(v: Views) -> DataFrame:
    one = v.raw("supplier").agg(
        F.max("s_suppkey").alias("specmethodid"), F.round(F.avg("s_acctbal"), 4).alias("calibration")
    )
    return joins.attach_row(v.raw("embeddings").select("vec_id", "label"), one)


# --- aggregates ------------------------------------------------------------------------
@check("select l_returnflag, l_linestatus, count(*) n from lineitem group by 1, 2")
def count_sorted(v: Views) -> DataFrame:
    return aggregate.count_sorted(v.raw("lineitem"), "l_returnflag", "l_linestatus")


@check(
    "select sitecode, round(avg(latitude), 9) latitude, round(avg(longitude), 9) longitude, count(*) n "
    "from plots group by 1",
    "plots",
)
def group_mean_n(v: Views) -> DataFrame:
    return v.plots().groupBy("sitecode").agg(
        F.round(F.avg("latitude"), 9).alias("latitude"),
        F.round(F.avg("longitude"), 9).alias("longitude"),
        F.count(F.lit(1)).alias("n"),
    )


@check(
    "with g as (select c_nationkey, c_mktsegment, case when count(lat) = count(*) then avg(lat) end m from "
    "(select *, case when c_acctbal >= 0 then c_acctbal end lat from customer) group by 1, 2) "
    "select cast(c_nationkey as bigint) site, c_mktsegment, "
    "round(case when m is null and c_mktsegment = 'BUILDING' then 71.275764 else m end, 8) latitude from g"
)
def group_mean_strict(v: Views) -> DataFrame:
    lat = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    means = v.raw("customer").withColumn("lat", lat).groupBy("c_nationkey", "c_mktsegment").agg(
        strict_mean("lat").alias("m")
    )
    value = update_where("m", F.col("m").isNull() & (F.col("c_mktsegment") == "BUILDING"), 71.275764)
    return means.select(
        F.col("c_nationkey").cast("long").alias("site"), "c_mktsegment", F.round(value, 8).alias("latitude")
    )


@check(
    "select l_orderkey, l_linenumber, round(avg(l_quantity), 6) l_quantity, round(avg(tax), 6) tax, "
    "min_by(l_returnflag, [l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint)]) l_returnflag "
    "from (select *, case when l_tax > 0 then l_tax end tax from lineitem) group by 1, 2"
)
def collapse_duplicates(v: Views) -> DataFrame:
    rows = v.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"),
        "l_returnflag",
        F.struct("l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long")).alias("line"),
    )
    out = aggregate.collapse_duplicates(rows, ["l_orderkey", "l_linenumber"], F.col("line"))
    return out.drop("line").withColumns({c: F.round(c, 6) for c in ("l_quantity", "tax")})


@check("select distinct l_suppkey, l_returnflag from lineitem")
def distinct_keys(v: Views) -> DataFrame:
    return v.raw("lineitem").select("l_suppkey", "l_returnflag").distinct()


@check("select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1")
def check_unique(v: Views) -> DataFrame:
    return aggregate.duplicate_keys(v.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "select attr, value, count(*) n from (select 'spec_length' attr, cast(length(c_name) as varchar) as value "
    "from customer union all select 'sign', case when c_acctbal >= 0 then 'positive' end from customer) group by 1, 2"
)
def frequency_table(v: Views) -> DataFrame:
    c = v.raw("customer").select(
        F.length("c_name").cast("string").alias("spec_length"), F.when(F.col("c_acctbal") >= 0, "positive").alias("sign")
    )
    long = reshape.melt(c, [], ["spec_length", "sign"], "attr", "value", drop_null=False)
    return aggregate.count_sorted(long, "attr", "value")


@check(
    "select l_orderkey, cast(ceil(min(l_extendedprice)) as bigint) min_wavelength, "
    "cast(floor(max(l_extendedprice)) as bigint) max_wavelength from lineitem group by 1"
)
def wavelength_extent(v: Views) -> DataFrame:
    return aggregate.wavelength_extent(v.raw("lineitem"), ["l_orderkey"], "l_extendedprice")


@check(
    "select o_orderkey, cast(date '1970-01-01' + cast(floor(avg(date_diff('day', date '1970-01-01', "
    "cast(o_orderdate as date))) over (partition by o_custkey)) as integer) as varchar) collectiondate from orders"
)
def window_mean_date(v: Views) -> DataFrame:
    rows = v.raw("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("collectiondate"))
    out = aggregate.group_mean_by_rows(rows, ["o_custkey"], "collectiondate")
    return out.select("o_orderkey", F.col("collectiondate").cast("string").alias("collectiondate"))


# --- order-dependent -----------------------------------------------------------------------
@check(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint) price, "
    "last_value(case when l_linenumber = 1 then l_returnflag end ignore nulls) over (partition by l_orderkey order by "
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag rows unbounded preceding) label from lineitem"
)
def fill_down(v: Views) -> DataFrame:
    rows = v.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
        F.when(F.col("l_linenumber") == 1, F.col("l_returnflag")).alias("label"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"]
    return ordered.fill_down(rows, "label", ["l_orderkey"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("price"), "label",
    )


@check("select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) specnum from orders")
def row_number_group(v: Views) -> DataFrame:
    rows = v.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = ordered.row_number_in_group(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "specnum")
    return out.select("o_orderkey", "specnum")


@check(
    "select c_custkey, cast(floor((rn - 1) / 32) % 4 + 1 as bigint) treenum from (select c_custkey, "
    "row_number() over (partition by c_mktsegment order by c_custkey) rn from customer)"
)
def block_label(v: Views) -> DataFrame:
    rows = v.raw("customer").select("c_custkey", "c_mktsegment")
    numbered = ordered.row_number_in_group(rows, ["c_mktsegment"], ["c_custkey"], "rn")
    return numbered.select("c_custkey", ordered.block_label("rn", 32, 4).alias("treenum"))


@check(
    "select part, spectraid, wavelength, round(spectravalue, 6) spectravalue from (select *, row_number() over "
    "(partition by spectraid order by wavelength) a, row_number() over (partition by spectraid order by wavelength desc) b "
    "from spectra_data) join (values ('head'), ('tail')) t(part) on (part = 'head' and a <= 6) or (part = 'tail' and b <= 6)",
    "spectra_data",
)
def head_tail(v: Views) -> DataFrame:
    out = ordered.head_tail(v.spectra_data(), ["spectraid"], "wavelength", 6)
    return out.withColumn("spectravalue", F.round("spectravalue", 6))


# --- set operations and reshapes --------------------------------------------------------------
@check(
    "select c_custkey id, c_nationkey nation, c_acctbal bal from customer union all "
    "select s_suppkey, s_nationkey, s_acctbal from supplier"
)
def union_all(v: Views) -> DataFrame:
    a = v.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    b = v.raw("supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b)


@check(
    "select c_custkey id, c_mktsegment segment, null nation from customer union all "
    "select s_suppkey, null, s_nationkey from supplier"
)
def union_fill(v: Views) -> DataFrame:
    a = v.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    b = v.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True)


@check(
    "select '2013' file_number, o_orderkey, o_totalprice from orders where o_orderstatus = 'F' union all "
    "select '2014', o_orderkey, o_totalprice from orders where o_orderstatus = 'O' union all "
    "select '2015', o_orderkey, o_totalprice from orders where o_orderstatus = 'P'"
)
def union_with_source(v: Views) -> DataFrame:
    o = v.raw("orders")
    tagged = [
        o.where(F.col("o_orderstatus") == s).select(F.lit(tag).alias("file_number"), "o_orderkey", "o_totalprice")
        for tag, s in (("2013", "F"), ("2014", "O"), ("2015", "P"))
    ]
    return reduce(lambda a, b: a.unionByName(b), tagged)


@check("select c_nationkey nation from customer union select s_nationkey from supplier")
def set_union(v: Views) -> DataFrame:
    a = v.raw("customer").select(F.col("c_nationkey").alias("nation"))
    return a.union(v.raw("supplier").select("s_nationkey")).distinct()


@check("select spectraid, wavelength, spectravalue from spectra_data", "spectra_data")
def wide_to_long_spectra(v: Views) -> DataFrame:
    return reshape.wide_to_long(v.spectra_wide(), ["spectraid"])


@check(
    "select spectraid wavelength, 'Wave_' || cast(wavelength as integer) samplename, spectravalue from spectra_data",
    "spectra_data",
)
def transposed_to_long(v: Views) -> DataFrame:
    wide = v.spectra_wide().withColumnRenamed("spectraid", "wavelength")
    names = columns.with_prefix(wide, "Wave_")
    return reshape.names_to_long(wide, ["wavelength"], names, "samplename", "spectravalue")


@check("select samplecode, trait, traitvalue from trait_data", "trait_data")
def melt_traits_dropna(v: Views) -> DataFrame:
    return reshape.melt(v.trait_wide(), ["samplecode"], TRAITS, "trait", "traitvalue", drop_null=True)


@check("select l_orderkey, condition, conditionvalue from conditions", "conditions")
def melt_conditions_keepna(v: Views) -> DataFrame:
    return v.conditions()


@check("select samplecode, leaf_quantity, leaf_price, leaf_tax from trait_wide", "trait_wide")
def pivot_traits(v: Views) -> DataFrame:
    return reshape.pivot(v.trait_data(), ["samplecode"], "trait", "traitvalue", TRAITS)


@check(
    "select o_orderkey, 'reflectance' spectratype, o_totalprice spectravalue from orders union all "
    "select o_orderkey, 'transmittance', 1 - o_totalprice from orders"
)
def stack_refl_trans(v: Views) -> DataFrame:
    two = v.raw("orders").select(
        "o_orderkey", F.col("o_totalprice").alias("Reflectance"), (1 - F.col("o_totalprice")).alias("Transmittance")
    )
    pairs = {"reflectance": "Reflectance", "transmittance": "Transmittance"}
    return reshape.stack_pairs(two, ["o_orderkey"], pairs, "spectratype", "spectravalue")


@check(
    "with p as (select spectraid, wavelength, avg(spectravalue) a from spectra_points group by 1, 2) "
    "select spectraid, count(*) n, min(wavelength) first_wl, max(wavelength) last_wl, round(min_by(a, wavelength), 6) "
    "first_value, round(max_by(a, wavelength), 6) last_value, round(sum(a), 6) total from p group by 1",
    "spectra_points",
)
def pack_spectra(v: Views) -> DataFrame:
    p = reshape.pack(v.spectra_points(), ["spectraid"])
    return p.select(
        "spectraid",
        F.size("wavelengths").cast("long").alias("n"),
        F.element_at("wavelengths", 1).alias("first_wl"),
        F.element_at("wavelengths", -1).alias("last_wl"),
        F.round(F.element_at("spectravalues", 1), 6).alias("first_value"),
        F.round(F.element_at("spectravalues", -1), 6).alias("last_value"),
        F.round(F.aggregate("spectravalues", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


@check(
    "select spectraid, wavelength, round(avg(spectravalue), 6) spectravalue from spectra_points group by 1, 2",
    "spectra_points",
)
def unpack_spectra(v: Views) -> DataFrame:
    long = reshape.unpack(reshape.pack(v.spectra_points(), ["spectraid"]), ["spectraid"])
    return long.withColumn("spectravalue", F.round("spectravalue", 6))
