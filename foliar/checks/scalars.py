"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliar.checks.analog import Views
from foliar.checks.registry import check
from foliar.functions import clean, parse, units
from foliar.functions.nulls import matches, ratio, recode_keep, recode_lookup, update_where
from foliar.operators.reshape import pack, scale_packed, unpack


@check(
    "select l_orderkey, l_partkey, case when l_discount = 0 or l_discount = 0.01 then null else l_discount end x, "
    "case when l_tax = 0 then null else l_tax end y from lineitem"
)
def sentinel_threshold(v: Views) -> DataFrame:
    d, t = F.col("l_discount"), F.col("l_tax")
    rows = v.raw("lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(d == 0, -999.0).when(d == 0.01, -998.0).otherwise(d).alias("x"),
        F.when(t == 0, -1e4).otherwise(t).alias("y"),
    )
    return clean.drop_sentinels(rows, -999.0, ["x", "y"])


@check(
    "select l_orderkey, l_partkey, nullif(l_discount, 0) x, case when l_returnflag <> 'A' then l_returnflag end flag "
    "from lineitem"
)
def sentinel_exact(v: Views) -> DataFrame:
    d = F.col("l_discount")
    rows = v.raw("lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(d == 0, -9999.0).otherwise(d).alias("x"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_returnflag")).alias("flag"),
    )
    return rows.withColumns({"x": clean.sentinel_equal("x", -9999.0), "flag": clean.sentinel_equal("flag", "")})


@check("select c_custkey, case when c_acctbal < 0 then null else c_acctbal end lma from customer")
def negative_to_null(v: Views) -> DataFrame:
    return v.raw("customer").select("c_custkey", clean.negative_to_null("c_acctbal").alias("lma"))


@check(
    "select samplecode, trait, case trait when 'leaf_quantity' then traitvalue * 0.001 when 'leaf_price' "
    "then traitvalue * 0.00001 else traitvalue end traitvalue from trait_data",
    "trait_data",
)
def convert_units(v: Views) -> DataFrame:
    trait = F.col("trait")
    rows = v.trait_data().withColumns(
        {
            "unit": F.when(trait == "leaf_quantity", "g m-2").when(trait == "leaf_price", "ug cm-2").otherwise("percent"),
            "to_unit": F.when(trait == "leaf_tax", "percent").otherwise("kg m-2"),
        }
    )
    return units.convert_long(rows, "traitvalue", "unit", "to_unit").select("samplecode", "trait", "traitvalue")


_TRAIT_NAME = (
    "'leaf_' || lower(p_type) || case when p_size < 10 then '_pct_mass' when p_size < 20 then '_per_area' "
    "when p_size < 30 then '_ratio_per_area' when p_size < 40 then '_thickness' else '_other' end"
)


@check(
    f"select distinct {_TRAIT_NAME} trait, case when p_size < 10 then '%' when p_size < 40 then 'kg m-2' end unit_first, "
    "case when p_size < 10 then '%' when p_size < 20 then 'kg m-2' when p_size < 30 then 'unitless' "
    "when p_size < 40 then 'kg m-2' end unit_last from part"
)
def derive_units(v: Views) -> DataFrame:
    size = F.col("p_size")
    tail = (
        F.when(size < 10, "_pct_mass").when(size < 20, "_per_area").when(size < 30, "_ratio_per_area")
        .when(size < 40, "_thickness").otherwise("_other")
    )
    rules = [("_pct", "%"), ("_area|_thickness", "kg m-2"), ("ratio", "unitless")]
    traits = v.raw("part").select(F.concat(F.lit("leaf_"), F.lower("p_type"), tail).alias("trait")).distinct()
    return traits.withColumns(
        {"unit_first": units.label("trait", rules), "unit_last": units.label("trait", rules, last_wins=True)}
    )


@check(
    "select o_orderkey, 'accp|' || o_custkey || '|' || case when o_orderstatus = 'P' then 'NA' else "
    "cast(year(o_orderdate) as varchar) end samplecode from orders"
)
def build_samplecode(v: Views) -> DataFrame:
    year = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate"))
    return v.raw("orders").select("o_orderkey", parse.samplecode(F.lit("accp"), "o_custkey", year).alias("samplecode"))


@check(
    "select c_custkey, 'p.' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') sitecode, "
    "'p.' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') || '.' || c_nationkey plotcode from customer"
)
def build_site_plot_codes(v: Views) -> DataFrame:
    site = F.nullif("c_mktsegment", F.lit("BUILDING"))
    df = v.raw("customer").select("c_custkey", "c_nationkey", parse.dotted(F.lit("p"), site).alias("sitecode"))
    return df.select("c_custkey", "sitecode", parse.dotted("sitecode", "c_nationkey").alias("plotcode"))


@check("select c_custkey, printf('%s_Leaf%02d', left(c_mktsegment, 3), c_nationkey) samplename from customer")
def padded_name(v: Views) -> DataFrame:
    stem = F.left("c_mktsegment", F.lit(3))
    return v.raw("customer").select("c_custkey", parse.leaf_name(stem, "c_nationkey").alias("samplename"))


# Names are two words, so the parts are known without a pattern.
_SHORT = "left(split_part(p_name, ' ', 1), 3) || '-' || left(split_part(p_name, ' ', 2), 3)"


@check(f"select p_partkey, {_SHORT} plain, {_SHORT} hybrid from part")
def abbreviate_name(v: Views) -> DataFrame:
    crossed = F.when(F.col("p_size") > 25, F.replace("p_name", F.lit(" "), F.lit(" x "))).otherwise(F.col("p_name"))
    return v.raw("part").select(
        "p_partkey",
        parse.abbreviate(F.concat("p_name", F.lit(" L."))).alias("plain"),
        parse.abbreviate(crossed, parse.HYBRID_BINOMIAL).alias("hybrid"),
    )


@check("select c_custkey, case when left(c_mktsegment, 1) in ('T', 'M', 'B') then left(c_mktsegment, 1) end pos from customer")
def extract_canopy_position(v: Views) -> DataFrame:
    token = F.concat(F.lit("L"), F.col("c_nationkey"), F.left("c_mktsegment", F.lit(1)), F.lit("_x"))
    return v.raw("customer").select("c_custkey", parse.canopy_position(token).alias("pos"))


@check(
    "select p_partkey, split_part(p_name, ' ', 1) genus, split_part(p_name, ' ', 2) species, "
    "case when p_type in ('SMALL', 'MEDIUM') then 'alba' end variety, case when p_type in ('LARGE', 'MEDIUM') then 'nigra' end subspecies "
    "from part"
)
def parse_scientific_name(v: Views) -> DataFrame:
    t = F.col("p_type")
    rank = (
        F.when(t == "SMALL", " var. alba").when(t == "LARGE", " subsp. nigra")
        .when(t == "MEDIUM", " var. alba subsp. nigra").otherwise("")
    )
    rows = v.raw("part").select("p_partkey", F.concat("p_name", rank, F.lit(" (L.) Mill.")).alias("full"))
    return rows.withColumns(parse.scientific_parts("full")).drop("full")


@check(
    "select p_partkey, case when p_type <> 'SMALL' and p_type <> 'ECONOMY' then p_name when p_type = 'ECONOMY' then "
    "split_part(p_name, ' ', 1) || ' sp' else p_name end accepted from part"
)
def derive_species_name(v: Views) -> DataFrame:
    t = F.col("p_type")
    genus = F.when(t != "SMALL", F.split_part("p_name", F.lit(" "), F.lit(1)))
    epithet = F.when(t == "ECONOMY", "").otherwise(F.split_part("p_name", F.lit(" "), F.lit(2)))
    full = F.concat("p_name", F.lit(" var. x (L.) Mill."))
    return v.raw("part").select("p_partkey", parse.accepted_name(genus, epithet, full).alias("accepted"))


# A coded name with 4 to 8 parts by priority: site, plot, species, leaf and kind.
_CODED = """with c as (select o_orderkey, o_orderstatus st, 'Plot' || o_custkey pl,
 case when o_totalprice > 400000 then 'Grape' else 'SP' || o_custkey end sp,
 'L' || month(o_orderdate) || case o_orderstatus when 'P' then 'T' when 'F' then 'M' else 'X' end lf,
 case when o_totalprice > 250000 then 'Refl' when o_totalprice > 100000 then 'trans' else 'x' end kd,
 cast(left(o_orderpriority, 1) as integer) + 3 n from orders) """


@check(
    _CODED + "select o_orderkey, n name_parts, case when n >= 5 then st end site, case when n >= 5 then pl end plot, "
    "case when n = 5 then case when sp = 'Grape' then 'Grape' end when n >= 6 then sp end species, "
    "case when n >= 5 then case kd when 'Refl' then 'reflectance' when 'trans' then 'transmittance' end end spectratype, "
    "case when n >= 6 then case right(lf, 1) when 'X' then null else right(lf, 1) end end CanopyPosition, "
    "case n when 5 then st || '_' || sp || '_' || pl when 6 then st || '_' || pl || '_' || sp || '_' || lf "
    "when 7 then st || '_' || pl || '_' || sp || '_' || lf when 8 then st || '_' || pl || '_' || sp || '_' || lf || '_b' "
    "end Sample_Name from c"
)
def parse_coded_name(v: Views) -> DataFrame:
    o, price = v.raw("orders"), F.col("o_totalprice")
    parts = o.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("st"),
        F.concat(F.lit("Plot"), F.col("o_custkey")).alias("pl"),
        F.when(price > 400000, "Grape").otherwise(F.concat(F.lit("SP"), F.col("o_custkey"))).alias("sp"),
        F.concat(
            F.lit("L"), F.month("o_orderdate"),
            F.when(F.col("o_orderstatus") == "P", "T").when(F.col("o_orderstatus") == "F", "M").otherwise("X"),
        ).alias("lf"),
        F.when(price > 250000, "Refl").when(price > 100000, "trans").otherwise("x").alias("kd"),
        (F.left("o_orderpriority", F.lit(1)).cast("int") + 3).alias("n"),
    )
    n = F.col("n")
    name = (
        F.when(n == 4, F.concat_ws("_", "st", "pl", "sp", "lf"))
        .when(n == 5, F.concat_ws("_", "st", "sp", "pl", F.lit("a"), "kd"))
        .when(n == 6, F.concat_ws("_", "st", "pl", "sp", "lf", F.lit("b"), "kd"))
        .when(n == 7, F.concat_ws("_", "st", "pl", "sp", "lf", F.lit("b"), "kd", F.lit("c")))
        .otherwise(F.concat_ws("_", "st", "pl", "sp", "lf", F.lit("b"), F.lit("c"), "kd", F.lit("d")))
    )
    return parts.select("o_orderkey", name.alias("name")).select(
        "o_orderkey", *[c.alias(k) for k, c in parse.coded_name("name").items()]
    )


@check(
    "select o_orderkey, case o_orderstatus when 'P' then 'all_pig' else 'sgf' end site, "
    "case o_orderstatus when 'P' then 'all_pig' else lower(o_orderstatus) || '1' end cond, "
    "case when o_orderstatus <> 'P' then o_custkey end specnum from orders"
)
def parse_file_name(v: Views) -> DataFrame:
    path = F.when(F.col("o_orderstatus") == "P", "/data/all_pig.txt").otherwise(
        F.concat(F.lit("/data/sgf_"), F.lower("o_orderstatus"), F.lit("1_top_s"), F.col("o_custkey"), F.lit(".txt"))
    )
    rows = v.raw("orders").select("o_orderkey", parse.base_name(path).alias("raw"))
    rx = r"(^\p{Alpha}+)_(\p{Alnum}+)_top_s(\p{Digit}+$)"
    out = rows.withColumns(parse.file_name_parts("raw", rx, {"site": 1, "cond": 2, "specnum": 3}))
    return out.withColumn("specnum", F.col("specnum").try_cast("long")).drop("raw")


@check(
    "select o_orderkey, case o_orderstatus when 'F' then 'ozone' when 'O' then 'green' end cond from orders",
    name="recode_lookup",
)
def recode_lookup_check(v: Views) -> DataFrame:
    return v.raw("orders").select("o_orderkey", recode_lookup("o_orderstatus", {"F": "ozone", "O": "green"}).alias("cond"))


@check(
    "select o_orderkey, case o_orderstatus when 'F' then 'ECM' when 'P' then null else o_orderstatus end myco from orders",
    name="recode_keep",
)
def recode_keep_check(v: Views) -> DataFrame:
    return v.raw("orders").select("o_orderkey", recode_keep("o_orderstatus", {"F": "ECM", "P": None}).alias("myco"))


@check("select p_partkey, lower(p_brand) projectcode from part")
def normalize_case(v: Views) -> DataFrame:
    return v.raw("part").select("p_partkey", F.lower("p_brand").alias("projectcode"))


@check("select c_custkey, replace(c_name, 'Cu', 'CuI') a, regexp_replace(c_name, 'omer#0+', '') b from customer")
def string_fix(v: Views) -> DataFrame:
    return v.raw("customer").select(
        "c_custkey", F.replace("c_name", F.lit("Cu"), F.lit("CuI")).alias("a"),
        F.regexp_replace("c_name", "omer#0+", "").alias("b"),
    )


@check(
    "select c_custkey, case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_name || '_dry' else c_name end samplename "
    "from customer"
)
def conditional_suffix(v: Views) -> DataFrame:
    seg = F.col("c_mktsegment")
    fname = (
        F.when(seg == "BUILDING", "map_d_sp.dat").when(seg == "MACHINERY", "df_d_sp.dat").when(seg == "HOUSEHOLD", "x_map_d")
    )
    named = F.concat("c_name", F.lit("_dry"))
    return v.raw("customer").select("c_custkey", update_where("c_name", matches(fname, "^(map|df)_"), named).alias("samplename"))


@check(
    "select p_partkey, case when contains(upper(p_name), 'U') then 'sun' when contains(upper(p_name), 'L') then 'shade' "
    "end by_letter, case when p_type = 'SMALL' then null when p_type = 'LARGE' then 'sun' else 'shade' end by_position from part"
)
def classify_sunshade(v: Views) -> DataFrame:
    position = F.when(F.col("p_type") == "LARGE", "T").when(F.col("p_type") != "SMALL", "B")
    return v.raw("part").select(
        "p_partkey",
        parse.sunshade_by_letter(F.upper("p_name")).alias("by_letter"),
        parse.sunshade_by_position(position).alias("by_position"),
    )


@check(
    "select o_orderkey, case left(o_orderpriority, 1) when '1' then 'N' when '4' then 'O' end NeedleOldNew, "
    "case left(o_orderpriority, 1) when '1' then 1.0 when '2' then 2.0 when '3' then 3.0 end::double NeedleAge from orders"
)
def needle_age(v: Views) -> DataFrame:
    first = F.left("o_orderpriority", F.lit(1))
    age = F.when(first == "1", "N").when(first == "4", "O").when(first.isin("2", "3"), first)
    return v.raw("orders").select("o_orderkey", *[c.alias(k) for k, c in parse.needle_age(age).items()])


@check(
    "select o_orderkey, cast(cast(o_orderdate as date) as varchar) two_digit, case when o_orderstatus <> 'P' then "
    "cast(cast(o_orderdate as date) as varchar) end fallback from orders"
)
def parse_dates(v: Views) -> DataFrame:
    st, day = F.col("o_orderstatus"), F.col("o_orderdate")
    text = (
        F.when(st == "F", F.date_format(day, "yyyyMMdd")).when(st == "O", F.date_format(day, "MMddyyyy")).otherwise("unknown")
    )
    two = F.date_format(day, "yyMMdd")
    return v.raw("orders").select(
        "o_orderkey",
        parse.parse_date(two, "%y%m%d").cast("string").alias("two_digit"),
        parse.parse_date(text, "%Y%m%d", "%m%d%Y").cast("string").alias("fallback"),
    )


@check(
    "select o_orderkey, case when o_orderstatus <> 'P' then cast(cast(o_orderdate as date) as varchar) "
    "when year(o_orderdate) in (1996, 2000) then year(o_orderdate) || '-12-31' end collectiondate from orders"
)
def doy_to_date(v: Views) -> DataFrame:
    day = F.when(F.col("o_orderstatus") == "P", F.lit(366)).otherwise(F.dayofyear("o_orderdate"))
    return v.raw("orders").select(
        "o_orderkey", parse.doy_to_date(F.year("o_orderdate"), day).cast("string").alias("collectiondate")
    )


@check(
    "select o_orderkey, cast(case when o_orderstatus <> 'P' then year(o_orderdate) when o_orderpriority <> '5-LOW' then "
    "2010 + cast(left(o_orderpriority, 1) as integer) end as bigint) as year from orders"
)
def year_fallback(v: Views) -> DataFrame:
    date = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    first = F.left("o_orderpriority", F.lit(1))
    path = F.when(first == "5", "/run/a").otherwise(F.concat(F.lit("/run/201"), first, F.lit("_x")))
    return v.raw("orders").select("o_orderkey", parse.year_of(date, path).cast("long").alias("year"))


@check(
    "select c_custkey, round(case when d < 0 then -(abs(d) + c_nationkey / 60.0::double + abs(c_acctbal) / 1000 / "
    "3600.0::double) else d + c_nationkey / 60.0::double + abs(c_acctbal) / 1000 / 3600.0::double end, 9) degrees "
    "from (select *, cast(floor(c_acctbal / 100) - 40 as integer) d from customer)"
)
def dms_to_decimal(v: Views) -> DataFrame:
    deg = (F.floor(F.col("c_acctbal") / 100) - 40).cast("int")
    value = clean.dms_to_decimal(deg, "c_nationkey", F.abs("c_acctbal") / 1000)
    return v.raw("customer").select("c_custkey", F.round(value, 9).alias("degrees"))


@check(
    "select l_orderkey, l_partkey, round(l_quantity / nullif(l_discount, 0), 6) cn_ratio, round(1 / nullif(l_tax, 0), 6) "
    "lma, round(l_discount * (1 / nullif(l_tax, 0)), 6) water, round(l_discount + l_tax, 6) chl_total from lineitem"
)
def derived_traits(v: Views) -> DataFrame:
    lma = ratio(F.lit(1.0), "l_tax")
    return v.raw("lineitem").select(
        "l_orderkey", "l_partkey",
        F.round(ratio("l_quantity", "l_discount"), 6).alias("cn_ratio"),
        F.round(lma, 6).alias("lma"),
        F.round(F.col("l_discount") * lma, 6).alias("water"),
        F.round(F.col("l_discount") + F.col("l_tax"), 6).alias("chl_total"),
    )


@check(
    "select l_orderkey, l_partkey, case when a is null then b when b is null then a else 0.5 * (a + b) end starch from "
    "(select *, nullif(l_discount, 0) a, nullif(l_tax, 0) b from lineitem)"
)
def replicate_mean(v: Views) -> DataFrame:
    a, b = F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0))
    return v.raw("lineitem").select("l_orderkey", "l_partkey", clean.replicate_mean(a, b).alias("starch"))


@check(
    "select spectraid, wavelength, round(spectravalue * 0.01, 8) spectravalue from spectra_data", "spectra_data"
)
def scale_spectra(v: Views) -> DataFrame:
    packed = pack(v.spectra_data(), ["spectraid"], unique=True)
    scaled = packed.withColumn("spectravalues", scale_packed("spectravalues", 0.01))
    return unpack(scaled, ["spectraid"]).withColumn("spectravalue", F.round("spectravalue", 8))


@check(
    "select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end a, "
    "case when o_orderstatus = 'F' then cast(o_custkey as double) end b from orders"
)
def retype_columns(v: Views) -> DataFrame:
    st = F.col("o_orderstatus")
    rows = v.raw("orders").select(
        "o_orderkey",
        F.when(st == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("a"),
        F.when(st == "F", F.col("o_custkey").cast("string")).otherwise("").alias("b"),
    )
    return clean.retype(rows, ["a", "b"], "double")
