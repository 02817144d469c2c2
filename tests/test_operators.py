import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from foliar import session
from foliar.operators import aggregate, columns, filters, joins, merge, ordered, quality, reshape
from foliar.plans.reference_data import match_rate, match_species
from foliar.plans.report import pairs_by_trait
from foliar.schema import TABLES


# --- joins ---------------------------------------------------------------------
def brute_join(left, right, how):
    """Key in the first place of each row; missing keys match."""
    out = []
    for a in left:
        hit = [b for b in right if b[0] == a[0]]
        if how in ("inner", "left", "full"):
            out += [(*a, b[1]) for b in hit]
        if how in ("left", "full") and not hit:
            out.append((*a, None))
        if how == "semi" and hit or how == "anti" and not hit:
            out.append(a)
    if how in ("full", "right"):
        if how == "right":
            out += [(*a, b[1]) for b in right for a in left if a[0] == b[0]]
        out += [(b[0], None, b[1]) for b in right if all(a[0] != b[0] for a in left)]
    return sorted(out, key=lambda t: [(x is not None, str(x)) for x in t])


LEFT = [(1, "a"), (1, "b"), (None, "c"), (3, "d"), (3, "e")]
RIGHT = [(1, "x"), (None, "y"), (None, "z"), (4, "w"), (3, "v")]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
def test_join_matches_missing_keys(spark, how):
    left = spark.createDataFrame(LEFT, "k int, l string")
    right = spark.createDataFrame(RIGHT, "k int, r string")
    assert rows(joins.join(left, right, how=how)) == brute_join(LEFT, RIGHT, how)


@pytest.mark.parametrize("how", ["inner", "left", "full", "semi", "anti"])
def test_join_without_broadcast_is_an_equi_join(spark, how):
    left = spark.createDataFrame(LEFT, "k int, l string")
    right = spark.createDataFrame(RIGHT, "k int, r string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = joins.join(left, right, how=how)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "FullOuter" not in plan
        assert rows(df) == brute_join(LEFT, RIGHT, how)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_database_style_join_drops_missing_keys(spark):
    left = spark.createDataFrame(LEFT, "k int, l string")
    right = spark.createDataFrame(RIGHT, "k int, r string")
    assert all(r[0] is not None for r in joins.join(left, right, ["k"], "inner", null_safe=False).collect())


def test_join_refuses_ambiguous_columns(spark):
    left = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    right = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="rename"):
        joins.join(left, right, ["a"])
    with pytest.raises(ValueError, match="share no column"):
        joins.join(left, spark.createDataFrame([(1,)], "z int"))


def test_full_join_unique_equals_chain(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n")], "k int, x string")
    b = spark.createDataFrame([(1, 5), (2, 6)], "k int, y int")
    c = spark.createDataFrame([(None, 1.0), (2, 2.0)], "k int, z double")
    chain = joins.join(joins.join(a, b, ["k"], "full"), c, ["k"], "full")
    assert rows(joins.full_join_unique([a, b, c], ["k"])) == rows(chain)


def test_update_join_writes_missing_values_too(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, v double")
    right = spark.createDataFrame([(1, 9.0), (2, None), (7, 7.0)], "k int, v double")
    assert rows(joins.update_join(left, right, ["k"], ["v"])) == [(1, 9.0), (2, None), (3, None)]
    with pytest.raises(ValueError, match="duplicates"):
        joins.update_join(left, right.unionByName(right), ["k"], ["v"])


def test_attach_row_needs_exactly_one(spark):
    df = spark.range(3)
    one = spark.createDataFrame([(5, None)], "m bigint, t string")
    assert rows(joins.attach_row(df, one)) == [(0, 5, None), (1, 5, None), (2, 5, None)]
    with pytest.raises(ValueError):
        joins.attach_row(df, spark.range(2).withColumnRenamed("id", "m"))


def test_common_wavelengths(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0), ("b", 3.0)], "s string, wavelength double")
    assert rows(joins.keep_common_wavelengths(df, "s", "wavelength")) == [("a", 2.0), ("b", 2.0)]


# --- order-dependent -----------------------------------------------------------------
def skewed(spark, n=400):
    """A group with most of the rows, a missing group, and ties in the order column."""
    data = [("hot" if i % 4 else ("a" if i % 8 else None), i // 3, i, str(i) if i % 7 == 0 else None) for i in range(n)]
    return spark.createDataFrame(data, "g string, o int, id int, v string").repartition(5), data


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_row_number_in_group(spark, parts):
    df, data = skewed(spark)
    out = ordered.row_number_in_group(df.repartition(parts), ["g"], ["o", "id"], "n")
    seen, want = {}, {}
    for g, o, i, _ in sorted(data, key=lambda r: (r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert {r.id: r.n for r in out.collect()} == want


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_fill_down(spark, parts):
    df, data = skewed(spark)
    out = ordered.fill_down(df.repartition(parts), "v", ["g"], ["o", "id"])
    last, want = {}, {}
    for g, o, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        last[g] = v if v is not None else last.get(g)
        want[i] = last[g]
    assert {r.id: r.v for r in out.collect()} == want
    assert out.columns == df.columns


def test_row_number_global_is_contiguous_even_for_copies(spark):
    df = spark.createDataFrame([(1, "x")] * 500 + [(0, "y")] * 3, "a int, b string").repartition(6)
    out = ordered.row_number_global(df, ["a"], "n", start=11)
    numbers = sorted((r.n, r.a) for r in out.collect())
    assert [n for n, _ in numbers] == list(range(11, 514))
    assert [a for _, a in numbers[:3]] == [0, 0, 0]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ordered.segments(df, ["a"]).groupBy("__seg").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 300  # copies do not end up in one partition


def test_row_number_any_is_contiguous(spark):
    out = ordered.row_number_any(spark.range(0, 1000, 1, 7), "n", start=5)
    assert sorted(r.n for r in out.collect()) == list(range(5, 1005))
    assert rows(ordered.row_number_any(spark.range(0), "n")) == []


def test_block_label_and_head_tail(spark):
    df = spark.range(1, 131).select("id", ordered.block_label("id", 32, 4).alias("b"))
    labels = [r.b for r in df.orderBy("id").collect()]
    assert labels == [1] * 32 + [2] * 32 + [3] * 32 + [4] * 32 + [1, 1]
    ends = ordered.head_tail(df.withColumn("g", (F.col("id") > 1000).cast("string")), ["g"], "id", 2)
    assert sorted((r.part, r.id) for r in ends.collect()) == [("head", 1), ("head", 2), ("tail", 129), ("tail", 130)]
    assert "WindowGroupLimit" in ends._jdf.queryExecution().executedPlan().toString()


# --- aggregates --------------------------------------------------------------------------
def test_collapse_duplicates(spark):
    df = spark.createDataFrame(
        [("a", 2, "second", 4.0), ("a", 1, "first", None), ("b", 1, None, None)], "k string, line int, t string, x double"
    )
    out = aggregate.collapse_duplicates(df.select("k", "t", "x", F.struct("line").alias("l")), ["k"], F.col("l"))
    assert sorted((r.k, r.t, r.x) for r in out.collect()) == [("a", "first", 4.0), ("b", None, None)]


def test_group_mean_by_rows(spark):
    df = spark.createDataFrame(
        [("a", "2013-01-01"), ("a", "2013-01-04"), ("b", None)], "k string, d string"
    ).withColumn("d", F.to_date("d"))
    assert [str(r.d) for r in aggregate.group_mean_by_rows(df, ["k"], "d").orderBy("k").collect()] == [
        "2013-01-02", "2013-01-02", "None",
    ]


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert rows(aggregate.duplicate_keys(df, ["k", "v"])) == [(1, "a", 2)]
    with pytest.raises(ValueError):
        aggregate.require_unique(df, ["k"])


# --- columns and filters ---------------------------------------------------------------------
def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "leaf_a int, leaf_b double, name string, `350` int")
    assert columns.select_prefix(df, ["name"], "leaf_").columns == ["name", "leaf_a", "leaf_b"]
    assert columns.select_pattern(df, [], r"^\d+$").columns == ["350"]
    assert columns.canonical(df, ["name", "zzz", "leaf_a"]).columns == ["name", "leaf_a"]
    assert columns.map_numeric(df, lambda c: c + 1).first()[:] == (2, 3.0, "x", 4)
    assert columns.drop_unnamed(df.withColumnRenamed("name", "_c2")).columns == ["leaf_a", "leaf_b", "350"]


def test_filters(spark):
    df = spark.createDataFrame(
        [("BNL1", "A"), ("BNL1", "B"), ("BNL1", None), (None, "A"), ("Soil_1", "A")], "Spectra string, Site string"
    )
    pair = rows(filters.exclude_pair(df, Spectra="BNL1", Site="A"))
    assert pair == [("BNL1", "B"), ("Soil_1", "A")]
    assert len(rows(filters.exclude(df, "Site", ["A"]))) == 2
    assert len(rows(filters.leaf_only(df, "Spectra"))) == 3
    kinds = df.select(filters.route("Spectra", [("^BNL", "leaf"), ("Soil", "soil")]).alias("k"))
    assert [r.k for r in kinds.collect()] == ["leaf", "leaf", "leaf", None, "soil"]


# --- reshape -----------------------------------------------------------------------------------
def test_wide_long_wide(spark):
    wide = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 4.0)], "s string, Wave_350 double, Wave_351 double")
    long = reshape.wide_to_long(wide, ["s"])
    assert rows(long) == [("a", 350.0, 1.0), ("a", 351.0, None), ("b", 350.0, 3.0), ("b", 351.0, 4.0)]
    back = reshape.pivot(long, ["s"], "wavelength", "spectravalue", [350.0, 351.0])
    assert rows(back) == rows(wide)


def test_pack_averages_repeats_and_unpacks(spark):
    long = spark.createDataFrame([(1, 2.0, 5.0), (1, 1.0, 4.0), (1, 2.0, 7.0), (2, 9.0, 1.0)], "s int, wavelength double, spectravalue double")
    packed = reshape.pack(long, ["s"])
    assert rows(packed) == [(1, [1.0, 2.0], [4.0, 6.0]), (2, [9.0], [1.0])]
    assert rows(reshape.unpack(packed, ["s"])) == [(1, 1.0, 4.0), (1, 2.0, 6.0), (2, 9.0, 1.0)]


def test_melt_and_stack(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "s string, x double, y double")
    assert rows(reshape.melt(df, ["s"], ["x", "y"], "t", "v", True)) == [("a", "x", 1.0)]
    assert rows(reshape.melt(df, ["s"], ["x", "y"], "t", "v", False)) == [("a", "x", 1.0), ("a", "y", None)]
    assert rows(reshape.stack_pairs(df, ["s"], {"p": "x", "q": "y"}, "t", "v")) == [("a", "p", 1.0), ("a", "q", None)]
    assert rows(reshape.names_to_long(df, ["s"], ["x", "y"], "t", "v", True)) == [("a", "x", 1.0)]


# --- merge ----------------------------------------------------------------------------------------
def test_merge_is_idempotent_and_keeps_ids(spark):
    target = spark.createDataFrame([(4, "a", None)], "id bigint, code string, note string")
    values = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "code string, extra int")
    first = merge.insert_if_absent(target, values, ["code"], "id", "error", order=["code"])
    assert rows(first.table) == [(4, "a", None), (5, None, None), (6, "b", None), (7, "c", None)]
    again = merge.insert_if_absent(first.table, values, ["code"], "id", "error")
    assert again.inserted.isEmpty()
    back = merge.with_ids(values, first.table, ["code"], "id")
    assert sorted((r.extra, r.id) for r in back.collect()) == [(1, 4), (2, 6), (3, 7), (4, 5)]


def test_merge_duplicates_in_the_batch(spark):
    target = spark.createDataFrame([], "id bigint, code string, v int")
    values = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "code string, v int")
    with pytest.raises(ValueError, match="repeats"):
        merge.insert_if_absent(target, values, ["code"], "id", "error")
    assert merge.insert_if_absent(target, values, ["code"], "id").table.count() == 3
    first = merge.insert_if_absent(target, values, ["code"], "id", "first").table
    assert sorted((r.code, r.v) for r in first.collect()) == [("a", 1), ("b", 3)]


def test_a_present_key_blocks_all_its_rows(spark):
    target = spark.createDataFrame([(1, 350.0)], "spectraid int, wavelength double")
    values = spark.createDataFrame([(1, 351.0), (2, 350.0), (2, 351.0)], "spectraid int, wavelength double")
    assert rows(merge.absent_rows(target, values, ["spectraid"])) == [(2, 350.0), (2, 351.0)]


def test_with_ids_refuses_repeated_keys(spark):
    table = spark.createDataFrame([(1, "a"), (2, "a")], "id int, code string")
    with pytest.raises(ValueError):
        merge.with_ids(table.select("code"), table, ["code"], "id")


def test_cascade_delete(spark):
    tables = {
        "projects": spark.createDataFrame([("p",), ("q",)], "projectcode string"),
        "samples": spark.createDataFrame([("s1", "p"), ("s2", "q"), ("s3", None)], "samplecode string, projectcode string"),
        "spectra_info": spark.createDataFrame([(1, "s1"), (2, "s2")], "spectraid int, samplecode string"),
        "spectra_data": spark.createDataFrame([(1,), (1,), (2,)], "spectraid int"),
        "trait_data": spark.createDataFrame([("s1",), ("s3",)], "samplecode string"),
    }
    left, removed = merge.cascade_delete(tables, "projects", F.col("projectcode") == "p")
    assert {k: v.count() for k, v in left.items()} == {
        "projects": 1, "samples": 2, "spectra_info": 1, "spectra_data": 1, "trait_data": 1,
    }
    assert {k: v.count() for k, v in removed.items()} == {
        "projects": 1, "samples": 1, "spectra_info": 1, "spectra_data": 2, "trait_data": 1,
    }


# --- quality ------------------------------------------------------------------------------------------
def test_audits(spark):
    tables = {
        "sites": spark.createDataFrame([("a",), ("a",), (None,), (None,)], "sitecode string"),
        "plots": spark.createDataFrame([("p", "a"), ("q", "z"), ("r", "z"), ("s", None)], "plotcode string, sitecode string"),
        "spectra_data": spark.createDataFrame(
            [(1, 0.0), (None, 350.0), (1, None), (1, -2.0)], "spectraid int, wavelength double"
        ),
    }
    unique = {r.table_name: (r.n_keys, r.n_extra_rows) for r in quality.audit_unique(tables).collect()}
    assert unique == {"sites": (1, 1), "plots": (0, 0), "spectra_data": (0, 0)}
    orphans = quality.audit_orphans(tables).collect()
    assert [(r.table_name, r.column_name, r.n_rows, r.n_keys) for r in orphans] == [("plots", "sitecode", 2, 1)]
    assert [r.n_null for r in quality.audit_not_null(tables).collect()] == [1]
    assert [r.n_bad for r in quality.audit_positive(tables).collect()] == [2]


def test_spectrum_contract(spark):
    df = spark.createDataFrame([(1.0, 350)], "value double, wavelength int")
    assert quality.spectrum_contract(df).columns == ["wavelength", "value"]
    with pytest.raises(ValueError, match="wavelength"):
        quality.spectrum_contract(df.drop("wavelength"))
    with pytest.raises(ValueError, match="numeric"):
        quality.spectrum_contract(df.withColumn("name", F.lit("x")))


def test_counts_and_codes(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "f string")
    b = spark.createDataFrame([(1,), (2,)], "d int")
    quality.require_counts_match(a, "f", b, "d")
    with pytest.raises(ValueError):
        quality.require_counts_match(a, "f", b.where("d = 1"), "d")
    known = spark.createDataFrame([("x", "p")], "f string, projectcode string")
    s = a.withColumn("projectcode", F.lit("p"))
    assert rows(quality.unresolved_codes(s, "f", known, "projectcode")) == [("p", "y")]


def test_schema_has_fourteen_tables_and_attributes():
    assert len(TABLES) == 15
    assert TABLES["spectra_data"].unique == (("spectraid", "wavelength"),)
    assert np.all([ref in TABLES for t in TABLES.values() for _, ref in t.refs])


def test_pivot_refuses_repeated_values(spark):
    from foliar.operators.reshape import pivot

    df = spark.createDataFrame([(1, "t", 1.0), (1, "t", 2.0)], "k int, name string, v double")
    with pytest.raises(Exception, match="repeats within a key"):
        pivot(df, ["k"], "name", "v", ["t"]).collect()
    assert [tuple(r) for r in pivot(df.limit(1), ["k"], "name", "v", ["t", "u"]).collect()] == [(1, df.first().v, None)]


@pytest.mark.parametrize("null_safe", [True, False])
def test_full_join_reads_each_side_twice_and_keeps_all_rows(spark, tmp_path, null_safe):
    left = [*LEFT, (7, None), (7, "f")]
    right = [*RIGHT, (4, "u"), (8, None)]
    spark.createDataFrame(left, "k int, l string").write.parquet(str(tmp_path / "left"))
    spark.createDataFrame(right, "k int, r string").write.parquet(str(tmp_path / "right"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = joins.join(spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right")), ["k"], "full", null_safe=null_safe)
        got = rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    if null_safe:
        want = brute_join(left, right, "full")
    else:
        # A missing key is like no other key, on either side.
        named = [(k if k is not None else f"left {i}", v) for i, (k, v) in enumerate(left)], [(k if k is not None else f"right {i}", v) for i, (k, v) in enumerate(right)]
        plain = [(None if isinstance(k, str) else k, a, b) for k, a, b in brute_join(*named, "full")]
        want = sorted(plain, key=lambda t: [(x is not None, str(x)) for x in t])
    assert got == want
    assert plan.count("FileScan") <= 4 and plan.count(" Exchange hashpartitioning") <= 4


# --- work dealt out by pairs --------------------------------------------------------------------------
def test_spread_join_is_a_left_join(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_PAIRS", 16)
    left = spark.createDataFrame([(k, i % 7) for i in range(40) for k in ("a", None)] + [("b", 1), ("b", 1), ("c", None)], "k string, x int")
    right = spark.createDataFrame([(k, i % 5) for i in range(11) for k in ("a", None)] + [("b", None), ("z", 9)], "k string, y int")
    out = joins.spread_join(left, right, ["k"], cell=(3, 2))
    want = joins.join(left, right, ["k"], "left")
    assert out.columns == want.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    for a, b in ((left, right.where("false")), (left.where("false"), right)):
        assert joins.spread_join(a, b, ["k"]).count() == a.count()


def test_species_match_of_one_name_runs_in_several_tasks(spark):
    usda = spark.range(2500).coalesce(1).select(F.col("id").alias("code"), F.lit("a").alias("genus"), F.lit("b").alias("species"), F.lit(None).cast("string").alias("scientificname"))
    names = spark.range(2500).coalesce(1).select(F.lit("a b").alias("AccSpeciesName"), F.col("id").alias("AccSpeciesID"))
    per_task = match_species(usda, names).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 2500**2 and len(per_task) > 1


def test_species_match_rate_builds_no_pairs(spark):
    n = 300_000
    usda = spark.range(n).select(F.lit("a").alias("genus"), F.lit("b").alias("species"), F.lit(None).cast("string").alias("scientificname"))
    more = spark.createDataFrame([(None, None, None), ("c", "d", None)], "genus string, species string, scientificname string")
    names = spark.range(n).select(F.lit("a b").alias("AccSpeciesName"), F.col("id").alias("AccSpeciesID"))
    names = names.unionByName(spark.createDataFrame([(None, 1), (None, None), ("a b", None), ("x", 2)], "AccSpeciesName string, AccSpeciesID long"))
    row = match_rate(usda.unionByName(more), names).first()
    # n rows meet n + 1 ids, one of them missing; the missing name meets two; the other name none.
    assert (row.n_match, row.n_total) == (n * n + 1, n * (n + 1) + 2 + 1)
    empty = match_rate(usda.where("false"), names).first()
    assert tuple(empty) == (0, 0, None)


def test_ledger_holds_a_count_per_reference_of_one_parent(spark):
    codes = [("1:a",), ("0:b",), (None,)]
    tables = {
        "projects": spark.createDataFrame([("p",)], "projectcode string"),
        "species": spark.createDataFrame([("1:a",)], "speciescode string"),
        "species_dict": spark.createDataFrame([("p", *c) for c in codes], "projectcode string, speciescode string"),
        "samples": spark.createDataFrame([(None, "s", "x", *c) for c in codes], "projectcode string, samplecode string, plotcode string, speciescode string"),
    }
    ledger, refs = quality.key_ledger(tables)
    assert ledger.columns == ["key", "known", "n_0", "n_1"] and len(refs) == 4
    bad = {(r.table_name, r.column_name): (r.n_rows, r.n_keys) for r in quality.audit_orphans(tables).collect()}
    assert bad == {("species_dict", "projectcode"): (0, 0), ("species_dict", "speciescode"): (1, 1), ("samples", "projectcode"): (0, 0), ("samples", "speciescode"): (1, 1)}


def test_trait_pairs_weigh_repeated_codes(spark):
    tables = {
        "samples": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "samplecode string"),
        "spectra_info": spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "samplecode string"),
        "trait_data": spark.createDataFrame([("a", "t"), ("a", "t"), ("a", "u"), ("b", "t"), (None, "t"), ("z", "t")], "samplecode string, trait string"),
    }
    assert [tuple(r) for r in pairs_by_trait(tables).collect()] == [("t", 13), ("u", 6)]


def test_a_session_is_held_to_small_reads(spark):
    for key, most in session.MOST_BYTES.items():
        before = spark.conf.get(key)
        try:
            for given, want in (("64m", most), ("128MB", most), ("1m", "1m"), ("8388608b", "8388608b")):
                spark.conf.set(key, given)
                assert session.configure(spark).conf.get(key) == want
        finally:
            spark.conf.set(key, before)
