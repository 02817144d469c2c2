"""The catalog's facts by project: what merges read, what deletes touch, and spectra appended one row each."""

import os
import re

import pytest
from pyspark.sql import functions as F

from foliar.operators import ordered
from foliar.operators.merge import insert_if_absent, tee
from foliar.operators.ordered import row_number_any
from foliar.operators.quality import audit_orphans
from foliar.plans.batch import Batch, first_of
from foliar.plans.build import export_together, read_export
from foliar.session import side_by_side, small_table
from foliar.sources.catalog import PACKED, SPECTRUM_KEY, Catalog, project_of

SAMPLES = [("a|1|2000", "a", "X"), ("a|2|2000", "a", "Y"), ("b|1|2001", "b", "X"), ("c d/e|1|NA", "c d/e", "Y"), ("loose", None, None)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def packed(spark, *spectra):
    """Spectra (samplecode, type, first value, points)."""
    data = [(code, kind, None, None, [350.0 + i for i in range(n)], [first + i for i in range(n)]) for code, kind, first, n in spectra]
    schema = "samplecode string, spectratype string, sampleprep string, spectracomment string, wavelengths array<double>, spectravalues array<double>"
    return spark.createDataFrame(data, schema)


def info(df):
    return df.select(*SPECTRUM_KEY)


@pytest.fixture()
def catalog(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "catalog"))
    c.reset()
    c.add("projects", small_table(spark, "projectcode string", [("a",), ("b",), ("c d/e",)]), ["projectcode"])
    c.add("species", small_table(spark, "speciescode string", [("X",), ("Y",)]), ["speciescode"])
    c.add("samples", small_table(spark, "samplecode string, projectcode string, speciescode string", SAMPLES), ["samplecode"])
    traits = [(s, t, 1.0) for s, *_ in SAMPLES for t in ("t1", "t2")]
    c.add("trait_data", small_table(spark, "samplecode string, trait string, traitvalue double", traits), ["samplecode", "trait"])
    p = packed(spark, *[(s, "r", i * 10.0, 3) for i, (s, *_) in enumerate(SAMPLES)])
    c.add_packed(p, info(p))
    return c


def files(catalog, table):
    """Path -> time stamp of a table's data files, by project folder."""
    out = {}
    for folder, _, names in os.walk(f"{catalog.root}/{table}"):
        out |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


def points(catalog):
    data = catalog.table("spectra_data").join(catalog.table("spectra_info"), "spectraid")
    return sorted((r.samplecode, r.spectratype, r.wavelength, r.spectravalue) for r in data.collect())


def test_facts_lie_by_project(catalog):
    folders = {p.split("project=")[1].split("/")[0] for p in files(catalog, "samples")}
    assert folders == {"a", "b", "c d%2Fe", "__HIVE_DEFAULT_PARTITION__"}
    assert sorted(r.samplecode for r in catalog.facts("samples", ["c d/e"]).collect()) == ["c d/e|1|NA"]
    assert sorted(r.samplecode for r in catalog.facts("samples", [None, "b"]).collect()) == ["b|1|2001", "loose"]
    assert catalog.table("spectra_data").count() == 15 and len(points(catalog)) == 15
    assert sorted(r.sampleid for r in catalog.table("samples").collect()) == [1, 2, 3, 4, 5]


def test_a_merge_reads_its_own_project_only(spark, catalog):
    before = files(catalog, "trait_data")
    more = small_table(spark, "samplecode string, trait string, traitvalue double", [("b|1|2001", "t1", 9.0), ("b|1|2001", "t3", 2.0)])
    target = catalog.facts("trait_data", ["b"])
    merged = insert_if_absent(target, more.withColumn("project", project_of("samplecode")), ["samplecode", "trait"], None, "error")
    text = plan(merged.inserted)
    assert re.search(r"PartitionFilters: \[[^]]*project#\d+ = b\)", text)
    # Nothing of the other projects is opened.
    for path in before:
        if "project=b" not in path:
            os.rename(path, path + ".away")
    catalog.add("trait_data", more, ["samplecode", "trait"])
    for path in before:
        if "project=b" not in path:
            os.rename(path + ".away", path)
    after = files(catalog, "trait_data")
    assert all(after[p] == t for p, t in before.items())
    rows = catalog.table("trait_data")
    assert rows.count() == 11 and rows.where("trait = 't3'").first().traitvalue == 2.0
    assert sorted(r.traitdataid for r in rows.collect()) == list(range(1, 12))


def test_delete_leaves_the_files_of_other_projects(catalog):
    tables = ("samples", "trait_data", "spectra_info", "spectra_data")
    before = {t: files(catalog, t) for t in tables}
    catalog.delete("projects", F.col("projectcode") == "c d/e")
    for t in tables:
        after = files(catalog, t)
        assert all(after[p] == stamp for p, stamp in before[t].items() if "project=c d" not in p)
        assert catalog.facts(t, ["c d/e"]).count() == 0
    assert [r.projectcode for r in catalog.table("projects").orderBy("projectcode").collect()] == ["a", "b"]
    assert catalog.table("samples").count() == 4 and catalog.table("spectra_data").count() == 12
    # Ids are not given twice.
    p = packed(catalog.spark, ("c d/e|1|NA", "r", 7.0, 2))
    catalog.add_packed(p, info(p))
    assert catalog.table("spectra_info").select("spectraid").distinct().count() == 5 == catalog.table("spectra_info").count()
    assert [x for x in points(catalog) if x[0].startswith("c d")] == [("c d/e|1|NA", "r", 350.0, 7.0), ("c d/e|1|NA", "r", 351.0, 8.0)]


def test_delete_by_a_shared_parent_keeps_the_rest_of_each_project(catalog):
    catalog.delete("species", F.col("speciescode") == "X")
    assert sorted(r.samplecode for r in catalog.table("samples").collect()) == ["a|2|2000", "c d/e|1|NA", "loose"]
    assert {x[0] for x in points(catalog)} == {"a|2|2000", "c d/e|1|NA", "loose"} and catalog.table("trait_data").count() == 6
    assert catalog.table("spectra_data").count() == 9
    catalog.delete("samples", F.col("samplecode") == "loose")
    assert catalog.table("samples").count() == 2 and catalog.facts("spectra_data", [None]).count() == 0


def test_spectra_are_appended_once(spark, catalog):
    first = points(catalog)
    again = packed(spark, *[(s, "r", 99.0, 4) for s, *_ in SAMPLES], ("a|1|2000", "t", 5.0, 2), ("new|1|2", "r", 6.0, 1), ("bare|1|2", "r", 0.0, 0))
    extra = small_table(spark, "samplecode string, spectratype string, sampleprep string, spectracomment string", [("only|info|1", "r", None, None)])
    catalog.add_packed(again, info(again).unionByName(extra))
    assert points(catalog) == sorted([*first, ("a|1|2000", "t", 350.0, 5.0), ("a|1|2000", "t", 351.0, 6.0), ("new|1|2", "r", 350.0, 6.0)])
    ids = [r.spectraid for r in catalog.table("spectra_info").collect()]
    assert len(ids) == len(set(ids)) == 9
    keys = catalog.table("spectra_data").select("spectradataid")
    assert keys.distinct().count() == keys.count()
    catalog.add_packed(again, info(again))
    assert len(points(catalog)) == 18


def test_a_load_that_ended_before_its_points_is_completed(spark, catalog):
    p = packed(spark, ("b|7|2001", "r", 1.0, 2), ("b|8|2001", "r", 3.0, 1))
    put = catalog._put

    def fail(name, *more):
        if name == "spectra_data":
            raise RuntimeError("lost")
        put(name, *more)

    catalog._put = fail
    with pytest.raises(RuntimeError):
        catalog.add_packed(p, info(p))
    catalog._put = put
    ids = {r.samplecode: r.spectraid for r in catalog.table("spectra_info").collect()}
    more = p.unionByName(packed(spark, ("b|9|2001", "r", 4.0, 1)))
    catalog.add_packed(more, info(more))
    assert {r.samplecode: r.spectraid for r in catalog.table("spectra_info").collect()}.items() > ids.items()
    assert [x for x in points(catalog) if x[0] in ("b|7|2001", "b|8|2001", "b|9|2001")] == [
        ("b|7|2001", "r", 350.0, 1.0), ("b|7|2001", "r", 351.0, 2.0), ("b|8|2001", "r", 350.0, 3.0), ("b|9|2001", "r", 350.0, 4.0),
    ]


def test_no_exchange_carries_points(spark, catalog):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = packed(spark, ("z|1|1", "r", 1.0, 2), ("z|2|1", "r", 1.0, 2))
        numbered = row_number_any(p.select(*SPECTRUM_KEY, *PACKED), "__n", 100)
        known = spark.createDataFrame([], "__n long, spectraid long")
        new = catalog.points(catalog._with_ids(numbered, known, ["z"]))
        assert sorted({r.spectraid for r in new.collect()}) == [100, 101]
        text = plan(new)
        assert "Generate" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batches_that_do_not_fit_are_refused(spark, catalog):
    p = packed(spark, ("a|9|1", "r", 1.0, 1))
    with pytest.raises(ValueError, match="without a row"):
        catalog.add_packed(p, info(packed(spark, ("a|8|1", "r", 1.0, 1))))
    with pytest.raises(ValueError, match="repeats"):
        catalog.add_packed(p, info(p).unionByName(info(p)))
    with pytest.raises(ValueError, match="samplecode"):
        catalog.add("trait_data", small_table(spark, "trait string", [("t",)]), ["trait"])


def test_dimension_rows_of_several_batches(spark):
    a = small_table(spark, "k string, v int", [("x", 1), ("y", 2)])
    b = small_table(spark, "k string, w int", [("y", 7), ("z", 8), (None, 9)])
    got = {r.k: (r.v, r.w) for r in first_of([a, b], ["k"]).collect()}
    assert got == {"x": (1, None), "y": (2, None), "z": (None, 8), None: (None, 9)}
    with pytest.raises(ValueError, match="repeats"):
        first_of([a, b.unionByName(b)], ["k"])


def test_facts_of_several_projects_load_side_by_side(spark, catalog):
    more = [small_table(spark, "samplecode string, trait string, traitvalue double", [(f"{p}|{i}|1", "t", 1.0) for i in range(50)]) for p in "pqrs"]
    side_by_side(*[lambda df=df: catalog.add("trait_data", df, ["samplecode", "trait"]) for df in more])
    ids = sorted(r.traitdataid for r in catalog.table("trait_data").collect())
    assert ids == list(range(1, 211))


def test_audit_reads_each_table_once(spark, catalog):
    tables = {n: catalog.table(n) for n in ("projects", "species", "samples", "spectra_info", "spectra_data", "trait_data")}
    ledger = audit_orphans(tables)
    text = plan(ledger)
    assert text.count("FileScan parquet") == len(tables) and text.count("Exchange hashpartitioning") == 1
    bad = {(r.table_name, r.column_name): (r.n_rows, r.n_keys) for r in ledger.collect()}
    assert set(bad.values()) == {(0, 0)} and len(bad) == 5
    tables["species"] = tables["species"].where("speciescode <> 'X'")
    bad = {(r.table_name, r.column_name): (r.n_rows, r.n_keys) for r in audit_orphans(tables).collect()}
    assert bad["samples", "speciescode"] == (2, 1) and bad["trait_data", "samplecode"] == (0, 0)


def test_tee_counts_on_the_way(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    t = tee(df, lambda d: d.select("k").distinct(), str(tmp_path / "side"))
    assert (t.n_main, t.n_side, t.main.count(), sorted(r.k for r in t.side.collect())) == (10, 3, 10, [0, 1, 2])
    empty = tee(df.where("false"), lambda d: d.select("k"), str(tmp_path / "none"))
    assert (empty.n_main, empty.n_side) == (0, 0)


def test_reports_are_exported_in_one_job(spark, tmp_path):
    a = small_table(spark, "k string, n bigint", [("x", 1), (None, 2)])
    b = small_table(spark, "y int, m double", [(2001, 0.25)])
    export_together({"a": a, "b": b}, str(tmp_path / "out"))
    back = read_export(spark, str(tmp_path / "out"), {"a": a.schema, "b": b.schema})
    assert sorted(map(tuple, back["a"].collect()), key=str) == [("x", 1), (None, 2)] and back["b"].first()[:] == (2001, 0.25)


def test_replaced_facts_may_come_from_themselves(catalog):
    catalog.replace("trait_data", catalog.table("trait_data").where("trait = 't1'"))
    assert catalog.table("trait_data").count() == 5 and catalog.facts("trait_data", ["a"]).count() == 2
    catalog.replace("spectra_data", catalog.table("spectra_data").where("wavelength = 350"))
    assert catalog.facts("spectra_data", ["a"]).count() == 2 and catalog.table("spectra_data").count() == 5


def counted(spark, df):
    """The rows, and how often any of them was computed."""
    seen = spark.sparkContext.accumulator(0)

    def code(value):
        seen.add(1)
        return value

    once = F.udf(code, "string").asNondeterministic()
    return df.withColumn("samplecode", once("samplecode")).select(*df.columns), seen


def test_a_merge_computes_its_batch_once(spark, catalog):
    more = small_table(spark, "samplecode string, trait string, traitvalue double", [(f"q|{i}|1", "t", 1.0) for i in range(30)])
    rows, seen = counted(spark, more)
    catalog.add("trait_data", rows, ["samplecode", "trait"])
    assert seen.value == 30 and catalog.facts("trait_data", ["q"]).count() == 30


def test_spectra_read_their_info_once(spark, catalog):
    p = packed(spark, *[(f"q|{i}|1", "r", float(i), 2) for i in range(20)])
    bare = info(packed(spark, *[(f"q|{i}|1", "t", 0.0, 1) for i in range(3)]))
    rows, seen = counted(spark, info(p).unionByName(bare))
    catalog.add_packed(p, rows)
    assert seen.value == 23
    added = catalog.facts("spectra_info", ["q"])
    assert sorted(r.spectraid for r in added.collect()) == list(range(6, 29))
    points = catalog.facts("spectra_data", ["q"]).join(added.select("spectraid", "samplecode"), "spectraid").collect()
    assert len(points) == 40 and {int(r.samplecode.split("|")[1]) for r in points if r.spectravalue == 7.0} == {6, 7}


def test_spectra_merge_refuses_repeats_and_strays(spark, catalog):
    p = packed(spark, ("q|1|1", "r", 0.0, 2), ("q|2|1", "r", 0.0, 2))
    for batch, rows, fault in ((p, info(p).unionByName(info(p)), "repeats"), (p.unionByName(p), info(p), "repeats"), (p, info(p).limit(1), "without a row"), (p, info(p).where("false"), "without a row")):
        with pytest.raises(ValueError, match=fault):
            catalog.add_packed(batch, rows)
    assert catalog.facts("spectra_info", ["q"]).isEmpty() and catalog.facts("spectra_data", ["q"]).isEmpty()


def test_facts_of_a_new_project_are_stored_once_before_they_are_put(spark, catalog, monkeypatch):
    labels = []
    keep = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df, label, *codec: labels.append(label) or keep(df, label, *codec))
    rows = small_table(spark, "samplecode string, trait string, traitvalue double", [(f"q|{i}|1", "t", 1.0) for i in range(9)])
    catalog.add("trait_data", rows, ["samplecode", "trait"])
    assert labels == ["segments"]
    catalog.add("trait_data", rows.unionByName(rows.withColumn("trait", F.lit("u"))), ["samplecode", "trait"])
    assert sorted(r.traitdataid for r in catalog.table("trait_data").collect()) == list(range(1, 29))
    with pytest.raises(ValueError, match="repeats"):
        catalog.add("samples", small_table(spark, "samplecode string", [("r|1|1",), ("r|1|1",)]), ["samplecode"])


def test_points_without_their_key_are_packed_by_the_spectrum(spark, catalog):
    points = spark.createDataFrame([(n, 350.0 + i, n + i / 4) for n in (1, 2, 3) for i in (1, 0, 0)], "rawid long, wavelength double, spectravalue double")
    info_rows = spark.createDataFrame([(1, "q|1|1", "r"), (2, "q|2|1", "r"), (4, "q|4|1", "r"), (None, "q|5|1", "r")], "rawid long, samplecode string, spectratype string")
    empty = info_rows.where("false")
    b = Batch(sites=empty, plots=empty, samples=empty, spectra_info=info_rows, spectra=points, spectrum="rawid")
    long = points.join(info_rows, "rawid").drop("rawid")
    plain = Batch(sites=empty, plots=empty, samples=empty, spectra_info=info_rows, spectra=long)
    got, want = (sorted(map(tuple, x.packed_spectra().select(*SPECTRUM_KEY, *PACKED).collect()), key=str) for x in (b, plain))
    assert got == want and len(got) == 2 and got[0][4] == [350.0, 351.0]
    text = plan(b.packed_spectra())
    assert "samplecode" not in "".join(line for line in text.splitlines() if "collect_list" in line)
