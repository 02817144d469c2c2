import pytest
from conftest import rows
from pyspark.sql import functions as F

from foliar.session import small_table
from foliar.sources.catalog import Catalog
from foliar.sources.files import drop_header_lines, read_csv, read_delimited, read_lines, read_tree, with_file
from foliar.sources.layouts import bind_columns, header_to_long, sectioned


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_with_na_and_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", 'code,note,ok,x\nA,"p, q",TRUE,1.5\nNA,NA,FALSE,NA\n')
    df = read_csv(spark, str(tmp_path / "a.csv"), "code string, note string, ok boolean, x double")
    assert rows(df) == [(None, None, False, None), ("A", "p, q", True, 1.5)]


def test_folder_scan_keeps_file_names(spark, tmp_path):
    write(tmp_path / "x_chem.csv", "id\n1\n")
    write(tmp_path / "y_chem.csv", "id\n2\n")
    write(tmp_path / "z.txt", "id\n3\n")
    df = with_file(read_csv(spark, str(tmp_path), "id int", pattern="*chem.csv"))
    assert rows(df) == [(1, "x_chem.csv"), (2, "y_chem.csv")]


def test_tree_scan_with_exclusion(spark, tmp_path):
    write(tmp_path / "a/Averaged.csv", "id\n1\n")
    write(tmp_path / "Canopy/b/Averaged.csv", "id\n2\n")
    write(tmp_path / "a/other.csv", "id\n3\n")
    df = read_tree(spark, str(tmp_path), "Averaged.csv", "id int", exclude="(?i)/canopy/")
    assert [r.id for r in df.collect()] == [1]


def test_delimited_text(spark, tmp_path):
    write(tmp_path / "s1.txt", "350.0\t0.1\n  351   n/a\n\n352 0.3 9\n")
    df = read_delimited(spark, str(tmp_path / "s1.txt"), ["wavelength", "v"])
    assert rows(df.drop("file")) == [(350.0, 0.1), (351.0, None), (352.0, 0.3)]


PIGMENTS = "chla chlb\ngf-oz1 gf-oz1\n1 2\n3 4\nmk-rand mk-rand\n5 6\n7 NA\n"


@pytest.mark.parametrize("block", [None, "4"])
def test_sectioned_file(spark, tmp_path, block):
    write(tmp_path / "all_pig.txt", PIGMENTS)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if block:  # several splits of one file, so order comes from the file offsets
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        lines = drop_header_lines(read_lines(spark, str(tmp_path)), ["chla", "chlb"])
        df = sectioned(lines, ["chla", "chlb"], ["file"], ["block", "row"])
        assert rows(df.select("info", "chla", "chlb")) == [
            ("gf-oz1", 1.0, 2.0), ("gf-oz1", 3.0, 4.0), ("mk-rand", 5.0, 6.0), ("mk-rand", 7.0, None),
        ]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_section_header_needs_one_label(spark, tmp_path):
    write(tmp_path / "p.txt", "a b\n1 2\n")
    with pytest.raises(ValueError, match="more than one label"):
        sectioned(read_lines(spark, str(tmp_path)), ["x", "y"], ["file"], ["block", "row"])


def test_columns_bound_by_position(spark, tmp_path):
    write(tmp_path / "m/b.csv", "350,0.3,0.4\n")
    write(tmp_path / "m/a.csv", "0,9,9\n350,0.1,NA\n351,0.2,0.5\n")
    samples = small_table(spark, "doy int, s string, n int", [(120, "x1", 1), (120, "x2", 2), (200, "z9", 1), (200, "y1", 2)])
    df = bind_columns(read_lines(spark, str(tmp_path / "m")), samples, "doy", "s", ["n"])
    assert rows(df) == [
        ("x1", 350.0, 0.1), ("x1", 351.0, 0.2), ("x2", 351.0, 0.5), ("y1", 350.0, 0.4), ("z9", 350.0, 0.3),
    ]


def test_files_with_their_own_headers(spark, tmp_path):
    write(tmp_path / "a.dat", "band wavelength S1 S2\n1 400 0.1 -1\n2 402 0.2 0.3\n")
    write(tmp_path / "b.dat", "band,wavelength,S3\n1,400,0.9\n")
    df = header_to_long(read_lines(spark, str(tmp_path)), "wavelength", "s", "v", skip=("band",))
    assert rows(df.drop("file")) == [
        (400.0, "S1", 0.1), (400.0, "S2", -1.0), (400.0, "S3", 0.9), (402.0, "S1", 0.2), (402.0, "S2", 0.3),
    ]


def test_catalog(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    assert catalog.table("sites").isEmpty()
    values = small_table(spark, "sitecode string, extra int", [("a", 1), ("b", 2)])
    ids = catalog.merge("sites", values, ["sitecode"])
    assert sorted((r.sitecode, r.extra) for r in ids.collect()) == [("a", 1), ("b", 2)]
    assert {r.siteid for r in ids.collect()} == {1, 2}
    catalog.add("sites", values.unionByName(small_table(spark, "sitecode string, extra int", [("c", 3)])), ["sitecode"])
    assert sorted(r.siteid for r in catalog.table("sites").collect()) == [1, 2, 3]
    catalog.replace("sites", catalog.table("sites").where("sitecode = 'b'"))
    assert [r.sitecode for r in catalog.table("sites").collect()] == ["b"]
    points = small_table(spark, "spectraid bigint, wavelength double, spectravalue double", [(1, 350.0, 0.1), (1, 351.0, 0.2)])
    catalog.add_spectra(points)
    catalog.add_spectra(points.unionByName(points.withColumn("spectraid", F.lit(2))), points.select("spectraid"))
    assert catalog.table("spectra_data").count() == 4
    assert catalog.table("spectra_data").select("spectradataid").distinct().count() == 4
    catalog.reset()
    assert all(df.isEmpty() for df in catalog.tables().values())


def test_unfinished_batches_are_invisible(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    catalog.replace("sites", small_table(spark, "sitecode string", [("a",)]))
    half = tmp_path / "sites/v000001/b000001"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half written")
    assert [r.sitecode for r in catalog.table("sites").collect()] == ["a"]


def test_files_that_do_not_fit_are_refused(spark, tmp_path):
    write(tmp_path / "m/a.csv", "350,0.1,0.2,0.3\n")
    lines = read_lines(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="as many files"):
        bind_columns(lines, small_table(spark, "doy int, s string, n int", [(1, "a", 1), (2, "b", 1)]), "doy", "s", ["n"])
    write(tmp_path / "h/a.dat", "band wl S1\n1 400 0.1\n")
    with pytest.raises(ValueError, match="no column"):
        header_to_long(read_lines(spark, str(tmp_path / "h")), "wavelength", "s", "v")
    write(tmp_path / "w/a.dat", "wavelength S1\n400 0.1 0.2\n")
    with pytest.raises(ValueError, match="another width"):
        header_to_long(read_lines(spark, str(tmp_path / "w")), "wavelength", "s", "v")


def test_matrices_of_another_width_than_their_day_are_refused(spark, tmp_path):
    samples = small_table(spark, "doy int, s string, n int", [(1, "a", 1), (1, "b", 2), (2, "c", 1)])
    for name, first in (("short", "350,0.1\n"), ("long", "350,0.1,0.2,0.3\n"), ("ragged", "350,0.1,0.2\n351,0.1\n")):
        write(tmp_path / name / "a.csv", first)
        write(tmp_path / name / "b.csv", "350,0.4\n\n")
        with pytest.raises(ValueError, match="as many cells"):
            bind_columns(read_lines(spark, str(tmp_path / name)), samples, "doy", "s", ["n"])
    write(tmp_path / "fit/a.csv", "350,0.1,\n")
    write(tmp_path / "fit/b.csv", "350,0.4\n\n")
    assert rows(bind_columns(read_lines(spark, str(tmp_path / "fit")), samples, "doy", "s", ["n"])) == [("a", 350.0, 0.1), ("c", 350.0, 0.4)]
