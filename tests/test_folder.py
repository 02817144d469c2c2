"""Folders of files with headers of their own, and the ledger of what was read."""

import pytest
from conftest import rows

from foliar.session import small_table
from foliar.sources.folder import read_folder, require_files


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_columns_by_each_files_own_header(spark, tmp_path):
    write(tmp_path / "x/a.csv", 'id,name,Wave_350,Wave_351\n1,"b, ""c""",0.1,0.2\n\n2,NA,bad,\n')
    write(tmp_path / "y/a.csv", "﻿Wave_351.5,id,extra\n0.3,x3,9\n")
    write(tmp_path / "y/b.csv", "other\n1\n")
    write(tmp_path / "no/a.csv", "id\n7\n")
    f = read_folder(spark, str(tmp_path), name="^a.csv$", exclude="/no/", sep=",")
    assert rows(f.table({"id": "int", "name": "string", "none": "double"})) == rows(small_table(spark, "a int, b string, c double", [(1, 'b, "c"', None), (2, None, None), (None, None, None)]))
    packed = {r.id: (r.wavelengths, r.spectravalues) for r in f.packed("Wave_", {"id": "string"}).collect()}
    assert packed == {"1": ([350.0, 351.0], [0.1, 0.2]), "2": ([350.0, 351.0], [None, None]), "x3": ([351.5], [0.3])}
    ledger = {r.path.split("/")[1]: (r.lines, r.wrong_width, r.cells, r.missing, r.refused) for r in f.ledger("s", "^(id|Wave_.*)$").collect()}
    assert ledger == {"x": (2, 0, 8, 2, 1), "y": (1, 0, 3, 0, 1)}


def test_sample_columns_long_and_lines_of_another_width(spark, tmp_path):
    write(tmp_path / "a.dat", "band wavelength S1 S2\n1 400 0.1 -1\n2 402 0.2\n3 404 0.2 0.3 0.4\n")
    write(tmp_path / "b.dat", "wavelength,S3\n400,x\n")
    write(tmp_path / "c.dat", "wavelength,S4\n")
    write(tmp_path / "d.dat", "")  # no bytes: not seen
    f = read_folder(spark, str(tmp_path), pattern="*.dat")
    assert rows(f.long("wavelength", "s", "v", ["band"]).drop("file")) == rows(
        small_table(spark, "w double, s string, v double", [(400.0, "S1", 0.1), (400.0, "S2", -1.0), (402.0, "S1", 0.2), (404.0, "S1", 0.2), (404.0, "S2", 0.3), (400.0, "S3", None)])
    )
    ledger = {r.path[1:]: (r.bytes > 0, r.lines, r.wrong_width, r.cells, r.refused) for r in f.ledger("s", "^S").collect()}
    assert ledger == {"a.dat": (True, 3, 2, 12, 0), "b.dat": (True, 1, 0, 2, 1), "c.dat": (True, 0, 0, 0, 0)}


def test_files_without_header_and_missing_files(spark, tmp_path):
    write(tmp_path / "r1.txt", "400 0.5\n401\t0.6\n")
    f = read_folder(spark, str(tmp_path), names=["wavelength", "value"])
    assert rows(f.table({"wavelength": "double", "value": "double"})) == [(400.0, 0.5), (401.0, 0.6)]
    require_files(small_table(spark, "f string", [("r1.txt",), (None,)]), "f", f)
    with pytest.raises(ValueError, match="r2.txt"):
        require_files(small_table(spark, "f string", [("r1.txt",), ("r2.txt",)]), "f", f)


def test_headers_that_do_not_serve_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b,a\n1,2,3\n")
    with pytest.raises(ValueError, match="repeats"):
        read_folder(spark, str(tmp_path))
    write(tmp_path / "z/a.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="without"):
        read_folder(spark, str(tmp_path / "z")).long("wavelength", "s", "v")


def test_one_scan_and_layouts_not_files_are_joined(spark, tmp_path):
    for i in range(5):
        write(tmp_path / f"{i}.csv", f"id,Wave_{350 + i % 2}\n{i},0.{i}\n")
    f = read_folder(spark, str(tmp_path), sep=",")
    assert f.layouts.count() == 2
    text = f.packed("Wave_", {"id": "int"})._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 2 and "FileScan text" not in text and "Exchange hashpartitioning" not in text
