"""What the whole build is given, on rows of its own."""

import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from foliar.checks import loads
from foliar.checks.analog import Views
from foliar.checks.registry import JOBS, SQL_TEXT
from foliar.session import side_by_side
from foliar.sources.catalog import PROJECT, Catalog

PARTS = [(1, "small plant", "B#1", "SMALL", 3), (2, "red tree", "B#2", "LARGE", 10), (3, "blue herb", "B#3", "LARGE", 47), (4, "no size", "B#4", "SMALL", None)]


class Reached(Exception):
    pass


def test_attributes_of_every_part_go_into_the_build(spark, tmp_path, monkeypatch):
    spark.createDataFrame(PARTS, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    given = {}

    def build(catalog, reference, projects):
        given.update(reference)
        raise Reached

    monkeypatch.setattr(loads, "build_catalog", build)
    with pytest.raises(Reached):
        JOBS["whole_build"](Views(spark, str(tmp_path)))
    rows = given["attributes"].select("speciescode", "ps_type", "myco_asso", "shade_tolerance").orderBy("speciescode").collect()
    assert [tuple(r) for r in rows] == [("SP1", "C3", "small", "b#1"), ("SP2", "C3", "red", "b#2"), ("SP3", None, "blue", "b#3"), ("SP4", None, "no", "b#4")]
    assert "select 'species_attributes', cast(count(*) as bigint) from part" in SQL_TEXT["whole_build"]


def test_projects_side_by_side_write_a_fact_table_in_turn(spark, tmp_path, monkeypatch):
    """Writes into one folder share its temporary files, which go when any of them ends."""
    catalog = Catalog(spark, str(tmp_path / "catalog"))
    writing, most, real = {}, {}, DataFrameWriter.parquet

    def parquet(self, path, *args, **named):
        writing[path] = writing.get(path, 0) + 1
        most[path] = max(most.get(path, 0), writing[path])
        time.sleep(2)
        real(self, path, *args, **named)
        writing[path] -= 1

    def rows(project):
        named = {"traitdataid": F.col("id"), "samplecode": F.concat(F.lit(f"{project}|"), "id"), "trait": F.lit("t"), "traitvalue": F.lit(1.0), "traitdatacomment": F.lit(None).cast("string"), PROJECT: F.lit(project)}
        return spark.range(2).select(*[c.alias(n) for n, c in named.items()])

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    side_by_side(*[lambda p=p: catalog._put("trait_data", rows(p), "append") for p in "ab"])
    assert most == {f"{catalog.root}/trait_data": 1}
    assert sorted(r.samplecode for r in catalog.table("trait_data").collect()) == ["a|0", "a|1", "b|0", "b|1"]
