"""Every registered query against its SQL in DuckDB, and the shape of key plans."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from foliar.checks.registry import JOBS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, duck, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(JOBS) <= set(entry.queries()) and set(JOBS) <= set(entry.oracle_sql())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered(spark):
    text = plan(entry.queries()["recursive_scan_exclude"](spark, SF))
    assert "file_path" in text
    text = plan(entry.queries()["report_missing_species"](spark, SF))
    assert "o_totalprice" not in text
    text = plan(entry.queries()["report_attribute_distribution"](spark, SF))
    assert "PushedFilters: [IsNotNull(p_size), GreaterThanOrEqual(p_size,10)" in text


@pytest.mark.parametrize(
    "name",
    [
        "full_outer_natural", "multiway_full_join", "null_safe_join", "update_join", "report_pairs_by_trait",
        "report_by_location", "resolve_species", "append_spectra", "collapse_duplicates", "window_mean_date",
        "wide_to_long_spectra", "parse_coded_name", "convert_units", "head_tail", "pack_spectra",
    ],
)
def test_plans_stay_in_the_engine(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "FullOuter"):
        assert node not in text, node


def test_multiway_full_join_is_one_aggregate(spark):
    text = plan(entry.queries()["multiway_full_join"](spark, SF))
    assert "Join" not in text


def test_wide_to_long_has_no_shuffle(spark):
    text = plan(entry.queries()["wide_to_long_spectra"](spark, SF))
    assert "Exchange" not in text and "Expand" not in text


def test_resampling_packed_spectra_has_no_shuffle(spark):
    from pyspark.sql import functions as F

    from foliar.operators.resample import resample_packed

    packed = spark.range(3).select("id", F.array(F.lit(1.0), F.lit(2.5)).alias("wavelengths"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    assert "Exchange" not in plan(resample_packed(packed, ["id"], {"r": "v"}))


def test_no_singleton_partition_windows(spark):
    for name in ("fill_down", "row_number_group", "block_label", "assign_surrogate_ids", "row_number_global"):
        text = plan(entry.queries()[name](spark, SF))
        assert not ("Window" in text and "SinglePartition" in text), name
