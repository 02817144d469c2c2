"""Session settings and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the jobs rely on; all of them can be changed at run time.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs one more shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Packed spectra are wide rows: some 35 kB each, so a batch of them stays small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.session.timeZone": "UTC",
}

# Rows are some ten bytes in a file and a few hundred in a task's tables of keys, so a task reads little:
# what it holds does not grow with the tables. A session that asks for less keeps that.
MOST_BYTES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in MOST_BYTES.items():
        if size(spark.conf.get(key)) > size(most):
            spark.conf.set(key, most)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliar")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_table(spark: SparkSession, schema: T.StructType | str, rows: Sequence[tuple]) -> DataFrame:
    """A driver-side table of a few rows, which Spark knows the size of."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def side_by_side(*steps: Callable[[], object], at_once: int = 4) -> None:
    """Run steps that each start their own Spark jobs, ``at_once`` of them at a time; the first error is raised.

    The driver holds the plans of all steps that run.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


_LOCAL_ROOT: list[str] = []
# The folder of each stored table.
_PLACES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a session on one machine may go without: it gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="foliar-"))
    return _LOCAL_ROOT[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, so columns that
    depend on the physical layout (row positions) keep their values on retries.
    ``codec`` is the compression where the session's own is not wanted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PLACES[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove the files of stored tables that no later step reads; any other table is left alone."""
    for table in tables:
        path = _PLACES.pop(table, None)
        if path:
            spark = table.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
