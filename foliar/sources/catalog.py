"""The catalog as Parquet folders: append batches, replace, reset, merge and delete.

Facts (``Table.by_project``) lie in one folder per project,
``root/<table>/project=<p>``, p the part of the samplecode before the first
``|``. A merge and a delete read and write the folders of their own projects
only, by partition filters, appends and dynamic partition overwrite; folders of
other projects are not touched. What was read from a folder before must be used
before it is rewritten. Last ids of facts are kept in a small table, so
no merge looks for the largest id.

Other tables are small and replaced as a whole: ``root/<table>/v<version>/b<batch>``,
where a batch counts once Spark has written its ``_SUCCESS`` marker. One writer
per table and project is assumed.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliar.operators.aggregate import duplicate_keys
from foliar.operators.joins import join
from foliar.operators.merge import insert_if_absent, removed_keys, with_ids
from foliar.operators.ordered import row_number_any
from foliar.operators.reshape import pack
from foliar.schema import LINKS, STORED, TABLES, children_of
from foliar.session import empty_table, materialize, side_by_side, small_table

PROJECT = "project"
SPECTRUM_KEY = ["samplecode", "spectratype", "sampleprep", "spectracomment"]
PACKED = ["wavelengths", "spectravalues"]
# Ids of points: the spectrum's id and the place in the spectrum.
POINTS_PER_SPECTRUM = 1 << 20


def project_of(samplecode: Column | str) -> Column:
    """The folder of a sample's facts; codes without a project part share one."""
    return F.when(F.contains(samplecode, F.lit("|")), F.substring_index(samplecode, "|", 1))


class Catalog:
    """Named tables below one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._ids = threading.Lock()
        self._writing = {name: threading.Lock() for name in STORED}

    # --- layout of the small tables ---------------------------------------------
    def _batches(self, name: str) -> tuple[int, list[str]]:
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/v*/b*/_SUCCESS")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [str(s.getPath().getParent().toString()) for s in fs.globStatus(pattern) or []]
        versions = {p: int(re.search(r"/v(\d+)/b\d+$", p).group(1)) for p in found}
        top = max(versions.values(), default=0)
        return top, sorted(p for p, v in versions.items() if v == top)

    def _write(self, name: str, df: DataFrame, version: int, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/v{version:06d}/b{batch:06d}")

    # --- layout of the facts ------------------------------------------------------
    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_table(self.spark, schema)

    def facts(self, name: str, projects: Sequence[str | None] | None = None) -> DataFrame:
        """A fact table with the column ``project``, of the given projects or of all."""
        df = self._read(name, T.StructType([*STORED[name].schema.fields, T.StructField(PROJECT, T.StringType())]))
        if projects is None:
            return df
        named = [p for p in projects if p is not None]
        known = F.col(PROJECT).isin(named) if named else F.lit(False)
        return df.where(known | F.col(PROJECT).isNull() if None in projects else known)

    def _put(self, name: str, df: DataFrame, mode: str, overwrite: str = "static") -> None:
        writer = df.select(*STORED[name].columns, PROJECT).write.mode(mode).option("partitionOverwriteMode", overwrite)
        # Loads that run side by side share the table's folder, and a write that ends clears the temporary files of all.
        with self._writing[name]:
            writer.partitionBy(PROJECT).parquet(f"{self.root}/{name}")

    def _last_id(self, name: str) -> int:
        marks = self._read(f"{name}-ids", T.StructType([T.StructField("last", T.LongType())]))
        return marks.agg(F.max("last").alias("m")).first().m or 0

    def _mark(self, name: str, last: int, mode: str = "append") -> None:
        """Ids up to ``last`` are taken. Written before the rows, so a job that dies leaves a gap and no repeated id."""
        small_table(self.spark, "last bigint", [(last,)]).coalesce(1).write.mode(mode).parquet(f"{self.root}/{name}-ids")

    def _reserve(self, name: str, n: int) -> int:
        """Take ``n`` ids for loads that may run side by side in this driver; the id before the first of them."""
        with self._ids:
            last = self._last_id(name)
            if n:
                self._mark(name, last + n)
            return last

    def _top(self, df: DataFrame, name: str) -> int:
        key = STORED[name].key
        return df.agg(F.max(key).alias("m")).first().m or 0

    # --- reads and writes --------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        if STORED[name].by_project:
            return self.facts(name).drop(PROJECT)
        _, batches = self._batches(name)
        schema = STORED[name].schema
        if not batches:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*batches)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def links(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in LINKS}

    def append(self, name: str, df: DataFrame) -> None:
        version, batches = self._batches(name)
        self._write(name, df.select(*STORED[name].columns), version, len(batches))

    def replace(self, name: str, df: DataFrame) -> None:
        """Drop the table's rows and write new ones; what they are made from may be the table itself."""
        types = {f.name: f.dataType for f in STORED[name].schema.fields}
        columns = [
            F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()
        ]
        if STORED[name].by_project:
            rows = materialize(self._placed(name, df.select(*columns)), "replaced")
            self._mark(name, self._top(rows, name), "overwrite")
            return self._put(name, rows, "overwrite")
        version, _ = self._batches(name)
        self._write(name, df.select(*columns), version + 1, 0)

    def _placed(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows of a fact with their project."""
        if "samplecode" in rows.columns:
            return rows.withColumn(PROJECT, project_of("samplecode"))
        owner = self.facts("spectra_info").select("spectraid", PROJECT)
        return join(rows, owner, ["spectraid"], "left", null_safe=False)

    def reset(self) -> None:
        """Empty tables with the declared columns."""
        side_by_side(*[partial(self._clear, name) for name in STORED])

    def _clear(self, name: str) -> None:
        empty = empty_table(self.spark, STORED[name].schema)
        if not STORED[name].by_project:
            return self.replace(name, empty)
        self._mark(name, 0, "overwrite")
        self._put(name, empty.withColumn(PROJECT, F.lit(None).cast("string")), "overwrite")

    # --- deletes ----------------------------------------------------------------------
    def delete(self, name: str, condition: Column) -> None:
        """Delete rows and, down the references, everything that depends on them.

        The removed keys of each level are stored, then the survivors of every
        table, and only then are new folders published, children first. Facts
        are rewritten in the projects that lose rows; other projects keep their
        files.
        """
        removed = {name: self._hit(name, F.coalesce(condition, F.lit(False)))}
        gone: dict[str, list[DataFrame]] = {}
        queue = [name]
        while queue:
            parent = queue.pop(0)
            for child, column in children_of(parent):
                keys = removed_keys(removed[parent], column)
                gone.setdefault(child, []).append(keys)
                rows = self._lost(child, keys, removed[parent])
                removed[child] = removed[child].unionByName(rows) if child in removed else rows
                if child not in queue:
                    queue.append(child)
        survivors = [(table, *self._left(table, name, condition, gone.get(table, []), removed[table])) for table in removed]
        for table, left, projects in reversed(survivors):
            if not STORED[table].by_project:
                self.replace(table, left)
            elif projects:
                self._publish(table, left, projects)

    def _hit(self, name: str, hit: Column) -> DataFrame:
        return (self.facts(name) if STORED[name].by_project else self.table(name)).where(hit)

    def _lost(self, child: str, keys: DataFrame, parent: DataFrame) -> DataFrame:
        """Rows of ``child`` that hold one of the keys; of facts below facts only the same projects are read."""
        if not STORED[child].by_project:
            rows = self.table(child)
        else:
            rows = self.facts(child, self._projects(parent) if PROJECT in parent.columns else None)
        return join(rows, keys, keys.columns, "semi", null_safe=False, unique_right=True)

    def _projects(self, rows: DataFrame) -> list[str | None]:
        """Distinct projects, a handful in any batch."""
        return [r[PROJECT] for r in rows.select(PROJECT).distinct().collect()]

    def _left(self, table: str, first: str, condition: Column, keys: list[DataFrame], removed: DataFrame):
        """Stored survivors of a table, and its projects that lose rows."""
        projects = self._projects(removed) if STORED[table].by_project else []
        rows = self.facts(table, projects) if STORED[table].by_project else self.table(table)
        if table == first:
            rows = rows.where(~F.coalesce(condition, F.lit(False)))
        for k in keys:
            rows = join(rows, k, k.columns, "anti", null_safe=False, unique_right=True)
        return materialize(rows, "survivors"), projects

    def _publish(self, table: str, left: DataFrame, projects: list[str | None]) -> None:
        kept = self._projects(left)
        self._put(table, left, "overwrite", "dynamic")
        for project in set(projects) - set(kept):
            # A project without survivors: an empty file in place of its rows.
            folder = "__HIVE_DEFAULT_PARTITION__" if project is None else _escaped(project)
            left.where("false").select(*STORED[table].columns).write.mode("overwrite").parquet(f"{self.root}/{table}/{PROJECT}={folder}")

    # --- merges ----------------------------------------------------------------------
    def merge(self, name: str, values: DataFrame, by: Sequence[str], on_duplicate: str = "error") -> DataFrame:
        """Insert absent rows and return the input with the table's ids."""
        key = STORED[name].key
        values = values.drop(key)
        self.add(name, values, by, on_duplicate)
        table = self.table(name)
        if STORED[name].by_project:
            table = self.facts(name, self._projects(values.select(project_of("samplecode").alias(PROJECT))))
        return with_ids(values, table, by, key, unique=on_duplicate == "error")

    def add(self, name: str, values: DataFrame, by: Sequence[str], on_duplicate: str = "error") -> None:
        """Insert absent rows without returning ids. Of a fact only the batch's projects are read."""
        key = STORED[name].key
        # Refusing repeats keeps the key unique in the table.
        unique = on_duplicate == "error"
        if not STORED[name].by_project:
            merged = insert_if_absent(self.table(name), values.drop(key), by, key, on_duplicate, unique=unique)
            return self.append(name, merged.inserted)
        if "samplecode" not in by:
            raise ValueError(f"{name} is merged by keys with a samplecode")
        types = {f.name: f.dataType for f in STORED[name].schema.fields}
        batch = values.select(*[F.col(c).cast(types[c]).alias(c) for c in values.columns if c in types and c != key])
        # Numbered as it is stored: the projects are read off it, and where they hold nothing yet the numbers are the ids.
        batch = row_number_any(batch.withColumn(PROJECT, project_of("samplecode")), key)
        present = self.facts(name, self._projects(batch))
        if on_duplicate == "first" or not present.isEmpty():
            batch = insert_if_absent(present, batch.drop(key), by, key, on_duplicate, unique=unique, last_id=0).inserted
        elif on_duplicate == "error" and not duplicate_keys(batch, by).isEmpty():
            raise ValueError(f"the batch repeats keys of {list(by)}")
        before = self._reserve(name, self._top(batch, name))
        filled = [F.col(c) if c in batch.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()]
        self._put(name, batch.select(*filled, PROJECT).withColumn(key, F.col(key) + F.lit(before)), "append")

    def add_packed(self, packed: DataFrame, info: DataFrame) -> None:
        """Append spectra, one row each: ``packed`` has the spectrum's key, its wavelengths and values, ``info`` all of ``spectra_info``.

        Which spectra are new is decided on their keys alone: the keys of both
        tables meet in one grouping, which is stored, so ``info`` is read once.
        A new spectrum's id is a reserved first id plus its number among the stored rows, so ids
        meet the points without a join; only a batch that holds both new and
        known spectra joins its rows, one per spectrum, with the known ids. The
        points are unpacked last, within the task that writes them. Spectra that have
        points already, also from a load that did not end, are passed over.
        """
        numbered = row_number_any(packed.select(*SPECTRUM_KEY, *PACKED), "__n")
        keys = numbered.select(*SPECTRUM_KEY, "__n")
        placed = info.select(*[c for c in STORED["spectra_info"].columns if c in info.columns and c != "spectraid"]).withColumn(PROJECT, project_of("samplecode"))
        met = materialize(_meeting(placed, keys), "spectra-keys", "zstd")
        given = met.where("__n_info > 0")
        projects = self._projects(given)
        present = self.facts("spectra_info", projects).select(*SPECTRUM_KEY, "spectraid")
        known = materialize(join(keys, present, SPECTRUM_KEY, "inner").select("__n", "spectraid"), "known-spectra")

        new = join(given, present, SPECTRUM_KEY, "anti")
        if not join(met.where("__n_info = 0"), present, SPECTRUM_KEY, "anti").isEmpty():
            raise ValueError("spectra without a row of spectra_info")
        if not new.where("__n_info > 1 or __n_packed > 1").isEmpty():
            raise ValueError(f"the batch repeats keys of {SPECTRUM_KEY}")
        new = new.drop("__n_info", "__n_packed")
        count = numbered.count()
        bare = row_number_any(new.where("__n is null").drop("__n"), "spectraid", count + 1)
        rows = new.where("__n is not null").withColumnRenamed("__n", "spectraid").unionByName(bare)
        taken = 0 if rows.isEmpty() else count + bare.count()
        before = F.lit(self._reserve("spectra_info", taken))
        columns = [F.col(c) if c in rows.columns else F.lit(None).cast(t.dataType).alias(c) for c, t in ((f.name, f) for f in STORED["spectra_info"].schema.fields)]
        self._put("spectra_info", rows.select(*columns, PROJECT).withColumn("spectraid", F.col("spectraid") + before), "append")
        numbered = numbered.withColumn("__n", F.col("__n") + before)
        known = known.withColumn("__n", F.col("__n") + before)
        self._put("spectra_data", self.points(self._with_ids(numbered, known, projects)), "append")

    def _with_ids(self, numbered: DataFrame, known: DataFrame, projects: list[str | None]) -> DataFrame:
        """Packed spectra without points in the catalog, with id and project."""
        spectra = numbered.withColumn(PROJECT, project_of("samplecode"))
        if known.isEmpty():
            return spectra.withColumnRenamed("__n", "spectraid")
        stored = self.facts("spectra_data", projects).select("spectraid").distinct()
        done = materialize(join(known, stored, ["spectraid"], "semi", null_safe=False, unique_right=True), "known-points")
        if done.count() == numbered.count():
            return spectra.where("false").withColumnRenamed("__n", "spectraid")
        spectra = join(spectra, done.select("__n"), ["__n"], "anti", null_safe=False, unique_right=True)
        spectra = join(spectra, known, ["__n"], "left", null_safe=False)
        return spectra.withColumn("spectraid", F.coalesce("spectraid", "__n")).drop("__n")

    def points(self, packed: DataFrame) -> DataFrame:
        """Rows of ``spectra_data`` from packed spectra with spectraid and project; no shuffle."""
        size = F.size("wavelengths")
        room = F.when(size > POINTS_PER_SPECTRUM, F.raise_error(F.lit("a spectrum has too many points")).cast("long")).otherwise(F.col("spectraid") * POINTS_PER_SPECTRUM)
        at = F.posexplode(F.arrays_zip(F.col("wavelengths").alias("wavelength"), F.col("spectravalues").alias("spectravalue")))
        long = packed.select("spectraid", PROJECT, room.alias("__first"), at)
        return long.select((F.col("__first") + F.col("pos")).alias("spectradataid"), "spectraid", F.col("col.wavelength").alias("wavelength"), F.col("col.spectravalue").alias("spectravalue"), PROJECT)

    def add_spectra(self, values: DataFrame, ids: DataFrame | None = None) -> None:
        """Append long points (spectraid, wavelength, spectravalue) of spectra that have none yet.

        They are packed first, one row per spectrum. ``ids`` may list the spectra of the batch: of those
        with a row in ``spectra_info`` only the projects are read.
        """
        typed = values.select(F.col("spectraid").cast("long").alias("spectraid"), *[F.col(c).cast("double").alias(c) for c in ("wavelength", "spectravalue")])
        owner = self.facts("spectra_info").select("spectraid", PROJECT)
        if ids is not None:
            owner = join(owner, ids.select("spectraid"), ["spectraid"], "semi", null_safe=False)
        spectra = materialize(join(pack(typed, ["spectraid"]), owner, ["spectraid"], "left", null_safe=False), "packed")
        stored = self.facts("spectra_data", self._projects(spectra)).select("spectraid")
        self._put("spectra_data", self.points(join(spectra, stored, ["spectraid"], "anti", null_safe=False)), "append")


def _meeting(placed: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per spectrum key of either table: how often each has it, the first row of ``placed`` and the number in ``keys``."""
    rest = [c for c in placed.columns if c not in SPECTRUM_KEY]
    sides = [
        placed.select(*SPECTRUM_KEY, F.struct(*rest).alias("__info"), F.lit(None).cast("long").alias("__n")),
        keys.select(*SPECTRUM_KEY, F.lit(None).cast(placed.select(F.struct(*rest).alias("r")).schema["r"].dataType).alias("__info"), "__n"),
    ]
    held = sides[0].unionByName(sides[1]).groupBy(*SPECTRUM_KEY)
    met = held.agg(F.first("__info", ignorenulls=True).alias("__info"), F.min("__n").alias("__n"), F.count("__info").alias("__n_info"), F.count("__n").alias("__n_packed"))
    return met.select(*SPECTRUM_KEY, *[F.col(f"__info.{c}").alias(c) for c in rest], "__n", "__n_info", "__n_packed")


def _escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    special = set("\"#%'*/:=?\\{[]^") | {chr(c) for c in range(1, 32)} | {"\x7f"}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)
