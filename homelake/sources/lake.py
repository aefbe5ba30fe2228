"""Table locations, the bronze and silver tables, and what is committed.

Tables live under ``<root>/<namespace>/<table>``. Each load or run writes its own folders. It counts
only once its row is in the load log or run log, which is written last; until then it may be repeated
and overwrites those folders, and nothing of it is visible.

The clean table is a bucketed table of the session's catalog, one version for each run, with all rows
of a URL in one bucket: a run's rows are dealt into the same buckets and merged bucket by bucket, so
that the rows that are already there are never exchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.conditions import conditions, delete_where, update_where

#: Buckets of the clean table of a new lake; a large one needs one for each some 100 MB.
BUCKETS = 16
KEY = "subpage_url"


@dataclass(frozen=True)
class RunState:
    """The newest committed silver run."""

    run: int = 0
    last_micros: int | None = None
    feed: str | None = None
    buckets: int | None = None


def _readable(loaded: DataFrame) -> DataFrame:
    return loaded.where("corrupt_record is null").select(*schemas.STAGING.fieldNames())


def write_parts(rows: DataFrame, path: str, column: str, values: int) -> None:
    """Write (or rewrite) rows as Parquet in a folder for each of the few ``values`` of a column.

    A task keeps a file open for each value; otherwise Spark sorts all rows of a task by the column
    first, in memory that grows with the task's input.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(max(values, int(before))))
    try:
        rows.write.mode("overwrite").partitionBy(column).parquet(path)
    finally:
        conf.set(name, before)


_BY_LOAD = T.StructField("load", T.StringType())


class Lake:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, namespace: str, table: str, *parts: str) -> str:
        return "/".join([self.root, namespace, table, *parts])

    def read(self, namespace: str, table: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows if nothing has been written yet."""
        return self.read_path(self.path(namespace, table), schema)

    def read_path(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, df: DataFrame, namespace: str, table: str, load: str | None = None) -> None:
        """Append rows, or with ``load`` write (or rewrite) that load's own folder."""
        if load is None:
            df.write.mode("append").parquet(self.path(namespace, table))
        else:
            df.write.mode("overwrite").parquet(self.path(namespace, table, f"load={load}"))

    # bronze

    def load_log(self) -> DataFrame:
        return self.read("bronze", "load_log", schemas.LOAD_LOG)

    def loaded(self) -> DataFrame:
        """Rows of committed loads with their load, broken lines included."""
        rows = self.read("bronze", "staging", T.StructType(schemas.LOADED.fields + [_BY_LOAD]))
        return rows.join(self.load_log().select("load").distinct(), "load", "left_semi")

    def loads(self, names: list[str]) -> DataFrame:
        """Rows of a bounded number of loads. Only their folders are listed and scanned."""
        staging = self.path("bronze", "staging")
        reader = self.spark.read.schema(T.StructType(schemas.LOADED.fields + [_BY_LOAD])).option("basePath", staging)
        return reader.parquet(*[f"{staging}/load={n}" for n in names]).where(F.col("load").isin(names))

    def staging(self) -> DataFrame:
        return _readable(self.loaded())

    def staging_stream(self) -> DataFrame:
        """Staging rows as loads are added."""
        return _readable(self.spark.readStream.schema(schemas.LOADED).parquet(self.path("bronze", "staging")))

    def rejected_lines(self) -> DataFrame:
        rows = self.loaded().where("corrupt_record is not null")
        return rows.select("source_file", "corrupt_record", "created_at")

    def staging_after(self, last_micros: int | None) -> DataFrame:
        """Rows created after a moment; the comparison is pushed to the Parquet scan."""
        rows = self.staging()
        if last_micros is None:
            return rows
        return rows.where(F.col("created_at") > F.timestamp_micros(F.lit(last_micros)))

    def new_load(self, name: str) -> str:
        """The name, or with a number if a committed call has it: no load overwrites another."""
        used = self.load_log().where((F.col("call") == name) | F.col("call").startswith(name + "~"))
        n = used.select("call").distinct().count()
        return f"{name}~{n + 1}" if n else name

    def is_committed(self, call: str) -> bool:
        return not self.load_log().where(F.col("call") == call).isEmpty()

    def add_load(self, rows: DataFrame, load: str) -> None:
        """Write a load and make it visible."""
        self.append(rows, "bronze", "staging", load)
        self.commit_loads([load], load)

    def commit_loads(self, loads: Iterable[str], call: str) -> None:
        """Make the loads of a call visible, all at once: one file."""
        rows = self.spark.createDataFrame([(n, call) for n in loads], "load string, call string")
        rows = rows.withColumn("committed_at", F.current_timestamp()).coalesce(1)
        rows.write.mode("append").parquet(self.path("bronze", "load_log"))

    def unrefined(self, most: int) -> list[str]:
        """The first ``most`` committed loads that no committed silver run has read."""
        done = self.run_log().select(F.explode("loads").alias("load"))
        rows = self.load_log().select("load").distinct().join(done, "load", "left_anti").orderBy("load").limit(most)
        return [r.load for r in rows.collect()]

    def file_log(self) -> DataFrame:
        """Files of committed calls."""
        rows = self.read("bronze", "processed_files_log", T.StructType(schemas.FILE_LOG.fields + [_BY_LOAD]))
        calls = self.load_log().select(F.col("call").alias("load")).distinct()
        return rows.join(calls, "load", "left_semi").select(*schemas.FILE_LOG.fieldNames())

    def failed_files(self) -> DataFrame:
        return self.file_log().where("status = 'failed'")

    def last_processed(self) -> DataFrame:
        return self.file_log().agg(F.max("processed_at").alias("last_processed_at"))

    # silver

    def run_log(self) -> DataFrame:
        return self.read("silver", "run_log", schemas.RUN_LOG)

    def state(self) -> RunState:
        facts = F.struct("run", F.unix_micros("last_date").alias("last_micros"), "feed", "buckets")
        newest = self.run_log().agg(F.max_by(facts, "run").alias("newest")).first().newest
        return RunState(**newest.asDict()) if newest else RunState()

    def last_transform_date(self) -> DataFrame:
        return self.run_log().agg(F.max_by("last_date", "run").alias("last_date"))

    def commit(self, row: DataFrame) -> None:
        """Make a run visible. One row, one file."""
        row.select(*schemas.RUN_LOG.fieldNames()).coalesce(1).write.mode("append").parquet(self.path("silver", "run_log"))

    def _name(self, table: str, run: int) -> str:
        """Name of a silver table in the catalog; each lake has its own database."""
        database = f"lake_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_silver"
        self.spark.sql(f"create database if not exists {database} location '{self.path('silver', '')}'")
        return f"{database}.{table}_{run}"

    def bucketed(self, table: str, run: int, buckets: int) -> DataFrame:
        """A version of a bucketed table, made known to the catalog if another session wrote it."""
        name = self._name(table, run)
        self.spark.sql(
            f"create table if not exists {name} ({schemas.CLEAN.toDDL()}) using parquet"
            f" clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets location '{self.path('silver', table, f'run={run}')}'"
        )
        return self.spark.table(name)

    def write_bucketed(self, rows: DataFrame, table: str, run: int, buckets: int) -> DataFrame:
        """Write (or rewrite) a version of a bucketed table. Rows that are dealt by the key already make
        one file for each bucket."""
        name = self._name(table, run)
        self.spark.sql(f"drop table if exists {name}")
        writer = rows.write.mode("overwrite").option("path", self.path("silver", table, f"run={run}"))
        writer.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)
        return self.spark.table(name)

    def clean(self) -> DataFrame:
        """The clean table as of the newest committed run."""
        state = self.state()
        if not state.run:
            return self.spark.createDataFrame([], schemas.CLEAN)
        return self.bucketed("clean", state.run, state.buckets)

    def _routed_errors(self, after: int, until: int) -> DataFrame:
        """Rejected rows of the runs after one and up to another."""
        partitions = [T.StructField("run", T.LongType()), T.StructField("is_valid", T.BooleanType())]
        rows = self.read("silver", "routed", T.StructType(schemas.ERRORS.fields + partitions))
        rows = rows.where(~F.col("is_valid") & (F.col("run") > after) & (F.col("run") <= until))
        return rows.select(*schemas.ERRORS.fieldNames(), "run")

    def error_version(self) -> tuple[int, int]:
        """The newest written version of the error table and the last run that it holds; zeros without one."""
        log = self.read("silver", "error_versions", schemas.ERROR_VERSIONS)
        newest = log.agg(F.max(F.struct("version", "through_run")).alias("newest")).first().newest
        return (newest.version, newest.through_run) if newest else (0, 0)

    def errors_of(self, version: int, run: int) -> DataFrame:
        """Rejected rows of a written version, or of one run."""
        if not version:
            return self._routed_errors(run - 1, run)
        fields = schemas.ERRORS.fields + [T.StructField("run", T.LongType())]
        return self.read_path(self.path("silver", "errors", f"version={version}"), T.StructType(fields))

    def errors(self) -> DataFrame:
        """Rejected rows with their run number: the newest written version of the table, which holds all
        runs up to one, and the rows of later runs."""
        version, through = self.error_version()
        later = self._routed_errors(through, self.state().run)
        return self.errors_of(version, 0).unionByName(later) if version else later

    def update_errors(self, changes: dict, filters: dict) -> int:
        """Set columns of the rejected rows that match; gives their number."""
        return self._rewrite_errors(lambda rows: update_where(rows, changes, filters), filters)

    def delete_errors(self, filters: dict) -> int:
        """Delete the rejected rows that match; gives their number."""
        return self._rewrite_errors(lambda rows: delete_where(rows, filters), filters)

    def _rewrite_errors(self, change, filters: dict) -> int:
        """Write the error table anew as its next version, counting the rows that match on the way."""
        version = self.error_version()[0] + 1
        through, seen = self.state().run, Observation()
        rows = self.errors().observe(seen, F.count_if(conditions(filters)).alias("matching"))
        change(rows).write.mode("overwrite").parquet(self.path("silver", "errors", f"version={version}"))
        row = self.spark.createDataFrame([(version, through)], "version long, through_run long")
        row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path("silver", "error_versions"))
        return seen.get["matching"] or 0
