"""Raw listing files: reading, stamping, the file log, and export."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import without_known
from ..operators.missing import null_tokens
from ..schemas import LOADED, RAW, RAW_COLUMNS
from .file_access import can_open, files_below, first_lines, qualified

CORRUPT = "corrupt_record"

# Fixed value: how a time is written in file names.
NAME_TIME = r"([0-9]{8})_([0-9]{6})"

WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"}


def name_time(name: Column | str, modified: Column | str) -> Column:
    """Time in a file name; null if its digits are no time; the modification time if it has none."""
    name = F.col(name) if isinstance(name, str) else name
    modified = F.col(modified) if isinstance(modified, str) else modified
    digits = F.concat(F.regexp_extract(name, NAME_TIME, 1), F.regexp_extract(name, NAME_TIME, 2))
    return F.when(digits == "", modified).otherwise(F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")))


def _file_time(path: Column, modified: Column) -> Column:
    # Spark writes an export as a folder of part files, so the folder may carry the time.
    own_name, folder = F.element_at(F.split(path, "/"), -1), F.element_at(F.split(path, "/"), -2)
    dated = F.when(~own_name.rlike(NAME_TIME) & folder.rlike(NAME_TIME), folder).otherwise(own_name)
    return name_time(dated, modified)


def _file_facts() -> dict[str, Column]:
    # The path as listings have it, without the escapes of an address.
    path = F.col("_metadata.file_path")
    path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return {"source_file": path, "file_timestamp": _file_time(path, F.col("_metadata.file_modification_time"))}


def _paths(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path")


def headers(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names in the order of each file's first line, with the files that have them.

    One row per file comes to the driver, so ``paths`` should be a bounded number of files. Of a file
    only the first block is read, where executors can open it.
    """
    files = _paths(spark, paths)
    if can_open(files.agg(F.min("path")).first()[0]):
        first = first_lines(files)
    else:
        lines = spark.read.text(paths).select(
            "value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        first = lines.where("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("path").toLocalIterator():
        names = tuple(n.strip() for n in next(csv.reader([row.line.removeprefix("\ufeff")]), []))
        found.setdefault(names, []).append(row.path)
    return found


def scan_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw columns as text, the broken line if any, and the file's path and time.

    Columns are found by the names in each file's header, in any order; one that a file does not
    have is null, and others are not read. Files are scanned together by header.
    """
    scans = []
    for names, files in headers(spark, paths).items():
        # A repeated or foreign name keeps its place but is not read.
        places = [n if n in RAW_COLUMNS and n not in names[:i] else f"_other_{i}" for i, n in enumerate(names)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*places, CORRUPT]])
        rows = spark.read.schema(schema).options(**CSV_OPTIONS, columnNameOfCorruptRecord=CORRUPT).csv(files)
        columns = [F.col(c) if c in places else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS]
        scans.append(rows.select(*columns, CORRUPT, *[c.alias(n) for n, c in _file_facts().items()]))
    if not scans:
        empty = T.StructType(
            RAW.fields + [T.StructField(n, T.StringType()) for n in (CORRUPT, "source_file")] + [T.StructField("file_timestamp", T.TimestampType())]
        )
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, scans)


_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _listed(files: DataFrame, modified: Column) -> DataFrame:
    path = F.col("path")
    return files.select(F.element_at(F.split(path, "/"), -1).alias("file_name"), path.alias("file_path"), _file_time(path, modified).alias("file_timestamp"))


def stream_files(spark: SparkSession, folder: str, max_files: int, archive: str | None = None) -> DataFrame:
    """Files as they arrive, as ``list_files`` gives them. With ``archive`` the source moves the files of
    finished batches there."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _listed(reader.load(folder), F.col("modificationTime"))


def move_files(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move a bounded number of files within their file system; one that is gone was moved before."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(conf).mkdirs(target)
    for path in paths:
        source = jvm.org.apache.hadoop.fs.Path(path)
        files = source.getFileSystem(conf)
        if files.exists(source):
            files.rename(source, jvm.org.apache.hadoop.fs.Path(target, source.getName()))


def stamp(rows: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Loadable rows from scanned rows: missing-value texts to null, then arrival time and order.

    ``ingest_seq`` holds the file's time in the upper bits and a number that rises within the file
    in the lower ones. Multi-line files are read whole by one task, so rows are in the same order
    by (time, ``source_file``, number) however files are dealt to tasks; the number alone is not
    unique over files. See ``keyed.newest_listing``.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 31) - 1))
    seconds = F.coalesce(F.unix_timestamp("file_timestamp"), F.lit(0))
    stamped = null_tokens(rows, RAW_COLUMNS).withColumns(
        {
            "created_at": F.current_timestamp() if created_at is None else created_at,
            "ingest_seq": F.shiftleft(seconds, 31).bitwiseOR(place),
        }
    )
    return stamped.select(*LOADED.fieldNames())


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder; their contents are not read. Tasks list the folders where they can."""
    if can_open(qualified(spark, folder)):
        return _listed(files_below(spark, qualified(spark, folder)), F.col("modified"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return _listed(files, F.col("modificationTime"))


def new_files(files: DataFrame, file_log: DataFrame) -> DataFrame:
    """Files with a usable time that the log does not have yet."""
    return without_known(files, file_log, "file_path").where(F.col("file_timestamp").isNotNull())


def file_log_rows(files: DataFrame, rows: DataFrame) -> DataFrame:
    """One log row per file: rows loaded, failed if none."""
    counts = rows.groupBy("source_file").agg(F.count("*").alias("record_count"))
    counted = files.join(counts, files.file_path == counts.source_file, "left")
    n = F.coalesce("record_count", F.lit(0))
    return counted.select(
        "file_name",
        "file_path",
        "file_timestamp",
        F.current_timestamp().alias("processed_at"),
        n.alias("record_count"),
        F.when(n > 0, "success").otherwise("failed").alias("status"),
    )


def export_csv(rows: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Raw rows as CSV files of at most ``rows_per_file`` rows, UTF-8 with a byte order mark.

    A file with quoted line breaks is read by one task: the default keeps it at some tens of MB.
    """
    flat = rows.select(*RAW_COLUMNS).na.fill("")
    # Each part file starts with the header, so a mark on the first name starts each file.
    marked = flat.withColumnRenamed(RAW_COLUMNS[0], "\ufeff" + RAW_COLUMNS[0])
    marked.write.mode("overwrite").options(**WRITE_OPTIONS, maxRecordsPerFile=rows_per_file).csv(path)
