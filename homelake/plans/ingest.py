"""Raw files to the bronze tables (batch form; see ``streaming`` for continuous pick-up)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import FILE_LOG
from ..sources.lake import Lake
from ..sources.raw_files import file_log_rows, list_files, move_files, new_files, scan_csv, stamp

#: Files of one load: what passes through the driver at once.
BATCH_FILES = 1000


def load_files(lake: Lake, files: DataFrame, load: str) -> None:
    """Write the rows of a bounded number of files as a load, which is not visible yet."""
    paths = [row.file_path for row in files.select("file_path").collect()]
    lake.append(stamp(scan_csv(lake.spark, paths)), "bronze", "staging", load)


def commit_files(lake: Lake, files: DataFrame, loads: list[str], call: str) -> DataFrame:
    """Log the files of a call's loads and make them visible; gives their log rows."""
    rows = lake.loads(loads).where("corrupt_record is null")
    lake.append(file_log_rows(files, rows), "bronze", "processed_files_log", call)
    lake.commit_loads(loads, call)
    return logged_files(lake, call)


def logged_files(lake: Lake, call: str) -> DataFrame:
    return lake.read_path(lake.path("bronze", "processed_files_log", f"load={call}"), FILE_LOG)


def ingest(
    lake: Lake, folder: str, load: str, batch_files: int = BATCH_FILES, archive: str | None = None, failed: str | None = None
) -> DataFrame:
    """Load all files of ``folder`` that the file log does not have; gives one summary row.

    Files are dealt by a hash of their path into batches of about ``batch_files``, each a load of
    its own that reads its part of the table of found files. A name that a committed call has gets a
    number. The logs are written last, once for all batches, so the files of a call that stopped
    half-way are simply found again. Finished files go to ``archive`` and files without a readable row
    to ``failed``, if given.
    """
    call = lake.new_load(load)
    found, dealt = lake.path("bronze", "found_files", f"{call}-all"), lake.path("bronze", "found_files", call)
    seen = Observation()
    fresh = new_files(list_files(lake.spark, folder), lake.file_log()).observe(seen, F.count("*").alias("files"))
    fresh.write.mode("overwrite").parquet(found)
    files, batches = lake.spark.read.parquet(found), -(-(seen.get["files"] or 0) // batch_files)
    if not batches:
        return lake.spark.createDataFrame([("no_files", 0, 0, 0)], _SUMMARY)
    number = F.pmod(F.xxhash64("file_path"), F.lit(batches)).cast("int")
    files.withColumn("batch", number).repartition("batch").write.mode("overwrite").partitionBy("batch").parquet(dealt)
    numbers = [r.batch for r in lake.spark.read.parquet(dealt).select("batch").distinct().orderBy("batch").collect()]
    loads = [f"{call}.{n}" for n in numbers]
    for n, name in zip(numbers, loads, strict=True):
        load_files(lake, lake.spark.read.parquet(f"{dealt}/batch={n}"), name)
    done = commit_files(lake, files, loads, call)
    for target, status in ((archive, "success"), (failed, "failed")):
        if target:
            for n in numbers:
                part = lake.spark.read.parquet(f"{dealt}/batch={n}").join(done.where(F.col("status") == status), "file_path", "left_semi")
                move_files(lake.spark, [r.file_path for r in part.collect()], target)
    counts = {r.status: r["count"] for r in done.groupBy("status").count().collect()}
    row = ("completed", counts.get("success", 0), counts.get("failed", 0), sum(counts.values()))
    return lake.spark.createDataFrame([row], _SUMMARY)


_SUMMARY = "status string, processed long, failed long, total long"
