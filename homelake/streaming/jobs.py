"""File stream to bronze, and rows to silver, by micro-batch.

Progress is kept in the stream's checkpoint rather than in a time predicate, so rows that
arrive late are not passed over. A batch's load is named after the identity that Spark gives the
checkpoint and the batch's number: a batch that is replayed is the same load, and another stream,
or a renewed checkpoint, never writes to it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import BATCH_FILES, commit_files, load_files
from ..plans.refine import refine_rows
from ..sources.lake import Lake
from ..sources.raw_files import new_files, stream_files


def _start(rows: DataFrame, batch, checkpoint: str, continuous: str | None) -> StreamingQuery:
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _identity(lake: Lake, checkpoint: str) -> str:
    return json.loads(lake.spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def ingest_stream(
    lake: Lake, folder: str, checkpoint: str, archive: str | None = None, continuous: str | None = None,
    max_files: int = BATCH_FILES,
) -> StreamingQuery:
    """Each raw file once into bronze, with its row in the file log; files that a load has are left
    out. With ``archive`` the file source itself moves the files of finished batches there."""

    def batch(found: DataFrame, n: int) -> None:
        load = f"stream-{_identity(lake, checkpoint)}-{n:012d}"
        files = new_files(found, lake.file_log())
        if lake.is_committed(load) or files.isEmpty():
            return
        # Written once: the log and the load are made of the same list.
        path = lake.path("bronze", "found_files", load)
        files.write.mode("overwrite").parquet(path)
        files = lake.spark.read.parquet(path)
        load_files(lake, files, load)
        commit_files(lake, files, [load], load)

    return _start(stream_files(lake.spark, folder, max_files, archive), batch, checkpoint, continuous)


def refine_stream(lake: Lake, rows: DataFrame, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Staging-shaped stream into silver: one run per batch, numbered after it."""
    return _start(rows, lambda df, n: refine_rows(lake, df, n + 1, f"stream {checkpoint}"), checkpoint, continuous)
