"""Bronze to silver: one incremental run.

1. Clean the rows of new loads and write them once, split into good and rejected (no shuffle).
2. Keep the newest good row per URL and write it in the buckets of the clean table (the run's rows
   are exchanged, by URL).
3. Merge the two bucket by bucket into the clean table's next version (no shuffle).
4. Append the run's row to the run log: watermark, and counts taken while steps 1 and 2 were writing.
   Only now is the run visible.

All but the last step overwrite the run's own folders, so a run that failed is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..operators.keyed import newest_listing, upsert_aligned
from ..sources.lake import KEY, Lake, write_parts
from .clean import PENDING, clean, clean_columns

#: Loads of one run: their names pass through the driver.
LOADS = 1000


def routed(staging: DataFrame) -> DataFrame:
    """Good rows carry clean columns and rejected rows carry raw ones; the rest is null.

    Column names shared by both (``facade`` and others) are stored under ``v_`` for the clean side.
    """
    cleaned = clean(staging)
    good = F.col("error_message").isNull()
    clean_side = [
        F.when(good, c).cast(f.dataType).alias(f"v_{f.name}")
        for c, f in zip(clean_columns(F.current_timestamp()), schemas.CLEAN.fields)
    ]
    raw_side = [
        (F.col(n) if n in ("created_at", "ingest_seq", "source_file") else F.when(~good, F.col(n))).alias(n)
        for n in schemas.STAGING.fieldNames()
    ]
    return cleaned.select(
        *clean_side,
        *raw_side,
        "error_message",
        F.when(~good, PENDING).alias("retry_status"),
        good.alias("is_valid"),
    )


def refine_rows(lake: Lake, staging: DataFrame, run: int, feed: str = "refine", loads: list[str] = []) -> None:
    """Put staging rows through run number ``run``; if it is the log's newest run, it is done.

    ``feed`` names where the rows come from. Runs are numbered by one feed at a time, and a number
    that another feed has used is an error rather than a repetition. What the log says of the run is
    counted while its tables are written.
    """
    state = lake.state()
    if run == state.run and feed == state.feed:
        return
    if run <= state.run:
        raise ValueError(f"run {run} of {feed}: the run log is at {state.run} of {state.feed}")
    buckets = state.buckets or lake.buckets
    folder = lake.path("silver", "routed", f"run={run}")
    valid = F.col("is_valid").cast("long")
    split, kept = Observation(), Observation()
    rows = routed(staging).observe(
        split, F.sum(valid).alias("good"), F.sum(1 - valid).alias("bad"), F.max(F.unix_micros("created_at")).alias("last")
    )
    write_parts(rows, folder, "is_valid", 2)

    good = lake.read_path(folder, schemas.ROUTED).where("is_valid").select(
        *[F.col(f"v_{c}").alias(c) for c in schemas.CLEAN_COLUMNS], "ingest_seq", "source_file"
    )
    newest = newest_listing(good).select(*schemas.CLEAN_COLUMNS).observe(kept, F.count("*").alias("rows"))
    incoming = lake.write_bucketed(newest.repartition(buckets, KEY), "incoming", run, buckets)
    merged = upsert_aligned(lake.clean(), incoming, KEY) if state.run else incoming
    lake.write_bucketed(merged, "clean", run, buckets)

    found = split.get
    micros = [m for m in (state.last_micros, found["last"]) if m is not None]
    facts = lake.spark.range(1).select(
        F.lit(run).cast("long").alias("run"),
        F.timestamp_micros(F.lit(max(micros, default=None)).cast("long")).alias("last_date"),
        F.lit(found["good"] or 0).cast("long").alias("good_rows"),
        F.lit(found["bad"] or 0).cast("long").alias("error_rows"),
        F.lit((found["good"] or 0) - (kept.get["rows"] or 0)).cast("long").alias("duplicate_rows"),
        F.current_timestamp().alias("committed_at"),
        F.lit(feed).alias("feed"),
        F.lit(buckets).alias("buckets"),
        F.array(*[F.lit(n) for n in loads]).cast("array<string>").alias("loads"),
    )
    lake.commit(facts)


def refine(lake: Lake, loads_per_run: int = LOADS) -> DataFrame:
    """Process the loads that no run has read yet, if any; gives the newest run-log row.

    Loads are told apart by name, whatever their times: one that was committed late is read too. A run
    takes a bounded number of loads, and reads their folders only.
    """
    while loads := lake.unrefined(loads_per_run):
        rows = lake.loads(loads).where("corrupt_record is null").select(*schemas.STAGING.fieldNames())
        refine_rows(lake, rows, lake.state().run + 1, loads=loads)
    return lake.run_log().orderBy(F.col("run").desc()).limit(1)
