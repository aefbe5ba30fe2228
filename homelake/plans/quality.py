"""Daily quality and error reports. All are plain grouped aggregates, partial before the shuffle.

Reports of a lake are kept as counts per load or run and day, which are taken once, and merged when a
report is read: a report costs the days of each load, not the rows. Daily tables are in ascending order.

Definitions: a value is missing if it is null or empty; the day is that of ``created_at``; the
status counts of a day are of that day's errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_empty
from ..operators.conditions import with_prefix
from ..operators.keyed import top_recent
from ..operators.reshape import column_label, day_text, metric_series, minute_text
from ..schemas import RAW_COLUMNS
from ..sources.lake import Lake

# Retry states of an error row, and the report headings.
STATUSES = ["pending", "resolved", "failed"]
RECENT_HEADINGS = {
    "report_date": "Report Date",
    "total_errors": "Total Errors",
    "total_pending": "Pending",
    "total_resolved": "Resolved",
    "total_failed": "Failed",
    "latest_error_time": "Latest Error Time",
}


QC_COUNTS = T.StructType(
    [T.StructField("load", T.StringType()), T.StructField("crawl_date", T.DateType())]
    + [T.StructField(n, T.LongType()) for n in ("total_records", *[f"missing_{c}" for c in RAW_COLUMNS])]
)
ERROR_COUNTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("version", "run")]
    + [T.StructField("report_date", T.DateType())]
    + [T.StructField(n, T.LongType()) for n in ("total_errors", *[f"total_{s}" for s in STATUSES])]
    + [T.StructField("latest_error_time", T.TimestampType())]
)


def _by_day(rows: DataFrame, name: str) -> DataFrame:
    return rows.orderBy(F.col(name).asc_nulls_first())


def _qc_counts(columns: list[str]) -> list:
    missing = [F.count_if(is_empty(c)).alias(f"missing_{c}") for c in columns]
    return [F.count("*").alias("total_records"), *missing]


def qc_daily(rows: DataFrame, time: str = "created_at", columns: list[str] | None = None) -> DataFrame:
    """Per day: rows, and rows missing each column."""
    return _by_day(rows.groupBy(F.to_date(time).alias("crawl_date")).agg(*_qc_counts(columns or RAW_COLUMNS)), "crawl_date")


def refresh_qc(lake: Lake, loads: int = 1000) -> None:
    """Take the counts of committed loads that have none yet, in steps of a bounded number of loads."""
    day = F.to_date("created_at").alias("crawl_date")
    while names := _uncounted(lake, loads):
        rows = lake.loads(names).where("corrupt_record is null")
        counts = rows.groupBy("load", day).agg(*_qc_counts(RAW_COLUMNS))
        # A load without rows is counted too: by a row of zeros.
        every = lake.spark.createDataFrame([(n,) for n in names], "load string")
        counts = every.join(counts, "load", "left").na.fill(0).coalesce(1)
        lake.append(counts, "bronze", "qc_counts")


def _uncounted(lake: Lake, most: int) -> list[str]:
    done = lake.read("bronze", "qc_counts", QC_COUNTS).select("load")
    rows = lake.load_log().select("load").distinct().join(done, "load", "left_anti").orderBy("load").limit(most)
    return [r.load for r in rows.collect()]


def lake_qc_daily(lake: Lake) -> DataFrame:
    """``qc_daily`` of all loads, from their counts."""
    counts = lake.read("bronze", "qc_counts", QC_COUNTS).where("total_records > 0")
    names = [f.name for f in QC_COUNTS.fields if f.name not in ("load", "crawl_date")]
    return _by_day(counts.groupBy("crawl_date").agg(*[F.sum(n).alias(n) for n in names]), "crawl_date")


def qc_series(daily: DataFrame) -> DataFrame:
    """One row per day and missing-count, with a display label."""
    series = metric_series(daily, "crawl_date", with_prefix(daily, "missing_"))
    return series.withColumn("label", column_label("metric"))


def qc_totals(daily: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("total_records"), F.lit(0))
    return daily.agg(
        total.alias("total_records"),
        F.floor(F.coalesce(F.avg("total_records"), F.lit(0.0))).alias("avg_daily_records"),
        F.count_distinct("crawl_date").alias("num_days"),
    )


def _error_counts(time: str) -> list:
    by_status = [F.count_if(F.col("retry_status") == s).alias(f"total_{s}") for s in STATUSES]
    return [F.count("*").alias("total_errors"), *by_status, F.max(time).alias("latest_error_time")]


def error_daily(errors: DataFrame, time: str = "created_at") -> DataFrame:
    """Per day: errors, errors in each state, and the time of the newest one."""
    return _by_day(errors.groupBy(F.to_date(time).alias("report_date")).agg(*_error_counts(time)), "report_date")


def refresh_errors(lake: Lake) -> None:
    """Take the counts of the error table's newest version and of each later run, as far as missing.

    The counts of a version stand for those of all runs that it holds, whose rows it may have changed.
    """
    done = {(r.version, r.run) for r in lake.read("silver", "error_counts", ERROR_COUNTS).select("version", "run").distinct().collect()}
    version, through = lake.error_version()
    day = F.to_date("created_at").alias("report_date")
    for part in [(version, 0)] * (version > 0) + [(0, run) for run in range(through + 1, lake.state().run + 1)]:
        if part not in done:
            rows = lake.errors_of(*part)
            counts = rows.groupBy(day).agg(*_error_counts("created_at"))
            key = lake.spark.createDataFrame([part], "version long, run long")
            # The key's row is there without errors too.
            lake.append(key.join(counts, F.lit(True), "left").na.fill(0).coalesce(1), "silver", "error_counts")


def lake_error_daily(lake: Lake) -> DataFrame:
    """``error_daily`` of the error table as it is now, from counts."""
    version, through = lake.error_version()
    counts = lake.read("silver", "error_counts", ERROR_COUNTS).where("total_errors > 0")
    run = F.col("run")
    counts = counts.where(((F.col("version") == version) & (run == 0)) | ((F.col("version") == 0) & (run > through) & (run <= lake.state().run)))
    sums = [F.sum(n).alias(n) for n in ("total_errors", *[f"total_{s}" for s in STATUSES])]
    daily = counts.groupBy("report_date").agg(*sums, F.max("latest_error_time").alias("latest_error_time"))
    return _by_day(daily, "report_date")


def error_totals(daily: DataFrame) -> DataFrame:
    """Totals over all days and the state of the latest day; zeros and N/A without data."""
    day = F.max_by(F.struct(*daily.columns), F.col("report_date"))
    facts = daily.agg(
        F.count_distinct("report_date").alias("total_days"),
        F.coalesce(F.sum("total_errors"), F.lit(0)).alias("total_errors"),
        F.round(F.coalesce(F.avg("total_errors"), F.lit(0.0)), 2).alias("avg_daily_errors"),
        day.alias("day"),
    )
    latest = F.coalesce("day.total_errors", F.lit(0))
    resolved = F.coalesce("day.total_resolved", F.lit(0))
    return facts.select(
        "total_days",
        "total_errors",
        "avg_daily_errors",
        *[F.coalesce(f"day.total_{s}", F.lit(0)).alias(s) for s in STATUSES],
        F.when(latest == 0, 0.0).otherwise(F.round(resolved / latest * 100, 1)).alias("resolution_rate"),
        day_text("day.report_date").alias("latest_report"),
        minute_text("day.latest_error_time").alias("latest_error_time"),
        latest.alias("latest_total_errors"),
    )


def recent_errors(daily: DataFrame, days: int = 10) -> DataFrame:
    """The latest days, newest first, formatted for display."""
    shown = top_recent(daily, "report_date", days).withColumns(
        {"report_date": day_text("report_date"), "latest_error_time": minute_text("latest_error_time")}
    )
    return shown.select(*RECENT_HEADINGS).withColumnsRenamed(RECENT_HEADINGS)
