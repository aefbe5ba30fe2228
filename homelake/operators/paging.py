"""Pages of a sorted table by number, found through an index.

The table is written in ranges of its order, each row with its place in its range, and beside it the
number of rows before each range. A page is then the rows of one or two ranges between two places: the
others are not read, and nothing is sorted or skipped when a page is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of ``monotonically_increasing_id`` that count the rows of a partition.
_IN_PARTITION = (1 << 33) - 1


def write_pages(df: DataFrame, path: str, order_by: list[str], ranges: int) -> None:
    """Write ``df`` for ``read_page``: in ``ranges`` parts of about equal size, one exchange."""
    if not order_by:
        raise ValueError("a page needs an order")
    dealt = df.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    placed = dealt.withColumns({"range_number": F.spark_partition_id(), "range_place": place})
    placed.write.mode("overwrite").partitionBy("range_number").parquet(f"{path}/rows")
    # A table without rows has no range whose files would tell its columns.
    placed.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    counts = _rows(df.sparkSession, path).groupBy("range_number").agg(F.count("*").alias("n_rows"))
    # One row for each range.
    before = Window.orderBy("range_number").rowsBetween(Window.unboundedPreceding, -1)
    index = counts.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def read_page(spark: SparkSession, path: str, page: int, page_size: int) -> DataFrame:
    """The rows of a page (from 1), in order. Only the ranges that the page touches are scanned."""
    first, end = (page - 1) * page_size, page * page_size
    index = spark.read.parquet(f"{path}/index")
    touched = index.where((F.col("first_row") < end) & (F.col("first_row") + F.col("n_rows") > first)).collect()
    rows = _rows(spark, path)
    wanted = F.lit(False)
    for r in touched:
        place = F.col("range_place")
        wanted = wanted | ((F.col("range_number") == r.range_number) & (place >= first - r.first_row) & (place < end - r.first_row))
    rows = rows.where(F.col("range_number").isin([r.range_number for r in touched])).where(wanted)
    return rows.orderBy("range_number", "range_place").drop("range_number", "range_place")
