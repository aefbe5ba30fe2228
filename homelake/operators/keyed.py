"""One row per key: newest row, first copy, and latest-wins merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    # Filtering a row number to 1 lets Spark keep one row per key in every map task before the
    # shuffle, so a key that holds a third of the rows sends one row per task.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_per_key(df: DataFrame, key: str, newest_first: list[Column]) -> DataFrame:
    """The first row per key in the given order; rows without a key are dropped."""
    return _first_per_key(df.where(F.col(key).isNotNull()), [key], newest_first)


def newest_listing(df: DataFrame, timestamp: str = "store_staging_at", key: str = "subpage_url") -> DataFrame:
    """Newest row per URL; equal times go to the later input row, a missing time loses.

    Input order is by the file's time (upper bits of ``ingest_seq``), its path where known, and
    the place in it: unique, and the same however files are dealt to tasks.
    """
    path = [F.col("source_file").desc_nulls_last()] if "source_file" in df.columns else []
    order = [F.shiftright("ingest_seq", 31).desc(), *path, F.col("ingest_seq").desc()]
    return latest_per_key(df, key, [F.col(timestamp).desc_nulls_last(), *order])


def _digest(columns: list[str]) -> Column:
    parts = []
    for c in columns:
        # The length in front keeps ("ab", "c") apart from ("a", "bc"), and null from "".
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct combinations of the given columns (whole values, no metadata)."""
    return df.select(*columns).distinct()


def distinct_values(df: DataFrame, columns: list[str], outputs: dict[str, Column]) -> DataFrame:
    """``outputs`` for each distinct combination of ``columns``, told apart by a digest.

    Outputs depend on the columns alone and are computed before the exchange, so that no whole
    value is moved.
    """
    slim = df.select(_digest(columns).alias("_digest"), *[c.alias(n) for n, c in outputs.items()])
    return slim.groupBy("_digest").agg(*[F.first(n).alias(n) for n in outputs]).drop("_digest")


def drop_copies(df: DataFrame, columns: list[str], first_by: list[Column]) -> DataFrame:
    """Keep the first row of each set of rows that agree on ``columns``; other columns stay."""
    return _first_per_key(df.withColumn("_digest", _digest(columns)), ["_digest"], first_by).drop("_digest")


def upsert(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The target with incoming rows put in, replacing rows of the same key.

    ``incoming`` has one row per key. Only its keys take part in the join: if they are small by
    Spark's own estimate they are broadcast and the target is not shuffled.
    """
    kept = target.join(incoming.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(incoming.select(*target.columns))


def upsert_aligned(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``upsert`` of two tables that are dealt by the key alike, as by the same buckets: neither side
    is exchanged, and the result is dealt like them. Both have one row per key and the same columns."""
    new = incoming.select(F.col(key).alias("_key"), F.struct(*incoming.columns).alias("_new"))
    old = target.select(key, F.struct(*target.columns).alias("_old"))
    both = old.join(new, F.col(key) == F.col("_key"), "full_outer")
    row = F.when(F.col("_key").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return both.select(row.alias("_row")).select("_row.*")


def without_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known``."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def latest_row(df: DataFrame, by: str) -> DataFrame:
    """The row with the greatest ``by``, as one aggregate rather than a sort."""
    row = F.max_by(F.struct(*df.columns), F.col(by)).alias("row")
    return df.agg(row).select("row.*")


def top_recent(df: DataFrame, by: str, rows: int = 10) -> DataFrame:
    return df.orderBy(F.col(by).desc()).limit(rows)
