"""Wide daily tables to long series, and display formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import title_case


def metric_series(df: DataFrame, date: str, metrics: list[str]) -> DataFrame:
    """One row per date and metric; gaps stay null."""
    return df.unpivot(date, metrics, "metric", "n")


def column_label(name: Column | str) -> Column:
    """``missing_post_id`` to ``Missing Post Id``."""
    name = F.col(name) if isinstance(name, str) else name
    return title_case(F.replace(name, F.lit("_"), F.lit(" ")))


def day_text(c: Column | str) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit("N/A"))


def minute_text(c: Column | str) -> Column:
    return F.coalesce(F.date_format(c, "dd/MM/yyyy HH:mm"), F.lit("N/A"))
