"""Cleaning of staging rows, and the split into good and rejected rows.

The work is laid out as a few projections, each using columns of the one before, so that a
text is normalised once however many values and messages depend on it. No shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import address, dates, labels, measures
from ..functions.text import plain_ascii, quoted_message
from ..operators.conditions import has_fields
from ..schemas import CLEAN_COLUMNS, REQUIRED_COLUMNS

# The message for rows without a required field, and the first retry status.
MISSING_FIELDS = "Thiếu các trường bắt buộc"
PENDING = "pending"

COUNT_FIELDS = ["number_bedroom", "number_bathroom", "number_floor"]
LEGAL_FLAGS = list(labels.LEGAL_KEYWORDS)


def normalised(rows: DataFrame) -> DataFrame:
    """Adds the texts that the cleaners read; all names start with ``_``."""
    return rows.withColumns(
        {
            "_parts": address.address_parts("address"),
            "_area": measures.area_text("area"),
            "_price": measures.price_text("price"),
            "_facade": measures.facade_text("facade"),
            "_legal": F.lower("legal"),
            "_furniture": F.lower("furniture"),
            "_way_in": measures.way_in_text("way_in"),
            "_status": plain_ascii("project_status"),
            "_url": F.lower("subpage_url"),
            "_start": dates.post_text("post_start_time"),
            "_end": dates.post_text("post_end_time"),
        }
    )


def first_values(rows: DataFrame) -> DataFrame:
    """Adds values that need only normalised texts: those that later ones need, and some others.

    Values are dealt to two projections, so that the code generated for each of them stays within the
    8,000 bytes that the JVM compiles.
    """
    return rows.withColumns(
        {
            "page_number": labels.page_number("main_page_url"),
            "_city": address.city_text("_parts"),
            "_district": address.district_text("_parts"),
            "area_m2": measures.area_m2("_area"),
            "_price_number": measures.price_number("_price"),
            "v_facade": measures.width("facade", "_facade"),
            **labels.legal_flags("_legal"),
            **labels.furniture_fields("_furniture"),
            "way_in_m": measures.width("way_in", "_way_in"),
        }
    )


def later_values(rows: DataFrame) -> DataFrame:
    """Adds the other values, among them the price per square metre and the address columns."""
    return rows.withColumns(
        {
            "million_per_m2": measures.million_per_m2("price", "_price", "_price_number", "area_m2"),
            **address.address_fields("_parts", "_city", "_district"),
            "v_house_direction": labels.direction("house_direction"),
            "v_balcony_direction": labels.direction("balcony_direction"),
            **{f"v_{c}": measures.count_field(c) for c in COUNT_FIELDS},
            "v_project_name": labels.project_title("project_name"),
            "project_status_stage": labels.status_stage("project_status", "_status"),
            "v_project_investor": labels.project_title("project_investor"),
            "v_post_start_time": dates.post_date_of("_start"),
            "v_post_end_time": dates.post_date_of("_end"),
            "loai_bat_dong_san": labels.property_type("_url"),
        }
    )


def field_errors() -> list[Column]:
    """Messages in the order in which fields are cleaned; the first one set is reported."""
    return [
        labels.page_number_error("main_page_url"),
        address.address_error("address", "_parts", "_city", "_district"),
        measures.area_error("area", "_area", "area_m2"),
        measures.price_error("price", "_price_number", "million_per_m2"),
        measures.width_error("_facade", "v_facade"),
        labels.legal_error("_legal", [F.col(c) for c in LEGAL_FLAGS]),
        labels.furniture_error("_furniture", "furniture_type", "has_premium_furniture"),
        *[measures.count_error(c, f"v_{c}") for c in COUNT_FIELDS],
        measures.width_error("_way_in", "way_in_m"),
        labels.property_type_error("subpage_url", "loai_bat_dong_san"),
    ]


def clean(rows: DataFrame) -> DataFrame:
    """Staging rows with all cleaned values and ``error_message``, which is null for a good row.

    Cleaned values whose name a raw column has are prefixed ``v_``.
    """
    valued = later_values(first_values(normalised(rows)))
    required = F.when(~has_fields(REQUIRED_COLUMNS), MISSING_FIELDS)
    # In two steps: the first one's message is looked at twice, so that they are not made one again.
    errors = field_errors()
    early = F.col("_early_error")
    found = valued.withColumn("_early_error", F.coalesce(required, *errors[:4]))
    found = found.withColumn("error_message", F.when(early.isNotNull(), early).otherwise(F.coalesce(*errors[4:])))
    # A filter on the message would be rewritten by the optimizer into a filter on the whole
    # cleaning expression, several times the size of the cleaning itself. An expression that
    # depends on the partition is evaluated where it is written, once, and then filtered.
    once = F.when(F.spark_partition_id() >= 0, quoted_message("error_message"))
    return found.withColumn("error_message", once)


def clean_columns(transformed_at: Column | None = None) -> list[Column]:
    """The clean table's columns over ``clean`` output, without the clock column if none is given."""
    renamed = {
        "house_direction": "v_house_direction",
        "balcony_direction": "v_balcony_direction",
        "facade": "v_facade",
        **{c: f"v_{c}" for c in COUNT_FIELDS},
        "project_name": "v_project_name",
        "project_investor": "v_project_investor",
        "post_start_time": "v_post_start_time",
        "post_end_time": "v_post_end_time",
        "store_staging_at": "created_at",
    }
    out = []
    for name in CLEAN_COLUMNS:
        if name != "transformed_at":
            out.append(F.col(renamed.get(name, name)).alias(name))
        elif transformed_at is not None:
            out.append(transformed_at.alias(name))
    return out


def good_rows(cleaned: DataFrame, keep: list[str] = ["ingest_seq"]) -> DataFrame:
    return cleaned.where(F.col("error_message").isNull()).select(*clean_columns(), *keep)


def rejected_rows(cleaned: DataFrame, staging_columns: list[str]) -> DataFrame:
    return cleaned.where(F.col("error_message").isNotNull()).select(
        *staging_columns, "error_message", F.lit(PENDING).alias("retry_status")
    )
