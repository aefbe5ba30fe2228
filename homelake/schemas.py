"""Declared table schemas. Nothing is inferred from file contents."""

from pyspark.sql import types as T

# Column names and their order in the raw listing files.
RAW_COLUMNS = [
    "main_page_url",
    "subpage_url",
    "title",
    "address",
    "price",
    "area",
    "house_direction",
    "balcony_direction",
    "facade",
    "legal",
    "furniture",
    "number_bedroom",
    "number_bathroom",
    "number_floor",
    "way_in",
    "project_name",
    "project_status",
    "project_investor",
    "post_id",
    "post_start_time",
    "post_end_time",
    "post_type",
    "source",
    "crawled_at",
]

# Fields without which a listing is rejected.
REQUIRED_COLUMNS = [
    "title",
    "address",
    "area",
    "price",
    "post_id",
    "post_start_time",
    "post_end_time",
    "post_type",
]

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

STAGING = T.StructType(
    RAW.fields
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("source_file", T.StringType()),
    ]
)

FILE_LOG = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_timestamp", T.TimestampType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

# One row is appended per committed load of bronze, those of a call at once; other loads are not visible.
LOAD_LOG = T.StructType(
    [
        T.StructField("load", T.StringType()),
        T.StructField("call", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)

# As stored: a line that could not be read is kept whole, in a column that is null otherwise.
LOADED = T.StructType(STAGING.fields + [T.StructField("corrupt_record", T.StringType())])

# The columns of the clean table, in order.
CLEAN = T.StructType(
    [
        T.StructField("main_page_url", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("subpage_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("specific_area", T.StringType()),
        T.StructField("hamlet_neighborhood", T.StringType()),
        T.StructField("ward_commune", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("province_city", T.StringType()),
        T.StructField("area_m2", T.DoubleType()),
        T.StructField("million_per_m2", T.DoubleType()),
        T.StructField("house_direction", T.StringType()),
        T.StructField("balcony_direction", T.StringType()),
        T.StructField("facade", T.DoubleType()),
        T.StructField("have_red_book", T.IntegerType()),
        T.StructField("have_pink_book", T.IntegerType()),
        T.StructField("have_sale_contract", T.IntegerType()),
        T.StructField("have_agreement_document", T.IntegerType()),
        T.StructField("furniture_type", T.StringType()),
        T.StructField("has_premium_furniture", T.IntegerType()),
        T.StructField("number_bedroom", T.IntegerType()),
        T.StructField("number_bathroom", T.IntegerType()),
        T.StructField("number_floor", T.IntegerType()),
        T.StructField("way_in_m", T.DoubleType()),
        T.StructField("project_name", T.StringType()),
        T.StructField("project_status_stage", T.StringType()),
        T.StructField("project_investor", T.StringType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("post_start_time", T.StringType()),
        T.StructField("post_end_time", T.StringType()),
        T.StructField("post_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("store_staging_at", T.TimestampType()),
        T.StructField("transformed_at", T.TimestampType()),
        T.StructField("loai_bat_dong_san", T.StringType()),
    ]
)
CLEAN_COLUMNS = CLEAN.fieldNames()

ERRORS = T.StructType(
    STAGING.fields + [T.StructField("error_message", T.StringType()), T.StructField("retry_status", T.StringType())]
)

# What a silver run writes first: clean columns of good rows, raw columns of rejected ones.
ROUTED = T.StructType(
    [T.StructField(f"v_{f.name}", f.dataType) for f in CLEAN.fields]
    + ERRORS.fields
    + [T.StructField("is_valid", T.BooleanType())]
)

# One row is appended per committed silver run; the newest row is the current state.
RUN_LOG = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("last_date", T.TimestampType()),
        T.StructField("good_rows", T.LongType()),
        T.StructField("error_rows", T.LongType()),
        T.StructField("duplicate_rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("feed", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("loads", T.ArrayType(T.StringType())),
    ]
)

# One row is appended per written version of the error table, with the last run that it holds.
ERROR_VERSIONS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("through_run", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)
