"""Explicit schemas; nothing in this package infers types from data."""

from pyspark.sql import types as T

TAXONOMY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)

# Column order of the product file.
PRODUCT_COLUMNS = [
    "brand",
    "product_name",
    "model_number",
    "category",
    "subcategory",
    "technical_specs",
    "short_description",
    "long_description",
    "product_image_url",
    "datasheet_url",
    "type_id",
    "classification_path",
    "source_url",
]

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField(c, T.LongType() if c == "type_id" else T.StringType())
        for c in PRODUCT_COLUMNS
    ]
)

# The full record also knows when it was taken; the default file leaves this out.
RECORD_SCHEMA = T.StructType(
    PRODUCT_SCHEMA.fields + [T.StructField("scraped_timestamp", T.TimestampNTZType())]
)

# Columns that lead a re-classified product file.
CLASSIFIED_FIRST = [
    "brand",
    "product_name",
    "type_id",
    "classification_path",
    "classification_name",
    "confidence_score",
    "classification_reasoning",
]

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

CANDIDATE_TYPE = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("numeric_path", T.StringType()),
        T.StructField("distance", T.DoubleType()),
    ]
)

DECISION_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("response_text", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

PROBE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)
