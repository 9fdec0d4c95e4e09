"""Sinks: product files and derived tables kept for reuse."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright.schemas import PRODUCT_SCHEMA
from shelfwright.operators.rows import to_product_schema


def csv_ready(df: DataFrame) -> DataFrame:
    """Every column as text: NULL as '', timestamps in ISO form."""

    def as_text(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    return df.select(*[as_text(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, store_empty: bool = True) -> bool:
    """Write any frame with its own columns. False if nothing was written."""
    if not store_empty and df.isEmpty():
        return False
    (
        csv_ready(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return True


def write_products(df: DataFrame, path: str, store_empty: bool = False, schema: T.StructType = PRODUCT_SCHEMA) -> bool:
    """Write the fixed product columns, replacing what is there; no file for no rows."""
    return write_csv(to_product_schema(df, schema), path, store_empty)


def classified_path(path: str) -> str:
    """Default output name: ``<stem>_classified`` beside the input."""
    stem, ext = os.path.splitext(path.rstrip("/"))
    return f"{stem}_classified{ext or '.csv'}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialize(spark: SparkSession, make: Callable[[], DataFrame], path: str, rebuild: bool = False) -> DataFrame:
    """Build a derived table once, then read it; ``rebuild`` forces a new one.

    Only a table whose write was committed counts as present.
    """
    if rebuild or not _exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
