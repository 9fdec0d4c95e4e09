"""Scans: taxonomy and product files, page snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright.schemas import PAGE_SCHEMA, TAXONOMY_SCHEMA
from shelfwright.session import is_small

# Cells of a product file that stand for nothing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy file: header, quoted commas, the literal NULL as null."""
    return (
        spark.read.schema(TAXONOMY_SCHEMA)
        .option("header", True)
        .option("nullValue", "NULL")
        .option("escape", '"')
        .csv(path)
    )


def read_products(
    spark: SparkSession, path: str, columns=None, multi_line: bool = False, row_idx: bool = False
) -> DataFrame:
    """Product file, columns in any order; all text but ``type_id`` and ``confidence_score``.

    Cells that stand for nothing are NULL. Doubled quotes inside JSON cells are read back. Files stay splittable unless
    ``multi_line`` is asked for. ``row_idx`` adds the 0-based row position.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
    )
    names = reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(n, _product_type(n)) for n in names])
    df = reader.schema(schema).csv(path)
    if row_idx:
        df = _with_row_idx(df)
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.withColumns({c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in text})
    return df.select(*columns, *(["row_idx"] if row_idx else [])) if columns else df


def _product_type(name: str) -> T.DataType:
    return {"type_id": T.LongType(), "confidence_score": T.DoubleType()}.get(name, T.StringType())


def _with_row_idx(df: DataFrame) -> DataFrame:
    """Row position over all files in name order, without a sort.

    Rows of one file split are numbered as they are read; a first pass counts the rows of
    each split (one row per split), a running sum over that table gives the offsets.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = placed.groupBy("_file", "_start").agg(F.count("*").alias("_rows"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_file", "_start", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    if is_small(offsets):
        offsets = F.broadcast(offsets)
    return (
        placed.join(offsets, ["_file", "_start"])
        .withColumn("row_idx", F.col("_before") + F.col("_mid") - F.col("_first"))
        .drop("_file", "_start", "_mid", "_first", "_before")
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page snapshots (page_id, url, html) from parquet."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)
