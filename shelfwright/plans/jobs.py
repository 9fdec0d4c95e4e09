"""File-to-file jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.functions.encoders import HashedCounts
from shelfwright.operators.audit import audit_summary, with_verdict
from shelfwright.operators.decisions import build_prompts, describe_product
from shelfwright.operators.knn import TOP_K
from shelfwright.operators.rows import require_columns
from shelfwright.plans.catalogue import classify_products, find_candidates, leaf_candidates
from shelfwright.sources.sinks import classified_path, materialize, write_csv
from shelfwright.sources.tables import read_products, read_taxonomy

ROW = "row_idx"


def load_candidates(
    spark: SparkSession, taxonomy_path: str, cache: str | None = None, encoder: Callable = HashedCounts, rebuild: bool = False
) -> DataFrame:
    """Leaf categories with vectors, built once where a ``cache`` folder is named."""

    def make():
        return leaf_candidates(read_taxonomy(spark, taxonomy_path), encoder)

    return materialize(spark, make, cache, rebuild) if cache else make()


def select_rows(products: DataFrame, start: int = 0, end: int | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a numbered product file by position; a plain filter on the row number."""
    if end is None and limit is not None:
        end = start + limit
    rows = products.where(F.col(ROW) >= start)
    return rows if end is None else rows.where(F.col(ROW) < end)


def reclassify_file(
    spark: SparkSession,
    products_path: str,
    candidates: DataFrame,
    output_path: str | None = None,
    start: int = 0,
    end: int | None = None,
    limit: int | None = None,
    encoder: Callable = HashedCounts,
    k: int = TOP_K,
    decisions: DataFrame | None = None,
    fill_path: bool = False,
) -> str:
    """Classify a product file (or a range of its rows) into a new file, rows in input order.

    ``decisions`` holds the reviewer's answers by ``row_idx``. Returns the output path.
    """
    products = select_rows(read_products(spark, products_path, row_idx=True), start, end, limit)
    done = classify_products(products, candidates, ROW, encoder, k, decisions, fill_path)
    output = output_path or classified_path(products_path)
    write_csv(done.orderBy(ROW).drop(ROW), output)
    return output


def review_prompts(
    products: DataFrame, candidates: DataFrame, key: str = ROW, encoder: Callable = HashedCounts, k: int = TOP_K
) -> DataFrame:
    """What to send to the reviewer: key, candidates as JSON, prompt. Answers come back as a
    table of key, response_text and error."""
    found = find_candidates(products, candidates, key, encoder, k)
    return build_prompts(describe_product(found), key)


def audit_file(spark: SparkSession, products_path: str, probes: DataFrame, output_path: str | None = None) -> DataFrame:
    """Check the image addresses of a product file; write the audited rows if a path is given
    and return the summary."""
    products = require_columns(read_products(spark, products_path, row_idx=True), ["product_image_url"])
    audited = with_verdict(products, probes, ROW)
    if output_path:
        write_csv(audited.orderBy(ROW).drop(ROW), output_path)
    return audit_summary(audited)
