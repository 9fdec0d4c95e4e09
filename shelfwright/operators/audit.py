"""URL audit against a log of HEAD and GET probes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.session import SMALL_ROWS, lookup_join


def probe_outcome(probes: DataFrame, order: str = "probe_order") -> DataFrame:
    """One row per URL with its latest HEAD and GET probe, grouped with map-side combine.

    The latest is the one with the greatest ``order``; in a log without that column, the one
    with the greatest (status, error). Status and error are always those of one probe.
    """
    answer = F.struct("status", "error")
    by = F.struct(F.col(order), answer) if order in probes.columns else answer

    def of(method):
        return F.max(F.when(F.col("method") == method, F.struct(by.alias("by"), "status", "error")))

    latest = probes.where(F.col("url").isNotNull()).groupBy("url").agg(of("HEAD").alias("h"), of("GET").alias("g"))
    return latest.select(
        "url",
        F.col("h.status").alias("head_status"),
        F.col("h.error").alias("head_error"),
        F.col("g.status").alias("get_status"),
        F.col("g.error").alias("get_error"),
    )


def with_verdict(
    df: DataFrame, probes: DataFrame, row_key: str, url: str = "product_image_url", max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Add ``image_valid`` and ``image_status``.

    HEAD 200 is OK; HEAD 405 asks the GET, whose code is then the one shown; an error shows
    its text. A placeholder URL shared by very many rows does not pile up in one task.
    """
    outcome = probe_outcome(probes).withColumnRenamed("url", "_url")
    df = df.withColumn("_url", F.nullif(F.col(url), F.lit("")))
    df = lookup_join(df, outcome, "_url", F.col(row_key), max_rows)
    retried = F.col("head_status") == 405
    code = F.when(retried, F.col("get_status")).otherwise(F.col("head_status"))
    error = F.coalesce("head_error", F.when(retried, F.col("get_error")))
    status = (
        F.when(F.col("_url").isNull(), "Missing URL")
        .when(error.isNotNull(), error)
        .when(code == 200, "OK")
        .when(code.isNotNull(), F.concat(F.lit("Status "), code.cast("string")))
        .otherwise("Not probed")
    )
    df = df.withColumn("image_status", status)
    ok = F.col("_url").isNotNull() & error.isNull() & F.coalesce(code == 200, F.lit(False))
    df = df.withColumn("image_valid", ok)
    return df.drop("_url", "head_status", "head_error", "get_status", "get_error")


def audit_summary(audited: DataFrame) -> DataFrame:
    """Valid, invalid and success rate in percent; the rate of no rows is NULL."""
    return audited.agg(F.count_if("image_valid").alias("valid"), F.count("*").alias("total")).select(
        "valid",
        (F.col("total") - F.col("valid")).alias("invalid"),
        F.round(F.try_divide(F.col("valid") * 100.0, F.col("total")), 1).alias("success_rate"),
    )


def invalid_sample(audited: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first n invalid rows."""
    return (
        audited.where(~F.col("image_valid"))
        .orderBy(order)
        .limit(n)
        .select("product_name", "product_image_url", "image_status")
    )
