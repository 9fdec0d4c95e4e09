"""What several of these operators share: row keys, batches of files, components, checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.session import settle

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

#: ASCII white space, the only white space these operators know.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

#: A side of at most so many narrow rows may be broadcast once it is counted.
BROADCAST_ROWS = 500_000


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame``, with the DuckDB query that must agree."""

    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def hash_pair(*cols: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: 128 bits, so that a collision is out of the question.

    Null values are hashed as such; the result is never null.
    """
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5DEECE66D), *cols)


def id_hash(c: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % divisor


def packed(df: DataFrame, name: str = "__row") -> Column:
    """All columns as one struct, so that no column name of the caller meets one of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(columns: list[str], new: dict[str, Column], name: str = "__row") -> list[Column]:
    """The caller's columns out of ``name``, each replaced where ``new`` has the same name, then the rest of ``new``."""
    out = [new[c].alias(c) if c in new else F.col(f"{name}.`{c}`").alias(c) for c in columns]
    return out + [v.alias(k) for k, v in new.items() if k not in columns]


def file_batches(df: DataFrame, batches: int) -> list[DataFrame]:
    """A plain scan dealt into groups of whole files, each file in one group; any other frame is one batch."""
    plan = df._jdf.queryExecution().analyzed()
    files = sorted(df.inputFiles()) if plan.getClass().getSimpleName() == "LogicalRelation" else []
    if len(files) < 2:
        return [df]
    groups = [files[i::batches] for i in range(min(batches, len(files)))]
    return [df.sparkSession.read.schema(df.schema).parquet(*g) for g in groups]


def counted_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A settled, narrow table, marked for broadcast if it is counted to be small; else left to a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def _checksum(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 31)), F.lit(0))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(u, v)``: root is the smallest node it reaches.

    Alternating large-star and small-star rounds: a round joins the edges with one minimum per
    node, never groups a node's neighbours into one row, and writes its result to the shared
    folder, so a lost executor costs one round. A star of any size is split by the skew join.
    """
    e = settle(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before, now = None, _checksum(e)
    while now != before and now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_min, "u")
        small = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = settle(small_min.select("u", F.col("m").alias("v")).unionByName(small).distinct())
        before, now = now, _checksum(e)
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
