"""Category tree operators: leaves, readable paths, the flat leaf table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.session import lookup_join


def _parents(tax: DataFrame) -> DataFrame:
    return tax.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("id")).distinct()


def with_is_leaf(tax: DataFrame) -> DataFrame:
    """Add ``is_leaf``: the node is nobody's parent."""
    marked = _parents(tax).withColumn("_parent", F.lit(True))
    return tax.join(marked, "id", "left").withColumn("is_leaf", F.col("_parent").isNull()).drop("_parent")


def leaves(tax: DataFrame) -> DataFrame:
    return tax.join(_parents(tax), "id", "left_anti")


def resolve_paths(nodes: DataFrame, tax: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Add ``rich_text``: the dotted id path spelled with names, ``A > B > C``.

    An id that is not in ``tax`` shows as ``Unknown(id)``, a segment that is no number as
    ``Invalid(segment)``, a missing path as ''. The root's id occurs in a large share of all
    paths, so the name lookup is the skew-safe one. Each path is spelled once; rows stay as they are,
    repeated ones too, and of several names of one id the smallest counts.
    """
    paths = nodes.select("path").where(F.col("path").isNotNull()).distinct()
    segs = paths.select("path", F.posexplode(F.split("path", r"\.")).alias("_pos", "_seg"))
    segs = segs.withColumn("_node", F.expr("try_cast(_seg AS BIGINT)"))
    lookup = tax.select(F.col("id").alias("_node"), F.col("name").alias("_name")).groupBy("_node").agg(F.min("_name").alias("_name"))
    named = lookup_join(segs, lookup, "_node", F.col("path"), max_rows)
    label = F.when(F.col("_node").isNull(), F.concat(F.lit("Invalid("), "_seg", F.lit(")"))).otherwise(
        F.coalesce("_name", F.concat(F.lit("Unknown("), "_seg", F.lit(")")))
    )
    parts = F.array_sort(F.collect_list(F.struct("_pos", label.alias("label"))))
    spelled = named.groupBy("path").agg(F.array_join(F.transform(parts, lambda p: p["label"]), " > ").alias("rich_text"))
    out = nodes.join(spelled, "path", "left")
    return out.select(*nodes.columns, F.coalesce("rich_text", F.lit("")).alias("rich_text"))


def flatten_taxonomy(tax: DataFrame) -> DataFrame:
    """Leaf nodes with a non-empty readable path."""
    return resolve_paths(leaves(tax), tax).where(F.col("rich_text") != "").withColumn("is_leaf", F.lit(True))


def as_candidates(flat: DataFrame) -> DataFrame:
    """Flat leaf table in the shape the nearest-neighbour search expects."""
    return flat.select(
        "id",
        "name",
        F.col("rich_text").alias("path"),
        F.coalesce(F.col("path"), F.col("id").cast("string")).alias("numeric_path"),
    )
