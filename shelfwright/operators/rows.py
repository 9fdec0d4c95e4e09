"""Row and column selection: required columns, positions, column order, record shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwright.functions.text import blank
from shelfwright.schemas import RECORD_SCHEMA
from shelfwright.session import is_small, settle

_SORTABLE_ROWS = 100_000
_BINS = 1024


def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df


def _key_at(df: DataFrame, key: str, position: int):
    """The key at a 0-based position in key order, None past the end.

    Narrows the key range by counting rows in equal-width bins, reading the key column only,
    until few enough rows are left to sort. Keys must be unique whole numbers.
    """
    k = F.col(key).cast("bigint")
    lo, hi, rows = df.agg(F.min(k), F.max(k), F.count(k)).first()
    if position >= rows:
        return None
    while rows > _SORTABLE_ROWS and hi > lo:
        width = (hi - lo) // _BINS + 1
        inside = df.where(F.col(key).between(lo, hi))
        bins = inside.groupBy(F.floor((k - F.lit(lo)) / F.lit(width)).cast("bigint").alias("b")).count()
        for b, n in sorted(bins.collect()):  # at most _BINS rows
            if position < n:
                lo, hi, rows = lo + b * width, min(hi, lo + (b + 1) * width - 1), n
                break
            position -= n
    near = df.where(F.col(key).between(lo, hi)).select(k.alias("k"))
    at = near.orderBy("k").offset(position).limit(1).first()["k"]
    if near.where(F.col("k") == at).count() > 1:
        raise ValueError(f"{key} {at} is repeated: a row range cannot end inside it")
    return at


def slice_rows(df: DataFrame, key: str, start: int = 0, end: int | None = None, limit: int | None = None) -> DataFrame:
    """Rows ``[start, end)`` or ``[start, start + limit)`` in ``key`` order; neither: from ``start``.

    Positions are first turned into key bounds, so the result is a plain range filter that
    reaches the file scan: no global sort, no numbering of all rows. A bound on a repeated key
    is an error; rows without a key have no position and are in no range. ``end`` goes before
    ``limit``. (A start with a limit selects the documented rows, not an empty set.)
    """
    if end is None and limit is not None:
        end = start + limit
    if end is not None and end <= start:
        return df.limit(0)
    df = df.where(F.col(key).isNotNull())
    if start > 0:
        first = _key_at(df, key, start)
        if first is None:
            return df.limit(0)
        lower = F.col(key) >= F.lit(first)
    else:
        lower = None
    upper = None
    if end is not None:
        stop = _key_at(df, key, end)
        upper = F.col(key) < F.lit(stop) if stop is not None else None
    for cond in (lower, upper):
        if cond is not None:
            df = df.where(cond)
    return df


def limit_items(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n records in a stated order."""
    return df.orderBy(*order).limit(n)


def columns_first(df: DataFrame, first) -> DataFrame:
    """``first`` in front, every other column after it in its old order; absent ones as NULL."""
    have = [F.col(c) if c in df.columns else F.lit(None).cast(_kind(c)).alias(c) for c in first]
    return df.select(*have, *[c for c in df.columns if c not in first])


def _kind(column: str) -> str:
    return {"type_id": "bigint", "confidence_score": "double"}.get(column, "string")


def to_product_schema(df: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Known fields only, in order, typed; absent ones NULL, unknown ones left out."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def first_per_url(df: DataFrame, url: str = "url", order: str = "page_id") -> DataFrame:
    """One row per URL: the one with the lowest ``order``, which must be unique.

    Only the two narrow columns are grouped and joined, which leaves the ids of the rows to
    drop. Those are written, counted, and broadcast if they are few, so that the wide rows
    stay where they are.
    """
    first = df.groupBy(url).agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
    narrow, first = df.select(url, order).alias("a"), first.where("_n > 1").alias("b")
    copies = narrow.join(first, F.col(f"a.{url}").eqNullSafe(F.col(f"b.{url}")))
    drop = settle(copies.where(F.col(f"a.{order}") != F.col("_first")).select(F.col(f"a.{order}").alias(order)))
    return df.join(F.broadcast(drop) if is_small(drop) else drop, order, "left_anti")


def dedupe_products(products: DataFrame, order: str = "page_id") -> DataFrame:
    return first_per_url(products, "source_url", order)


def fill_blank(df: DataFrame) -> DataFrame:
    """NULL text to ''; other types stay as they are."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank(F.col(c)) for c in text}) if text else df


def default_name(name: Column) -> Column:
    return F.coalesce(name, F.lit("Unknown"))
