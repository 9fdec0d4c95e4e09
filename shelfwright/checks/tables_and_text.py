"""Scans, row selection and text rules."""

from pyspark.sql import functions as F

from shelfwright.checks import sqltext as S
from shelfwright.checks.registry import query, table
from shelfwright.functions import text as X
from shelfwright.operators import rows as R
from shelfwright.plans.catalogue import clean_products
from shelfwright.plans.site_profiles import A_NOISE_PHRASES
from shelfwright.sources.tables import read_pages


@query("pages_scan", "SELECT page_id, url, length(html) AS n_chars, md5(html) AS digest FROM pages")
def pages_scan(spark, d):
    pages = read_pages(spark, f"{d}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").alias("n_chars"), F.md5("html").alias("digest"))


def _numbered(cond):
    return (
        "SELECT o_orderkey, o_custkey, o_totalprice FROM "
        "(SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders) "
        f"WHERE {cond}"
    )


@query("slice_range", _numbered("pos >= 100 AND pos < 1200"))
def slice_range(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.slice_rows(o, "o_orderkey", start=100, end=1200)


@query("slice_limit", _numbered("pos >= 50 AND pos < 55"))
def slice_limit(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.slice_rows(o, "o_orderkey", start=50, limit=5)


@query("slice_from", _numbered("pos >= 1000"))
def slice_from(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.slice_rows(o, "o_orderkey", start=1000)


@query(
    "item_limit",
    "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 50",
)
def item_limit(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    return R.limit_items(p, 50, F.col("p_retailprice").desc(), F.col("p_partkey"))


@query(
    "columns_first",
    "SELECT p_brand AS brand, p_name AS product_name, CAST(NULL AS BIGINT) AS type_id, p_partkey, p_size FROM part",
)
def columns_first(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"))
    return R.columns_first(p, ["brand", "product_name", "type_id"])


@query(
    "to_schema",
    "SELECT p_brand AS brand, p_name AS product_name, NULL::VARCHAR AS model_number, NULL::VARCHAR AS category, "
    "p_type AS subcategory, NULL::VARCHAR AS technical_specs, NULL::VARCHAR AS short_description, "
    "NULL::VARCHAR AS long_description, NULL::VARCHAR AS product_image_url, NULL::VARCHAR AS datasheet_url, "
    "CAST(p_size AS BIGINT) AS type_id, NULL::VARCHAR AS classification_path, "
    "'/p/' || p_partkey AS source_url, NULL::TIMESTAMP AS scraped_timestamp FROM part",
)
def to_schema(spark, d):
    p = table(spark, d, "part").selectExpr(
        "p_size AS type_id",
        "concat('/p/', p_partkey) AS source_url",
        "p_type AS subcategory",
        "p_name AS product_name",
        "p_brand AS brand",
        "p_retailprice AS not_a_field",
    )
    return R.to_product_schema(p)


@query(
    "dedupe_products",
    "SELECT page_id, source_url, product_name FROM (SELECT p_partkey AS page_id, "
    "concat('https://shop.example.com/', p_brand, '/', p_type) AS source_url, p_name AS product_name, "
    "row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1",
)
def dedupe_products(spark, d):
    p = table(spark, d, "part").selectExpr(
        "p_partkey AS page_id",
        "concat('https://shop.example.com/', p_brand, '/', p_type) AS source_url",
        "p_name AS product_name",
    )
    return R.dedupe_products(p)


def _documents(name, rule, sql):
    """A text rule over the whole documents table."""

    @query(name, f"SELECT doc_id, {sql} AS result FROM documents")
    def run(spark, d):
        return table(spark, d, "documents").select("doc_id", rule(F.col("text")).alias("result"))


_documents("clean_ws", X.clean_ws, S.clean_ws("text"))
_documents("clean_strict", X.clean_strict, S.clean_strict("text"))
_documents("title_case", X.title_case, S.title_case("text"))
_documents("normalize_key", X.normalize_key, S.normalize_key("text"))
_documents(
    "ellipsize",
    lambda c: X.ellipsize(c, 500),
    "CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '...' ELSE text END",
)


def _pages(name, rule, sql):
    """A markup rule over the whole page table."""

    @query(name, f"SELECT page_id, {sql} AS result FROM pages")
    def run(spark, d):
        return table(spark, d, "pages").select("page_id", rule(F.col("html")).alias("result"))


_pages("clean_tags_space", X.clean_tags_space, S.clean_tags_space("html"))
_pages("clean_tags", X.clean_tags, S.clean_tags("html"))
_pages("strip_markup", X.strip_markup, S.strip_markup("html"))

_NOISY = "concat('Local dealers ', source, ' Downloads', text, 'Instruction manual Product data sheet.')"


def _without_phrases(c):
    for p in A_NOISE_PHRASES:
        c = f"replace({c}, '{p}', '')"
    return c


@query("strip_phrases", f"SELECT doc_id, {S.clean_strict(_without_phrases(_NOISY))} AS result FROM documents")
def strip_phrases(spark, d):
    return table(spark, d, "documents").select("doc_id", X.strip_phrases(F.expr(_NOISY), A_NOISE_PHRASES).alias("result"))


@query(
    "canonical_json",
    "SELECT event_id, CAST(json(props) AS VARCHAR) AS specs, event_type AS other FROM events",
)
def canonical_json(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id", X.canonical_json(F.col("props")).alias("specs"), X.canonical_json(F.col("event_type")).alias("other")
    )


@query(
    "fill_blank",
    "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), '') AS status, "
    "coalesce(nullif(o_orderpriority, '5-LOW'), '') AS priority, o_totalprice FROM orders",
)
def fill_blank(spark, d):
    o = table(spark, d, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') AS status", "nullif(o_orderpriority, '5-LOW') AS priority", "o_totalprice"
    )
    return R.fill_blank(o)


@query(
    "default_name",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Unknown' ELSE c_name END AS name FROM customer",
)
def default_name(spark, d):
    c = table(spark, d, "customer")
    name = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_name"))
    return c.select("c_custkey", R.default_name(name).alias("name"))


@query(
    "clean_products",
    f"SELECT doc_id, {S.clean_ws('source')} AS product_name, {S.clean_ws('text')} AS short_description, "
    f"{S.clean_ws('NULL')} AS long_description, "
    "concat('{\"lang\":\"', lang, '\",\"chars\":', n_chars, '}') AS technical_specs FROM documents",
)
def clean(spark, d):
    p = table(spark, d, "documents").selectExpr(
        "doc_id",
        "concat(' ', source, ' ') AS product_name",
        "text AS short_description",
        "CAST(NULL AS STRING) AS long_description",
        "concat('{\"lang\": \"', lang, '\",  \"chars\" : ', n_chars, '}') AS technical_specs",
    )
    return clean_products(p, stamp=False)
