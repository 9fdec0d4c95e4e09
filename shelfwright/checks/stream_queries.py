"""Streams run to their end into a scratch folder and compared with plain SQL."""

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from shelfwright.checks import sqltext as S
from shelfwright.checks.class_queries import LABELS, PART_C, counts, ranked, tree, whole_counts
from shelfwright.checks.page_queries import H1, SHORT_A
from shelfwright.checks.registry import query, table
from shelfwright.operators.taxonomy import flatten_taxonomy
from shelfwright.plans.catalogue import leaf_candidates
from shelfwright.plans.site_profiles import SITE_A
from shelfwright.session import shared_dir
from shelfwright.streaming import items as ST


#: The page table stands in for the site, so its hosts are the site's.
ANY_HOST = replace(SITE_A, hosts=())


def _run(spark, stream):
    base = f"{shared_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    q = ST.run_stream(stream, f"{base}/out", f"{base}/state")
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query(
    "stream_items",
    f"SELECT page_id, 'Flex' AS brand, {S.clean_ws(S.clean_strict(H1))} AS product_name, '' AS long_description, "
    "url AS source_url FROM pages",
)
def stream_items(spark, d):
    items = ST.item_stream(ST.page_stream(spark, d, "pages.parquet"), ANY_HOST)
    return _run(spark, items.select("page_id", "brand", "product_name", "long_description", "source_url"))


_TEXTS = f"(SELECT page_id AS query_id, concat({S.clean_strict(H1)}, ' ', {SHORT_A}) AS t FROM pages)"


@query(
    "stream_classified",
    "SELECT query_id AS page_id, id AS type_id, name AS category, numeric_path AS classification_path, 0.5 AS confidence_score "
    f"FROM {ranked(counts(_TEXTS), PART_C, 1)}",
)
def stream_classified(spark, d):
    """Every stage on the stream: de-duplicate, extract, clean, embed, search, decide."""
    cands = leaf_candidates(tree(spark, d), whole_counts)
    items = ST.item_stream(ST.page_stream(spark, d, "pages.parquet"), ANY_HOST, candidates=cands, encoder=whole_counts, fill_path=True)
    return _run(spark, items.select("page_id", "type_id", "category", "classification_path", "confidence_score"))


@query("stream_dedupe", "SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS url FROM pages")
def stream_dedupe(spark, d):
    """Pages whose address is cut to the host, so most of them are copies."""
    pages = ST.page_stream(spark, d, "pages.parquet")
    hosts = pages.select(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("url"))
    return _run(spark, ST.once_per_url(hosts))


@query(
    "stream_taxonomy_join",
    f"SELECT event_id, user_id + 1000 AS type_id, name AS category_name FROM events LEFT JOIN {LABELS} ON id = user_id + 1000 AND id >= 1000",
)
def stream_taxonomy_join(spark, d):
    schema = table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    items = events.select("event_id", (F.col("user_id") + 1000).alias("type_id"))
    return _run(spark, ST.with_category_names(items, flatten_taxonomy(tree(spark, d)))).select(
        "event_id", "type_id", "category_name"
    )
