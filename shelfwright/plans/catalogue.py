"""The jobs: pages to products, cleaning, classification, re-classification, audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.functions.encoders import HashedCounts
from shelfwright.functions.text import blank, canonical_json, clean_ws
from shelfwright.functions.urls import link_route, same_site
from shelfwright.operators import extract as X
from shelfwright.operators.decisions import (
    attach_to_items,
    attach_to_rows,
    decide_by_vector,
    query_text,
    reconcile,
)
from shelfwright.operators.knn import TOP_K, embed, nearest
from shelfwright.operators.links import card_graph, crawl_closure, link_graph
from shelfwright.operators.page_facts import page_facts
from shelfwright.operators.rows import columns_first, first_per_url, slice_rows, to_product_schema
from shelfwright.operators.taxonomy import as_candidates, flatten_taxonomy
from shelfwright.plans.site_profiles import SITE_A, SITE_B, SiteProfile
from shelfwright.schemas import CLASSIFIED_FIRST, RECORD_SCHEMA
from shelfwright.session import is_small

#: What a field of site A is made of: page facts, and other fields. ``None`` is what every row needs.
FIELDS_A = {
    None: (("heads", "classes"), ()),
    "variants": (("elements", "rows"), ()),
    "product_name": (("title", "heads", "marked"), ("specs",)),
    "specs": (("rows", "items", "elements", "strings"), ()),
    "model_number": ((), ("product_name", "specs")),
    "subcategory": (("elements",), ()),
    "short_description": (("marked", "paras"), ()),
    "long_description": (("metas", "paras"), ()),
    "product_image_url": (("metas", "images"), ()),
    "datasheet_url": (("links",), ()),
    "technical_specs": ((), ("specs",)),
}
#: The same of site B.
FIELDS_B = {
    None: (("heads", "links"), ()),
    "product_name": (("heads", "title"), ()),
    "specs": (("rows", "kin", "plain"), ()),
    "model_number": (("body_text",), ("product_name",)),
    "subcategory": (("elements",), ()),
    "short_description": (("paras",), ()),
    "long_description": (("metas", "paras"), ()),
    "datasheet_url": (("links",), ()),
    "technical_specs": ((), ("specs",)),
}


def needs(fields: dict, columns) -> tuple[set[str], list[str]]:
    """The fields that ``columns`` (all if None) are made of, directly or not, and the facts all of them read."""
    todo = [None, *(fields if columns is None else columns)]
    names: set = set()
    while todo:
        name = todo.pop()
        if name not in names:
            names.add(name)
            todo += fields.get(name, ((), ()))[1]
    facts = dict.fromkeys(f for name, (own, _) in fields.items() if name in names for f in own)
    return names, list(facts)


def extract_a(
    pages: DataFrame, profile: SiteProfile = SITE_A, variants: bool = True, columns: list[str] | None = None
) -> DataFrame:
    """Product rows of site A pages: page_id, item_id (unique, also among the variants of one
    page), the product fields, ``specs`` as a map.

    ``columns`` limits the result, and with it the rules built and the facts read, since nothing
    prunes below the page reading. Works the same on a stream. Page tests run before the field
    expressions.
    """
    url = F.col("url")
    wanted, names = needs(FIELDS_A, None if columns is None else [*columns, *(["variants"] if variants else [])])
    facts = page_facts(pages, names, profile.watch(), keep=["page_id", "url"])
    facts = facts.where(X.is_product_page_a(url))
    early = {"product_name": X.product_name_a, "specs": X.specs_a}
    df = facts.withColumns({n: rule() for n, rule in early.items() if n in wanted})
    rules = {
        "product_name": lambda: F.col("product_name"),
        "model_number": lambda: X.model_number_a(F.col("product_name"), url, F.col("specs")),
        "subcategory": lambda: blank(F.coalesce(X.subcategory_a(url), X.subcategory_breadcrumb(profile.crumb_stop))),
        "specs": lambda: F.col("specs"),
        "short_description": X.short_description_a,
        "long_description": X.long_description_a,
        "product_image_url": lambda: X.image_url(url),
        "datasheet_url": lambda: X.datasheet_a(url),
        "variants": lambda: X.variant_rows(profile),
    }
    own = [rule().alias(n) for n, rule in rules.items() if n in wanted and (variants or n != "variants")]
    df = df.select("page_id", F.lit(profile.brand).alias("brand"), *own, url.alias("source_url"))
    if variants:
        df = X.explode_variants(df)
    else:
        df = df.withColumns({"is_variant": F.lit(False), "variant_pos": F.lit(0)})
    df = df.withColumn("item_id", F.concat_ws("-", "page_id", "variant_pos"))
    if "technical_specs" in wanted:
        json = F.when(F.col("is_variant"), F.to_json("specs")).otherwise(X.specs_to_json(F.col("specs")))
        df = df.withColumn("technical_specs", json)
    return df if columns is None else df.select(*columns)


def extract_b(pages: DataFrame, profile: SiteProfile = SITE_B, columns: list[str] | None = None) -> DataFrame:
    """Product rows of site B pages: page_id, item_id, the product fields, ``specs`` as a map.

    ``columns`` limits the result, the rules built and the facts read.
    """
    url = F.col("url")
    wanted, names = needs(FIELDS_B, columns)
    facts = page_facts(pages, names, profile.watch(), keep=["page_id", "url"])
    facts = facts.where(X.is_product_page_b())
    early = {"product_name": X.product_name_b, "specs": X.specs_b}
    df = facts.withColumns({n: rule() for n, rule in early.items() if n in wanted})

    def subcategory():
        by_url = F.nullif(X.subcategory_b(url, profile.url_root, profile.url_stop), F.lit(""))
        return F.coalesce(by_url, X.subcategory_breadcrumb(profile.crumb_stop))

    rules = {
        "product_name": lambda: F.col("product_name"),
        "model_number": lambda: X.model_number_b(F.col("product_name"), url, F.col("body_text")),
        "subcategory": subcategory,
        "specs": lambda: F.col("specs"),
        "technical_specs": lambda: X.specs_to_json(F.col("specs")),
        "short_description": X.short_description_b,
        "long_description": X.long_description_b,
        "datasheet_url": lambda: X.datasheet_b(url),
    }
    out = df.select(
        "page_id",
        F.col("page_id").cast("string").alias("item_id"),
        F.lit(profile.brand).alias("brand"),
        *[rule().alias(n) for n, rule in rules.items() if n in wanted],
        F.lit(None).cast("string").alias("product_image_url"),
        url.alias("source_url"),
    )
    return out if columns is None else out.select(*columns)


EXTRACT = {SITE_A.brand: extract_a, SITE_B.brand: extract_b}


#: Whether a page is a product page, on sites that list their pages as cards.
PAGE_TEST = {SITE_A.brand: X.is_product_page_a}


def crawled_pages(
    pages: DataFrame, profile: SiteProfile, max_depth: int | None = None, page_test: Callable | None = None
) -> DataFrame:
    """The snapshots a crawl from ``profile.seeds`` reaches and takes for product pages, one per URL.

    A site with cards is followed by its cards and next pages, and every page reached is a
    candidate for the page tests of its extraction; any other site by the routes of its links, and
    the product links are the candidates. Only URLs move until the pages meet the reached ones,
    which are broadcast if they are counted to be few.
    """
    spark = pages.sparkSession
    mine = first_per_url(_own_pages(pages, profile))
    if profile.card_class:
        test = page_test or PAGE_TEST[profile.brand]
        graph = card_graph(mine, profile, test(F.col("url")))
    else:
        graph = link_graph(mine, lambda href, to: link_route(href, to, profile))
    seeds = spark.createDataFrame([(s,) for s in profile.seeds], "url string")
    reached = crawl_closure(graph, seeds, max_depth)
    if not profile.card_class:
        reached = reached.where("route = 'product'")
    urls = reached.select("url")
    return mine.join(F.broadcast(urls) if is_small(urls) else urls, "url", "left_semi").select(*pages.columns)


def _own_pages(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    return pages.where(same_site(F.col("url"), list(profile.hosts))) if profile.hosts else pages


def products_from_pages(pages: DataFrame, profile: SiteProfile, extract: Callable | None = None) -> DataFrame:
    """Snapshots of one site to product records, one extraction per URL.

    The host test is a plain column test, so it runs at the scan, before de-duplication and
    long before any page is read. ``extract`` overrides the rules for another site.
    """
    extract = extract or EXTRACT[profile.brand]
    return extract(first_per_url(_own_pages(pages, profile)), profile)


def crawl_products(
    pages: DataFrame,
    profile: SiteProfile,
    extract: Callable | None = None,
    max_depth: int | None = None,
    page_test: Callable | None = None,
) -> DataFrame:
    """The crawl job: seeds, closure over the links of the snapshots, reached product pages, records."""
    extract = extract or EXTRACT[profile.brand]
    return extract(crawled_pages(pages, profile, max_depth, page_test), profile)


def clean_products(products: DataFrame, stamp: bool = True) -> DataFrame:
    """Timestamp, whitespace of the three text fields, specification JSON."""
    new = {c: clean_ws(F.col(c)) for c in ("product_name", "short_description", "long_description")}
    new["technical_specs"] = canonical_json(F.col("technical_specs"))
    if stamp:
        new["scraped_timestamp"] = F.localtimestamp()
    return products.withColumns({c: v for c, v in new.items() if c in products.columns or c == "scraped_timestamp"})


def leaf_candidates(taxonomy: DataFrame, encoder: Callable = HashedCounts) -> DataFrame:
    """The leaf categories with label, path and vector: what products are matched against.

    Build it once and keep it with ``materialize``; it is small beside the products.
    """
    return embed(as_candidates(flatten_taxonomy(taxonomy)), "path", encoder)


def find_candidates(
    products: DataFrame, candidates: DataFrame, key: str, encoder: Callable = HashedCounts, k: int = TOP_K, **opts
) -> DataFrame:
    """Products with their ranked candidates list."""
    vectors = embed(query_text(products), "query_text", encoder).drop("query_text")
    return nearest(vectors, candidates, k, key, **opts).drop("embedding")


def classify_products(
    products: DataFrame,
    candidates: DataFrame,
    key: str,
    encoder: Callable = HashedCounts,
    k: int = TOP_K,
    decisions: DataFrame | None = None,
    fill_path: bool = False,
    start: int = 0,
    end: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Re-classification of a product table: select rows, embed, search, decide, attach.

    Without outside answers no join is needed at all: each row's class comes from its own
    candidates. With answers there is one join on the unique product key.
    """
    if start or end is not None or limit is not None:
        products = slice_rows(products, key, start, end, limit)
    old = ("type_id", "classification_path", "classification_name", "classification_reasoning", "confidence_score")
    rows = products.drop(*old)
    found = find_candidates(rows, candidates, key, encoder, k)
    if decisions is None:
        done = decide_by_vector(found, fill_path)
    else:
        done = reconcile(found, decisions, key)
    return columns_first(done.drop("chosen_rank", "status"), CLASSIFIED_FIRST)


def catalogue(
    pages: DataFrame,
    profile: SiteProfile,
    candidates: DataFrame | None = None,
    decisions: DataFrame | None = None,
    encoder: Callable = HashedCounts,
    classify: bool = True,
    key: str = "item_id",
    extract: Callable | None = None,
    crawl: bool = False,
    page_test: Callable | None = None,
) -> DataFrame:
    """Pages to finished product records. ``classify=False`` leaves classification out.

    ``decisions`` are keyed by ``item_id``: variants share a page, so the page is no key.
    ``extract`` overrides the rules for another site, ``page_test`` its test of product pages;
    ``crawl`` takes only the pages that the site's seeds lead to.
    """
    if crawl:
        items = crawl_products(pages, profile, extract, page_test=page_test)
    else:
        items = products_from_pages(pages, profile, extract)
    items = clean_products(items)
    if classify and candidates is not None:
        found = find_candidates(items, candidates, key, encoder)
        if decisions is None:
            done = decide_by_vector(found)
        else:
            done = reconcile(found, decisions, key)
        items = done.withColumn("category", F.col("classification_name"))
    return to_product_schema(items, RECORD_SCHEMA)


__all__ = [
    "attach_to_items",
    "attach_to_rows",
    "catalogue",
    "classify_products",
    "clean_products",
    "crawl_products",
    "crawled_pages",
    "extract_a",
    "extract_b",
    "find_candidates",
    "leaf_candidates",
    "products_from_pages",
]
