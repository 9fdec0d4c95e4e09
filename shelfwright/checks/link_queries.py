"""Link discovery, routing, closure and the crawl job."""

from dataclasses import replace

from pyspark.sql import functions as F

from shelfwright.checks import sqltext as S
from shelfwright.checks.registry import query, table
from shelfwright.functions.urls import contains_denied, link_route, looks_like_product, same_site
from shelfwright.operators import links as L
from shelfwright.operators.rows import first_per_url
from shelfwright.operators.extract import is_product_page_a
from shelfwright.plans.catalogue import crawl_products, extract_b
from shelfwright.plans.site_profiles import B_DENIED, B_PRODUCT_PATTERNS, SITE_A, SITE_B

# ---- links of the page table itself ----------------------------------------------------

_PAGE_LINKS = (
    "SELECT page_id, url, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS href, unnest(names) AS text FROM ("
    "SELECT page_id, url, regexp_extract_all(html, '<a href=\"([^\"]*)\">', 1) AS hrefs, "
    "regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1) AS names FROM pages)"
)
_SITE = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


@query(
    "links_all",
    f"SELECT page_id, pos, {S.unescape('href')} AS href, {S.unescape('text')} AS text FROM ({_PAGE_LINKS})",
)
def links_all(spark, d):
    return L.extract_links(table(spark, d, "pages")).select("page_id", "pos", "href", "text")


@query(
    "links_distinct",
    f"SELECT DISTINCT page_id, {_SITE} || {S.unescape('href')} AS abs_url FROM ({_PAGE_LINKS}) WHERE href <> ''",
)
def links_distinct(spark, d):
    return L.distinct_page_links(table(spark, d, "pages"))


# ---- pages written from the part table -------------------------------------------------

_CARD_PAGE = (
    "concat('<html><body><a class=\"nav\" href=\"/\">Home</a><p><a class=\"card-link big\" href=\"/p/', p_partkey, "
    "'.html\">', p_name, '</a><br><a href=\"/b/', p_brand, '\" class=\"x card-link\"><b>', p_brand, '</b></a>', "
    "CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 2 = 0 "
    "THEN concat('<ul><li class=\"pagination-next\"><a href=\"?page=', p_size, '\">next</a></ul>') "
    "ELSE concat('<a class=\"next\" href=\"/list/', p_size, '\">more</a><a class=\"next\" href=\"/no\">x</a>') END)"
)
_CARD_URL = "concat('https://shop.example.com/en/', lower(p_type), '/', p_partkey)"


def _written(spark, d, url, html):
    return table(spark, d, "part").selectExpr("p_partkey AS page_id", f"{url} AS url", f"{html} AS html")


@query(
    "links_by_class",
    "SELECT p_partkey AS page_id, 1 AS pos, concat('/p/', p_partkey, '.html') AS href, p_name AS text FROM part "
    "UNION ALL SELECT p_partkey, 2, concat('/b/', p_brand), p_brand FROM part",
)
def links_by_class(spark, d):
    links = L.extract_links(_written(spark, d, _CARD_URL, _CARD_PAGE), css_class="card-link")
    return links.select("page_id", "pos", "href", "text")


@query(
    "next_page",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 5 = 0 THEN NULL "
    f"WHEN p_partkey % 2 = 0 THEN concat({_CARD_URL}, '?page=', p_size) "
    "ELSE concat('https://shop.example.com/list/', p_size) END AS next_url FROM part",
)
def next_page(spark, d):
    pages = _written(spark, d, _CARD_URL, _CARD_PAGE)
    return L.next_page(pages, own_classes=("next",), within_classes=("pagination-next",)).select("page_id", "next_url")


_HREF = (
    "CASE p_partkey % 9 WHEN 0 THEN concat('javascript:go(', p_size, ')') WHEN 1 THEN concat('mailto:', p_brand) "
    "WHEN 2 THEN 'tel:123' WHEN 3 THEN concat('#', p_size) WHEN 4 THEN concat('  /lead/', p_size, ' ') "
    "WHEN 5 THEN concat('../up/', p_size) WHEN 6 THEN concat('https://else.example.org/', p_size, '?q=1') "
    "WHEN 7 THEN '' ELSE concat('./here/../', p_size, '.html#top') END"
)


def _one_link(spark, d):
    html = f"concat('<a title=\"', p_name, '\" href=\"', {_HREF}, '\">', p_brand, '</a>')"
    return L.extract_links(_written(spark, d, _CARD_URL, html))


@query(
    "links_navigable",
    f"SELECT p_partkey AS page_id, trim({_HREF}) AS href, p_name AS title FROM part WHERE p_partkey % 9 IN (4, 5, 6, 8)",
)
def links_navigable(spark, d):
    return L.keep_navigable(_one_link(spark, d)).select("page_id", "href", "title")


@query(
    "links_absolute",
    "SELECT p_partkey AS page_id, CASE p_partkey % 9 "
    "WHEN 4 THEN concat('https://shop.example.com/lead/', p_size) "
    "WHEN 5 THEN concat('https://shop.example.com/en/up/', p_size) "
    "WHEN 6 THEN concat('https://else.example.org/', p_size, '?q=1') "
    "ELSE concat('https://shop.example.com/en/', lower(p_type), '/', p_size, '.html#top') END AS abs_url "
    "FROM part WHERE p_partkey % 9 IN (4, 5, 6, 8)",
)
def links_absolute(spark, d):
    return L.with_absolute(L.keep_navigable(_one_link(spark, d))).select("page_id", "abs_url")


_HOST_URL = (
    "concat(CASE p_partkey % 5 WHEN 0 THEN 'https://gcc.sika.com' WHEN 1 THEN 'http://www.gcc.sika.com' "
    "WHEN 2 THEN 'https://gcc.sika.com:8443' WHEN 3 THEN 'https://gcc.sika.com.example.org' ELSE '' END, '/en/', p_size)"
)


@query(
    "links_same_site",
    f"SELECT p_partkey AS page_id, {_HOST_URL} AS abs_url FROM part WHERE p_partkey % 5 IN (0, 1, 4)",
)
def links_same_site(spark, d):
    links = table(spark, d, "part").selectExpr("p_partkey AS page_id", f"{_HOST_URL} AS abs_url")
    return L.keep_same_site(links, SITE_B.hosts)


# ---- URL tests on the page table's URLs and on URLs written from parts ------------------

_PART_URL = (
    "concat(CASE p_partkey % 3 WHEN 0 THEN 'https://gcc.sika.com' WHEN 1 THEN '' ELSE 'https://other.example.org' END, "
    "'/en/', CASE p_partkey % 4 WHEN 0 THEN 'construction/' WHEN 1 THEN 'industry/' WHEN 2 THEN 'Concrete/Media/' "
    "ELSE 'construction/flooring/' END, lower(p_type), '/', CASE p_partkey % 11 WHEN 0 THEN 'sikadur-' "
    "WHEN 1 THEN 'sika-' WHEN 2 THEN 'News-' WHEN 3 THEN 'my-Brochure-' WHEN 4 THEN 'SikaRep-' ELSE '' END, "
    "replace(p_name, ' ', '-'), CASE WHEN p_partkey % 7 < 3 THEN concat('-', p_partkey) ELSE '' END, "
    "CASE WHEN p_partkey % 13 = 0 THEN '/' WHEN p_partkey % 13 = 1 THEN '.htm' ELSE '.html' END)"
)
_ALL_URLS = f"SELECT p_partkey AS id, {_PART_URL} AS href FROM part UNION ALL SELECT -1 - page_id, url FROM pages"


def _any(words, col):
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


_DENIED = _any(B_DENIED, "lower(href)")
_NAMED = "(" + " OR ".join(f"regexp_matches(split_part(low, '/', -1), '{p}')" for p in B_PRODUCT_PATTERNS) + ")"
_PRODUCT = (
    f"((ends_with(low, '.html') OR ends_with(low, '.htm')) AND NOT {_DENIED} AND ({_NAMED} OR "
    f"(length(low) - length(replace(low, '/', '')) >= 6 AND {_any(SITE_B.topic_words, 'low')})))"
)
_WITH_LOW = f"(SELECT *, lower(href) AS low FROM ({_ALL_URLS}))"


def _urls(spark, d):
    parts = table(spark, d, "part").selectExpr("p_partkey AS id", f"{_PART_URL} AS href")
    return parts.unionAll(table(spark, d, "pages").selectExpr("-1 - page_id AS id", "url AS href"))


@query("url_denylist", f"SELECT id, {_DENIED} AS denied FROM ({_ALL_URLS})")
def url_denylist(spark, d):
    return _urls(spark, d).select("id", contains_denied(F.col("href"), SITE_B.denied).alias("denied"))


@query("url_is_product", f"SELECT id, {_PRODUCT} AS is_product FROM {_WITH_LOW}")
def url_is_product(spark, d):
    is_product = looks_like_product(F.col("href"), SITE_B.denied, SITE_B.product_patterns, SITE_B.topic_words)
    return _urls(spark, d).select("id", is_product.alias("is_product"))


_ABS = "CASE WHEN starts_with(href, '/') THEN concat('https://gcc.sika.com', href) ELSE href END"
_USABLE = f"regexp_matches(abs_url, '^https?://(www\\.)?gcc\\.sika\\.com(/|$)') AND NOT {_DENIED}"


@query(
    "url_route",
    f"SELECT id, abs_url, CASE WHEN {_USABLE} AND {_PRODUCT} THEN 'product' WHEN {_USABLE} AND "
    f"{_any(SITE_B.sections, 'abs_url')} THEN 'category' END AS route FROM (SELECT *, {_ABS} AS abs_url FROM {_WITH_LOW})",
)
def url_route(spark, d):
    links = _urls(spark, d).withColumn("url", F.lit("https://gcc.sika.com/en/construction.html"))
    return L.route_links(L.with_absolute(links), SITE_B).select("id", "abs_url", "route")


# ---- a site written from the supplier table ---------------------------------------------
# Every supplier is a category page. It links to up to eight child pages, back to its parent
# and the start, to one product, twice to one of the links, and to places not to be followed.

_HOME = "https://gcc.sika.com/en/construction/c"
_CHILDREN = "".join(
    f", '<li><a class=\"card\" href=\"c', s_suppkey * 8 + {j}, '.html\">child</a>'" for j in range(1, 9)
)
_TREE_PAGE = (
    "concat('<!DOCTYPE html><title>', s_name, '</title><nav><a href=\"/en/construction/c0.html\">start</a>"
    "<a href=\"mailto:x@example.com\">mail</a><a href=\"#top\">top</a></nav><ul>'"
    + _CHILDREN
    + ", '</ul><a href=\"./c', (s_suppkey + 7) DIV_8, '.html\">up</a><a href=\"/en/construction/p/sika-', s_suppkey, "
    "'.html\">', s_name, '</a><a href=\" /en/construction/p/sika-', s_suppkey, '.html\">again</a>"
    "<a href=\"https://elsewhere.example.org/en/construction/x.html\">out</a><a href=\"/en/media/n.html\">news</a>')"
)


def _site(spark, d):
    # parent of page i is (i - 1) / 8 in whole numbers, 0 for the start page
    html = _TREE_PAGE.replace("(s_suppkey + 7) DIV_8", "greatest(0, cast(floor((s_suppkey - 1) / 8) AS BIGINT))")
    return table(spark, d, "supplier").selectExpr(
        "s_suppkey AS page_id", f"concat('{_HOME}', s_suppkey, '.html') AS url", f"{html} AS html"
    )


_PARENT = "greatest(0, CAST(floor((s_suppkey - 1) / 8) AS BIGINT))"
_CHILD_ROWS = "SELECT s_suppkey, s_suppkey * 8 + j AS to_key FROM supplier, (SELECT unnest(range(1, 9)) AS j)"


@query(
    "links_unseen",
    "SELECT s_suppkey AS page_id, url FROM ("
    f"SELECT s_suppkey, concat('{_HOME}', to_key, '.html') AS url FROM ({_CHILD_ROWS}) "
    "WHERE to_key NOT IN (SELECT s_suppkey FROM supplier) UNION ALL "
    "SELECT s_suppkey, concat('https://gcc.sika.com/en/construction/p/sika-', s_suppkey, '.html') FROM supplier "
    "UNION ALL SELECT s_suppkey, 'https://elsewhere.example.org/en/construction/x.html' FROM supplier "
    "UNION ALL SELECT s_suppkey, 'https://gcc.sika.com/en/media/n.html' FROM supplier)",
)
def links_unseen(spark, d):
    pages = _site(spark, d)
    return L.unseen(L.distinct_page_links(pages), pages.select("url")).select("page_id", F.col("abs_url").alias("url"))


_CLOSURE = (
    f"WITH RECURSIVE kids AS ({_CHILD_ROWS}), walk(key, depth) AS ("
    "SELECT CAST(0 AS BIGINT), 0 UNION ALL SELECT kids.to_key, walk.depth + 1 FROM walk JOIN kids ON kids.s_suppkey = walk.key) "
    f"SELECT concat('{_HOME}', key, '.html') AS url, 'category' AS route, depth FROM walk UNION ALL "
    "SELECT concat('https://gcc.sika.com/en/construction/p/sika-', key, '.html'), 'product', depth + 1 FROM walk "
    "WHERE key IN (SELECT s_suppkey FROM supplier)"
)


def _closure(spark, d):
    pages = first_per_url(_site(spark, d))
    graph = L.link_graph(pages, lambda href, to: link_route(href, to, SITE_B))
    return L.crawl_closure(graph, spark.createDataFrame([(f"{_HOME}0.html",)], "url string"))


@query("crawl_closure", _CLOSURE)
def crawl_closure(spark, d):
    return _closure(spark, d)


# The whole job on that tree: every second product link leads to a page that is there; as many
# product pages stand beside them that no page links to.

_PRODUCT = "concat('https://gcc.sika.com/en/construction/{}/sika-', s_suppkey, '.html')"
_PRODUCT_PAGE = (
    "concat('<h1>', s_name, '</h1><h2>Product Details</h2><table><tr><td>Zone (km)</td><td>zone ', s_nationkey, "
    "'</td></tr><tr><td>zone km<td><table><tr><td>Inner</td><td>of ', s_suppkey + 100, '</td></tr></table></table>"
    "<a href=\"/en/construction/q/sika-', s_suppkey, '.html#x\">not followed from here</a>')"
)


@query(
    "crawl_products",
    f"WITH RECURSIVE kids AS ({_CHILD_ROWS}), walk(key) AS (SELECT CAST(0 AS BIGINT) UNION ALL "
    "SELECT kids.to_key FROM walk JOIN kids ON kids.s_suppkey = walk.key) "
    "SELECT 1000000 + s_suppkey AS page_id, s_name AS product_name, CAST(s_suppkey AS VARCHAR) AS model_number, "
    "concat('{\"zone km\":\"Inner\",\"inner\":\"of ', s_suppkey + 100, '\"}') AS technical_specs, "
    f"{_PRODUCT.format('p')} AS source_url FROM walk JOIN supplier ON s_suppkey = key WHERE s_suppkey % 2 = 0",
)
def crawl_products_query(spark, d):
    """Seeds to closure to reached product pages to records."""
    suppliers = table(spark, d, "supplier")
    pages = _site(spark, d)
    for n, (folder, where) in enumerate((("p", "s_suppkey % 2 = 0"), ("q", "true")), 1):
        more = suppliers.where(where).selectExpr(
            f"{n}000000 + s_suppkey AS page_id", f"{_PRODUCT.format(folder)} AS url", f"{_PRODUCT_PAGE} AS html"
        )
        pages = pages.unionByName(more)
    profile = replace(SITE_B, seeds=(f"{_HOME}0.html",))
    columns = ["page_id", "product_name", "model_number", "technical_specs", "source_url"]
    return crawl_products(pages, profile, lambda p, site: extract_b(p, site, columns))


# The same tree as a site of cards: inner pages show a grid of two cards and a next link to a
# third child, every fourth page is a leaf: a heading and no grid. The reach grows with the table.

_CARDS = "https://www.flex-tools.com/en/c"
_CARD_SITE = (
    "concat('<title>', s_name, '</title><h1>', s_name, '</h1>', CASE WHEN s_suppkey % 4 <> 3 THEN "
    "concat('<div class=\"product-card-grid\"><a class=\"card-link\" href=\"c', s_suppkey * 3 + 1, '\">x</a>"
    "<a class=\"card-link\" href=\"/en/c', s_suppkey * 3 + 2, '\">y</a></div><p class=\"pagination-next\"><a href=\"c', "
    "s_suppkey * 3 + 3, '\">next</a><a class=\"next\" href=\"/no\">no</a></p>') "
    "ELSE '<a class=\"card-link\" href=\"/related\">z</a>' END)"
)


@query(
    "crawl_closure_cards",
    "WITH RECURSIVE walk(key, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION ALL "
    "SELECT walk.key * 3 + j, walk.depth + 1 FROM walk, (SELECT unnest(range(1, 4)) AS j) "
    "WHERE walk.key % 4 <> 3 AND walk.key IN (SELECT s_suppkey FROM supplier)) "
    f"SELECT concat('{_CARDS}', key) AS url, depth, s_suppkey IS NOT NULL AND key % 4 = 3 AS is_product "
    "FROM walk LEFT JOIN supplier ON s_suppkey = key",
)
def crawl_closure_cards(spark, d):
    pages = table(spark, d, "supplier").selectExpr(
        "s_suppkey AS page_id", f"concat('{_CARDS}', s_suppkey) AS url", f"{_CARD_SITE} AS html"
    )
    graph = L.card_graph(first_per_url(pages), SITE_A, is_product_page_a(F.col("url")))
    reached = L.crawl_closure(graph, spark.createDataFrame([(f"{_CARDS}0",)], "url string"))
    found = reached.join(graph.select("url", "is_product"), "url", "left")
    return found.select("url", "depth", F.coalesce("is_product", F.lit(False)).alias("is_product"))


@query(
    "crawl_stats",
    "SELECT (SELECT count(*) FROM part) AS items_extracted, (SELECT count(DISTINCT url) FROM pages) AS pages_visited, "
    "(SELECT count(DISTINCT concat(p_brand, '/', p_type)) FROM part) AS unique_products",
)
def crawl_stats(spark, d):
    records = table(spark, d, "part").selectExpr("concat(p_brand, '/', p_type) AS source_url")
    return L.crawl_stats(records, table(spark, d, "pages"))
