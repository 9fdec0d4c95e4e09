"""Links of page snapshots: extraction, routing, de-duplication, closure."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwright.functions.htmlscan import Watch
from shelfwright.functions.text import strip
from shelfwright.functions.urls import is_navigable, link_route, resolve_url, same_site
from shelfwright.operators.page_facts import page_facts
from shelfwright.plans.site_profiles import SiteProfile
from shelfwright.session import SMALL_ROWS, estimated_bytes, settle, shared_dir


def extract_links(pages: DataFrame, css_class: str | None = None) -> DataFrame:
    """One row per ``<a href>`` in document order: page_id, url, pos, href, text, title, classes."""
    links = F.col("links")
    if css_class:
        links = F.filter(links, lambda a: F.array_contains(a["classes"], css_class))
    rows = page_facts(pages, ["links"], keep=["page_id", "url"]).select("page_id", "url", F.inline(links))
    return rows.drop("anc")


def next_page(pages: DataFrame, own_classes=(), within_classes=()) -> DataFrame:
    """The next-page link of each page: the first ``a`` with one of the classes or inside one."""
    facts = page_facts(pages, ["links"], Watch(classes=within_classes), keep=["page_id", "url"])
    href = F.get(F.filter("links", lambda a: _is_next(a, own_classes, within_classes)), 0)["href"]
    return facts.select("page_id", "url", resolve_url(F.col("url"), href).alias("next_url"))


def _is_next(a: Column, own_classes, within_classes) -> Column:
    return F.arrays_overlap(a["classes"], _strings(own_classes)) | F.arrays_overlap(a["anc"], _strings(within_classes))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def keep_navigable(links: DataFrame) -> DataFrame:
    """Without blank, script, mail, phone and in-page links; hrefs stripped."""
    return links.where(is_navigable(F.col("href"))).withColumn("href", strip(F.col("href")))


def with_absolute(links: DataFrame) -> DataFrame:
    return links.withColumn("abs_url", resolve_url(F.col("url"), F.col("href")))


def keep_same_site(links: DataFrame, hosts) -> DataFrame:
    return links.where(same_site(F.col("abs_url"), list(hosts)))


def route_links(links: DataFrame, profile) -> DataFrame:
    """Add ``route``: 'product', 'category' or NULL. One pass, no second scan per class."""
    return links.withColumn("route", link_route(F.col("href"), F.col("abs_url"), profile))


def distinct_page_links(pages: DataFrame) -> DataFrame:
    """The set of absolute URLs each page links to. A page is one row, so nothing is shuffled."""
    facts = page_facts(pages, ["links"], keep=["page_id", "url"])
    navigable = F.filter("links", lambda a: is_navigable(a["href"]))
    urls = F.transform(navigable, lambda a: resolve_url(F.col("url"), strip(a["href"])))
    return facts.select("page_id", F.explode(F.array_distinct(urls)).alias("abs_url"))


def unseen(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Links whose ``abs_url`` is not among ``seen.url``."""
    known = seen.select(F.col("url").alias("abs_url")).distinct()
    return links.join(known, "abs_url", "left_anti")


def link_graph(pages: DataFrame, route) -> DataFrame:
    """One row per page URL: ``url``, ``outlinks array<struct<to, route>>`` without duplicates.

    ``route`` maps (href, absolute url) to 'product', 'category' or NULL (not followed). Each
    step is a pass of its own over the page's links, so no step repeats another's work.
    """
    facts = page_facts(pages, ["links"], keep=["page_id", "url"])
    hrefs = F.transform(F.filter("links", lambda a: is_navigable(a["href"])), lambda a: strip(a["href"]))
    pairs = F.transform(
        F.array_distinct(hrefs), lambda h: F.struct(h.alias("href"), resolve_url(F.col("url"), h).alias("to"))
    )
    edges = F.transform(pairs, lambda p: F.struct(p["to"].alias("to"), route(p["href"], p["to"]).alias("route")))
    followed = F.filter(edges, lambda e: e["route"].isNotNull())
    return facts.select("url", F.array_distinct(followed).alias("outlinks"))


def card_graph(pages: DataFrame, profile: SiteProfile, is_product) -> DataFrame:
    """Link graph of a site that lists its pages as cards: ``url``, ``outlinks``, ``is_product``.

    ``is_product`` is a Column over the facts heads and classes. A product page leads nowhere;
    any other page leads to its cards and its next page.
    """
    facts = page_facts(pages, ["links", "heads", "classes"], profile.watch(), keep=["page_id", "url"])
    facts = facts.withColumn("is_product", is_product)
    links = F.when(F.col("is_product"), F.slice("links", 1, 0)).otherwise(F.col("links"))
    cards = F.filter(links, lambda a: F.array_contains(a["classes"], profile.card_class))
    onward = F.slice(F.filter(links, lambda a: _is_next(a, profile.next_own, profile.next_within)), 1, 1)
    edges = F.transform(
        F.array_distinct(F.transform(F.concat(cards, onward), lambda a: a["href"])),
        lambda h: F.struct(resolve_url(F.col("url"), h).alias("to"), F.lit("category").alias("route")),
    )
    return facts.select("url", F.array_distinct(edges).alias("outlinks"), "is_product")


def crawl_closure(graph: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Every URL reached from ``seeds.url``: (url, route, depth). Category pages lead on,
    product pages do not.

    ``graph`` and the URLs seen are tables in the shared folder with the same buckets by URL, the
    latter partitioned by depth: a level is read as the partition that its predecessor appended,
    meets the pages bucket by bucket, and what it finds is grouped once and compared with all
    URLs seen, which never move. So a level has the same exchanges at any depth. Per level, the new
    URLs (each once) meet the pages (one row per URL, links in an array), so neither side has a
    hot key, and URLs many pages link to collapse map-side in the grouping. A side counted as small
    is broadcast instead. A lost executor costs one level at most. Both tables are removed
    at the end, also after a failure; the result is a table of its own.
    """
    spark = graph.sparkSession
    graph = settle(graph.select("url", "outlinks"))
    buckets = bucket_count(graph)
    pages, seen = Bucketed(spark, "url", buckets), Bucketed(spark, "url", buckets, "depth")
    try:
        pages.append(graph)
        first = seeds.select("url").where("url is not null").distinct()
        seen.append(first.select("url", F.lit("category").alias("route"), F.lit(0).alias("depth")))
        depth, total = 0, 0
        while max_depth is None or depth < max_depth:
            level = seen.read().where(F.col("depth") == depth)
            size = level.count()
            if not size:
                break
            total += size
            fresh = _next_level(pages.read(), level, seen.read(), size <= SMALL_ROWS, total <= SMALL_ROWS)
            depth += 1
            seen.append(fresh.withColumn("depth", F.lit(depth)))
        return settle(seen.read().select("url", "route", "depth"))
    finally:
        pages.remove()
        seen.remove()


def _next_level(pages: DataFrame, level: DataFrame, seen: DataFrame, few: bool, few_seen: bool) -> DataFrame:
    leads = level.where(F.col("route") == "category").select("url")
    out = pages.join(F.broadcast(leads) if few else leads, "url").select(F.explode("outlinks").alias("e"))
    found = out.groupBy(F.col("e.to").alias("url")).agg(F.max("e.route").alias("route"))
    known = seen.select("url")
    return found.join(F.broadcast(known) if few_seen else known, "url", "left_anti")


#: Bytes of a bucket, about, and the most buckets Spark takes.
BUCKET_BYTES, MOST_BUCKETS = 128 << 20, 100_000


def bucket_count(df: DataFrame) -> int:
    """By the bytes of a written table alone, so that a bucket stays readable by one task."""
    return min(MOST_BUCKETS, 1 + estimated_bytes(df) // BUCKET_BYTES)


class Bucketed:
    """A table in the shared folder, bucketed and sorted by ``key``, that is appended to and removed at the end."""

    def __init__(self, spark: SparkSession, key: str, buckets: int, partition: str | None = None):
        self.spark, self.key, self.buckets, self.partition = spark, key, buckets, partition
        self.name = f"bucketed_{uuid.uuid4().hex}"
        self.path = f"{shared_dir(spark).rstrip('/')}/{self.name}"

    def append(self, df: DataFrame) -> None:
        writer = df.repartition(self.buckets, self.key).write.mode("append").format("parquet")
        if self.partition:
            writer = writer.partitionBy(self.partition)
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def remove(self) -> None:
        """The table and its files; nothing happens where it was never written."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def crawl_stats(records: DataFrame, visited: DataFrame) -> DataFrame:
    """Run totals: items extracted, pages visited, unique products."""
    items = records.agg(
        F.count("*").alias("items_extracted"),
        F.lit(0).cast("bigint").alias("pages_visited"),
        F.count_distinct("source_url").alias("unique_products"),
    )
    zero = F.lit(0).cast("bigint")
    pages = visited.agg(F.count_distinct("url").alias("n")).select(zero, "n", zero)
    # two rows, each with its own counts and zeros for the other's
    both = items.union(pages)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])
