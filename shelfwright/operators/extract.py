"""Product fields from page facts, as Column expressions.

Every function reads the fact columns of ``page_facts`` (or the arguments it names); none of
them touches HTML, shuffles rows or leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.functions.text import (
    DIGIT,
    SPACE,
    SPACE_IN,
    blank,
    clean_strict,
    clean_tags,
    ellipsize,
    has_digit,
    holds_any,
    let,
    normalize_key,
    strip,
    strip_markup,
    strip_phrases,
    title_case,
)
from shelfwright.functions.urls import last_segment, resolve_url
from shelfwright.plans import site_profiles as P

PAIRS = "array<struct<key:string,value:string>>"


# ---- small helpers --------------------------------------------------------------------


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _first(items, test, field: str) -> Column:
    return F.get(F.filter(items, test), 0)[field]


def _none_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _resolved(url: Column, href: Column) -> Column:
    return let(href, lambda h: resolve_url(url, h))


def _filled(c: Column) -> Column:
    return let(strip(c), lambda s: F.when(s != "", s))


def last_wins(pairs: Column) -> Column:
    """Key/value pairs to a map: the last value of a key counts, keys in first-seen order."""
    return let(in_order(pairs), _latest)


def _latest(pairs: Column) -> Column:
    """Pairs with the place ``late`` their value counts from, in first-seen order, to a map.

    Only if a key repeats are they sorted, once by place seen and once by ``late`` within the key.
    """
    keys = F.transform(pairs, lambda x: x["key"])
    plain = F.map_from_arrays(keys, F.transform(pairs, lambda x: x["value"]))
    seen = F.array_sort(F.transform(pairs, lambda x, i: F.struct(x["key"].alias("key"), i.alias("at"))))
    late = F.array_sort(
        F.transform(
            pairs,
            lambda x, i: F.struct(x["key"].alias("key"), x["late"].alias("late"), i.alias("at"), x["value"].alias("value")),
        )
    )

    def firsts(p):
        return F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1)["key"] != x["key"]))

    def lasts(p):
        return F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1)["key"] != x["key"]))

    def merged(f, x):
        return F.struct(f["at"].alias("at"), f["key"].alias("key"), x["value"].alias("value"))

    both = F.array_sort(F.zip_with(let(seen, firsts), let(late, lasts), merged))
    sorted_ = F.map_from_entries(F.transform(both, lambda x: F.struct(x["key"], x["value"])))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), plain).otherwise(sorted_)


def in_order(pairs: Column) -> Column:
    """Pairs whose place is where they stand."""
    return F.transform(
        pairs, lambda x, i: F.struct(x["key"].alias("key"), x["value"].alias("value"), i.cast("bigint").alias("late"))
    )


def pairs_of(specs: Column) -> Column:
    return F.transform(
        F.map_entries(specs), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    )


def _pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


# ---- page tests -----------------------------------------------------------------------


def is_product_page_a(url: Column) -> Column:
    """Facts heads, classes: a heading without a card grid, a specification block, or a
    product-like URL without a card grid."""
    # Class names, heading text and URL folders
    has_h1 = F.exists("heads", lambda h: h["level"] == 1)
    grid = F.array_contains("classes", "product-card-grid")
    spec_head = F.exists(
        "heads", lambda h: (h["level"] == 3) & F.array_join(h["texts"], "").contains(P.A_SPEC_HEADING)
    )
    specs = F.arrays_overlap("classes", _strings(("technical-data", "specifications"))) | spec_head
    slug = r"[\p{L}\p{N}_-]+"
    product_url = F.lower(url).rlike(f"/(?:products|accessories)/{slug}/{slug}")
    return (has_h1 & ~grid) | specs | (product_url & ~grid)


def is_product_page_b() -> Column:
    """Facts heads, links: a telling heading, or a data-sheet PDF and no brochure PDF."""
    heading = F.lower(F.array_join(F.flatten(F.transform("heads", lambda h: h["texts"])), " "))
    pdfs = F.transform(F.filter("links", lambda a: a["href"].contains(".pdf")), lambda a: F.lower(a["href"]))
    # Words in the addresses of data sheets
    sheet = F.exists(pdfs, lambda h: h.contains("pds") | h.contains("data-sheet"))
    brochure = F.exists(pdfs, lambda h: h.contains("brochure"))
    return holds_any(heading, P.B_HEADINGS) | (sheet & ~brochure)


# ---- names and descriptions -----------------------------------------------------------


def product_name_a() -> Column:
    """Facts heads, marked, title: the first selector that finds more than blanks."""

    def h1(test):
        return _first("heads", lambda h: (h["level"] == 1) & h["own"].isNotNull() & test(h), "own")

    found = F.coalesce(
        _filled(h1(lambda h: F.array_contains(h["classes"], "product-title"))),
        _filled(h1(lambda h: F.array_contains(h["classes"], "title"))),
        _filled(h1(lambda h: F.array_contains(h["anc"], "product-name"))),
        _filled(F.col("marked")["product-title"]["own"]),
        _filled(h1(lambda h: F.lit(True))),
        _filled(F.col("title")),
    )
    return let(found, clean_strict)


def product_name_b() -> Column:
    """Facts heads, title: h1 text, else the title; no fall-through on blanks."""
    h1 = _first("heads", lambda h: (h["level"] == 1) & h["own"].isNotNull(), "own")
    return let(F.coalesce(h1, F.col("title")), clean_tags)


def _meta(test) -> Column:
    return _first("metas", test, "content")


def _description_meta() -> Column:
    return _meta(lambda m: m["name"] == "description")


def _para_in(classes) -> Column:
    return _first("paras", lambda p: F.arrays_overlap(p["anc"], _strings(classes)), "text")


def long_description_a() -> Column:
    """Facts metas, paras: description meta, four summary selectors, else the first
    paragraph of a description block cut at 200."""
    para = _para_in(P.A_PARAGRAPH_CLASSES)
    cut = let(para, lambda p: ellipsize(p, 200))
    tries = [_filled(_description_meta())] + [_filled(_para_in((c,))) for c in P.A_SUMMARY_CLASSES]
    return let(F.coalesce(*tries, cut), clean_strict)


def long_description_b() -> Column:
    """Facts metas, paras."""
    return let(F.coalesce(_none_empty(_description_meta()), _para_in(P.B_PARAGRAPH_CLASSES)), clean_tags)


def short_description_a() -> Column:
    """Facts marked, paras: the first description container, else up to three telling
    paragraphs among the first eight; noise phrases removed."""
    keys = (*P.A_DESCRIPTION_CLASSES, "text-paragraph-content")
    block = F.coalesce(*[_none_empty(F.col("marked")[k]["markup"]) for k in keys])
    from_block = let(let(strip_markup(block), clean_strict), lambda t: F.when(t != "", t))
    # cleaning never adds characters: what is short before it is short after it
    long_ones = F.filter(F.slice("paras", 1, 8), lambda p: F.length(p["text"]) > 50)
    cleaned = F.transform(long_ones, lambda p: clean_strict(p["text"]))
    telling = F.filter(cleaned, lambda t: (F.length(t) > 50) & ~holds_any(F.lower(t), P.A_SKIP_WORDS))
    from_paras = F.array_join(F.slice(telling, 1, 3), " ")

    def without_noise(t):
        # already clean, so there is only something to do where a phrase occurs
        return F.when(holds_any(t, P.A_NOISE_PHRASES), strip_phrases(t, P.A_NOISE_PHRASES)).otherwise(t)

    return let(F.coalesce(from_block, from_paras), without_noise)


def short_description_b() -> Column:
    """Fact paras: those over 50 characters among the first five, joined."""
    long_ones = F.filter(F.slice("paras", 1, 5), lambda p: F.length(p["text"]) > 50)
    cleaned = F.transform(long_ones, lambda p: clean_tags(p["text"]))
    return F.array_join(F.filter(cleaned, lambda t: F.length(t) > 50), " ")


# ---- specifications -------------------------------------------------------------------


def specs_from_tables(clean) -> Column:
    """Fact rows: first two cells of every row inside a specification table, both longer than two characters.

    Tables stand in the page's order, and the rows of a table inside another are read with both: a
    row is first seen with the outermost of its tables, and its value counts last with the
    innermost. So every row is taken once, its place ``late`` by the innermost table.
    """
    rows = F.filter("rows", lambda r: r["outer"]["specs"].isNotNull() & (F.size(r["cells"]) >= 2))
    raw = F.transform(
        rows,
        lambda r: F.struct(
            strip(r["cells"][0]["text"]).alias("key"),
            strip(r["cells"][1]["text"]).alias("value"),
            (r["inner"]["specs"].cast("bigint") * (1 << 31) + r["pre"]).alias("late"),
        ),
    )
    long_enough = F.filter(raw, lambda p: (F.length(p["key"]) > 2) & (F.length(p["value"]) > 2))
    return _kept(
        F.transform(
            long_enough,
            lambda p: F.struct(normalize_key(p["key"]).alias("key"), clean(p["value"]).alias("value"), p["late"].alias("late")),
        )
    )


def specs_map(*pairs: Column) -> Column:
    """Lists of pairs to a map, keys in first-seen order; a later list counts over an earlier one."""

    def placed(n, p):
        def late(x):
            return F.struct(F.lit(n).alias("part"), x["late"].alias("at"))

        return F.transform(p, lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"), late(x).alias("late")))

    return let(F.concat(*[placed(n, p) for n, p in enumerate(pairs)]), _latest)


def _kept(pairs: Column) -> Column:
    return F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))


def specs_from_lists(clean, classes=P.A_LIST_CLASSES) -> Column:
    """Fact items: ``key: value`` list items, split at the first colon."""
    items = F.filter("items", lambda i: F.arrays_overlap(i["anc"], _strings(classes)) & i["text"].contains(":"))

    def split(text):
        key = F.substring_index(text, ":", 1)
        return _pair(normalize_key(key), clean(F.substring(text, F.length(key) + 2, F.lit(1 << 30))))

    return _kept(F.transform(F.transform(items, lambda i: strip(i["text"])), split))


def after_marker(marker: str = P.A_SPEC_MARKER, ahead: int = P.A_LOOK_AHEAD) -> Column:
    """Facts elements, strings: the texts after the first closed element whose own first text holds the marker."""
    ends = F.transform(F.filter("elements", lambda n: F.get(n["own"], 0).contains(marker)), lambda n: n["last"])
    after = let(F.array_min(ends), lambda end: F.filter("strings", lambda s: s["pre"] > end))
    return F.transform(F.slice(after, 1, ahead), lambda s: s["text"])


def specs_from_text(labels=P.A_TEXT_LABELS) -> Column:
    """Facts elements, strings: a text without digits is a key, the text after it the value."""
    texts = F.filter(
        F.transform(after_marker(), strip), lambda t: (t != "") & ~t.isin(*labels)
    )
    start = F.struct(F.lit(None).cast("string").alias("key"), F.array().cast(PAIRS).alias("pairs"))

    def step(acc, t):
        opens = acc["key"].isNull() & ~t.rlike(DIGIT)
        closes = acc["key"].isNotNull()
        return F.struct(
            F.when(opens, t).alias("key"),
            F.when(closes, F.concat(acc["pairs"], F.array(_pair(normalize_key(acc["key"]), t))))
            .otherwise(acc["pairs"])
            .alias("pairs"),
        )

    return F.aggregate(texts, start, step)["pairs"]


def sections(tag: str = "h3") -> Column:
    """Facts kin, plain: (pre, head, blocks) of every ``tag``; its blocks run to the next heading beside it.

    The headings of one parent cut its children into slices, so no child is looked at twice.
    """

    def cut(kids):
        heads = F.filter(
            F.transform(kids, lambda k, i: F.struct(k["tag"].alias("tag"), k["pre"].alias("pre"), k["head"].alias("head"), i.alias("at"))),
            lambda k: k["tag"].rlike("^h[0-9]"),
        )

        def blocks(hs):
            def slice_(h, i):
                end = F.coalesce(F.get(hs, i + 1)["at"], F.size(kids))
                return F.struct(
                    h["pre"].alias("pre"), h["tag"].alias("tag"), h["head"].alias("head"),
                    F.slice(kids, h["at"] + 2, end - h["at"] - 1).alias("blocks"),
                )

            return F.filter(F.transform(hs, slice_), lambda h: h["tag"] == tag)

        return let(heads, blocks)

    return F.array_sort(F.flatten(F.transform("kin", cut)))


def specs_from_headings(topics=P.B_SPEC_HEADINGS) -> Column:
    """Facts kin, plain: h3 with a topic word, value from its first two blocks of text."""

    def text(block):
        own = F.substring(F.col("plain"), block["start"] + 1, block["size"])
        return strip(F.coalesce(block["text"], own))

    told = F.filter(sections(), lambda s: holds_any(F.lower(strip(s["head"])), topics))
    heads = F.transform(
        told,
        lambda s: F.struct(
            F.lower(strip(s["head"])).alias("head"),
            F.transform(F.slice(F.filter(s["blocks"], lambda b: ~b["blank"]), 1, 2), text).alias("blocks"),
        ),
    )
    return F.transform(
        F.filter(heads, lambda h: F.size(h["blocks"]) > 0),
        lambda h: _pair(F.replace(normalize_key(h["head"]), F.lit(" "), F.lit("_")), F.array_join(h["blocks"], " ")),
    )


def specs_a() -> Column:
    """Tables, else lists, else running text."""

    def or_else(pairs, other):
        return let(pairs, lambda p: F.when(F.size(p) > 0, p).otherwise(other))

    lists = or_else(specs_from_lists(clean_strict), specs_from_text())
    return specs_map(or_else(specs_from_tables(clean_strict), in_order(lists)))


def specs_b() -> Column:
    """Tables with headings merged over them."""
    return specs_map(specs_from_tables(clean_tags), in_order(specs_from_headings()))


def specs_to_json(specs: Column) -> Column:
    return F.when(F.size(specs) > 0, F.to_json(specs)).otherwise("")


# ---- data sheets ----------------------------------------------------------------------


def datasheet_a(url: Column) -> Column:
    """Fact links: a PDF link with a telling text, else a telling PDF address."""
    # Fixed value: the file ending; the terms stand in the profile
    by_text = _first(
        "links",
        lambda a: a["href"].endswith(".pdf") & holds_any(F.lower(a["text"]), P.A_SHEET_TERMS),
        "href",
    )
    by_url = _first(
        "links", lambda a: a["href"].contains(".pdf") & holds_any(F.lower(a["href"]), P.A_SHEET_URL_TERMS), "href"
    )
    return _resolved(url, F.coalesce(by_text, by_url))


def _points(test: Column, points: int) -> Column:
    return F.when(test, F.lit(points)).otherwise(F.lit(0))


def link_score(href: Column, text: Column, title: Column) -> Column:
    """How much a link looks like a product data sheet."""
    folded = F.struct(
        F.lower(strip(href)).alias("href"),
        F.lower(strip(blank(text))).alias("text"),
        F.lower(strip(blank(title))).alias("title"),
    )
    return let(folded, lambda f: _score(f["href"], f["text"], f["title"]))


def _score(href: Column, text: Column, title: Column) -> Column:
    def either(phrase):
        return text.contains(phrase) | title.contains(phrase)

    def word(w):
        alone = f"(^|{SPACE}){w}({SPACE}|$)"
        return (text.contains(w) & text.rlike(alone)) | (title.contains(w) & title.rlike(alone))

    def safety(c):
        # "msds" contains "sds"
        return c.contains("safety") | c.contains("sds")

    def anywhere(w):
        return either(w) | href.contains(w)

    # Terms and points
    return (
        _points(either("product data sheet"), 10)
        + _points(word("pds"), 8)
        + _points(either("technical data sheet"), 8)
        + _points(word("tds"), 6)
        + _points(href.contains("pds"), 5)
        + _points(href.contains("data-sheet") | href.contains("datasheet"), 4)
        + _points(safety(text), -20)
        + _points(safety(title), -20)
        + _points(safety(href), -20)
        + _points(anywhere("brochure"), -10)
        + _points(anywhere("flyer"), -10)
        + _points(text.contains("declaration") | text.contains("dop"), -5)
        + _points(href.contains("pds.html") | href.contains("documents-resources"), -30)
        + _points(href.endswith(".pdf"), 20)
    )


def _scorable(href: Column) -> Column:
    h = strip(href)
    return (h != "") & ~(h.startswith("javascript:") | h.startswith("#") | h.startswith("mailto:"))


def score_links(links: DataFrame) -> DataFrame:
    """Score of every link row that could be a file."""
    return links.where(_scorable(F.col("href"))).withColumn(
        "score", link_score(F.col("href"), F.col("text"), F.col("title"))
    )


def best_link(url: Column) -> Column:
    """Fact links: the best positive score, the earliest link on a tie."""
    scored = F.transform(
        F.filter("links", lambda a: _scorable(a["href"])),
        lambda a: F.struct(
            link_score(a["href"], a["text"], a["title"]).alias("score"),
            (-a["pos"]).alias("early"),
            strip(a["href"]).alias("href"),
        ),
    )
    best = F.array_max(F.filter(scored, lambda s: s["score"] > 0))
    return _resolved(url, best["href"])


def datasheet_b_fallback(url: Column) -> Column:
    """Fact links: the first PDF of a downloads block that is no safety sheet."""
    href = _first(
        "links",
        lambda a: F.arrays_overlap(a["anc"], _strings(P.B_DOWNLOAD_CLASSES))
        & a["href"].endswith(".pdf")
        & ~holds_any(F.lower(a["href"]), ("sds", "safety")),  # Fixed values
        "href",
    )
    return _resolved(url, href)


def datasheet_b(url: Column) -> Column:
    return F.coalesce(best_link(url), datasheet_b_fallback(url))


# ---- model numbers --------------------------------------------------------------------


def model_number_a(name: Column, url: Column, specs: Column | None = None) -> Column:
    """From the name if it is all capitals and digits, else the URL, else the specs."""
    # Fixed value: what a name that is a model number looks like
    rx = rf"^([A-Z0-9{SPACE_IN}/\-]+?)(?:{SPACE}+-{SPACE}+FLEX)?$"
    from_name = strip(F.regexp_extract(name, rx, 1))
    slug = last_segment(F.lower(url))
    tries = [
        F.when(has_digit(from_name), from_name),
        F.when(has_digit(slug), F.replace(F.upper(slug), F.lit("-"), F.lit(" "))),
    ]
    if specs is not None:
        tries.append(F.get(F.filter(F.map_entries(specs), lambda e: holds_any(e["key"], P.A_MODEL_KEYS)), 0)["value"])
    return F.coalesce(*tries, F.lit(""))


def model_number_b(name: Column, url: Column, body_text: Column | None = None) -> Column:
    """From the URL, else a labelled code in the page text, else the name's first word."""
    slug = F.upper(F.regexp_extract(last_segment(F.lower(url)), P.B_MODEL_IN_SLUG, 1))
    tries = [_none_empty(slug)]
    if body_text is not None:
        rx = rf"(?i){P.B_MODEL_IN_TEXT}{SPACE}*[:{SPACE_IN}]*([^{SPACE_IN}]+)"
        tries.append(_none_empty(F.regexp_extract(body_text, rx, 1)))
    code = F.coalesce(*tries)
    first_word = F.regexp_extract(name, rf"([^{SPACE_IN}]+)", 1)
    return F.when(code.isNotNull(), clean_tags(code)).otherwise(first_word)


# ---- image, subcategory ---------------------------------------------------------------


def image_url(url: Column) -> Column:
    """Facts metas, images: og:image as given, five selectors, else the first picture
    that is no logo, icon or sprite."""
    og = F.coalesce(
        _none_empty(_meta(lambda m: m["property"] == "og:image")),
        _none_empty(_meta(lambda m: m["name"] == "og:image")),
    )
    picks = [_none_empty(_first("images", lambda i: F.array_contains(i["anc"], c), "src")) for c in P.A_IMAGE_CLASSES]
    picks.append(_none_empty(_first("images", lambda i: F.array_contains(i["classes"], P.A_IMAGE_OWN_CLASS), "src")))
    any_image = _first("images", lambda i: ~holds_any(F.lower(i["src"]), P.A_NO_IMAGE_WORDS), "src")
    return F.coalesce(og, _resolved(url, F.coalesce(*picks, any_image)))


def _segment_after(url: Column, word: str, not_prefix: str) -> Column:
    parts = F.split(url, "/", -1)
    after = F.transform(parts, lambda p, i: F.struct(p.alias("part"), F.get(parts, i + 1).alias("nxt")))
    good = F.filter(
        after, lambda a: (a["part"] == word) & (a["nxt"] != "") & ~a["nxt"].startswith(not_prefix)
    )
    return F.try_element_at(good, F.lit(-1))["nxt"]


def _as_title(segment: Column) -> Column:
    return title_case(F.replace(segment, F.lit("-"), F.lit(" ")))


def subcategory_a(url: Column) -> Column:
    found = F.when(url.contains("/products/"), _segment_after(url, "products", "product-")).when(
        url.contains("/accessories/"), _segment_after(url, "accessories", "accessory-")
    )
    return _as_title(found)


def subcategory_b(url: Column, root: str = P.SITE_B.url_root, stop=P.SITE_B.url_stop) -> Column:
    """Second folder below the root, stop folders left out; NULL on shorter URLs."""
    tail = F.split(F.substring_index(url, root, -1), "/", -1)
    folders = F.filter(F.slice(tail, 1, F.greatest(F.size(tail) - 1, F.lit(0))), lambda s: ~F.lower(s).isin(*stop))
    return F.when(url.contains(root), _as_title(F.get(folders, 1)))


def crumbs() -> Column:
    """Fact elements: the own texts of links in a list item that is inside a trail."""
    inside = F.filter("elements", lambda n: (n["tag"] == "a") & (n["outer"]["trail"] < n["inner"]["li"]))
    return F.flatten(F.transform(inside, lambda n: n["own"]))


def subcategory_breadcrumb(stop) -> Column:
    """Fact elements: the second crumb that is no stop word."""
    named = F.filter(F.transform(crumbs(), strip), lambda b: (b != "") & ~F.lower(b).isin(*stop))
    return F.get(named, 1)


# ---- variants -------------------------------------------------------------------------


def variant_name(name: Column, specs: Column, words=P.A_VARIANT_WORDS) -> Column:
    """The name with the values of telling spec keys in parentheses."""
    told = F.filter(F.map_entries(specs), lambda e: holds_any(F.lower(e["key"]), words))
    joined = F.array_join(F.transform(told, lambda e: e["value"]), ", ")
    return F.when(F.size(told) > 0, F.concat(name, F.lit(" ("), joined, F.lit(")"))).otherwise(name)


def variant_rows(profile: P.SiteProfile = P.SITE_A) -> Column:
    """Facts elements, rows: headers and rows (article, second, cells) of the page's variant tables, null without one."""
    classes = _strings(profile.variant_tables)

    def below(n, t):
        return (n["pre"] > t["pre"]) & (n["pre"] <= t["last"])

    def headers(t):
        heads = F.filter("elements", lambda n: (n["tag"] == "th") & below(n, t) & (n["inner"]["thead"] > t["pre"]))
        return F.flatten(F.transform(heads, lambda n: n["own"]))

    def row(r):
        article = F.filter(
            "elements",
            lambda n: F.array_contains(n["classes"], profile.article_class) & below(n, r) & (F.size(n["own"]) > 0),
        )
        cells = F.filter(r["cells"], lambda c: c["tag"] == "td")
        second = F.filter(cells, lambda c: (c["nth"] == 2) & c["own"].isNotNull())
        return F.struct(
            F.get(F.get(article, 0)["own"], 0).alias("article"),
            F.get(second, 0)["own"].alias("second"),
            F.transform(cells, lambda c: c["text"]).alias("cells"),
        )

    variant = F.filter("rows", lambda r: F.array_contains(r["classes"], profile.variant_row))

    def rows(t):
        return F.transform(F.filter(variant, lambda r: below(r, t) & (r["inner"]["tbody"] > t["pre"])), row)

    tables = F.filter("elements", lambda n: (n["tag"] == "table") & F.arrays_overlap(n["classes"], classes))
    both = F.struct(
        F.flatten(F.transform(tables, headers)).alias("headers"), F.flatten(F.transform(tables, rows)).alias("rows")
    )
    return F.when(F.exists("elements", lambda n: (n["tag"] == "table") & F.arrays_overlap(n["classes"], classes)), both)


def explode_variants(products: DataFrame) -> DataFrame:
    """One row per variant row, one row for a page without a variant table.

    Needs ``variants`` of ``variant_rows``; of ``product_name``, ``model_number`` and ``specs`` those
    there are made the variant's (the name needs ``specs``). A table without rows gives no product.
    """
    v = F.col("variants")
    row_type = "array<struct<article:string,second:string,cells:array<string>>>"
    lone = F.array(F.lit(None)).cast(row_type)
    cols = [c for c in products.columns if c != "variants"]
    headers = F.filter(F.transform(v["headers"], strip), lambda h: h != "")
    df = products.select(
        *cols,
        headers.alias("_headers"),
        F.posexplode(F.when(v.isNull(), lone).otherwise(v["rows"])).alias("variant_pos", "_row"),
    )
    row = F.col("_row")
    cells = F.transform(
        row["cells"],
        lambda c, i: F.struct(
            F.when(i > 0, F.get("_headers", i - 1)).alias("key"), strip(c).alias("value")
        ),
    )
    told = F.filter(
        cells, lambda p: p["key"].isNotNull() & (p["value"] != "") & ~F.lower(p["key"]).isin(*P.A_ORDER_HEADERS)
    )
    is_variant = row.isNotNull()
    out = {"is_variant": is_variant}
    if "specs" in cols:
        merged = last_wins(F.concat(pairs_of(F.col("specs")), told))
        df = df.withColumn("_specs", F.when(is_variant, merged).otherwise(F.col("specs")))
        out["specs"] = F.col("_specs")
    if "product_name" in cols:
        named = variant_name(F.col("product_name"), F.col("_specs"))
        out["product_name"] = F.when(is_variant, named).otherwise(F.col("product_name"))
    if "model_number" in cols:
        number = F.coalesce(_none_empty(row["article"]), _none_empty(row["second"]))
        own = is_variant & number.isNotNull()
        out["model_number"] = F.when(own, strip(number)).otherwise(F.col("model_number"))
    return df.withColumns(out).drop("_headers", "_row", "_specs")
