"""Page tests and field extraction.

Pages are either the page table itself or written from table columns, so that the SQL twin
gets its answer from the columns and knows nothing of any HTML reader.
"""

from pyspark.sql import functions as F

from shelfwright.checks import sqltext as S
from shelfwright.checks.registry import query, table
from shelfwright.functions.text import clean_strict, clean_tags
from shelfwright.operators import extract as X
from shelfwright.operators import links as L
from shelfwright.operators.page_facts import page_facts
from shelfwright.plans.catalogue import extract_a, products_from_pages
from shelfwright.plans.site_profiles import SITE_A, SITE_B

def _url():
    return F.col("url")


def _part_facts(spark, d, html, facts, watch=None, url="concat('https://shop.example.com/en/', p_partkey)"):
    pages = table(spark, d, "part").selectExpr("p_partkey AS page_id", f"{url} AS url", f"{html} AS html")
    return page_facts(pages, facts, watch)


def _doc_facts(spark, d, html, facts, watch=None):
    pages = table(spark, d, "documents").selectExpr(
        "doc_id AS page_id", "concat('https://shop.example.com/en/', doc_id) AS url", f"{html} AS html"
    )
    return page_facts(pages, facts, watch)


# ---- page tests -------------------------------------------------------------------------

_A_URL = (
    "concat('https://www.flex-tools.com/en/', CASE WHEN p_partkey % 3 = 0 THEN 'Products/saws/x-' "
    "WHEN p_partkey % 3 = 1 THEN 'products/' ELSE 'about/' END, p_partkey)"
)
_A_PAGE = (
    "concat('<body>', CASE WHEN p_partkey % 2 = 0 THEN '<h1>' ELSE '<h2>' END, p_name, "
    "CASE WHEN p_partkey % 2 = 0 THEN '</h1>' ELSE '</h2>' END, "
    "CASE WHEN p_partkey % 5 < 2 THEN '<div class=\"grid product-card-grid\"></div>' ELSE '' END, "
    "CASE p_partkey % 7 WHEN 0 THEN '<section class=\"technical-data\">x</section>' "
    "WHEN 1 THEN '<h3>Technical <b>attributes</b></h3>' WHEN 2 THEN '<p>Technical attributes</p>' ELSE '' END)"
)


@query(
    "page_is_product_a",
    "SELECT p_partkey AS page_id, (p_partkey % 2 = 0 AND p_partkey % 5 >= 2) OR p_partkey % 7 < 2 "
    "OR (p_partkey % 3 = 0 AND p_partkey % 5 >= 2) AS is_product FROM part",
)
def page_is_product_a(spark, d):
    facts = _part_facts(spark, d, _A_PAGE, ["heads", "classes"], SITE_A.watch(), _A_URL)
    return facts.select("page_id", X.is_product_page_a(_url()).alias("is_product"))


_B_PAGE = (
    "concat('<body><h1>', p_name, '</h1><h3>', CASE p_partkey % 5 WHEN 0 THEN 'Product<i>Details</i>' "
    "WHEN 1 THEN 'TECHNICAL DATA' WHEN 2 THEN 'Application' ELSE 'More' END, '</h3>', "
    "CASE WHEN p_partkey % 3 < 2 THEN concat('<a href=\"/d/', p_size, '-PDS.pdf?v=1\">sheet</a>') ELSE '' END, "
    "CASE WHEN p_partkey % 4 = 0 THEN '<a href=\"/d/Brochure.pdf\">brochure</a>' ELSE '<a href=\"/brochure.html\">b</a>' END)"
)


@query(
    "page_is_product_b",
    "SELECT p_partkey AS page_id, p_name AS name FROM part "
    "WHERE p_partkey % 5 < 2 OR (p_partkey % 3 < 2 AND p_partkey % 4 <> 0)",
)
def page_is_product_b(spark, d):
    facts = _part_facts(spark, d, _B_PAGE, ["heads", "links", "title"])
    return facts.where(X.is_product_page_b()).select("page_id", X.product_name_b().alias("name"))


# ---- names and descriptions -------------------------------------------------------------

H1 = S.unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")
_PARAS = f"list_filter(regexp_extract_all(html, '<p>([^<]*)', 1), lambda x: x <> '')"


@query(
    "extract_basic",
    f"SELECT page_id, 'Flex' AS brand, {S.clean_strict(H1)} AS product_name, {S.clean_tags(H1)} AS name_b, "
    "url AS source_url FROM pages",
)
def extract_basic(spark, d):
    facts = page_facts(table(spark, d, "pages"), ["title", "heads", "marked"], SITE_A.watch())
    return facts.select(
        "page_id",
        F.lit(SITE_A.brand).alias("brand"),
        X.product_name_a().alias("product_name"),
        X.product_name_b().alias("name_b"),
        _url().alias("source_url"),
    )


_ATTR = f"replace({S.escape('text')}, '\"', '&quot;')"
_LONG_PAGE = (
    "concat('<html><head><meta name=\"keywords\" content=\"k\">', CASE doc_id % 5 "
    f"WHEN 0 THEN concat('<meta name=\"description\" content=\"', {_ATTR}, '\">') "
    "WHEN 1 THEN '<meta name=\"description\" content=\"  \">' ELSE '' END, '</head><body><p>', lang, "
    "'</p>', CASE WHEN doc_id % 5 < 3 THEN concat('<div class=\"a summary\"><p>', "
    f"{S.escape('source')}, '</p></div>') ELSE '' END, CASE WHEN doc_id % 5 = 3 THEN "
    f"concat('<div class=\"description\"><section><p>', {S.escape('text')}, '</p></section></div>') ELSE '' END)"
)
_CUT = "CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END"


@query(
    "extract_longdesc",
    f"SELECT doc_id AS page_id, CASE doc_id % 5 WHEN 0 THEN {S.clean_strict('text')} "
    f"WHEN 3 THEN {S.clean_strict(_CUT)} WHEN 4 THEN '' ELSE {S.clean_strict('source')} END AS long_a, "
    f"CASE doc_id % 5 WHEN 0 THEN {S.clean_tags('text')} ELSE '' END AS long_b FROM documents",
)
def extract_longdesc(spark, d):
    facts = _doc_facts(spark, d, _LONG_PAGE, ["metas", "paras"], SITE_A.watch())
    return facts.select(
        "page_id", X.long_description_a().alias("long_a"), X.long_description_b().alias("long_b")
    )


_TELLING = (
    "concat('This part is called ', {0}, ' and it is number ', p_partkey, ' of the {1} printed catalogue')"
)
_SHORT_PAGE = (
    "concat('<body>', CASE WHEN p_partkey % 2 = 0 THEN concat('<div class=\"product-info-description\">"
    "<script>if (a<b) track(1);</script><p>', p_name, ' &amp; co</p> Downloads <b>', p_brand, '</b></div>') ELSE '' END, "
    f"'<p>', {_TELLING.format('p_name', 'first')}, '</p><p>short</p><p>', {_TELLING.format('p_brand', 'cookie')}, "
    f"'</p><p>', {_TELLING.format('p_type', 'second')}, '</p><p>', {_TELLING.format('p_brand', 'third')}, '</p><p>', "
    f"{_TELLING.format('p_name', 'fourth')}, '</p>')"
)


@query(
    "extract_shortdesc_a",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' &amp; co ', replace(p_brand, '#', '#')) "
    f"ELSE concat({_TELLING.format('p_name', 'first')}, ' ', {_TELLING.format('p_type', 'second')}, ' ', "
    f"{_TELLING.format('p_brand', 'third')}) END AS short_description FROM part",
)
def extract_shortdesc_a(spark, d):
    facts = _part_facts(spark, d, _SHORT_PAGE, ["marked", "paras"], SITE_A.watch())
    return facts.select("page_id", X.short_description_a().alias("short_description"))


_FIVE = f"list_transform({_PARAS}[1:5], lambda x: {S.clean_tags(S.unescape('x'))})"


@query(
    "extract_shortdesc_b",
    f"SELECT page_id, array_to_string(list_filter({_FIVE}, lambda x: length(x) > 50), ' ') AS short_description FROM pages",
)
def extract_shortdesc_b(spark, d):
    facts = page_facts(table(spark, d, "pages"), ["paras"])
    return facts.select("page_id", X.short_description_b().alias("short_description"))


_EIGHT = f"list_transform({_PARAS}[1:8], lambda x: {S.clean_strict(S.unescape('x'))})"
_SKIP = "cookie|privacy|terms|contact|sitemap|copyright|local dealer|standard supply"
SHORT_A = (
    f"array_to_string(list_filter({_EIGHT}, lambda x: length(x) > 50 AND NOT regexp_matches(lower(x), '{_SKIP}'))[1:3], ' ')"
)


# ---- specifications ---------------------------------------------------------------------


def _spec_rows(df, specs):
    return df.select("page_id", F.explode(F.map_entries(specs)).alias("e")).select(
        "page_id", F.col("e.key").alias("spec"), F.col("e.value").alias("value")
    )


_TABLE_PAGE = (
    "concat('<table class=\"other\"><tr><td>Hidden</td><td>not here</td></tr></table><table class=\"x spec-table\">"
    "<tr><th>Brand (name):<th>', p_brand, '<tr><td>Type<td><b>', p_type, '</b></td></tr><tr><td>ab</td><td>too short</td></tr>"
    "<tr><td>Price in EUR</td><td> ', CAST(CAST(p_retailprice AS BIGINT) + 1000 AS STRING), ' </td><td>more</td></tr>"
    "<tr><td>TYPE</td><td>last ', p_name, '</td></tr><tr><td>alone</td></tr></table>')"
)
_TABLE_SPECS = (
    "SELECT p_partkey AS page_id, 'brand name' AS spec, p_brand AS value FROM part UNION ALL "
    "SELECT p_partkey, 'type', concat('last ', p_name) FROM part UNION ALL "
    "SELECT p_partkey, 'price in eur', CAST(CAST(p_retailprice AS BIGINT) + 1000 AS STRING) FROM part"
)


@query("specs_table", _TABLE_SPECS)
def specs_table(spark, d):
    facts = _part_facts(spark, d, _TABLE_PAGE.replace("CAST(p_retailprice AS BIGINT)", _whole("p_retailprice")), ["rows"], SITE_A.watch())
    return _spec_rows(facts, X.specs_map(X.specs_from_tables(clean_strict)))


def _whole(c):
    # DuckDB's cast to a whole number rounds half to even, Spark's cuts off
    return f"CAST(bround({c}) AS BIGINT)"


@query(
    "specs_table_b",
    _TABLE_SPECS + " UNION ALL SELECT p_partkey, 'hidden', 'not here' FROM part",
)
def specs_table_b(spark, d):
    facts = _part_facts(spark, d, _TABLE_PAGE.replace("CAST(p_retailprice AS BIGINT)", _whole("p_retailprice")), ["rows"], SITE_B.watch())
    return _spec_rows(facts, X.specs_map(X.specs_from_tables(clean_tags)))


_LIST_PAGE = (
    "concat('<ul><li>Outside: no</li></ul><div class=\"tech-specs\"><ul><li>Brand: ', p_brand, '<li>Ratio: 1:', p_size, "
    "'<li>no colon here<li> Type (kind) :', p_type, '</li><li>Empty:</li></ul></div>')"
)


@query(
    "specs_list",
    "SELECT p_partkey AS page_id, 'brand' AS spec, p_brand AS value FROM part UNION ALL "
    "SELECT p_partkey, 'ratio', concat('1:', p_size) FROM part UNION ALL SELECT p_partkey, 'type kind', p_type FROM part",
)
def specs_list(spark, d):
    facts = _part_facts(spark, d, _LIST_PAGE, ["rows", "items", "elements", "strings"], SITE_A.watch())
    return _spec_rows(facts, X.specs_a())


_TEXT_PAGE = (
    "concat('<body><p>before</p><h2>Technical data</h2><p>Downloads</p><div>Weight</div><div>', p_size, ' kg</div>"
    "<p>4711</p><p>Max. load</p><p>', p_type, '</p><p>Instruction manual</p><span>Brand</span><span>', p_brand, '</span>"
    "<p>Weight</p><p>', p_size + 1, ' kg</p><p>open end</p>')"
)


@query(
    "specs_text",
    "SELECT p_partkey AS page_id, 'weight' AS spec, concat(p_size + 1, ' kg') AS value FROM part UNION ALL "
    "SELECT p_partkey, 'max load', p_type FROM part UNION ALL SELECT p_partkey, 'brand', p_brand FROM part",
)
def specs_text(spark, d):
    facts = _part_facts(spark, d, _TEXT_PAGE, ["rows", "items", "elements", "strings"], SITE_A.watch())
    return _spec_rows(facts, X.specs_a())


_HEADING_PAGE = (
    "concat('<table><tr><td>Colour</td><td>from table</td></tr><tr><td>Brand</td><td>', p_brand, '</td></tr></table>"
    "<div><h3>Colour</h3> ', p_name, ' <p> ', p_type, '</p><p>third</p><h3>Packaging (size)</h3><p><b>', p_size, "
    "'</b> kg</p><h2>End</h2><p>x</p><h3>Application</h3><p>no</p><h3>Shelf life</h3><h3>Density</h3>1.4</div>')"
)


@query(
    "specs_heading",
    "SELECT p_partkey AS page_id, 'colour' AS spec, concat(p_name, ' ', p_type) AS value FROM part UNION ALL "
    "SELECT p_partkey, 'brand', p_brand FROM part UNION ALL "
    "SELECT p_partkey, 'packaging_size', concat(p_size, ' kg') FROM part UNION ALL SELECT p_partkey, 'density', '1.4' FROM part",
)
def specs_heading(spark, d):
    return _spec_rows(_part_facts(spark, d, _HEADING_PAGE, ["rows", "kin", "plain"], SITE_B.watch()), X.specs_b())


@query(
    "specs_json",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE "
    "concat('{\"brand\":\"', p_brand, '\",\"type\":\"', p_type, '\"}') END AS technical_specs FROM part",
)
def specs_json(spark, d):
    html = (
        "CASE WHEN p_partkey % 6 = 0 THEN '<p>none</p>' ELSE concat('<table class=data-table><tr><td>Brand<td>', "
        "p_brand, '<tr><td>Type<td>', p_type, '</table>') END"
    )
    facts = _part_facts(spark, d, html, ["rows", "items", "elements", "strings"], SITE_A.watch())
    return facts.select("page_id", X.specs_to_json(X.specs_a()).alias("technical_specs"))


# ---- data sheets ------------------------------------------------------------------------

_SHEETS_A = (
    "concat('<a href=\"/x.pdf\">price list</a>', CASE p_partkey % 4 WHEN 0 THEN concat('<a href=\"f/', p_size, "
    "'.pdf\"><i>Instruction Manual</i></a>') WHEN 1 THEN concat('<a href=\"https://cdn.example.org/Spec-', p_size, "
    "'.pdf?v=2\">get</a>') WHEN 2 THEN '<a href=\"/manual.html\">manual</a>' ELSE "
    "concat('<a href=\"/MANUAL-', p_size, '.pdf\">get</a><a href=\"/t/', p_size, '.pdf\">Technical sheet</a>') END)"
)


@query(
    "datasheet_a",
    "SELECT p_partkey AS page_id, CASE p_partkey % 4 WHEN 0 THEN concat('https://shop.example.com/en/f/', p_size, '.pdf') "
    "WHEN 1 THEN concat('https://cdn.example.org/Spec-', p_size, '.pdf?v=2') WHEN 2 THEN NULL "
    "ELSE concat('https://shop.example.com/t/', p_size, '.pdf') END AS datasheet_url FROM part",
)
def datasheet_a(spark, d):
    return _part_facts(spark, d, _SHEETS_A, ["links"]).select("page_id", X.datasheet_a(_url()).alias("datasheet_url"))


_HREFS = (
    "CASE p_partkey % 10 WHEN 0 THEN concat('/f/', p_size, '-pds.PDF') WHEN 1 THEN '/f/data-sheet.html' "
    "WHEN 2 THEN '/f/MSDS.pdf' WHEN 3 THEN '/f/brochure.pdf' WHEN 4 THEN '/documents-resources/pds.html' "
    "WHEN 5 THEN '#pds' WHEN 6 THEN 'javascript:pds()' WHEN 7 THEN '/f/flyer-datasheet.pdf' WHEN 8 THEN '/f/x.pdf' ELSE '/f/y' END"
)
_TEXTS = (
    "CASE p_size % 9 WHEN 0 THEN 'Product Data Sheet' WHEN 1 THEN 'the PDS here' WHEN 2 THEN 'Technical data sheet (TDS)' "
    "WHEN 3 THEN 'TDS' WHEN 4 THEN 'Safety sheet' WHEN 5 THEN 'Brochure' WHEN 6 THEN 'DoP' WHEN 7 THEN 'epds' ELSE 'file' END"
)
_TITLES = "CASE CAST(p_retailprice AS BIGINT) % 3 WHEN 0 THEN 'product data sheet' WHEN 1 THEN 'SDS' ELSE '' END"


def _title(dialect):
    return _TITLES if dialect == "duckdb" else _TITLES.replace("CAST(p_retailprice AS BIGINT)", _whole("p_retailprice"))


def _score_sql():
    h, t, l = "lower(href)", "lower(text)", "lower(title)"

    def has(c, w):
        return f"contains({c}, '{w}')"

    def any_of(*xs):
        return "(" + " OR ".join(xs) + ")"

    def word(w):
        return any_of(*[f"list_contains(string_split({c}, ' '), '{w}')" for c in (t, l)])

    def safety(c):
        return any_of(has(c, "safety"), has(c, "sds"), has(c, "msds"))

    def wide(w):
        return any_of(has(t, w), has(l, w), has(h, w))

    rules = [
        (any_of(has(t, "product data sheet"), has(l, "product data sheet")), 10),
        (word("pds"), 8),
        (any_of(has(t, "technical data sheet"), has(l, "technical data sheet")), 8),
        (word("tds"), 6),
        (has(h, "pds"), 5),
        (any_of(has(h, "data-sheet"), has(h, "datasheet")), 4),
        (safety(t), -20),
        (safety(l), -20),
        (safety(h), -20),
        (wide("brochure"), -10),
        (wide("flyer"), -10),
        (any_of(has(t, "declaration"), has(t, "dop")), -5),
        (any_of(has(h, "pds.html"), has(h, "documents-resources")), -30),
        (f"ends_with({h}, '.pdf')", 20),
    ]
    return " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n in rules)


_SCORED_LINKS = f"SELECT p_partkey AS page_id, {_HREFS} AS href, {_TEXTS} AS text, {_title('duckdb')} AS title FROM part"


def _sheet_link(href, text, title):
    return f"'<a href=\"', {href}, '\" title=\"', {title}, '\"><b>', {text}, '</b></a>'"


@query(
    "link_scores",
    f"SELECT page_id, href, CAST({_score_sql()} AS INTEGER) AS score FROM ({_SCORED_LINKS}) "
    "WHERE NOT starts_with(href, '#') AND NOT starts_with(href, 'javascript:')",
)
def link_scores(spark, d):
    html = f"concat({_sheet_link(_HREFS, _TEXTS, _title('spark'))})"
    pages = table(spark, d, "part").selectExpr("p_partkey AS page_id", "'https://x.example.com/' AS url", f"{html} AS html")
    return X.score_links(L.extract_links(pages)).select("page_id", "href", "score")


_B_LINKS = (
    f"SELECT p_partkey AS page_id, 0 AS pos, {_HREFS} AS href, {_TEXTS} AS text, '' AS title FROM part UNION ALL "
    f"SELECT p_partkey, 1, concat('/g', {_HREFS}), {_TEXTS}, {_title('duckdb')} FROM part UNION ALL "
    "SELECT p_partkey, 2, concat('/late/', p_size, '.html'), 'Product Data Sheet', '' FROM part"
)


@query(
    "datasheet_b",
    "SELECT p.p_partkey AS page_id, CASE WHEN href IS NULL THEN NULL ELSE concat('https://shop.example.com', href) END "
    "AS datasheet_url FROM part p LEFT JOIN (SELECT page_id, href, row_number() OVER (PARTITION BY page_id "
    f"ORDER BY score DESC, pos) AS rn FROM (SELECT *, {_score_sql()} AS score FROM ({_B_LINKS})) "
    "WHERE score > 0 AND NOT starts_with(href, '#') AND NOT starts_with(href, 'javascript:')) s "
    "ON s.page_id = p.p_partkey AND rn = 1",
)
def datasheet_b(spark, d):
    second = f"concat('/g', {_HREFS})"
    late = "concat('/late/', p_size, '.html')"
    html = (
        f"concat({_sheet_link(_HREFS, _TEXTS, repr(''))}, {_sheet_link(second, _TEXTS, _title('spark'))}, "
        f"{_sheet_link(late, repr('Product Data Sheet'), repr(''))})"
    )
    return _part_facts(spark, d, html, ["links"]).select("page_id", X.best_link(_url()).alias("datasheet_url"))


@query(
    "datasheet_fallback",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 < 2 THEN concat('https://shop.example.com/d/', p_size, '.pdf') END "
    "AS datasheet_url FROM part",
)
def datasheet_fallback(spark, d):
    html = (
        "concat('<a href=\"/out.pdf\">x</a><div ', CASE p_partkey % 3 WHEN 0 THEN 'class=\"a related-documents\"' "
        "WHEN 1 THEN 'id=\"downloads\"' ELSE 'id=\"documents\"' END, '><ul><li><a href=\"/d/SDS.pdf\">a</a><li>"
        "<a href=\"/d/page.html\">b</a><li><a href=\"/d/', p_size, '.pdf\">c</a></ul></div><a href=\"/later.pdf\">x</a>')"
    )
    facts = _part_facts(spark, d, html, ["links"], SITE_B.watch())
    return facts.select("page_id", X.datasheet_b_fallback(_url()).alias("datasheet_url"))


# ---- model numbers, image, subcategory --------------------------------------------------

_A_NAME = (
    "CASE p_partkey % 4 WHEN 0 THEN concat('GPS ', p_size, ' 18-EC - FLEX') WHEN 1 THEN concat('LKS 65/', p_partkey) "
    "WHEN 2 THEN 'SP-MAP - FLEX' ELSE concat(p_name, ' ', p_size) END"
)
_A_SLUG = "CASE WHEN p_partkey % 3 = 0 THEN concat('tl-', p_partkey, '-x') WHEN p_partkey % 3 = 1 THEN 'sp-map' ELSE '' END"


@query(
    "model_a",
    "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN concat('GPS ', p_size, ' 18-EC') "
    "WHEN p_partkey % 4 = 1 THEN concat('LKS 65/', p_partkey) WHEN p_partkey % 3 = 0 THEN concat('TL ', p_partkey, ' X') "
    "WHEN p_partkey % 2 = 0 THEN p_brand ELSE '' END AS model_number FROM part",
)
def model_a(spark, d):
    p = table(spark, d, "part").selectExpr(
        "p_partkey",
        f"{_A_NAME} AS name",
        f"concat('https://www.flex-tools.com/en/products/', {_A_SLUG}) AS url",
        "CASE WHEN p_partkey % 2 = 0 THEN map('weight', p_type, 'article no', p_brand, 'part', p_name) "
        "ELSE map('weight', p_type) END AS specs",
    )
    return p.select("p_partkey", X.model_number_a(F.col("name"), _url(), F.col("specs")).alias("model_number"))


@query(
    "model_b",
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat(p_partkey) WHEN 1 THEN concat(p_partkey, 'W') "
    "WHEN 2 THEN concat('A-', p_size) ELSE split_part(p_name, ' ', 1) END AS model_number FROM part",
)
def model_b(spark, d):
    html = (
        "concat('<h1>', p_name, '</h1>', CASE WHEN p_partkey % 4 = 2 THEN concat('<p>Colour</p><p>article no.: <b>A-', "
        "p_size, '</b> pcs</p>') ELSE '<p>Article number</p>' END)"
    )
    url = (
        "concat('https://gcc.sika.com/en/construction/', CASE p_partkey % 4 WHEN 0 THEN concat('Sika-ucrete-cr-', p_partkey) "
        "WHEN 1 THEN concat('sikafloor-', p_partkey, 'w-x') WHEN 2 THEN 'sikalatex' ELSE 'other-7' END, '.html')"
    )
    facts = _part_facts(spark, d, html, ["title", "heads", "body_text"], None, url)
    return facts.select(
        F.col("page_id").alias("p_partkey"),
        X.model_number_b(X.product_name_b(), _url(), F.col("body_text")).alias("model_number"),
    )


@query(
    "image_url",
    "SELECT p_partkey AS page_id, CASE p_partkey % 6 WHEN 0 THEN concat('https://i.example.org/', p_size, '.jpg') "
    "WHEN 1 THEN concat('//raw/', p_size) WHEN 2 THEN concat('https://shop.example.com/m/', p_size, '.png') "
    "WHEN 3 THEN concat('https://shop.example.com/en/ph', p_size) WHEN 4 THEN concat('https://shop.example.com/en/z', p_size) "
    "END AS product_image_url FROM part",
)
def image_url(spark, d):
    html = (
        "concat(CASE p_partkey % 6 WHEN 0 THEN concat('<meta property=\"og:image\" content=\"https://i.example.org/', p_size, "
        "'.jpg\">') WHEN 1 THEN concat('<meta property=\"og:image\" content=\"\"><meta name=\"og:image\" content=\"//raw/', "
        "p_size, '\">') ELSE '' END, '<img src=\"/Logo.png\">', CASE p_partkey % 6 WHEN 2 THEN "
        "concat('<img src=\"/first.png\"><div class=\"main-image\"><a href=\"#\"><img alt=x src=\"/m/', p_size, "
        "'.png\"></a></div>') WHEN 3 THEN concat('<img src=\"a.png\"><img class=\"product-photo\" src=\"ph', p_size, '\"/>') "
        "WHEN 4 THEN concat('<img src=\"icon-1.png\"><img alt=\"no source\"><img src=\"z', p_size, '\">') ELSE '' END)"
    )
    facts = _part_facts(spark, d, html, ["metas", "images"], SITE_A.watch())
    return facts.select("page_id", X.image_url(_url()).alias("product_image_url"))


@query(
    "subcategory_a",
    "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('Hot ', upper(p_type[1]) || lower(p_type[2:]), ' 3D X1A') "
    "WHEN 1 THEN 'Cases' WHEN 2 THEN NULL WHEN 3 THEN 'Last One' END AS subcategory FROM part",
)
def subcategory_a(spark, d):
    url = (
        "concat('https://www.flex-tools.com/en/', CASE p_partkey % 5 WHEN 0 THEN concat('products/hot-', p_type, '-3d-x1a/z') "
        "WHEN 1 THEN 'accessories/cases/products' WHEN 2 THEN 'products/product-list' "
        "WHEN 3 THEN 'products/first/products/last-one' ELSE 'service/products' END)"
    )
    p = table(spark, d, "part").selectExpr("p_partkey", f"{url} AS url")
    return p.select("p_partkey", X.subcategory_a(_url()).alias("subcategory"))


@query(
    "subcategory_b",
    "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN concat(upper(p_type[1]) || lower(p_type[2:]), ' Floor') "
    "WHEN 1 THEN 'B2' END AS subcategory FROM part",
)
def subcategory_b(spark, d):
    url = (
        "CASE p_partkey % 4 WHEN 0 THEN concat('https://gcc.sika.com/en/construction/flooring/', p_type, '-floor/x/y.html') "
        "WHEN 1 THEN 'https://gcc.sika.com/en/a1/Construction/b2/c.html' WHEN 2 THEN 'https://gcc.sika.com/en/one.html' "
        "ELSE 'https://elsewhere.example.org/en/a/b/c.html' END"
    )
    p = table(spark, d, "part").selectExpr("p_partkey", f"{url} AS url")
    return p.select("p_partkey", X.subcategory_b(_url()).alias("subcategory"))


@query(
    "subcategory_crumb",
    "SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS crumb FROM part",
)
def subcategory_crumb(spark, d):
    html = (
        "concat('<ul class=\"', CASE WHEN p_partkey % 3 = 1 THEN 'x breadcrumb' ELSE 'breadcrumbs' END, "
        "'\"><li><a href=\"/\"> HOME </a></li><li><a href=\"/t\">', p_type, '</a><li><a> </a><li>plain', "
        "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('<li><a href=\"/b\">', p_brand, '</a>') END, "
        "'</ul><ul><li><a href=\"/o\">outside</a></ul>')"
    )
    return _part_facts(spark, d, html, ["elements"], SITE_A.watch()).select("page_id", X.subcategory_breadcrumb(SITE_A.crumb_stop).alias("crumb"))


# ---- variants and whole pages -----------------------------------------------------------

_VARIANT_PAGE = (
    "concat('<h1 class=\"title\">', p_name, '</h1><table class=\"spec-table\"><tr><td>Brand</td><td>', p_brand, "
    "'</td></tr><tr><td>Shank type</td><td>', p_type, '</td></tr></table>', CASE WHEN p_partkey % 3 = 0 THEN '' "
    "WHEN p_partkey % 3 = 1 THEN concat('<table class=\"accessory-variants-table\"><thead><tr><th></th><th>Order Number</th>"
    "<th>Size</th><th>Brand</th></tr></thead><tbody><tr class=\"row-variant odd\"><td></td><td>A', p_partkey, '</td><td>', "
    "p_size, ' mm</td><td>own</td></tr><tr class=\"row-variant\"><td><b>+</b></td><td> B', p_partkey, ' </td><td></td></tr>"
    "<tr class=\"note\"><td>no</td><td>no</td></tr></tbody></table>') "
    "ELSE '<table class=\"product-variants-table\"><tbody></tbody></table>' END)"
)
_VARIANT_URL = "concat('https://www.flex-tools.com/en/products/saws/s-', p_partkey)"


def _variants(spark, d, columns):
    pages = table(spark, d, "part").selectExpr(
        "p_partkey AS page_id", f"{_VARIANT_URL} AS url", f"{_VARIANT_PAGE} AS html"
    )
    return extract_a(pages, columns=columns)


@query(
    "variants",
    "SELECT p_partkey AS page_id, concat('S ', p_partkey) AS model_number, "
    "concat('brand=', lower(p_brand), ';shank type=', p_type) AS specs FROM part WHERE p_partkey % 3 = 0 "
    "UNION ALL SELECT p_partkey, concat('A', p_partkey), "
    "concat('Brand=own;Size=', p_size, ' mm;brand=', lower(p_brand), ';shank type=', p_type) FROM part WHERE p_partkey % 3 = 1 "
    "UNION ALL SELECT p_partkey, concat('B', p_partkey), "
    "concat('brand=', lower(p_brand), ';shank type=', p_type) FROM part WHERE p_partkey % 3 = 1",
)
def variants(spark, d):
    pairs = F.transform(
        F.array_sort(F.map_entries("specs")),
        lambda e: F.concat(e["key"], F.lit("="), F.when(e["key"] == "brand", F.lower(e["value"])).otherwise(e["value"])),
    )
    rows = _variants(spark, d, ["page_id", "model_number", "specs"])
    return rows.select("page_id", "model_number", F.array_join(pairs, ";").alias("specs"))


@query(
    "variant_name",
    "SELECT p_partkey AS page_id, 'S ' || p_partkey AS model_number, p_name AS product_name FROM part WHERE p_partkey % 3 = 0 "
    "UNION ALL SELECT p_partkey, 'A' || p_partkey, concat(p_name, ' (', p_type, ', ', p_size, ' mm)') FROM part "
    "WHERE p_partkey % 3 = 1 UNION ALL SELECT p_partkey, 'B' || p_partkey, concat(p_name, ' (', p_type, ')') FROM part "
    "WHERE p_partkey % 3 = 1",
)
def variant_name(spark, d):
    return _variants(spark, d, ["page_id", "model_number", "product_name"])


@query(
    "extract_site_a",
    f"SELECT page_id, 'Flex' AS brand, {S.clean_strict(H1)} AS product_name, '' AS technical_specs, "
    "'' AS long_description, '' AS subcategory, NULL::VARCHAR AS datasheet_url, NULL::VARCHAR AS product_image_url, "
    f"{SHORT_A} AS short_description, url AS source_url FROM pages",
)
def extract_site_a(spark, d):
    """Every rule of site A over the page table."""
    return extract_a(table(spark, d, "pages")).select(
        "page_id", "brand", "product_name", "technical_specs", "long_description", "subcategory",
        "datasheet_url", "product_image_url", "short_description", "source_url",
    )


_B_FULL = (
    "concat('<html><head><title>t</title><meta name=\"description\" content=\"', p_brand, ' long\"></head><body><h1>', p_name, "
    "'</h1><h2>Product Details</h2><p>', "
    + _TELLING.format("p_brand", "newest")
    + ", '</p><table><tr><td>Brand</td><td>', p_brand, '</td></tr></table><a href=\"/d/', p_size, "
    "'-pds.pdf\">Product Data Sheet</a><h3>Colour</h3><p>', p_type, '</p></body></html>')"
)
_B_FULL_URL = (
    "concat('https://', CASE WHEN p_partkey % 4 = 0 THEN 'www.example.org' ELSE 'gcc.sika.com' END, "
    "'/en/construction/flooring/', lower(p_type), '/sikafloor-', CAST(floor(p_partkey / 2) AS BIGINT), '.html')"
)


@query(
    "extract_site_b",
    "SELECT page_id, 'Sika' AS brand, p_name AS product_name, split_part(split_part(source_url, 'sikafloor-', 2), '.', 1) "
    "AS model_number, upper(p_type[1]) || lower(p_type[2:]) AS subcategory, concat('{\"brand\":\"', p_brand, "
    "'\",\"colour\":\"', p_type, '\"}') AS technical_specs, "
    + _TELLING.format("p_brand", "newest")
    + " AS short_description, p_brand || ' long' AS long_description, "
    "concat('https://gcc.sika.com/d/', p_size, '-pds.pdf') AS datasheet_url, source_url FROM ("
    f"SELECT *, p_partkey AS page_id, {_B_FULL_URL} AS source_url, row_number() OVER (PARTITION BY {_B_FULL_URL} "
    "ORDER BY p_partkey) AS rn FROM part WHERE p_partkey % 4 <> 0) WHERE rn = 1",
)
def extract_site_b(spark, d):
    """Snapshots of two hosts, some URLs twice, to one product row per _url() of the site."""
    pages = table(spark, d, "part").selectExpr("p_partkey AS page_id", f"{_B_FULL_URL} AS url", f"{_B_FULL} AS html")
    return products_from_pages(pages, SITE_B).select(
        "page_id", "brand", "product_name", "model_number", "subcategory", "technical_specs",
        "short_description", "long_description", "datasheet_url", "source_url",
    )
