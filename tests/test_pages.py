import random
import time

import pytest
from pyspark.sql import functions as F

from shelfwright.functions.htmlscan import Node, PageFacts, Watch, first_text, read_tree
from shelfwright.operators import extract as X
from shelfwright.operators import links as L
from shelfwright.operators.page_facts import page_facts
from shelfwright.operators.rows import first_per_url
from shelfwright.plans.catalogue import catalogue, extract_a, extract_b, products_from_pages
from shelfwright.plans.site_profiles import SITE_A, SITE_B, SiteProfile

PAGE = "page_id bigint, url string, html string"


def facts(html, **watch):
    return PageFacts(html, Watch(**watch))


def value(spark, html, column, names, watch):
    """A rule's Column over the facts of one page."""
    pages = spark.createDataFrame([(1, "https://h.example/", html)], PAGE)
    return page_facts(pages, names, watch).select(column.alias("v")).first()["v"]


def test_open_tags_close_where_a_browser_closes_them():
    f = facts("<p>a<b>x</b>c<p>d<br>e<div>f</div><ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>")
    assert [t for t, _ in f.paras()] == ["a", "c", "d", "e"]
    assert [[c[3] for c in r[-1]] for r in f.rows()] == [["1", "2"], ["3"]]


def test_a_bold_run_left_open_ends_with_the_next_paragraph():
    f = facts("<p><b>lost<br><p>kept</p>")
    assert [t for t, _ in f.paras()] == ["kept"]


def test_script_bodies_are_text_but_never_markup():
    f = facts('<body><script>var a = "<a href=x>y</a></p>";</script><a href="/z">z</a>')
    assert [(href, text) for _, href, text, *_ in f.links()] == [("/z", "z")]
    assert 'var a = "<a href=x>y</a></p>";' in f.body_text()


def test_comments_doctype_and_broken_markup():
    f = facts("<!DOCTYPE html><!-- <a href=no>no</a> --><a href='/q?a=1&amp;b=2' TITLE=T>x < y</a><a>none</a></b><")
    assert [(href, text, title) for _, href, text, title, *_ in f.links()] == [("/q?a=1&b=2", "x < y", "T")]
    assert facts("").links() == [] and facts(None).links() == []


def test_text_after_the_marker_skips_what_is_inside_it(spark):
    html = "<div><h2>Technical data <i>inside</i></h2><p>A</p></div><p>1 kg</p>"
    watch = Watch(marker="Technical data")

    def after(html, **opts):
        return value(spark, html, X.after_marker(**opts), ["elements", "strings"], watch)

    assert after(html) == ["A", "1 kg"]
    assert after(html, ahead=1) == ["A"]
    assert not after("<p>nothing</p>")
    assert after("<div>Technical data<h2>Technical data</h2>x</div>y") == ["x", "y"]


@pytest.mark.parametrize(
    "part, fact",
    [
        ("<a ", "links"),
        ("<div class=a><p>t", "paras"),
        ("<h3>t</h3><p>x</p>", "kin"),
        ("<div><h3>t</h3>x", "kin"),
        ("<table><tr><td>k<td>v", "rows"),
        ("<table><tr><td>", "rows"),
        ("<table class=v><tbody><tr><th>", "elements"),
    ],
)
def test_reading_time_follows_the_length_of_the_page(part, fact):
    def seconds(n):
        began = time.process_time()
        getattr(facts(part * n, classes=("a",)), fact)()
        return time.process_time() - began

    short = min(seconds(2000) for _ in range(3))
    assert min(seconds(16000) for _ in range(3)) < 24 * short + 0.1  # a square would be 64 times


def test_nested_tables_take_no_time(spark):
    html = "<table><tr><td>key one<td>value" * 3300  # 100 KB
    began = time.process_time()
    rows = facts(html, marks={"specs": ("table",)}).rows()
    assert len(rows) == 3300 and time.process_time() - began < 1
    names, watch = ["rows"], SITE_B.watch()
    assert value(spark, html, X.specs_map(X.specs_from_tables(lambda c: c)), names, watch) == {"key one": "value"}


def below(node, tags):
    for k in node.kids:
        if isinstance(k, Node):
            if k.tag in tags:
                yield k
            yield from below(k, tags)


def plain_specs(html, classes):
    """Table by table in the page's order, row by row, tables inside tables read with both."""
    _, nodes = read_tree(html)
    out = {}
    for t in nodes:
        if t.tag == "table" and (classes is None or set(classes) & set(t.classes)):
            for r in below(t, ("tr",)):
                cells = [first_text(c).strip() for c in below(r, ("td", "th"))][:2]
                if len(cells) == 2 and min(map(len, cells)) > 2:
                    out[cells[0]] = cells[1]
    return list(out.items())


def test_specs_of_tables_inside_tables(spark):
    rnd = random.Random(7)

    def table(depth):
        rows = []
        for _ in range(rnd.randrange(4)):
            cells = [f"<td>{rnd.choice(['kaa', 'kbb', 'kcc', 'x'])}", f"<td>{rnd.randrange(100, 130)}", "<td>no"]
            if depth and rnd.random() < 0.6:
                cells.insert(rnd.randrange(4), f"<td>{table(depth - 1)}")
            rows.append("<tr>" + "".join(cells[: rnd.randrange(1, 5)]))
        return f"<table class='{rnd.choice(['spec-table', 'other', 'data-table x'])}'>{''.join(rows)}</table>"

    html = ["".join(table(3) for _ in range(3)) for _ in range(150)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], PAGE)
    for profile in (SITE_A, SITE_B):
        got = page_facts(pages, ["rows"], profile.watch()).select("page_id", X.specs_map(X.specs_from_tables(lambda c: c)).alias("m"))
        for r in got.collect():
            assert list(r["m"].items()) == plain_specs(html[r["page_id"]], profile.table_classes)


def test_tags_left_open_at_the_end_are_text_and_an_open_comment_is_none():
    f = facts("<p>a > b <a <a href=x")
    assert [t for t, _ in f.paras()] == ["a > b <a <a href=x"] and f.links() == []
    assert facts("<p>x</p>y <i <!-- z").body_text() == "x y <i "


def test_ancestor_classes_are_given_once():
    f = facts("<div class='a b'><div class=a><div class=c><p>t</p></div></div></div><p>u</p>", classes=("a", "b"))
    assert [(t, sorted(anc)) for t, anc in f.paras()] == [("t", ["a", "b"]), ("u", [])]


def test_a_cell_goes_to_every_row_around_it():
    f = facts("<table><tr><td>o</td><td><table><tr><td>i</td><td>j</td></tr></table></td></tr></table>", whole_rows=("w",))
    assert [[c[3] for c in r[-1]] for r in f.rows()] == [["o", "i"], ["i", "j"]]
    f = facts("<table><tr class=w><td>o</td><td><table><tr><td>i</td><td>j</td></tr></table></td></tr></table>", whole_rows=("w",))
    assert [[c[3] for c in r[-1]] for r in f.rows()] == [["o", "i", "i", "j"], ["i", "j"]]


def test_variant_rows_need_their_own_table_body(spark):
    inner = '<table class="product-variants-table">{}<tr class="row-variant"><td>a</td><td>b</td></tr></table>'
    outer = "<table><tbody><tr><td>{}</td></tr></tbody></table>"

    def variants(html):
        return value(spark, html, X.variant_rows(), ["elements", "rows"], SITE_A.watch())

    assert variants("<table><tr><td>a</table>") is None
    assert variants(outer.format(inner.format(""))) == ([], [])
    with_body = variants(outer.format(inner.format("<thead><th> H </th></thead><tbody>")))
    assert with_body == ([" H "], [(None, "b", ["a", "b"])])


def test_crumbs_are_links_of_list_items_inside_a_trail(spark):
    def crumbs(html):
        return value(spark, html, X.crumbs(), ["elements"], SITE_A.watch())

    assert crumbs("<ul class='x breadcrumb'><li><a>one<b>no</b>two</a><li><a></a></ul><li><a>out</a>") == ["one", "two"]
    assert crumbs("<li><div class=breadcrumbs><a>no list item inside</a></div>") == []
    assert crumbs("<li class=breadcrumb><a>itself</a>") == []
    assert crumbs("<li><div class=breadcrumbs><ul><li class=breadcrumb><a>in</a></ul></div>") == ["in"]


def facts_referred_to(df):
    """Columns of the page reading that the optimized plan above it refers to."""
    names, made, todo = set(), set(), [df._jdf.queryExecution().optimizedPlan()]

    def each(seq):
        it = seq.iterator()
        while it.hasNext():
            yield it.next()

    while todo:
        node = todo.pop()
        if node.nodeName() == "MapInArrow":
            made = {a.name() for a in each(node.output())} - {"page_id", "url"}
        else:
            names |= {a.name() for a in each(node.references())}
            todo += each(node.children())
    return made, made & names


@pytest.mark.parametrize(
    "extract, columns",
    [(extract_a, ["page_id", "model_number", "specs"]), (extract_a, ["page_id", "datasheet_url"]), (extract_b, ["page_id", "datasheet_url"])]
    + [(extract_a, None), (extract_b, None)],
)
def test_only_the_facts_needed_are_read(spark, extract, columns):
    """What the field table says is what the optimizer finds."""
    pages = spark.createDataFrame([], PAGE)
    made, used = facts_referred_to(extract(pages, columns=columns))
    assert made == used
    if columns == ["page_id", "datasheet_url"]:
        assert made == ({"heads", "links"} if extract is extract_b else {"heads", "classes", "links", "elements", "rows"})


def test_some_columns_are_those_of_the_whole(pages):
    some = extract_a(pages, columns=["page_id", "model_number", "specs"])
    whole = extract_a(pages).select("page_id", "model_number", "specs")
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


def test_deep_nesting_does_not_overflow():
    f = facts("<div>" * 5000 + "<p>x</p><h3>Density</h3>1" + "</div>" * 5000)
    assert [t for t, _ in f.paras()] == ["x"]
    (kids,) = f.kin()
    assert [k[2] or k[6] or f.plain()[k[3] : k[3] + k[4]] for k in kids] == ["x", "Density", "1"]
    assert "x" in f.body_text()


def test_selector_classes_follow_ancestors():
    f = facts('<div class="a summary"><section><p>t</p></section></div><div id=downloads><a href=x.pdf>x</a></div>', classes=("summary", "#downloads"))
    assert f.paras() == [("t", ["summary"])]
    assert f.links()[0][5] == ["#downloads"]


A = """<html><head><title>T - FLEX</title><meta name="description" content="Long  d">
<meta property="og:image" content="http://i/x.png"></head><body>
<ol class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/p">Products</a></li><li><a>Mixers</a></li></ol>
<h1 class="title">MXE 1602 - FLEX</h1><div class="product-description"><script>var a="<b>";</script><p>Good <b>mixer</b> Downloads</p></div>
<table class="spec-table x"><tr><th>Power</th><td>1600 W</td></tr><tr><td>Voltage</td><td>230 V</td></tr><tr><td>Power</td><td>900 W</td></tr></table>
<a href="/f/manual.pdf">Instruction Manual</a>
<table class="product-variants-table"><thead><tr><th></th><th>Order number</th><th>Size (mm)</th></tr></thead><tbody>
<tr class="row-variant"><td></td><td>123</td><td>8 x</td></tr>
<tr class="row-variant"><td></td><td class="column-article-number">456 </td><td>9 x</td></tr></tbody></table></body></html>"""

B = """<html><head><title>T</title></head><body><h1>Sikafloor&reg;-264</h1><h2>Product Details</h2>
<p>A long paragraph about flooring with more than fifty characters in it.</p><p>short</p>
<table><tr><td>Colour:</td><td>grey &amp; red</td></tr></table><h3>Packaging size</h3>  10 kg <p>drum</p><p>third</p>
<h3>Density (kg/l)</h3><div>1.4</div><h2>x</h2><a href="x.html" title="pds">a</a>
<a href="/d/sika-pds.pdf">Product Data Sheet</a><a href="/d/sds.pdf">Safety</a></body></html>"""

A_URL = "https://www.flex-tools.com/en/products/mixers/mxe-1602"
B_URL = "https://gcc.sika.com/en/construction/flooring-coating/industrial-flooring/epoxy-flooring/sikafloor-264-sg.html"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, A_URL, A), (3, B_URL, B), (4, A_URL, A), (5, "https://other.example.org/x", A)]
    return spark.createDataFrame(rows, PAGE)


def test_facts_are_handed_over_in_pieces(spark, monkeypatch):
    from shelfwright.operators import page_facts as P

    monkeypatch.setattr(P, "_FLUSH_CHARS", 40)
    pages = spark.range(50).selectExpr("id AS page_id", "concat('u', id) AS url", "concat('<title>', id, '</title>', repeat('x', CAST(id AS INT))) AS html")
    got = P.page_facts(pages, ["title"]).orderBy("page_id").collect()
    assert [(r["url"], r["title"]) for r in got] == [(f"u{i}", str(i)) for i in range(50)]


def test_site_a_page_with_variants(pages):
    rows = [r.asDict() for r in products_from_pages(pages, SITE_A).orderBy("model_number").collect()]
    assert [(r["page_id"], r["model_number"], r["product_name"]) for r in rows] == [
        (1, "123", "MXE 1602 - FLEX (8 x)"),
        (1, "456", "MXE 1602 - FLEX (9 x)"),
    ]
    assert rows[0]["specs"] == {"power": "900 W", "voltage": "230 V", "Size (mm)": "8 x"}
    assert list(rows[0]["specs"]) == ["power", "voltage", "Size (mm)"]
    assert rows[0]["short_description"] == "Good mixer"
    assert rows[0]["long_description"] == "Long d"
    assert rows[0]["subcategory"] == "Mixers"
    assert rows[0]["datasheet_url"] == "https://www.flex-tools.com/f/manual.pdf"
    assert rows[0]["product_image_url"] == "http://i/x.png"


def test_site_b_page(pages):
    (r,) = products_from_pages(pages, SITE_B).collect()
    assert r["specs"] == {"colour": "grey & red", "packaging_size": "10 kg drum", "density_kgl": "1.4"}
    assert (r["product_name"], r["model_number"], r["subcategory"]) == ("Sikafloor®-264", "264", "Industrial Flooring")
    assert r["datasheet_url"] == "https://gcc.sika.com/d/sika-pds.pdf"
    assert r["short_description"] == "A long paragraph about flooring with more than fifty characters in it."


def test_classification_can_be_left_out(pages):
    out = catalogue(pages, SITE_A, classify=False)
    assert out.columns[-1] == "scraped_timestamp"
    assert {r["type_id"] for r in out.collect()} == {None}


def test_variants_of_one_page_are_classified_one_by_one(spark, pages):
    from shelfwright.operators.knn import embed
    from shelfwright.plans import catalogue as C

    leaves = spark.createDataFrame([(1, "Nine", "9 x"), (2, "Eight", "8 x")], "id bigint, name string, path string")
    cands = embed(leaves.withColumn("numeric_path", F.col("id").cast("string")), "path")
    items = C.clean_products(products_from_pages(pages, SITE_A))
    for limit in (1 << 28, 600):
        found = C.find_candidates(items, cands, "item_id", k=1, max_bytes=limit)
        got = {r["item_id"]: (r["model_number"], r["candidates"][0]["name"]) for r in found.collect()}
        assert got == {"1-0": ("123", "Eight"), "1-1": ("456", "Nine")}
    answers = spark.createDataFrame([("1-1", '{"selected_type_id": 2}', None)], "item_id string, response_text string, error string")
    rows = catalogue(pages, SITE_A, cands, answers).orderBy("model_number").collect()
    assert [(r["model_number"], r["category"], r["classification_path"]) for r in rows] == [("123", "Eight", "2"), ("456", "Eight", "2")]


def test_unknown_pages_give_no_rows(spark):
    pages = spark.createDataFrame([(1, "https://gcc.sika.com/en/x.html", "<h1>News</h1>"), (2, B_URL, None)], PAGE)
    assert extract_b(pages).count() == 0
    assert extract_a(pages).count() == 1


GOLDEN_A = [
    ("TL 4000 18.0/230 - FLEX", "https://www.flex-tools.com/en/products/lighting/tl-4000-18-0-230", "TL 4000 18 0 230", "Lighting"),
    ("SP-MAP - FLEX", "https://www.flex-tools.com/en/accessories/carrying-case-system/sp-map", "", "Carrying Case System"),
    ("WLS-70-190 - FLEX", "https://www.flex-tools.com/en/products/measuring-technology-laser/laser-tripods/wls-70-190", "WLS-70-190", "Measuring Technology Laser"),
    ("LKS 65-170 F 1/4 - FLEX", "https://www.flex-tools.com/en/products/saws/x", "LKS 65-170 F 1/4", "Saws"),
]


@pytest.mark.parametrize("name,url,model,sub", GOLDEN_A)
def test_recorded_site_a_values(one, name, url, model, sub):
    assert one(lambda n, u: X.model_number_a(n, u), n=name, u=url) == model
    assert one(X.subcategory_a, u=url) == sub


@pytest.mark.parametrize("slug,model", [("sikafloor-264-sg", "264"), ("sikafloor-3240", "3240"), ("sikafloor-305-w", "305")])
def test_recorded_site_b_values(one, slug, model):
    url = f"https://gcc.sika.com/en/construction/a/industrial-flooring/b/{slug}.html"
    assert one(lambda n, u: X.model_number_b(n, u), n="Any name", u=url) == model
    assert one(lambda u: X.subcategory_b(u), u=url) == "Industrial Flooring"


def test_short_urls_have_no_subcategory(one):
    assert one(lambda u: X.subcategory_b(u), u="https://gcc.sika.com/en/x.html") is None
    assert one(lambda u: X.subcategory_b(u), u="https://gcc.sika.com/en/construction/x.html") is None


def test_last_value_of_a_key_wins_and_order_stays(spark):
    pairs = [("a", "1"), ("b", "2"), ("a", "3"), ("b", "2"), ("a", "1")]
    df = spark.createDataFrame([(pairs,)], f"p {X.PAIRS}")
    assert list(df.select(X.last_wins(F.col("p"))).first()[0].items()) == [("a", "1"), ("b", "2")]


def test_repetitive_tables_stay_quick(spark):
    """Many rows under one key: the last one counts, without pairing rows with each other."""
    df = spark.range(1).select(
        F.transform(
            F.sequence(F.lit(1), F.lit(20000)),
            lambda i: F.struct((i % 3).cast("string").alias("key"), (i % 50).cast("string").alias("value")),
        ).alias("p")
    )
    assert df.select(X.last_wins(F.col("p")).alias("m")).first()["m"] == {"1": "49", "2": "0", "0": "48"}


def test_equal_scores_go_to_the_earliest_link(spark):
    html = '<a href="/b.pdf">x</a><a href="/a.pdf">x</a><a href="/m.pdf">Safety</a>'
    pages = spark.createDataFrame([(1, "https://h.example/", html)], PAGE)
    assert X.score_links(L.extract_links(pages)).select("score").collect() == [(20,), (20,), (0,)]
    from shelfwright.operators.page_facts import page_facts

    facts_ = page_facts(pages, ["links"])
    assert facts_.select(X.best_link(F.col("url"))).first()[0] == "https://h.example/b.pdf"


def test_one_row_per_url_is_the_lowest_id(spark):
    pages = spark.createDataFrame([(5, "u", "x"), (2, "u", "y"), (9, "v", "z")], PAGE)
    assert sorted(tuple(r) for r in first_per_url(pages).collect()) == [(2, "u", "y"), (9, "v", "z")]


def test_closure_with_cycles_and_copies(spark):
    rows = [(i, f"https://h.example/c{i}", f'<a href="/c{(i + 1) % 5}">n</a><a href="/c{i}">me</a><a href="/p{i}">p</a>') for i in range(5)]
    pages = first_per_url(spark.createDataFrame(rows + [(9, *rows[0][1:])], PAGE))
    graph = L.link_graph(pages, lambda href, to: F.when(to.contains("/p"), "product").otherwise("category"))
    seeds = spark.createDataFrame([("https://h.example/c0",)], "url string")
    got = {r["url"][18:]: (r["route"], r["depth"]) for r in L.crawl_closure(graph, seeds).collect()}
    assert got == {**{f"c{i}": ("category", i) for i in range(5)}, **{f"p{i}": ("product", i + 1) for i in range(5)}}
    assert L.crawl_closure(graph, seeds, max_depth=1).count() == 3


@pytest.mark.parametrize("small", [3, -1])
def test_closure_is_the_same_whatever_is_broadcast(spark, monkeypatch, small):
    rows = [(i, f"https://h.example/c{i}", "".join(f'<a href="/c{j}">n</a>' for j in (2 * i + 1, 2 * i + 2))) for i in range(15)]
    graph = L.link_graph(spark.createDataFrame(rows, PAGE), lambda href, to: F.lit("category"))
    seeds = spark.createDataFrame([("https://h.example/c0",)], "url string")
    monkeypatch.setattr(L, "SMALL_ROWS", small)
    assert L.crawl_closure(graph, seeds).groupBy("depth").count().orderBy("depth").collect() == [
        (d, 2**d) for d in range(5)
    ]


def test_closure_leaves_no_table_behind(spark, monkeypatch):
    import os

    from shelfwright.session import shared_dir

    def left():
        return [n for n in os.listdir(shared_dir(spark).removeprefix("file:")) if n.startswith("bucketed_")], spark.catalog.listTables()

    graph = spark.createDataFrame([("a", [("b", "category")]), ("b", [("a", "category"), ("c", "product")])], "url string, outlinks array<struct<to:string,route:string>>")
    seeds = spark.createDataFrame([("a",), (None,), ("a",)], "url string")
    before = left()
    assert sorted(map(tuple, L.crawl_closure(graph, seeds).collect())) == [("a", "category", 0), ("b", "category", 1), ("c", "product", 2)]
    assert L.crawl_closure(graph, seeds.limit(0)).count() == 0
    assert left() == before

    def broken(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(L, "_next_level", broken)
    with pytest.raises(RuntimeError):
        L.crawl_closure(graph, seeds)
    assert left() == before


@pytest.mark.parametrize("depth", [1, 4])
def test_a_level_has_the_same_exchanges_at_any_depth(spark, monkeypatch, depth):
    """With tables too large for a broadcast: the links found are grouped and laid out, nothing else moves."""
    monkeypatch.setattr(L, "SMALL_ROWS", -1)
    monkeypatch.setattr(L, "bucket_count", lambda df: 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plans, real = [], L._next_level

    def watched(*a):
        out = real(*a)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(L, "_next_level", watched)
    try:
        rows = [(f"u{i}", [(f"u{2 * i + 1}", "category"), (f"u{2 * i + 2}", "category")]) for i in range(40)]
        graph = spark.createDataFrame(rows, "url string, outlinks array<struct<to:string,route:string>>")
        assert L.crawl_closure(graph, spark.createDataFrame([("u0",)], "url string"), depth).count() == 2 ** (depth + 1) - 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {p.count("Exchange hashpartitioning") for p in plans} <= {1, 2} and len({p.count("Exchange") for p in plans}) == 1


def test_a_third_site_from_its_seeds(spark):
    third = SiteProfile(
        brand="Third",
        hosts=("third.example",),
        sections=("/shop",),
        product_patterns=(r"item-\d+\.html",),
        seeds=("https://third.example/shop",),
        url_root="third.example/",
    )
    shop = '<a href="/shop/item-1.html">1</a><a href="/shop/more">m</a><a href="https://gcc.sika.com/shop/item-5.html">x</a>'
    item = "<h1>Item {0}</h1><h2>Product details</h2><table><tr><td>Size<td>{0} cm</table>"
    rows = [(1, "https://third.example/shop", shop), (2, "https://third.example/shop/more", '<a href="item-2.html">2</a><a href="/shop">s</a>')]
    rows += [(10 + i, f"https://third.example/shop/item-{i}.html", item.format(i)) for i in (1, 2, 3)]
    rows += [(20, "https://third.example/shop/item-2.html", item.format(9)), (30, "https://gcc.sika.com/shop/item-5.html", item.format(5))]
    pages = spark.createDataFrame(rows, PAGE)
    out = catalogue(pages, third, classify=False, extract=extract_b, crawl=True)
    assert sorted((r["brand"], r["product_name"], r["technical_specs"]) for r in out.collect()) == [
        ("Third", "Item 1", '{"size":"1 cm"}'),
        ("Third", "Item 2", '{"size":"2 cm"}'),
    ]
    everything = catalogue(pages, third, classify=False, extract=extract_b)
    assert sorted(r["product_name"] for r in everything.collect()) == ["Item 1", "Item 2", "Item 3"]


def test_a_card_site_from_its_seeds(pages, spark):
    seed, card = SITE_A.seeds[0], A_URL
    grid = f'<h1>Products</h1><div class="product-card-grid"><a class="card-link" href="{card}">c</a></div>'
    more = spark.createDataFrame([(50, seed, grid), (51, card + "-unlinked", A)], PAGE)
    rows = catalogue(pages.unionByName(more), SITE_A, classify=False, crawl=True).collect()
    assert sorted((r["model_number"], r["source_url"]) for r in rows) == [("123", card), ("456", card)]
