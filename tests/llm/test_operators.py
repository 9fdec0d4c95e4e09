"""The operators on small odd tables, against plain versions, and the queries against their SQL."""

import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwright import llm
from shelfwright.checks.compare import connect, difference
from shelfwright.llm import embedding_join, line_dedup, log_bilinear, main_text, maxscore
from shelfwright.llm import minhash_join, mixing, sharding, toxic_segments
from shelfwright.llm.common import components

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = llm.all_queries()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id here at all today", None, "b", 1)]
    rows += [(3, long, "en", "a", 1), (4, "same words in this text", "en", None, 1), (4, "same words in this text", "en", None, 1)]
    rows += [(5, "same words in this text", "en", "b", 1), (6, " \n\t\n ", "en", "c", 1)]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 290)] + [(5, 5), (9, 8)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(200, 290)} == {7}
    assert found[9] == 8 and 5 not in found
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_line_runs_over_arrivals(spark):
    texts = [f" Common \nown {i}\n{'rare' if i < 4 else 'other'}\n" for i in range(12)]
    rows = [(i, t, "h1") for i, t in enumerate(texts)] + [(None, None, "x"), (50, "", "y"), (0, texts[0], "h1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 string")
    halves = [docs.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == k) for k in range(3)]
    for arrivals in ([docs], halves):
        out = line_dedup.dedup_lines(docs, min_docs=5, arrivals=arrivals).collect()
        assert len(out) == len(rows)
        for r in out:
            if r.doc_id is None or r.doc_id == 50:
                assert (r.text, r.n_lines, r.n_dropped) == ("", 1, 0)
            else:
                kept = [f"own {r.doc_id}"] + (["rare"] if r.doc_id < 4 else []) + [""]  # rare: in five rows, one repeated
                kept = [k for k in kept if k != "rare"]
                assert r.text == "\n".join(kept) and r.n_lines == 4
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_on_odd_rows(spark):
    out = line_dedup.dedup_lines(odd_docs(spark), min_docs=3).collect()
    assert len(out) == 8
    assert Counter(r.n_dropped for r in out) == {0: 5, 1: 3}


def plain_links(vectors, threshold):
    links = defaultdict(set)
    for (i, (la, a)), (j, (lb, b)) in combinations(vectors.items(), 2):
        if la == lb and len(a) == len(b) and np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)) >= threshold:
            links[i].add(j)
            links[j].add(i)
    return links


def test_grid_join_with_small_intervals(spark):
    g = np.random.default_rng(3)
    centres = g.normal(size=(9, 8))
    vectors = {i: (int(g.integers(2)), centres[i % 9] + g.normal(0, 0.25, 8)) for i in range(400)}
    rows = [(i, v.tolist(), label) for i, (label, v) in vectors.items()]
    rows += [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, [None] * 8, 1), (904, rows[0][1], None), (905, [], 1)]
    rows += [(906, rows[0][1], rows[0][2]), (None, [1e200] * 8, 5), (907, [1e-200] * 8, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: r for r in embedding_join.near_duplicates(df, leaf=16).collect()}
    vectors[906] = vectors[0]
    links = plain_links(vectors, 0.93)
    for i in vectors:
        assert out[i].n_links == len(links[i])
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert out[i].component_id == min(seen) and out[i].kept == (i == min(seen))
    for i in (900, 901, 902, 903, 904, 905):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True)
    assert out[907].n_links == out[None].n_links == 1 and out[None].component_id == 907
    assert embedding_join.near_duplicates(df.limit(0)).count() == 0


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10_000), st.integers(1, 6), st.integers(1, 3))
def test_shards_merge_to_the_exact_best(seed, k, spread):
    g = np.random.default_rng(seed)
    rows = g.integers(-3 * spread, 3 * spread, (60, 5))
    ids = g.permutation(60)
    best = maxscore._Best(ids[:7], k)
    for part in np.array_split(np.arange(60), 4):
        maxscore.score_shard(best, rows[:7], ids[part], rows[part])
    for i in range(7):
        want = sorted((-int(rows[i] @ rows[j]), int(ids[j])) for j in range(60) if ids[j] != ids[i])[:k]
        assert [(-s, r) for r, s in zip(*(x.tolist() for x in best.rows[i]))] == want


def test_top_k_leaves_out_what_has_no_terms(spark):
    rows = [(0, [1, 2]), (1, [1, 2]), (2, [1, 2]), (3, None), (4, [1, None]), (None, [9, 9]), (20, [5, 5, 5])]
    df = spark.createDataFrame(rows, "id long, terms array<long>")
    out = maxscore.top_k(df, F.col("id") % 20 == 0, 2).collect()
    assert sorted(tuple(r) for r in out) == [(0, 1, 1, 5), (0, 2, 2, 5)]
    assert maxscore.top_k(df.limit(0), F.col("id") == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><header>top</header>
<nav><ul><li><a href="/">menu</a></ul></nav><div class="cookie-notice">We use <b>cookies</b></div>
<article><h1>Ti&amp;tle &lt;1&gt;</h1><p class="lead">One  <b>bo</b>ld<br>two<p title="a > b">three
<div class="ad">buy <div>now</div></div><form><input name=x>mail</form><p>four</p><script>"</p>"</script>
<section id="comments"><p>nice one</p></section></article><aside>side</aside><footer>&copy; x</footer>"""


def test_main_text():
    assert main_text.main_text(PAGE) == "Ti&tle <1> One bold two three four"
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<p") == ""
    plain = "<div id=menu><a>x</a></div><div><p>" + "long text here " * 9 + "</p><p>short</p></div>" + "<br><p></p>" * 9 + "<p>end</p>"
    assert main_text.main_text(plain) == ("long text here " * 9).strip() + " short end" or main_text.main_text(plain).endswith("short")


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize(
    "mark",
    ['class="post comments-open"', 'class="content has-sidebar"', 'class="entry-content share-enabled"', 'title="a hidden gem"']
    + ["data-t='The hidden city'", 'data-x="class=menu id=nav"', 'class="related-work commentary"', 'alt=" hidden"'],
)
def test_main_text_keeps_what_only_looks_like_an_aside(tag, mark):
    page = f"<body><{tag} {mark}><p>the whole text</p></{tag}></body>"
    assert main_text.main_text(page) == "the whole text"


def test_main_text_reads_attributes_whole():
    of = main_text.main_text
    assert of('<article><div class="article-header"><h1>Title</h1></div><p>a <a title="Hidden costs">link</a></p></article>') == "Title a link"
    body = "<p>the text of the page</p>"
    for mark in ("class=sidebar", 'id="page-comments"', "class='x cookie-notice'", "hidden", "HIDDEN", 'style="color: red; display: none"'):
        assert of(f"<article>{body}<div {mark}>not this</div></article>") == "the text of the page"
        assert of(f"<div {mark}><article>{body}</article></div>") == "the text of the page"
        assert of(f"<main><div {mark}><article {mark}>{body}</article></div></main>") == "the text of the page"
        assert of(f"<article>{body}</article><div {mark}><article>teaser</article></div>") == "the text of the page"
    assert of(f"<form id=all><article>{body}</article><form>") == "the text of the page"
    assert of(f'<article>{body}<section><article class="comment">nice</article></section></article>') == "the text of the page"


LONG = "This is a long paragraph of the page. " * 20


def test_main_text_keeps_short_passages():
    of, long = main_text.main_text, LONG.strip()
    advert = '<div class="ad"><div><div>buy</div></div></div>' * 3
    assert of(f"<div><div><p>{LONG}</p></div></div><div><div><p>A short end.</p></div></div>") == f"{long} A short end."
    assert of(f"<body><div><h1>Title</h1><p>A lead.</p>{advert}<p>{LONG}</p>{advert}<p>The end.</p></div>") == f"Title A lead. {long} The end."


def test_main_text_tells_links_from_menus():
    of, long = main_text.main_text, LONG.strip()
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Menu item {i}</a></li>" for i in range(9)) + "</ul>"
    link = "<p><a href=x>The study in full</a></p>"
    assert of(f"<div><p>{LONG}</p>{link}<p>{LONG}</p></div>") == f"{long} The study in full {long}"
    assert of(f"<h1>Site</h1>{menu}<p>{LONG}</p>{menu}<p>&copy; 2020 Site. All rights reserved.</p>") == f"Site {long}"
    assert of(menu) == of("") == ""


def test_main_text_prefers_main_to_a_small_article():
    of, long = main_text.main_text, LONG.strip()
    teaser = "<article><h2>Other news</h2></article>"
    assert of(f"<main><div>{LONG}</div>{teaser}<div>{LONG}</div></main>") == f"{long} Other news {long}"
    assert of(f"<main><div>{LONG}</div></main>{teaser * 90}") == long
    assert of(f"<main><p>Home</p><article>{LONG}</article><p>See also</p></main>") == long
    assert of(f"<main><p>Home</p><article>{LONG}</article><article>{LONG}</article></main>") == f"{long} {long}"


@pytest.mark.parametrize("piece", ["<p><a>x</a>", "<p>x<p><a>x</a>", "<div><article>", "<p a=' b=\" ", "<div class=nav><main>x</main>", "<a b                              "])
def test_main_text_stays_linear(piece):
    import time

    def took(n):
        def once():
            t = time.process_time()
            main_text.main_text(piece * n)
            return time.process_time() - t

        return min(once() for _ in range(3))

    assert took(80_000) < 6 * max(took(20_000), 0.05)


@pytest.mark.parametrize("piece", ["<a ", "<a title='", '<!--', "<p>x", "<div><p>x</p>", "<script>", "</b>", "<article>", "&amp;"])
def test_main_text_is_linear(piece):
    import time

    def took(n):
        t = time.process_time()
        main_text.main_text(piece * n)
        return time.process_time() - t

    took(1000)
    assert took(80_000) < 6 * max(took(20_000), 0.05)


def test_main_text_on_odd_rows(spark):
    rows = [(1, "u", PAGE, "clash"), (2, None, None, None), (None, "", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, `__x y` string")
    out = {r.page_id: r for r in main_text.extract_main_text(df).collect()}
    assert out[1].n_chars == len(out[1].text) and out[2].text == "" and out[None].text == ""


def test_mixing_keeps_to_its_targets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source")
    out = mixing.mix(docs).collect()
    by = defaultdict(list)
    for r in out:
        assert r.size == len(words(r.text)) and r.taken == r.copies * r.size <= 2 * r.size
        by[r.source].append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows)
        assert rows[0].source_size == sum(r.size for r in rows)
    assert sum(rows[0].target for rows in by.values()) == pytest.approx(1.5 * sum(r.size for r in out))
    assert {r.doc_id: r.copies for r in mixing.mix(docs).collect()} == {r.doc_id: r.copies for r in out}


def test_mixing_on_odd_rows(spark):
    out = mixing.mix(odd_docs(spark)).collect()
    assert len(out) == 8 and all(r.copies == 0 for r in out if not r.size)
    assert mixing.mix(odd_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("id", [7, None])
def test_mixing_splits_equal_rows_at_the_cut(spark, id):
    """Every source holds nothing but copies of one row, over many partitions; each still comes near its target."""
    rows = [(id, "one two three", s, "x") for s in ("a", "b", "c") for _ in range(101)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").repartition(7)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    for s in "abc":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1.5
        assert max(r.copies for r in mine) - min(r.copies for r in mine) <= 1 and {r.size for r in mine} == {3}


def test_mixing_draws_rows_without_id_by_text(spark):
    docs = spark.createDataFrame([(None, f"w{i} x", s) for i in range(90) for s in "ab"], "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    for s in "ab":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1


def plain_mix(docs, grades):
    """Copies of every row (id, text, source) by the definition, one source at a time."""
    import hashlib

    sources = sorted({r[2] for r in docs})
    size = {s: sum(len(words(t)) for _, t, x in docs if x == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, free = {}, set(sources)
    while free:
        level = (1.5 * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * size[s]}
        target |= {s: 2 * size[s] for s in full} if full else {s: weight[s] * level for s in free}
        free = free - full if full else set()
    copies = {}
    for s in sources:
        epochs, before = int(target[s] // size[s]), 0
        rest, keyed = target[s] - epochs * size[s], []
        for d, t, x in docs:
            if x == s:
                u = (int(hashlib.md5(str(d).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                keyed.append((-math.log(u) / (1 + grades(d, t)), d, len(words(t))))
        for _, d, n in sorted(keyed):
            copies[d] = (epochs + (rest > 0 and before + n / 2 <= rest)) if n else 0
            before += n
    return copies


def test_mixing_uses_labelled_quality(spark, monkeypatch):
    """Known bad documents without a symbol weigh less than known good ones full of them."""
    from shelfwright.llm import common

    labels = [(d, q) for d in range(0, 300, 2) for q in ([d // 2 % 2] if d % 4 else [0, 1, d // 4 % 2])] + [(7, None), (None, 1)]
    docs = [(d, " ".join(["#$%" if d % 3 else "word"] * (d % 7 + 1)), "abc"[d % 3 % 2]) for d in range(300)]
    known = defaultdict(list)
    for d, q in labels:
        if q is not None:
            known[d].append(q)

    def grade(d, t):
        return np.mean(known[d]) if d in known else max(0.0, 1 - 5 * sum(c in mixing.SYMBOLS for c in t) / len(t))

    known.pop(None)
    want = plain_mix(docs, grade)
    assert want != plain_mix(docs, lambda d, t: grade(None, t))
    table, given = spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int")
    given = mixing.quality_labels(given)
    assert {r.doc_id: r.copies for r in mixing.mix(table, labels=given).collect()} == want
    monkeypatch.setattr(mixing, "counted_broadcast", lambda df: common.counted_broadcast(df, 20))
    assert {r.doc_id: r.copies for r in mixing.mix(table, labels=given).collect()} == want


def test_pipeline_mixing_uses_the_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]

    def grade(d, t):
        return known[d] if d in known else max(0.0, 1 - 5 * sum(c in mixing.SYMBOLS for c in t) / len(t)) if t else 0.5

    got = Counter(r.doc_id for r in corpus_pipeline.mixing(spark, docs, FOLDER).collect())
    assert got == {d: n for d, n in plain_mix(rows, grade).items() if n}


def test_hypergeometric_law():
    import random

    rng = random.Random(1)
    draws = [sharding.hypergeometric(rng, 12, 20, 9) for _ in range(20_000)]
    for k in range(10):
        p = math.comb(12, k) * math.comb(20, 9 - k) / math.comb(32, 9)
        assert abs(draws.count(k) / len(draws) - p) < 5 * math.sqrt(p / len(draws)) + 1e-3
    matrix = sharding.communication_matrix([5, 0, 11, 30], 4, 3)
    assert [sum(r) for r in matrix] == [5, 0, 11, 30] and sorted(map(sum, zip(*matrix))) == [11, 11, 12, 12]


@pytest.mark.parametrize("n", [0, 1, 23, 200])
def test_shards_are_exact(spark, n):
    df = spark.range(n).withColumns({"shard": F.lit("clash"), "part": F.lit(None).cast("int")})
    out = sharding.shuffle_into_shards(df, 24, ["id"]).collect()
    assert sorted(r.id for r in out) == list(range(n))
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_query(spark):
    import zlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["op8_sharding"](spark, FOLDER).collect():
        b = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "rows", None)


def shingle_set(text):
    w = [lower(x) for x in words(text)]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


@pytest.mark.parametrize("short", [minhash_join.SHORT, 2, 10**6])
def test_herds_lose_no_link(spark, monkeypatch, short):
    """A family of near copies around one text, of which many pairs are just not similar enough."""
    monkeypatch.setattr(minhash_join, "SHORT", short)
    g = np.random.default_rng(4)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for d in range(140):
        w = list(base)
        for i in g.choice(90, int(g.integers(0, 7)), replace=False):
            w[i] = f"x{g.integers(10**6)}"
        rows.append((d, " ".join(w)))
    rows += [(200 + d, " ".join([f"p{i}" for i in range(20)] + [f"o{d}_{i}" for i in range(15)])) for d in range(40)]
    rows += [(300, None), (301, ""), (302, "a b"), (303, "A  b"), (None, "a b"), (None, "only this one"), (304, "a b"), (304, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = minhash_join.near_duplicates(df).collect()
    sets = {d: shingle_set(t) for d, t in rows if d is not None}
    links = defaultdict(set)
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id in (302, None) and r.kept == (r.component_id is None)
            continue
        seen, todo = {r.doc_id}, [r.doc_id]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), min(seen), r.doc_id == min(seen))
    assert minhash_join.near_duplicates(df.limit(0)).count() == 0


def test_boilerplate_without_links_meets_nowhere(spark, monkeypatch):
    """Pages that share 40 of 68 words are one herd; none of them is sent to a block or compared in a pair."""
    compared = []
    keep = minhash_join.confirmed
    monkeypatch.setattr(minhash_join, "confirmed", lambda pairs, sets: compared.append(pairs.count()) or keep(pairs, sets))
    monkeypatch.setattr(minhash_join, "_block_links", None)
    shared = [f"s{i}" for i in range(40)]
    rows = [(d, " ".join(shared + [f"o{d}_{i}" for i in range(28)])) for d in range(600)]
    rows += [(1000, rows[5][1] + " one"), (1001, rows[5][1] + " two")]
    out = minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in out if not r.kept} == {1000, 1001} and {r.component_id for r in out if not r.kept} == {5}
    assert sum(compared[1:]) <= 10


def test_one_row_of_each_component_stays(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = " and more".join([a, ""])
    rows = [(1, a, "y"), (1, a, "x"), (1, a, "x"), (1, near, "z"), (2, a, "x"), (None, near, "n")]
    rows += [(None, b, "x"), (None, b, "y"), (None, b + " end", "x"), (9, c, "x"), (None, c, "x"), (5, c, None)]
    rows += [(None, "", "x"), (None, None, "x"), (7, " ", "x"), (7, " ", "x"), (8, "on its own", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in minhash_join.drop_near_duplicates(df).collect()]
    groups = Counter(next((k for k, x in zip("abc", (a, b, c)) if t and t.startswith(x)), t) for _, t, _ in out)
    assert groups == {"a": 1, "b": 1, "c": 1, "": 1, None: 1, " ": 2, "on its own": 1}
    assert [d for d, t, _ in out if t and t.startswith("a")] == [1] and (5, c, None) in out
    assert set(out) <= set(rows) and ((1, a, "x") in out or (1, near, "z") in out)
    assert minhash_join.drop_near_duplicates(df.limit(0)).count() == 0


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(-6, 6), max_size=14))
def test_segments_are_the_maximal_ones(weights):
    def recursive(lo, hi):
        best = max(((sum(weights[i:j]), i - j, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0, 0, 0, 0), key=lambda x: (x[0], x[1]))
        if best[0] <= 0:
            return []
        return recursive(lo, best[2]) + [best[0]] + recursive(best[3], hi)

    found = toxic_segments.segments([float(w) for w in weights])
    assert sorted(s for *_, s in found) == sorted(map(float, recursive(0, len(weights))))
    assert all(sum(weights[a:b]) == s for a, b, s in found)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    hit = Counter((truth[r.doc_id], r.predicted) for r in QUERIES["op10_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in truth)
    assert hit[1, 1] >= 0.85 * (hit[1, 1] + hit[1, 0]) and hit[0, 1] <= 0.01 * hit[0, 0]


def test_toxicity_on_odd_rows(spark):
    docs = odd_docs(spark)
    for labels in ([], [(1, 1)], [(2, 1), (3, 0), (None, 1), (4, None), (3, 0)]):
        model = toxic_segments.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        out = toxic_segments.score(docs, model).collect()
        assert len(out) == 8 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_language_model_scores(spark):
    import zlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    out = {r.doc_id: r for r in QUERIES["op5_lm_scoring"](spark, FOLDER).collect()}
    tokens = {d: [lower(w) for w in words(t)] + ["\n"] for d, t in docs.items()}
    train = Counter(w for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in t)
    n, v = sum(train.values()), len(train)
    assert set(out) == set(docs)
    for d, t in tokens.items():
        r = out[d]
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in train for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (zlib.crc32(str(d).encode()) % 10 == 0)
        assert r.score < 0
    held = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("kept", [None, 600])
def test_language_model_against_a_plain_loop(spark, monkeypatch, kept):
    """Every text word by word from the same parameters; with few counts kept, most words meet theirs in the join."""
    lb = log_bilinear
    if kept:
        monkeypatch.setattr(lb, "COUNTS", kept)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(1000, "never seen zzyx, never qqxj"), (1001, None)], "doc_id long, text string"))
    r1, r2 = lb.hash_pair(F.col("doc_id"), F.col("text"))
    rows = docs.select("doc_id", "text", r1.alias("r1"), r2.alias("r2"))
    model, counts = lb.train(rows.where("doc_id % 5 > 0 AND doc_id < 1000"), F.col("doc_id"))
    got = {(r.r1, r.r2): r for r in lb.score(rows, model, counts).collect()}
    given = rows.collect()
    n = Counter(w for r in given if r.doc_id % 5 and r.doc_id < 1000 for w in map(str.encode, map(lower, words(r.text))))
    own = {w: i for i, w in enumerate(model.frequent)}
    of = {w: own.get(w, model.layout.ending(w)) for w in n}
    assert len(n) > 2 * len(model.counts) if kept else len(model.counts) == len(n) + 1
    mass = Counter()
    for w, c in of.items():
        mass[c] += n[w] + lb.SMOOTH
    first, p = {}, model.p
    for r in given:
        one, two, total = model.layout.start, model.layout.start, 0.0
        for w in [*map(str.encode, map(lower, words(r.text))), None]:
            c = model.layout.end if w is None else own.get(w, model.layout.ending(w))
            if (one, two) not in first:
                s = (p.r[one] * p.c[0] + p.r[two] * p.c[1]) @ p.q.T + p.b
                first[one, two] = s - s.max() - math.log(np.exp(s - s.max()).sum())
            total += first[one, two][c] / math.log(10)
            if w is not None and c >= model.layout.words:
                total += math.log10((n[w] + lb.SMOOTH) / (mass[c] + lb.SMOOTH))
            one, two = c, one
        assert got[r.r1, r.r2].score == pytest.approx(total, rel=1e-5, abs=1e-3)
        assert got[r.r1, r.r2].n_known == sum(w in n for w in map(str.encode, map(lower, words(r.text)))) + 1


def test_language_model_is_normalised_and_odd_rows(spark):
    docs = odd_docs(spark)
    model, counts = log_bilinear.train(docs.select("text"), F.coalesce("doc_id", F.lit(0)))
    p, start = model.p, model.layout.start
    for one, two in ((start, start), (0, start), (3, min(600, start))):
        s = p.predict(np.array([one]), np.array([two]))[0] @ p.q.T + p.b - model.normalisers[one, two]
        assert np.exp(s).sum() == pytest.approx(1, abs=1e-4)
    out = log_bilinear.train_and_score(docs).collect()
    assert len(out) == 8 and {r.n_tokens for r in out if r.doc_id in (1, 2, 6)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)
    assert log_bilinear.train_and_score(docs.limit(0)).count() == 0


def test_language_model_grows_and_forgets_its_partitions(spark, monkeypatch):
    monkeypatch.setattr(log_bilinear, "STREAM", 20_000)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    few = log_bilinear.train(docs.where("doc_id < 40"), F.col("doc_id"))[0].layout
    scores = []
    for parts in (1, 8):
        rows = docs.repartition(parts)
        model, _ = log_bilinear.train(rows, F.col("doc_id"), F.xxhash64("doc_id", "text"))
        assert model.layout.words > few.words and model.layout.endings > few.endings
        assert model.layout.endings == int(log_bilinear.PER_ROOT * model.vocabulary ** (1 / 3))
        scores.append({r.doc_id: r.score for r in log_bilinear.train_and_score(rows).collect()})
    assert scores[0].keys() == scores[1].keys()
    assert all(scores[1][d] == pytest.approx(s, rel=1e-4) for d, s in scores[0].items())


def test_pipeline_stages(spark):
    from shelfwright.session import settle

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs
        docs = settle(stage(spark, docs, FOLDER))
        assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = docs
    ids = [r.doc_id for r in kept["toxicity"].collect()]
    assert Counter(ids).keys() == Counter(r.doc_id for r in kept["line_dedup"].collect()).keys()
    texts = {r.doc_id: r.text for r in kept["line_dedup"].collect()}
    sets = {d: shingle_set(t) for d, t in texts.items()}
    survivors = [r.doc_id for r in kept["near_dedup"].collect()]
    assert survivors and set(survivors) <= set(ids)
    for a, b in combinations(survivors, 2):
        if sets[a] and sets[b]:
            assert 100 * len(sets[a] & sets[b]) < 75 * len(sets[a] | sets[b])
    copies = Counter(r.doc_id for r in kept["mixing"].collect())
    assert set(copies) <= set(survivors) and max(copies.values()) <= 2
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == copies
    odd = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), FOLDER).count() == 0
        stage(spark, odd, FOLDER).collect()
