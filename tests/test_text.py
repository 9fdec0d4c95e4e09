import json
import re
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwright.functions import text as X
from shelfwright.functions import urls as U

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
LETTERS = "abzAZ09 _-.:;,()<>/&#\t\n\r\x0b\x0c\x1c\x85\xa0  éÜñ²½…“„|[]{}!?*"
TEXTS = st.lists(st.text(alphabet=LETTERS, max_size=40), min_size=150, max_size=150)


def _apply(spark, values, *rules):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [tuple(r) for r in df.select(*[rule(F.col("c")) for rule in rules]).collect()]


@SLOW
@given(TEXTS)
def test_cleaners_equal_python(spark, values):
    rows = _apply(spark, values, X.clean_ws, X.clean_tags_space, X.clean_tags, X.clean_strict, X.strip, X.normalize_key)
    for v, (ws, spaced, tags, strict, stripped, key) in zip(values, rows):
        assert ws == " ".join(v.split())
        assert spaced == re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", v)).strip()
        assert tags == re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", v)).strip()
        kept = re.sub(r"[^\w\s.,;:()\-+@#%$€£¥&*°'\"/\\]", "", re.sub(r"<[^>]+>", "", v))
        assert strict == re.sub(r"\s+", " ", kept).strip()
        assert stripped == v.strip()
        assert key == re.sub(r"[^\w\s-]", "", v).strip().lower()


@SLOW
@given(TEXTS)
def test_cleaners_are_idempotent(spark, values):
    for rule in (X.clean_ws, X.clean_strict, X.normalize_key):
        once = [r[0] for r in _apply(spark, values, rule)]
        again = [r[0] for r in _apply(spark, once, rule)]
        assert once == again


@SLOW
@given(st.lists(st.text(alphabet="abzAZ09 -_.'é²\t/", max_size=30), min_size=100, max_size=100))
def test_title_case_equals_python(spark, values):
    assert [r[0] for r in _apply(spark, values, X.title_case)] == [v.title() for v in values]


SEGMENT = st.sampled_from(["", ".", "..", "a", "b.html", "c;p=1", "%20", "x y", "..."])
HREF = st.one_of(
    st.lists(SEGMENT, min_size=0, max_size=5).map("/".join),
    st.builds(
        lambda lead, path, q, f: lead + "/".join(path) + q + f,
        st.sampled_from(["", "/", "//host.example", "http://o.example/", "https://o.example", "mailto:", "  "]),
        st.lists(SEGMENT, min_size=1, max_size=4),
        st.sampled_from(["", "?", "?a=1&b=/../x"]),
        st.sampled_from(["", "#", "#top"]),
    ),
)
BASE = st.sampled_from(
    ["http://h.example", "https://h.example/", "https://h.example/a/b/c.html?q=1#f", "http://h.example:8080/a/", "https://h.example/a?x=/y/z"]
)


@SLOW
@given(st.lists(st.tuples(BASE, HREF), min_size=200, max_size=200))
def test_resolve_url_equals_python(spark, pairs):
    df = spark.createDataFrame(pairs, "b string, h string").select(U.resolve_url(F.col("b"), F.col("h")))
    for (b, h), row in zip(pairs, df.collect()):
        assert row[0] == urljoin(b, h), (b, h)


def test_strip_markup_removes_whole_blocks(one):
    html = "a<script type=x>if (1<2) {'</b>'}</script>b<style>p{}</style><p>c <b>d</b></p>"
    assert one(X.strip_markup, c=html) == "abc d"
    assert one(X.clean_strict, c="<script>x</script>y") == "xy"


def test_canonical_json(one):
    assert one(X.canonical_json, c='{"b" : "x",  "a": 1.5, "ü": "²"}') == '{"b":"x","a":1.5,"ü":"²"}'
    assert one(X.canonical_json, c="not json") == "not json"
    assert one(X.canonical_json, c="[1, 2]") == "[1, 2]"
    assert json.loads(one(X.canonical_json, c='{"n": {"z": 1, "y": [true, null]}}')) == {"n": {"z": 1, "y": [True, None]}}
    assert one(X.canonical_json, c=None) is None


@pytest.mark.parametrize("n,expect", [(5, "abcde"), (4, "abcd..."), (9, "abcde")])
def test_ellipsize(one, n, expect):
    assert one(lambda c: X.ellipsize(c, n), c="abcde") == expect


def test_words_with_pattern_characters_are_literal(one):
    words = ("a.b", "c+", "(d", "e|f")
    assert one(lambda c: X.holds_any(c, words), c="x a.b") is True
    assert one(lambda c: X.holds_any(c, words), c="aXb cc e") is False
