"""URL rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwright.functions.text import holds_any, strip

# The component split of RFC 3986, appendix B.
_PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
# path, query and fragment without blanks, control characters or an empty query or fragment
_TIDY = r"[^\x00-\x20?#]*(\?[^\x00-\x20#]+)?(#[^\x00-\x20]+)?$"
_JOINABLE = ("", "http", "https", "ftp", "file")

# Hrefs that lead nowhere.
DEAD_PREFIXES = ("javascript:", "mailto:", "tel:", "#")


def _part(c: Column, i: int) -> Column:
    return F.regexp_extract(c, "(?s)" + _PARTS, i)


def _remove_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a rooted path; nothing climbs above the root."""
    kept = F.aggregate(
        F.split(path, "/", -1),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(
            s == "..",
            F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc),
        )
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(path.rlike(r"/\.\.?$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.regexp_replace(F.array_join(tail, "/"), "^(?!/)", "/")


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on page ``base`` (RFC 3986 reference resolution).

    The two common shapes, a full http URL and a rooted path, are recognised by one pattern
    each and need no splitting; only the rest is taken apart.
    """
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    full = href.rlike(rf"^https?://[^/?#]{_TIDY}")
    rooted = href.rlike(rf"^/(?!/){_TIDY}") & ~href.rlike(r"/\.\.?(/|[?#]|$)") & (site != "")
    return (
        F.when(full, href)
        .when(rooted, F.concat(site, href))
        .when(href.isNotNull(), _resolve_any(base, site, href))
    )


def _resolve_any(base: Column, site: Column, href: Column) -> Column:
    h = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    scheme, auth, path = _part(h, 1), _part(h, 2), _part(h, 3)
    query, frag = _part(h, 4), _part(h, 5)
    b_scheme, b_path, b_query = F.lower(_part(base, 1)), _part(base, 3), _part(base, 4)
    foreign = (scheme != "") & (F.lower(scheme) != b_scheme)
    query = F.when(query == "?", "").otherwise(query)
    frag = F.when(frag == "#", "").otherwise(frag)
    folder = F.regexp_extract(b_path, r"^(.*/)", 1)
    joined = F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), path), "/+", "/")
    rooted = F.when(path.startswith("/"), path).otherwise(joined)
    walked = F.when(rooted.rlike(r"/\.\.?(/|$)"), _remove_dots(rooted)).otherwise(rooted)
    return (
        F.when(href == "", base)
        .when(foreign | ~b_scheme.isin(*_JOINABLE), h)
        .when(F.length(auth) > 2, F.concat(b_scheme, F.lit(":"), auth, path, query, frag))
        .when(path == "", F.concat(site, b_path, F.when(query == "", b_query).otherwise(query), frag))
        .otherwise(F.concat(site, walked, query, frag))
    )


def is_navigable(href: Column) -> Column:
    """Not blank and not a script, mail, phone or in-page link."""
    ok = href.isNotNull() & (href != "")
    for p in DEAD_PREFIXES:
        ok = ok & ~href.startswith(p)
    return ok


def authority(url: Column) -> Column:
    """Network location with port, '' for a URL without one."""
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)


def same_site(url: Column, hosts) -> Column:
    return authority(url).isin(*hosts)


def contains_denied(url: Column, denied) -> Column:
    """The lower-cased URL contains a denied word.

    A word that contains another word of the list can never decide, so it is left out.
    """
    deciding = [w for w in denied if not any(o != w and o in w for o in denied)]
    return holds_any(F.lower(url), deciding)


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def _product_shape(u: Column, patterns, topics, deep: int) -> Column:
    is_html = u.endswith(".html") | u.endswith(".htm")
    slashes = F.length(u) - F.length(F.replace(u, F.lit("/"), F.lit("")))
    named = last_segment(u).rlike("|".join(f"(?:{p})" for p in patterns))
    return is_html & (named | ((slashes >= deep) & holds_any(u, topics)))


def looks_like_product(href: Column, denied, patterns, topics, deep: int = 6) -> Column:
    """HTML page, not denied, with a product-like file name or deep under a topic.

    Takes the href as written on the page: a relative link has fewer slashes.
    """
    return _product_shape(strip(F.lower(href)), patterns, topics, deep) & ~contains_denied(href, denied)


def link_route(href: Column, abs_url: Column, profile, deep: int = 6) -> Column:
    """'product', 'category' or NULL (not followed) for a link on a page of the site."""
    usable = is_navigable(href) & same_site(abs_url, profile.hosts) & ~contains_denied(href, profile.denied)
    product = _product_shape(strip(F.lower(href)), profile.product_patterns, profile.topic_words, deep)
    section = holds_any(abs_url, profile.sections)
    return F.when(usable, F.when(product, "product").when(section, "category"))
