"""A small tolerant HTML reader: one page in, the facts the extraction rules need out.

This is the only per-page Python code. Everything that decides anything about a page is a
Column expression over these facts.

Elements and texts are numbered in document order; an element's interval ``[pre, last]`` holds
the numbers of all below it, so "inside", "below" and "after" are comparisons of numbers. Of the
elements around a node that match a watched mark, ``outer`` and ``inner`` give the number of the
outermost and the innermost.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import escape, unescape

_TOKEN = re.compile(
    r"<(?:!--(.*?)(?:-->|\Z)"  # 1 comment
    r"|/([a-zA-Z][^\s/>]*)[^>]*>"  # 2 end tag
    r"|([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"  # 3 start tag, 4 attributes
    r"|[!?][^>]*>)",
    re.S,
)
_OPEN_COMMENT = re.compile(r"<!--(.*)\Z", re.S)
_HEADING = re.compile(r"h\d")
_MARKUP = re.compile(r"<[^>]+>")
_VISIBLE = re.compile(r"\S")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CLASS = re.compile("class", re.I)
_NO_ATTRS: dict = {}

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style"))
_RAW_END = {t: re.compile(f"</{t}", re.I) for t in _RAW}
# whitespace directly inside these is layout, not text
_NO_BLANKS = frozenset("html head table thead tbody tfoot tr ul ol dl select".split())

# A start tag closes open elements of these names, innermost first, while one matches.
_BLOCKS = "address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul"
_INLINE = frozenset("b big i s small strike tt u".split())
_CLOSES: dict[str, frozenset] = {t: frozenset(("p", "head")) for t in _BLOCKS.split()}
_CLOSES["p"] = frozenset(("p", "head", "h1", "h2", "h3", "h4", "h5", "h6")) | _INLINE
_CLOSES["li"] = frozenset(("li", "p", "h1", "h2", "h3", "h4", "h5", "h6"))
_CLOSES["dt"] = _CLOSES["dd"] = frozenset(("dt", "dd", "p"))
_CLOSES["td"] = _CLOSES["th"] = frozenset(("td", "th", "p", "a")) | _INLINE
_CLOSES["tr"] = frozenset(("td", "th", "tr", "p", "caption", "colgroup"))
_CLOSES["tbody"] = _CLOSES["tfoot"] = _CLOSES["thead"] = frozenset(
    ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup", "p")
)
_CLOSES["a"] = frozenset(("a",))
_CLOSES["option"] = frozenset(("option",))
_CLOSES["body"] = frozenset(("head", "title", "style", "script"))

# An end tag does not reach past an open element of higher rank.
_RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180}
_RANK |= {"table": 190, "head": 200, "body": 200, "html": 220}


class Node:
    __slots__ = ("tag", "src", "parent", "kids", "_attrs", "_classes", "pre", "last")

    def __init__(self, tag, src, parent):
        self.tag, self.src, self.parent = tag, src, parent
        self.kids = []  # Node, str (text) or bytes (comment)
        self._attrs = self._classes = None

    @property
    def attrs(self) -> dict:
        if self._attrs is None:
            self._attrs = _attributes(self.src)
        return self._attrs

    @property
    def classes(self) -> list:
        if self._classes is None:
            # look for the word first: most elements have no class
            self._classes = self.attrs.get("class", "").split() if _CLASS.search(self.src) else []
        return self._classes


def _attributes(src: str) -> dict:
    if not src or src.isspace() or src == "/":
        return _NO_ATTRS
    out = {}
    for m in _ATTR.finditer(src):
        name = m.group(1).lower()
        if name not in out:
            v = m.group(2) or m.group(3) or m.group(4) or ""
            out[name] = unescape(v) if "&" in v else v
    return out


def _next_token(html: str, pos: int, last: int):
    """The first token at or after ``pos``; ``last`` is the end of the page's last ``>``.

    Beyond it only a comment that is never closed can start, so no open tag there is tried.
    """
    at = html.find("<", pos)
    while 0 <= at < last:
        m = _TOKEN.match(html, at)
        if m:
            return m
        at = html.find("<", at + 1)
    return _OPEN_COMMENT.search(html, at) if at >= 0 else None


def read_tree(html: str):
    """The document root and all its elements in document order."""
    root = cur = Node("#root", "", None)
    nodes: list[Node] = []
    pos, end = 0, len(html)
    last = html.rfind(">") + 1
    while pos < end:
        m = _next_token(html, pos, last)
        at = end if m is None else m.start()
        if at > pos:
            text = html[pos:at]
            if not (cur.tag in _NO_BLANKS and text.isspace()):
                if "&" in text:
                    text = unescape(text)
                kids = cur.kids
                if kids and type(kids[-1]) is str:
                    kids[-1] += text
                else:
                    kids.append(text)
        if m is None:
            break
        pos = m.end()
        kind = m.lastindex
        if kind == 4:  # start tag, with its attributes
            tag = m[3].lower()
            closes = _CLOSES.get(tag)
            if closes:
                while cur.tag in closes:
                    cur = cur.parent
            node = Node(tag, m[4], cur)
            cur.kids.append(node)
            nodes.append(node)
            if tag in _RAW:
                stop = _RAW_END[tag].search(html, pos)
                cut = stop.start() if stop else end
                if cut > pos:
                    node.kids.append(html[pos:cut])
                pos = cut
                cur = node
            elif tag not in _VOID:
                cur = node
        elif kind == 2:  # end tag
            tag = m[2].lower()
            if cur.tag == tag:
                cur = cur.parent
                continue
            rank = _RANK.get(tag, 100)
            n = cur
            while n is not root and n.tag != tag:
                if _RANK.get(n.tag, 100) > rank:
                    n = root
                    break
                n = n.parent
            if n is not root:
                cur = n.parent
        elif kind == 1:  # comment
            cur.kids.append(m[1].encode("utf-8", "replace"))
    return root, nodes


def texts(node: Node):
    """Text nodes at or below ``node`` in document order."""
    stack = [iter(node.kids)]
    while stack:
        for kid in stack[-1]:
            if type(kid) is str:
                yield kid
            elif type(kid) is Node:
                stack.append(iter(kid.kids))
                break
        else:
            stack.pop()


def first_text(node: Node) -> str:
    return next(texts(node), "")


def own_text(node: Node):
    return next((k for k in node.kids if type(k) is str), None)


def _written(k) -> str:
    """A comment, or an element whose content is no markup, as text."""
    if type(k) is bytes:
        return f"<!--{k.decode('utf-8', 'replace')}-->"
    return f"<{k.tag}>{''.join(x for x in k.kids if type(x) is str)}</{k.tag}>"


def markup(node: Node) -> str:
    """The element as text, attributes left out: tags, escaped text, comments."""
    out = []
    todo = [node]
    while todo:
        k = todo.pop()
        if type(k) is Node:
            out.append(f"<{k.tag}>")
            if k.tag in _RAW:
                out.extend(x for x in k.kids if type(x) is str)
                out.append(f"</{k.tag}>")
            elif k.tag not in _VOID:
                todo.append(k.tag)
                todo.extend(reversed([(x,) if type(x) is str else x for x in k.kids]))
        elif type(k) is tuple:
            out.append(escape(k[0], quote=False))
        elif type(k) is bytes:
            out.append(f"<!--{k.decode('utf-8', 'replace')}-->")
        else:
            out.append(f"</{k}>")
    return "".join(out)


#: Marks every page is read with.
MARKS = {"table": ("table",), "thead": ("thead",), "tbody": ("tbody",), "li": ("li",), "trail": (".breadcrumb", ".breadcrumbs")}


class Selectors:
    """Named sets of simple selectors ``tag``, ``.class`` or ``tag.class``; says which names an element matches."""

    def __init__(self, named: dict[str, tuple]):
        self.names = tuple(named)
        self.tags: dict[str, list] = {}
        self.classes: dict[str, list] = {}
        for i, selectors in enumerate(named.values()):
            for s in selectors:
                tag, _, cls = s.partition(".")
                if cls:
                    self.classes.setdefault(cls, []).append((tag, i))
                else:
                    self.tags.setdefault(tag, []).append(i)

    def of(self, node: Node) -> list[int]:
        found = list(self.tags.get(node.tag, ()))
        if self.classes and node.src:
            for c in node.classes:
                found += [i for tag, i in self.classes.get(c, ()) if not tag or tag == node.tag]
        return found


class Watch:
    """Which class names, ids, marks and marker text the facts of a site refer to.

    ``marks`` are named selectors for ``outer`` and ``inner``; ``listed`` are pairs of a selector
    and a mark that must be around the element (or None); rows with one of ``whole_rows`` list all
    of their cells, others the first two; ``kin`` are the tags whose siblings are listed.
    """

    def __init__(self, classes=(), marked=(), marker="", marks=None, listed=(), whole_rows=(), kin=("h3",)):
        self.classes = frozenset(classes)
        self.ids = any(c.startswith("#") for c in self.classes)
        self.marked = tuple(marked)  # (key, class, ancestor class or None)
        self.marker = marker
        self.marks = Selectors({**MARKS, **(marks or {})})
        self.listed = tuple(listed)
        self.listing = Selectors({str(i): (selector,) for i, (selector, _) in enumerate(self.listed)})
        self.whole_rows = frozenset(whole_rows)
        self.kin = tuple(kin)


class PageFacts:
    """Facts of one page, each computed on request from one reading of it."""

    def __init__(self, html: str | None, watch: Watch):
        self.root, self.nodes = read_tree(html or "")
        self.watch = watch
        self.by_tag: dict[str, list[Node]] = {}
        self.classed: list[Node] = []
        self._watched: dict[Node | None, tuple] = {None: ()}
        nothing = (None,) * len(watch.marks.names)
        self._marks: dict[Node | None, tuple] = {None: (nothing, nothing)}
        self._order: dict[Node, dict] = {}
        self._places: list | None = None
        self._strings: list = []
        self._plain: str | None = None
        self._span: dict[Node, tuple] = {}
        for n in self.nodes:
            self.by_tag.setdefault(n.tag, []).append(n)
            if n.src and n.classes:
                self.classed.append(n)

    def _all(self, *tags):
        if len(tags) == 1:
            return self.by_tag.get(tags[0], ())
        return (n for n in self.nodes if n.tag in tags)

    def _anc(self, node: Node):
        """Watched class names and ids of the ancestors, each once."""
        watched, ids = self.watch.classes, self.watch.ids
        if not watched:
            return []
        known, path, n = self._watched, [], node.parent
        while n not in known:
            path.append(n)
            n = n.parent
        out = known[n]
        for n in reversed(path):
            if n.src:
                own = [c for c in n.classes if c in watched]
                if ids and "#" + n.attrs.get("id", "") in watched:
                    own.append("#" + n.attrs["id"])
                if not set(own).issubset(out):
                    out = tuple(dict.fromkeys((*own, *out)))
            known[n] = out
        return list(out)

    def title(self):
        return next((t for t in map(own_text, self._all("title")) if t is not None), None)

    def metas(self):
        return [
            (n.attrs.get("name"), n.attrs.get("property"), n.attrs["content"])
            for n in self._all("meta")
            if "content" in n.attrs
        ]

    def heads(self):
        return [
            (int(n.tag[1]), n.classes, self._anc(n), own_text(n), list(texts(n)))
            for n in self._all("h1", "h2", "h3")
        ]

    def paras(self):
        out = []
        for n in self._all("p"):
            anc = None
            for k in n.kids:
                if type(k) is str:
                    anc = self._anc(n) if anc is None else anc
                    out.append((k, anc))
        return out

    def links(self):
        return [
            (i, n.attrs["href"], first_text(n), n.attrs.get("title", ""), n.classes, self._anc(n))
            for i, n in enumerate(a for a in self._all("a") if "href" in a.attrs)
        ]

    def images(self):
        return [(n.attrs["src"], n.classes, self._anc(n)) for n in self._all("img") if "src" in n.attrs]

    def items(self):
        found = ((first_text(n), self._anc(n)) for n in self._all("li"))
        return [(text, anc) for text, anc in found if anc]

    def _inside(self, node: Node, cls: str) -> bool:
        n = node.parent
        while n is not None and cls not in n.classes:
            n = n.parent
        return n is not None

    def marked(self):
        out = {}
        for key, cls, outer in self.watch.marked:
            for n in self.classed:
                if cls in n.classes and (outer is None or self._inside(n, outer)):
                    own, whole = out.get(key, (None, None))
                    out[key] = (own_text(n) if own is None else own, markup(n) if whole is None else whole)
        return list(out.items())

    def classes(self):
        seen = {c for n in self.classed for c in n.classes}
        return sorted(seen & self.watch.classes)

    # ---- numbered nodes -----------------------------------------------------------------

    def _number(self):
        """Numbers elements and texts in document order, once."""
        if self._places is not None:
            return
        self._places, self._strings = [], []
        at, self.root.pre = 0, 0
        stack = [(self.root, iter(self.root.kids))]
        while stack:
            node, kids = stack[-1]
            for k in kids:
                kind = type(k)
                if kind is str:
                    at += 1
                    self._places.append(at)
                    self._strings.append(k)
                elif kind is Node:
                    at += 1
                    k.pre = at
                    stack.append((k, iter(k.kids)))
                    break
            else:
                node.last = at
                stack.pop()

    def _text(self, node: Node) -> str:
        """The first text at or below the element, found by its number."""
        i = bisect_left(self._places, node.pre)
        return self._strings[i] if i < len(self._places) and self._places[i] <= node.last else ""

    def _around(self, node: Node):
        """(outer, inner) over the marks, each a tuple of numbers or None, of the elements around ``node``."""
        known, path, n = self._marks, [], node.parent
        while n not in known:
            path.append(n)
            n = n.parent
        out = known[n]
        for n in reversed(path):
            hits = self.watch.marks.of(n)
            if hits:
                outer, inner = map(list, out)
                for i in hits:
                    outer[i] = n.pre if outer[i] is None else outer[i]
                    inner[i] = n.pre
                out = tuple(outer), tuple(inner)
            known[n] = out
        return out

    def _listed(self, node: Node) -> bool:
        for i in self.watch.listing.of(node):
            mark = self.watch.listed[i][1]
            if mark is None or self._around(node)[0][self.watch.marks.names.index(mark)] is not None:
                return True
        return bool(self.watch.marker) and self.watch.marker in (own_text(node) or "")

    def elements(self):
        """The listed elements, and those whose own first text holds the marker."""
        self._number()
        return [
            (n.tag, n.pre, n.last, n.classes, [k for k in n.kids if type(k) is str], *self._around(n))
            for n in self.nodes
            if self._listed(n)
        ]

    def strings(self):
        """(number, text) of all texts from the first element on whose own first text holds the marker."""
        mark = self.watch.marker
        first = next((n for n in self.nodes if mark in (own_text(n) or "")), None) if mark else None
        if first is None:
            return []
        self._number()
        at = bisect_left(self._places, first.pre)
        return list(zip(self._places[at:], self._strings[at:]))

    def rows(self):
        """Table rows with their cells, read in one pass: a cell goes to the rows open around it that still take cells."""
        self._number()
        whole, out, open_ = self.watch.whole_rows, [], []
        for n in self.nodes:
            if n.tag not in ("tr", "td", "th"):
                continue
            while open_ and open_[-1][0].last < n.pre:
                open_.pop()
            if n.tag == "tr":
                cells: list = []
                out.append((n.pre, n.last, n.classes, *self._around(n), cells))
                open_.append((n, cells, bool(whole) and not whole.isdisjoint(n.classes)))
            elif open_:
                cell = (n.tag, self._nth(n), own_text(n), self._text(n))
                for _, cells, _ in open_:
                    cells.append(cell)
                if any(len(cells) == 2 and not every for _, cells, every in open_):
                    open_ = [o for o in open_ if o[2] or len(o[1]) < 2]
        return out

    def _nth(self, node: Node) -> int:
        """Place among the element children of its parent, from 1."""
        places = self._order.get(node.parent)
        if places is None:
            kids = (k for k in node.parent.kids if type(k) is Node)
            places = self._order[node.parent] = {k: i for i, k in enumerate(kids, 1)}
        return places[node]

    def kin(self):
        """Per parent of a watched tag its children in order: (tag, pre, head, start, size, blank, text).

        Of an element, its place in ``plain``, and for a heading its first text; of a text, itself
        without what looks like tags.
        """
        self._plain_text()
        parents = dict.fromkeys(n.parent for n in self._all(*self.watch.kin))
        out = []
        for p in parents:
            kids = []
            for k in p.kids:
                if type(k) is Node:
                    start, size = self._span[k]
                    head = self._text(k) if _HEADING.match(k.tag) else None
                    kids.append((k.tag, k.pre, head, start, size, self._blank(start, size), None))
                elif type(k) is str:
                    text = _MARKUP.sub("", k)
                    kids.append((None, None, None, 0, 0, not text.strip(), text))
            out.append(kids)
        return out

    def plain(self):
        """The page's markup as text without its tags: text escaped, scripts and comments as they are written."""
        return self._plain_text()

    def _blank(self, start: int, size: int) -> bool:
        """Nothing but white space in that part of the plain text."""
        m = _VISIBLE.search(self._plain, start, start + size)
        return m is None

    def _plain_text(self) -> str:
        if self._plain is not None:
            return self._plain
        self._plain, self._span = "", {}
        if not any(self.by_tag.get(t) for t in self.watch.kin):
            return self._plain
        self._number()
        out, at = [], 0
        stack = [(self.root, iter(self.root.kids), 0)]
        while stack:
            node, kids, start = stack[-1]
            for k in kids:
                if type(k) is Node and k.tag not in _RAW:
                    stack.append((k, iter(k.kids if k.tag not in _VOID else ()), at))
                    break
                piece = escape(k, quote=False) if type(k) is str else _MARKUP.sub("", _written(k))
                if type(k) is Node:
                    self._span[k] = at, len(piece)
                out.append(piece)
                at += len(piece)
            else:
                self._span[node] = start, at - start
                stack.pop()
        self._plain = "".join(out)
        return self._plain

    def body_text(self):
        """All text nodes but those of the head, one space between them."""
        parts = []
        todo = list(reversed(self.root.kids))
        while todo:
            k = todo.pop()
            if type(k) is str:
                parts.append(k)
            elif type(k) is Node:
                if k.tag == "html":
                    todo.extend(reversed(k.kids))
                elif k.tag not in ("head", "title"):
                    parts.extend(texts(k))
        return " ".join(parts)
