"""Main text of web pages by tree scoring.

A page is cut into tags and text and built into a tree, with the end tags that
authors leave out.  Menus, page headers and footers, sidebars, forms, notices,
adverts, comments and the like go by their element, role or the head word of a
class or id (``page-header`` is a header, ``share-price`` is no share); inside an
article such words drop boxes, not headings, paragraphs or its own header.  Each remaining block of text gives points for its length and
commas to its ancestors (all to the parent, half to the next, a third, ...),
and an element's points are discounted by the share of its text that is links.
The best container stays.  Inside an article or main element all of that
element stays, links too.  Elsewhere all of its parent stays, if that holds most
of the text that is not links; beside a container at page level stay headings,
paragraphs, lists, tables, bare text, the boxes that score close to it, boxes of
a heading and paragraphs after it, and what lies between two that stay; lists
and boxes of mostly links go, but for a numbered list under a heading that
stays.  If the words of a class or id, or a form, dropped the best container and
what is left has few points, its ancestors come back: a form may wrap a page.

Text is decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by an empty line.  Nothing else is dropped or
cut.  A page without markup is one block.  Null and empty html give an empty
text; repeated rows and null ids are kept.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_pass

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/><]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)", re.S)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_OPEN_QUOTE = re.compile(r"""=\s*(["'])""")
_VALUE_OR_END = re.compile(r"""=\s*(["'])|>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements whose content is not markup.
_RAW = {"script", "style", "noscript", "iframe", "textarea", "title", "template", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
          "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary",
          "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: An opening tag ends the elements named here, up to the nearest of the others.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}
#: Elements that an end tag of something inside them cannot reach beyond.
_WALL = {"table", "td", "th", "button", "article", "section", "main", "body"}

_DROP_TAGS = {"nav", "footer", "aside", "button", "select", "dialog", "menu", "svg", "object", "canvas", "audio",
              "video", "search", "input", "fieldset"} | _RAW
_DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu",
               "menubar", "toolbar", "form"}
_DROP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "alert", "banner", "breadcrumb", "breadcrumbs",
               "byline", "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr",
               "header", "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
               "notices", "notification", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended",
               "related", "replies", "reply", "respond", "share", "sharing", "shoutbox", "sidebar", "signup", "skip", "social",
               "sponsor", "sponsored", "subscribe", "subscription", "tags", "toolbar", "widget", "widgets"}
_DROP_WORDS |= {"commentlist", "responses"}
#: Names of boxes of reader comments that sections of an article have too.
_OUTSIDE_WORDS = {"discussion", "feedback"}
#: An article has a header of its own.
_OWN_WORDS = {"header", "banner", "byline"}
#: Words that only say that something is held: the word before them is the head.
_HOLDERS = {"area", "articles", "bar", "block", "body", "box", "boxes", "button", "buttons", "col", "column", "container",
            "content", "form", "group", "heading", "holder", "icons", "inner", "item", "items", "label", "link", "links", "list",
            "message", "outer", "panel", "posts", "region", "row", "section", "slot", "stories", "text", "thread", "title",
            "top", "bottom", "left", "right", "unit", "wrap", "wrapper", "zone"}
#: Inside an article a class word drops none of these.
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "span", "em", "strong", "b", "i", "a", "code", "td", "th",
          "li", "dt", "dd", "figure", "figcaption", "math"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A word after one of these says what is not there, or is beside the element.
_ABOUT = {"has", "no", "with", "without"}
#: Ancestors that a block gives points to.
_LEVELS = 5
_KEEP_TAGS = {"html", "body", "article", "main"}
_CONTENT = {"article": 25.0, "main": 25.0, "body": 0.0}
_LISTS = {"ul", "ol", "dl", "table", "div", "section"}
#: A container that class words dropped comes back, if the best other has fewer points than this and a fifth of its own.
_LITTLE = 10.0


class Node:
    __slots__ = ("tag", "parent", "kids", "drop", "size", "links", "score", "inside", "soft")

    def __init__(self, tag: str, parent: Node | None, drop: bool):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.kids: list[Node | str] = []
        self.size = self.links = 0
        self.score = 0.0
        self.soft = False
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))


def _names(value: str, inside: bool) -> bool:
    """Whether the head word of a class or id is one of what is dropped."""
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name) if not w.isdigit()]
        while len(words) > 1 and words[-1] in _HOLDERS:
            words.pop()
        if not words or len(words) > 1 and words[-2] in _ABOUT:
            continue
        head = words[-1]
        if inside and head in _OWN_WORDS:
            continue
        if head in _DROP_WORDS or not inside and head in _OUTSIDE_WORDS:
            return True
    return False


def _dropped(tag: str, attrs: str, inside: bool) -> bool | None:
    """Whether an element is not part of any article; None if only a word of its class or id says so."""
    if tag in _DROP_TAGS or tag == "header" and not inside:
        return True
    out: bool | None = None if tag == "form" else False
    if not attrs or tag in _KEEP_TAGS:
        return out
    for m in _ATTR.finditer(attrs):
        name = (m[1] or m[5]).lower()
        value = m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.strip().lower() in _DROP_ROLES:
            return True
        if name in ("class", "id") and not (inside and tag in _PROSE) and _names(value, inside):
            out = None
    return out


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends a tag, outside of quoted values; -1 without one."""
    while m := _VALUE_OR_END.search(page, at):
        if not m[1]:
            return m.start()
        at = page.find(m[1], m.end()) + 1
        if not at:
            break
    return -1


def parse(page: str) -> tuple[Node, list[Node]]:
    """The tree of a page and its elements that only a word drops; other text that is dropped is left out of it."""
    root = Node("#root", None, False)
    open_, soft, whole = [root], [], True
    count: Counter[str] = Counter()
    at, raw_until = 0, None
    n, last = len(page), page.rfind(">")
    while at < n:
        if raw_until is not None:
            m = raw_until.search(page, at)
            raw_until = None
            if m is None:
                break
            at = m.end()
            continue
        m = _TAG.search(page, at) if at <= last or page.find("<!--", at) >= 0 else None
        text = page[at:m.start()] if m else page[at:]
        if text and not open_[-1].drop:
            open_[-1].kids.append(text)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3]
        if m[1]:
            if count[tag]:
                _close(open_, tag, count)
            continue
        if whole and "=" in attrs and _OPEN_QUOTE.search(_QUOTED.sub("", attrs)):
            end = _tag_end(page, m.end(2))
            whole = end >= 0  # a page that ends inside a tag is read without quotes from there on
            if whole:
                attrs, at = page[m.end(2):end], end + 1
        if tag in _BLOCK and count["p"]:
            _end(open_, {"p"}, _WALL, count)
        if tag in _ENDS and any(count[t] for t in _ENDS[tag][0]):
            _end(open_, *_ENDS[tag], count)
        top = open_[-1]
        drop = top.drop or tag == "label" and count["form"] > 0 or \
            _dropped(tag, attrs, top.inside or top.tag in ("article", "main"))
        node = Node(tag, top, bool(drop))
        if not node.drop:
            top.kids.append(node)
        if drop is None:
            node.soft = True
            soft.append(node)
        if tag in _RAW:
            raw_until = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I)
        elif tag not in _VOID and (tag in _BLOCK or not attrs.endswith("/")):  # a slash does not close a block
            open_.append(node)
            count[tag] += 1
    return root, soft


def _cut(open_: list[Node], at: int, count: Counter[str]) -> None:
    for node in open_[at:]:
        count[node.tag] -= 1
    del open_[at:]


def _end(open_: list[Node], ends: set[str], wall: set[str], count: Counter[str]) -> None:
    """Ends the innermost element of the given names, if no wall stands before it."""
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag in ends:
            return _cut(open_, i, count)
        if open_[i].tag in wall:
            return None


def _close(open_: list[Node], tag: str, count: Counter[str]) -> None:
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag == tag:
            return _cut(open_, i, count)
        if open_[i].tag in _WALL and tag not in _BLOCK:
            return None


def _measure(root: Node) -> list[Node]:
    """Text and link sizes of all elements, children first; points for the ancestors of each block."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.score = 0.0
        order.append(node)
        stack.extend(k for k in node.kids if type(k) is Node)
    order.reverse()
    commas = {}
    for node in order:
        size, links, own, c = 0, 0, 0, 0
        for k in node.kids:
            if type(k) is str:
                length = len(k.strip())
                size += length
                own += length
                c += k.count(",") + k.count("，") + k.count("、")
            else:
                size += k.size
                links += k.links
                if k.tag not in _BLOCK:
                    own += k.size
                    c += commas[id(k)]
        node.size, node.links = size, size if node.tag == "a" else links
        commas[id(node)] = c
        if own and (node.tag in _BLOCK or node is root):
            points = (1 + c + min(own / 100, 3)) * (1 - node.links / size)
            up, share = (node if node.tag in ("body", "article", "main", "#root", "div", "section") else node.parent), 1
            while up is not None and share <= _LEVELS:
                up.score += points / share
                up, share = up.parent, share + 1
    return order


def _density(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def _best(root: Node) -> tuple[Node, float]:
    """The best container and its points."""
    order = _measure(root)
    best, most = root, -1.0
    for node in reversed(order):
        if node.tag in _BLOCK and node.tag not in ("p", "li", "html") or node is root:
            score = (node.score + _CONTENT.get(node.tag, 0.0)) * (1 - _density(node)) if node.size else 0.0
            if score > most and (node is not root or not node.kids):
                best, most = node, score
    return best, most


def _prune(soft: list[Node]) -> None:
    for top in {id(n.parent): n.parent for n in soft if n.soft}.values():
        top.kids = [k for k in top.kids if type(k) is str or not k.soft]


def _chosen(root: Node, soft: list[Node]) -> Node:
    """What belongs to the article, in page order."""
    before = [(n.parent, n.parent.kids) for n in soft]
    _prune(soft)
    best, most = _best(root)
    for top, kids in before:
        top.kids = kids
    if soft:
        held, points = _best(root)
        if most < min(_LITTLE, points / 5):
            while held is not None:
                held.soft, held = False, held.parent
        _prune(soft)
        best, most = _best(root)
    up = best
    while up is not None:  # all of the outermost article
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    top = best.parent
    if best is root or top is None:
        return root
    if top.tag not in ("body", "html", "#root") and 2 * (top.size - top.links) >= root.size - root.links:
        return top
    stays = [_stays(k, best, most, top.kids, i) for i, k in enumerate(top.kids)]
    first, last = stays.index(True), len(stays) - 1 - stays[::-1].index(True)  # the best container is one
    out = Node("div", None, False)
    for i, k in enumerate(top.kids):
        between = first < i < last and (type(k) is str or _density(k) <= 0.6)
        if stays[i] or between:
            out.kids.append(k)
            if type(k) is Node and k.tag == "ol":
                k.inside = True
    return out


def _stays(k: Node | str, best: Node, most: float, kids: list, i: int) -> bool:
    """Whether an element beside the best container belongs to the article."""
    if type(k) is str or k is best:
        return True
    if k.tag in ("article", "div", "section", "main"):
        if k.size and k.score * (1 - _density(k)) >= max(_LITTLE, most / 5):
            return True
        own = [x.tag for x in k.kids if type(x) is Node and x.size]
        return best in kids[:i] and bool(own) and own[0] in _HEADINGS and "p" in own and _density(k) <= 0.2
    if k.tag == "ol" and _density(k) > 0.6:
        before = [x for x in kids[:i] if type(x) is Node and x.size or type(x) is str and x.strip()]
        return bool(before) and type(before[-1]) is Node and before[-1].tag in _HEADINGS and best in kids[:i]
    return _density(k) <= 0.6


def _blocks(node: Node, out: list[list[str]], top: bool = True) -> None:
    """Appends the texts of the blocks below ``node``; the last list is the block in the making."""
    stack: list = [(node, iter(node.kids))]
    out.append([])
    while stack:
        node, kids = stack[-1]
        for k in kids:
            if type(k) is str:
                out[-1].append(k)
                continue
            if k.tag == "br":
                out[-1].append(" ")
                continue
            if k.tag in _LISTS and k.size and not k.inside and _density(k) > 0.6:
                continue
            if k.tag in _BLOCK:
                out.append([])
            stack.append((k, iter(k.kids)))
            break
        else:
            stack.pop()
            if node.tag in _BLOCK:
                out.append([])


def extract(page: str) -> str:
    """Main text of a page."""
    out: list[list[str]] = []
    _blocks(_chosen(*parse(page)), out)
    texts = (" ".join(entities.unescape("".join(b)).split()) for b in out if b)
    return "\n\n".join(t for t in texts if t)


def extract_pages(df: DataFrame, html: str = "html", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(id, url, text, n_chars): one row for each row of ``df``."""
    def run(rows: pa.RecordBatch, pages: pa.Array) -> pa.RecordBatch:
        texts = [extract(p) for p in pages.to_pylist()]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [id_col, url, "text", "n_chars"])

    kinds = dict(df.dtypes)
    return text_pass(df.select(id_col, url, html), run,
                     f"`{id_col}` {kinds[id_col]}, `{url}` {kinds[url]}, text string, n_chars long", html)
