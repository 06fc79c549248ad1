"""Main text of HTML pages by tree scoring.

A forgiving parser builds the element tree of a whole page.  Boilerplate subtrees (menus, hidden parts
and so on, by element or role) go.  Forms and blocks with boilerplate words in class or id are only
marked: they go unless they hold the article or most of the page's prose.  Each remaining paragraph earns
points for its length and commas and passes them to its ancestors, less with each level; a container
is discounted by the share of its text that stands in links.  The best container is widened to the
article around it or else to the ancestor over which prose is spread, without its linked parts and loose notices;
lists of mere links go in either.  Every step takes time in proportion to the page.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title meta link nav aside button select option textarea input "
    "fieldset legend iframe noembed noframes object embed applet canvas svg math audio video map dialog menu datalist footer".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of their kind, up to the containers that shield it.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())), "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "tbody": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
_P_SHIELD = frozenset("button table td th caption object html body div article section li blockquote main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BAD_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promos promotion "
    "sidebar sidebars rail menu menus nav navbar navigation navi breadcrumb breadcrumbs pagination pager footer foot "
    "masthead topbar toolbar header comment comments commentlist disqus respond reply replies discussion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations outbrain taboola widget widgets toc hidden skip copyright legal disclaimer "
    "form search feedback responses guestbook shoutbox".split()
)
#: Marked for these words, an element stays only where the page has no other prose.
_STRICT = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner banners sponsored promo promos comment comments commentlist "
    "disqus respond reply replies cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login outbrain taboola "
    "feedback responses guestbook shoutbox".split()
)
#: Words that beside another one may as well name a part of an article.
_TITLE_WORDS = frozenset(
    "header related notice notices legal copyright disclaimer alert form search discussion social recommended recommendations promotion".split()
)
_LAYOUT = frozenset("layout wrap wrapper content container page main site".split())
SOFT, STRICT, TITLE = 1, 2, 3  # marks
LOW_LINK = 0.25
HIGH_LINK = 0.8  # a list or block of at least two links with this share in links is no part of an article
LOOSE = 120  # code points of bare text beside the best container, without a paragraph or the like, that go
NOTE = 300  # code points up to which a text with one of these phrases is a notice
_NOTE = re.compile(
    r"all rights reserved|\bcopyright\b|©|\bsite ?map\b|terms (?:of|and|&)|privacy policy|cookie policy|subscribe|sign (?:up|in)\b|log ?in\b"
    r"|follow us|share this|click here|advertisement|sponsored|powered by|back to top|contact us|\bcall\b[^.]*\d{3}|\d{3}[-. ]\d{4}\b", re.I,
)
_TEXTUAL = frozenset("p pre blockquote li td th dd dt figcaption caption h1 h2 h3 h4 h5 h6".split())
_MODIFIERS = ("has", "with", "no", "without", "is")
_SAFE = frozenset("html body article main".split())
_COMMAS = re.compile("[,،、，﹐﹑､]")


class _Node:
    __slots__ = ("tag", "bad", "mark", "parent", "children", "points", "text", "linked")

    def __init__(self, tag: str, bad: bool, mark: int, parent: "_Node | None"):
        self.tag, self.bad, self.mark, self.parent = tag, bad, mark, parent
        self.children: list[_Node | str] = []
        self.points = 0.0
        self.text = self.linked = 0  # code points in the subtree, and those in links


def _is_boilerplate(tag: str, attributes: str, in_article: bool, in_form: bool) -> bool:
    if tag in DROPPED or (tag == "label" and in_form):
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes or tag in _SAFE:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.strip().lower() in BAD_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _mark(tag: str, attributes: str, in_article: bool) -> int:
    """SOFT, STRICT or TITLE for a form or a block with boilerplate words in class or id, else 0."""
    mark = SOFT if tag == "form" else 0
    if not attributes or tag in _SAFE or tag in HEADINGS or tag not in BLOCKS:
        return mark
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() not in ("class", "id"):
            continue
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        for one in unescape(value).split():
            words = [w.lower() for w in _WORD.findall(one)]
            bad = BAD_WORDS.intersection(words)
            if not bad or words[0] in _MODIFIERS:
                continue
            if not _STRICT.isdisjoint(bad) and all(w in BAD_WORDS or w.isdigit() for w in words):
                return STRICT
            if not _STRICT.isdisjoint(bad):
                # "comment-list" is strict too; a wrapper named after its layout is not.
                mark = SOFT if not _LAYOUT.isdisjoint(words) and mark != STRICT else STRICT
            elif mark in (0, TITLE):
                other = any(w not in BAD_WORDS and not w.isdigit() for w in words)
                mark = TITLE if in_article and other and bad <= _TITLE_WORDS else SOFT
    return mark


class _Open:
    """The open elements, with the depths at which each tag, blocks and shields of paragraphs stand, so that
    no look upwards costs more than a search among depths."""

    def __init__(self, root: _Node):
        self.stack = [root]
        self.tags: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.shields: list[int] = []

    @property
    def node(self) -> _Node:
        return self.stack[-1]

    def last(self, tag: str) -> int:
        depths = self.tags.get(tag)
        return depths[-1] if depths else 0

    def push(self, node: _Node) -> None:
        depth = len(self.stack)
        self.stack.append(node)
        self.tags.setdefault(node.tag, []).append(depth)
        if node.tag in BLOCKS:
            self.blocks.append(depth)
        if node.tag in _P_SHIELD:
            self.shields.append(depth)

    def cut(self, depth: int) -> None:
        """Close the element at ``depth`` and all in it."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            self.tags[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()
            if node.tag in _P_SHIELD:
                self.shields.pop()

    def implied_end(self, tag: str) -> int:
        """Depth of the element that a start tag ends, 0 for none."""
        closed, shield = IMPLIED.get(tag, (frozenset(), frozenset()))
        if not closed:
            p = self.last("p")
            return p if p > (self.shields[-1] if self.shields else 0) else 0
        floor = max((self.last(t) for t in shield), default=0)
        found = [d[at] for t in closed if (d := self.tags.get(t)) and (at := bisect_right(d, floor)) < len(d)]
        return min(found, default=0)


def parse(html: str) -> _Node:
    """The element tree; unclosed and misnested elements end where their parent does."""
    root = _Node("#root", False, 0, None)
    open_, at = _Open(root), 0
    while m := _TOKEN.match(html, at):
        at = m.end()
        if m[4] is not None:
            open_.node.children.append(unescape(m[4]))
            continue
        if m[2] is None:  # comment, declaration
            continue
        tag = m[2].lower()
        if m[1]:
            depth = open_.last(tag)
            if depth and (tag in BLOCKS or depth > (open_.blocks[-1] if open_.blocks else 0)):  # an inline end tag closes no block
                open_.cut(depth)
            elif tag == "br":
                open_.node.children.append(" ")
            continue
        if tag in ("br", "wbr"):
            open_.node.children.append(" " if tag == "br" else "")
            continue
        if tag in BLOCKS and (depth := open_.implied_end(tag)):
            open_.cut(depth)
        in_article = bool(open_.last("article") or open_.last("main"))
        child = _Node(tag, _is_boilerplate(tag, m[3], in_article, bool(open_.last("form"))), _mark(tag, m[3], in_article), open_.node)
        open_.node.children.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if not m[3].rstrip().endswith("/") or tag in BLOCKS or tag not in ("path", "use"):
            open_.push(child)
    return root


def _blocks(top: list, keep_marked: bool = False) -> list[tuple[_Node, str, int]]:
    """Blocks of text in page order: (element that holds the text, text, code points in links)."""
    out: list[tuple[_Node, str, int]] = []
    held: list[str] = []
    linked = 0
    owner: _Node | None = None
    stack: list = [(n, False, None) for n in reversed(top)]

    def close() -> None:
        nonlocal linked, owner
        text = " ".join("".join(held).split())
        if text and owner is not None:
            out.append((owner, text, min(linked, len(text))))
        held.clear()
        linked, owner = 0, None

    while stack:
        item, in_link, parent = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            if owner is None and not item.isspace():
                owner = parent
            held.append(item)
            if in_link:
                linked += len(item.strip())
        elif not item.bad and (keep_marked or not item.mark):
            block = item.tag in BLOCKS
            if block:
                close()
                stack.append((None, False, None))
            home = item if block or parent is None else parent
            link = in_link or item.tag == "a"
            stack.extend((c, link, home) for c in reversed(item.children))
        elif item.tag in BLOCKS:
            close()
    close()
    return out


def _points(text: str, linked: int) -> float:
    size = len(text)
    points = 1 + len(_COMMAS.findall(text)) + min(size / 100, 3.0) if size >= 25 else 0.0
    return points * (1 - linked / size)


def _link_share(blocks: list[tuple[_Node, str, int]]) -> float:
    """Share of the blocks' text that stands in links; 1 if there is none."""
    size = sum(len(t) for _, t, _ in blocks)
    return sum(k for _, _, k in blocks) / size if size else 1.0


def _lift_marks(root: _Node) -> None:
    """Take the mark off elements that hold the article or most of the prose outside of marks."""
    marked: list[_Node] = []  # outer ones first
    around: dict[_Node, _Node | None] = {}  # the marked element next around a marked one
    mains: set[_Node] = set()  # marked elements that hold a main element, up to a strict one
    nearest: dict[_Node, _Node | None] = {root: None}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.mark:
            marked.append(node)
            around[node] = nearest[node]
            nearest[node] = node
        if node.tag == "main" and nearest[node] is not None:
            mains.add(nearest[node])
        for c in reversed(node.children):
            if isinstance(c, _Node) and not c.bad:
                nearest[c] = nearest[node]
                stack.append(c)
    if not marked:
        return
    free, own = 0.0, dict.fromkeys(marked, 0.0)
    for home, text, linked in _blocks([root], True):
        if (m := nearest[home]) is None:
            free += _points(text, linked)
        else:
            own[m] += _points(text, linked)
    held = dict(own)
    for m in reversed(marked):  # inner ones first; what a strict element holds counts for none around it
        if m.mark != STRICT and (up := around[m]) is not None:
            held[up] += held[m]
            if m in mains:
                mains.add(up)
    dropped = set()
    for m in marked:
        if around[m] in dropped or m.mark == STRICT:
            dropped.add(m)
            continue
        keep = m in mains or held[m] > free
        if not keep and m.mark == TITLE:
            m.mark = 0
            inner = _blocks([m])
            m.mark = TITLE
            keep = _link_share(inner) < LOW_LINK and any(len(t) >= 25 or h.tag in HEADINGS for h, t, _ in inner)
        if keep:
            m.mark = 0
            free += own[m]
        else:
            dropped.add(m)


def _bottom_up(top: _Node) -> list[_Node]:
    """The elements of a tree, children before their parents, without boilerplate."""
    out, stack = [], [top]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in node.children if isinstance(c, _Node) and not c.bad and not c.mark)
    return out[::-1]


def _score(root: _Node, blocks: list[tuple[_Node, str, int]]) -> list[_Node]:
    """Pass the points of each block to its ancestors; returns the containers that got any, inner ones
    first.

    A container gets its own points whole, those one level below by half and from there on 2/3 of what a
    level less gets, so two sums a node, own and passed on, make one pass of the tree."""
    passed: dict[_Node, float] = {}
    for home, text, linked in blocks:
        up = home.parent if home.tag in ("p", "pre", "blockquote", "li", "td", "dd", *HEADINGS) and home.parent else home
        up.points += _points(text, linked)
        up.text += len(text)
        up.linked += linked
    found = []
    for node in _bottom_up(root):
        own, below = node.points, passed.get(node, 0.0)
        if not node.text or node is root:
            continue
        if (up := node.parent) is not None:
            passed[up] = passed.get(up, 0.0) + own / 2 + below / 1.5
            up.text += node.text
            up.linked += node.linked
        node.points = (own + below) * (1 - node.linked / max(node.text, 1))
        found.append(node)
    return found


def _prune(top: _Node) -> None:
    """Leave out, within the article, lists and blocks that are nothing but several links."""
    sums: dict[_Node, list[int]] = {}  # code points, those in links, links, other blocks in it
    for node in _bottom_up(top):
        size, linked, links, parts = sums.pop(node, [0, 0, 0, 0])
        size += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            linked, links = size, links + (size > 0)
        if node is top:
            break
        if node.tag in BLOCKS and node.tag not in HEADINGS and links >= 2 and linked >= HIGH_LINK * size and (parts == 0 or node.tag in ("ul", "ol", "dl")):
            node.bad = True
            continue
        up = sums.setdefault(node.parent, [0, 0, 0, 0])
        for k, v in enumerate((size, linked, links, int(node.tag in BLOCKS and node.tag not in ("li", "dt", "dd") and size > 0))):
            up[k] += v


def _unmark(root: _Node) -> None:
    stack = [root]
    while stack:
        node = stack.pop()
        node.mark = 0
        stack.extend(c for c in node.children if isinstance(c, _Node))


def _joined(node: _Node) -> str:
    return "\n\n".join(t for _, t, _ in _blocks([node]))


def _loose(node: _Node, own: list[tuple[_Node, str, int]]) -> bool:
    """Whether a part beside the best container is a line of its own: a notice by its words, or short bare
    text that stands in no paragraph, heading, list or table."""
    text = " ".join(t for _, t, _ in own)
    if len(text) <= NOTE and _NOTE.search(text):
        return True
    return node.tag in BLOCKS and node.tag not in _TEXTUAL and len(text) < LOOSE and all(h.tag not in _TEXTUAL for h, _, _ in own)


def _spread(best: _Node) -> _Node:
    """The nearest ancestor over which the prose of ``best`` goes on, at least its parent, without the
    linked and loose parts on the way."""
    path, top, started = best, best, False
    leave: list[tuple[int, _Node]] = []
    level = height = 0
    while path.tag not in ("body", "html") and path.parent is not None and path.parent.tag != "#root":
        prose, items = False, path.parent.children
        for k, s in enumerate(items):
            if isinstance(s, str) or s is path or s.bad or s.mark:
                continue
            own = _blocks([s])
            if not own:
                continue
            in_text = s.tag not in BLOCKS and any(isinstance(n, str) and not n.isspace() for n in (*items[max(k - 1, 0) : k], *items[k + 1 : k + 2]))
            if not in_text and (_link_share(own) >= LOW_LINK or _loose(s, own)):
                leave.append((level, s))
            elif _link_share(own) < LOW_LINK:
                prose = prose or any(_points(t, n) > 0 for _, t, n in own)
        bare = [s for s in items if isinstance(s, str) and len(s.strip()) >= 25]
        prose = prose or any(len(s.strip()) > NOTE or not _NOTE.search(s) for s in bare)
        if started and not prose:
            break
        path, level = path.parent, level + 1
        if prose or level == 1:
            top, height = path, level
        started = started or prose
    for at, s in leave:
        s.bad = s.bad or at < height
    # Bare notices between the parts on the way.
    up = best
    for _ in range(height):
        up = up.parent
        up.children = [c for c in up.children if not (isinstance(c, str) and len(c.strip()) <= NOTE and _NOTE.search(c))]
    return top


def main_text(html: str | None) -> str:
    """The article's blocks joined by a blank line; empty if there is none."""
    if not html:
        return ""
    root = parse(html)
    _lift_marks(root)
    blocks = _blocks([root])
    if not any(_points(t, k) > 0 for _, t, k in blocks):
        every = _blocks([root], True)
        if not blocks or any(_points(t, k) > 0 for _, t, k in every):
            _unmark(root)
            blocks = every
    if not blocks:
        return ""
    found = _score(root, blocks)
    best = max(found, key=lambda n: n.points, default=None)
    if best is None or best.points <= 0:
        keep = [n for n in found if n.tag in ("article", "main")][:1]
        return _joined(keep[0]) if keep else "\n\n".join(t for _, t, _ in blocks)
    up, around = best, None
    while up is not None:
        if up.tag == "article" or (up.tag == "main" and around is None):
            around = up
        up = up.parent
    top = around if around is not None else _spread(best)
    _prune(top)
    return _joined(top)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; null or empty html: empty text, 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
