"""The main text of HTML pages by tree scoring."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import ship

#: Elements without an end tag; with text that is no markup; that begin and end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: An element that these end tags or begin tags close by implication.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
SCOPES = frozenset("html body article section div main table ul ol dl form aside blockquote td th".split())
NEVER = frozenset(
    "script style noscript template svg math canvas iframe object embed audio video nav aside footer button select "
    "textarea input dialog menu head title search noembed noframes xmp".split()
)
CONTAINERS = frozenset("article body blockquote dd div html main section td".split())
WHOLE = frozenset("article main".split())
#: Characters of an entry of a menu, on average, at most.
MENU_ENTRY = 30
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar status note".split())
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""",
    re.S,
)
_BEGUN = re.compile(r"<[A-Za-z/!?]")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|alerts?|banners?|bread-?crumbs?|consent|cookies?|disclaimer|disqus|foot(?:er)?|gdpr|head(?:er)?|login|"
    r"discussion|masthead|menu\w*|modal|nav\w*|newsletter|notices?|notification|pager|pagination|popup|promo\w*|recommend\w*|related|"
    r"shar(?:e|ing)|side-?bar\w*|sign-?up|social|sponsor\w*|subscribe|subscription|toolbar|tool-?tip|widgets?)(?:$|[\s_-])",
    re.I,
)
#: Reader comments by a whole name; a theme's state, such as "has-comments" or "comments-open", is none.
_COMMENT = re.compile(
    r"(?:^|\s)(?:(?:all|post|reader|user|the)[_-])?(?:comments?|comment-?list|disqus\w*|replies|respond)"
    r"(?:[_-](?!open|closed?|off|on|enabled|disabled|link|count)[\w-]+)?(?:$|\s)",
    re.I,
)
_LIKELY = re.compile(r"(?:^|[\s_-])(?:article\w*|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.I)
_SPACE = re.compile(r"\s+")


class _Tree:
    """Elements by number, a parent before its children, and blocks of text in page order."""

    def __init__(self, page: str):
        self.tag, self.parent, self.dead, self.weight, self.doubtful = ["#"], [0], [False], [0.0], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._stack, self._pieces, self._owner, self._linked = [0], [], 0, 0
        self._opened: Counter[str] = Counter()  # open elements by name
        at, last = 0, page.rfind(">") + 1
        # A tag that the page breaks off in is none; nor is anything after it.
        if broken := _BEGUN.search(page, last):
            page = page[: broken.start()]
        while m := _TAG.search(page, at, last):
            self._text(page[at : m.start()])
            at = m.end()
            slash, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            name = name.lower()
            if slash:
                self._close(name)
                continue
            self._open(name, rest)
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}\\b", re.I).search(page, at)
                at = end.start() if end else len(page)
        self._text(page[at:])
        self._flush()

    def _text(self, text: str) -> None:
        if text and not self.dead[self._stack[-1]]:
            self._pieces.append(text)
            if self._opened["a"]:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._pieces:
            text = _SPACE.sub(" ", unescape("".join(self._pieces))).strip()
            if text:
                self.blocks.append((self._owner, text, min(self._linked, len(text))))
        self._pieces, self._linked = [], 0
        self._owner = next((n for n in reversed(self._stack) if self.tag[n] in BLOCKS), 0)

    def _open(self, name: str, rest: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name in BLOCKS:
            self._flush()
            if name != "option":
                self._imply({"p"})
        if name in CLOSES:
            self._imply(CLOSES[name])
        if name in VOID:
            return
        over = self._stack[-1]
        dead, weight, doubtful = self.dead[over], 0.0, False
        if not dead:
            dead, weight, doubtful = _judged(name, rest, name == "header" and not self._within(WHOLE))
        self.tag.append(name)
        self.parent.append(over)
        self.dead.append(dead)
        self.weight.append(weight)
        self.doubtful.append(doubtful)
        self._stack.append(len(self.tag) - 1)
        self._opened[name] += 1
        if name in BLOCKS:
            self._flush()

    def _within(self, names: frozenset) -> bool:
        return any(self.tag[n] in names for n in self._stack)

    def _imply(self, names: set) -> None:
        """Close an open element of the names, if no other scope lies between."""
        if not any(self._opened[n] for n in names):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[i]]
            if tag in names:
                self._cut(i)
                return
            if tag in SCOPES:
                return

    def _close(self, name: str) -> None:
        if not self._opened[name]:
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[i]] == name:
                self._cut(i)
                return

    def _cut(self, i: int) -> None:
        gone = self._stack[i:]
        if any(self.tag[n] in BLOCKS for n in gone):
            self._flush()
        self._opened.subtract(self.tag[n] for n in gone)
        del self._stack[i:]
        if any(self.tag[n] in BLOCKS for n in gone):
            self._flush()


def _judged(name: str, rest: str, outer_header: bool) -> tuple[bool, float, bool]:
    """Whether an element can't be part of an article, the weight of its names, and whether they are doubtful.

    Names that menus, notices and the like have may also tell the state of a
    page, on an element around all of it.
    """
    if name in NEVER or outer_header:
        return True, 0.0, False
    doubtful = name == "form"
    if not rest or rest == "/" or name in ("html", "body"):
        return False, 0.0, doubtful
    has = {k.lower(): v.strip("\"'") for k, v in _NAMED.findall(rest)}
    if not has:
        return False, 0.0, doubtful
    names = f"{has.get('class', '')} {has.get('id', '')}"
    gone = (
        has.get("role", "").lower() in ROLES
        or "hidden" in has
        or has.get("aria-hidden", "").lower() == "true"
        or re.search(r"display\s*:\s*none", has.get("style", ""), re.I)
        or _COMMENT.search(names)
    )
    likely = bool(_LIKELY.search(names))
    doubtful = doubtful or bool(name not in WHOLE and not likely and _UNLIKELY.search(names))
    return bool(gone), 25.0 if likely else 0.0, doubtful


def _in_doubt(tree: _Tree) -> list[bool]:
    """Elements of doubtful names, and all in them, but for one that holds most of the page's text, and not in links."""
    n = len(tree.tag)
    length, linked = [0] * n, [0] * n
    for node, text, in_links in tree.blocks:
        length[node] += len(text)
        linked[node] += in_links
    for i in range(n - 1, 0, -1):
        length[tree.parent[i]] += length[i]
        linked[tree.parent[i]] += linked[i]
    gone = [False] * n
    for i in range(1, n):
        most = 2 * length[i] > length[0] and 2 * linked[i] <= length[i]
        gone[i] = gone[tree.parent[i]] or (tree.doubtful[i] and not most)
    return gone


def main_blocks(page: str | None) -> list[str]:
    """The blocks of the article, in page order; none for a null or empty page.

    Each block gives one point, one for each comma and up to three for its
    length to the element that holds it, half to the one above, then a sixth,
    and so on. An element's points are discounted by the share of its text that
    lies in links. The best element is taken, or the best one marked as an article
    if it has a fifth of its score; raised to the article around it, it is kept.
    One not marked is kept with all that stands beside it or beside an element
    around it, paragraphs, text and elements of any length, but what has more than half of its text in links;
    elements with the names of menus, notices and the like are gone before,
    unless one holds more than half of the page's text, and forms likewise. Of
    several articles beside each other the best one is taken, with what is in it.
    """
    tree = _Tree(page or "")
    n = len(tree.tag)
    if any(tree.doubtful):
        gone = _in_doubt(tree)
        tree.blocks = [b for b in tree.blocks if not gone[b[0]]]
    points, length, linked, links_only = [0.0] * n, [0] * n, [0] * n, [0] * n
    for node, text, in_links in tree.blocks:
        length[node] += len(text)
        linked[node] += in_links
        links_only[node] += in_links >= 0.8 * len(text)
        holder = node if tree.tag[node] in CONTAINERS else tree.parent[node]
        own = 1 + text.count(",") + min(len(text) // 100, 3)
        if tree.tag[node] in ("h1", "h2", "h3", "h4", "h5", "h6"):
            own = 0.5
        for level in range(4):
            points[holder] += own if not level else own / (2 if level == 1 else level * 3)
            if not holder:
                break
            holder = tree.parent[holder]
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        length[up] += length[i]
        linked[up] += linked[i]
        links_only[up] += links_only[i]
    score = [
        0.0 if not length[i] else (points[i] + (tree.weight[i] if points[i] else 0) + (25 if tree.tag[i] in WHOLE else 0))
        * (1 - linked[i] / length[i])
        for i in range(n)
    ]
    if not tree.blocks:
        return []
    best = max(range(n), key=lambda i: (score[i], -i))
    whole = max((i for i in range(n) if tree.tag[i] in WHOLE), key=lambda i: (score[i], -i), default=best)
    best = at = whole if score[whole] >= score[best] / 5 else best
    while at:
        if tree.tag[at] in WHOLE:
            best = at
        at = tree.parent[at]
    over, at = set(), best  # the elements around one that is not marked as an article
    while at and tree.tag[best] not in WHOLE:
        at = tree.parent[at]
        over.add(at)
    kept = [False] * n
    for i in range(n):
        beside = i > 0 and i != best and i not in over and tree.parent[i] in over
        near = beside and (2 * linked[i] <= length[i] or tree.tag[i] in ("h1", "h2"))
        # A list of nothing but short links is a menu, also within an article; long ones are its sources.
        menu = tree.tag[i] in ("ul", "ol", "div") and links_only[i] >= 3 and linked[i] > 0.8 * length[i]
        menu = menu and length[i] < MENU_ENTRY * links_only[i]
        kept[i] = not menu and (i == best or near or (i > 0 and kept[tree.parent[i]]))
    return [t for node, t, links in tree.blocks if kept[node] or (node in over and 2 * links <= len(t))]


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row ``id_col, blocks array<string>`` per row of ``pages``.

    Character references are decoded, white space within a block is one space,
    blocks are in page order. Null and empty pages have no blocks, nor do pages
    without any text of an article. Null and repeated ids and rows keep their
    row; other columns are not looked at.
    """
    return pages.select(id_col, blocks(pages, html_col).alias("blocks"))


def blocks(pages: DataFrame, html_col: str = "html"):
    """The blocks of a column of pages."""
    ship(pages.sparkSession)

    @F.arrow_udf("array<string>")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([main_blocks(p.as_py()) for p in column], pa.list_(pa.string()))

    return of(F.col(html_col))
