"""HTML as a tree: reading it without ever failing, and telling the article from what surrounds it.

A node is a ``Node`` or, for text, a ``str``.  Broken markup is read as it comes: missing end tags are implied, unknown
ones ignored, cut-off pages end where they end.
"""

import html
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag ends these open elements, if they are inside no element of the second group.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Never part of the main text.
DROPPED = frozenset(
    "head script style title noscript template nav footer aside form button select option input textarea label fieldset "
    "legend datalist iframe object embed applet canvas svg math audio video map dialog menu menuitem search noembed "
    "noframes frameset xmp plaintext".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split()
)
#: Words of a class or id that name what surrounds an article.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsored promo "
    "promos promotion promoted nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars "
    "aside footer foot masthead topbar header cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations teaser comment comments "
    "commentlist replies respond disqus feedback widget widgets toolbar skip copyright disclaimer legal".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist replies respond disqus related recommended teaser".split())
#: Words of a class or id that name the article where no element does.
ARTICLE_NAMES = frozenset("article content post entry story maintext body main".split())

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*){_ATTRIBUTES}>?|<([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("attributes", "children", "parent", "tag")

    def __init__(self, tag: str, attributes: str, parent: "Node | None"):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []

    def named(self) -> dict[str, str]:
        if not self.attributes:
            return {}
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(self.attributes)}


def _close(node: Node, tags: set[str] | frozenset[str], inside: set[str] | frozenset[str]) -> Node:
    """The parent of the nearest open element with one of the tags, or ``node`` if there is none."""
    at: Node | None = node
    found = None
    while at is not None and at.tag not in inside:
        if at.tag in tags:
            found = at
        at = at.parent
    return found.parent if found is not None else node


def parse(source: str) -> Node:
    root = Node("", "", None)
    node, at = root, 0
    while at < len(source):
        found = _TOKEN.search(source, at)
        end = found.start() if found else len(source)
        if end > at:
            node.children.append(html.unescape(source[at:end]))
        if not found:
            break
        at = found.end()
        if found[1]:
            tag = found[1].lower()
            if tag == "p" or tag == "br":
                opened = node
                while opened is not None and opened.tag != tag:
                    opened = opened.parent
                if opened is None:
                    node.children.append(Node(tag, "", node))
                    continue
            opened = node
            while opened is not None and opened.tag != tag:
                opened = opened.parent
            if opened is not None and opened.parent is not None:
                node = opened.parent
        elif found[2]:
            tag = found[2].lower()
            if tag in CLOSES:
                node = _close(node, *CLOSES[tag])
            if tag in BLOCK:
                node = _close(node, {"p"}, {"button", "table", "td", "th", "object"})
            new = Node(tag, found[3] or "", node)
            node.children.append(new)
            if tag in RAW:
                closing = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = closing.start() if closing else len(source)
                new.children.append(source[found.end() : at])
                if closing:
                    at = (source.find(">", at) + 1) or len(source)
            elif tag not in VOID and not (found[3] or "").endswith("/"):
                node = new
    return root


def is_surrounding(node: Node) -> bool:
    """Whether an element is a menu, an advert, a form or the like by its tag, role, name or invisibility."""
    if node.tag in DROPPED:
        return True
    if not node.attributes or node.tag in ("html", "body", "main"):
        return False
    named = node.named()
    if "hidden" in named or named.get("aria-hidden") == "true" or _HIDDEN.search(named.get("style", "")):
        return True
    if named.get("role", "").lower() in DROPPED_ROLES:
        return True
    words = {word.lower() for key in ("class", "id") for word in _NAME.findall(named.get(key, ""))}
    return bool(words & DROPPED_NAMES)


def _walk(top: Node, skip) -> list[tuple[Node | str, bool]]:
    """Nodes in page order, each element also when it ends (True); skipped elements are left out."""
    order: list[tuple[Node | str, bool]] = []
    todo: list[tuple[Node | str, bool]] = [(top, False)]
    while todo:
        item, ends = todo.pop()
        if isinstance(item, str) or ends:
            order.append((item, ends))
            continue
        if item is not top and skip(item):
            continue
        order.append((item, False))
        todo.append((item, True))
        todo += [(child, False) for child in reversed(item.children)]
    return order


def blocks_of(top: Node, skip) -> list[str]:
    """Texts of the blocks below ``top``, white space turned into single spaces, without empty ones."""
    blocks: list[str] = []
    open_block: list[str] = []

    def settle() -> None:
        text = " ".join("".join(open_block).split())
        if text:
            blocks.append(text)
        open_block.clear()

    for item, _ in _walk(top, skip):
        if isinstance(item, str):
            open_block.append(item)
        elif item.tag in BLOCK:
            settle()
        elif item.tag in ("br", "wbr", "img"):
            open_block.append(" " if item.tag == "br" else "")
    settle()
    return blocks


def _length(top: Node, skip) -> int:
    return sum(len(item) for item, _ in _walk(top, skip) if isinstance(item, str))


def main_node(root: Node) -> Node:
    """The element that holds the article: ``article``, else ``main``, else one so named, else the page.

    Of several, the one with the most text; an ``article`` inside another one is part of it.  Elements inside menus,
    asides and the like do not count.  Names alone can mislead, as a page's ``with-sidebar`` does: what lies inside an
    element that only its name marks counts if there is nothing else.
    """
    best: dict[tuple[bool, int], tuple[int, Node]] = {}
    todo = [(root, True, False)]
    while todo:
        node, clear, within = todo.pop()
        if node.tag in DROPPED or node.tag == "header":
            continue
        clear = clear and (node is root or not is_surrounding(node))
        named = node.named() if node.attributes else {}
        words = {w.lower() for key in ("class", "id") for w in _NAME.findall(named.get(key, ""))} if named else set()
        if words & COMMENT_NAMES:
            continue
        rank = 0
        if node.tag == "article" or named.get("role") == "article":
            rank = 3
        elif node.tag == "main" or named.get("role") == "main":
            rank = 2
        elif node.tag in ("div", "section", "td") and not within:
            rank = int(bool(words & ARTICLE_NAMES))
        if rank:
            size = _length(node, is_surrounding)
            if size > best.get((clear, rank), (0, None))[0]:
                best[clear, rank] = size, node
        if rank < 3:
            todo += [(child, clear, within or rank == 1) for child in reversed(node.children) if isinstance(child, Node)]
    for key in ((True, 3), (True, 2), (False, 3), (False, 2), (True, 1), (False, 1)):
        if key in best:
            return best[key][1]
    return root


def article_blocks(root: Node, template: set[int]) -> list[str]:
    """Blocks of the article.  ``template`` has the ids of nodes that the host's pages share.

    Of a header inside the article only its headings count.  If the template would take more than half of the article,
    it has taken the article itself for boilerplate, and is not used.
    """
    top = main_node(root)

    def surrounding(node: Node) -> bool:
        if is_surrounding(node):
            return True
        if node.tag == "header" and node.parent is not None:
            return not any(isinstance(c, Node) and c.tag in HEADINGS for c in node.children)
        inside = node.parent
        return inside is not None and inside.tag == "header" and node.tag not in HEADINGS

    blocks = blocks_of(top, surrounding)
    if not template:
        return blocks
    rest = blocks_of(top, lambda node: id(node) in template or surrounding(node))
    return rest if 2 * sum(map(len, rest)) >= sum(map(len, blocks)) else blocks
