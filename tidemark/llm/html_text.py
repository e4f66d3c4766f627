"""Main text of web pages by scoring the tree of tags.

Blocks of text pass points for their length and commas to the containers around them,
half as many at each level up; a container's points are discounted by the share of its
text that is links. The best container and its siblings except menus
are kept, and the whole article when the best container is a part of one. Menus, headers,
footers, sidebars, notices, adverts, forms, comments and scripts never count.

Defined cases: null, empty or tag-only html gives an empty text and 0 characters; html
without tags is one block; unclosed and stray tags are tolerated; repeated pages are
extracted each; of containers with equal scores the first on the page is the best; a page of any
length is read whole. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import arrow_schema, batches, with_workers

# Kinds of tags and names that mark what surrounds an article.
RAW = frozenset("script style noscript template textarea iframe noframes xmp title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody "
    "tfoot tr td th blockquote pre figure figcaption address header footer nav aside form fieldset "
    "details summary hr center dialog menu search hgroup".split())
DROPPED = frozenset(
    "script style noscript template textarea iframe noframes xmp title head nav footer aside form button "
    "select option object embed svg canvas menu dialog input label audio video map search".split())
TEXT_BLOCKS = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption".split())
CLOSES = {  # a start tag ends these open ones, up to the given bounds
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
AROUND = re.compile(
    r"ads?|adverts?|advertis\w*|adsense|adbox|banner|breadcrumbs?|comments?|commentlist|"
    r"respond|replies|disqus|cookies?|consent|gdpr|notices?|alert|disclaimer|footer|foot|header|masthead|"
    r"menus?|nav|navbar|navigation|newsletter|pager|pagination|popup|modal|overlay|promo\w*|related|"
    r"recommend\w*|shar(?:e|ing)|social|sidebar|sponsor\w*|subscribe|subscription|widgets?|toolbar|login|"
    r"signup|copyright|skip|hidden|print-only|tags", re.I)
#: Words that may stand beside these in a class without changing its meaning.
NEUTRAL = re.compile(
    r"\d*|site|page|post|posts|entry|article|main|top|bottom|left|right|box|bar|wrap|wrapper|container|"
    r"list|section|area|block|links?|buttons?|inner|outer|items?|primary|secondary|global|local|user|media|"
    r"meta|form|panel|col|column|row|group|message|print|only|icons?|js|module|region|slot|unit|area", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu "
                  "menubar toolbar status note".split())
NEVER_AROUND = frozenset(("html", "body", "main"))
#: Tags nested more deeply become siblings.
DEEPEST = 500
END_OF_SCOPE = frozenset(("table", "td", "th", "html", "body"))

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][\w:.-]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("name", "parent", "parts", "around", "named", "depth", "points", "length", "linked", "commas")

    def __init__(self, name: str, parent: Node | None, around: bool = False):
        self.name, self.parent, self.around = name, parent, around
        self.named = False  # around by a class or an id alone
        self.parts: list = []  # strings and nodes, in page order
        self.points = 0.0
        self.length = self.linked = self.commas = 0
        self.depth = parent.depth + 1 if parent else 0


def _surrounds(name: str, rest: str) -> bool:
    """Is it part of what surrounds an article, by its tag or attributes?"""
    if name in DROPPED:
        return True
    if not rest or rest.isspace() or name in NEVER_AROUND:
        return False
    given = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)}
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    if given.get("role", "").lower() in ROLES or HIDDEN_STYLE.search(given.get("style", "")):
        return True
    return False


def _named(name: str, rest: str) -> bool:
    """Does a whole class or id say that it surrounds an article?"""
    if not rest or rest.isspace() or name in NEVER_AROUND:
        return False
    given = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)}
    for token in entities.unescape(f"{given.get('class', '')} {given.get('id', '')}").split():
        words = re.split("[_-]", token)
        marks = [bool(AROUND.fullmatch(w)) for w in words]
        if any(marks) and all(m or NEUTRAL.fullmatch(w) for m, w in zip(marks, words)):
            return True
    return False


def parse(page: str) -> Node:
    """Tree of a page; every tag that is not closed ends with what holds it."""
    root = at = Node("#root", None)
    position = 0
    while found := TOKEN.search(page, position):
        if found.start() > position:
            at.parts.append(page[position:found.start()])
        position = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        name, rest = name.lower(), found["rest"] or found["rest2"] or ""
        if found["end"] or found["end2"]:
            node = at
            while node is not root and node.name != name:
                if node.name in END_OF_SCOPE and name not in BLOCKS:
                    node = root
                    break
                node = node.parent
            if node is not root:
                at = node.parent
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(page, position)
            position = end.end() if end else len(page)
            continue
        if name in VOID:
            at.parts.append(Node(name, at, name in DROPPED))
            continue
        if name in CLOSES:
            names, bounds = CLOSES[name]
            node, last = at, None
            while node is not root and node.name not in bounds:
                last = node if node.name in names else last
                node = node.parent
            at = last.parent if last else at
        elif name in BLOCKS:
            node = at
            while node is not root and (node.name == "p" or node.name not in BLOCKS):
                if node.name == "p":
                    at = node.parent
                    break
                node = node.parent
        child = Node(name, at, _surrounds(name, rest))
        if not child.around and _named(name, rest):
            child.around = child.named = True
        at.parts.append(child)
        if not rest.rstrip().endswith("/") and child.depth < DEEPEST:
            at = child
    at.parts.append(page[position:])
    return root


def _order(root: Node) -> list[Node]:
    """Nodes before their children, without recursion: pages may nest deeply."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return nodes


def _keep_most(nodes: list[Node]) -> None:
    """What holds most of the page's text does not surround it, whatever its class."""
    lengths = {id(n): 0 for n in nodes}
    for node in reversed(nodes):
        lengths[id(node)] += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        if node.parent and (node.named or not node.around):
            lengths[id(node.parent)] += lengths[id(node)]
    for node in nodes:
        if node.named and 2 * lengths[id(node)] > lengths[id(nodes[0])]:
            node.around = node.named = False


#: A form around so much of the paragraphs' text is no form of the page but the page itself.
FORM_SHARE = 0.8


def _open_forms(nodes: list[Node]) -> None:
    """Let forms that are wrapped around a page count as plain containers; their fields go."""
    forms = [n for n in nodes if n.name == "form" and not n.named]
    if not forms:
        return
    held: dict[int, int] = {}
    for node in nodes:
        if node.name == "p":
            size = sum(len(x) for n in _order(node) for x in n.parts if isinstance(x, str))
            holder: Node | None = node
            while holder is not None:
                held[id(holder)] = held.get(id(holder), 0) + size
                holder = holder.parent
    total = held.get(id(nodes[0]), 0)
    for form in forms:
        if total and held.get(id(form), 0) >= FORM_SHARE * total:
            form.name, form.around = "div", False


def _prune(root: Node) -> list[Node]:
    """Drop what surrounds the article; a wrapper that holds an article is not dropped."""
    nodes = _order(root)
    _open_forms(nodes)
    if not any(n.name in ("article", "main") and not n.around for n in nodes):
        _keep_most(nodes)
    holds: set[int] = set()
    for node in reversed(nodes):
        own = node.name in ("article", "main") and not node.around
        if (own or id(node) in holds) and node.parent:
            if node.name not in DROPPED and not (node.around and own):
                holds.add(id(node.parent))
    for node in nodes:
        inside = node.parent is not None and node.parent.name in ("article", "section", "main")
        if node.name == "header" and not (inside and not node.around):
            node.around = True
        if node.around and (node.name in DROPPED or id(node) not in holds):
            node.parent.parts = [p for p in node.parent.parts if p is not node]
    return _order(root)


def _measure(nodes: list[Node]) -> None:
    """Text lengths, link lengths and points, leaves first."""
    for node in reversed(nodes):
        own = sum(len(p) - p.count(" ") for p in node.parts if isinstance(p, str) and not p.isspace())
        node.length += own
        node.commas += sum(p.count(",") for p in node.parts if isinstance(p, str))
        node.linked = node.length if node.name == "a" else node.linked
        if node.parent:
            node.parent.length += node.length
            node.parent.linked += node.linked
            node.parent.commas += node.commas
    for node in nodes:
        direct = [p for p in node.parts if isinstance(p, str)]
        if node.name in TEXT_BLOCKS:
            commas, length = node.commas, node.length - node.linked
        elif node.name in BLOCKS or node.parent is None:
            commas = sum(p.count(",") for p in direct)
            length = sum(len(p.strip()) for p in direct)
        else:
            continue
        if length < 2:
            continue
        points, up, holder = 1 + commas + min(length / 100, 3), 1.0, node.parent
        if node.name not in TEXT_BLOCKS:
            node.points += points
        while holder is not None and up > 0.05:
            if holder.name in BLOCKS or holder.parent is None:
                holder.points += points * up
                up /= 2
            holder = holder.parent


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _menu(part: Node) -> bool:
    """A list of links without a heading, a paragraph or a table."""
    if part.name not in ("ul", "ol", "div", "section") or _density(part) <= 0.6:
        return False
    names = [n.name for n in _order(part)]
    return names.count("a") > 1 and not set(names) & set("p h1 h2 h3 h4 h5 h6 table".split())


def _blocks(kept: list, whole: tuple = ()) -> list[str]:
    """Text blocks of what is kept; menus count as such only in what is the whole page."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        if text := " ".join(entities.unescape("".join(run)).split()):
            out.append(text)
        run.clear()

    stack: list = list(reversed(kept))
    while stack:
        part = stack.pop()
        if part is None:
            end()
        elif isinstance(part, str):
            run.append(part)
        elif part.name == "br":
            run.append(" ")
        elif part.parent in whole and _menu(part):
            end()
        else:
            block = part.name in BLOCKS or part.parent is None
            if block:
                end()
                stack.append(None)
            stack.extend(reversed(part.parts))
    end()
    return out


def main_text(page: str | None) -> str:
    """Blocks of the main text, parted by an empty line."""
    if not page:
        return ""
    root = parse(page)
    nodes = _prune(root)
    _measure(nodes)
    holders = [n for n in nodes if n.points > 0 and (n.name in BLOCKS or n is root)]
    page_nodes = tuple(n for n in nodes if n is root or n.name in ("html", "body"))
    if not holders:
        return "\n\n".join(_blocks([root], page_nodes))
    best = max(holders, key=lambda n: n.points * (1 - _density(n)))
    whole = best
    node = best
    while node is not None:
        if node.name in ("article", "main"):
            whole = node
        node = node.parent
    if whole is not best or best.name in ("article", "main") or best.parent is None:
        return "\n\n".join(_blocks([whole], page_nodes))
    kept = [p for p in best.parent.parts if p is best or isinstance(p, str) or (p.length or p.name == "br") and not _menu(p)]
    return "\n\n".join(_blocks(kept, page_nodes))


def _extract(rows):
    schema = arrow_schema("page_id bigint, url string, text string, n_chars bigint")

    def out():
        for batch in rows:
            for page_id, url, page in zip(*batch.columns):
                text = main_text(page.as_py())
                yield page_id.as_py(), url.as_py(), text, len(text)

    yield from batches(out(), schema, 1024)


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    with_workers(spark)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint")
