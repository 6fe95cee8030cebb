"""HTML extraction by tag-path ratios: the main text of web pages.

A page's text nodes are grouped by their path of tags (with class words) from the root. For each path the mean
length of its nodes and the mean number of punctuation marks in them are taken, both are smoothed over the paths in
page order, and their fused product is held against a share of the page's greatest. Inline elements count
to the block that holds them. Elements that mark menus, headers, footers, sidebars, notices, adverts, forms, comments
or code by their tag, or by whole class, id or role words, never count; such words say nothing on an article or main
element, on what holds most article text, or, on a page without articles, on what holds most text. Where article and
main elements hold most of the chosen text, all of those with chosen text are content; else the chosen paths are, with
every short block of the element that most of them are in.

White space in a block becomes one space; blocks and line breaks are joined by one space. Defined results: null or
empty html, and pages without content, give an empty text. Broken markup is read as far as it goes: unclosed tags
stay open, stray end tags are skipped, an unclosed comment or script lasts to the end. Rows are read one by one,
so repeated rows each get their own. An empty table gives an empty result. Columns other than page_id, url and html
are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

#: Share of the greatest fused ratio of a page that a path needs.
SHARE = 0.05
#: Weights of a path's neighbours, itself and its neighbours again in page order.
SMOOTHING = (0.25, 0.5, 0.25)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br option".split()
)
#: Blocks that hold a piece of running text.
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote caption figcaption summary br ul ol dl".split())
_LISTS = frozenset("ul ol dl tr".split())
_CLOSES_P = _BLOCK - frozenset("br caption dd dt li option summary tbody td tfoot th thead tr".split())
_SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
_BOILERPLATE_TAGS = frozenset("head script style noscript template svg nav footer aside form button select textarea iframe object dialog menu title canvas audio video xmp datalist input".split())
#: Class, id and role words of what is not the article (fixed values).
_BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promotion promoted banner menu menus nav navbar navigation"
    " breadcrumb breadcrumbs sidebar side aside footer foot masthead topbar cookie cookies consent gdpr notice notices alert alerts warning popup modal overlay"
    " newsletter subscribe subscription signup login register comment comments commentary disqus reply replies respond responses share sharing social related"
    " recommended recommendations widget widgets toolbar pagination pager copyright legal disclaimer contentinfo complementary search hidden skip tags".split()
)
_ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promoted hidden".split())
_HEADER_WORDS = frozenset("header head masthead".split())
#: Words that may stand beside those above in one class, id or role: "cookie-banner-top" is marked, "has-sidebar" is not.
_PLAIN_WORDS = frozenset("site page global main left right top bottom box block list bar area section container wrapper inner outer slot unit links link posts items content primary secondary".split())
#: Words that mark a part of an article, not what stands beside it, where they are found inside one.
_ARTICLE_WORDS = frozenset("warning notice notices alert alerts tags legal disclaimer copyright side head".split())
_MARK = re.compile(r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*>?|</?[a-zA-Z](?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*>|</?[a-zA-Z][^<>]*(?:>|\Z)", re.DOTALL)
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s=<>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")


def _labels(tag: str, named: int) -> tuple[list[str], bool]:
    """Class, id and role tokens of a start tag whose name ends at `named`, and whether it is hidden."""
    tokens, hidden = [], False
    for name, *values in _ATTRIBUTE.findall(tag, named):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name in ("class", "id", "role"):
            tokens += value.split()
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value == "true"
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
    return tokens, hidden


def _marks(tokens: list[str], words: frozenset[str]) -> set[str]:
    """Those of the words that tokens consist of, alone or with plain words."""
    found: set[str] = set()
    for token in tokens:
        parts = set(re.findall(r"[^\W\d_]+", token))
        if parts <= words | _BOILERPLATE_WORDS | _PLAIN_WORDS:
            found |= parts & words
    return found


class _Node:
    """An element; `marks` are its boilerplate words, `size` and `story` the text in it and in its articles."""

    __slots__ = ("tag", "path", "parent", "hard", "marks", "header", "out", "region", "size", "story", "depth", "block")

    def __init__(self, tag: str, path: str, parent: _Node | None, hard: bool = False, marks: frozenset[str] | set[str] = frozenset(), header: bool = False) -> None:
        self.tag, self.path, self.parent, self.hard, self.marks, self.header = tag, path, parent, hard, marks, header
        self.out, self.region, self.size, self.story = False, 0, 0, 0
        self.depth = parent.depth + 1 if parent else 0
        self.block = parent is None or tag in _BLOCK


def _resolve(nodes: list[_Node]) -> None:
    """Sets which elements are out, and which article or main element each is in."""
    for node in reversed(nodes[1:]):
        if not node.hard:
            node.parent.size += node.size
            node.parent.story += node.size if node.tag in ("article", "main") else node.story
    whole, regions = nodes[0], 0
    for node in nodes[1:]:
        top = node.parent
        exempt = node.tag in ("article", "main", "html", "body") or 2 * node.story > whole.story
        if not exempt and not whole.story:
            exempt = 2 * node.size > whole.size
        marks = node.marks
        if top.region and marks:
            marks = marks - _ARTICLE_WORDS if node.block and node.tag not in _TEXT_BLOCKS - _LISTS else marks & _ADVERT_WORDS
        header = node.header and not top.region and node.tag not in ("article", "main", "body", "html") and (node.tag == "header" or not exempt)
        label = node.tag == "label" and not top.region
        node.out = top.out or node.hard or header or label or bool(marks) and not exempt
        node.region = top.region
        if node.tag in ("article", "main") and not node.out and not node.region:
            regions += 1
            node.region = regions


def text_nodes(page: str) -> list[tuple[_Node, int, str]]:
    """(element, block, text) of the text that no boilerplate element holds; region 0 is outside any article."""
    root = _Node("", "", None)
    stack, nodes = [root], [root]
    found: list[tuple[_Node, int, str]] = []
    block = 0
    at, size = 0, len(page)
    low = None
    while at < size:
        mark = _MARK.search(page, at)
        begin = mark.start() if mark else size
        top = stack[-1]
        if begin > at:
            text = entities.unescape(page[at:begin])
            top.size += len(text.strip())
            found.append((top, block, text))
        if not mark:
            break
        at, tag = mark.end(), mark[0]
        named = _TAG.match(tag)
        if not named:
            continue
        name = named[1].lower()
        if name in _BLOCK:
            block += 1
        if tag[1] == "/":
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
            continue
        if name in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _BLOCK or stack[i].tag in ("button", "object"):
                    break
        if name in _SIBLINGS:
            same, until = _SIBLINGS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in until:
                    break
                if stack[i].tag in same.split():
                    del stack[i:]
                    break
        if name in _VOID or tag.endswith("/>") and name not in _BLOCK | _RAW:
            continue
        top = stack[-1]
        tokens, hidden = _labels(tag, named.end()) if "=" in tag or "hidden" in tag else ([], False)
        if name in _RAW:
            low = page.lower() if low is None else low
            if len(low) != size:  # lower-casing changed the length: fall back to a search without case
                end = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
                end = end.start() if end else -1
            else:
                end = low.find(f"</{name}", at)
            if end < 0:
                break
            close = page.find(">", end)
            at = close + 1 if close >= 0 else size
            continue
        path = f"{top.path}>{name}{'.' + '.'.join(sorted(set(tokens))) if tokens else ''}" if name in _BLOCK else top.path
        hard = name in _BOILERPLATE_TAGS or hidden and name not in ("html", "body")
        header = name == "header" or bool(_marks(tokens, _HEADER_WORDS))
        stack.append(_Node(name, path, top, hard, _marks(tokens, _BOILERPLATE_WORDS), header))
        nodes.append(stack[-1])
    _resolve(nodes)
    return [x for x in found if not x[0].out]


def content_paths(nodes: list[tuple[_Node, int, str]], share: float = SHARE) -> set[str]:
    """Paths whose smoothed and fused ratios reach the share of the page's greatest; inline elements count to their block."""
    length: dict[str, list[float]] = {}
    before = None
    for node, block, text in nodes:
        size = len(text.strip())
        if size:
            one = length.setdefault(node.path, [0, 0, 0])
            one[0] += size
            one[1] += len(_PUNCTUATION.findall(text))
            one[2] += before != (node.path, block)
            before = node.path, block
    if not length:
        return set()
    texts, marks = [a / n for a, _, n in length.values()], [b / n for _, b, n in length.values()]

    def smooth(x: list[float]) -> list[float]:
        padded = [x[0], *x, x[-1]]
        return [sum(w * padded[i + k] for k, w in enumerate(SMOOTHING)) for i in range(len(x))]

    fused = [t * (1 + m) for t, m in zip(smooth(texts), smooth(marks), strict=True)]
    bound = share * max(fused)
    return {path for path, x in zip(length, fused, strict=True) if x >= bound}


def _chosen_nodes(nodes: list[tuple[_Node, int, str]], chosen: set[str]) -> list[tuple[_Node, int, str]]:
    """The text of a page without leading articles: chosen paths, and all short blocks of their common element.

    That element is the innermost, no paragraph, heading or list, that holds more than half of the chosen text. In
    body only what stands between the first and the last chosen block counts, with headings before them.
    """
    held: dict[_Node, int] = {}
    for node, _, text in nodes:
        held[node] = held.get(node, 0) + (len(text.strip()) if node.path in chosen else 0)
        while node.parent is not None and node.parent not in held:
            node = node.parent
            held[node] = 0
    inwards = sorted(held, key=lambda x: x.depth)
    for node in reversed(inwards[1:]):
        held[node.parent] += held[node]
    container = inwards[0]
    for node in inwards:
        if 2 * held[node] > held[inwards[0]] and node.block and node.tag not in _TEXT_BLOCKS:
            container = node
    inside: dict[_Node, bool] = {}
    for node in inwards:
        inside[node] = node is container or node.parent is not None and inside[node.parent]
    places = [i for i, (node, _, text) in enumerate(nodes) if node.path in chosen and text.strip()]
    first, last = places[0], places[-1]
    while first and (_heading(nodes[first - 1][0]) or not nodes[first - 1][2].strip()):
        first -= 1
    body = container.tag in ("", "html", "body")

    def keep(i: int, node: _Node) -> bool:
        if node.region and not container.region:  # articles that hold less than the rest: teasers
            return False
        return node.path in chosen or inside[node] and (not body or first <= i <= last)

    return [x for i, x in enumerate(nodes) if keep(i, x[0])]


def _heading(node: _Node | None) -> bool:
    while node is not None and not node.block:
        node = node.parent
    return node is not None and re.fullmatch("h[1-6]", node.tag) is not None


def main_text(page: str | None, share: float = SHARE) -> str:
    """The article of one page."""
    nodes = text_nodes(page or "")
    chosen = content_paths(nodes, share)
    if not chosen:
        return ""
    sizes = [(node.region, len(text.strip())) for node, _, text in nodes if node.path in chosen]
    regions = {region for region, size in sizes if region and size}
    if 2 * sum(size for region, size in sizes if region) > sum(size for _, size in sizes):
        keep = [x for x in nodes if x[0].region in regions]
    else:
        keep = _chosen_nodes(nodes, chosen)
    parts = [text if i == 0 else " " * (keep[i - 1][1] != block) + text for i, (_, block, text) in enumerate(keep)]
    return " ".join("".join(parts).split())


def extract_main_text(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages(page_id, url, html)."""

    def extract(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(x.as_py(), share) for x in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
