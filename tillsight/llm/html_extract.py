"""Main text of web pages by tag-path ratios.

Every text node has a path of tags from the root. Per path the text length and the punctuation are
summed over its nodes; both are divided by the number of nodes, put back on the nodes in page order,
smoothed along the page and multiplied. Paths whose fused value reaches a threshold made from the
page's own spread are content. The subtree that holds the content is the article; what stands in it
is taken whole, headings and short paragraphs too, but for the parts that are marked as something
else.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import text_values

# Elements by the part they play in HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNSEEN = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select "
    "option datalist textarea".split()
)
BOILERPLATE = frozenset("nav header footer aside form button menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCKS - {"body", "caption", "dd", "dt", "html", "legend", "li", "option", "summary",
                   "tbody", "td", "tfoot", "th", "thead", "tr"}
SIBLING = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = frozenset("ul ol dl table td th html body article section main div aside nav footer header form".split())
HEAD_PARTS = frozenset("head title meta link base basefont bgsound script style noscript template".split())
# Elements whose class or role may take them out of the content with any word of the list below; an id only
# where it is made for the layout, not from a heading.
CONTAINERS = frozenset("div aside form table center dl ul ol".split())
# Words in class, id and role that name a part of a page. Those of the first list do so in any
# element, as first or last part of a name, those of the second in containers, as its first part.
SURELY_NOT = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored cookie cookies "
    "consent gdpr newsletter subscribe sidebar breadcrumb breadcrumbs comment comments disqus "
    "pagination navbar contentinfo complementary copyright paywall notice notices".split()
)
NOT_CONTENT = SURELY_NOT | frozenset(
    "banner promo promotion menu nav navigation aside widget footer header masthead "
    "signup login popup modal overlay respond reply replies share sharing social related recommended "
    "recommendations pager toolbar search legal alert".split()
)
LISTS, NOT_LISTS = frozenset("ul ol dl".split()), frozenset("search legal alert related respond".split())
COMMENTS = frozenset("comment comments reply replies disqus".split())
#: first parts that say where on the page something stands, and those that only speak of another part
PLACES = frozenset("site page main top bottom left right global primary secondary".split())
SPEAKS_OF = frozenset("no has with without hide".split())
CONTENT = frozenset("article content main post entry story body text".split())
PUNCTUATION = frozenset(",.;:!?，。；：！？、…。")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z0-9]+")
_HUMP = re.compile(r"([a-z])([A-Z])")
_RADIUS = 1


@dataclass(eq=False)
class Node:
    """An element; ``path`` numbers its labels from the root, ``article`` and ``named`` are the outermost
    elements above or at it of the kind article or main, and named as content."""

    tag: str
    parent: Node | None
    depth: int
    path: int
    excluded: bool = False
    hidden: bool = False
    article: Node | None = None
    named: Node | None = None


@dataclass(eq=False)
class Block:
    """Text between two block borders, in one element."""

    node: Node
    parts: list = field(default_factory=list)

    @property
    def text(self) -> str:
        return _SPACE.sub(" ", "".join(self.parts)).strip()


def _parts(name: str) -> list[str]:
    return _NAME.findall(_HUMP.sub(r"\1 \2", name).lower())


def _names_another_part(tag: str, attrs: dict, inside: bool) -> bool:
    """Whether class, role or id say that an element is no content. ``inside`` an article, an
    article whose class says so is a comment."""
    given = [_parts(n) for k in ("class", "role") for n in str(attrs.get(k) or "").split()]
    ident = _parts(str(attrs.get("id") or ""))
    if tag in ("article", "main"):
        return any(COMMENTS & set(parts) for parts in given) or inside and COMMENTS.issuperset(ident) and bool(ident)
    loose = tag in CONTAINERS or tag == "section"
    if tag in CONTAINERS and len(ident) == 1:
        given.append(ident)
    elif tag in CONTAINERS and ident and ident[0] in SURELY_NOT:
        given.append(ident[:1])
    for parts in given:
        if not parts or parts[0] in SPEAKS_OF:
            continue
        if not SURELY_NOT.isdisjoint((parts[0], parts[-1])) or not COMMENTS.isdisjoint(parts):
            return True
        if parts[0] in PLACES and len(parts) > 1:
            parts = parts[1:]
        words = NOT_CONTENT - NOT_LISTS if tag in LISTS else NOT_CONTENT
        if loose and parts[0] in words:
            return True
    return False


class _Reader(HTMLParser):
    """Blocks of a page in its order. Work grows with the page, not with the depth of its elements: what
    must be known of the elements above is kept at each node or in the places of the open tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        root = Node("#root", None, 0, 0)
        self.stack = [root]
        self.nodes = [root]
        self.paths: dict[tuple[int, str], int] = {}
        #: places in the stack of the open elements, by tag, and of those that are blocks
        self.places: dict[str, list[int]] = defaultdict(list)
        self.block_places = [0]
        self.blocks: list[Block] = []
        self.open: Block | None = None

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "wbr"):
            if tag == "br":
                self.handle_data(" ")
            return
        if tag not in HEAD_PARTS:
            self._end_head()
        if tag in ENDS_P:
            self._close_within("p", SCOPES - {"div"})
        for sibling in SIBLING.get(tag, ()):
            self._close_within(sibling, SCOPES)
        if tag in BLOCKS:
            self.open = None
        if tag in VOID:
            return
        above = self.stack[-1]
        attrs = dict(attrs)
        inside = bool(self.places["article"] or self.places["main"])
        marked = tag in BOILERPLATE and not (tag == "header" and self.places["article"])
        marked |= tag not in ("html", "body") and _names_another_part(tag, attrs, inside)
        style = (attrs.get("style") or "").replace(" ", "").lower()
        names = sorted({n for k in ("class", "id", "role") for n in _parts(str(attrs.get(k) or ""))})
        label = ".".join([tag, *names])
        node = Node(
            tag, above, above.depth + 1, self.paths.setdefault((above.path, label), len(self.paths) + 1),
            above.excluded or marked,
            above.hidden or tag in UNSEEN or "hidden" in attrs or "display:none" in style,
            above.article, above.named,
        )
        if tag in ("article", "main"):
            node.article = node.article or node
            node.named = node.named or node
        elif tag in ("div", "section", "td") and not CONTENT.isdisjoint(names):
            node.named = node.named or node
        self.nodes.append(node)
        self.places[tag].append(len(self.stack))
        if tag in BLOCKS:
            self.block_places.append(len(self.stack))
        self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_data(" ")
        places = self.places[tag]
        if not places:
            if tag == "p":
                self.open = None
        elif tag in BLOCKS or places[-1] > self.block_places[-1]:
            # a block's end reaches past inline elements that were never closed, not past other blocks
            self._cut(places[-1])

    def _cut(self, place: int) -> None:
        """Close the element at a place of the stack and all in it."""
        if self.block_places[-1] >= place:
            self.open = None
        while len(self.stack) > place:
            node = self.stack.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.block_places.pop()

    def _close_within(self, tag, scopes):
        places = self.places[tag]
        if places and all(self.places[s][-1] <= places[-1] for s in scopes if self.places[s]):
            self.open = None
            self._cut(places[-1])

    def _end_head(self) -> None:
        """The end tag of ``head`` may be left out: what cannot stand in it ends it."""
        if self.stack[-1].tag == "head":
            self._cut(len(self.stack) - 1)

    def handle_data(self, data):
        if not data.isspace():
            self._end_head()
        inner = self.stack[-1]
        if inner.hidden:
            return
        owner = self.stack[self.block_places[-1]]
        if inner.excluded and not owner.excluded:
            return
        if self.open is None or self.open.node is not owner:
            self.open = Block(owner)
            self.blocks.append(self.open)
        self.open.parts.append(data)


def path_values(blocks: list[Block], texts: list[str]) -> np.ndarray:
    """Fused tag-path ratio of each block: text and punctuation per node of its path, each smoothed
    along the page with a triangle of weights, multiplied."""
    at = np.unique([b.node.path for b in blocks], return_inverse=True)[1]
    nodes = np.bincount(at)
    length = np.bincount(at, [len(t) for t in texts]) / nodes
    marks = np.bincount(at, [sum(c in PUNCTUATION for c in t) for t in texts]) / nodes
    kernel = np.convolve(np.ones(_RADIUS + 1), np.ones(_RADIUS + 1))
    weight = np.convolve(np.ones(len(at)), kernel, "same")[: len(at)] if len(at) >= len(kernel) else None

    def smooth(v):
        return v if weight is None else np.convolve(v, kernel, "same") / weight

    fused = smooth(length[at]) * (1.0 + smooth(marks[at]))
    # a path is content or not as a whole
    return (np.bincount(at, fused) / nodes)[at]


def extract(html: str) -> str:
    """Main text of a page: blocks in page order, joined by an empty line."""
    if not html:
        return ""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    blocks, texts = [], []
    for b in reader.blocks:
        if not b.node.hidden and (t := b.text):
            blocks.append(b)
            texts.append(t)
    open_ = [i for i, b in enumerate(blocks) if not b.node.excluded]
    if not open_:
        return ""
    values = path_values([blocks[i] for i in open_], [texts[i] for i in open_])
    threshold = min(values.std(), values.max()) if len(values) > 1 else 0.0
    chosen = [i for i, v in zip(open_, values) if v >= threshold]
    tops = _articles(reader.nodes, [blocks[i].node for i in chosen], [len(texts[i]) for i in chosen])
    # what was chosen is content wherever it stands, unless the page itself names its articles
    kept = set() if all(n.tag in ("article", "main") for n in tops) else set(chosen)
    under = {id(n) for n in tops}
    for node in reader.nodes:  # parents come before what is in them
        if id(node.parent) in under:
            under.add(id(node))
    return "\n\n".join(texts[i] for i in open_ if i in kept or id(blocks[i].node) in under)


def _articles(every: list[Node], nodes: list[Node], lengths: list[int]) -> list[Node]:
    """The elements that are taken whole: the outermost ones of the kind article or main that hold
    chosen text, if they hold over half of it together; else the outermost ones whose class or id
    names content, if they do; else the deepest element, but for a single block, that holds all
    chosen text."""
    half = sum(lengths) / 2
    for kind in ("article", "named"):
        tops = [getattr(node, kind) for node in nodes]
        if sum(n for n, top in zip(lengths, tops) if top is not None) > half:
            return list({id(t): t for t in tops if t is not None}.values())
    held = Counter(id(n) for n in nodes)
    top = every[0]
    for node in reversed(every):  # what is in an element comes after it
        if held[id(node)] == len(nodes):
            top = node
            break
        if node.parent is not None:
            held[id(node.parent)] += held[id(node)]
    while top.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td"):
        top = top.parent
    return [top]


def extract_pages(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text`` per row. Null and empty html give an empty text; rows with the same id
    stay separate; other columns are ignored; an empty table stays empty. The step is narrow, and a
    page is read whole however long it is.
    """
    names = [id_col, url_col, "text"]
    kinds = dict(df.dtypes)

    def run(batches):
        for batch in batches:
            made = [extract(h) for h in text_values(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.string())], names
            )

    return df.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(
        run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string"
    )
