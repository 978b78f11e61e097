"""The main text of web pages, by paths that the pages of a host agree on.

1. What stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments is left out,
   as far as tags, roles and class names tell. Of the rest, a page's own container is the articles, or else the innermost
   container beside which there is nothing but links. From there the way goes on down to the container that holds most of
   the text; the page votes for its path: tags and classes from the root, with numbers in class names made equal. It also
   names the blocks of its own container that stand beside that one.
2. Spark counts the votes of each host; the path with most votes wins (then the longer text, then the name). Blocks that
   a tenth of a host's pages name, three at least, are the host's and no page's: what one page alone can't tell.
3. Each page is read again: its own container, without the host's blocks that stand outside of the winning path. So a
   title or an end beside the voted container stays, and a line that the whole site repeats goes. A page without the
   winning path is of another make and keeps all of its own container.

Null and empty pages have no text. A url without a host votes with all others of that kind. Repeated pages vote once per
row; further columns stay out of the result.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoferry.llm.common import Scratch, shuffled_join, staged

#: Tags that hold other blocks, tags that are blocks, tags without content, tags whose content is no text.
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "center"}
BLOCKS = CONTAINERS | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "pre", "blockquote", "table", "tr", "th",
    "thead", "tbody", "figure", "figcaption", "hr", "address", "details", "summary",
}
EMPTY = {"br", "img", "hr", "meta", "link", "input", "source", "wbr", "area", "base", "col", "embed", "track", "param"}
RAW = ("script", "style", "template", "textarea", "title", "iframe", "svg", "select")
#: Blocks that stay open until their end tag, a sibling, or the end of what they stand in.
OPEN = {"ul", "ol", "dl", "table", "blockquote", "figure", "details", "p", "li", "dt", "dd", "tr", "th", "thead", "tbody"}
#: For tags whose end tag may be left out: the open elements that a new one closes, and those that it doesn't look behind.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
OUTSIDE = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "label", "fieldset"}
#: Words of class names, ids and roles that mark what is not the article, wherever in a name they stand ...
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar comment comments disqus cookie cookies consent gdpr "
    "newsletter breadcrumb breadcrumbs pagination popup modal masthead complementary contentinfo".split()
)
#: ... and those that do only where the rest of the name says nothing else: a share-price or a post-header is the article's.
WEAK_MARKS = set(
    "banner nav navbar navigation menu header footer widget respond reply replies notice notices alert overlay subscribe signup login share "
    "sharing social related recommended pager search".split()
)
SAYS_NOTHING = set(
    "site page main top bottom left right global primary secondary sub mobile desktop sticky fixed box bar block container wrapper wrap inner outer "
    "area section list links link items item row col column buttons button icons posts stories form panel group holder region".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<close>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE) for tag in RAW}
#: Share of a page's text that the container it votes for holds at least.
MOST = 0.6
#: Least share of a host's pages, and least number of them, that name a block for it to be the host's.
SHARE, PAGES = 0.1, 3

_PART = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


@dataclass(eq=False)
class Node:
    """A container: its part of the path, the blocks in it (places in the page's list) and whether it is outside of the article.

    ``key`` is a hash of its path, made from the one above it, so that deep pages don't take long paths for every container.
    """

    tag: str
    name: str
    above: Node | None
    outside: bool
    first: int
    last: int = -1
    weight: int = 0
    links: int = 0
    children: list[Node] = field(default_factory=list)
    heavy: list[bool] = field(default_factory=list)  # of the root: for each block whether more than half of it is links

    def __post_init__(self) -> None:
        self.key = hash((self.above.key, self.name)) if self.above else 0

    @property
    def path(self) -> str:
        names, node = [], self
        while node.above:
            names.append(node.name)
            node = node.above
        return "".join("/" + name for name in reversed(names))

    @property
    def worth(self) -> int:
        return self.weight - 2 * self.links


def key_of(path: str) -> int:
    key = 0
    for name in path.split("/")[1:]:
        key = hash((key, name))
    return key


def _marks(name: str) -> bool:
    words = _PART.findall(name)
    return any(word in MARKS for word in words) or any(word in WEAK_MARKS for word in words) and all(word in WEAK_MARKS or word in SAYS_NOTHING for word in words)


def _marked(rest: str) -> tuple[bool, str]:
    """Whether attributes put an element outside, and its class as part of a path."""
    if not rest:
        return False, ""
    outside, name = False, ""
    for key, a, b, c in _ATTRIBUTE.findall(rest):
        value = entities.unescape(a or b or c).lower()
        key = key.lower()
        if key == "class":
            name = ".".join(sorted(_DIGITS.sub("#", part) for part in value.replace("/", "_").split()))
        if key in ("class", "id", "role"):
            outside = outside or any(map(_marks, value.split()))
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            outside = True
    return outside, name


def parsed(page: str) -> tuple[list[str], list[Node]]:
    """The blocks of text inside of articles, in order, and all containers with the blocks they span."""
    blocks: list[str] = []
    held: list[str] = []
    root = Node("", "", None, False, 0)
    nodes, stack = [root], [("", root, False)]  # tag, container, outside
    opened: Counter[str] = Counter()  # tags on the stack
    weights: list[tuple[int, int]] = []
    sizes = [0, 0]  # characters of the block, and those in links
    link = 0

    def cut() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                blocks.append(text)
                weights.append((len(text), min(sizes[1], len(text))))
        sizes[:] = 0, 0

    def add(raw: str) -> None:
        if raw and not stack[-1][2]:
            text = entities.unescape(raw) if "&" in raw else raw
            held.append(text)
            if link:
                sizes[1] += len(text)

    def close(depth: int) -> None:
        for _, node, _ in stack[depth:]:
            if node.last < 0 and node is not stack[depth - 1][1]:
                node.last = len(blocks)
        opened.subtract(tag for tag, _, _ in stack[depth:])
        del stack[depth:]

    def imply(tags: set[str], bounds: set[str]) -> None:
        """End tags that a new block implies: of the outermost of these elements inside of the bounds."""
        if not any(opened[tag] for tag in tags):
            return
        lowest = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                lowest = depth
            elif stack[depth][0] in bounds:
                break
        if lowest:
            close(lowest)

    at = 0
    while True:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA["):
                add(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if found["close"]:
            if tag == "a":
                link = max(0, link - 1)
            if tag in BLOCKS or tag in OUTSIDE:
                cut()
            if opened[tag]:
                close(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth][0] == tag))
            continue
        rest = found["rest"]
        if tag in RAW:
            if tag in BLOCKS:
                cut()
            if not rest.endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in EMPTY:
            if tag in BLOCKS:
                cut()
                imply({"p"}, CONTAINERS)
            continue
        if tag == "a":
            link += 1
            continue
        outside, name = _marked(rest) if rest.strip() else (False, "")
        if tag in BLOCKS or tag in OUTSIDE:
            cut()
            link = 0
            if tag != "label":
                imply({"p"}, CONTAINERS)
            if tag in SIBLINGS:
                imply(*SIBLINGS[tag])
        elif not outside:
            continue  # an inline element
        outside = outside and tag not in ("html", "body") or stack[-1][2] or tag in OUTSIDE
        above = stack[-1][1]
        if tag in CONTAINERS:
            node = Node(tag, f"{tag}.{name}" if name else tag, above, outside, len(blocks))
            nodes.append(node)
            above.children.append(node)
            stack.append((tag, node, outside))
            opened[tag] += 1
        elif tag in OPEN or outside:
            if not rest.endswith("/"):
                stack.append((tag, above, outside))
                opened[tag] += 1
    cut()
    root.heavy = [2 * links > size for size, links in weights]
    so_far = [list(accumulate((pair[k] for pair in weights), initial=0)) for k in (0, 1)]
    for node in nodes:
        node.last = len(blocks) if node.last < 0 else node.last
        node.weight, node.links = (sums[node.last] - sums[node.first] for sums in so_far)
    return blocks, nodes


def best(nodes: list[Node]) -> Node:
    """The container that holds the page's text: the articles, or else all but blocks that are mostly links.

    Outermost <article> and <main> elements with enough of the text are taken as a whole, with what they have between them.
    Without one, the way goes down as long as nothing but links is left beside a container.
    """
    root, heavy = nodes[0], nodes[0].heavy
    named, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.tag in ("article", "main"):
            if node.worth > 0:
                named.append(node)
            continue
        waiting.extend(inner for inner in node.children if not inner.outside)
    if named and sum(node.worth for node in named) >= 0.3 * root.worth:
        node, others = named[0], named[1:]
        while any(not (node.first <= x.first and x.last <= node.last) for x in others):
            node = node.above
        return node
    node = root
    while True:
        inner = max((x for x in node.children if not x.outside), key=lambda x: x.worth, default=None)
        if inner is None or not inner.weight or not all(heavy[node.first : inner.first] + heavy[inner.last : node.last]):
            return node
        node = inner


def core(own: Node) -> Node:
    """The innermost container in a page's own one that still holds most of its text."""
    node = own
    while True:
        inner = max((x for x in node.children if not x.outside), key=lambda x: x.worth, default=None)
        if inner is None or inner.worth < MOST * own.worth or inner.worth <= 0:
            return node
        node = inner


def block_hash(block: str) -> int:
    return int.from_bytes(hashlib.blake2b(block.encode(), digest_size=8).digest(), "little", signed=True)


def vote_of(page: str) -> tuple[str, int, list[int]]:
    """A page's path, the characters in it, and the blocks beside it."""
    blocks, nodes = parsed(page)
    own = best(nodes)
    inner = core(own)
    beside = [*blocks[own.first : inner.first], *blocks[inner.last : own.last]]
    return inner.path, inner.weight, sorted({block_hash(block) for block in beside})


def text_at(blocks: list[str], nodes: list[Node], path: str | None, repeated: set[int] = frozenset()) -> str:
    """The text of a page's own container, but for the host's blocks that stand outside of its path."""
    own = best(nodes)
    key = None if path is None else key_of(path)
    at = [node for node in nodes if node.key == key and node.weight and not node.outside]
    if not at or not repeated:
        return "\n".join(blocks[own.first : own.last])
    inside = {place for node in at for place in range(node.first, node.last)}
    return "\n".join(blocks[place] for place in range(own.first, own.last) if place in inside or block_hash(blocks[place]) not in repeated)


def page_votes(pages: DataFrame) -> DataFrame:
    """Host, path and characters of the container that holds most of each page's text, and hashes of the blocks beside it."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes, beside = zip(*map(vote_of, batch.column(1).to_pylist())) if batch.num_rows else ([], [], [])
            columns = [pa.array(list(x), kind) for x, kind in ((paths, pa.string()), (sizes, pa.int64()), (beside, pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["host", "path", "size", "beside"])

    return pages.select("host", "html").mapInArrow(vote, "host string, path string, size long, beside array<long>")


def host_blocks(votes: DataFrame) -> DataFrame:
    """The blocks that so many pages of a host name: no more than ten times as many as a page names on average."""
    named = votes.select("host", F.explode("beside").alias("block")).groupBy("host", "block").agg(F.count("*").alias("n"))
    pages = votes.where("size > 0").groupBy("host").agg(F.greatest(F.lit(PAGES), F.count("*") * SHARE).alias("least"))
    return shuffled_join(named, pages, ["host"]).where("n >= least").groupBy("host").agg(F.collect_list("block").alias("repeated"))


def host_paths(votes: DataFrame) -> DataFrame:
    """The path of each host. Counts are combined before they are shuffled, by host and path and then by host."""
    counted = votes.where("size > 0").groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum("size").alias("size"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("pages", "size", "path")).alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    whole = pages.select(
        F.col("page_id"),
        F.col("url"),
        F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    scratch = Scratch()
    votes = scratch.stage(page_votes(whole), "page-votes")
    hosts = staged(host_paths(votes).join(host_blocks(votes), "host", "left"), "hosts")
    scratch.drop(pages.sparkSession)
    joined = whole.join(hosts, "host", "left").select("page_id", "url", "html", "path", "repeated")
    kind, url = (joined.schema[name].dataType.simpleString() for name in ("page_id", "url"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(place).to_pylist() for place in (2, 3, 4)))
            texts = [text_at(*parsed(page), path, set(repeated or ())) for page, path, repeated in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    done = joined.mapInArrow(extract, f"page_id {kind}, url {url}, text string")
    return done.withColumn("n_chars", F.char_length("text").cast("long"))
