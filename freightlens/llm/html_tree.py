"""Main text of pages by a style tree per site.

The element trees of a host's pages are merged: a node is a path of tags with
their presentation (class and role words, digits removed).  Over the pages of
the host a node has

* presentation entropy: of the sequences of child elements it has on a page;
* content entropy: of the texts of the blocks below it on a page;

each the (quadratic) chance that two pages with the node differ, so that 0 is
"the same on every page" and 1 "different everywhere" whatever their number;
pages with equal html count once.  Its importance mixes the two: a node with many
styles is judged by them, one with a single style by the content below it.
Branches of low importance are removed from every page of the host.

Inside ``article`` and ``main`` the leaves are judged one by one: the importance
of a text is the chance that another page of the site does not have it, so a
notice that stands in every article goes.  Where such texts are more than half
of an article, the pages are copies of each other and it stays whole.

What an element says of itself comes first: ``nav``, ``footer``, ``form``,
``script`` and the like, hidden elements, and whole class or role words such as
``ad`` or ``comment-list`` are not main text, as such texts may differ from page
to page.  A part of a class word (``has-sidebar``) and the id of a heading or
paragraph say nothing.  A page with nothing besides elements named so by a class
keeps their text.  A host needs ``MIN_PAGES`` pages with the node, or with
articles, for its own statistics to count.

On Spark: pages give rows of 64-bit hashes, equal pages fall together, and the
removable nodes and texts of a host are one row, which its pages join.  Parsing
is linear in the html.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import Scratch, slices
from freightlens.llm.urls import host_of

MIN_PAGES = 8
LOW = 0.2
GAMMA = 0.9
HALF = 0.5

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|iframe|textarea|object|canvas|math|select|title"
NOISE_TAGS = frozenset("head nav footer aside form button input select option label fieldset dialog menu script style noscript template "
                       "svg iframe textarea object canvas math title".split())
CONTENT_TAGS = frozenset(["article", "main"])
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())
# A start tag closes an open element of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NOISE_WORDS = frozenset("ad ads advert advertisement advertising adsense adslot banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
                        "copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notification outbrain paging pagination popup "
                        "promo promoted promotion related respond share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar topbar widget "
                        "alert complementary contentinfo dialog search".split())
# Words beside which a noise word is still the whole sense of a class word.
PLAIN_WORDS = frozenset("area articles bar block bottom box button buttons container content form global inner item items left link links list main message outer page panel "
                        "post posts primary right row secondary section site slot text thread top unit wrap wrapper".split())
# Kept in spite of such a word: the page's own body or article.
_NEVER_NOISE = frozenset(["html", "body", "article", "main"])
# The id of these is an anchor, made of their text.
_ANCHORS = frozenset("p h1 h2 h3 h4 h5 h6 a span b i em strong dt dd td th li".split())

_TAGS = (r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(" + RAW + r")\b[^>]*>.*?(?:</\2\s*>|\Z)|"
         r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|"
         r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")  # the last: a quote that is never closed
_TOKEN = re.compile(r"<!\[CDATA\[(.*?)\]\]>|" + _TAGS, re.S | re.I)
_TOKEN_LATE = re.compile(r"(\Zx)?" + _TAGS, re.S | re.I)  # after the last end of a CDATA section
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_TELLING = re.compile("class|role|id|style", re.I)  # "id" is in "hidden" too
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[-_]+")
_TAG_START = re.compile(r"<[/!?a-zA-Z]")
#: How an element is known not to be main text: not at all, by a class word, by its kind.
NOT, SAID, IS = 0, 1, 2


@dataclass(slots=True)
class Node:
    tag: str
    path: int  # hash of the path
    above: "Node | None"
    noise: int
    content: bool  # inside an article or main element
    children: list[str] = field(default_factory=list)
    block: int = 0  # place of the block element that it is in, or is
    texts: int = 0  # sum of the hashes of the blocks below
    filled: bool = False  # whether there are such blocks


@dataclass(slots=True)
class Block:
    node: Node
    content: bool  # a text block of an article or main element
    text: str

    @property
    def noise(self) -> int:
        return self.node.noise


def _says_noise(word: str) -> bool:
    """Whether a whole class word names something other than main text."""
    parts = [x for x in _PARTS.split(_DIGITS.sub("", word)) if x]
    return any(x in NOISE_WORDS for x in parts) and all(x in NOISE_WORDS or x in PLAIN_WORDS for x in parts)


@lru_cache(maxsize=1 << 14)
def _presentation(tag: str, raw: str, inside: bool) -> tuple[str, int]:
    """The node's name, and whether the element is known not to be main text.
    A header inside an article or main element holds its title."""
    kind = IS if tag in NOISE_TAGS else NOT
    if not _TELLING.search(raw):
        return tag, kind
    words, said = [], False
    seen: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), (a or b or c).lower()
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "role"):
            own = value.split()
            words += [w for w in (_DIGITS.sub("", x) for x in own) if w]
            said |= any(_says_noise(x) and not (inside and "header" in _PARTS.split(x)) for x in own)
        elif name == "id":
            said |= tag not in _ANCHORS and _says_noise(value) and not (inside and "header" in _PARTS.split(value))
        elif name == "style":
            value = "".join(value.split())
            kind = IS if "display:none" in value or "visibility:hidden" in value else kind
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            kind = IS
    if said and kind == NOT and tag not in _NEVER_NOISE:
        kind = SAID
    return ".".join([tag, *sorted(set(words))]), kind


def hash_text(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


@lru_cache(maxsize=1 << 16)
def _path(above: int, name: str) -> int:
    return hash_text(f"{above}/{name}")


def _signed(x: int) -> int:
    return ((x + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63)


def parse(html: str | None) -> tuple[list[Block], list[Node]]:
    """The blocks of text of a page in order, and its elements (each after the one it is in)."""
    html = html or ""
    cut = _TAG_START.search(html, html.rfind(">") + 1)  # a tag at the end of a page that was cut
    if cut:
        html = html[:cut.start()]
    late = html.rfind("]]>")
    root = Node("", hash_text(""), None, NOT, False)
    stack, nodes, blocks, run = [root], [root], [], []
    places: dict[str, list[int]] = {}  # of the open elements of a name

    def flush() -> None:
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            top = stack[-1]
            blocks.append(Block(top, top.content and stack[top.block].tag in TEXT_BLOCKS, text))

    def close(at: int) -> None:
        if stack[-1].block >= at:  # a block is among them
            flush()
        for n in stack[at:]:
            places[n.tag].pop()
        del stack[at:]

    def innermost(*tags: str) -> int:
        """Place of the last open element of these names; 0: none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    end = 0
    while m := (_TOKEN if end <= late else _TOKEN_LATE).search(html, end):
        if m.start() > end:
            run.append(html[end:m.start()])
        end = m.end()
        section, _, shut, tag, raw, bad_shut, bad_tag, bad_raw = m.groups()
        if section is not None:
            run.append(section.replace("&", "&amp;"))
        if bad_tag:
            shut, tag, raw = bad_shut, bad_tag, bad_raw
        if not tag:
            continue
        tag = tag.lower()
        if shut:
            at = innermost(tag)
            if at:
                close(at)
            continue
        block = tag in BLOCKS
        if tag == "br":
            run.append(" ")
        if block:
            at = innermost("p")
            if at and stack[-1].block == at:
                close(at)  # a block ends an open paragraph
            flush()
        if tag in CLOSES:
            at = innermost(*CLOSES[tag])
            if at > innermost("ul", "ol", "dl", "table", "select"):
                close(at)
        above = stack[-1]
        name, kind = _presentation(tag, raw, above.content)
        if tag == "header" and not above.content:
            kind = IS
        node = Node(tag, _path(above.path, name), above, max(above.noise, kind), above.content or tag in CONTENT_TAGS)
        above.children.append(name)
        nodes.append(node)
        if tag not in VOID and not raw.endswith("/"):
            node.block = len(stack) if block else above.block
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    if end < len(html):
        run.append(html[end:])
    flush()
    return blocks, nodes


def _style(children: list[str]) -> str:
    """A sequence of children without repeats next to each other."""
    return " ".join(c for i, c in enumerate(children) if not i or children[i - 1] != c)


#: Kinds of statistics: children, texts below, a text of an article, pages with an article.
STYLE, CONTENT, LEAF, ARTICLE = 0, 1, 2, 3


def page_rows(html: str | None) -> set[tuple[int, int, int, int]]:
    """``(path, above, kind, value)`` of a page: the children and the texts below
    of its nodes that are not noise, and the texts of its article."""
    blocks, nodes = parse(html)
    for b in blocks:
        if not b.noise:
            b.node.texts, b.node.filled = b.node.texts + hash_text(b.text), True
    for n in reversed(nodes):
        if n.above is not None and n.filled:
            n.above.texts, n.above.filled = n.above.texts + n.texts, True
    styles: dict[int, list[str]] = {}
    contents: dict[int, int] = {}
    above = {}
    for n in nodes:
        if not n.noise:
            above[n.path] = n.above.path if n.above else 0
            if n.children:
                styles.setdefault(n.path, []).append(_style(n.children))
            if n.filled:
                contents[n.path] = contents.get(n.path, 0) + n.texts
    rows = {(p, above[p], STYLE, hash_text("\n".join(x))) for p, x in styles.items()}
    rows |= {(p, above[p], CONTENT, _signed(x)) for p, x in contents.items()}
    leaves = {hash_text(b.text) for b in blocks if b.content and not b.noise}
    return rows | {(x, 0, LEAF, 0) for x in leaves} | ({(0, 0, ARTICLE, 0)} if leaves else set())


def statistics(pages: DataFrame) -> DataFrame:
    """``host, path, above, kind, value, n``: on how many different pages of a
    host the nodes of a path had these children or texts below (``page_rows``)."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            rows = {(host, hash_text(html or ""), *r) for host, html in set(zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True)) for r in page_rows(html)}
            kinds = (pa.string(), *[pa.int64()] * 3, pa.int32(), pa.int64())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "page", "path", "above", "kind", "value"])

    return (pages.select("host", "html").mapInArrow(collect, "host string, page long, path long, above long, kind int, value long").distinct()
            .groupBy("host", "path", "above", "kind", "value").agg(F.count(F.lit(1)).alias("n")))


def importance(stats: DataFrame) -> DataFrame:
    """``host, path, above, seen, presentation, content, importance`` of every node;
    ``seen`` is the number of pages with it."""
    x = F.col("n").cast("double")
    each = stats.where(F.col("kind") <= CONTENT).groupBy("host", "path", "above", "kind").agg(F.sum("n").alias("total"), F.sum(x * (x - 1)).alias("equal"), F.count(F.lit(1)).alias("styles"))
    total = F.col("total").cast("double")
    entropy = F.when(F.col("total") > 1, 1 - F.col("equal") / (total * (total - 1))).otherwise(1.0)
    pick = lambda kind, c: F.max(F.when(F.col("kind") == kind, c))
    node = each.withColumn("entropy", F.greatest(F.lit(0.0), entropy)).groupBy("host", "path", "above").agg(
        F.max("total").alias("seen"), pick(0, F.col("entropy")).alias("presentation"), pick(0, F.col("styles")).alias("styles"), pick(1, F.col("entropy")).alias("content"))
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    mixed = (1 - weight) * F.coalesce("presentation", F.lit(0.0)) + weight * F.coalesce("content", F.lit(0.0))
    return node.withColumn("importance", F.when(F.col("presentation").isNull(), F.coalesce("content", F.lit(0.0)))
                           .when(F.col("content").isNull(), F.col("presentation")).otherwise(F.greatest(mixed, GAMMA * F.col("content"))))


def removable(stats: DataFrame, low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, low, texts``: a host's removable nodes (without those whose parent
    is removable too) and the removable texts of its articles."""
    nodes = importance(stats).where((F.col("importance") < low) & (F.col("seen") >= min_pages) & F.col("content").isNotNull()).select("host", "path", "above")
    parents = nodes.select(F.col("host").alias("its"), F.col("path").alias("above"))
    top = nodes.join(parents, nodes["host"].eqNullSafe(parents["its"]) & (nodes["above"] == parents["above"]), "left_anti")
    pages = stats.where(F.col("kind") == ARTICLE).select(F.col("host").alias("its"), F.col("n").alias("pages"))
    leaves = stats.where(F.col("kind") == LEAF).select("host", "path", "n").join(pages, F.col("host").eqNullSafe(F.col("its")))
    texts = leaves.where((F.col("pages") >= min_pages) & (1 - F.col("n") / F.col("pages") < low)).select("host", F.lit(None).cast("long").alias("path"), F.col("path").alias("text"))
    both = top.select("host", "path", F.lit(None).cast("long").alias("text")).unionByName(texts)
    return both.groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("low"), F.array_sort(F.collect_set("text")).alias("texts"))


def main_text(page: tuple[list[Block], list[Node]], low: list[int] | None = None, texts: list[int] | None = None) -> str:
    """Blocks that are not noise, nor below a removed node, nor removed texts of an article.

    The texts of an article go one by one, and only if they are no more than
    half of it.  A page whose every block would go keeps those that are not
    noise; one that has none keeps those that only a class word calls noise.
    """
    blocks, nodes = page
    named = [b for b in blocks if not b.noise] or [b for b in blocks if b.noise == SAID]
    gone, branches = set(), set(low or ())
    if branches:
        for n in nodes:  # a node comes after the one it is in
            if n.path in branches or (n.above is not None and id(n.above) in gone):
                gone.add(id(n))
    shared = set(texts or ())
    leaves = [b for b in named if b.content]
    if shared:
        repeated = sum(len(b.text) for b in leaves if hash_text(b.text) in shared)
        if repeated > HALF * sum(len(b.text) for b in leaves):
            shared = set()
    kept = [b for b in named if not (hash_text(b.text) in shared if b.content and shared else not b.content and id(b.node) in gone)]
    return "\n".join(b.text for b in kept or named)


def extract(pages: DataFrame, scratch: Scratch, low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages(page_id, url, html)``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by a line feed.  Null or empty html
    gives an empty text; pages without a host (null URL) form a site of their
    own; repeated rows give equal texts (and count once for their site); other
    columns are ignored; an empty table gives an empty result.
    """
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    stats = scratch.write(statistics(pages), "statistics")
    found = scratch.write(removable(stats, low, min_pages), "low")  # a row per host: the planner sees its size
    scratch.drop("statistics")

    @F.arrow_udf("string")
    def text(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in parts:
            yield pa.array([main_text(parse(h), x, t) for h, x, t in zip(*[c.to_pylist() for c in columns], strict=True)], pa.string())

    found = found.withColumnRenamed("host", "its")
    joined = pages.join(found, F.col("host").eqNullSafe(F.col("its")), "left")
    return joined.select("page_id", "url", text.asNondeterministic()(F.col("html"), F.col("low"), F.col("texts")).alias("text"))
