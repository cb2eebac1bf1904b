"""Main text of web pages by scores on the tree of elements.

Every paragraph earns points for its length and its commas and passes them to its ancestors: all
to the parent, half to the next, and a third of the depth's share beyond. A container's points
are discounted by the share of its letters that stand in links. The container with the most
points is the article; its siblings stay when they score near it or are plain prose themselves.

Elements that are never article text (navigation, scripts, …) are left out, at any depth. A form,
or an element whose class, id or role names a part beside the article, is left out if it holds
under half of the page's points, or if there is prose enough outside all such parts: one paragraph
beside reader comments, two beside others. The page's own container, with nothing much outside,
only scores lower, and so does a form that wraps the page. A word of the article as a whole class or id ("post tag-legal")
overrules the others, and "has-sidebar" or "tag-legal" tell of something else than the element. If
all text would go, these elements stay. Lists and tables that are mostly links go, but for those that
follow prose of the article in the same container. Within a block white space is one space; blocks are joined
in page order by line feeds.

Each page is parsed alone with bounded state, in one pass over its tags, so malformed or very long
pages neither fail nor grow beyond their own size. Null, empty and text-free pages have an empty
text. Equal rows get equal texts, an empty table an empty result; columns of the input with the
name of a result are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.cluster import prepare
from stardw.llm.frames import others
from stardw.llm.words import blocks

# Element names by their role on a page.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu
nav ol p pre search section summary table tbody td tfoot th thead tr ul caption""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
SKIPPED = frozenset("""head script style noscript template iframe svg math canvas object audio video
nav footer aside button select textarea input label menu dialog search title""".split())
PARAGRAPHS = frozenset("p pre td li dd blockquote h1 h2 h3 h4 h5 h6 figcaption".split())
# Closed by the start of another of the same group, up to the container that holds both.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
          "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
          "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
# Words of class, id or role that name a part beside the article.
BESIDE = frozenset("""ad ads adv advert adverts advertisement advertising adbox banner sponsor
sponsored promo promotion popup modal overlay cookie cookies consent gdpr notice notices alert
newsletter subscribe subscription signup login sidebar aside rail widget widgets nav navbar
navigation menu menus breadcrumb breadcrumbs pager pagination toc footer foot header masthead
topbar toolbar comment comments commentlist disqus discussion replies reply respond feedback
share sharing social related recommended recommendations trending popular tags tagcloud author-box
skip search searchbox form hidden print-only copyright legal disclaimer outbrain taboola""".split())
ARTICLE = frozenset("article main content post entry story body text articlebody".split())
# First parts of a class that tell what the element has or is filed under, not what it is.
TELLS = frozenset("has with no without not hide show tag category cat type format layout is".split())
# Of a heading these words say what it is.
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADS = frozenset("header masthead".split())
# "entry-header" is the head of the entry, not of the page.
HEADED = frozenset("article entry post story".split())
# Words of reader comments.
COMMENTS = frozenset("comment comments commentlist disqus discussion replies reply respond".split())
# Letters of a paragraph that is prose, and paragraphs of prose outside that make a part one beside.
PROSE = 60
BESIDE_COMMENTS, BESIDE_OTHERS = 1, 2
# An element beside the article holds less than this share of the points; others score so much lower.
MINOR, LOWERED = 0.5, 0.75

_TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?][^>]*>|"
                  r"(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.DOTALL)
_LABEL = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""",
                     re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "beside", "named", "points", "letters", "linked", "depth", "link",
                 "suspect", "comments", "weight")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or (parent.link if parent else False)
        self.points, self.letters, self.linked = 0.0, 0, 0
        self.weight = 0.0
        whole: set[str] = set()
        parts: set[str] = set()
        headed = False
        if attributes:
            for found in _LABEL.finditer(attributes):
                for label in (found[1] or found[2] or found[3] or "").lower().split():
                    whole.add(label)
                    split = re.split(r"[_-]+", label)
                    if len(split) == 1 or split[0] not in TELLS:
                        if HEADED & set(split) and HEADS & set(split):
                            headed = True
                            split = set(split) - HEADS
                        parts.update(split)
        self.named = bool((whole | parts) & ARTICLE) and not headed or tag in ("article", "main")
        beside = (whole | parts) & BESIDE
        if tag in HEADING:
            beside -= HEADS
        self.suspect = tag == "form" or (bool(beside) and not whole & ARTICLE and tag not in (
            "html", "body", "article", "main"))
        self.comments = self.suspect and bool(beside & COMMENTS)
        inside = parent is not None and parent.beside
        self.beside = inside or tag in SKIPPED or (
            tag not in ("html", "body", "article", "main")
            and bool(attributes and _HIDDEN.search(attributes))
        ) or (tag == "header" and not headed and not self.within_article())

    def within_article(self) -> bool:
        at = self.parent
        while at:
            if at.named:
                return True
            at = at.parent
        return False


Pieces = list[tuple[Node, str]]


def parse(page: str) -> tuple[list[Node], list[tuple[Node, Pieces]]]:
    """Elements in page order, and the blocks: the block element each stands in, and its pieces
    of text with their elements."""
    root = at = Node("html", None)
    nodes, texts = [root], []
    pieces: Pieces = []
    holder = root

    def end_block() -> None:
        if pieces:
            texts.append((holder, pieces.copy()))
            pieces.clear()

    def add(text: str) -> None:
        if not at.beside and text:
            pieces.append((at, text))

    pos, size = 0, len(page)
    while pos < size:
        found = _TAG.search(page, pos)
        if not found:
            add(page[pos:])
            break
        add(page[pos:found.start()])
        pos = found.end()
        name = found[4]
        if name is None:
            if found[2]:
                add(html.escape(found[2]))
            continue
        name = name.lower()
        if found[3]:
            up = at
            while up and up.tag != name:
                if name not in BLOCKS and up.tag in BLOCKS:
                    up = None  # an inline end tag doesn't close blocks
                    break
                up = up.parent
            if name in BLOCKS:
                end_block()
            if up and up.parent:
                at = up.parent
            if name in BLOCKS:
                holder = _block(at)
            continue
        if name == "br":
            add(" ")
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, pos)
            tail = page.find(">", close.start()) if close else -1
            pos = tail + 1 if tail >= 0 else size
            continue
        if name in BLOCKS:
            end_block()
            up = at
            while up and up.tag in ("a", "b", "i", "em", "strong", "span", "font", "u", "p", "small"):
                if up.tag == "p":
                    at = up.parent or root
                    break
                up = up.parent
            if name in CLOSES:
                same, limit = CLOSES[name]
                up = at
                while up and up.tag not in limit:
                    if up.tag in same:
                        at = up.parent or root
                    up = up.parent
        if name in ("html", "body") and name == "html":
            continue
        node = Node(name, at, found[5])
        if name in BLOCKS:
            holder = node
        if name in VOID or found[5].endswith("/") and name not in BLOCKS:
            if name in BLOCKS:
                holder = _block(at)
            continue
        nodes.append(node)
        at = node
    end_block()
    return nodes, texts


def _block(node: Node) -> Node:
    while node.parent and node.tag not in BLOCKS:
        node = node.parent
    return node


def _inside(node: Node | None, top: Node) -> bool:
    while node and node.depth > top.depth:
        node = node.parent
    return node is top


def _text(pieces: Pieces) -> str:
    return _SPACE.sub(" ", html.unescape("".join([t for _, t in pieces]))).strip()


def _points(text: str) -> float:
    return 1 + text.count(",") + text.count("،") + text.count("、") + min(len(text) / 100, 3.0)


def _is_prose(holder: Node, pieces: Pieces, text: str) -> bool:
    """A paragraph of some length that is not mostly links."""
    if holder.tag not in PARAGRAPHS or len(text) < PROSE:
        return False
    linked = sum(len(t) for at, t in pieces if at.link)
    return linked < 0.25 * sum(len(t) for _, t in pieces)


def _without_minor_parts(nodes: list[Node], blocks_: list[tuple[Node, Pieces]],
                         ) -> list[tuple[Node, Pieces]]:
    """The blocks outside suspect elements of a minor share of the points; marks those elements."""
    total = 0.0
    doubtful = {nodes[0]: False}
    for node in nodes[1:]:
        doubtful[node] = doubtful[node.parent] or node.suspect
    prose = 0
    for holder, pieces in blocks_:
        text = _text(pieces)
        if text:
            prose += _is_prose(holder, pieces, text) and not any(doubtful[p] for p, _ in pieces)
            points, size = _points(text), sum(len(t) for _, t in pieces)
            total += points
            for node, piece in pieces:
                node.weight += points * len(piece) / size
    for node in reversed(nodes):
        if node.parent:
            node.parent.weight += node.weight
    minor = {nodes[0]: False}
    for node in nodes[1:]:
        enough = BESIDE_COMMENTS if node.comments else BESIDE_OTHERS
        minor[node] = minor[node.parent] or node.suspect and (
            node.weight < MINOR * total or prose >= enough and node.tag != "form")
    left = [(holder, [p for p in pieces if not minor[p[0]]]) for holder, pieces in blocks_]
    if not any(_text(pieces) for _, pieces in left):
        return blocks_
    for node in nodes:
        node.beside = node.beside or minor[node]
    return left


def main_text(page: str) -> str:
    """The text of the best container of ``page`` and of the siblings that belong to it."""
    nodes, blocks_ = parse(page)
    if any(node.suspect for node in nodes):
        blocks_ = _without_minor_parts(nodes, blocks_)
    filled = [(holder, pieces, text) for holder, pieces in blocks_ if (text := _text(pieces))]
    texts = [(holder, text) for holder, _, text in filled]
    # By container: its first block of prose.
    first_prose: dict[Node, int] = {}
    for i, (holder, pieces, text) in enumerate(filled):
        if holder.parent and holder.parent.tag != "body" and _is_prose(holder, pieces, text):
            first_prose.setdefault(holder.parent, i)
    for _, pieces in blocks_:
        for at, text in pieces:
            if not text.isspace():
                n, up = len(text.strip()), at
                while up and up.tag not in BLOCKS:
                    up = up.parent
                up = up or nodes[0]
                up.letters += n
                if at.link:
                    up.linked += n
    for holder, text in texts:
        points = _points(text)
        up, step = holder.parent if holder.tag in PARAGRAPHS and holder.parent else holder, 0
        while up:
            up.points += points / (1, 2)[step] if step < 2 else points / (3 * step)
            up, step = up.parent, step + 1
    for node in reversed(nodes):  # letters of an element include those below it
        if node.parent:
            node.parent.letters += node.letters
            node.parent.linked += node.linked

    def plain(node: Node) -> float:
        return 1 - node.linked / node.letters if node.letters else 1.0

    def score(node: Node) -> float:
        lowered = LOWERED if node.suspect and node.tag != "form" else 1.0
        return (node.points + (25 if node.named else 0)) * plain(node) * lowered

    scored = [n for n in nodes if n.points and not n.beside]
    if not scored:
        return ""
    best = max(scored, key=score)
    tops = [best]
    if best.parent and best.tag != "body":
        for node in nodes:
            if node.parent is best.parent and node is not best and not node.beside and node.letters:
                near = score(node) >= max(10, 0.2 * score(best))
                prose = node.tag in PARAGRAPHS and node.letters > 80 and plain(node) > 0.75
                if near or prose:
                    tops.append(node)

    def listed(i: int, node: Node, top: Node) -> bool:
        """Whether a block stands in a list or table that is mostly links and follows no prose."""
        while node is not top and node.parent:
            if node.tag in ("ul", "ol", "table", "dl") and plain(node) < 0.5:
                return first_prose.get(node.parent, i) >= i
            node = node.parent
        return False

    kept = []
    for i, (holder, text) in enumerate(texts):
        top = next((t for t in tops if _inside(holder, t)), None)
        if top and not listed(i, holder, top):
            kept.append(text)
    return "\n".join(kept)


def _extractor(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, column):
            texts = [main_text(page or "") for page in batch.column(column).to_pylist()]
            kept = [n for n in batch.schema.names if n != column]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"])
    return run


def extract(pages: DataFrame, *, column: str = "html") -> DataFrame:
    """``pages`` without the markup, with ``text`` and ``n_chars``."""
    prepare(pages.sparkSession)
    kept = others(pages, (column, "text", "n_chars"))
    rows = pages.select(*kept, F.col(column).cast("string").alias(column))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != column]
    return rows.mapInArrow(_extractor(column), ", ".join([*types, "text string", "n_chars long"]))


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages)


QUERIES = {"op6_html_extraction": op6_html_extraction}
