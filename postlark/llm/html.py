"""Main text of web pages: flat text blocks, described by their words, links and neighbours, and a decision tree over them."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.llm.html_labels import LABELLED_PAGES

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style head title noscript template svg math iframe object textarea select canvas audio video".split())
RAW = frozenset("script style title textarea noscript iframe template".split())
FOREIGN = {t: re.compile(rf"<(/?){t}(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.I) for t in ("svg", "math")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog button fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
# Hints are looked for in class tokens, ids, roles and labels one by one.
ASIDE_HINT = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|side-?bar\w*|menu\w*|nav\w*|breadcrumbs?|footer\w*|header|masthead|"
    r"cookies?\w*|consent|gdpr|notices?|notification\w*|alert\w*|popup\w*|modal\w*|overlay|subscri\w*|newsletter\w*|sign-?up|login|search\w*|"
    r"share\w*|sharing|social\w*|related\w*|recommend\w*|widgets?\w*|comments?\w*|replies|reply|respond|disqus\w*|pagination|pager|tags|"
    r"toolbar|disclaimer|copyright|legal|outbrain|taboola|toc|skip\w*|complementary|navigation|contentinfo|form)(?=$|[_-])", re.I)
CONTENT_HINT = re.compile(r"(?:^|[_-])(?:article\w*|content|post|entry\w*|story\w*|main|body-?text|prose)(?=$|[_-])", re.I)
# Tokens that say what a part is about or what state it is in, not what it is: taxonomy and state.
STATE = re.compile(r"(?:category|cat|tag|tagged|topic|format|type|status|has|no|with|without|is|hide|show)-.*|.*-(?:open|closed|on|off|enabled|disabled)", re.I)
# Content by its whole name: such a part is content inside an aside as well, and such a token outweighs a hint beside it.
CONTENT_NAME = re.compile(r"(?:article|entry|post|story)[-_]+(?:content|body|text)|(?:main|page)[-_]+content", re.I)
CONTENT_TOKEN = re.compile(r"post|hentry|article", re.I)
# What makes even an article element an aside: advertising, unless a content token stands beside it.
SOLD = re.compile(r"(?:ads?|advert\w*|adsense|sponsor\w*|promo)(?:[-_].*)?", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "place", "heading", "item")
TREE_DEPTH = 6


HARD_HINT = re.compile(r"comment|repl(?:y|ies)|respond|related|recommend", re.I)
CARDS_HINT = re.compile(r"related|recommend", re.I)
# The ids that say a role within content, by the whole: the first always, the second unless a heading of that name follows. Any
# other id there is an anchor that a heading's words gave.
ROLE_ID = re.compile(r"comments?(?:[-_]?(?:area|list|section|form))?|respond|disqus_thread|side-?bar|navbar|breadcrumbs?|"
                     r"(?:cookie|consent)[-_](?:banner|notice|bar)|newsletter[-_](?:form|signup|box)|share[-_](?:buttons|bar|links)|"
                     r"(?:related|recommended)[-_](?:posts|articles|stories|content|links|reading|pages|news|products|topics)|(?:ad|advert|promo|banner)(?:[-_]\w+)?", re.I)
PLAIN_ID = re.compile(r"newsletter|subscribe|footer|menu|nav|navigation|social|share|ads?|advert\w*|banner|promo|popup|modal|toc", re.I)
NEXT_HEADING = re.compile(r"\s*<(h[1-6])\b[^>]*>([^<]{0,200})", re.I)
PART_NAME = re.compile(r"(?:article|entry|post|story|page|section)[-_]+(?:header|main|title|body|text)", re.I)
ASIDE, HARD, UNSEEN, VEILED, CARDS, CARD = -1, -3, -2, -4, -5, -6


def _slug(words: str) -> str:
    return "-".join(re.findall(r"\w+", unescape(words).lower()))


def _place(tag: str, attributes: str, outer: int, heading: str = "") -> int:
    """1 within content, ASIDE within an aside, HARD where an aside holds what looks like articles, else 0; what stands
    nearest decides. VEILED is an aside that is not shown, out of which only an article or main element leads. Such an element
    is content whatever single words its classes hold, unless these name comments, related matter or advertising.

    Ids of headings, of sections that repeat the words of the ``heading`` that follows, and all within content are anchors
    and say nothing, unless they are a role's name as a whole. Headings within content are asides only by a class that names
    comments or related matter. CARDS is an aside of related matter; an article in it is a CARD, which is content on a page
    that has no other.
    """
    classes, ids = [], []
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style":
            if name == "hidden" or HIDDEN.search(value):
                return outer if outer in (HARD, CARDS) else VEILED
        else:
            (ids if name == "id" else classes).extend(x for x in value.split() if not STATE.fullmatch(x))
    if outer == HARD:
        return HARD
    sectional = tag == "section" or "section" in classes
    anchors = [x for x in ids if tag in HEADINGS or sectional and "-" in heading and _slug(x.replace("_", "-")) == heading]
    if outer in (1, CARD):
        anchors += [x for x in ids if not PLAIN_ID.fullmatch(x) or x.lower() == heading]
    roles = [x for x in ids if ROLE_ID.fullmatch(x) or x not in anchors]
    hints = classes + roles
    named = [PART_NAME.sub("content", x) for x in hints]
    own = any(CONTENT_TOKEN.fullmatch(x) or CONTENT_NAME.fullmatch(x) for x in hints)
    aside = [x for x in named if ASIDE_HINT.search(x)] if tag not in ("html", "body") else []
    if tag in HEADINGS and outer in (1, CARD):
        aside = [x for x in aside if HARD_HINT.search(x)]
    if tag in ("aside", "nav", "footer") or any(map(HARD_HINT.search, aside)) and tag != "main":
        cards = tag not in ("aside", "nav", "footer", "article") and all(CARDS_HINT.search(x) for x in aside if HARD_HINT.search(x))
        return CARDS if cards else HARD
    if outer == CARDS:
        return CARD if tag in CONTENT_TAGS else CARDS
    if tag in CONTENT_TAGS:
        return ASIDE if tag == "article" and not own and any(map(SOLD.fullmatch, aside)) else CARD if outer == CARD else 1
    if tag in ASIDE_TAGS or aside and not own:
        return VEILED if outer == VEILED else ASIDE
    if tag == "header":
        return outer if outer in (1, CARD, VEILED) else ASIDE
    if outer == 0 and any(map(CONTENT_HINT.search, named)) or outer == ASIDE and any(map(CONTENT_NAME.fullmatch, hints)):
        return 1
    return outer


def _foreign_ends(html: str, tag: str) -> tuple[dict[int, int], list[int]]:
    """For each start tag of svg or math, by where it ends, where its element ends; and where all end tags end."""
    ends, closers, opened = {}, [], []
    for m in FOREIGN[tag].finditer(html):
        if m[1]:
            closers.append(m.end())
            if opened:
                ends[opened.pop()] = m.end()
        elif not m[2].endswith("/"):
            opened.append(m.end())
    return ends, closers


class _Open:
    """The open elements, each with its place, and how many there are of each tag."""

    def __init__(self) -> None:
        self.stack: list[list] = []  # tag, place, whether inline, elements of the same tag within that are not kept
        self.counts: dict[str, int] = {}

    def push(self, tag: str, place: int, inline: bool = False) -> None:
        self.stack.append([tag, place, inline, 0])
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def pop(self) -> str:
        tag = self.stack.pop()[0]
        self.counts[tag] -= 1
        return tag

    def close(self, tag: str) -> None:
        if self.counts.get(tag):
            while self.pop() != tag:
                pass

    def ends_by_itself(self, tag: str) -> None:
        """Closes what ``tag`` ends: an open paragraph or an element of its own kind, with a hinted inline element in it."""
        while self.stack:
            top = self.stack[-1]
            under = self.stack[-2] if top[2] and len(self.stack) > 1 else top
            if under[2] or under[0] not in ("p", tag):
                return
            if under is not top:
                self.pop()
            self.pop()

    @property
    def place(self) -> int:
        return self.stack[-1][1] if self.stack else 0


def blocks(html: str) -> list[tuple[str, int, int, int, int, int]]:
    """The page's texts between block-level tags, in order: text, words, words in links, place, whether a heading, whether
    a list item. The time grows with the page's length, however deep it nests.

    An inline element never leaves its block: one whose class is a hint makes its block an aside only if nothing else stands
    there, one that is hidden is left out. Never fails: an end tag without a start is passed over, what is not closed ends with
    the page (svg and math at their first end tag, if any), a tag that the page's end cuts off is dropped.
    """
    out: list[tuple[str, int, int, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    places: set[int] = set()
    foreign: dict[str, tuple[dict[int, int], list[int]]] = {}
    opened = _Open()
    links = 0

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                in_links = len(unescape(" ".join(linked)).split())
                out.append((text, len(text.split()), in_links, max(places, default=opened.place),
                            int(any(x[0] in HEADINGS for x in opened.stack[-3:])), int(opened.counts.get("li", 0) > 0)))
            linked.clear()
        places.clear()

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        end = m.start() if m else size
        if end > at and not (opened.place == VEILED and opened.stack[-1][2]):
            parts.append(html[at:end])
            if not html[at:end].isspace():
                places.add(opened.place)
            if links:
                linked.append(html[at:end])
        if not m:
            break
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if not m[0].endswith(">"):
            break
        if not closing and tag in FOREIGN:
            if not attributes.endswith("/"):
                if tag not in foreign:
                    foreign[tag] = _foreign_ends(html, tag)
                ends, closers = foreign[tag]
                later = bisect_right(closers, at)
                at = ends.get(at) or (closers[later] if later < len(closers) else size)
            continue
        if not closing and tag in RAW:
            ended = re.compile(rf"</{tag}\b", re.I).search(html, at)
            at = (html.find(">", ended.end()) + 1 or size) if ended else size
            continue
        if tag in INLINE:
            top = opened.stack[-1] if opened.stack else None
            inside = top is not None and top[2] and top[0] == tag
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
            if tag in VOID:
                continue
            if closing and inside:
                if top[3]:
                    top[3] -= 1
                else:
                    opened.pop()
            elif not closing and inside:
                top[3] += 1
            elif not closing and attributes and opened.place in (0, 1, CARD):
                hint = _place(tag, attributes, opened.place)
                if hint < 0 and tag != "a":
                    opened.push(tag, hint, True)
            continue
        flush()
        links = 0
        if closing:
            opened.close(tag)
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") or tag in HEADINGS:
                opened.ends_by_itself(tag)
            if tag == "body":
                opened.close("head")
            if tag in UNREAD:
                opened.push(tag, UNSEEN)
            else:
                following = NEXT_HEADING.match(html, at) if "id" in attributes else None
                opened.push(tag, UNSEEN if opened.place == UNSEEN else _place(tag, attributes, opened.place, _slug(following[2]) if following else ""))
    flush()
    lone = not any(b[3] == 1 for b in out)
    seen = {0: 0, 1: 1, CARD: 1 if lone else ASIDE}
    return [(*b[:3], seen.get(b[3], ASIDE), *b[4:]) for b in out if b[3] != UNSEEN]


def described(page: list[tuple[str, int, int, int, int, int]]) -> list[list[float]]:
    """The features of each block, in the order of FEATURES."""
    sizes = [(0.0, 0.0), *((float(b[1]), b[2] / b[1]) for b in page), (0.0, 0.0)]
    return [[*sizes[i + 1], *sizes[i], *sizes[i + 2], float(b[3]), float(b[4]), float(b[5])] for i, b in enumerate(page)]


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """The small labelled table: the blocks of a few invented pages, with 1 where a block belongs to the article."""
    rows = []
    for page, article in LABELLED_PAGES:
        found = blocks(page)
        rows += [(Vectors.dense(x), float(b[0] in article)) for b, x in zip(found, described(found), strict=True)]
    return spark.createDataFrame(rows, ["features", "label"])


Node = tuple


def _node(node) -> Node:
    if node.getClass().getSimpleName() == "LeafNode":
        return (float(node.prediction()),)
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _node(node.leftChild()), _node(node.rightChild()))


def trained_tree(spark: SparkSession, depth: int = TREE_DEPTH) -> Node:
    """A decision tree trained on the labelled blocks, as nested tuples: (feature, threshold, at or below, above) or
    (label,). All labelled blocks are used; there are some two hundred, whatever the size of the corpus."""
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=3).fit(labelled_blocks(spark).coalesce(1))
    return _node(model._call_java("rootNode"))


def is_article(tree: Node, features: list[float]) -> bool:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0] > 0.5


def main_text(html: str, tree: Node) -> str:
    page = blocks(html)
    return "\n".join(b[0] for b, x in zip(page, described(page), strict=True) if is_article(tree, x))


def _extracted(batches: Iterator[pa.RecordBatch], tree: Node) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("_html")
        texts = [main_text(x.as_py() or "", tree) for x in batch.column(at)]
        keys = batch.drop_columns(["_html"])
        made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([*keys.columns, *made], names=[*keys.schema.names, "text", "n_chars"])


def extract(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """For each page its ``keys``, the main ``text`` (the article's blocks, one a line) and ``n_chars``, its code points.

    Null and empty html and pages without an article give an empty text. Character references are decoded, white space
    within a block is one space. Rows are worked on one by one, so repeated ones come out alike and each as often as it
    came in; no rows give no rows. A page of any length is read whole.
    """
    tree = trained_tree(pages.sparkSession)
    rows = pages.select(*keys, F.col(html).alias("_html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_html").schema)
    return rows.mapInArrow(lambda batches: _extracted(batches, tree), f"{kinds}, text string, n_chars bigint")
