"""Main text of web pages by composite text density.

Every element of a page has a density: its characters per tag, adjusted down by the share of its text and tags that
are links, relative to the whole body. The sum of its children's densities is high where many dense children lie
together; the element of the largest sum is the centre of the article. The least density on the way from the body
down to it is the threshold: other parts of the page count as text, too, if they reach it.

Elements that cannot be article text are left out before densities are computed: navigation, forms, scripts and others
by tag or role; lists of reader comments by their repeated structure; and elements that a class or id names as noise. A
name of several words is that of its last one that tells anything (``fb-comments`` are comments, ``related-work`` is
work). Names that also occur in articles (``notice``, ``share``) count outside of the chosen element; inside it
they only take out link lists and whole containers, not paragraphs.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("caption tbody td tfoot th thead tr body html legend".split())
#: Elements that end an open one of the same group, up to the nearest of the borders.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# Elements that hold no article text.
NO_TEXT = frozenset(
    "head script style title noscript template iframe object embed svg canvas nav aside footer form button select "
    "textarea input dialog menu noframes noembed xmp audio video".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
# Names of page parts that are never article text, and of those that may also stand for something in an article.
SURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sidebar nav navbar navigation "
    "breadcrumb breadcrumbs comment comments replies disqus cookie cookies gdpr newsletter subscribe signup login popup "
    "modal toolbar pagination pager masthead".split())
VAGUE_NAMES = frozenset(
    "promo promotion banner menu footer reply consent notice notices subscription overlay share sharing social related "
    "recommended recommendations widget copyright disclaimer alert skip feedback responses reactions".split())
# Words of a name that tell nothing about what is in the element.
NEUTRAL = frozenset(
    "area article articles bar block body bottom box button buttons container content entry holder inner item items left "
    "links list main message news outer page panel post posts right row section site slot stories story text title top "
    "unit user wrap wrapper".split())
#: A name that begins so tells a state of the page, not what the element is.
STATES = frozenset("has with without no not is".split())
#: Names of lists of records that may be written by readers.
TALK = frozenset("discussion discussions conversation conversations thread threads opinions readers guestbook".split())
# Headings of an article; smaller ones may hold the name of a writer.
HEADINGS = frozenset(["h1", "h2", "h3"])
CONTAINERS = frozenset("div section article ul ol dl li table tbody tr td figure details fieldset center main".split())
MAIN = frozenset(["article", "main"])
#: A line that says who wrote a comment has so many characters at most.
BYLINE = 60

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([^\s/>]+)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_MAY_ROLE = re.compile(r"\s(?:class|id|role|hidden|style|aria-hidden)\b", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "parts", "role", "chars", "tags", "link_chars", "link_tags", "density", "total", "own", "names", "whole",
                 "headed", "dated", "first")

    def __init__(self, tag: str, parent: Node | None, role: str = "", names: tuple[str, ...] = ()):
        self.tag, self.parent, self.role, self.names = tag, parent, role, names
        self.children: list[Node] = []
        self.parts: list = []  # texts and elements in order
        self.whole: list = []  # the same with elements of vague names that stay inside the chosen element
        self.own = 0  # characters of its texts, white space apart


def parse(source: str) -> Node:
    """The element tree of a page; open ends, missing end tags and stray ones are allowed."""
    root = Node("html", None)
    here, at, stop = root, 0, len(source)
    opened: Counter = Counter()  # elements around this place, by tag: what is not there need not be searched

    def leave(node: Node) -> Node:
        """Close all elements up to this one; its parent."""
        last = here
        while last is not node:
            opened[last.tag] -= 1
            last = last.parent
        opened[node.tag] -= 1
        return node.parent

    while at < stop:
        m = _TOKEN.search(source, at)
        text = source[at:m.start() if m else stop]
        if text:
            if "&" in text:
                text = html.unescape(text)
            here.parts.append(text)
            here.own += len("".join(text.split()))
        if not m:
            break
        at, token = m.end(), m[0]
        if token[1] in "!?" or not token.endswith(">"):
            continue
        tag = _NAME.match(token)[1].lower()
        if token[1] == "/":
            if opened[tag]:
                node = here
                while node.tag != tag:
                    node = node.parent
                here = leave(node)
            elif tag == "br":
                here.parts.append(" ")
            continue
        if tag == "html":
            continue
        if tag == "br":
            here.parts.append(" ")
            continue
        if tag in ENDS_P and opened["p"]:
            node = here
            while node is not root and node.tag not in ("p", "button", "table", "td", "th", "caption", "object"):
                node = node.parent
            if node.tag == "p":
                here = leave(node)
        if tag in SIBLINGS:
            same, border = SIBLINGS[tag]
            node = here if any(opened[t] for t in same) else root
            while node is not root and node.tag not in same and node.tag not in border:
                node = node.parent
            if node.tag in same:
                here = leave(node)
        if here.tag == "head" and tag in BLOCK:
            here = leave(here)
        node = Node(tag, here, *(_role(token) if _MAY_ROLE.search(token) else ()))
        here.children.append(node)
        here.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = end.start() if end else stop
            if end:
                close = source.find(">", at)
                at = close + 1 if close >= 0 else stop
        elif tag not in VOID and not (token.endswith("/>") and tag in ("svg", "path")):
            here = node
            opened[tag] += 1
    return root


def _role(token: str) -> tuple[str, tuple[str, ...]]:
    """``never`` for hidden elements and roles without article text, else what the names say; and the names."""
    names: list[str] = []
    for key, *values in _ATTRIBUTE.findall(token):
        key, value = key.lower(), html.unescape(next((v for v in values if v), ""))
        if key in ("class", "id"):
            names += _HUMP.sub("-", value).lower().split()
            continue
        value = value.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "never", ()
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "never", ()
        if key == "role" and value.strip() in NO_TEXT_ROLES:
            return "never", ()
    found = {_meaning(name) for name in names}
    return next((m for m in ("sure", "vague", "partly") if m in found), ""), tuple(names)


def _meaning(name: str) -> str:
    """What one name says: ``sure`` noise, ``vague`` if all its words are noise or tell nothing, ``partly`` if a
    vague word ends a name of others, else empty."""
    words = [w for w in re.split(r"[_-]+", name) if w]
    if not words or words[0] in STATES:
        return ""
    telling = [w for w in words if w not in NEUTRAL and not w[0].isdigit()]
    if not telling or telling[-1] not in SURE_NAMES | VAGUE_NAMES:
        return ""
    noise = all(w in SURE_NAMES or w in VAGUE_NAMES for w in telling)
    if telling[-1] in SURE_NAMES or noise and SURE_NAMES.intersection(telling):
        return "sure"
    return "vague" if noise else "partly"


def _reader_comments(node: Node) -> bool:
    """Whether most text of a container is records of one make, each a short line of its writer without a heading and
    then a longer text, that carry a time or an answer button, or whose container is named after talk."""
    if node.tag not in CONTAINERS or not node.chars:
        return False
    makes: dict[tuple, list[Node]] = {}
    for child in node.children:
        if child.tag in CONTAINERS and child.chars:
            makes.setdefault((child.tag, child.names), []).append(child)
    if not makes:
        return False
    records = max(makes.values(), key=lambda group: sum(r.chars for r in group))
    if len(records) < 2 or 5 * sum(r.chars for r in records) < 4 * node.chars:
        return False
    talk = any(TALK.intersection(re.split(r"[_-]+", name)) for n in (node, records[0]) for name in n.names)
    return all((r.dated or talk) and _signed(r) for r in records)


def _signed(record: Node) -> bool:
    line = record.first
    return (not record.headed and line is not None and line.tag not in ("p", "li", "td") and line.chars <= BYLINE
            and 2 * line.chars < record.chars)


def _survey(nodes: list[Node]) -> None:
    """What the elements inside each one show: a heading, a time or button, and the first one with a text of its own."""
    for node in reversed(nodes):
        node.headed = any(c.headed or c.tag in HEADINGS and c.chars > 0 for c in node.children)
        node.dated = any(c.dated or c.tag == "time" or c.tag == "button" and c.own for c in node.children)
        node.first = next((c if c.own else c.first for c in node.children if c.own or c.first is not None), None)


def _prune(root: Node, whole: int) -> None:
    """Take out what holds no article text. Neither names nor structure count on an element with over half of it."""
    todo = [(root, False)]
    while todo:
        node, inside_main = todo.pop()
        keep: list = []
        node.whole = []
        for part in node.parts:
            if isinstance(part, Node):
                main = inside_main or part.tag in MAIN
                if part.tag in NO_TEXT or part.role == "never" or part.tag == "header" and not main:
                    continue
                if 2 * part.chars <= whole and part.tag not in ("body", "main"):
                    if part.role == "sure" or _reader_comments(part):
                        continue
                    if part.role:
                        if 2 * part.link_chars <= part.chars and (part.role == "partly" or part.tag not in CONTAINERS):
                            node.whole.append(part)
                            todo.append((part, main))
                        continue
                todo.append((part, main))
            keep.append(part)
            node.whole.append(part)
        node.parts = keep
        node.children = [p for p in keep if isinstance(p, Node)]


def _walk(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.children)
    return out


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        node.chars = node.own
        node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.link_tags += child.link_tags + (child.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars


def _density(node: Node, body: Node) -> float:
    """Characters per tag, times a logarithm that falls with the part of links; its base grows with the links of the
    element and of the body, and never raises the value."""
    c, t, links, link_tags = node.chars, node.tags or 1, node.link_chars, node.link_tags
    if not c:
        return 0.0
    base = math.log(c / max(1, c - links) * links + body.link_chars / body.chars * c + math.e)
    ratio = c / max(1, links) * t / max(1, link_tags)
    return c / t * math.log(max(1.0, ratio)) / max(1.0, math.log(base))


def _blocks(node: Node, wanted, whole: bool, out: list[str], line: list[str]) -> None:
    """The text of the wanted elements, block by block; ``whole``: with their elements of vague names."""
    stack = [(node, iter(node.parts), node in wanted)]
    while stack:
        here, parts, use = stack[-1]
        part = next(parts, None)
        if part is None:
            stack.pop()
            if here.tag in BLOCK:
                _end(out, line)
        elif isinstance(part, str):
            if use:
                line.append(part)
        else:
            if part.tag in BLOCK:
                _end(out, line)
            inside = use or part in wanted
            stack.append((part, iter(part.whole if inside and whole else part.parts), inside))


def _end(out: list[str], line: list[str]) -> None:
    text = " ".join("".join(line).split()) if line else ""
    line.clear()
    if text:
        out.append(text)


def _marked(best: Node, body: Node) -> Node | None:
    """The article or main element around the best one, or else one inside it that has most of its text and is, with the
    elements around it, the only one with text: then the sum of the best one is nothing but its density."""
    node = best
    while node is not body and node.tag not in MAIN:
        node = node.parent
    if node.tag in MAIN:
        return node
    node = best
    while node.tag not in MAIN:
        inner = [child for child in node.children if child.chars]
        if len(inner) != 1 or 2 * inner[0].chars <= best.chars:
            return None
        node = inner[0]
    return node


def main_text(source: str | None) -> str:
    """The article of a page: blocks in page order, one a line; empty if there is none.

    White space inside a block is one space, a line break as well. Text of the element with the largest density sum
    (or the article or main element around it) is taken whole; elsewhere the largest-sum part of every element that
    reaches the threshold, marked article or not.
    """
    if not source:
        return ""
    root = parse(source)
    bodies = [n for n in _walk(root) if n.tag == "body"]
    body = bodies[0] if bodies else root
    nodes = _walk(body)
    _measure(nodes)
    _survey(nodes)
    _prune(body, body.chars)
    nodes = _walk(body)
    _measure(nodes)
    if not body.chars:
        return ""
    for node in reversed(nodes):
        node.density = _density(node, body)
        node.total = sum(child.density for child in node.children)
    best = max(nodes, key=lambda n: n.total)
    path, node = [best.density], best
    while node is not body:
        node = node.parent
        path.append(node.density)
    threshold = min(path)
    main = _marked(best, body)
    # Around a marked article, the elements that hold it are not taken whole; all other parts that are as dense count.
    around, node = set(), main
    while node is not None and node is not body:
        node = node.parent
        around.add(node)
    top: dict[Node, Node] = {}
    for n in reversed(nodes):
        top[n] = max([n, *(top[c] for c in n.children)], key=lambda x: x.total)
    wanted = {main or best} | {top[n] for n in nodes if n not in around and n.density >= threshold and n.chars}
    out: list[str] = []
    line: list[str] = []
    # With the body chosen, an element of a vague name may lie anywhere on the page.
    _blocks(body, wanted, (main or best) is not body, out, line)
    _end(out, line)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row; null and empty pages have an empty
    text. Rows are worked on where they are read; each is its own, so repeated rows, null ids and addresses and
    further columns make no difference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")
