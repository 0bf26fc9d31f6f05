"""Main text of web pages by tree scoring.

The whole page is parsed into a tree. Subtrees that are never article text
(scripts, styles, navigation, footers, sidebars, forms, adverts, notices,
reader comments) are cut by tag, role or class and id names. Outside an article
one such word in a name is enough; inside it, and on paragraphs, headings and
sections anywhere, the whole name must be made of such words and of neutral ones
("share-buttons" goes, "share-price" and "ad-hoc" stay). Every paragraph then
passes points - one, plus its commas, plus one per 100 characters up to three - to
its parent, and every container half of its points on to its own parent; a
container's points are discounted by its link density. The best container is
widened: to the article or main element around it, if there is one, and from
there up to the outermost one, whatever stands beside it with few links is kept;
without such an element, the parts beside the best container stay if few of them
are links, and at every level above, those that also hold a long paragraph or a
heading. Beside the outermost article, only containers that score near it and
paragraphs stay. The kept blocks give the text: character references decoded,
white space inside a block one space, blocks in page order joined by an empty
line. All steps are linear in the page.

Defined results: null or empty html, or a page without any text outside the
cut parts, gives an empty text; a cut-off page is read to its end with every
element closed there; repeated rows give repeated results; only the page and
its key columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import html as H
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hirescope.llm import common as C

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">]++|['\"])*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")
BREAKS = re.compile(r"[\s ]+")

# fixed values of HTML: elements without content, with raw text, and those that make a block
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
#: an opening tag ends these open elements, up to the nearest of its scope
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
PARAGRAPH = frozenset("p pre blockquote li dd td h1 h2 h3 h4 h5 h6 figcaption".split())

# what is never main text
CUT_TAGS = frozenset("""script style noscript template title head nav footer aside form iframe svg canvas object
    button select option textarea input dialog menu""".split())
CUT_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alertdialog alert menu menubar
    toolbar form""".split())
CUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted
    banner sidebar side nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead cookie cookies
    consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup
    comment comments commentlist disqus reply replies respond share sharing social related recommended
    toolbar pagination pager widget skip login""".split())
HEADER_WORDS = frozenset({"header", "topbar"})
#: what else such a name is made of
NEUTRAL_WORDS = frozenset("""area bar block body bottom box btn button buttons col column container content count cta
    div embed fixed form frame global group header heading icon icons inner item items js label large layer left line
    link links list main module outer page panel part placeholder post posts primary right row section secondary
    section shell site slot small space sticky story stories tag tags teaser text thread title tools top unit view
    wrap wrapper zone the and by for in of on to us your all more""".split())
KEEP_TAGS = frozenset({"html", "body", "article", "main"})
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

NEAR = 0.2  # a sibling of an article with this share of the best score is kept
SEMANTIC = {"article": 25.0, "main": 10.0}
STRICT_TAGS = PARAGRAPH | {"section"}
HEADINGS = frozenset("h1 h2 h3 h4".split())
LONG = 80  # characters of a paragraph that speaks for its container


class Node:
    __slots__ = ("tag", "parent", "kids", "points", "chars", "linked", "commas", "bonus", "longest", "headed", "in_link", "in_article")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent, self.kids = tag, parent, []
        self.points = self.bonus = 0.0
        self.chars = self.linked = self.commas = self.longest = 0
        self.headed = tag in HEADINGS
        self.in_link = tag == "a" or parent is not None and parent.in_link and tag not in BLOCK
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article


def _cut(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in CUT_TAGS:
        return True
    if tag == "header" and not inside_article:
        return True
    if not attrs or tag in KEEP_TAGS:
        return False
    for name, a, b, c, bare in ATTR.findall(attrs):
        name, value = (name or bare).lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in CUT_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            if inside_article or tag in STRICT_TAGS:
                for single in value.split():
                    parts = {p.lower() for p in NAME_PARTS.findall(single)}
                    if parts & CUT_WORDS and parts <= CUT_WORDS | NEUTRAL_WORDS:
                        return True
            elif (parts := {p.lower() for p in NAME_PARTS.findall(value)}) & CUT_WORDS or parts & HEADER_WORDS:
                return True
    return False


def parse(page: str) -> Node:
    """The tree of what is not cut; leaves are (text, inside a link)."""
    root = Node("html", None)
    at, stack, cut_at = root, [root], 0  # cut_at: depth of the stack at which a cut subtree began
    pos = 0

    def text(s: str) -> None:
        if s and not cut_at:
            at.kids.append((s, at.in_link))

    places: dict[str, list[int]] = {"html": [0]}  # where in the stack each tag is open
    blocks_at = [0]  # and where blocks are

    def close(to: int) -> None:
        nonlocal at, cut_at
        for node in reversed(stack[to:]):
            places[node.tag].pop()
            if node.tag in BLOCK:
                blocks_at.pop()
        del stack[to:]
        at = stack[-1]
        if cut_at and len(stack) < cut_at:
            cut_at = 0

    def innermost(tags: frozenset | set) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def ending(tags: frozenset | set, scope: frozenset | set) -> None:
        i = innermost(tags)
        if i and i > innermost(scope):
            close(i)

    while True:
        m = TOKEN.search(page, pos)
        if m is None:
            text(page[pos:])
            return root
        text(page[pos:m.start()])
        pos = m.end()
        slash, tag, attrs = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag == "br" or tag in VOID:
                continue
            i = places[tag][-1] if places.get(tag) else 0
            # an inline end tag does not reach out of its block
            if i and (tag in BLOCK or i > blocks_at[-1]):
                close(i)
            continue
        if tag in CLOSES_P:
            if stack[blocks_at[-1]].tag == "p":  # the innermost block
                close(blocks_at[-1])
            if tag[0] == "h" and len(tag) == 2 and stack[-1].tag[:1] == "h" and len(stack[-1].tag) == 2 \
                    and stack[-1].tag[1].isdigit() and tag[1].isdigit():
                close(len(stack) - 1)
        if tag in ENDS:
            ending(*ENDS[tag])
        if tag in VOID:
            if not cut_at:
                at.kids.append(Node(tag, at) if tag == "hr" else (" ", False))
            continue
        node = Node(tag, at)
        cut = not cut_at and _cut(tag, attrs, at.in_article)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, pos)
            if end is None:
                return root
            close_at = page.find(">", end.end())
            pos = len(page) if close_at < 0 else close_at + 1
            continue
        if attrs.rstrip().endswith("/") and tag not in BLOCK:
            continue
        if not cut and not cut_at:
            at.kids.append(node)
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            blocks_at.append(len(stack))
        stack.append(node)
        at = node
        if cut:
            cut_at = len(stack)


def _walk(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        n = todo.pop()
        yield n
        todo.extend(k for k in reversed(n.kids) if isinstance(k, Node))


def _flat(s: str) -> str:
    return " ".join(H.unescape(s).split())


def blocks(node: Node) -> list[str]:
    """The texts of the blocks in page order."""
    out, run = [], []

    def flush() -> None:
        t = _flat("".join(run))
        run.clear()
        if t:
            out.append(t)

    todo: list = [node]
    while todo:
        k = todo.pop()
        if k is None:
            flush()
        elif isinstance(k, tuple):
            run.append(k[0])
        elif k.tag in BLOCK:
            flush()
            todo.append(None)
            todo.extend(reversed(k.kids))
        else:
            todo.extend(reversed(k.kids))
    flush()
    return out


def score(root: Node) -> list[Node]:
    """Give every container its points; returns the containers."""
    nodes = list(_walk(root))
    for n in reversed(nodes):  # children before parents
        for k in n.kids:
            if isinstance(k, Node):
                n.chars += k.chars
                n.linked += k.linked
                n.commas += k.commas
            else:
                size = len(k[0].strip())
                n.chars += size
                n.linked += size if k[1] else 0
                n.commas += k[0].count(",")
    for n in reversed(nodes):
        own = n.tag in PARAGRAPH or n.tag in BLOCK and any(not isinstance(k, Node) and k[0].strip() for k in n.kids)
        if own and n.chars:
            points = (1 + n.commas + min(n.chars / 100, 3)) * (1 - n.linked / n.chars)
            n.longest = max(n.longest, n.chars - n.linked)
            to = n.parent if n.tag in PARAGRAPH else n
            if to is not None:
                to.points += points
        if n.parent is not None:
            # all of its children have passed theirs; an inline element passes on what it got
            n.parent.points += n.points / 2 if n.tag in BLOCK else n.points
            n.parent.longest = max(n.parent.longest, n.longest)
            n.parent.headed |= n.headed
    boxes = [n for n in nodes if n.tag in BLOCK and n.chars]
    for n in boxes:
        n.bonus = (n.points + (SEMANTIC.get(n.tag, 0.0))) * (1 - n.linked / n.chars)
    return boxes


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    boxes = score(root)
    if not boxes:
        return "\n\n".join(blocks(root))
    best = max(boxes, key=lambda n: n.bonus)
    if best.bonus <= 0:
        return ""
    if best.tag in PARAGRAPH and best.parent is not None:
        best = best.parent
    top, inside, outer = best.bonus, None, None
    up = best
    while up is not None:
        if up.tag in SEMANTIC:
            inside, outer = inside or up, up
        up = up.parent
    best = inside or best
    # from the best container up: (what is kept of the level before it, of the level behind it)
    before, behind, node, level = [], [], best, 0
    while node.parent is not None:
        left, right = _beside(node, inside is None, node is outer, level, top)
        before.append(left)
        behind.append(right)
        if node is outer:
            break
        node, level = node.parent, level + 1
    texts = [t for side in reversed(before) for t in side] + blocks(best) + [t for side in behind for t in side]
    return "\n\n".join(texts)


def _beside(node: Node, loose: bool, outside: bool, level: int, top: float) -> tuple[list[str], list[str]]:
    """The kept texts before and behind ``node`` in its parent.

    ``loose``: there is no article element; ``outside``: ``node`` is the outermost one; ``level``: steps above the best container.
    """
    left: list[str] = []
    side, run = left, Node("div", None)

    def flush() -> None:
        """The loose text and inline elements met since the last block, if little of them is linked."""
        if run.linked * 4 < run.chars and (not (loose and level) or run.chars >= LONG):
            side.extend(blocks(run))
        run.kids, run.chars, run.linked = [], 0, 0

    for k in node.parent.kids:
        if k is node:
            flush()
            side = []
        elif not isinstance(k, Node):
            size = len(k[0].strip())
            run.kids.append(k)
            run.chars, run.linked = run.chars + size, run.linked + (size if k[1] else 0)
        elif k.tag not in BLOCK and not _has_block(k):
            run.kids.append(k)
            run.chars, run.linked = run.chars + k.chars, run.linked + k.linked
        else:
            flush()
            if not k.chars or k.linked * 4 >= k.chars:
                continue
            if outside:
                keep = k.tag in PARAGRAPH or k.bonus >= NEAR * top
            else:
                keep = not loose or not level or k.headed or k.longest >= LONG
            if keep:
                side += blocks(k)
    flush()
    return left, side


def _has_block(node: Node) -> bool:
    return any(n.tag in BLOCK for n in _walk(node))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    src = pages.select(key, url, html)
    names = [key, url, "text", "n_chars"]
    kinds = [f.dataType.simpleString() for f in src.schema.fields[:2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.chunks(batches, html, 8 << 20):
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=names)

    return src.mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, base: str) -> DataFrame:
    """The main text of every page."""
    return extract(C.read(spark, base, "pages"))
