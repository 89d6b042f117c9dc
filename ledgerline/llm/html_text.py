r"""Main text of web pages by tree scoring (operator 10).

A page is read into a light tree (implied end tags, void and raw-text
elements, stray markup tolerated). Subtrees that are furniture by element,
role or name are taken out. Every paragraph then passes points for its
length and its commas to its ancestors (whole to the parent, half to the
next, a third, ...), a container's points are discounted by the share of its
text that stands in links, and the best container and its siblings that are
not mostly links are kept.

Defined cases: null and empty pages and pages without text give an empty
text; markup that never ends runs to the end of the page; rows are read
each, repeated or not; an empty table gives an empty result; columns pass
through unchanged (the result column is ``main_text``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_batches

MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)", re.S)
HIDES = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|/|$)", re.I)
ATTR = re.compile(r"""(?<![\w:-])([a-zA-Z][\w:-]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")

# Elements by how the HTML standard lays them out.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption html body".split())
#: Start tag -> elements it ends if one is open, and where that search stops.
ENDS = {"li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
        "dd": (frozenset({"dd", "dt"}), frozenset({"dl"})),
        "dt": (frozenset({"dd", "dt"}), frozenset({"dl"})),
        "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
        "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
        "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
        "option": (frozenset({"option"}), frozenset({"select"}))}

FURNITURE = frozenset(
    "head script style title noscript template nav footer aside form button select textarea input "
    "iframe object embed svg canvas video audio menu dialog fieldset noembed noframes xmp".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar "
    "form status toolbar".split())
#: Names of furniture, as whole parts of a class or id. The plain ones mean
#: nothing else; the others count where nothing in their class or id but
#: layout words stands beside them ("share-buttons", not "share-prices").
PLAIN_NAMES = frozenset(
    "ads adv advert adverts advertisement advertisements advertising adsense dfp sponsored popup modal "
    "toolbar pager login signup rss byline breadcrumb breadcrumbs disqus footer masthead navbar navigation "
    "navmenu newsletter pagination paginator sidebar sidebars subscribe".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
FURNITURE_NAMES = PLAIN_NAMES | COMMENT_NAMES - {"reply"} | frozenset(
    "ad overlay register hidden skip tags meta banner banners consent cookie cookies cookiebar "
    "disclaimer disclaimers foot menu menus menubar nav navs notice notices notification notifications "
    "promo promos promotion promotions recommend recommended recommendation recommendations related "
    "share shares sharing sharebar sharebox social subscription subscriptions sponsor sponsors widget "
    "widgets".split())
HEADER_NAMES = frozenset("header headers topbar".split())
LAYOUT_NAMES = frozenset(
    "a area article articles aside bar block blocks body bottom box btn button buttons card cards center "
    "col column cont container content contents count desktop div element entry feed fixed float form "
    "full global group header heading holder home icon icons id inline inner item items js label large "
    "layout left link links list lists main media mid middle mini mobile module modules nav new news "
    "outer page pages pane panel part placeholder post posts pre primary primer region responsive right "
    "row rhs lhs secondary section sections side simple site slot small sticky stories story sub tab "
    "text the thread title tool tools top ui ul unit view web wrap wrapper wrappers zone".split())
#: Words beside a comment name in the containers of readers' comments.
COMMENT_LAYOUT = frozenset("area block body box container content div form inner item list section text "
                           "thread title wrap wrapper".split())
CONTENT_NAMES = frozenset("article content entry main post story text body".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RUNNING = HEADINGS | frozenset("p pre blockquote figcaption".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption".split())
START_POINTS = {"article": 10, "main": 10, "div": 5, "section": 5, "blockquote": 3, "td": 3,
                "ul": -3, "ol": -3, "dl": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "th": -5}


#: Characters of text a link in a menu inside an article has, on average.
SHORT_LINK = 15


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "size", "linked", "points")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.size = self.linked = 0
        self.points = 0.0


def parse(page: str) -> Node:
    root = Node("html", "", None)  # stands for html and body
    here, last, pos = root, 0, 0
    while m := MARKUP.search(page, pos):
        if m.start() > last:
            here.children.append(html.unescape(page[last:m.start()]))
        last = pos = m.end()
        tag = (m["tag"] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if m["end"]:
            here = _end(here, tag)
            continue
        if tag in CLOSES_P:
            here = _end(here, "p", BLOCK - {"p"})
        if tag in ENDS:
            here = _end_any(here, *ENDS[tag])
        node = Node(tag, m["attrs"], here)
        here.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(page, pos)
            pos = last = close.end() if close else len(page)
        elif tag not in VOID:
            here = node
    if last < len(page):
        here.children.append(html.unescape(page[last:]))
    return root


def _end(here: Node, tag: str, stop: frozenset = frozenset()) -> Node:
    """Leave the nearest open ``tag``, if there is one before ``stop``."""
    node = here
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        if node.tag in stop:
            break
        node = node.parent
    return here


def _end_any(here: Node, tags: frozenset, stop: frozenset) -> Node:
    node, out = here, here
    while node.parent is not None and node.tag not in stop:
        if node.tag in tags:
            out = node.parent
        node = node.parent
    return out


def _is_furniture(node: Node, inside: bool) -> bool:
    tag = node.tag
    if tag in FURNITURE:
        return True
    if tag == "header":
        return not inside
    if not node.attrs:
        return False
    for key, *values in ATTR.findall(node.attrs):
        key, value = key.lower(), "".join(values)
        if (key == "role" and value.lower() in FURNITURE_ROLES
                or key == "aria-hidden" and value.lower() == "true"
                or key == "style" and HIDES.search(value)):
            return True
    if HIDDEN.search(node.attrs):
        return True
    names = _names(node)
    if tag in ("article", "main"):
        return any(map(_of_readers, names))
    if tag in RUNNING and inside:
        return False
    if any(map(_of_furniture, names)):
        return True
    parts = frozenset().union(*names)
    return bool(parts & HEADER_NAMES) and not parts & CONTENT_NAMES and not inside


def _names(node: Node) -> list[frozenset[str]]:
    """The parts of each class and of the id, digits left out."""
    out = []
    for key, *values in ATTR.findall(node.attrs):
        if key.lower() in ("class", "id"):
            out += [frozenset(p.lower() for p in NAME_PARTS.findall(v) if not p.isdigit())
                    for v in "".join(values).split()]
    return out


def _of_furniture(parts: frozenset[str]) -> bool:
    return bool(parts & PLAIN_NAMES) or bool(parts & FURNITURE_NAMES) and parts <= FURNITURE_NAMES | LAYOUT_NAMES


def _of_readers(parts: frozenset[str]) -> bool:
    """The name of a container of readers' comments. They may write more
    than the author: no size saves it."""
    return bool(parts & COMMENT_NAMES) and parts <= COMMENT_NAMES | COMMENT_LAYOUT


def _inside_article(node: Node) -> bool:
    while node is not None:
        if node.tag in ("article", "main"):
            return True
        node = node.parent
    return False


def _measure(root: Node) -> list[Node]:
    """All nodes, parents first, with the size of their text and of the part
    of it that stands in links."""
    nodes, k = [root], 0
    while k < len(nodes):
        nodes += [c for c in nodes[k].children if not isinstance(c, str)]
        k += 1
    for node in reversed(nodes):
        node.size = node.linked = 0
        for c in node.children:
            if isinstance(c, str):
                node.size += len(" ".join(c.split()))
            else:
                node.size += c.size
                node.linked += c.linked
        if node.tag == "a":
            node.linked = node.size
    return nodes


def _prune(root: Node) -> list[Node]:
    """Take furniture out. A name alone does not condemn a subtree that
    holds an article or more than half of the page's running text, but for
    readers' comments."""
    nodes = _measure(root)
    running = sum(n.size - n.linked for n in nodes if n.tag in PARAGRAPHS)
    holds = set()
    for n in nodes:
        if n.tag in ("article", "main") and not any(map(_of_readers, _names(n))):
            p = n.parent
            while p is not None and id(p) not in holds:
                holds.add(id(p))
                p = p.parent
    queue = [(root, False)]
    while queue:
        node, inside = queue.pop()
        inside = inside or node.tag in ("article", "main")
        kept = []
        for c in node.children:
            if not isinstance(c, str):
                if _is_furniture(c, inside):
                    by_name = c.tag not in FURNITURE
                    wraps = id(c) in holds or (2 * (c.size - c.linked) > running > 0
                                               and c.tag not in PARAGRAPHS and 4 * c.linked < c.size)
                    if not (by_name and wraps) or any(map(_of_readers, _names(c))):
                        continue
                queue.append((c, inside))
            kept.append(c)
        node.children = kept
    return _measure(root)


def _points(size: int, commas: int) -> float:
    return min(1.0, size / 25) + commas + min(size / 100, 3.0)


def _own_text(node: Node) -> str:
    """Text directly in a block, through its inline elements."""
    out, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag not in BLOCK:
            stack += reversed(c.children)
    return " ".join(" ".join(out).split())


def best_container(root: Node, nodes: list[Node]) -> Node:
    scored = []
    for node in nodes:
        paragraph = node.tag in PARAGRAPHS
        if not paragraph and not (node.tag in BLOCK and any(
                isinstance(c, str) and c.strip() for c in node.children)):
            continue
        text = _own_text(node)
        if not text:
            continue
        points = _points(len(text), sum(text.count(c) for c in ",，、"))
        up, depth = (node.parent if paragraph else node), 1
        while up is not None:
            if not up.points:
                up.points = START_POINTS.get(up.tag, 0) + 1e-9
                scored.append(up)
            up.points += points / depth
            up, depth = up.parent, depth + 1
    if not scored:
        return root
    best = max(scored, key=lambda n: n.points * (1 - n.linked / n.size if n.size else 0))
    # Parts of one article belong together.
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            return up
        up = up.parent
    return best


def _menu(node: Node) -> bool:
    """A list or box that is all but links only; in an article only a list
    of short ones, since sources and references are links too."""
    if (node.tag not in ("ul", "ol", "dl", "div", "section", "table") or not node.size
            or node.linked <= 0.8 * node.size or (links := _links(node)) < 3):
        return False
    return not _inside_article(node) or node.tag in ("ul", "ol", "dl") and node.size < SHORT_LINK * links


def _links(node: Node) -> int:
    n, stack = 0, [node]
    while stack:
        for c in stack.pop().children:
            if not isinstance(c, str):
                n += c.tag == "a"
                stack.append(c)
    return n


def blocks(parts: list[Node | str]) -> list[str]:
    """Texts of the blocks in page order, white space folded."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = list(reversed(parts))
    while stack:
        c = stack.pop()
        if c is None:
            flush()
        elif isinstance(c, str):
            run.append(c)
        elif c.tag in ("br", "hr") or c.tag in BLOCK:
            if c.tag == "br":
                run.append(" ")
                continue
            flush()
            if not _menu(c):
                stack.append(None)
                stack += reversed(c.children)
        else:
            stack += reversed(c.children)
    flush()
    return out


def _title_before(root: Node, parts: list[Node | str]) -> Node | None:
    """The last h1 before the parts, in whatever box, if they have none of
    their own. One that is all but a link is the site's name."""
    own = {id(c) for c in parts if not isinstance(c, str)}
    title, seen_parts = None, False
    stack = [(root, False)]
    while stack:
        node, within = stack.pop()
        if id(node) in own:
            seen_parts = within = True
        if node.tag == "h1" and node.size:
            if within:
                return None
            if not seen_parts and 2 * node.linked < node.size:
                title = node
        stack += [(c, within) for c in reversed(node.children) if not isinstance(c, str)]
    return title


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    nodes = _prune(root)
    best = best_container(root, nodes)
    parts: list[Node | str] = [best]
    if best.parent is not None and best.tag not in ("article", "main"):
        parts = [c for c in best.parent.children if c is best or (
            c.strip() if isinstance(c, str) else 2 * c.linked < max(c.size, 1))]
    elif best.parent is not None:
        parts = [c for c in best.parent.children if c is best or (
            not isinstance(c, str) and c.tag in ("article", "h1") and 2 * c.linked < max(c.size, 1))]
    title = _title_before(root, parts)
    return "\n\n".join(blocks([title, *parts] if title else parts))


def with_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``main_text``."""
    small_batches(pages.sparkSession)
    out = pages.withColumn("main_text", F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = [main_text(h) for h in batch.column(names.index("html")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "main_text" else batch.column(k)
                 for k, n in enumerate(names)], names)

    return out.mapInArrow(run, out.schema)


def html_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    found = with_main_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))
