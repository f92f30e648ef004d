"""Main text of web pages, by wrappers learned from pages of the same host.

A page becomes a small tree: block elements only, runs of like siblings folded into one node. The
host's commonest tree is its reference. Every page's tree is aligned with it by simple tree matching
(nodes match if they and their ancestors have equal labels; the matching keeps the order and is as
large as can be). Texts of aligned nodes are counted over all pages of the host: a node whose text
is mostly the same is template, one whose text varies is a slot. The innermost container of most slot
text is where the host keeps its articles; pages give the text of the node aligned with it, without
the texts of template nodes in it where they are the host's commonest.

Counts are sums by host, node and text, added up map-side, so a host with a third of all pages is
no more work for one task than others. What is known of a host is its reference tree and one row for
each of its nodes. The joins to pages are plain equi-joins on the host with one row a host.
"""

from __future__ import annotations

import html as entities
import re
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle

#: A node's text is template if it is the same on more than this share of at least so many pages.
SAME_SHARE = 0.6
LEAST_PAGES = 3
#: The container holds at least this share of all slot text.
SLOT_SHARE = 0.8
#: Pairs of children up to which all steps of a matching are held; larger ones are halved first, with
#: the same result in size.
HELD_PAIRS = 4096
#: Nodes of remembered alignments; changes no result.
REMEMBERED_NODES = 400_000

# fixed values: kinds of HTML elements
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
         "track", "wbr"}
_CONTAINERS = {"html", "body", "div", "section", "article", "main", "table", "tbody", "tr", "td"}
_BLOCKS = _CONTAINERS | {
    "address", "aside", "blockquote", "caption", "center", "dd", "details", "dialog", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hr", "li", "menu", "nav", "ol", "p", "pre", "summary", "tfoot", "th", "thead", "ul"}
_DROPPED = _RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "menu",
                   "dialog", "svg", "canvas", "object", "audio", "video", "option", "datalist"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold others; only what such an element is called can say that it is no content. A
#: heading, a paragraph or part of a line is never judged by its name.
_NAMED = _CONTAINERS - {"tr", "td", "tbody", "main"} | _RAW | {
    "aside", "center", "details", "dialog", "dl", "fieldset", "figure", "footer", "form", "header",
    "menu", "nav", "ol", "ul"}
_ARTICLES = {"article", "main"}
_CLOSED_BY_ARTICLE = {"nav", "header", "footer", "aside", "form", "menu", "head"}
# fixed values: what elements that are no content are called
_NOISE = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup sidebar side menu nav navbar navigation breadcrumb breadcrumbs topbar header masthead "
    "footer foot comment comments disqus replies respond share sharing social related recommended "
    "pager pagination login search skip".split())
_NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert",
                "dialog", "menu", "menubar", "form"}

_PIECE = re.compile(
    r"(?P<gone><!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z))"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|(?P<cut><[a-zA-Z/][^>]*\Z)|(?P<text>[^<]+|<)", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+|\d+")
_ARTICLE_NODE = re.compile(r":(?:article|main)(?:[. ]|\Z)")


@dataclass(slots=True)
class Node:
    label: str
    parent: "Node | None" = None
    kids: list["Node"] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    number: int = -1
    article: bool = False


@dataclass
class Page:
    root: Node
    nodes: list[Node]
    #: node, its text, whether it lies in an element that is no content
    blocks: list[tuple[Node, str, bool]]


def _names(rest: str) -> tuple[str, bool]:
    """The first class of a tag, numbers hidden, and whether its names say it is no content."""
    first, noise = "", False
    for name, *values in _NAMES.findall(rest):
        value = (values[0] or values[1] or values[2]).lower()
        if name.lower() == "role":
            noise |= value in _NOISE_ROLES
            continue
        if name.lower() == "class" and value.split():
            first = re.sub(r"\d+", "0", re.sub(r"[^\w-]", "", value.split()[0]))
        noise |= any(w in _NOISE for w in _WORDS.findall(value))
    return first, noise


def parse(text: str | None) -> Page:
    """Read a page leniently: unclosed and stray tags, cut ends and bare < are all right."""
    text = text or ""
    root = Node("page")
    here = root
    # open elements: tag, node to go back to, what it adds to ``dropping``
    stack: list[tuple[str, Node, int]] = []
    dropping = 0
    blocks: list[tuple[Node, str, bool]] = []
    pending: list[str] = []

    def flush() -> None:
        if pending:
            joined = " ".join("".join(pending).split())
            pending.clear()
            if joined:
                blocks.append((here, joined, dropping > 0))

    def close(depth: int) -> None:
        """Leave all elements that are open above ``depth``."""
        nonlocal here, dropping
        flush()
        while len(stack) > depth:
            _, here, dropped = stack.pop()
            dropping -= dropped

    at = 0
    while True:
        found = _PIECE.match(text, at)
        if not found:
            break
        at = found.end()
        piece = found["text"]
        if piece is not None:
            pending.append(entities.unescape(piece) if "&" in piece else piece)
            continue
        tag = found["tag"] or found["tag2"]
        if not tag:
            continue  # comments, declarations, a tag that the page's end cuts off
        tag = tag.lower()
        if found["close"] or found["close2"]:
            if tag == "p" and not any(t == "p" for t, _, _ in stack):
                flush()
            # an end tag does not reach out of a table cell, nor an inline one out of a block
            for depth in range(len(stack) - 1, -1, -1):
                open_tag = stack[depth][0]
                if open_tag == tag:
                    if tag in _BLOCKS or stack[depth][2]:
                        close(depth)
                    else:
                        stack.pop(depth)
                    break
                if open_tag in _BLOCKS and tag not in _BLOCKS:
                    break
            continue
        rest = found["rest"] or found["rest2"] or ""
        if tag == "br":
            pending.append(" ")
            continue
        if tag in _RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(text, at)
            at = end.start() if end else len(text)
            if end:
                at = text.find(">", at) + 1 or len(text)
            if tag in ("textarea", "iframe"):
                pending.append(" ")
            continue
        first, noise = _names(rest) if rest and "=" in rest else ("", False)
        dropped = int(tag in _DROPPED or noise and tag in _NAMED and tag not in ("html", "body"))
        if tag in _HEADINGS and dropping == 1 and any(t == "header" and d for t, _, d in stack) \
                and any(t in _ARTICLES for t, _, _ in stack):
            dropped = -1  # an article's own header keeps its headings
        outermost = tag in _ARTICLES and not dropped and not any(t in _ARTICLES for t, _, _ in stack)
        if tag in _BLOCKS:
            if outermost:  # no article lies in a menu: its end tag is missing
                for depth, (open_tag, _, _) in enumerate(stack):
                    if open_tag in _CLOSED_BY_ARTICLE:
                        close(depth)
                        break
            elif tag == "body":
                close(next((k for k, s in enumerate(stack) if s[0] == "head"), len(stack)))
            for depth in range(len(stack) - 1, -1, -1):  # end tags that may be left out
                open_tag = stack[depth][0]
                if open_tag == "p" or open_tag == tag and tag in ("li", "dd", "dt", "tr", "td", "th"):
                    close(depth)
                    break
                if open_tag in _BLOCKS and open_tag != "p":
                    break
            flush()
            if tag == "hr":
                continue
            if outermost:  # nor does the name of what holds it say that it is no content
                dropped = -dropping
            label = f"{tag}.{first}" if first else tag
            last = here.kids[-1] if here.kids else None
            if last is not None and last.label == label and (tag not in _CONTAINERS or first):
                node = last
            else:
                node = Node(label, here)
                here.kids.append(node)
            node.article |= outermost
            stack.append((tag, here, dropped))
            here = node
            dropping += dropped
        elif tag not in _VOID and not rest.endswith("/"):
            if dropped:
                flush()
            stack.append((tag, here, dropped))
            dropping += dropped
    close(0)
    nodes: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        node.number = len(nodes)
        nodes.append(node)
        todo += reversed(node.kids)
    return Page(root, nodes, blocks)


def skeleton(page: Page) -> str:
    """The tree as text: depth and label of each node, in page order."""
    depth = {}
    out = []
    for node in page.nodes:
        depth[node.number] = depth[node.parent.number] + 1 if node.parent else 0
        out.append(f"{depth[node.number]}:{node.label}")
    return " ".join(out)


Tree = tuple[list[str], list[list[int]], list[int]]  # labels, children, parents


def tree_of(text: str) -> Tree:
    labels: list[str] = []
    kids: list[list[int]] = []
    parents: list[int] = []
    open_nodes: list[int] = []
    for k, item in enumerate(text.split(" ")):
        depth, label = item.split(":", 1)
        del open_nodes[int(depth):]
        labels.append(label)
        kids.append([])
        parents.append(open_nodes[-1] if open_nodes else -1)
        if open_nodes:
            kids[open_nodes[-1]].append(k)
        open_nodes.append(k)
    return labels, kids, parents


def _last_row(weights: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """The weight of a heaviest matching of all ``xs`` with the first 0, 1, 2, ... of ``ys``."""
    row = np.zeros(len(ys) + 1, np.int64)
    for x in xs:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights[x, ys]))
    return row


def heaviest(weights: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> list[tuple[int, int]]:
    """Places in ``xs`` and ``ys`` of a heaviest matching that keeps the order; ``weights`` by kind."""
    if not len(xs) or not len(ys):
        return []
    if len(xs) > 1 and len(xs) * len(ys) > HELD_PAIRS:
        half = len(xs) // 2
        cut = int(np.argmax(_last_row(weights, xs[:half], ys)
                            + _last_row(weights, xs[half:][::-1], ys[::-1])[::-1]))
        return heaviest(weights, xs[:half], ys[:cut]) \
            + [(half + i, cut + j) for i, j in heaviest(weights, xs[half:], ys[cut:])]
    own = weights[np.ix_(xs, ys)].tolist()
    size = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, line in enumerate(own):
        for j, w in enumerate(line):
            size[i + 1][j + 1] = max(size[i][j + 1], size[i + 1][j], size[i][j] + w)
    pairs, i, j = [], len(xs), len(ys)
    while i and j:
        w = own[i - 1][j - 1]
        if w and size[i][j] == size[i - 1][j - 1] + w:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif size[i][j] == size[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def align(page: Tree, reference: Tree) -> dict[int, int]:
    """Simple tree matching: pairs of nodes of a largest order-keeping, top-down matching.

    Equal subtrees are one shape. Shapes are compared once, equal ones at the ends of two rows of
    children are paired at once (no matching is larger), so long tables take little work.
    """
    numbers: dict[tuple, int] = {}
    shapes: list[tuple[str, tuple[int, ...]]] = []  # label, shapes of the children
    size: list[int] = []

    def shapes_of(tree: Tree) -> list[int]:
        labels, kids, _ = tree
        out = [0] * len(labels)
        for k in range(len(labels) - 1, -1, -1):  # children come later than parents
            shape = labels[k], tuple([out[c] for c in kids[k]])
            if shape not in numbers:
                numbers[shape] = len(shapes)
                shapes.append(shape)
                size.append(1 + sum(size[c] for c in shape[1]))
            out[k] = numbers[shape]
        return out

    known: dict[tuple[int, int], tuple[int, list]] = {}  # size, places of paired children

    def weight(x: int, y: int) -> int:
        if x == y:
            return size[x]
        return known[x, y][0] if shapes[x][0] == shapes[y][0] else 0

    ours, theirs = shapes_of(page), shapes_of(reference)
    todo = [(ours[0], theirs[0])]
    while todo:
        x, y = todo[-1]
        if x == y or shapes[x][0] != shapes[y][0] or (x, y) in known:
            todo.pop()
            continue
        xs, ys = shapes[x][1], shapes[y][1]
        least = min(len(xs), len(ys))
        begin = next((k for k in range(least) if xs[k] != ys[k]), least)
        end = next((k for k in range(least - begin) if xs[-1 - k] != ys[-1 - k]), least - begin)
        in_x, in_y = xs[begin:len(xs) - end], ys[begin:len(ys) - end]
        kinds_x, kinds_y = ({s: k for k, s in enumerate(dict.fromkeys(row))} for row in (in_x, in_y))
        missing = [(p, q) for p in kinds_x for q in kinds_y
                   if p != q and shapes[p][0] == shapes[q][0] and (p, q) not in known]
        if missing:
            todo += missing
            continue
        weights = np.array([[weight(p, q) for q in kinds_y] for p in kinds_x], np.int64)
        inner = heaviest(weights, np.array([kinds_x[s] for s in in_x], np.int64),
                         np.array([kinds_y[s] for s in in_y], np.int64))
        pairs = [(k, k) for k in range(begin)] + [(begin + i, begin + j) for i, j in inner] \
            + [(len(xs) - k, len(ys) - k) for k in range(end, 0, -1)]
        known[x, y] = 1 + sum(weight(xs[i], ys[j]) for i, j in pairs), pairs
        todo.pop()

    out: dict[int, int] = {}
    nodes = [(0, 0)] if weight(ours[0], theirs[0]) else []
    while nodes:
        a, b = nodes.pop()
        out[a] = b
        if ours[a] == theirs[b]:
            nodes += zip(page[1][a], reference[1][b])
        else:
            nodes += [(page[1][a][i], reference[1][b][j]) for i, j in known[ours[a], theirs[b]][1]]
    return out


class Aligner:
    """Alignments by tree and reference; the last ones are remembered."""

    def __init__(self, most: int = REMEMBERED_NODES):
        self._known: OrderedDict = OrderedDict()
        self._most = most
        self._held = 0

    def __call__(self, page: Page, reference: str | None) -> dict[int, int]:
        if not reference:
            return {}
        key = skeleton(page), reference
        if key in self._known:
            return self._known[key]
        found = self._known[key] = align(tree_of(key[0]), tree_of(reference))
        self._held += len(page.nodes)
        while self._held > self._most:
            (tree, _), _ = self._known.popitem(last=False)
            self._held -= tree.count(" ") + 1
        return found


def host_of(url: str | None) -> str:
    """What lies after the first :// up to the path, A-Z lower-cased; empty if there is none."""
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return ""
    return re.split("[/?#]", rest, maxsplit=1)[0].translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def _skeletons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"host": [host_of(u) for u in batch.url],
                            "tree": [skeleton(parse(h)) for h in batch.html]})


def own_texts(page: Page, to: dict[int, int]) -> dict[int, list[str]]:
    """The texts that lie right in each aligned node of a page, by the node of the reference."""
    held: dict[int, list[str]] = {}
    for node, text, dropped in page.blocks:
        if not dropped and node.number in to:
            held.setdefault(to[node.number], []).append(text)
    return held


def hash_of(texts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(texts).encode("utf-8", "surrogatepass")) >> 1


def _node_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    aligned = Aligner()
    for batch in batches:
        rows = []
        for host, html, reference in zip(batch.host, batch.html, batch.reference):
            page = parse(html)
            rows += [(host, node, hash_of(texts), sum(map(len, texts)))
                     for node, texts in own_texts(page, aligned(page, reference)).items()]
        yield pd.DataFrame(rows, columns=["host", "node", "hash", "chars"])


def wrapper_of(reference: str, stats: dict[int, tuple[int, int, int, int, int]]) \
        -> tuple[int, list[tuple[int, int]]]:
    """The container's node, and template nodes in it with the hash of the text that pages leave out.

    ``stats`` of a node: pages with text there, pages with its commonest text, characters, those of
    the commonest text, its hash.
    """
    labels, kids, parents = tree_of(reference)
    constant = {k for k, (pages, same, *_) in stats.items()
                if pages >= LEAST_PAGES and same > SAME_SHARE * pages}
    mass = [stats[k][2] - (stats[k][3] if k in constant else 0) if k in stats else 0
            for k in range(len(labels))]
    if not any(mass):  # all pages are alike, or one page: then all text counts
        mass = [stats[k][2] if k in stats else 0 for k in range(len(labels))]
        constant = set()
    for k in range(len(labels) - 1, 0, -1):
        mass[parents[k]] += mass[k]
    articles = [k for k, label in enumerate(labels) if label.split(".")[0] in _ARTICLES and mass[k]]
    at = max(articles, key=lambda k: (mass[k], -k), default=0)  # where its author says it is
    while mass[0] and not articles:
        inner = [k for k in kids[at] if mass[k] >= SLOT_SHARE * mass[0]
                 and labels[k].split(".")[0] in _CONTAINERS]
        if not inner:
            break
        at = inner[0]
    behind = at + 1
    while behind < len(labels) and parents[behind] >= at:
        behind += 1
    return at, sorted((k, stats[k][4]) for k in constant if at < k < behind
                      and labels[k].split(".")[0] in _CONTAINERS | {"ul", "ol", "li"})


def _wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, reference, nodes in zip(batch.host, batch.reference, batch.nodes):
            stats = {n["node"]: (n["pages"], n["same"], n["chars"], n["same_chars"], n["hash"])
                     for n in nodes} if nodes is not None else {}
            container, left_out = wrapper_of(reference, stats)
            rows.append((host, reference, container, left_out))
        yield pd.DataFrame(rows, columns=["host", "reference", "container", "left_out"])


def wrappers(pages: DataFrame) -> DataFrame:
    """Learn ``host, reference, container, left_out`` of each host from all of its pages."""
    read = picked(pages, page_id="long", url="string", html="string")
    references = settle(
        read.select("url", "html").mapInPandas(_skeletons, "host string, tree string")
        .groupBy("host", "tree").agg(F.count("*").alias("n"))
        .groupBy("host").agg(F.max_by("tree", F.struct("n", "tree")).alias("reference")),
        "wrapper-references")
    counted = (
        with_host(read).join(references, "host").select("host", "html", "reference")
        .mapInPandas(_node_texts, "host string, node int, hash long, chars long")
        .groupBy("host", "node", "hash").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
        .groupBy("host", "node").agg(F.sum("n").alias("pages"), F.sum("chars").alias("chars"),
                                     F.max(F.struct("n", "hash", "chars")).alias("top"))
        .groupBy("host").agg(F.collect_list(F.struct(
            "node", "pages", F.col("top.n").alias("same"), "chars",
            F.col("top.chars").alias("same_chars"), F.col("top.hash").alias("hash")))
            .alias("nodes"))  # a row for each node of one tree
    )
    return settle(
        references.join(counted, "host", "left").select("host", "reference", "nodes")
        .mapInPandas(_wrap, "host string, reference string, container int, "
                            "left_out array<struct<node: int, hash: bigint>>"),
        "wrappers")


def with_host(pages: DataFrame) -> DataFrame:
    after = F.when(F.instr("url", "://") > 0,
                   F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(after, "^([^/?#]*)", 1)
    return pages.withColumn("host", F.coalesce(F.translate(
        host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")))


def main_text(page: Page, to: dict[int, int], container: int, left_out: set[tuple[int, int]],
              articles_known: bool = False) -> str:
    """The blocks of the node aligned with the container, or of the page's own articles, or of its
    whole body, in this order of preference; own articles come first unless the host's reference has
    articles too (``articles_known``), so that the container was chosen with regard to them.

    ``left_out``: nodes of the reference and hashes; where the texts right in such a node have
    that hash, these are left out, but nothing below the node.
    """
    gone = {b for b, texts in own_texts(page, to).items() if (b, hash_of(texts)) in left_out} \
        if left_out else set()

    def below(tops: set[int], without: set[int]) -> str:
        inside: list[bool] = []
        for node in page.nodes:  # parents come first
            up = inside[node.parent.number] if node.parent else False
            inside.append(up or node.number in tops)
        return "\n".join(text for node, text, dropped in page.blocks
                         if not dropped and inside[node.number]
                         and to.get(node.number) not in without)

    tops = {a for a, b in to.items() if b == container and container > 0}
    own = {n.number for n in page.nodes if n.article}
    for chosen in (tops, own) if articles_known else (own, tops):
        found = below(chosen, gone) if chosen else ""
        if found:
            return found
    return "" if own else below({0}, gone)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    aligned = Aligner()
    for batch in batches:
        texts = []
        for html, reference, container, left_out in zip(batch.html, batch.reference,
                                                        batch.container, batch.left_out):
            page = parse(html)
            texts.append(main_text(page, aligned(page, reference), int(container),
                                   {(n["node"], n["hash"]) for n in left_out},
                                   bool(_ARTICLE_NODE.search(reference))))
        yield pd.DataFrame({"page_id": batch.page_id, "url": batch.url, "text": texts,
                            "n_chars": [len(t) for t in texts], "host": batch.host})


def extract(pages: DataFrame) -> DataFrame:
    """Return ``page_id, url, text, n_chars, host`` for each page.

    A null or empty html gives an empty text. Pages without a host (null url, or no ://) form one
    host of their own. Equal trees are ordered by their text, so ties change nothing. Repeated rows
    give repeated results. Other columns are ignored; rows without a page_id are left out. An empty
    table gives an empty result. Pages are read whole, however long.
    """
    learned = wrappers(pages)
    return with_host(picked(pages, page_id="long", url="string", html="string")) \
        .join(learned, "host") \
        .select("page_id", "url", "html", "host", "reference", "container", "left_out") \
        .mapInPandas(_extract, "page_id long, url string, text string, n_chars long, host string")
