"""Main text of web pages by tag-path ratios.

A page is cut into text nodes, each with its root-to-leaf tag path (tags with their class names, and whether they are
boilerplate by their tag or names). Over all nodes text length and punctuation are added up per path and divided by the path's
nodes, where link text and text in boilerplate elements weigh nothing; each node takes its path's two ratios; both sequences
are smoothed over the page with a Gaussian, fused into their geometric mean, and thresholded at ``THRESHOLD`` standard
deviations. The paths whose nodes clear it on average are the content paths, and their nodes are content.

Short parts of an article have thin paths. So of the other nodes outside boilerplate those are content too that lie in an article, main or text
block which holds content paths; or else, in a part that is not mostly links, between two content nodes of the innermost
element around them that has any, in a heading right before content, or in a paragraph, list, quotation or table beside it.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import require, text_slices

#: Standard deviations of the fused ratio that a content node reaches.
THRESHOLD = 0.8
#: Nodes to either side that the smoothing reaches, and its width.
REACH, SIGMA = 2, 1.0
#: Share of a region's text that may be link text.
MOST_LINKS = 0.6

# Element names of HTML by what they do here.
RAW = "script style title textarea noscript iframe xmp noembed noframes".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TEXTUAL = HEADINGS | set("p ul ol dl li dt dd blockquote pre figure figcaption table tbody tr td th a b i em strong span u s small code q cite mark sub sup".split())
BOILERPLATE = set("nav footer aside form head menu dialog button select datalist template svg canvas object video audio map".split())
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
#: Words of class names and ids that mark boilerplate.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Start tags that end an open paragraph or an open element of the same kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: What a head may hold; anything else ends it, as its end tag may be left out.
HEAD = {"html", "head", "title", "meta", "link", "base", "basefont", "bgsound", "style", "script", "noscript", "noframes", "template"}

_RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_TAG_END = re.compile(r">|=\s*([\"'])")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
_BLANKS = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(text, '', '') and ('', tag, attributes) in page order, end tags with a slash before their name; comments,
    declarations and raw elements are left out. The page is gone through once: an attribute's quote that never
    ends is none, and after a tag that never ends quotes count no more."""
    at = begin = 0
    last = {q: page.rfind(q) for q in "\"'"}
    while True:
        at = page.find("<", at)
        if at < 0:
            break
        name = _NAME.match(page, at + 1)
        if name is None and page[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1
            continue
        if at > begin:
            yield page[begin:at], "", ""
        if name is None:
            stop = "-->" if page.startswith("<!--", at) else ">"
            at = page.find(stop, at + (4 if len(stop) > 1 else 0))
            at = begin = len(page) if at < 0 else at + len(stop)
            continue
        end = name.end()
        while (m := _TAG_END.search(page, end)) and m[1]:
            end = page.index(m[1], m.end()) + 1 if last[m[1]] >= m.end() else m.end()
        if m is None:
            last = dict.fromkeys(last, -1)
            end = page.find(">", name.end())
            if end < 0:
                return
        else:
            end = m.start()
        tag = name[0].lower()
        at = begin = end + 1
        if tag in _RAW_END:
            closed = _RAW_END[tag].search(page, at)
            at = begin = closed.end() if closed else len(page)
        else:
            yield "", tag, page[name.end() : end]
    if begin < len(page):
        yield page[begin:], "", ""


def marks(attributes: str) -> tuple[set[str], str]:
    words, classes = set(), ""
    for name, a, b, c in _ATTR.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "role":
            if value in ROLES:
                words.add("ad")
        else:
            words.update(re.findall(r"[a-z]+", value))
            if name.lower() == "class":
                classes = "." + ".".join(value.split())
    return words, classes


@dataclass
class Element:
    """An element: its parent and path as numbers, its tag, and what it stands in. ``until``: text nodes before this number
    are boilerplate in it."""

    parent: int
    path: int
    tag: str
    link: bool
    article: bool
    own: bool
    marked: int  # the nearest element around or at this one that is boilerplate by itself, or -1
    block: int  # how many open elements there are up to the nearest block
    until: float = 0


@dataclass
class Node:
    """A stretch of text: its element, its block, its words."""

    element: int
    block: int
    text: str


def parse(page: str) -> tuple[list[Element], list[Node]]:
    """Elements in the order in which they open, the first being the page itself, and text nodes. Every step is the work of
    the tags it opens or closes, so a page takes time in proportion to its length, however deep or broken it is."""
    elements = [Element(-1, 0, "", False, False, False, -1, 1)]
    nodes: list[Node] = []
    paths: dict[tuple[int, str, bool], int] = {}
    stack, opened = [0], defaultdict(int)
    block = 0
    ended: dict[int, int] = {}  # boilerplate without an end tag so far: the first node of an article or main in it

    def close(size: int) -> None:
        while len(stack) > size:
            opened[elements[stack.pop()].tag] -= 1

    for text, tag, attributes in tokens(page):
        if not tag or tag == "br":
            if elements[stack[-1]].tag == "head" and text.strip():
                close(len(stack) - 1)
            nodes.append(Node(stack[-1], block, html.unescape(text) if text else "\n"))
            continue
        if tag[0] == "/":
            block += tag[1:] in BLOCKS
            if opened[tag[1:]]:
                while elements[stack[-1]].tag != tag[1:]:
                    close(len(stack) - 1)
                ended.pop(stack[-1], None)
                close(len(stack) - 1)
            continue
        if tag not in HEAD and elements[stack[-1]].tag == "head":
            close(len(stack) - 1)
        if tag in BLOCKS:
            block += 1
            ends = CLOSES.get(tag, set()) | {"p"}
            while elements[stack[at := elements[stack[-1]].block - 1]].tag in ends:
                close(at)
        if tag in VOID or attributes.endswith("/"):
            continue
        around = elements[stack[-1]]
        words, classes = marks(attributes)
        own = tag in BOILERPLATE or tag == "header" and not around.article or bool(words & MARKS) and tag not in ("html", "body", "article", "main") or "header" in words and not around.article and tag not in ("html", "body")
        article = tag in ("article", "main")
        if article:
            e = around.marked
            while e >= 0 and e not in ended:
                ended[e] = len(nodes)
                e = elements[elements[e].parent].marked
        number = len(elements)
        path = paths.setdefault((around.path, tag + classes, own), len(paths) + 1)
        elements.append(Element(stack[-1], path, tag, around.link or tag == "a", around.article or article, own, number if own else around.marked, len(stack) + 1 if tag in BLOCKS else around.block))
        stack.append(number)
        opened[tag] += 1
    # an article ends the boilerplate around it whose end tag never came
    for number, e in enumerate(elements[1:], 1):
        e.until = max(elements[e.parent].until, ended.get(number, math.inf) if e.own else 0)
    return elements, nodes


def fused_ratios(paths: np.ndarray, length: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """For nodes in page order, with their paths: the text length and punctuation of each path a node of it, smoothed over
    the page and fused into their geometric mean; 0 where the path has no text."""
    count = np.maximum(np.bincount(paths), 1)
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    inside = slice(REACH, REACH + len(paths))
    weight = np.convolve(np.ones(len(paths)), kernel)[inside]
    ratios = [(np.bincount(paths, x) / count)[paths] for x in (length, signs)]
    smooth = [np.convolve(r, kernel)[inside] / weight for r in ratios]
    return np.where(ratios[0] > 0, np.sqrt(smooth[0] * (smooth[1] + 0.1)), 0.0)


def content_nodes(elements: Sequence[Element], nodes: Sequence[Node], boilerplate: Sequence[bool]) -> list[bool]:
    """Which of a page's text nodes with text are content; ``boilerplate`` says which of them boilerplate elements hold."""
    # boilerplate that an article ends has nodes of both kinds on one path; they are told apart
    paths = np.unique([2 * elements[n.element].path + b for n, b in zip(nodes, boilerplate, strict=True)], return_inverse=True)[1]
    size = [len(n.text.strip()) for n in nodes]
    linked = [elements[n.element].link for n in nodes]
    weightless = [x or b for x, b in zip(linked, boilerplate, strict=True)]
    length = np.array([0 if x else s for s, x in zip(size, weightless, strict=True)], float)
    signs = np.array([0 if x else len(_PUNCTUATION.findall(n.text)) for n, x in zip(nodes, weightless, strict=True)], float)
    if not length.any():
        length = np.array([0 if b else s for s, b in zip(size, boilerplate, strict=True)], float)  # a page of links
        if not length.any():
            return [False] * len(nodes)
    fused = fused_ratios(paths, length, signs)
    share = (np.bincount(paths, fused) / np.maximum(np.bincount(paths), 1))[paths]
    picked = share >= min(THRESHOLD * fused.std(), share.max())
    # by element: its text and link text, and the first and last node that it holds of the content paths
    n = len(elements)
    text, links, first, last = [0] * n, [0] * n, [len(nodes)] * n, [-1] * n
    for i, node in enumerate(nodes):
        e = node.element
        text[e] += size[i]
        links[e] += size[i] * linked[i]
        if picked[i]:
            first[e], last[e] = min(first[e], i), i
    for e in range(n - 1, 0, -1):
        up = elements[e].parent
        text[up] += text[e]
        links[up] += links[e]
        first[up], last[up] = min(first[up], first[e]), max(last[up], last[e])
    # by element: the innermost one around it that holds content paths, and the part of that one in which it lies
    holder, part = [0] * n, [0] * n
    for e in range(1, n):
        up = elements[e].parent
        holder[e] = e if last[e] >= 0 else holder[up]
        part[e] = e if holder[e] == e or last[up] >= 0 else part[up]
    out = picked.tolist()
    for i in range(len(nodes) - 1, -1, -1):
        if out[i] or boilerplate[i]:
            continue
        e = nodes[i].element
        around, branch = holder[e], part[e]
        tag = elements[around].tag
        if tag in ("article", "main") or tag in TEXTUAL:
            out[i] = True
        elif branch == around or links[branch] <= MOST_LINKS * text[branch]:
            heading = elements[branch].tag in HEADINGS and i + 1 < len(nodes) and (out[i + 1] or nodes[i + 1].block == nodes[i].block)
            out[i] = first[around] < i < last[around] or heading or tag not in ("", "html", "body") and (branch == around or elements[branch].tag in TEXTUAL - HEADINGS)
    return out


def main_text(page: str) -> str:
    """The content's blocks in page order, blanks made one space, joined by two newlines; '' where there is none."""
    elements, nodes = parse(page)
    solid = [(n, i < elements[n.element].until) for i, n in enumerate(nodes) if n.text.strip()]
    if not solid:
        return ""
    chosen = content_nodes(elements, [n for n, _ in solid], [b for _, b in solid])
    wanted = {id(n) for (n, _), yes in zip(solid, chosen, strict=True) if yes}
    blocks: dict[int, list[str]] = {n.block: [] for n, _ in solid if id(n) in wanted}
    for n in nodes:
        if n.block in blocks and (id(n) in wanted or not n.text.strip()):
            blocks[n.block].append(n.text)
    joined = (_BLANKS.sub(" ", "".join(parts)).strip() for _, parts in sorted(blocks.items()))
    return "\n\n".join(b for b in joined if b)


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id", "url"), output: str = "text") -> DataFrame:
    """The ``keep`` columns and the main text of every whole page.

    Null or empty pages, and pages without text, give ''. Repeated rows are answered each; other columns are ignored. A page
    is parsed where it is read, without a shuffle.
    """
    require(pages, html_col, *keep)
    if output.lower() in [k.lower() for k in keep]:
        raise ValueError(f"a kept column is named {output}")
    keep = list(keep)
    schema = T.StructType([*(pages.schema[k] for k in keep), T.StructField(output, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 64):
            made = [main_text(p or "") for p in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(made, pa.string())], names=[*keep, output])

    return pages.select(*keep, html_col).mapInArrow(run, schema)
