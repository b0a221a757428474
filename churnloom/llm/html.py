"""Main text of web pages by tag-path ratios.

A page is read into blocks (text between block-level tags, inline tags pass), each with its path of
open tags from the root. Per path: text length, punctuation and number of blocks. The ratios length / blocks
and punctuation / blocks of a path, laid out over the blocks in page order, are smoothed with
their neighbours and fused (multiplied); a path's value is the mean over its blocks. The page's own
markup only weighs: a path inside <article> or <main> counts ``MARKED`` times, one inside an
element whose class or id has a word such as "ad" or "comments" ``WORDED`` times; links weigh against a path.
Paths whose value reaches ``THRESHOLD`` of the largest are content. A heading goes with the content it stands before
in the same element.

The container of the content is the deepest element that holds ``MOST`` of its text. Inside it, no block is lost
for being short: list items, table cells, quotes, captions and headings stay wherever they stand, but for those that a
class word speaks against and, outside <article> and <main>, those that are mostly links. The page as a whole
(<html>, <body>) is no container; there the paths alone decide.

Elements that are never main text by tag, role or as hidden (scripts, styles, menus, headers, footers,
asides, forms) are left out before; the <header> of an <article> belongs to it. Of the classes of an <article>, only
those that name reader comments count.

A null or empty page has an empty text, an empty table no rows; repeated rows are extracted one by one. Other columns
stay as they are, but one with the name of the new column is replaced. Each page is handled by itself, whole, in its own task.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

THRESHOLD = 0.25
MARKED = 2.0
WORDED = 0.1
MOST = 0.9

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe noembed noframes xmp template".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
LEFT_OUT = set(
    "script style title textarea noscript iframe noembed noframes xmp template head nav header footer aside form button select option fieldset dialog menu svg canvas object audio video math map".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar status".split())
COMMENTS = set("comment comments commentlist disqus respond reply replies".split())
WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "sidebar aside nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead footer copyright comment comments commentlist disqus respond reply replies "
    "share sharing social related recommended newsletter subscribe subscription signup login search widget toolbar hidden".split()
)
#: a start tag on the left is ended by one of these
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
ENDS_AT = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
PLAIN_ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: classes of these say nothing about a part of the page
WHOLE_PAGE = {"html", "body", "main"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TO_END = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")


@dataclass
class Node:
    block: str
    path: str
    marked: bool
    worded: bool
    linked: int
    inside: tuple[tuple[int, str], ...]  # the elements around it: number, tag


def _tag_end(page: str, at: int) -> int:
    """Place after the ``>`` that ends a tag; quotes are minded if they close."""
    m = _TO_END.match(page, at)
    if m:
        return m.end()
    end = page.find(">", at)
    return len(page) if end < 0 else end + 1


def _never_content(name: str, attributes: str) -> bool:
    if name in LEFT_OUT:
        return True
    if not attributes or attributes.isspace():
        return False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), entities.unescape(a or b or c)
        if key == "role" and value.strip().lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _worded(name: str, attributes: str) -> bool:
    """Whether a word of class or id speaks against an element."""
    if name in WHOLE_PAGE or not attributes or attributes.isspace():
        return False
    against = COMMENTS if name == "article" else WORDS
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id") and against.intersection(_SPLIT.split(re.sub(r"([a-z])([A-Z])", r"\1-\2", entities.unescape(a or b or c)).lower())):
            return True
    return False


def blocks(page: str) -> list[Node]:
    """The text blocks of a page in order, without what is never content."""
    out: list[Node] = []
    stack: list[tuple[str, bool, bool, int]] = []  # open tags; left out or not; worded or not; number
    opened = 0
    texts: list[str] = []
    linked = 0
    path_of: list[str] = []

    def flush() -> None:
        nonlocal linked
        if texts:
            words = _SPACE.sub(" ", "".join(texts)).strip()
            if words:
                tags = [t for t, *_ in stack if t not in INLINE]
                worded = stack[-1][2] if stack else False
                # the same tags with and without such words are paths of their own
                out.append(Node(words, ("!" if worded else "") + ">".join(tags), any(t in PLAIN_ARTICLE for t in tags), worded, linked, tuple((k, t) for t, _, _, k in stack if t not in INLINE)))
            texts.clear()
        linked = 0

    def close(k: int) -> None:
        """End the open tags from the k-th on."""
        if any(t not in INLINE for t, *_ in stack[k:]):
            flush()
        del stack[k:]

    at, n = 0, len(page)
    while at < n:
        tag = page.find("<", at)
        if tag < 0:
            tag = n
        if tag > at and not (stack and stack[-1][1]):
            words = entities.unescape(page[at:tag])
            texts.append(words)
            if any(t == "a" for t, *_ in stack):
                linked += len(words)
        if tag == n:
            break
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = n if end < 0 else end + 3
            continue
        nxt = page[tag + 1 : tag + 2]
        if nxt in ("!", "?"):
            end = page.find(">", tag)
            at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        m = _NAME.match(page, tag + 1 + closing)
        if not m:
            if closing:
                end = page.find(">", tag)
                at = n if end < 0 else end + 1
            else:
                if not (stack and stack[-1][1]):
                    texts.append("<")
                at = tag + 1
            continue
        name, end = m.group().lower(), _tag_end(page, m.end())
        at = end
        if closing:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if k >= 0:
                close(k)
            elif name not in INLINE:
                flush()
            continue
        if name in ("br", "wbr", "img"):
            if name != "wbr":
                texts.append(" ")
            continue
        if name not in INLINE:
            flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in ENDED_BY:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ENDS_AT[name]:
                    break
                if stack[k][0] in ENDED_BY[name]:
                    close(k)
                    break
        attributes = page[m.end() : end - 1]
        if name in VOID or attributes.endswith("/") and name not in RAW and name in ("svg", "path"):
            continue
        if name in RAW:
            close_at = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, end)
            at = n if not close_at else _tag_end(page, close_at.end())
            continue
        if name == "body" and any(t == "head" for t, *_ in stack):
            close(next(k for k, (t, *_) in enumerate(stack) if t == "head"))
        own_header = name == "header" and any(t == "article" for t, *_ in stack)
        out_here = bool(stack and stack[-1][1]) or _never_content("div" if own_header else name, attributes)
        worded_here = bool(stack and stack[-1][2]) or _worded(name, attributes)
        opened += 1
        stack.append((name, out_here, worded_here, opened))
    flush()
    return out


def _smoothed(values: list[float]) -> list[float]:
    """Each value with half of its neighbours (1-2-1)."""
    n = len(values)
    return [(values[max(k - 1, 0)] + 2 * values[k] + values[min(k + 1, n - 1)]) / 4 for k in range(n)]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    nodes = blocks(page or "")
    if not nodes:
        return ""
    length: dict[str, float] = {}
    marks: dict[str, float] = {}
    links: dict[str, float] = {}
    count: dict[str, int] = {}
    for x in nodes:
        length[x.path] = length.get(x.path, 0) + len(x.block)
        marks[x.path] = marks.get(x.path, 0) + len(_PUNCTUATION.findall(x.block))
        links[x.path] = links.get(x.path, 0) + x.linked
        count[x.path] = count.get(x.path, 0) + 1
    by_length = _smoothed([length[x.path] / count[x.path] for x in nodes])
    by_marks = _smoothed([marks[x.path] / count[x.path] for x in nodes])
    value: dict[str, float] = dict.fromkeys(count, 0.0)
    for x, a, b in zip(nodes, by_length, by_marks, strict=True):
        text_share = max(0.0, 1 - links[x.path] / max(length[x.path], 1))
        value[x.path] += a * (1 + b) * text_share / count[x.path]
    for path in {x.path for x in nodes if x.marked}:
        value[path] *= MARKED
    for path in {x.path for x in nodes if x.worded}:
        value[path] *= WORDED
    bar = threshold * max(value.values())
    kept = [value[x.path] >= bar for x in nodes]
    ahead: int | None = None  # the next block that is neither heading nor worded
    for k in range(len(nodes) - 1, -1, -1):
        x = nodes[k]
        if x.worded:
            continue
        inside, _, tag = x.path.rpartition(">")
        if tag not in HEADINGS:
            ahead = k
        elif ahead is not None and kept[ahead] and (not inside or nodes[ahead].path.startswith(inside + ">")):
            kept[k] = True
    held = _container([x for x, own in zip(nodes, kept, strict=True) if own and not x.worded])
    for k, x in enumerate(nodes):
        if held in x.inside and not x.worded and (x.marked or 2 * x.linked < len(x.block)):
            kept[k] = True
    return "\n\n".join(x.block for x, own in zip(nodes, kept, strict=True) if own)


def _container(content: list[Node]) -> tuple[int, str] | None:
    """The deepest element that holds MOST of the content's text, if that is not the page itself."""
    total, size, depth = 0, {}, {}
    for x in content:
        total += len(x.block)
        for k, element in enumerate(x.inside):
            size[element] = size.get(element, 0) + len(x.block)
            depth[element] = k
    found = max((e for e in size if size[e] >= MOST * total), key=lambda e: depth[e], default=None)
    return None if found is None or found[1] in ("html", "body") else found


def extract(pages: DataFrame, *, html: str = "html", into: str = "text") -> DataFrame:
    """All columns but ``html``, with the main text in ``into``."""
    out = pages.withColumn(into, F.col(f"`{html}`")) if into != html else pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(into)
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = pa.array([main_text(x) for x in part.column(into).to_pylist()], pa.string())
                yield part.set_column(k, into, texts)

    if into != html:
        out = out.drop(html)
    return out.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema]))
