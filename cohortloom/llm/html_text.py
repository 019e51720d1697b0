"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: elements at the same place with
the same tag and class are one node.  A node whose content and presentation
hardly vary beside the different main texts of its host has a low entropy and so
a low importance; the contents it repeats are template, not text.  Near copies
of a page are one main text, so they say nothing about each other.  Names of
tags and classes and the share of links tell the rest.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table
from cohortloom.session import BROADCAST_ROWS, saved

MIN_PAGES = 5  # different main texts that must stand beside a node before its importance counts
REPEATED = 0.01  # of the main texts beside a node, and two at least, that show a content which is template
LOW = 0.3  # importance under which a branch is template
CONTENT_WEIGHT = 0.9  # of the content's entropy against the presentation's
LINK_SHARE = 0.6  # of a list's or container's text, over which it is a menu

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s>/]*)[^>]*>"
    r"|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s>/]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?=[\s>/])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed")}
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements that never hold main text.
DROPPED = frozenset(
    "head script style noscript template iframe object embed applet svg canvas audio video map nav footer aside form button select "
    "textarea input label fieldset legend dialog menu title xmp noembed".split()
)
#: Words in class, id or role that name what is not main text.
TEMPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial adsense adbox adslot banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay menu menus nav navbar navigation breadcrumb "
    "breadcrumbs sidebar sidebars rail footer foot topbar masthead comment comments commentlist disqus respond reply replies "
    "discussion share sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "searchbox pagination pager paging widget widgets toolbar tagcloud skip copyright disclaimer legal privacy form banners "
    "complementary contentinfo alertdialog tablist outbrain taboola paywall".split()
)
#: Elements that are never judged by their names, nor by importance.
_FRAME = frozenset("html body article main".split())
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS = frozenset("ul ol dl table tbody thead tfoot div section article select menu main body".split())


class Page:
    """The elements of a page in order: tag, parent, names, and children (element numbers or strings)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.names, self.children, self.hidden = ["#"], [-1], [""], [[]], [False]
        stack, at, size = [0], 0, len(source)
        while at < size:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(stack, source[at:])
                break
            if m.start() > at:
                self._text(stack, source[at : m.start()])
            at = m.end()
            if m[1]:
                self._close(stack, m[1].lower())
                continue
            name = m[2] or m[4]
            if not name:
                if m[0].startswith("<![CDATA["):
                    self._text(stack, m[0][9:-3] if m[0].endswith("]]>") else m[0][9:])
                continue
            name, attributes = name.lower(), m[3] if m[2] else m[5]
            node = self._open(stack, name, attributes or "")
            if name in RAW:
                end = RAW[name].search(source, at)
                at = end.end() if end else size
            elif name not in VOID and not (attributes or "").endswith("/"):
                stack.append(node)

    def _text(self, stack: list[int], raw: str) -> None:
        self.children[stack[-1]].append(entities.unescape(raw))

    def _open(self, stack: list[int], name: str, attributes: str) -> int:
        if name in BLOCK:  # a paragraph ends where a block begins
            for i in range(len(stack) - 1, 0, -1):
                if self.tag[stack[i]] == "p":
                    del stack[i:]
                    break
                if self.tag[stack[i]] in BLOCK:
                    break
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag in _CLOSED_BY.get(name, ()):
                del stack[i:]
                if name != "tr" or tag == "tr":
                    break
            elif tag in _LISTS and not (name == "tr" and tag in ("tbody", "thead", "tfoot")):
                break
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.children.append([])
        self.children[stack[-1]].append(node)
        names, hidden = [], False
        for a in _ATTRIBUTE.finditer(attributes) if attributes else ():
            key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
            if key in ("class", "id", "role"):
                names.append(value)
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
        self.names.append(" ".join(names))
        self.hidden.append(hidden)
        return node

    def _close(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag == name:
                del stack[i:]
                return
            if name not in BLOCK and tag in BLOCK:
                return  # an end tag inside a block does not end what is around it

    def texts(self, gone: list[bool]) -> list[str]:
        """The text below every element, without that of the elements that are gone."""
        out = [""] * len(self.tag)
        for node in range(len(self.tag) - 1, -1, -1):  # children come after their parent
            if not gone[node]:
                parts = [x if isinstance(x, str) else out[x] for x in self.children[node]]
                out[node] = " ".join(" ".join(parts).split())
        return out

    def keys(self) -> list[int]:
        """The style-tree node of every element: its tag and names below those of its parents."""
        out = [0]
        for node in range(1, len(self.tag)):
            label = f"{out[self.parent[node]]}/{self.tag[node]}.{re.sub('[0-9]+', '#', self.names[node])}"
            out.append(_digest(label))
        return out


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _template_name(names: str) -> bool:
    return any(w.lower() in TEMPLATE_WORDS for w in _NAME.findall(names))


class Branch(NamedTuple):
    """The elements of a page at one style-tree node that importance may judge."""

    elements: list[int]
    content: int
    shape: int
    chars: int


def _branches(page: Page, out: list[bool], spared: list[bool]) -> tuple[dict[int, Branch], int]:
    """The branches of a page by style-tree node, and the length of its text, without the elements that are out."""
    judged = [
        n for n in range(1, len(page.tag)) if not out[n] and not spared[n] and page.tag[n] in BLOCK and page.tag[n] not in _FRAME
    ]
    if not judged:
        return {}, 0
    texts, keys = page.texts(out), page.keys()
    elements: dict[int, list[int]] = {}
    for node in judged:
        elements.setdefault(keys[node], []).append(node)

    def tags(node: int) -> str:
        return ",".join(page.tag[c] for c in page.children[node] if isinstance(c, int) and not out[c])

    found = {
        k: Branch(own, _digest("\n".join(texts[n] for n in own)), _digest(";".join(map(tags, own))), sum(len(texts[n]) for n in own))
        for k, own in elements.items()
    }
    return {k: b for k, b in found.items() if b.chars}, len(texts[0])


def _beside(page: Page, out: list[bool], branches: dict[int, Branch]) -> dict[int, int]:
    """The digest of the longest block outside each branch, for those that have text beside them."""
    key_of = {n: k for k, b in branches.items() for n in b.elements}
    main: dict[int, int] = {}
    open_keys = set(branches)
    for text, node in sorted(_runs(page, out), key=lambda r: (-len(r[0]), r[0])):
        around = set()
        while node > 0:
            around.add(key_of.get(node))
            node = page.parent[node]
        own = _digest(text)
        for key in open_keys - around:
            main[key] = own
        open_keys &= around
        if not open_keys:
            break
    return main


def style_features(source: str) -> list[tuple[int, int, int, int]]:
    """(node, main, content, presentation) digests of a page, one per style-tree node that importance may judge.

    ``main`` is the longest block beside the node: it is the same on near copies
    of a page, whatever their menus, adverts and scripts are.
    """
    page = Page(source)
    out, spared = _by_rules(page)
    branches, _ = _branches(page, out, spared)
    return [(k, m, branches[k].content, branches[k].shape) for k, m in _beside(page, out, branches).items()]


def _pair(node: int, content: int) -> int:
    """One number for a style-tree node and its content."""
    return (node * 0x9E3779B97F4A7C15 + content + (1 << 63)) % (1 << 64) - (1 << 63)


def main_text(source: str | None, low: frozenset[int] = frozenset()) -> str:
    """The blocks of the main text in page order, joined by a space.

    ``low`` are the host's template contents, as ``_pair`` of node and content.
    What is inside an article, or holds most of the page's text, is never one.
    """
    if not source:
        return ""
    page = Page(source)
    out, spared = _by_rules(page)
    if low:
        branches, total = _branches(page, out, spared)
        for key, branch in branches.items():
            if 2 * branch.chars <= total and _pair(key, branch.content) in low:
                for node in branch.elements:
                    out[node] = True
    blocks = _blocks(page, out)
    return " ".join(blocks or _blocks(page, _by_names(page)[0]))


def _by_names(page: Page) -> tuple[list[bool], list[bool]]:
    """Which elements tags, names and articles tell to be no main text, and which importance never removes."""
    count = len(page.tag)
    out, inside = [False] * count, [False] * count  # removed; inside an article
    root = [""] * count
    for node in range(1, count):
        tag, names, up = page.tag[node], page.names[node], page.parent[node]
        inside[node] = inside[up] or tag in ("article", "main") or "main" in names.split()
        root[node] = "article" if tag == "article" or root[up] == "article" else "main" if tag == "main" or "main" in names.split() else root[up]
        out[node] = (
            out[up] or tag in DROPPED or page.hidden[node] or (tag == "header" and not inside[up])
            or (bool(names) and (tag not in _FRAME or tag == "article") and _template_name(names))
        )
    held = [False] * count  # holds an article
    for node in range(count - 1, 0, -1):
        if not out[node] and (page.tag[node] in ("article", "main") or held[node]):
            held[page.parent[node]] = True
    kept = {root[n] for n in range(1, count) if not out[n]}
    scope = "article" if "article" in kept else "main" if "main" in kept else ""
    for node in range(1, count):
        if scope and not held[node] and not (root[node] == "article" or scope == "main" and root[node] == "main"):
            out[node] = True
    return out, [i or h for i, h in zip(inside, held)]


def _by_rules(page: Page) -> tuple[list[bool], list[bool]]:
    """As ``_by_names``, with menus, which the share of links tells."""
    out, spared = _by_names(page)
    count = len(page.tag)
    links, chars, linked = [0] * count, [0] * count, [0] * count
    for node in range(count - 1, 0, -1):
        if out[node]:
            continue
        chars[node] += sum(len(x.strip()) for x in page.children[node] if isinstance(x, str))
        if page.tag[node] == "a":
            links[node], linked[node] = links[node] + 1, chars[node]
        up = page.parent[node]
        links[up], chars[up], linked[up] = links[up] + links[node], chars[up] + chars[node], linked[up] + linked[node]
    for node in range(1, count):
        up = page.parent[node]
        menu = links[node] >= 3 and linked[node] > LINK_SHARE * chars[node] and page.tag[node] in ("ul", "ol", "div", "section", "table", "dl", "center")
        out[node] = out[node] or out[up] or menu
    return out, spared


def _blocks(page: Page, out: list[bool]) -> list[str]:
    """The text of every block that is left, its white space made single spaces."""
    return [text for text, _ in _runs(page, out)]


def _runs(page: Page, out: list[bool]) -> list[tuple[str, int]]:
    """(text, element) of every block that is left; the element is one that holds text of the block."""
    blocks, run, held_by = [], [], 0

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append((text, held_by))

    stack: list = [(0, 0)]
    while stack:
        node, at = stack.pop()
        children = page.children[node]
        if at == len(children):
            if page.tag[node] in BLOCK:
                flush()
            continue
        stack.append((node, at + 1))
        child = children[at]
        if isinstance(child, str):
            run.append(child)
            held_by = node
        elif page.tag[child] == "br":
            run.append(" ")
        elif not out[child]:
            if page.tag[child] in BLOCK:
                flush()
            stack.append((child, 0))
        elif page.tag[child] in BLOCK:
            flush()
    flush()
    return blocks


def host_of(url: str = "url") -> Column:
    """The lower-cased host of a URL; null without one."""
    return F.nullif(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def _sightings(pages: DataFrame) -> DataFrame:
    """(host, node, main, content, shape): what the nodes of the hosts' style trees hold beside which main text, each once."""

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, source in zip(batch["host"], batch["html"]):
                rows += [(host, *f) for f in style_features(source)]
            yield pd.DataFrame(rows, columns=["host", "node", "main", "content", "shape"])

    sited = pages.select(host_of().alias("host"), F.col("html").cast("string").alias("html")).filter("host IS NOT NULL AND html IS NOT NULL")
    return sited.mapInPandas(features, "host string, node bigint, main bigint, content bigint, shape bigint").distinct()


def _importance(seen: DataFrame) -> DataFrame:
    both = seen.select("host", "node", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("content").alias("f")), F.struct(F.lit(1).alias("kind"), F.col("shape").alias("f")))).alias("x"))
    counted = both.groupBy("host", "node", F.col("x.kind").alias("kind"), F.col("x.f").alias("f")).agg(F.count("*").alias("c"))
    spread = F.col("c") * F.log("c")
    sums = counted.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("seen"),
        F.sum(F.when(F.col("kind") == 0, spread)).alias("content"), F.sum(F.when(F.col("kind") == 1, spread)).alias("shape"),
    )

    def entropy(total: str) -> Column:
        return (F.log("seen") - F.col(total) / F.col("seen")) / F.log("seen")

    weighed = CONTENT_WEIGHT * entropy("content") + (1 - CONTENT_WEIGHT) * entropy("shape")
    mains = seen.select("host", "node", "main").distinct().groupBy("host", "node").agg(F.count("*").alias("pages"))
    return mains.join(sums, ["host", "node"]).select("host", "node", "pages", F.when(F.col("seen") > 1, weighed).otherwise(F.lit(1.0)).alias("importance"))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of the nodes of the hosts' style trees that may be template.

    ``pages`` counts the different main texts beside the node.  Importance is the
    entropy of a node's contents, and to a smaller part of its presentations,
    beside them, as a share of the highest possible.  A node seen once has
    importance 1.
    """
    return _importance(_sightings(pages))


def extract(pages: DataFrame, name: str = "main_text", min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """Add the main text of ``html`` to every page (page_id, url, html and any more columns).

    Null or empty html gives an empty text, pages without a host are judged by
    themselves, whole pages of any length are read, copies and near copies of a
    page count once in their host's tree.  Only a node's contents that repeat
    beside different main texts are removed.  An existing column ``name`` is
    replaced.
    """
    seen = saved(_sightings(pages))
    template = _importance(seen).filter((F.col("pages") >= min_pages) & (F.col("importance") < low)).select("host", "node", "pages")
    shown = seen.select("host", "node", "content", "main").distinct().groupBy("host", "node", "content").agg(F.count("*").alias("_beside"))
    repeated = shown.join(template, ["host", "node"]).filter((F.col("_beside") >= 2) & (F.col("_beside") >= REPEATED * F.col("pages")))
    pair = F.udf(_pair, "bigint")("node", "content")
    by_host = saved(repeated.groupBy("host").agg(F.collect_set(pair).alias("_template")).withColumnRenamed("host", "_host"))
    nodes = by_host.agg(F.coalesce(F.sum(F.size("_template")), F.lit(0)).alias("n")).first()["n"]
    side = F.broadcast(by_host) if nodes <= BROADCAST_ROWS else by_host

    @F.pandas_udf("string")
    def text_of(sources: pd.Series, templates: pd.Series) -> pd.Series:
        sets: dict[bytes, frozenset[int]] = {}
        out = []
        for source, nodes_ in zip(sources, templates):
            if nodes_ is None:
                known: frozenset[int] = frozenset()
            else:
                at = nodes_.tobytes()
                known = sets.get(at) or sets.setdefault(at, frozenset(nodes_.tolist()))
            out.append(main_text(source, known))
        return pd.Series(out, dtype=object)

    joined = pages.withColumn("_host_of_page", host_of()).join(side, F.col("_host_of_page") == F.col("_host"), "left")
    return joined.withColumn(name, text_of(F.col("html").cast("string"), F.col("_template"))).drop("_host_of_page", "_host", "_template")


@query("op9_html_extraction")
def op9_html_extraction(spark, sf):
    found = extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))
