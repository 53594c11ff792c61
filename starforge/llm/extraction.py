"""Main text of web pages, by wrappers inferred for each host.

A page is a stream of tokens: tags and texts. The streams of the pages of a host are aligned one after the other into
a wrapper, a regular expression without alternatives: equal tokens stay, texts that differ become slots, tags that
only some pages have become optional, and neighbours of one form become a repeated group. Tags nest, so streams are
aligned level by level: at each level an alignment of highest weight says which elements belong together, and the
levels below follow. A slot gathers how many pages fill it, with how many code points and how many of them in links;
a text that is the same on all pages stays fixed.

The wrapper tells template from article where markup alone does not. A block of text is dropped if it stands

* in an element for menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments,
  by its tag, role, class or id;
* outside the region of the article, where the page marks one (``article``, else ``main``, else a class for content);
* in a slot that is fixed on at least ``LEAST_PAGES`` different pages and half of its host's (headings of the article stay);
* in a slot whose text is nearly all links.

What is left is decoded, white space becomes one blank, and blocks are joined in page order.

At scale: tasks align the pages they read into one wrapper per host, and wrappers are merged in rounds of about
``FAN_IN`` per task, dealt by hash, so no host is ever gathered in one task; a wrapper's size is bounded by the
labels of its levels, not by the number of pages. Pages then join the wrapper of their host; the planner broadcasts
wrappers only below its size limit, else the join shuffles and large hosts are split by adaptive execution.

Defined results: null and empty pages, and pages without an article, give the empty text and 0 code points. Pages
whose url has no host share the host ''. Equal rows give equal results; a page's copies count as one page where
fixed text is decided. Unclosed tags end where HTML says (paragraphs, list items, cells) or with what encloses them;
what follows an unclosed comment, script or style belongs to it. Elements nested deeper than ``DEPTH`` belong to the
element at that depth. A table without rows gives none; missing columns are null, others ignored, whatever their
names. A very long page costs a task its blocks of text and one node for each element.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import keep_named, ready, stored

#: Wrappers merged by one task in a round.
FAN_IN = 16
#: Hosts whose wrappers a task holds before it hands them on.
HELD_HOSTS = 2_000
#: Levels with more items become one repeated group of optional items, each label once; with more labels than the
#: second bound classes no longer tell labels apart.
LEVEL_ITEMS, LEVEL_LABELS = 24, 200
#: Widest repeated group of several elements.
GROUP_WIDTH = 4
DEPTH = 60
#: Different pages that must show a fixed text before it counts as template.
LEAST_PAGES = 5
#: Share of a slot's code points in links from which on it is a menu: in the article's region, and elsewhere.
LINKS_INSIDE, LINKS_OUTSIDE = 0.9, 0.6

# HTML's elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup "
             "time tt u var wbr img br".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
DROPPED = set("nav header footer aside form button select textarea script style noscript template iframe object svg canvas audio video dialog menu head title "
              "option datalist map fieldset".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
             "menu nav ol p pre section summary table ul".split())
#: Elements that end an open one of these names, unless a list or table lies between.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
#: Words of a class, id or role that name template, and those that name the article.
TEMPLATE_WORDS = set("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb
    breadcrumbs sidebar widget widgets footer header masthead banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
    subscribe subscription signup share sharing social related recommended recommendations comment comments disqus respond reply replies pagination pager login
    search searchbox searchform toolbar copyright complementary contentinfo skiplink""".split())
ARTICLE_WORDS = set("article content entry post story".split())

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


@dataclass(slots=True)
class Block:
    """A stretch of text inside one block element."""
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    dropped: bool = False
    region: int = 0  # 3 article, 2 main, 1 an element classed as content, 0 none
    heading: bool = False
    text: str = ""


@dataclass(slots=True)
class Element:
    """An open or closed block element; ``label`` is its tag and classes."""
    name: str
    label: str
    dropped: bool
    region: int
    header: bool  # of an article: its headings stay
    inline: bool = False
    items: list = field(default_factory=list)


def parse(page: str) -> tuple[Element, list[Block]]:
    """Tree of the block elements of a page, and its blocks of text in page order."""
    root = Element("", "", False, 0, False)
    stack, blocks = [root], []
    at, end, block = 0, len(page), None
    link = 0  # the depth at which a link is open

    def text(raw: str) -> None:
        nonlocal block
        if block is None:
            if not raw.strip():
                return
            top = stack[-1]
            heading = any(e.name in HEADINGS for e in stack[-3:])
            block = Block(dropped=top.dropped or top.header and not heading, region=top.region, heading=heading)
            blocks.append(block)
            next(e for e in reversed(stack) if not e.inline).items.append(block)
        elif stack[-1].dropped and not block.dropped:
            return  # template inside a paragraph
        raw = html.unescape(raw) if "&" in raw else raw
        block.parts.append(raw)
        if link:
            block.linked += len(raw)

    def pop_to(k: int) -> None:
        nonlocal block, link
        if k < link:
            link = 0
        if not all(e.inline for e in stack[k:]):
            block = None
        elif block is not None and block.dropped:
            block = None  # a dropped stretch of text ends with its element
        del stack[k:]

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                link = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    pop_to(k)
                    break
            continue
        attrs = m["attrs"]
        if name in RAW:
            done = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = done.end() if done else end
            continue
        if name == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                block = None
            continue
        if name == "a":
            link = len(stack)
        words, classes, region = _named(attrs)
        template = bool(words & TEMPLATE_WORDS) and name not in ("html", "body", "main", "article")
        if name in INLINE:
            if template:  # dropped inside its paragraph
                stack.append(Element(name, name, True, stack[-1].region, False, True))
            continue
        block = None
        if name in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    pop_to(k)
                if not stack[k - 1].inline and stack[k - 1].name != "p":
                    break
        if name in SIBLINGS:
            ended, within = SIBLINGS[name]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in within:
                    break
                if stack[k].name in ended:
                    pop_to(k)
                    if name != "tr":
                        break
        up = stack[-1]
        own = 3 if name == "article" or region == 3 else 2 if name == "main" or region == 2 else 1 if words & ARTICLE_WORDS and name in ("div", "section", "td") else 0
        header = name == "header" or template and words & TEMPLATE_WORDS == {"header"}
        in_article = header and (up.region >= 1 or bool(words & ARTICLE_WORDS))
        e = Element(name, name + classes, up.dropped or (name in DROPPED or template) and not in_article, max(up.region, own), up.header or in_article)
        if len(stack) <= DEPTH:
            next(x for x in reversed(stack) if not x.inline).items.append(e)
        else:
            e.items = next(x for x in reversed(stack) if not x.inline).items
        stack.append(e)
    if at < end:
        text(page[at:])
    for b in blocks:
        b.text = " ".join("".join(b.parts).split())
    return root, blocks


def _named(attrs: str) -> tuple[set[str], str, int]:
    """Words of class, id and role; the classes without their digits, as part of a label; the region an attribute marks."""
    if "=" not in attrs:
        return set(), "", 0
    words, classes, region = set(), "", 0
    for m in _ATTR.finditer(attrs):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "itemprop":
            region = 3 if value.lower() == "articlebody" else region
            continue
        if kind == "role":
            region = max(region, {"main": 2, "article": 3}.get(value.lower(), 0))
        if kind == "class":
            classes = "".join("." + c for c in sorted({_DIGITS.sub("0", c.lower()) for c in value.split()}))
        words |= {w.lower() for w in _WORD.findall(value)}
    return words, classes, region


# ---- wrappers
# Items of a level: text ["#", optional, fixed, seen, pages, points, linked] and element [label, optional, repeated, items];
# a repeated group of several items has the label "(" and their labels.

TEXT = "#"


def _marks(item: list) -> set:
    """Labels of an element's items, and its fixed texts."""
    return {x[0] for x in item[3]} | {x[2] for x in item[3] if x[0] == TEXT}


def _weight(a: list, b: list) -> float:
    """How well two items belong together; 0 if they can't."""
    if a[0] != b[0]:
        return 0.0
    if a[0] == TEXT:
        return 1.5 if a[2] is not None and a[2] == b[2] else 1.0
    x, y = _marks(a), _marks(b)
    return 1.0 + (len(x & y) / len(x | y) if x or y else 1.0)


def _join(a: list, b: list) -> list:
    """One item for two of a label."""
    if a[0] == TEXT:
        return [TEXT, a[1] and b[1], a[2] if a[2] == b[2] else None, a[3] | b[3], a[4] + b[4], a[5] + b[5], a[6] + b[6]]
    return [a[0], a[1] and b[1], a[2] or b[2], merge(a[3], b[3])]


def _optional(item: list) -> list:
    return [item[0], True, *item[2:]]


def _one_each(items: list) -> list:
    """Each label once, optional: the body of a repeated group that takes the labels in any order."""
    out: dict[str, list] = {}
    for x in items:
        for y in x[3] if x[0].startswith("(") else [x]:
            out[y[0]] = _optional(_join(out[y[0]], y) if y[0] in out else y)
    if len(out) > LEVEL_LABELS:
        plain: dict[str, list] = {}
        for x in out.values():
            x = [x[0].split(".")[0], *x[1:]]
            plain[x[0]] = _optional(_join(plain[x[0]], x) if x[0] in plain else x)
        out = plain
    return list(out.values())


def _fold(items: list) -> list:
    """Neighbours of one form become a repeated group."""
    for width in range(1, GROUP_WIDTH + 1):
        out, k = [], 0
        while k < len(items):
            form = [x[0] for x in items[k:k + width]]
            stop = k + width
            if len(form) == width and any(_telling(f) for f in form):
                while [x[0] for x in items[stop:stop + width]] == form:
                    stop += width
            if stop == k + width or stop > len(items):
                out.append(items[k])
                k += 1
                continue
            body = items[k:k + width]
            for j in range(k + width, stop, width):
                body = [_join(x, y) for x, y in zip(body, items[j:j + width])]
            out.append([body[0][0], body[0][1], True, body[0][3]] if width == 1 else ["(" + " ".join(form), all(x[1] for x in body), True, body])
            k = stop
        items = out
    if len(items) > LEVEL_ITEMS:
        body = _one_each(items)
        return [["(*", False, True, body]]
    return items


def _telling(label: str) -> bool:
    """Whether neighbours of a label have one form. Texts, groups, and containers without a class may stand for anything."""
    return label not in (TEXT, "div", "section", "table", "tr", "td", "center") and not label.startswith("(")


def merge(a: list, b: list) -> list:
    """Align two levels: an alignment of highest weight joins items, all others become optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_join(x, y) for x, y in zip(a, b)]
    if a and b and "(*" in (a[0][0], b[0][0]):
        return [["(*", False, True, _one_each(a + b)]]
    n, m = len(a), len(b)
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            w = _weight(a[i], b[j])
            row[j] = max(below[j], row[j + 1], w + below[j + 1] if w else 0.0)
    out, i, j = [], 0, 0
    while i < n and j < m:
        w = _weight(a[i], b[j])
        if w and best[i][j] == w + best[i + 1][j + 1]:
            out.append(_join(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return _fold(out + [_optional(x) for x in a[i:] + b[j:]])


def page_wrapper(root: Element, bit: int) -> list:
    """The wrapper of one page alone."""
    out = []
    for x in root.items:
        if isinstance(x, Element):
            out.append([x.label, False, False, page_wrapper(x, bit)])
        elif x.text:
            item = [TEXT, False, zlib.crc32(x.text.encode()), bit, 1, len(x.text), min(len(x.text), x.linked)]
            if out and out[-1][0] == TEXT:
                out[-1] = _join(out[-1], item)
            else:
                out.append(item)
    return _fold(out)


def page_bit(blocks: list[Block]) -> int:
    """One of 63 bits by the page's text: the bits set by several pages bound from below how many of them differ."""
    return 1 << zlib.crc32("\n".join(b.text for b in blocks if not b.dropped).encode()) % 63


def _own_marks(x: Element) -> set:
    """As ``_marks``, of a page's element."""
    return {y.label if isinstance(y, Element) else TEXT for y in x.items} | {zlib.crc32(y.text.encode()) for y in x.items if isinstance(y, Block)}


def _fit(unit: list, label: str, item: list) -> tuple[float, list | None]:
    """How well a run of a page's items fits an item of the wrapper, and the item that its parts follow."""
    if item[0].startswith("("):
        hit = next((y for y in item[3] if y[0] == label or y[0] == label.split(".")[0]), None)
        return (1.0 if hit else 0.0), hit
    if item[0] != label:
        return 0.0, None
    if label == TEXT:
        return (1.5 if item[2] is not None and item[2] == zlib.crc32(unit[0].text.encode()) else 1.0), item
    x, y = _own_marks(unit[0]), _marks(item)
    return 1.0 + (len(x & y) / len(x | y) if x or y else 1.0), item


def place(root: Element, wrapper: list, found: dict[int, list]) -> None:
    """Align a page with its host's wrapper: the slot of every block of text, by the block's identity.

    Runs of one telling label are one unit. A wrapper's level has at most LEVEL_ITEMS items, so a level costs a bounded
    number of steps for each unit.
    """
    units: list[tuple[str, list]] = []
    for x in root.items:
        label = x.label if isinstance(x, Element) else TEXT
        if units and units[-1][0] == label and _telling(label):
            units[-1][1].append(x)
        else:
            units.append((label, [x]))
    n, m = len(units), len(wrapper)
    fits = [[_fit(unit, label, w) for w in wrapper] for label, unit in units]
    best = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            w = fits[i][j][0]
            stay = below[j] if wrapper[j][0] != TEXT and wrapper[j][2] else below[j + 1]
            row[j] = max(below[j], row[j + 1], w + stay if w else 0.0)
    i = j = 0
    while i < n and j < m:
        w, hit = fits[i][j]
        many = wrapper[j][0] != TEXT and wrapper[j][2]
        if w and best[i][j] == w + best[i + 1][j if many else j + 1]:
            for x in units[i][1]:
                if isinstance(x, Element):
                    place(x, hit[3], found)
                else:
                    found[id(x)] = hit
            i, j = i + 1, j if many else j + 1
        elif best[i][j] == best[i][j + 1]:
            j += 1
        else:
            i += 1


@dataclass(slots=True)
class Wrapper:
    """A host's wrapper with the number of its pages."""
    items: list
    pages: int

    def template(self, slot: list, block: Block, inside: bool) -> bool:
        """Whether the slot holds text of the host rather than of its pages."""
        _, _, fixed, seen, pages, points, linked = slot
        many = seen.bit_count() >= LEAST_PAGES and 2 * pages >= self.pages
        if fixed is not None and many and not (inside and block.heading):
            return True
        share = linked / points if points else 0.0
        return share >= LINKS_INSIDE and seen.bit_count() >= LEAST_PAGES if inside else share >= LINKS_OUTSIDE


def main_text(page: str | None, wrapper: Wrapper | None) -> str:
    """The article's blocks, one to a line."""
    if not page:
        return ""
    root, blocks = parse(page)
    found: dict[int, list] = {}
    if wrapper:
        place(root, wrapper.items, found)
    kept = [b for b in blocks if b.text and not b.dropped]
    region = max((b.region for b in kept), default=0)
    out = []
    for b in kept:
        title = b.heading and b.region == 2 and region == 3
        if b.region < region and not title:
            continue
        slot = found.get(id(b))
        if slot is None or not wrapper.template(slot, b, region > 0):
            out.append(b.text)
    return "\n".join(out)


# ---- jobs

def host_of(url: Column) -> Column:
    """Lower-case host and port of a url; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#\s]*)", 1)), F.lit(""))


WRAPPERS = "host string, wrapper string, pages long"


def infer_wrappers(pages: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(host, wrapper, pages): the wrapper of all pages of each host; ``pages`` has host and html."""
    ready(pages.sparkSession)

    def shown(held: dict[str, tuple[list, int]]) -> pd.DataFrame:
        return pd.DataFrame([(h, json.dumps(w, separators=(",", ":")), n) for h, (w, n) in held.items()], columns=["host", "wrapper", "pages"])

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[list, int]] = {}
        for pdf in batches:
            for host, page in zip(pdf["host"], pdf["html"]):
                root, blocks = parse(page)
                own = page_wrapper(root, page_bit(blocks))
                before = held.get(host)
                held[host] = (merge(before[0], own), before[1] + 1) if before else (own, 1)
            if len(held) > HELD_HOSTS:
                yield shown(held)
                held = {}
        if held:
            yield shown(held)

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["pages", "wrapper"], ascending=[False, True])
        items = None
        for text in pdf["wrapper"]:
            more = json.loads(text)
            items = more if items is None else merge(items, more)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "wrapper": [json.dumps(items, separators=(",", ":"))], "pages": [int(pdf["pages"].sum())]})

    found = stored(pages.where("length(html) > 0").select("host", "html").mapInPandas(align, WRAPPERS), "wrappers")
    while True:
        size = stored(found.groupBy("host").agg(F.count("*").alias("parts")), "wrapper-parts")
        if not size.where("parts > 1").limit(1).count():
            return found
        dealt = found.join(size, "host").withColumn("deal", F.pmod(F.xxhash64("wrapper", "pages"), F.ceil(F.col("parts") / fan_in)))
        alone = dealt.where("parts = 1").select("host", "wrapper", "pages")
        merged = dealt.where("parts > 1").groupBy("host", "deal").applyInPandas(lambda pdf: unite(pdf), WRAPPERS)
        found = stored(merged.unionByName(alone), "wrappers")


def extract(pages: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    rows = keep_named(pages, {"page_id": "long", "url": "string", "html": "string"}).withColumn("host", host_of(F.col("url")))
    wrappers = infer_wrappers(rows, fan_in)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, Wrapper] = {}
        for pdf in batches:
            out = []
            for page, host, text, n in zip(pdf["html"], pdf["host"], pdf["wrapper"], pdf["pages"]):
                if page and host not in known:
                    if len(known) >= HELD_HOSTS:
                        known.clear()
                    known[host] = Wrapper(json.loads(text), int(n))
                out.append(main_text(page, known.get(host)))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": out, "n_chars": [len(t) for t in out]})

    return rows.join(wrappers, "host", "left").select("page_id", "url", "html", "host", "wrapper", "pages").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
