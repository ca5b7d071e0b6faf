"""Main text of web pages by tag-path ratios.

A page is read into text nodes under root-to-leaf paths of block elements (with
their class and id; inline markup belongs to its block).  Elements that can't be
article text by their HTML meaning, and blocks whose class, id or role says menu,
advert, notice, comment and the like, are left out first.  For every other path
the text length, punctuation and link text of all its nodes are added up; the
two ratios (characters a node, and punctuation marks a node) are fused by multiplication, smoothed a little over
the means of the path's ancestors and weighed by the share of text outside links; paths
below a share of the page's mean are dropped.  A heading goes with the text that follows it.
If the page marks an ``article`` or ``main`` element, only paths inside it compete, against the same floor; lists, tables and
quotations there that follow kept text go with it, since their short items have low ratios wherever they stand.

Defined cases: null or empty html gives ''; unclosed, misnested and unknown
tags are read the way browsers do; markup with no main text gives ''; if the class words
rule out everything, they are ignored for that page; repeated rows are each
read; a path whose score equals the floor stays; an empty table gives an empty result; other columns aren't read.
A page of any length is read whole, in time linear in it.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A path scoring below this share of its page's mean is boilerplate.
SHARE = 0.4
#: Weight of a path's own ratio; the rest is that of its ancestors.
OWN = 0.95

# HTML element kinds and words of boilerplate blocks.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd td th caption figcaption pre blockquote".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
NEVER = frozenset("head script style title textarea noscript iframe template nav footer aside form select option "
                  "button dialog menu svg canvas object audio video map datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr nobr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
          "th": ("table", "tr"), "option": ("select",), "p": ("article", "main", "section", "div", "td", "th", "body")}
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav "
                        "navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar widget widgets cookie "
                        "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
                        "login share sharing social related recommended comment comments disqus respond reply replies "
                        "pagination pager search form toolbar contentinfo complementary dialog".split())
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
PUNCTUATION = re.compile(r"[.,;:!?。、，！？；：…]")

# What isn't an element's tag; a tag's attributes have any number and length, so its end is sought by Tags.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|[^<]+|<""", re.S)
TAG = re.compile(r"</?[A-Za-z]")
NAME_END = re.compile(r"[\s/>]")
MARK = re.compile(r"""=\s*["']|>""")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")


class Ahead:
    """Next place of a pattern at or after positions asked in rising order (the length if none): one pass in all."""

    def __init__(self, pattern: re.Pattern, html: str):
        self.pattern, self.html, self.since, self.next = pattern, html, 0, -1

    def __call__(self, at: int) -> int:
        if not self.since <= at <= self.next:
            m = self.pattern.search(self.html, at)
            self.since, self.next = at, m.start() if m else len(self.html)
        return self.next


class Tags:
    """Reads the tags of one page, asked for at rising positions, in linear time."""

    def __init__(self, html: str):
        self.html, self.name_end, self.mark = html, Ahead(NAME_END, html), Ahead(MARK, html)
        self.dead: set[int] = set()  # quoted values from which no end of a tag is reached

    def read(self, at: int):
        """(end, closing, name, attributes) of the tag at ``at``, None if there is none or it doesn't end."""
        m = TAG.match(self.html, at)
        if not m:
            return None
        name = self.name_end(m.end())
        end = self._close(name)
        return end and (end, m[0][1] == "/", self.html[m.end() - 1:name].lower(), self.html[name:end - 1])

    def _close(self, at: int) -> int | None:
        """Place after the first > outside quoted values.

        As in browsers a quote elsewhere than after = is an ordinary character; so is one without a second.
        """
        html, size, seen, i = self.html, len(self.html), [], self.mark(at)
        while i < size and i not in self.dead:
            if html[i] == ">":
                return i + 1
            seen.append(i)
            quote = MARK.match(html, i).end() - 1
            m = MARK.search(html, max(html.find(html[quote], quote + 1), quote) + 1)
            i = m.start() if m else size
        self.dead.update(seen)
        return None


class Page:
    """Text nodes of one page, in order, with the block path of each."""

    def __init__(self, html: str, use_names: bool = True):
        self.parent, self.marked, self.heading, self.whole, self.item = [-1], [False], [False], [True], [False]  # by path; 0 is the root
        self.nodes: list[tuple[int, str, bool]] = []  # path (-1: a break between blocks), text, in a link
        self._number: dict[tuple[int, str], int] = {}
        self._read(html, use_names)

    def _path(self, parent: int, label: str, marks: bool) -> int:
        key = (parent, label)
        if key not in self._number:
            self._number[key] = len(self.parent)
            self.parent.append(parent)
            self.marked.append(marks or self.marked[parent])
            self.heading.append(label.split(".", 1)[0] in HEADINGS)
            self.whole.append(label.split(".", 1)[0] in ("html", "body"))
            self.item.append(label.split(".", 1)[0] in ITEMS or self.item[parent])
        return self._number[key]

    def common(self, a: int, b: int) -> int:
        """The deepest path that both lie in (parents have smaller numbers than their children)."""
        while a != b:
            a, b = (self.parent[a], b) if a > b else (a, self.parent[b])
        return a

    def _read(self, html: str, use_names: bool) -> None:
        # Open elements: (tag, path, skipped, in a link)
        stack = [("", 0, False, False)]
        opened: dict[str, int] = {}  # how many of each tag are open

        def close(i: int) -> None:
            for tag, *_ in stack[i:]:
                opened[tag] -= 1
            del stack[i:]

        at, size, tags = 0, len(html), Tags(html)
        while at < size:
            found = tags.read(at)
            tag, path, skipped, linked = stack[-1]
            if not found:
                m = TOKEN.match(html, at)
                at = m.end()
                if not skipped and not m[0].startswith(("<!", "<?")):
                    self.nodes.append((path, unescape(m[0]), linked))
                continue
            at, closing, name, attributes = found
            if name not in INLINE:
                self.nodes.append((-1, "", False))
            if closing:
                if opened.get(name):
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name))
                continue
            if name in VOID:
                continue
            closes = ("p",) if name in CLOSES_P else SIBLINGS.get(name, ())
            if any(opened.get(c) for c in closes):
                stop = SCOPES["p"] if name in CLOSES_P else SCOPES[name]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in closes:
                        close(i)
                        break
                    if stack[i][0] in stop:
                        break
                tag, path, skipped, linked = stack[-1]
            if name in RAW:
                end = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
                at = end.start() if end else size
            words = {w for v in NAMES.findall(attributes) for w in WORDS.findall("".join(v).lower())} if attributes else set()
            inside = self.marked[path]
            skip = (skipped or name in NEVER or (name == "header" and not inside)
                    or (use_names and bool(words & (COMMENTS if name in ("html", "body", "article", "main") else BOILERPLATE))))
            if name not in INLINE:
                path = self._path(path, name + "." + ".".join(sorted(words)), name in ("article", "main"))
            stack.append((name, path, skip, linked or name == "a"))
            opened[name] = opened.get(name, 0) + 1


def scores(page: Page) -> tuple[dict[int, float], float, bool]:
    """Smoothed fused ratio of every path that has text, the page's mean, and whether it marks its article."""
    length, marks, links, count = {}, {}, {}, {}
    for path, text, linked in page.nodes:
        n = len(text.strip()) if path >= 0 else 0
        if n:
            length[path] = length.get(path, 0) + n
            marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
            links[path] = links.get(path, 0) + n * linked
            count[path] = count.get(path, 0) + 1
    marked = any(page.marked[p] for p in length)
    if marked:
        length = {p: n for p, n in length.items() if page.marked[p]}
    fused = {p: n / count[p] * (1 + marks[p] / count[p]) for p, n in length.items()}
    # Means over the subtree of each path, weighed by length: children come after their parents.
    size = len(page.parent)
    weight, total = [0.0] * size, [0.0] * size
    for p, n in length.items():
        weight[p], total[p] = n, n * fused[p]
    for p in range(size - 1, 0, -1):
        weight[page.parent[p]] += weight[p]
        total[page.parent[p]] += total[p]
    # Half of a path's value is its own mean, half that of its parent, and so on up to the root.
    smooth = [0.0] * size
    for p in range(size):
        mean = total[p] / weight[p] if weight[p] else 0.0
        smooth[p] = 0.5 * mean + 0.5 * smooth[page.parent[p]] if p else mean
    return ({p: (OWN * fused[p] + (1 - OWN) * smooth[p]) * (1 - links[p] / n) for p, n in length.items()}, smooth[0], marked)


def kept_nodes(page: Page, share: float = SHARE) -> list[bool]:
    """Which nodes are main text: those of paths at or above the floor, headings that such text follows, what
    stands between two such nodes inside a container of both that is smaller than the page (cells of a table, short items),
    and items that follow the last such node in a marked article."""
    found, mean, marked = scores(page)
    floor = share * mean
    keep = {p for p, s in found.items() if s >= floor}
    out = [p in keep for p, _, _ in page.nodes]
    after = -1
    for i in range(len(out) - 1, -1, -1):
        p, text, _ = page.nodes[i]
        if p in found and not text.isspace():
            if page.heading[p]:
                out[i] = out[i] or after in keep
            else:
                after = p
    last, waiting = None, []
    for i, (p, text, _) in enumerate(page.nodes):
        if out[i] and not text.isspace():
            if waiting and last is not None:
                around = page.common(last, p)
                if marked and around in (last, p):  # blocks of one path stand beside each other in its parent
                    around = max(page.parent[around], 0)
                for j in waiting:
                    out[j] = not page.whole[around] and page.common(around, page.nodes[j][0]) == around
            last, waiting = p, []
        elif found.get(p, 0) > 0 and not text.isspace():
            waiting.append(i)
    for j in waiting if marked and last is not None else []:
        if not page.item[page.nodes[j][0]]:
            break
        out[j] = True
    return out


def main_text(html: str, share: float = SHARE) -> str:
    for use_names in (True, False):
        page = Page(html, use_names)
        keep = kept_nodes(page, share)
        text = " ".join("".join(" " if p < 0 else t for (p, t, _), k in zip(page.nodes, keep) if p < 0 or k).split())
        if text:
            return text
    return ""


def extract(html: Column, share: float = SHARE) -> Column:
    """Main text of an html column."""

    @F.arrow_udf("string")
    def read(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "", share) for p in pages], pa.string())

    return read(html)


def extract_pages(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    return pages.select("page_id", "url", extract(F.col("html"), share).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
