"""Main text of web pages by composite text density.

A page is read into block nodes; inline markup belongs to the block around it.
Elements that HTML or ARIA itself defines as no article text (navigation, forms,
scripts, page headers and footers, hidden elements, ...) are left out with all they
hold. For every remaining node:

    density = C / T * log(C / L * T / A) / log(ln(C * L / (C - L) + l * C / c + e))

with C characters, L of them in links, T tags, A of them links, and l, c the same
for the body. The text of blocks whose class or id says nothing but that they are
an advert, a notice, comments or the like is not counted, so their density is
nothing. The node with the largest sum of its children's densities is where the
article is; half the least density on its path to the body is the threshold, since
densities grow with the logarithm of a node's size. From the
body down that path, a branch off the path belongs to the text if its density
reaches the threshold, or if it is a heading without links. Below the node all
belongs to the text but branches that are link text for the most part, hold
controls or are so named, and stay below the threshold.

Every page is independent; a lost executor repeats its own split. Defined results:
null or empty html gives an empty text; unclosed or stray tags are closed or
skipped; a page without any block is one block; repeated rows give repeated
results; an empty table gives an empty table; columns other than the three named
are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Element names and roles of HTML and ARIA, and words that name parts of a page.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^<>"']*(?:"[^"<]*"[^<>"']*|'[^'<]*'[^<>"']*)*+)(>)?""", re.S)
MARK = re.compile("[\"'>]")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template", "svg", "math", "object", "select", "audio", "video", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
NEVER = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "head"}
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "body", "html", "div", "section", "article"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "status", "menu", "menubar", "toolbar", "tablist", "tooltip"}
CONTROLS = {"button", "form", "input", "select", "textarea", "fieldset"}
PARTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "sidebars", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar", "sitemap", "widget", "widgets"}
#: Words beside those above that don't say what a block holds.
PLAIN = {"area", "bar", "block", "body", "bottom", "box", "buttons", "container", "content", "form", "global", "group", "inner", "item", "items", "left", "links", "list", "main", "module", "outer", "panel", "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "stories", "text", "thread", "top", "unit", "user", "wrap", "wrapper", "page", "header", "articles", "policy", "message", "to", "and", "the", "id", "js", "l", "r", "x"}
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s/]|=\s*["']?(?!until|false)|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
WORDS = re.compile(r"[a-z]+")
SHARE = 0.5  # of the least density on the path is the threshold
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def names_of(attributes: str) -> list[tuple[str, str]]:
    """(attribute, value) of class, id and role."""
    return [(m[0].lower(), m[1] or m[2] or m[3]) for m in NAMES.findall(attributes)] if "=" in attributes else []


def left_out(name: str, attributes: str, inside: bool) -> bool:
    """Whether HTML or ARIA defines an element as no article text; inside: within an article or main element."""
    if name in NEVER or name == "header" and not inside:
        return True
    return bool(attributes) and (any(kind == "role" and v.strip().lower() in ROLES for kind, v in names_of(attributes)) or bool(HIDDEN.search(attributes)))


def named_part(attributes: str) -> bool:
    """Whether one of an element's names is made of words for such parts and of words that say nothing else."""
    for kind, value in names_of(attributes) if attributes else ():
        for token in value.split() if kind != "role" else ():
            words = set(WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()))
            if words & PARTS and words <= PARTS | PLAIN:
                return True
    return False


class Page:
    """Block nodes in page order, and runs of text that belong to them."""

    def __init__(self, source: str):
        self.name, self.parent = ["body"], [-1]
        self.chars, self.links, self.tags, self.anchors, self.controls = [0], [0], [0], [0], [0]
        self.named = [False]
        self.texts: list[tuple[int, int, str]] = []  # (node, run, text)
        self.read(source)

    def open(self, name: str, parent: int, named: bool) -> int:
        self.name.append(name)
        self.parent.append(parent)
        for counts in (self.chars, self.links, self.tags, self.anchors, self.controls):
            counts.append(0)
        self.named.append(self.named[parent] or named)
        self.tags[-1] = not self.named[-1]
        return len(self.name) - 1

    def read(self, source: str) -> None:
        # (element, node it belongs to, whether it's a block)
        stack: list[tuple[str, int, bool]] = []
        node, run, links, skipping, at, inside = 0, 0, 0, 0, 0, 0
        end, open_quotes = len(source), set()
        while at < end:
            m = TAG.search(source, at)
            text = source[at : m.start()] if m else source[at:]
            if text and not skipping:
                self.add(node, run, text, links > 0)
            if not m:
                break
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            closing, attributes = bool(m[1]), m[3]
            if not m[4]:
                stop = tag_end(source, at, open_quotes)
                attributes, at = attributes + source[at : stop - 1], stop
            if not skipping and name in CONTROLS:
                self.controls[node] += 1
            if not closing and name in RAW:
                shut = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                if shut is None:
                    if name in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"):
                        break
                    continue
                at = source.find(">", shut.start()) + 1 or end
                run += 1
                continue
            if name in VOID:
                if name in ("br", "hr"):
                    run += 1
                continue
            block = name not in INLINE
            run += block
            if closing:
                k = len(stack) - 1
                while k >= 0 and stack[k][0] != name:
                    if not block and stack[k][2]:
                        k = -1  # an inline end tag closes nothing beyond its block
                    else:
                        k -= 1
                if k >= 0:
                    node, skipping, links, inside = self.close(stack, k, skipping, links, inside)
                continue
            if name in ("html", "body"):
                continue
            if block:
                closes = {"p"} if name in ENDS_P else SAME_KIND.get(name, ())
                for k in range(len(stack) - 1, -1, -1):
                    if closes and stack[k][0] in closes:
                        node, skipping, links, inside = self.close(stack, k, skipping, links, inside)
                        break
                    if stack[k][0] in SCOPE:
                        break
            skip = skipping > 0 or left_out(name, attributes, inside > 0)
            stack.append((name, node, block))
            skipping += skip
            inside += name in ("article", "main")
            links += name == "a"
            if not skip:
                if name == "a":
                    self.anchors[node] += not self.named[node]
                    self.tags[node] += not self.named[node]
                elif block:
                    node = self.open(name, node, named_part(attributes))
            # a skipped element counts itself, so that its end tag counts back

    def close(self, stack, k, skipping, links, inside):
        while len(stack) > k:
            name, node, _ = stack.pop()
            skipping -= skipping > 0
            links -= name == "a"
            inside -= name in ("article", "main")
        return node, skipping, links, inside

    def add(self, node: int, run: int, text: str, linked: bool) -> None:
        if "&" in text:
            text = entities.unescape(text)
        self.texts.append((node, run, text))
        size = 0 if self.named[node] else len("".join(text.split()))
        self.chars[node] += size
        if linked:
            self.links[node] += size

    def whole(self, counts: list[int]) -> list[int]:
        """Counts of each node with all below it."""
        out = list(counts)
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out

    def densities(self) -> tuple[list[float], list[int], list[int]]:
        chars, links, tags, anchors = map(self.whole, (self.chars, self.links, self.tags, self.anchors))
        share = links[0] / max(1, chars[0])
        out = []
        for c, l, t, a in zip(chars, links, tags, anchors, strict=True):
            if not c:
                out.append(0.0)
                continue
            t, ratio = max(1, t), c / max(1, l) * max(1, t) / max(1, a)
            base = math.log(c * l / max(1, c - l) + share * c + math.e)
            out.append(c / t * max(0.0, math.log(ratio) / math.log(base) if base > 1.0000001 else math.log(ratio)))
        return out, chars, links

    def main_nodes(self) -> list[bool]:
        """Which nodes' texts belong to the article."""
        density, chars, links = self.densities()
        controls = self.whole(self.controls)
        n = len(density)
        sums = [0.0] * n
        for i in range(1, n):
            sums[self.parent[i]] += density[i]
        best = max(range(n), key=lambda i: (sums[i], -i)) if n > 1 else 0
        path = [best]
        while path[-1]:
            path.append(self.parent[path[-1]])
        threshold = SHARE * min(density[i] for i in path)
        on, keep = set(path), [False] * n
        for i in range(n):
            up = self.parent[i]
            if i in on:
                keep[i] = True
            elif up in on and up != best:
                keep[i] = density[i] >= threshold > 0 or self.name[i] in HEADINGS and links[i] == 0
            else:
                no_text = self.named[i] or controls[i] > 0 or chars[i] and 10 * links[i] >= 8 * chars[i]
                keep[i] = keep[up] and not (no_text and density[i] < threshold)
        return keep

    def main_text(self) -> str:
        keep = self.main_nodes()
        out, last = [], None
        for node, run, text in self.texts:
            if keep[node]:
                if run != last:
                    out.append(" ")
                out.append(text)
                last = run
        return " ".join("".join(out).split())


def tag_end(source: str, at: int, open_quotes: set[str]) -> int:
    """The place after the `>` of a tag whose quoted values hold `<`; a quote that nothing closes is an ordinary character."""
    while m := MARK.search(source, at):
        quote, at = m[0], m.end()
        if quote == ">":
            return at
        if quote not in open_quotes:
            shut = source.find(quote, at)
            if shut >= 0:
                at = shut + 1
            else:
                open_quotes.add(quote)
    return len(source) + 1


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in common.slices(b)):
            texts = [Page(s).main_text() if (s := x.as_py()) else "" for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["key", "url", "text", "n_chars"])

    rows = common.spread(pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(source).alias("html")))
    return rows.mapInArrow(run, f"key {kinds[0]}, url {kinds[1]}, text string, n_chars long").withColumnsRenamed({"key": key, "url": url})
