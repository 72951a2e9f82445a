"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import in_batches, whole

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""")
OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul".split())
#: A start tag on the left ends an open element of the kinds on the right.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
        "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
#: Elements that bound the search for what a start or end tag ends.
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "tbody": ("table",), "tfoot": ("table",)}
NOT_TEXT = frozenset("nav header footer aside form script style noscript button select option textarea iframe template dialog menu svg head title object canvas".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of a class or id that mark menus, notices, adverts and comments.
NOT_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                      "footer header masthead comment comments disqus reply replies cookie cookies consent notice notices popup modal newsletter subscribe social share "
                      "sharing related recommended widget pagination".split())


COMMENT_WORDS = frozenset("comment comments disqus reply replies".split())
#: A marked element is the page's own frame if it holds this share of all text and at most half of it is links.
FRAME_SHARE = 0.7
#: Elements beside the main part, directly in the body, that are read as parts of it.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup blockquote pre ul ol dl table figure section".split())


def _mark(tag: str, attributes: str) -> int:
    """1 if the element's role, class or id speak against it, 2 if they name reader comments, else 0."""
    if "=" not in attributes or tag in ("html", "body"):
        return 0
    mark = 0
    for name, a, b, c in NAMED.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "role":
            mark = max(mark, int(value in NOT_ROLES and tag not in ("article", "main")))
            continue
        found = set(re.split(r"[\s_\-:]+", value))
        if not COMMENT_WORDS.isdisjoint(found):
            mark = 2
        elif tag in ("article", "main"):
            mark = max(mark, int(not found.isdisjoint({"ad", "advert"})))
        elif not NOT_WORDS.isdisjoint(found):
            mark = max(mark, 1)
    return mark


class Page:
    """Nodes in page order (a parent before its children) with their counts, and the pieces of text."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.skip, self.link = [""], [-1], [False], [False]
        self.marks = [0]
        self.chars, self.count, self.link_chars, self.link_count = [0], [0], [0], [0]
        self.flow: list[tuple[int, str | None]] = []  # text of a node; None ends a block
        self.stack = [0]
        self.depths: dict[str, list[int]] = {}  # where in the stack each kind of element stands
        self._read(source)
        self._drop_marked()

    def _text(self, raw: str) -> None:
        node = self.stack[-1]
        if raw and not self.skip[node]:
            text = html.unescape(raw) if "&" in raw else raw
            self.flow.append((node, text))
            size = sum(map(len, text.split()))
            self.chars[node] += size
            if self.link[node]:
                self.link_chars[node] += size

    def _close(self, names: tuple[str, ...], bounds: tuple[str, ...] = ()) -> None:
        """Leave the innermost open element of these names, unless a bound stands inside it."""
        depth = max((d[-1] for n in names if (d := self.depths.get(n))), default=0)
        if depth and depth > max((d[-1] for n in bounds if n not in names and (d := self.depths.get(n))), default=0):
            left = self.stack[depth:]
            for n in left:
                self.depths[self.tags[n]].pop()
            if any(self.tags[n] in BLOCKS for n in left):
                self.flow.append((self.stack[depth], None))
            del self.stack[depth:]

    def _open(self, tag: str, attributes: str, stays: bool) -> int:
        if tag in BLOCKS:
            self._close(("p",), ("table", "button", "article", "section", "div", "td", "th", "li"))
            self.flow.append((self.stack[-1], None))
        if tag in ENDS:
            for _ in ENDS[tag] if tag in ("tr", "tbody", "tfoot") else (0,):
                self._close(ENDS[tag], SCOPES.get(tag, ()))
        parent = self.stack[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.skip.append(self.skip[parent] or tag in NOT_TEXT)
        self.marks.append(0 if self.skip[-1] else _mark(tag, attributes))
        self.link.append(self.link[parent] or tag == "a")
        for counts in (self.chars, self.count, self.link_chars, self.link_count):
            counts.append(0)
        node = len(self.tags) - 1
        if not self.skip[node]:
            self.count[node], self.link_count[node] = 1, int(tag == "a")
        if stays:
            self.depths.setdefault(tag, []).append(len(self.stack))
            self.stack.append(node)
        return node

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            hit = OPEN.search(source, at)
            if hit is None:
                self._text(source[at:])
                return
            start = hit.start()
            self._text(source[at:start])
            if source.startswith("<!--", start):
                close = source.find("-->", start + 4)
                at = end if close < 0 else close + 3
                continue
            tag = TAG.match(source, start)
            if tag is None:  # a doctype, an instruction, or a tag that the page's end cuts off
                close = source.find(">", start)
                at = end if close < 0 else close + 1
                continue
            at = tag.end()
            ending, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
            name = name.lower()
            if ending:
                self._close((name,), ("table", "body") if name in ("p", "li", "a", "b", "i", "em", "strong", "span") else ())
            elif name in VOID:
                if name == "br":
                    self.flow.append((self.stack[-1], " "))
                elif name == "hr":
                    self.flow.append((self.stack[-1], None))
                self._open(name, attributes, False)
            elif name in RAW:
                node = self._open(name, attributes, False)
                close = re.compile(rf"</{name}(?![^\s/>])[^>]*>", re.I).search(source, at)
                at = end if close is None else close.end()
                self.count[node] = 0
            else:
                self._open(name, attributes, not attributes.endswith("/") or name not in ("svg", "path"))

    def _sums(self, own: list[int]) -> list[int]:
        """Of every node the sum over its subtree."""
        total = own.copy()
        for n in range(len(total) - 1, 0, -1):
            total[self.parents[n]] += total[n]
        return total

    def _drop_marked(self) -> None:
        """Skip marked elements but frames: ones that hold an article or main, the headline, or most of the text.

        Reader comments are frames only with an article or main, every headline and most of the text in them. If an
        article or main stands outside all marked elements, none of these is a frame.
        """
        if not any(self.marks):
            return
        total = len(self.tags)
        chars, links = self._sums(self.chars), self._sums(self.link_chars)
        under, clear = [0] * total, False  # under: the strongest mark of the node and those above it
        for n in range(1, total):
            under[n] = max(under[self.parents[n]], self.marks[n])
            clear |= self.tags[n] in ("article", "main") and not under[n] and not self.skip[n] and chars[n] > 0
        articles = self._sums([int(t in ("article", "main") and m == 0 and not k) for t, m, k in zip(self.tags, self.marks, self.skip)])
        heads = self._sums([int(t == "h1" and not k and c > 0) for t, k, c in zip(self.tags, self.skip, chars)])
        for n in range(1, total):
            if self.marks[n] and not self.skip[n]:
                most = chars[n] >= FRAME_SHARE * chars[0] and 2 * links[n] <= chars[n]
                self.skip[n] = clear or not (most or articles[n] or heads[n] if self.marks[n] == 1 else most and articles[n] and heads[n] == heads[0])
            if self.skip[self.parents[n]]:
                self.skip[n] = True
            if self.skip[n]:
                self.chars[n] = self.count[n] = self.link_chars[n] = self.link_count[n] = 0

    def main_text(self) -> str:
        root, threshold, density = self._densest()
        if root is None:
            return ""
        named = self.tags[root] in ("article", "main")
        path, node = {root}, self.parents[root]
        while node >= 0:
            path.add(node)
            node = self.parents[node]
        kept = [False] * len(self.tags)  # parents come first
        for n in range(len(self.tags)):
            parent = self.parents[n]
            kept[n] = not self.skip[n] and (n == root or parent >= 0 and (kept[parent] or (not named and parent in path and n not in path and self._belongs(n, parent, threshold, density))))
        blocks, parts = [], []
        for node, text in [*self.flow, (0, None)]:
            if text is None:
                if block := " ".join("".join(parts).split()):
                    blocks.append(block)
                parts = []
            elif kept[node] or (node in path and not named and not self.skip[node]):
                parts.append(text)
        return "\n\n".join(blocks)

    def _belongs(self, n: int, parent: int, threshold: float, density: list[float]) -> bool:
        """If an element beside the path to the main part is of it: dense enough, or prose (links are under a third) in the same frame or of a kind that holds prose."""
        if not self.chars[n]:
            return False
        prose = 3 * self.link_chars[n] < self.chars[n]
        return density[n] >= threshold or prose and (self.tags[parent] not in ("", "html", "body") or self.tags[n] in PARTS)

    def _densest(self) -> tuple[int | None, float, list[float]]:
        """Node whose children's densities have the largest sum (its article, if it stands in one), and the body path's threshold."""
        total = len(self.tags)
        chars, count, link_chars, link_count = self.chars, self.count, self.link_chars, self.link_count
        for n in range(total - 1, 0, -1):
            parent = self.parents[n]
            chars[parent] += chars[n]
            count[parent] += count[n]
            link_chars[parent] += link_chars[n]
            link_count[parent] += link_count[n]
        if not chars[0]:
            return None, 0.0, []
        body_share = link_chars[0] / chars[0]
        density = [0.0] * total
        for n in range(total):
            if (c := chars[n]) and not self.skip[n]:
                t, lc, lt = max(1, count[n]), max(1, link_chars[n]), max(1, link_count[n])
                base = math.log(c / max(1, c - link_chars[n]) * link_chars[n] + body_share * c + math.e)
                density[n] = c / t * math.log(max(1.0, c / lc * t / lt)) / math.log(max(base, 1.0001)) if base > 1.0001 else c / t * math.log(max(1.0, c / lc * t / lt) + math.e - 1)
        sums, leaf = [0.0] * total, [True] * total
        for n in range(1, total):
            sums[self.parents[n]] += density[n]
            if density[n]:
                leaf[self.parents[n]] = False
        root = max(range(total), key=lambda n: (density[n] if leaf[n] else sums[n], -n))
        threshold, node = math.inf, root
        while node >= 0:
            threshold = min(threshold, density[node])
            if self.tags[node] == "body":
                break
            node = self.parents[node]
        for wanted in ("article", "main"):
            node = root
            while node >= 0:
                if self.tags[node] == wanted and not self.skip[node]:
                    return node, threshold, density
                node = self.parents[node]
        return root, threshold, density


def main_text(source: str) -> str:
    return Page(source).main_text()


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: ``key``, ``url``, text, n_chars (code points).

    The main part is the densest node's article or main. Without one it is the densest node with
    the prose around it. Roles, classes and ids that name menus, notices, adverts or comments speak
    against an element, unless it is the frame of the main part.
    The text is the page's main part: character references are decoded, white space inside a
    block becomes one space, blocks are trimmed and joined by an empty line in page order. It is
    empty for a null page and for one without text. Whole pages are read, nothing is shuffled;
    repeated rows stay, other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(s) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["id", "address", "text", "n_chars"])

    schema = "id long, address string, text string, n_chars long"
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("address"), whole(source).alias("source"))
    return in_batches(rows, run, schema).withColumnsRenamed({"id": key, "address": url})
