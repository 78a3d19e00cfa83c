"""Main text of HTML pages by tree scoring.

Each block of text earns points for its length and commas, less by its share of link text, and passes them to its ancestors, less with every step.
The element with the most points is the container; an enclosing article or main element takes its place. The container and those of its
siblings that score well too are kept, without the parts that are boilerplate by their element or by the words of their class, id or role.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {  # a start tag ends these open elements
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "option": {"select"}}
#: Never article text.
DROPPED = frozenset("head nav footer aside form script style noscript template iframe textarea title button select option svg math canvas object audio video dialog menu xmp noembed noframes datalist".split())
#: Words of class, id and role that mark boilerplate.
MARKED = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored banner promo promotion cookie cookies consent gdpr notice popup modal overlay sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus respond footer header masthead share sharing social related recommended "
    "newsletter subscribe subscription signup login search toolbar pagination pager widget complementary contentinfo dialog alertdialog".split()
)
WHOLE = frozenset(("html", "body", "article", "main"))
#: Marks of readers' comments.
COMMENTS = frozenset("comment comments disqus respond".split())
#: First or last words of names that tell a state.
STATES = frozenset("has no with without open closed".split())
#: Ancestors that get points; further ones would get less than this part of them.
STEPS = 32
#: A sibling stays if it has at least this share of the container's points.
SIBLING = 0.2
#: So does one beside a container that is no article, if at most this share of its text is in links and a block of it has so many points (80 characters
#: without a comma), or it has no links and ends as a sentence does.
LINKED, LEAST_POINTS = 0.25, 1.8
SENTENCE = frozenset(".!?\u2026\u3002\uff01\uff1f\"'\u201d\u2019")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_END = re.compile(r"""(?>(?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


class Page:
    """A light tree: parallel lists by element, and the texts and breaks in page order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.marks = ["html"], [-1], [""]
        self.items: list[tuple[int, str | None]] = []  # (element, text), or (element, None) at an edge of a block
        self.depth: dict[str, int] = {}  # how many of an element are open
        self._read(html)

    def _close(self, stack: list[int], k: int) -> None:
        for element in stack[k:]:
            self.depth[self.tag[element]] -= 1
        del stack[k:]

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag not in INLINE:
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends where a block begins
                if self.tag[stack[k]] == "p":
                    self._close(stack, k)
                    break
                if self.tag[stack[k]] not in INLINE:
                    break
            for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
                name = self.tag[stack[k]]
                if name in CLOSES.get(tag, ()):
                    self._close(stack, k)
                elif name in HOLDS[tag]:
                    break
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.marks.append(" ".join("".join(m) for m in _MARKS.findall(attributes)).lower() if "=" in attributes else "")
        self.depth[tag] = self.depth.get(tag, 0) + 1
        stack.append(len(self.tag) - 1)
        if tag not in INLINE:
            self.items.append((stack[-1], None))

    def _read(self, html: str) -> None:
        stack, at, n = [0], 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0 or lt == n - 1:
                self.items.append((stack[-1], html[at:]))
                break
            following = html[lt + 1]
            if not (following.isascii() and following.isalpha()) and following not in "/!?":
                self.items.append((stack[-1], html[at : lt + 1]))
                at = lt + 1
                continue
            if lt > at:
                self.items.append((stack[-1], html[at:lt]))
            if following in "!?":
                if html.startswith("<!--", lt):
                    end = html.find("-->", lt + 2)
                    at = n if end < 0 else end + 3
                else:
                    end = html.find(">", lt)
                    at = n if end < 0 else end + 1
                continue
            name = _NAME.match(html, lt + 1 + (following == "/"))
            if name is None:  # </ without a name is a comment
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            end = _END.match(html, name.end())
            if end is None:
                break  # the page stops inside a tag
            tag, at = name.group().lower(), end.end()
            if following == "/":
                for k in range(len(stack) - 1, 0, -1) if self.depth.get(tag) else ():
                    if self.tag[stack[k]] == tag:
                        if tag not in INLINE:
                            self.items.append((stack[k], None))
                        self._close(stack, k)
                        break
                    if tag in INLINE and self.tag[stack[k]] not in INLINE:
                        break
                continue
            self._open(stack, tag, html[name.end() : at - 1])
            if tag in VOID or html[at - 2] == "/" and tag in ("svg", "math"):
                self._close(stack, len(stack) - 1)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = n if close is None else close.start()

    def _words(self, k: int, in_article: bool) -> set[str]:
        """The words of an element's marks that mark boilerplate. Names of a state ('has-sidebar', 'comments-open') say what a page has, not what an element is."""
        names = [re.split(r"[^a-z0-9]+", name) for name in self.marks[k].split()]
        words = {w for parts in names if not (len(parts) > 1 and (parts[0] in STATES or parts[-1] in STATES)) for w in parts}
        return words & MARKED - ({"header"} if in_article else set())

    def boilerplate(self, spared: frozenset[int] | set[int] = frozenset()) -> tuple[list[bool], list[bool]]:
        """Whether an element is, or lies in, boilerplate, and whether it is marked; marks of ``spared`` elements do not count."""
        out, in_article, marked = [False], [False], [False]
        for k, (tag, parent) in enumerate(zip(self.tag[1:], self.parent[1:], strict=True), 1):
            words = self._words(k, in_article[parent]) if self.marks[k] else ()
            drop = tag in DROPPED or tag == "header" and not in_article[parent] or tag == "article" and not COMMENTS.isdisjoint(words)
            marked.append(bool(words) and tag not in WHOLE)
            out.append(out[parent] or drop or marked[k] and k not in spared)
            in_article.append(in_article[parent] or tag in ("article", "main"))
        return out, marked

    def wrappers(self) -> set[int]:
        """Marked elements that are no boilerplate: they hold all articles (or main elements) of a page that has none elsewhere, or most of the points of
        the article or page. Comments can outweigh an article and are spared for its sake only."""
        dropped, marked = self.boilerplate()
        if not any(marked):
            return set()
        every = {k for k, m in enumerate(marked) if m}
        unmarked = self.boilerplate(every)[0]
        linked, block = self._blocks()
        self.lists_of_links(linked, unmarked)
        points = self._points(block, linked, unmarked)
        own = {k for k, tag in enumerate(self.tag) if tag in ("article", "main") and not dropped[k]}
        inner = {k for k, tag in enumerate(self.tag) if tag == "article" and not unmarked[k]}
        if not inner and not own:
            inner = {k for k, tag in enumerate(self.tag) if tag == "main" and not unmarked[k]}
        if any(self.tag[k] == "article" for k in own):
            inner = set()
        scope, holds = [not own], [0] * len(self.tag)
        for k in range(1, len(self.tag)):
            scope.append(scope[self.parent[k]] or k in own)
            points[k] *= scope[k]
        total = sum(points)
        for k in range(len(self.tag) - 1, 0, -1):
            holds[k] += k in inner
            holds[self.parent[k]] += holds[k]
            points[self.parent[k]] += points[k]
        return {
            k for k in every
            if inner and holds[k] == len(inner) or scope[k] and 2 * points[k] > total and COMMENTS.isdisjoint(self._words(k, False))
        }

    def lists_of_links(self, linked: list[bool], dropped: list[bool]) -> None:
        """Marks lists that hold links and hardly anything else: menus without a name."""
        size: dict[int, list[int]] = {}
        around = [-1] * len(self.tag)  # the nearest list
        for k in range(1, len(self.tag)):
            around[k] = k if self.tag[k] in ("ul", "ol") else around[self.parent[k]]
        for element, text in self.items:
            if text is None or dropped[element]:
                continue
            n, up, step = len(text.strip()), around[element], 1
            while up > 0 and n and step <= STEPS:
                of = size.setdefault(up, [0, 0, 0])
                of[0] += n
                of[1] += n * linked[element]
                of[2] += linked[element]
                up, step = around[self.parent[up]], step + 1
        for element, (total, links, count) in size.items():
            if count >= 2 and links >= 0.8 * total:
                dropped[element] = True
        for k in range(1, len(self.tag)):
            dropped[k] = dropped[k] or dropped[self.parent[k]]

    def _blocks(self) -> tuple[list[bool], list[int]]:
        """Whether an element lies in a link, and its nearest block."""
        linked, block = [False] * len(self.tag), list(range(len(self.tag)))
        for k in range(1, len(self.tag)):
            linked[k] = self.tag[k] == "a" or linked[self.parent[k]]
            if self.tag[k] in INLINE:
                block[k] = block[self.parent[k]]
        return linked, block

    def _points(self, block: list[int], linked: list[bool], dropped: list[bool]) -> list[float]:
        """The points of each block for the text that it holds itself."""
        length, commas, links = ([0] * len(self.tag) for _ in range(3))
        for element, text in self.items:
            if text is not None and not dropped[element]:
                b, n = block[element], len(text.strip())
                length[b] += n
                commas[b] += text.count(",")
                links[b] += n if linked[element] else 0
        return [(1 + c + min(n / 100, 3)) * (1 - x / n) if n else 0.0 for n, c, x in zip(length, commas, links, strict=True)]

    def _beside(self, best: int, score: list[float], block: list[int], linked: list[bool], dropped: list[bool], own: list[float]) -> set[int]:
        """The siblings of the container that stay: those that score well, and where no article or main element bounds the text, those that read as text
        by their own points and links, and headings that such a sibling or the container follows."""
        siblings = [k for k in range(1, len(self.tag)) if self.parent[k] == self.parent[best] and k != best]
        keep = {k for k in siblings if score[k] > 0 and score[k] >= SIBLING * score[best]}
        if self.tag[best] in ("article", "main"):
            return keep
        top = list(range(len(self.tag)))  # the sibling that an element lies in
        for k in range(1, len(self.tag)):
            if self.parent[k] != self.parent[best]:
                top[k] = top[self.parent[k]]
        length, links, most, ends, prose = ([0] * len(self.tag) for _ in range(5))
        for element, text in self.items:
            if text is not None and not dropped[element] and (said := text.strip()):
                k = top[element]
                length[k] += len(said)
                links[k] += len(said) * linked[element]
                prose[k] += self.tag[block[element]] not in HEADINGS
                ends[k] = said[-1] in SENTENCE
        for b, n in enumerate(own):
            most[top[b]] = max(most[top[b]], n)
        follows = False
        for k in sorted([best, *siblings], reverse=True):
            if k == best or k in keep:
                follows = True
            elif length[k]:
                if self.tag[k] in INLINE:
                    most[k] = 1 + min(length[k] / 100, 3)
                text_like = links[k] <= LINKED * length[k] and (most[k] >= LEAST_POINTS or links[k] == 0 and ends[k])
                if prose[k] and text_like:
                    keep.add(k)
                    follows = True
                elif not prose[k] and follows and links[k] < length[k]:
                    keep.add(k)
        return keep

    def main_text(self) -> str:
        dropped = self.boilerplate(self.wrappers())[0]
        linked, block = self._blocks()
        self.lists_of_links(linked, dropped)
        own = self._points(block, linked, dropped)
        score = [0.0] * len(self.tag)
        for b in range(len(self.tag)):
            if own[b]:
                up, step = self.parent[b] if b else b, 1
                while up >= 0 and step <= STEPS:
                    score[up] += own[b] / step
                    up, step = self.parent[up], step + 1
        best = max(range(len(score)), key=lambda k: (score[k], -k))
        up = best
        while up >= 0:
            if self.tag[up] in ("article", "main") and not dropped[up]:
                best = up
                if self.tag[up] == "article":
                    break
            up = self.parent[up]
        beside = self._beside(best, score, block, linked, dropped, own)
        keep = [False] * len(self.tag)
        for k in range(len(self.tag)):
            keep[k] = k == best or (k > 0 and keep[self.parent[k]]) or k in beside
        out, held, of = [], [], -1
        for element, text in self.items:
            if text is None or block[element] != of:
                out.append("".join(held))
                held, of = [], block[element]
            if text is not None and keep[element] and not dropped[element]:
                held.append(text)
        out.append("".join(held))
        return " ".join(x for t in out if (x := " ".join(unescape(t).split())))


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, one row per input row.

    Null and empty pages, and pages of boilerplate only, have an empty text. Unclosed, crossed and cut tags are read as a browser would; a page without
    any article element is judged by its points alone. Repeated rows give repeated rows.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(_extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
