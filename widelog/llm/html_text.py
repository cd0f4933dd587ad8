"""Main text of web pages by minimum-cut labelling.

A page's tags cut its text into blocks: runs of text between tags that are not inline. A linear classifier gives each block
log odds of being content, from its form (length, sentence ends, links, kind of element) and its place: landmark elements
and class names above it, which count the less the further up they are. The costs of either label, -log p and -log (1 - p), are a
block's capacities to the two terminals. Blocks next to each other and blocks under the same element are tied by edges that cost when their
labels differ, the more so the closer they are in the document tree, and little across the border of a landmark. The minimum cut is the
cheapest labelling; blocks on the content side, in page order, make the text. So a short line between
paragraphs goes with them, and one long sentence in a menu goes with the menu.

No name ever counts against html, body, main or article, nor against an element that holds more than half of the page's words
(reader comments apart); words after "no", "has", "with" and the like are about something else.

Blocks whose terminals outweigh all their edges are labelled at once, which is exact, and hand their edges' weight on to
their neighbours' terminals; maximum flow by shortest augmenting levels settles the rest.

A null or empty page has the text "" and 0 characters. Character references are decoded and white space (Unicode's)
inside a block becomes one space. Tags and attributes are read as the HTML standard says; unclosed, misnested and truncated markup is read
as far as it goes. Repeated rows are read one by one; only the three named columns are read, whatever else there is.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?]|/)")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
COMMENT_END = re.compile(r"-?->|--!>")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
SENTENCE_END = re.compile(r"[.!?\u2026\u3002\uff01\uff1f\u0964\u061f]['\"\u00bb\u201d)]*(?:\s|$)|[\u3002\uff01\uff1f]")

# Names of elements by the HTML standard, and usual class names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math meter nobr output q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript".split())
TEXTUAL = frozenset("p li dd dt td th blockquote pre figcaption caption h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_BLOCK = frozenset("p dt dd li option tr td th thead tbody tfoot".split())
NEVER_BAD = frozenset("html body main article".split())
TAGS = {"nav": -5.0, "footer": -5.0, "aside": -5.0, "menu": -5.0, "dialog": -5.0, "template": -9.0, "button": -5.0, "fieldset": -4.0, "select": -5.0, "datalist": -9.0, "audio": -5.0, "video": -5.0, "canvas": -5.0, "object": -3.0, "article": 3.5, "main": 2.0}
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer dropdown footer gdpr hidden login "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription tags toc toolbar widget".split()
)
COMMENT_NAMES = frozenset("comment comments discussion disqus replies reply respond".split())
GOOD_NAMES = frozenset("article story entry post".split())
#: Words of a class name after which it is about something else.
LINKING = frozenset("no not has have with without is are overflow show shows js can open closed hide".split())
ROLES = {**dict.fromkeys("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split(), -5.0), "main": 2.0, "article": 3.5}
#: Weights of the classifier. What an element counts for goes down by DEEPER with each step to its descendants.
PLAIN, WORD, MOST_WORDS, SENTENCE, LINKS, TEXT_TAG, HEADING = -1.5, 0.08, 40, 1.0, -4.0, 1.0, 0.5
GOOD, BAD, HEADER, FORM, UNSEEN, DEEPER = 2.0, -5.0, -4.0, -4.0, -9.0, 0.9
#: Edges: next to each other under one element; in elements a step or two apart, and half of that for each further step; on either side
#: of a landmark's border that share; under one element with others between them.
SAME, NEAR, FURTHER, BORDER, AGAIN, MOST_STEPS = 1.2, 0.8, 0.5, 0.2, 0.4, 6


class Page:
    """Blocks of a page and the elements they are in. An element's number is greater than its parent's."""

    def __init__(self, source: str):
        self.parent, self.depth, self.tag = [0], [0], ["#root"]
        self.own: list[tuple[float, float, bool]] = [(0.0, 0.0, False)]  # strength by tag and role, by names, whether those are of comments
        self.blocks: list[tuple[str, int, float]] = []  # text, element, share of it in links
        self._pieces: list[str] = []
        self._linked = self._anchor = 0
        self._read(source)
        self._place()

    def _flush(self, at: int) -> None:
        if self._pieces:
            text = " ".join(html.unescape("".join(self._pieces)).split())
            if text:
                self.blocks.append((text, at, min(1.0, self._linked / len(text))))
            self._pieces = []
            self._linked = 0

    def _element(self, tag: str, attributes: list[tuple[str, str]], up: int) -> int:
        strength, named, comments = TAGS.get(tag, FORM if tag == "form" else HEADER if tag == "header" else 0.0), 0.0, False
        for name, value in attributes:
            name = name.lower()
            if name in ("class", "id"):
                for word in map(self._named, value.split()):
                    if word in COMMENT_NAMES:
                        named, comments = BAD, True
                    elif word in BAD_NAMES:
                        named = BAD
                    elif word == "header":
                        named = min(named, HEADER)
                    elif word and not named:
                        named = GOOD
            elif name == "role":
                strength = min(strength, role) if (role := ROLES.get(value.strip().lower(), 0.0)) < 0 else max(strength, role)
            elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and HIDDEN.search(value)):
                strength = UNSEEN
        if tag in NEVER_BAD:
            strength, named, comments = TAGS.get(tag, 0.0), max(named, 0.0) if tag != "article" or not comments else named, comments and tag == "article"
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.tag.append(tag)
        self.own.append((strength, named, comments))
        return len(self.tag) - 1

    @staticmethod
    def _named(token: str) -> str:
        """The last word of a class name or id that says something, up to a linking word; "" if none does."""
        said = ""
        for word in map(str.lower, NAME.findall(token)):
            if word in LINKING:
                break
            if word in BAD_NAMES or word in COMMENT_NAMES or word in GOOD_NAMES or word == "header":
                said = word
        return said

    @staticmethod
    def _tag(source: str, spot: int) -> tuple[list[tuple[str, str]], int, bool]:
        """Attributes from spot on, where the tag ends, and whether it closes itself; a tag that never ends takes all the rest."""
        found, end = [], len(source)
        while spot < end:
            if source[spot] == ">":
                return found, spot + 1, source[spot - 1] == "/"
            m = ATTRIBUTE.match(source, spot)
            if not m:
                spot += 1  # a slash or white space before the end
                continue
            name, value = m[1], m[2] or ""
            if value[:1] in ("'", '"') and len(value) > 1 and value[-1] == value[0]:
                value = value[1:-1]
            found.append((name, html.unescape(value) if "&" in value else value))
            spot = m.end()
        return found, end, False

    def _read(self, source: str) -> None:
        at = spot = 0
        end = len(source)
        opened: Counter[str] = Counter()
        while spot < end:
            m = MARKUP.search(source, spot)
            text = source[spot : m.start() if m else end]
            if text:
                self._pieces.append(text)
                if self._anchor:
                    self._linked += len(text)
            if not m:
                break
            spot = m.end()
            if not m[2]:
                if m[3]:
                    shut = re.compile("-?>").match(source, spot) or COMMENT_END.search(source, spot)
                    spot = shut.end() if shut else end
                else:
                    spot = found + 1 if (found := source.find(">", spot)) >= 0 else end
                continue
            tag, closing = m[2].lower(), m[1]
            attributes, spot, itself = self._tag(source, spot)
            if tag == "a":
                self._anchor = 0 if closing else 1
            if tag in RAW:
                if not closing:
                    shut = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(source, spot)
                    spot = shut.end() if shut else end
                continue
            if tag in INLINE:
                continue
            self._flush(at)
            if tag in VOID:
                continue
            if not closing:
                if self.tag[at] in CLOSED_BY_BLOCK and (self.tag[at] == "p" or self.tag[at] == tag):
                    opened[self.tag[at]] -= 1
                    at = self.parent[at]
                at = self._element(tag, attributes, at)
                opened[tag] += 1
            elif opened[tag] > 0:
                while self.tag[at] != tag:
                    opened[self.tag[at]] -= 1
                    at = self.parent[at]
                opened[tag] -= 1
                at = self.parent[at]
        self._flush(at)

    def _place(self) -> None:
        """What landmarks and names count for at each element, and which elements are borders."""
        held = [0.0] * len(self.tag)
        for text, at, linked in self.blocks:
            held[at] += len(text) * (1 - linked)
        for k in range(len(held) - 1, 0, -1):
            held[self.parent[k]] += held[k]
        self.place, self.border = [0.0] * len(held), [False] * len(held)
        for k in range(1, len(held)):
            strength, named, comments = self.own[k]
            above = self.place[self.parent[k]]
            most = 2 * held[k] > held[0]
            if self.tag[k] == "form" and most:
                strength = 0.0
            if self.tag[k] == "header" and (above > 0 or most) and strength == HEADER:
                strength = 0.0
            if named < 0 and not comments and (most or (named == HEADER and above > 0)):
                named = 0.0
            own = min(strength, named) if min(strength, named) < 0 else max(strength, named)
            if own < 0:
                self.place[k] = own + DEEPER * min(above, 0.0)
            else:
                self.place[k] = (own if above > -1 else 0.0) + DEEPER * above
            self.border[k] = own != 0 and self.tag[k] != "main"

    def leaning(self, k: int) -> float:
        """Log odds of a block being content."""
        text, at, linked = self.blocks[k]
        odds = PLAIN + WORD * min(len(text) / 6, MOST_WORDS) + LINKS * linked
        if SENTENCE_END.search(text):
            odds += SENTENCE
        if self.tag[at] in TEXTUAL:
            odds += TEXT_TAG
        if self.tag[at] in HEADINGS:
            odds += HEADING
        return odds + self.place[at]

    def _apart(self, a: int, b: int) -> tuple[int, bool]:
        """Steps from one element to another, no more than MOST_STEPS, and whether a border is passed."""
        steps, border = 0, False
        while a != b and steps < MOST_STEPS:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            border = border or self.border[a]
            a, steps = self.parent[a], steps + 1
        return steps, border or a != b

    def edges(self) -> list[tuple[int, int, float]]:
        out, last_under = [], {}
        for k, (_, at, _) in enumerate(self.blocks):
            up = self.parent[at]
            if k:
                steps, border = self._apart(self.blocks[k - 1][1], at)
                out.append((k - 1, k, (SAME if not steps else NEAR * FURTHER ** max(0, steps - 2)) * (BORDER if border else 1.0)))
            if (j := last_under.get(up, k - 1)) != k - 1 and not (self.border[at] or self.border[self.blocks[j][1]]):
                out.append((j, k, AGAIN))
            last_under[up] = k
        return out


def minimum_cut(leanings: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut. A leaning is capacity from the source less that to the sink."""
    n = len(leanings)
    lean = list(leanings)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        k = todo.popleft()
        if side[k] is None and abs(lean[k]) >= sum(near[k].values()):
            side[k] = lean[k] > 0
            for j, w in near[k].items():
                del near[j][k]
                lean[j] += w if side[k] else -w
                todo.append(j)
            near[k] = {}
    rest = [k for k in range(n) if side[k] is None]
    if rest:
        reached = _source_side({k: lean[k] for k in rest}, near)
        for k in rest:
            side[k] = k in reached
    return [bool(s) for s in side]


def _source_side(lean: dict[int, float], near: list[dict[int, float]]) -> set[int]:
    """Maximum flow, then what the residual network still reaches from the source."""
    s, t, tiny = -1, -2, 1e-12
    left: dict[int, dict[int, float]] = {s: {}, t: {}, **{k: dict(near[k]) for k in lean}}
    for k, x in lean.items():
        left[s][k], left[k][s] = max(x, 0.0), 0.0
        left[k][t], left[t][k] = max(-x, 0.0), 0.0
    while True:
        level, line = {s: 0}, deque([s])
        while line:
            k = line.popleft()
            for j, w in left[k].items():
                if w > tiny and j not in level:
                    level[j] = level[k] + 1
                    line.append(j)
        if t not in level:
            return set(level)
        arcs = {k: iter(tuple(left[k])) for k in level}
        path = [s]
        while path:
            k = path[-1]
            if k == t:
                flow = min(left[a][b] for a, b in zip(path, path[1:], strict=False))
                cut = None
                for i, (a, b) in enumerate(zip(path, path[1:], strict=False)):
                    left[a][b] -= flow
                    left[b][a] += flow
                    if cut is None and left[a][b] <= tiny:
                        cut = i
                del path[cut + 1 :]
                arcs[path[-1]] = iter(tuple(left[path[-1]]))
                continue
            for j in arcs[k]:
                if left[k][j] > tiny and level.get(j) == level[k] + 1:
                    path.append(j)
                    break
            else:
                level.pop(k)
                path.pop()


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    # -log(1 - p) less -log p is the log odds themselves
    kept = minimum_cut([page.leaning(k) for k in range(len(page.blocks))], page.edges())
    return " ".join(page.blocks[k][0] for k, keep in enumerate(kept) if keep)


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            texts = [main_text(column[k].as_py()) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(source).cast("string")).mapInArrow(extract, "page_id long, url string, text string, n_chars long")


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return extracted(read(spark, sf_dir, "pages"))
