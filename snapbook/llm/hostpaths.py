"""Main text of web pages by consensus of the pages of a host.

Every page scores its containers: a block of text counts for the element around it and half for the one above, less
its links. From the best container the page climbs to the article or main element around it, or to an outer element named as an
article whose further blocks are text with few links, so headings, leads and other sections beside a wrapper stay. The generalised path (tags and classes from the root, digits and ids left out) of what is reached is the page's
vote. Votes are summed up for each host in Spark, and every page is extracted again from the host's winning path; a page without
that path uses its own best container. Votes combine before the exchange, so a host with a third of all
pages costs one row for each task and path.

Inside the container, subtrees that are not article text are left out: scripts, styles, forms, menus, asides, headers and footers of the
page and drawings by tag, role or a hidden mark; sidebars, notices, adverts and reader comments by class or id. A name counts alone only if all its
words are words of page furniture or of layout (``ad-box``, ``related-posts``, not ``share-price`` or ``related-work``); a name with other words needs
evidence in the subtree: form fields, or links for half of its characters. An id never leaves out a heading, nor an element whose first heading spells the
same id, since such ids are made from headings; comments are the exception. Formulas keep their text; ``noscript`` and vector drawings have none.

Rules: a null or empty page has the empty text. White space inside a block becomes one space, blocks stand in page order with one
line break between them. A page without any container text has the empty text. Repeated rows repeat their result. Broken markup (open tags, missing
ends) is read like browsers do for the common cases; after a tag whose quotes run to the end of the page, tags end at the next ``>``. The work for a page
grows with its length, however deep or broken it is. A null url is a host of its own.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from snapbook.llm.blocks import texts_of
from snapbook.llm.shared import cut, map_arrow

OPENING = re.compile(r"</?([a-zA-Z][^\s/>]*)")
QUOTED_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table html body div section article main td th".split())

# What is not article text.
NO_TEXT_TAGS = frozenset("head nav footer aside form button select datalist dialog menu svg canvas object audio video map search".split())
NO_TEXT_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog form menu menubar toolbar".split())
NO_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall share sharing social related recommended "
    "comment comments disqus replies reply respond newsletter subscribe subscription signup login toolbar pagination pager skip copyright".split()
)
DOUBTFUL_NAMES = frozenset("legal discussion widget".split())
COMMENT_NAMES = frozenset("comment comments disqus replies reply respond".split())
# Words of layout, which say nothing about what an element holds.
LAYOUT_NAMES = frozenset(
    "area articles bar block body bottom box button buttons card cards center col column container content count feed first form global group head holder "
    "icon icons inner item items last left link links list main message module outer page panel post posts region right row section site slot stories "
    "story text thread title top unit widget wrap wrapper zone".split()
)
GOOD_NAMES = frozenset("article content entry post story main body text page".split())
CONTAINERS = frozenset("article main section div td body center".split())
# Names of whole pages (page, body) are good for a container, but do not make an outer element an article.
ARTICLE_NAMES = GOOD_NAMES - {"page", "body"}
# Names of one article, whose own header is part of it.
OWN_HEADER = frozenset("article post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FIELDS = frozenset("form input textarea select button".split())
GOOD_FACTOR = 1.5
EVIDENT_LINKS = 1 / 2
LINK_SHARE = 1 / 3
BROADCAST_HOSTS = 100_000
PATH_LENGTH = 400


def words_of(name: str) -> list[str]:
    """The words of a class or id, whose borders are capitals, digits and signs."""
    return [w for w in re.split(r"[^a-z]+", HUMP.sub("-", name).lower()) if w]


def kind_of(words: list[str]) -> int:
    """What the words of one name tell: 2 for page furniture, 1 for what needs evidence, else 0."""
    named = NO_TEXT_NAMES.intersection(words)
    if named and all(w in NO_TEXT_NAMES or w in LAYOUT_NAMES for w in words):
        return 2
    return int(bool(named or DOUBTFUL_NAMES.intersection(words)))


class Element:
    __slots__ = ("tag", "parent", "label", "plain", "header", "kind", "by_id", "id", "names", "holds_main")

    def __init__(self, tag: str, parent: int, attributes: str):
        self.tag, self.parent, self.holds_main = tag, parent, False
        self.label, self.plain, self.header, self.kind, self.by_id = tag, tag in NO_TEXT_TAGS, tag == "header", 0, 0
        self.id, self.names = "", frozenset()
        if not attributes:
            return
        found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        classes = html.unescape(found.get("class", "")).split()
        self.id = found.get("id", "")
        named = [words_of(c) for c in classes]
        own = words_of(self.id)
        self.names = frozenset(w for words in [*named, own] for w in words)
        self.label = ".".join([tag, *sorted({re.sub(r"\d+", "", c.lower()) for c in classes} - {""})])
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
        self.plain = self.plain or hidden or found.get("role", "").lower() in NO_TEXT_ROLES
        self.header = self.header or any("header" in words and all(w == "header" or w in LAYOUT_NAMES for w in words) for words in [*named, own])
        self.kind = max(map(kind_of, named), default=0)
        self.by_id = 0 if tag in HEADINGS else kind_of(own)


class OpenTags:
    """The elements open at a place of a page, with the places of each tag, so that nothing is looked for by walking down."""

    def __init__(self) -> None:
        self.stack = [0]
        self.tags = ["#root"]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.table_scopes: list[int] = []

    def push(self, element: int, tag: str) -> None:
        at = len(self.stack)
        self.stack.append(element)
        self.tags.append(tag)
        self.places.setdefault(tag, []).append(at)
        for places, member in self._kinds(tag):
            if member:
                places.append(at)

    def _kinds(self, tag: str) -> tuple[tuple[list[int], bool], ...]:
        return (self.blocks, tag in BLOCK), (self.scopes, tag in SCOPE), (self.table_scopes, tag in SCOPE and tag not in ("td", "th"))

    def close(self, to: int) -> None:
        """Close the elements from a place on."""
        while len(self.stack) > to:
            self.stack.pop()
            tag = self.tags.pop()
            self.places[tag].pop()
            for places, member in self._kinds(tag):
                if member:
                    places.pop()

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def ended_by(self, tag: str) -> int:
        """The place of the first element that a block's start ends, 0 for none: items of its level, open paragraphs and headings."""
        scopes = self.table_scopes if tag in ("tr", "td", "th") else self.scopes
        scope = scopes[-1] if scopes else 0
        found = [self.last("p"), *(self.last(h) for h in HEADINGS if tag in CLOSED_BY_BLOCK)]
        for same in SAME_LEVEL.get(tag, ()):
            places = self.places.get(same, ())
            at = bisect_right(places, scope)
            found += places[at : at + 1]
        return min((f for f in found if f > scope), default=0)


class Page:
    """Elements and text blocks of one page."""

    def __init__(self, source: str):
        self.elements = [Element("#root", -1, "")]
        self.blocks: list[tuple[str, int, int]] = []  # text, characters in links, element
        self.fields: list[int] = []
        self._read(source)
        self._relate()

    def _read(self, source: str) -> None:
        elements, open_tags = self.elements, OpenTags()
        stack = open_tags.stack
        parts: list[str] = []
        linked, quotes = 0, True

        def flush() -> None:
            nonlocal linked
            text = " ".join("".join(parts).split()) if parts else ""
            if text:
                self.blocks.append((text, min(linked, len(text)), stack[-1]))
            parts.clear()
            linked = 0

        def say(start: int, stop: int) -> None:
            nonlocal linked
            if stop > start:
                text = source[start:stop]
                parts.append(html.unescape(text) if "&" in text else text)
                linked += len(parts[-1].strip()) if open_tags.places.get("a") else 0

        position = said = 0
        last_end = source.rfind(">")
        last_cdata = source.rfind("]]>")
        while (at := source.find("<", position)) >= 0 and at < last_end:
            if source.startswith("<!--", at):
                say(said, at)
                stop = source.find("-->", at + 4)
                position = said = stop + 3 if stop >= 0 else len(source)
                continue
            if source.startswith("<![CDATA[", at) and at < last_cdata:
                say(said, at)
                stop = source.find("]]>", at)
                parts.append(source[at + 9 : stop])
                position = said = stop + 3
                continue
            if source.startswith(("<!", "<?"), at):
                say(said, at)
                position = said = source.find(">", at) + 1
                continue
            opening = OPENING.match(source, at)
            if not opening:
                position = at + 1
                continue
            say(said, at)
            rest = QUOTED_REST.match(source, opening.end()) if quotes else None
            quotes = quotes and rest is not None
            position = said = rest.end() if rest else source.find(">", opening.end()) + 1
            attributes = source[opening.end() : position - 1]
            tag = opening[1].lower()
            if tag == "br":
                parts.append(" ")
                continue
            if source[at + 1] == "/":
                to = open_tags.last(tag)
                if to and (tag in BLOCK or not open_tags.blocks or open_tags.blocks[-1] < to):
                    if tag in BLOCK or elements[stack[to]].plain or elements[stack[to]].kind or elements[stack[to]].by_id:
                        flush()
                    open_tags.close(to)
                continue
            if tag in BLOCK:
                flush()
                to = open_tags.ended_by(tag)
                if to:
                    open_tags.close(to)
            if tag in FIELDS:
                self.fields.append(stack[-1])
            if tag in RAW:
                found = re.compile(f"</{re.escape(tag)}\\b", re.IGNORECASE).search(source, position)
                stop = source.find(">", found.end()) if found else -1
                position = said = stop + 1 if stop >= 0 else len(source)
                continue
            if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCK:
                continue
            element = Element(tag, stack[-1], attributes)
            if element.plain or element.kind or element.by_id:
                flush()
            elements.append(element)
            open_tags.push(len(elements) - 1, tag)
        say(said, len(source))
        flush()

    def _relate(self) -> None:
        """What elements say about each other. A parent stands before its children, so each fact needs one walk forward or backward."""
        elements = self.elements
        size = len(elements)
        self.end = list(range(size))
        for i in range(size - 1, 0, -1):
            e, parent = elements[i], elements[i].parent
            self.end[parent] = max(self.end[parent], self.end[i])
            elements[parent].holds_main |= e.holds_main or e.tag in ("article", "main")
        # The containers around, and the kinds of paths: one number for each parent's number and label.
        self.around = [0] * size
        self.kinds = [0] * size
        self.labels: list[tuple[int, str, int]] = [(0, "", 0)]  # number above, label, checksum of the whole path
        numbers: dict[tuple[int, str], int] = {}
        for i in range(1, size):
            e = elements[i]
            self.around[i] = i if e.tag in CONTAINERS else self.around[e.parent]
            above = self.kinds[e.parent]
            if e.tag in BLOCK and (above, e.label) not in numbers:
                numbers[above, e.label] = len(self.labels)
                self.labels.append((above, e.label, zlib.crc32((">" if above else "").encode() + e.label.encode("utf-8", "surrogatepass"), self.labels[above][2])))
            self.kinds[i] = numbers[above, e.label] if e.tag in BLOCK else above
        self.out = self._left_out()

    def under(self, sums: list[int], i: int) -> int:
        """The part of running sums over elements that belongs to one element's subtree."""
        return sums[self.end[i] + 1] - sums[i]

    def _sums(self, out: list[bool] | None = None) -> tuple[list[int], list[int]]:
        """Running sums of the blocks' characters and linked characters over the elements."""
        chars, links = [0] * (len(self.elements) + 1), [0] * (len(self.elements) + 1)
        for text, linked, i in self.blocks:
            if out is None or not out[i]:
                chars[i + 1] += len(text)
                links[i + 1] += linked
        return list(accumulate(chars)), list(accumulate(links))

    def _left_out(self) -> list[bool]:
        """Which elements lie in a subtree that is not article text."""
        chars, links = self._sums()
        fields = [0] * (len(self.elements) + 1)
        for i in self.fields:
            fields[i + 1] += 1
        fields = list(accumulate(fields))
        headings = {i: text for text, _, i in reversed(self.blocks) if self.elements[i].tag in HEADINGS}
        order = sorted(headings)
        out: list[bool] = []
        inside: list[bool] = []
        for i, e in enumerate(self.elements):
            above = out[e.parent] if e.parent >= 0 else False
            article = inside[e.parent] if e.parent >= 0 else False
            inside.append(article or e.tag in ("article", "main") or (e.tag in CONTAINERS and bool(e.names & OWN_HEADER)))
            drop = e.plain or e.header and not article
            kind = e.kind
            if not drop and e.by_id > kind:
                at = bisect_left(order, i)
                first = headings[order[at]] if at < len(order) and order[at] <= self.end[i] else ""
                spelt = words_of(first.lower()) == words_of(self.elements[i].id.lower())
                kind = e.by_id if not spelt or e.names & COMMENT_NAMES else kind
            if not drop and kind == 1:
                drop = self.under(fields, i) > 0 or 0 < EVIDENT_LINKS * self.under(chars, i) <= self.under(links, i)
            out.append(above or ((drop or kind == 2) and not e.holds_main and e.tag not in ("html", "body", "article", "main")))
        return out

    def path(self, index: int) -> str:
        number, checksum = self.kinds[index], self.labels[self.kinds[index]][2]
        labels, length = [], 0
        while number and length <= PATH_LENGTH:
            labels.append(self.labels[number][1])
            length += len(labels[-1]) + 1
            number = self.labels[number][0]
        path = ">".join(reversed(labels))
        # Paths are votes and are broadcast: a very long one is named by its end and a hash of the whole.
        return path if not number and len(path) <= PATH_LENGTH else f"{checksum:08x}>{path[-PATH_LENGTH:]}"

    def on_path(self, path: str) -> list[int]:
        """The containers on a path."""
        if not path:
            return []
        checksum = int(path[:8], 16) if len(path) > PATH_LENGTH else zlib.crc32(path.encode("utf-8", "surrogatepass"))
        near = {n for n, label in enumerate(self.labels) if label[2] == checksum}
        found: dict[int, bool] = {}
        places = []
        for i, e in enumerate(self.elements):
            number = self.kinds[i]
            if number in near and e.tag in CONTAINERS:
                if number not in found:
                    found[number] = self.path(i) == path
                if found[number]:
                    places.append(i)
        return places

    def best(self) -> tuple[str, float]:
        """Path and score of the container with most text of its own."""
        elements = self.elements
        scores = [0.0] * len(elements)
        for text, linked, index in self.blocks:
            if not self.out[index]:
                worth = len(text) - 2.0 * linked
                own = self.around[index]
                scores[own] += worth
                if own > 0:
                    scores[self.around[elements[own].parent]] += worth / 2
        top, at = 0.0, 0
        for i, e in enumerate(elements):
            score = scores[i] * (GOOD_FACTOR if e.tag in ("article", "main") or e.names & GOOD_NAMES else 1.0)
            if score > top:
                top, at = score, i
        return self.path(self.whole(at)), top

    def whole(self, index: int) -> int:
        """The element that holds the whole article of a container."""
        at = index
        while at > 0 and self.elements[at].tag not in ("article", "main"):
            at = self.elements[at].parent
        if at > 0:
            return at
        chars, links = self._sums(self.out)
        at, above = index, self.around[self.elements[index].parent] if index > 0 else 0
        nearest = above
        while above > 0:
            e = self.elements[above]
            # A section is part of what is around it.
            joins = e.tag != "body" and e.names & ARTICLE_NAMES or above == nearest and self.elements[at].tag == "section"
            if joins and self.under(links, above) - self.under(links, at) <= LINK_SHARE * (self.under(chars, above) - self.under(chars, at)):
                at, nearest = above, self.around[e.parent]
            above = self.around[e.parent]
        return at

    def text(self, path: str) -> str:
        """Article text of the elements on a path."""
        roots = set(self.on_path(path))
        under: list[bool] = []
        for i, e in enumerate(self.elements):
            under.append((under[e.parent] if e.parent >= 0 else path == "") or i in roots)
        return "\n".join(t for t, _, i in self.blocks if under[i] and not self.out[i])

    def has(self, path: str) -> bool:
        return bool(self.on_path(path))


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1))


def host_votes(pages: DataFrame) -> DataFrame:
    """``host`` and the path with the largest sum of votes; the alphabetically first on a tie."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        best = [Page(t).best() if t else ("", 0.0) for t in texts_of(batch, "html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([p for p, _ in best]), pa.array([s for _, s in best], pa.float64())], names=["host", "path", "score"])

    votes = map_arrow(pages.select("host", "html"), run, "host string, path string, score double").filter("score > 0")
    # A page weighs by the order of magnitude of its text, so one huge page does not outvote the others.
    sums = votes.groupBy("host", "path").agg(F.sum(F.round(F.log2(F.col("score") + 1) * 1000).cast("long")).alias("votes"))
    return sums.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("order"), F.col("path").alias("path")))["path"].alias("path"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars`` and the ``path`` it was taken from.

    The winners are one short row for each host. Up to ``BROADCAST_HOSTS`` counted hosts they are broadcast and no page moves;
    beyond, pages and winners meet in a shuffle, where the skew rule splits a large host.
    """
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{source}`").alias("html")).withColumn("host", host_of(F.col("url")))
    winners = cut(host_votes(rows).withColumnRenamed("path", "winner"))
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, paths = [], []
        for source, winner in zip(texts_of(batch, "html"), batch.column("winner").to_pylist(), strict=True):
            page = Page(source)
            path = winner if winner is not None and page.has(winner) else page.best()[0]
            text = page.text(path)
            if not text:
                path = page.best()[0]
                text = page.text(path)
            texts.append(text)
            paths.append(path)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array(paths, pa.string())],
            names=["page_id", "url", "text", "n_chars", "path"],
        )

    kind = rows.schema["page_id"].dataType.simpleString()
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "winner")
    return map_arrow(joined, run, f"page_id {kind}, url string, text string, n_chars long, path string")
