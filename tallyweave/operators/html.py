"""Web pages as flat rows of elements: one pass of the standard HTML parser, every rule after it is a DataFrame expression."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID_TAGS = frozenset("img meta br hr input link".split())
#: Elements whose text is no text of the page.
SILENT = frozenset(("script", "style"))
#: Headings that may carry a label, and headings whose label ends a section before them.
LABEL_TAGS = frozenset(("h2", "h3", "h4", "strong", "b", "dt"))
#: Ancestors that rules ask for.
NAMED_ANCESTORS = frozenset(("main", "article"))
#: Class of the scripts that hold cards as JSON, and what marks a card (fixed values).
CARD_CLASS = "fd-content-json"
CARD_TAGS = ("article", "li")
CARD_WORDS = ("person", "people", "profile", "faculty", "card")
#: Length of the longest card; of a longer text so much and one character more is kept.
CARD_CHARS = 2500
ELEMENTS = (
    "page_id long, pos int, last int, parent int, above int, parent_tag string, tag string, attrs map<string,string>, inside array<string>, cards array<int>, "
    "json_card int, text string, around string"
)
#: Rows that a task hands on together, and bytes for each core under which pages are few.
ROWS_TOGETHER, FEW_BYTES = 20_000, 8 << 20
#: The row that stands for the whole page.
PAGE = "page"


class Elements(HTMLParser):
    """A page's elements; an element's text is a stretch of the page's pieces of text."""

    def __init__(self, noscript: bool) -> None:
        super().__init__(convert_charrefs=True)
        #: parent, tag, attrs, first and last piece of text, last element inside, json card
        self.rows: list[list] = []
        self.open: list[int] = []
        self.pieces: list[str] = []
        self.lengths = [0]
        self.scripts: dict[int, list[str]] = {}
        self.silent = SILENT if noscript else SILENT | {"noscript"}
        self.muted: int | None = None
        self.json_card = -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.muted is None:
            self.begin(tag, {k: v or "" for k, v in attrs})
            if tag in VOID_TAGS:
                self.end(len(self.open) - 1)

    def begin(self, tag: str, attrs: dict[str, str]) -> None:
        self.rows.append([self.open[-1] if self.open else -1, tag, attrs, len(self.pieces), 0, 0, self.json_card])
        self.open.append(len(self.rows) - 1)
        if tag in self.silent:
            self.muted = len(self.open) - 1

    def end(self, depth: int) -> None:
        for i in self.open[depth:]:
            self.rows[i][4:6] = [len(self.pieces), len(self.rows) - 1]
        del self.open[depth:]
        if self.muted is not None and self.muted >= depth:
            self.muted = None

    def handle_endtag(self, tag: str) -> None:
        lowest = -1 if self.muted is None else self.muted - 1
        for depth in range(len(self.open) - 1, lowest, -1):
            if self.rows[self.open[depth]][1] == tag:
                self.end(depth)
                return

    def handle_data(self, data: str) -> None:
        if self.muted is not None:
            if self.rows[self.open[-1]][1] == "script":
                self.scripts.setdefault(self.open[-1], []).append(data)
        elif words := data.split():
            self.pieces.append(" ".join(words))
            self.lengths.append(self.lengths[-1] + len(self.pieces[-1]) + 1)

    def read_cards(self) -> None:
        """Appends each card of the page's JSON scripts as an element `card`, with the elements of its template under it."""
        for i, parts in list(self.scripts.items()):
            if CARD_CLASS not in self.rows[i][2].get("class", "").split():
                continue
            try:
                items = json.loads("".join(parts))
            except ValueError:
                continue
            for item in items if isinstance(items, list) else ():
                if isinstance(item, dict):
                    self.open, self.muted, self.json_card = [], None, len(self.rows)
                    self.begin("card", {k: " ".join(str(item.get(k, "")).split()) for k in ("name", "search", "departmentCode")})
                    self.feed(unescape(str(item.get("template", ""))))
                    self.end(0)

    def text(self, start: int, stop: int) -> str:
        """Pieces from start to stop, up to CARD_CHARS and one character."""
        if self.lengths[stop] - self.lengths[start] <= CARD_CHARS + 1:
            return " ".join(self.pieces[start:stop])
        at = start
        while self.lengths[at] - self.lengths[start] <= CARD_CHARS + 1:
            at += 1
        return " ".join(self.pieces[start:at])[: CARD_CHARS + 1]


def is_card(tag: str, attrs: dict[str, str]) -> bool:
    return tag in CARD_TAGS or tag == "card" or (tag == "div" and any(w in attrs.get("class", "") for w in CARD_WORDS))


def page_rows(page_id: int, html: str, tags: frozenset[str] | None) -> Iterator[tuple]:
    parser = Elements(noscript=tags is not None)
    parser.feed(html)
    parser.close()
    parser.end(0)
    n_text = len(parser.pieces)
    script_chars = sum(len("".join(s).strip()) for s in parser.scripts.values()) + max(0, len(parser.scripts) - 1)
    parser.read_cards()
    rows = parser.rows
    if tags is None:
        yield (page_id, -1, len(rows) - 1, -2, -2, "", PAGE, {"script_chars": str(script_chars)}, [], [], -1, " ".join(parser.pieces[:n_text]), "")
    ancestors: list[tuple[list[str], list[int]]] = []
    for pos, (parent, tag, attrs, start, stop, last, json_card) in enumerate(rows):
        over, cards = ancestors[parent] if parent >= 0 else ([], [])
        over = [*over, tag] if tag in NAMED_ANCESTORS else over
        cards = [*cards, pos] if is_card(tag, attrs) else cards
        ancestors.append((over, cards))
        if (tags is None and tag not in parser.silent) or (tags is not None and tag in tags):
            around = "" if tag not in LABEL_TAGS else parser.text(*rows[parent][3:5]) if parent >= 0 else parser.text(0, n_text)
            above, parent_tag = (rows[parent][0], rows[parent][1]) if parent >= 0 else (-2, PAGE)
            yield (page_id, pos, last, parent, above, parent_tag, tag, attrs, over, cards, json_card, parser.text(start, stop), around)


def elements(pages: DataFrame, tags: frozenset[str] | None = None) -> DataFrame:
    """Rows (as ELEMENTS) of the elements of pages(page_id, html).

    pos counts a page's elements in order, `last` is the last one inside,
    parent and above the elements around it (-1: the page). inside names its
    ancestors `main` and `article`, cards its enclosing cards, json_card the
    card of a JSON script that it belongs to (else -1). Text is that of
    everything inside, whatever the depth, but scripts, styles and noscript, up
    to CARD_CHARS and one character; `around` is the parent's text for elements
    that may be labels. A row `page` at -1 holds all of the text. With `tags`
    only these elements, those in noscript too, and no such row.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in ELEMENTS.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for page_id, html in zip(batch["page_id"], batch["html"], strict=True):
                rows += page_rows(page_id, html or "", tags)
                if len(rows) >= ROWS_TOGETHER:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    return dealt(pages.select("page_id", "html")).mapInPandas(parse, ELEMENTS)


def computed(df: DataFrame) -> DataFrame:
    """df with its columns computed once, however often later filters and columns name them."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def dealt(pages: DataFrame) -> DataFrame:
    """pages, dealt evenly to all cores if they are few, as they may lie in one file: parsing costs far more than moving them."""
    cores = pages.sparkSession.sparkContext.defaultParallelism
    size = int(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return pages.repartition(cores) if size < cores * FEW_BYTES else pages
