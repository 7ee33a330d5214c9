"""Notices out of detail pages: title candidates from an ordered table of sources, the body by density, images, plain text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column

from . import constants as K
from . import selectors as S
from .dom import Node, parse
from .lists import squeeze
from .udfs import batch_udf


class Density(NamedTuple):
    """A text and how much of it lies in links."""

    text: str
    links: float

    @classmethod
    def of(cls, node: Node) -> Density:
        text = node.text()
        linked = len(squeeze("".join(a.raw_text() for a in node.find("a"))))
        return cls(text, min(1.0, linked / max(1, len(text))))

    @property
    def mass(self) -> float:
        return len(self.text) * (1 - self.links)


def body_of(page: Node, configured: str, least: int = 20) -> tuple[Node, str]:
    """The element with the notice's text, and how it was found: the configured one, else the densest of the usual places.

    Texts of less than `least` characters are passed over.
    Only if none of these has a text are sections, divisions and cells looked at, and of those the first 501, as the rule has
    it; the first of several that score alike wins.
    """
    own = page.first(configured) if configured else None
    if own and len(own.text()) >= least:
        return own, configured

    def scored(places: Iterable[tuple[Node, str, bool]]) -> list[tuple[float, Node, str]]:
        out = []
        for node, name, preferred in places:
            density = Density.of(node)
            if len(density.text) >= least:
                blocks = min(len(node.find("p, div, td, li")), 20)
                out.append((density.mass + 20 * blocks + 500 * preferred, node, name))
        return out

    usual = scored((node, s, s not in ("main", ".content")) for s in S.DETAIL_BODIES for node in page.find(s))
    found = usual or scored((node, "heuristic-container", False) for node in page.find("section, div, td")[:501])
    if not found:
        return page.first("body") or page, "body"
    _, node, name = max(found, key=lambda x: x[0])
    return node, name


#: Where an image's address stands: lazy attributes first, then the last of a set, then its own.
IMAGE_SOURCES: tuple[tuple[str, Callable[[Node], str]], ...] = (
    ("data-original", lambda i: i.get("data-original")),
    ("data-src", lambda i: i.get("data-src")),
    ("data-lazy-src", lambda i: i.get("data-lazy-src")),
    ("srcset", lambda i: next((p.split()[0] for p in reversed(i.get("srcset").split(",")) if p.split()), "")),
    ("src", lambda i: i.get("src")),
)


def images_of(body: Node, page_url: str) -> Iterator[dict]:
    """Images worth keeping, each address once: no dots, spacers or trackers."""
    seen = set()
    for image in body.find("img"):
        sizes = [int(m.group()) for a in ("width", "height") if (m := re.match(r"\d+", image.get(a)))]
        attribute, raw = next(((k, v) for k, f in IMAGE_SOURCES if (v := f(image))), ("src", ""))
        if any(s <= 2 for s in sizes) or not raw or re.match("(?i)data:|blob:", raw):
            continue
        url = urljoin(page_url, raw)
        if not re.match("https?:", url) or url in seen or re.search(S.NO_IMAGE, url):
            continue
        seen.add(url)
        figure = image.closest("figure")
        yield {"url": url, "alt": image.get("alt"), "caption": figure.first_text("figcaption") if figure else "", "attribute": attribute}


def comparable(text: str) -> str:
    return " ".join(re.sub(r"[\W_]+", " ", text.lower()).split())


def near_expected(page: Node, expected: str) -> Iterator[str]:
    """Texts that equal the expected title, or hold it or lie in it for 55 % and more; the five nearest, exact ones first.

    The first 1,501 elements that could be titles are looked at, as the rule has it.
    """
    want = comparable(expected)
    if len(want) < 4:
        return
    found: dict[str, tuple[bool, float]] = {}
    for node in page.find(S.EXPECTED_TITLES)[:1501]:
        raw = node.text()
        have = comparable(raw)
        short, long = sorted((have, want), key=len)
        if len(have) >= 4 and len(raw) <= max(320, len(squeeze(expected)) * 2.5) and short in long and (have == want or len(short) >= 0.55 * len(long)):
            found.setdefault(raw, (have == want, 100 * len(short) / len(long) - len(raw) / 1000))
    yield from sorted(found, key=found.__getitem__, reverse=True)[:5]


def labelled(page: Node) -> Iterator[str]:
    """What stands beside a label that says title: in a table's row, then in a list of terms."""
    for row in page.find("tr"):
        if re.match(S.TITLE_LABEL, row.first_text("th, dt")):
            yield row.first_text("td, dd")
    for term in page.find("dt"):
        beside = term.parent.children()
        after = beside[beside.index(term) + 1 :][:1]
        if after and after[0].tag == "dd" and re.match(S.TITLE_LABEL, term.text()):
            yield after[0].text()


def parts_of(title: str) -> Iterator[str]:
    """A document's title may hold the notice's: in the brackets of a board's name, in others, or between separators."""
    yield from re.findall(S.BOARD_READ, title)[:1]
    yield from re.findall(r"\(\s*([^()]{8,})\s*\)", title)
    yield from (p for p in re.split(S.TITLE_PARTS, title) if len(squeeze(p)) >= 4)


def announced(page: Node) -> Iterator[str]:
    """The first heading, then the titles that the page gives for itself, their parts before the whole."""
    yield page.first_text("h1, h2, h3")
    meta = next((m.get("content") for m in page.find("meta") if m.get("property") == "og:title"), "")
    for title in (meta, page.first_text("title")):
        yield from parts_of(squeeze(title))
        yield title


#: Where titles come from, the likeliest first: (page, configured selector, expected title).
TITLE_SOURCES: tuple[Callable[[Node, str, str], Iterable[str]], ...] = (
    lambda page, _, expected: near_expected(page, expected),
    lambda page, *_: labelled(page),
    lambda page, *_: (page.first_text(s) for s in S.DETAIL_TITLES),
    lambda page, configured, _: [page.first_text(configured)] if configured else [],
    lambda page, *_: announced(page),
)


def titles_of(page: Node, configured: str = "", expected: str = "") -> list[str]:
    """Candidates for a notice's title, each once, twenty at most, as the rule has it."""
    found = (squeeze(t) for source in TITLE_SOURCES for t in source(page, configured, expected))
    return list(dict.fromkeys(t for t in found if t))[:20]


def parse_detail(html: str | None, page_url: str = "", content: str = "", title: str = "", date: str = "", expected: str = "", least: int = 20, cut_references: bool = True) -> dict:
    page = parse(html, cut_references)
    titles = titles_of(page, title, expected)
    page.drop(S.CLUTTER)
    body, selector = body_of(page, content, least)
    text = body.text()
    quality = "empty_or_boilerplate" if len(text) < K.SHORT_BODY else "layout_risk" if selector in S.WIDE_BODIES else "clean"
    return {
        "title": titles[0] if titles else "", "titles": titles, "content": text, "body_selector": selector, "body_chars": len(text), "body_quality": quality,
        "detail_date": page.first_text(date) if date else "", "images": list(images_of(body, page_url)),
    }


DETAIL_TYPE = "title string, titles array<string>, content string, body_selector string, body_chars int, body_quality string, detail_date string, images array<struct<url:string,alt:string,caption:string,attribute:string>>"


def detail(html: Column | str, page_url: Column | str, **rules) -> Column:
    """`parse_detail` as a column; `rules` are its options."""

    @batch_udf(DETAIL_TYPE)
    def parsed(html: pd.Series, page_url: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_detail(h, u or "", **rules) for h, u in zip(html, page_url, strict=True)], columns=["title", "titles", "content", "body_selector", "body_chars", "body_quality", "detail_date", "images"])

    return parsed(html, page_url)


#: What makes a text read like a notice, and how much it weighs.
TEXT_WEIGHTS: tuple[tuple[float, Callable[[Density], float]], ...] = (
    (1, lambda d: d.mass),
    (220, lambda d: sum(w in d.text for w in S.BODY_WORDS)),
    (8, lambda d: len(re.findall(S.SENTENCE_END, d.text))),
    (-90, lambda d: sum(w in d.text for w in S.MENU_WORDS)),
)


def dense_text(html: str | None, most: int = 12_000, boxes: bool = True, cut_pages: bool = True, cut_references: bool = True) -> str:
    """The text that reads most like a notice, `most` characters of it, as the rule has it.

    Usual places count for more than any section, division or cell, the page's description for a little less, and the whole
    body for less than nothing; of each selector the first 61 elements are looked at. Without `boxes` sections, divisions and
    cells are not looked at, without `cut_pages` a body whose end is missing is not.
    """
    page = parse(html, cut_references)
    page.drop(S.CLUTTER)
    rated: list[tuple[float, str]] = []

    def rate(density: Density, bonus: float, always: bool = False) -> None:
        points = sum(w * f(density) for w, f in TEXT_WEIGHTS) + bonus if len(density.text) >= 80 else -1
        if points > 0 or always:
            rated.append((points, density.text))

    for selector, bonus in (*((s, 240) for s in S.EXTRACTION_BODIES), *((("section, div, td", 0),) if boxes else ())):
        for node in page.find(selector)[:61]:
            rate(Density.of(node), bonus)
    about = next((squeeze(m.get("content")) for m in page.find("meta") if m.get("property") == "og:description"), "")
    if len(about) >= 60:
        rate(Density(about, 0.0), 180, always=True)
    body = page.first("body")
    if body and (cut_pages or body.closed) and len(body.text()) >= 120:
        rate(Density.of(body), -120, always=True)
    return max(rated, key=lambda x: x[0], default=(0, ""))[1][:most]


def densest(html: Column | str, **rules) -> Column:
    """`dense_text` as a column; `rules` are its options."""

    @batch_udf("string")
    def picked(html: pd.Series) -> pd.Series:
        return html.map(lambda h: dense_text(h, **rules))

    return picked(html)
