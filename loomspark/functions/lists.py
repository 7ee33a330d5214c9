"""Notices out of list pages. A row becomes a candidate, candidates meet an ordered table of rules, and the first rule that
applies is a candidate's fate; all counts are read off the fates."""

from __future__ import annotations

import datetime
import json
import re
from collections import Counter
from collections.abc import Callable
from functools import cached_property
from typing import NamedTuple
from urllib.parse import parse_qsl, urljoin, urlsplit

import pandas as pd
from pyspark.sql.functions import udtf

from . import constants as K
from . import selectors as S
from .dom import Node, matches, parse
from .udfs import batch_udf
from .urls import CATEGORY_KEY, DETAIL_PATH, DETAIL_QUERY, NAMED_KEY, from_script, from_site, resolve_one, with_query

CONFIGURED, BOARD, ANCHOR = "A_CONFIGURED_SELECTOR", "B_COMMON_BOARD", "C_HEURISTIC_ANCHOR"


def squeeze(text: str | None) -> str:
    return " ".join((text or "").split())


def list_title(text: str) -> str:
    out = squeeze(text)
    for pattern in K.LIST_TITLE_TRIMS:
        out = re.sub(pattern, "", out)
    return out.strip()


def day_of(text: str) -> str:
    """The first day that exists, as an ISO date; empty without one."""
    for pattern in S.DAY_PATTERNS:
        if found := re.search(pattern, text):
            year, month, day = map(int, found.groups())
            try:
                return datetime.date(year + 2000 if year < 100 else year, month, day).isoformat()
            except ValueError:
                continue
    return ""


def is_detail(url: str) -> bool:
    if re.search(DETAIL_QUERY, url):
        return True
    if re.search(r"(?i)/main/view\.do(?:[?#]|$)", url):
        return False
    return bool(re.search(DETAIL_PATH, url) or re.search(NAMED_KEY, url))


def is_category(url: str, page: str) -> bool:
    try:
        a, b = urlsplit(url), urlsplit(page)
    except ValueError:
        return False
    return (a.scheme, a.netloc, a.path) == (b.scheme, b.netloc, b.path) and not is_detail(url) and bool(re.search(CATEGORY_KEY, url))


def is_menu(title: str) -> bool:
    return len(title) <= 1 or bool(re.match(K.TITLE_MENU, title))


def data_url(link: Node) -> str:
    return link.get("data-href") or link.get("data-url") or link.get("data-link")


#: What makes a link look like a notice's, and how much it weighs.
LINK_WEIGHTS: tuple[tuple[int, Callable[[Node], float]], ...] = (
    (1, lambda a: min(len(a.text()), 40)),
    (80, lambda a: is_detail(a.get("href")) or is_detail(data_url(a))),
    (80, lambda a: bool(re.search(S.DETAIL_CALL, f"{a.get('onclick')} {a.get('href')}"))),
    (-100, lambda a: is_menu(a.text())),
)


def link_of(row: Node, configured: str) -> Node | None:
    """The row itself, the one configured link, or the link that looks most like a notice's."""
    if matches(row, S.LINKS):
        return row
    only = row.find(configured) if configured else []
    if len(only) == 1:
        return only[0]
    return max(row.find(S.LINKS), key=lambda a: sum(w * f(a) for w, f in LINK_WEIGHTS), default=None)


class Handler(NamedTuple):
    """A script function that a click calls: the name of its argument and its body."""

    argument: str = ""
    body: str = ""

    def search(self, pattern: str) -> str:
        found = re.search(pattern, self.body)
        return found.group(1) if found else ""

    @property
    def field(self) -> str:
        """The field that it writes its argument to."""
        if not self.argument:
            return ""
        name = re.escape(self.argument)
        return self.search(rf"(?i)\.([A-Za-z_$][\w$]*)\.value\s*=\s*{name}\b") or self.search(rf"(?i)\$\(\s*['\"]#([A-Za-z_$][\w$-]*)['\"]\s*\)\.val\(\s*{name}\b")


def handler_of(page: Node, name: str) -> Handler:
    scripts = "\n".join(x.raw_text() for x in page.find("script"))
    found = re.search(rf"(?is)function\s+{name}\s*\(\s*([A-Za-z_$][\w$]*)[^)]*\)\s*\{{(.*?)\n\}}", scripts)
    return Handler(*found.groups()) if found else Handler()


def has_field(form: Node, name: str, by_id: bool = True) -> bool:
    return any(name == i.get("name") or (by_id and name == i.get("id")) for i in form.find("input"))


def same_page_view(page: Node, list_url: str, number: str) -> str:
    """A list.do page with a view.do form and a board id in it: that address, with the list's parameters."""
    if not re.search(r"(?i)(?:^|/)list\.do(?:[?#]|$)", list_url):
        return ""
    form = next((f for f in page.find("form") if re.search(r"(?i)(?:^|/)view\.do(?:[?#]|$)", f.get("action")) and has_field(f, "boardId")), None)
    if form is None:
        return ""
    target = urljoin(list_url, form.get("action"))
    own = {k for k, _ in parse_qsl(urlsplit(target).query, keep_blank_values=True)}
    more = {k: v for k, v in parse_qsl(urlsplit(list_url).query, keep_blank_values=True) if k not in own}
    return with_query(target, more | {"boardId": number})


def posted_form(page: Node, link: Node, handler: Handler) -> Node | None:
    """The form that a click posts: the one its handler names, else the one around the link, else one with an id field."""
    named = handler.search(r"document\.([A-Za-z_$][\w$]*)")
    first = next((f for f in page.find("form") if f.get("name") == named), None) if named else link.closest("form")
    return first or next((f for f in page.find("form") if any(has_field(f, n, by_id=False) for n in S.ID_FIELDS)), None)


def form_target(page: Node, link: Node, list_url: str) -> str:
    """The address that a form would post a click's number to, where page and handler say enough to build it."""
    href = link.get("href")
    script = link.get("onclick") or (href[11:] if href.lower().startswith("javascript:") else "")
    call = re.search(S.FORM_CALL, script)
    if not call or re.search(r"(?i)\bjf_view\s*\(", script):
        return ""
    if target := same_page_view(page, list_url, call.group(2)):
        return target
    handler = handler_of(page, call.group(1))
    form = posted_form(page, link, handler)
    fields = [n for n in (handler.field, *S.ID_FIELDS) if n and has_field(form, n)] if form else []
    if not fields:
        return ""
    target = urljoin(list_url, handler.search(r"(?i)\.action\s*=\s*['\"]([^'\"]+)['\"]") or form.get("action") or list_url)
    hidden = {i.get("name"): i.get("value") for i in form.find("input[type='hidden'][name]") if i.get("value") and not re.search("(?i)csrf|token|session", i.get("name"))}
    mode = [n for n in S.MODE_FIELDS if has_field(form, n, by_id=False)][:1]
    return with_query(target, hidden | {fields[0]: call.group(2)} | dict.fromkeys(mode, "view"))


class Source:
    """What is known about a list: its address, selectors, the pattern of its notices and the words looked for."""

    def __init__(self, known: dict):
        get = lambda k: known.get(k) or ""
        self.id, self.list_url, self.base_url = known.get("source_id"), known["list_url"], known.get("base_url")
        self.rows, self.link, self.title, self.date = map(get, ("list_item_selector", "link_selector", "title_selector", "date_selector"))
        self.pattern = re.compile(known["notice_url_pattern"]) if known.get("notice_url_pattern") else None
        self.keywords = [k.lower() for k in known.get("keywords") or S.KEYWORDS]


class Candidate:
    """A row of a list, or a link taken for one: what can be read off it, when it is asked for."""

    def __init__(self, page: Node, source: Source, node: Node, strategy: str):
        self.page, self.source, self.strategy = page, source, strategy
        anchor = strategy == ANCHOR
        self.row = (node.closest(S.CONTEXTS) or node) if anchor else node
        self.link = node if anchor else link_of(node, source.link)

    @cached_property
    def raw(self) -> str:
        return self.row.text()

    @cached_property
    def title_node(self) -> Node | None:
        inner = self.link.first(S.LIST_TITLES) if self.link else None
        if inner or not self.source.title:
            return inner
        return self.row if matches(self.row, self.source.title) else self.row.first(self.source.title)

    @cached_property
    def title(self) -> str:
        nodes = (self.title_node, self.link)
        return list_title(next((t for n in nodes if n and (t := n.raw_text())), ""))

    @cached_property
    def date(self) -> str:
        """The configured date, else the first usual place with a day in it, else what looks like one in the row."""
        if own := self.row.first_text(self.source.date) if self.source.date else "":
            return own
        usual = next((t for s in S.DATES if day_of(t := self.row.first_text(s))), "")
        found = None if usual else re.search(S.DAY_LIKE, self.raw)
        return found.group() if found else usual

    @cached_property
    def day(self) -> str:
        return day_of(self.date) or day_of(self.title)

    @cached_property
    def dated(self) -> bool:
        return any(map(day_of, (self.date, self.raw, self.title)))

    @cached_property
    def cells(self) -> bool:
        return len(self.row.find("td, th")) >= 2

    def meta(self, *places: tuple[Node | None, tuple[str, ...]]) -> bool:
        """Whether one of these attributes speaks of a board."""
        return bool(re.search(S.BOARD_META, " ".join(n.get(a) for n, names in places if n for a in names)))

    @cached_property
    def of_board(self) -> bool:
        named = ("class", "id")
        return (
            self.strategy == CONFIGURED
            or self.dated
            or self.meta((self.row, named), (self.row.parent, named), (self.link, (*named, "href", "onclick")))
            or (self.row.tag in ("tr", "li") and self.cells)
            or bool(self.link and re.search(S.DETAIL_HREF, self.link.get("href")))
        )

    @cached_property
    def strong(self) -> bool:
        """Evidence enough for a link that no list selector led to."""
        speaks = self.meta((self.row, ("class", "id")), (self.row.parent, ("class",)), (self.link, ("class", "id"))) and len(self.title) >= 4
        return is_detail(self.url) and (self.dated or (self.row.tag == "tr" and self.cells) or speaks)

    @cached_property
    def clicked(self) -> str:
        """The address that the link's script leads to, by the rules of its site or by the general ones."""
        onclick = self.link.get("onclick")
        return from_site(self.source.id, onclick, self.source.list_url) or from_script(onclick, self.source.list_url, self.source.base_url)

    @cached_property
    def direct(self) -> str:
        at = resolve_one(data_url(self.link) or self.link.get("href"), self.source.list_url, self.source.base_url) or self.clicked
        return self.clicked if self.link.get("onclick") and at.split("#")[0] == self.source.list_url else at

    @cached_property
    def inferred(self) -> str:
        return "" if self.direct else form_target(self.page, self.link, self.source.list_url)

    @property
    def url(self) -> str:
        return self.direct or self.inferred

    @property
    def navigates(self) -> bool:
        return bool(self.link.get("href") or self.scripted)

    @property
    def scripted(self) -> bool:
        return bool(self.link.get("onclick") or data_url(self.link) or self.link.get("href").lower().startswith("javascript:"))

    @property
    def manual(self) -> bool:
        """Only a browser's network log could tell where this link leads."""
        href = self.link.get("href")
        placeholder = not href or re.match(r"#\d*$", href) or href.lower().startswith("javascript:")
        return bool(placeholder and re.search(S.MANUAL_CALL, self.link.get("onclick")))

    @property
    def contaminated(self) -> bool:
        """The title holds more than a title."""
        whole = any(n and list_title(n.text()) == self.title for n in (self.link, self.title_node))
        beyond = len(self.raw) > len(self.title) + K.RAW_BEYOND_TITLE
        return bool(re.search(K.TITLE_NOISE, self.title)) or (not whole and (beyond or bool(re.search(K.TITLE_DATE_RANGE, self.title)))) or (len(self.title) > K.LONG_TITLE and beyond)

    @property
    def wanted(self) -> bool:
        said = squeeze(f"{self.title} {self.raw} {self.date}").lower()
        return any(k in said for k in self.source.keywords)

    def item(self) -> dict:
        return {"title": self.title, "url": self.url, "date_text": self.date, "parsed_date": self.day, "keyword_matched": self.wanted, "raw_text": self.raw}


#: Why a candidate is no item: the first rule that applies, given the addresses of the items before it. The order is fixed.
RULES: tuple[tuple[str, Callable[[Candidate, set[str]], bool]], ...] = (
    ("menu_container", lambda c, _: bool(c.row.closest(S.MENUS) or (c.link and c.link.closest(S.MENUS)))),
    ("menu_text", lambda c, _: is_menu(c.title or c.raw)),
    ("unproven", lambda c, _: not c.of_board),
    ("linkless", lambda c, _: c.link is None),
    ("untargeted", lambda c, _: not c.url),
    ("repeated", lambda c, seen: c.url in seen or c.url == c.source.list_url or is_category(c.url, c.source.list_url)),
    ("weak", lambda c, _: c.strategy == ANCHOR and not c.strong),
    ("pattern_rejected", lambda c, _: bool(c.strategy == CONFIGURED and c.source.pattern and not c.source.pattern.search(c.url) and not c.inferred)),
    ("untitled", lambda c, _: not c.title),
    ("contaminated", lambda c, _: c.contaminated),
)
ORDER = {fate: k for k, (fate, _) in enumerate((*RULES, ("kept", None)))}


class Attempt:
    """The candidates of one way to read a page, each with its fate."""

    def __init__(self, page: Node, source: Source, strategy: str, nodes: list[Node]):
        self.strategy, self.n_nodes = strategy, len(nodes)
        self.met: list[tuple[str, Candidate]] = []
        seen: set[str] = set()
        for node in nodes:
            c = Candidate(page, source, node, strategy)
            fate = next((name for name, applies in RULES if applies(c, seen)), "kept")
            if fate == "kept":
                seen.add(c.url)
            self.met.append((fate, c))
        self.fates = Counter(fate for fate, _ in self.met)
        self.items = [c.item() for fate, c in self.met if fate == "kept"]

    def past(self, rule: str) -> list[Candidate]:
        """Candidates to which neither this rule nor one before it applies."""
        return [c for fate, c in self.met if ORDER[fate] > ORDER[rule]]

    def counts(self) -> dict[str, int]:
        linked = self.past("linkless")
        return {
            "links": len(self.past("untargeted")),
            "valid_links": len(self.past("pattern_rejected")),
            "board": len(self.past("unproven")),
            "menu_text": self.fates["menu_text"],
            "menu_container": self.fates["menu_container"],
            "navigation": sum(c.navigates for c in linked),
            "event_urls": sum(c.scripted for c in linked),
            "manual_evidence": sum(c.manual for fate, c in self.met if fate == "untargeted"),
            "contaminated": self.fates["untitled"] + self.fates["contaminated"],
            "pattern_rejected": self.fates["pattern_rejected"],
            "dated": sum(bool(x["parsed_date"]) for x in self.items),
            "keyword_matches": sum(x["keyword_matched"] for x in self.items),
        }


def attempts(page: Node, source: Source) -> list[Attempt]:
    """The configured rows; without items the fullest common board, if any shows evidence; without items again the links."""
    tried = []
    if source.rows:
        tried.append(Attempt(page, source, CONFIGURED, page.find(source.rows)))
    if not any(t.items for t in tried):
        boards = [Attempt(page, source, BOARD, nodes) for s in S.BOARDS if (nodes := page.find(s))]
        tried.append(max((Attempt(page, source, BOARD, []), *boards), key=lambda t: (len(t.items), len(t.past("unproven")))))
    if not any(t.items for t in tried):
        tried.append(Attempt(page, source, ANCHOR, [a for a in page.find(S.LINKS) if not a.closest(S.MENUS)]))
    return tried


def parse_list(html: str | None, known: dict) -> tuple[list[dict], dict]:
    """Items and metrics of a list page."""
    page, source = parse(html), Source(known)
    tried = attempts(page, source)
    configured = tried[0] if source.rows else None
    chosen = next((t for t in tried if t.items), configured) or max(tried, key=lambda t: len(t.past("untargeted")) + len(t.past("unproven")))
    counts = chosen.counts()
    menus = counts["menu_text"] + counts["menu_container"]
    rate = round(menus / chosen.n_nodes, 4) if chosen.n_nodes else 0.0
    metrics = counts | {
        "strategy": chosen.strategy,
        "recovered": bool(chosen.items) and chosen.strategy != CONFIGURED,
        "selector_matches": configured.n_nodes if configured else None,
        "n_nodes": chosen.n_nodes,
        "n_items": len(chosen.items),
        "menu_rate": rate,
        "menu": menus >= 3 and not chosen.items and rate >= 0.2,
        "pagination": int(bool(page.first(S.PAGERS))),
        "empty_state": bool(re.search(S.EMPTY_TEXT, squeeze(" ".join(x.text() for x in page.find(S.EMPTY_STATES))))),
    }
    return chosen.items, metrics


ITEM_TYPE = "ordinal int, title string, url string, date_text string, parsed_date string, keyword_matched boolean"
METRICS_TYPE = "strategy string, recovered boolean, selector_matches int, n_nodes int, n_items int, links int, valid_links int, board int, menu_text int, menu_container int, menu_rate double, menu boolean, manual_evidence int, event_urls int, contaminated int, pattern_rejected int, dated int, keyword_matches int, pagination int, empty_state boolean"


@udtf(returnType=ITEM_TYPE)
class ListItems:
    """Items of a list page: LATERAL list_items(html, source as JSON)."""

    def eval(self, html: str, source: str):
        items, _ = parse_list(html, json.loads(source))
        for i, x in enumerate(items):
            yield i, x["title"], x["url"], x["date_text"], x["parsed_date"] or None, x["keyword_matched"]


@batch_udf(METRICS_TYPE)
def list_metrics(html: pd.Series, source: pd.Series) -> pd.DataFrame:
    names = [x.split()[0] for x in METRICS_TYPE.split(", ")]
    rows = [parse_list(h, json.loads(s))[1] for h, s in zip(html, source, strict=True)]
    return pd.DataFrame([[r[n] for n in names] for r in rows], columns=names)
