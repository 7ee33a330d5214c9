"""Is a detail page the notice that the list named? A table of ways in which titles can be one; the first that fits wins."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

import pandas as pd

from . import constants as K
from .lists import squeeze
from .udfs import batch_udf

SHORT_BADGE = re.compile(rf"(?i)^(?:{'|'.join(map(re.escape, K.TITLE_BADGES))})$")
STOP = re.compile(rf"(?i)\b(?:{'|'.join(K.TITLE_STOP_WORDS)})\b", re.ASCII)
BRACKETS = re.compile(r"\[([^\]]*)\]")


def normal(text: str | None) -> str:
    """Letters and digits in lower case, without known badges in brackets (of 12 characters at most) and stop words."""

    def opened(m: re.Match) -> str:
        inner = squeeze(m.group(1))
        return " " if len(inner) <= 12 and (not inner or SHORT_BADGE.match(inner)) else f" {inner} "

    return squeeze(STOP.sub(" ", re.sub(r"[\W_]+", " ", BRACKETS.sub(opened, squeeze(text).lower()))))


def peeled(text: str | None, passes: int = 4) -> str:
    """Without leading badges, so many layers at most."""
    layers = [squeeze(text)]
    while len(layers) <= passes and (len(layers) < 2 or layers[-1] != layers[-2]):
        layers.append(layers[-1])
        for pattern in K.TITLE_LAYERS:
            layers[-1] = re.sub(pattern, "", layers[-1])
        layers[-1] = layers[-1].strip()
    return layers[-1]


class Titles:
    """A list's title and one candidate for the detail's, in the forms in which they are compared."""

    def __init__(self, listed: str, raw: str):
        self.listed, self.raw = squeeze(listed), raw
        self.want, self.have, self.bare = normal(listed), normal(raw), normal(peeled(listed))

    @cached_property
    def segments(self) -> list[str]:
        return re.split(K.TITLE_SEGMENT, self.raw)

    def is_wanted(self, text: str) -> bool:
        return text != "" and text in (self.want, self.bare)

    def beyond(self) -> str | None:
        """What follows the list's title in the candidate; None where that does not start with it."""
        return self.have[len(self.want) :].strip() if self.have.startswith(self.want) else None

    @staticmethod
    def dressed(outer: str, inner: str, before: str, after: str) -> bool:
        """Whether outer is inner with nothing but such words around it."""
        left, held, right = outer.partition(inner)
        return bool(held) and all(not edge.strip() or bool(re.match(p, edge.strip())) for edge, p in ((left, before), (right, after)))


#: The ways, in their order.
MODES: tuple[tuple[str, Callable[[Titles], bool]], ...] = (
    ("normalized_exact", lambda t: t.have == t.want),
    ("notice_prefix_stripped_exact", lambda t: t.bare != "" and normal(peeled(t.raw)) == t.bare),
    ("detail_title_site_suffix_stripped", lambda t: t.is_wanted(normal(t.segments[0]))),
    ("detail_title_segment_match", lambda t: any(t.is_wanted(normal(peeled(s))) for s in t.segments)),
    ("detail_title_metadata_suffix_stripped", lambda t: bool(t.beyond()) and len(t.beyond()) <= 20 and bool(re.match(K.TITLE_SUFFIX, t.beyond()))),
    ("truncated_list_title_prefix", lambda t: bool(re.search(r"(?:\.{2,}|…)$", t.listed)) and t.have.startswith(t.want) and len(t.have) - len(t.want) <= 40),
    ("list_metadata_stripped", lambda t: t.dressed(t.want, t.have, K.BEFORE_LIST_TITLE, K.AFTER_LIST_TITLE)),
    ("detail_metadata_stripped", lambda t: t.dressed(t.have, t.want, K.BEFORE_DETAIL_TITLE, K.AFTER_DETAIL_TITLE)),
)


def verify(title: str | None, candidates: list[str] | None, raw_list: str | None = "", quality: str | None = "clean") -> tuple[bool, str, str, str]:
    """(verified, status, mode, matched title)."""
    no = lambda status, mode="": (False, status, mode or status, "")
    want, row, clean = normal(title), normal(raw_list), squeeze(quality) != "contaminated"
    if len(want) < 4:
        return no("title_unavailable")
    usable = [squeeze(c) for c in (candidates if candidates is not None else []) if len(normal(c)) >= 4]
    if not usable:
        return no("detail_title_unavailable")
    for raw in usable:
        titles = Titles(title or "", raw)
        if mode := next((name for name, fits in MODES if fits(titles)), ""):
            return True, "title_match", mode, raw
        if clean and row and titles.have in row and titles.have in want:
            return no("weak_raw_list_contains_detail_title", "raw_list_contains_detail_title_only")
    return no("title_mismatch") if clean else no("list_title_not_clean", "list_title_quality_failed")


@batch_udf("verified boolean, status string, mode string, matched string")
def verified(title: pd.Series, candidates: pd.Series, raw_list: pd.Series, quality: pd.Series) -> pd.DataFrame:
    rows = [verify(*x) for x in zip(title, candidates, raw_list, quality, strict=True)]
    return pd.DataFrame(rows, columns=["verified", "status", "mode", "matched"])
