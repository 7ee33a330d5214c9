"""Address rules. Where an address must be parsed as browsers do, a pandas UDF over urllib does it in Arrow batches."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import clean_text
from .udfs import batch_udf

ID_KEYS = "article_?no|article_?id|board_?no|board_?id|ntt_?no|idx|no|wr_id|b_idx|seq|uid|p_idx|post_id|id"
DETAIL_QUERY = rf"(?i)[?&](?:{ID_KEYS})=\d+|[?&](?:mode|p_mode|mod|act|action)=(?:view|read|detail|document)"
DETAIL_PATH = r"(?i)(?:/|_)(?:view|read|detail)(?:\.|/|_|[?#]|$)|/\d{4}/\d{1,2}/\d{1,2}/"
NAMED_KEY = rf"(?i)[?&](?:[^=&#]*_)?(?:{ID_KEYS}|message_?id)(?:=|&|#|$)"
CATEGORY_KEY = r"(?i)[?&][^=&#]*(?:category|cate|gubun|filter|search(?:type|kind|gubun)?)[^=&#]*(?:=|&|#|$)"


def normalise(url: Column) -> Column:
    """Without fragment; scheme and host in lower case, a bare host with its slash. What is no address stays as it is."""
    t = clean_text(url)
    bare = F.regexp_replace(t, "#.*$", "")
    head = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
    rest = F.substr(bare, F.length(head) + 1)
    path = F.when((rest == "") | F.startswith(rest, F.lit("?")), F.concat(F.lit("/"), rest)).otherwise(rest)
    return F.when(head != "", F.concat(F.lower(head), path)).otherwise(t)


def is_web(url: Column) -> Column:
    return clean_text(url).rlike("(?i)^https?://")


def parts(url: Column) -> dict[str, Column]:
    return {k: F.try_parse_url(url, F.lit(k)) for k in ("PROTOCOL", "HOST", "PATH", "QUERY")}


def is_list(url: Column) -> Column:
    """A list or menu page rather than a notice: a list path whose query, if any, only pages and filters."""
    p = parts(url)
    path, query = F.lower(F.coalesce(p["PATH"], F.lit(""))), F.coalesce(p["QUERY"], F.lit(""))
    hint = F.concat(path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), F.lower(query)))).rlike(K.DETAIL_HINT)
    keys = F.transform(F.split(query, "&"), lambda kv: F.lower(F.element_at(F.split(kv, "="), 1)))
    listing = (query == "") | F.forall(keys, lambda k: k.isin(*K.LIST_QUERY_KEYS))
    return F.coalesce(p["HOST"].isNotNull() & ~hint & path.rlike(K.LIST_PATH) & listing, F.lit(False))


def likely_detail(url: Column) -> Column:
    """The address looks like one notice's page: an identifying parameter, a view mode, or a telling path."""
    t = clean_text(url)
    portal = t.rlike(r"(?i)/main/view\.do(?:[?#]|$)")
    return (t != "") & (t.rlike(DETAIL_QUERY) | (~portal & (t.rlike(DETAIL_PATH) | t.rlike(NAMED_KEY))))


def same_page_category(url: Column, list_url: Column) -> Column:
    """The list's own page under another filter."""
    a, b = parts(url), parts(list_url)
    same = (a["PROTOCOL"] == b["PROTOCOL"]) & (a["HOST"] == b["HOST"]) & F.coalesce(a["PATH"], F.lit("/")).eqNullSafe(F.coalesce(b["PATH"], F.lit("/")))
    return F.coalesce(same & ~likely_detail(url) & url.rlike(CATEGORY_KEY), F.lit(False))


def same_site(a: Column, b: Column) -> Column:
    """One host is the other or lies below it, "www." aside."""
    x, y = (F.regexp_replace(F.lower(F.try_parse_url(u, F.lit("HOST"))), r"^www\.", "") for u in (a, b))
    below = lambda p, q: F.endswith(p, F.concat(F.lit("."), q))
    return F.coalesce((x == y) | below(x, y) | below(y, x), F.lit(False))


def imported(url: Column) -> Column:
    """An address out of a spreadsheet: a Markdown link's target, and a lost first letter put back."""
    t = clean_text(url)
    target = F.regexp_extract(t, r"\[[^\]]*\]\((https?://[^)\s]+)\)", 1)
    own = F.when(target != "", target).otherwise(t)
    return F.regexp_replace(own, "^ttps?://", "https://")


def repaired(url: Column, base: Column) -> Column:
    """https, and where the path was lost the base's path."""
    secure = F.regexp_replace(clean_text(url), "(?i)^http://", "https://")
    own, given = (F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit("")) for u in (secure, base))
    lost = own.isin("", "/") & ~given.isin("", "/") & F.try_parse_url(secure, F.lit("HOST")).eqNullSafe(F.try_parse_url(base, F.lit("HOST")))
    query = F.try_parse_url(secure, F.lit("QUERY"))
    host = F.concat(F.lit("https://"), F.try_parse_url(secure, F.lit("HOST")))
    return F.when(lost, F.concat(host, given, F.coalesce(F.concat(F.lit("?"), query), F.lit("")))).otherwise(secure)


def resolve_one(value: str | None, page: str | None, base: str | None = None, http_hosts: frozenset[str] = frozenset()) -> str:
    """An absolute https address; http stays for hosts that have nothing else, and where the page itself is http there."""
    text = " ".join((value or "").split())
    if not text or text.startswith("#") or text.lower().startswith("javascript:"):
        return ""
    for reference in (page, base):
        try:
            found = urlsplit(urljoin(reference or "", text))
        except ValueError:
            continue
        if not found.scheme or not (found.netloc or found.scheme not in ("http", "https")):
            continue
        scheme = found.scheme
        if scheme in ("http", "https") and found.hostname in http_hosts:
            scheme = "http"
        elif scheme == "http":
            kept = any(r and r.lower().startswith("http://") and urlsplit(r).netloc == found.netloc for r in (page, base))
            scheme = "http" if kept else "https"
        path = found.path or ("/" if found.netloc else "")
        return urlunsplit((scheme, found.netloc.lower(), path, found.query, found.fragment))
    return ""


def from_script(script: str | None, page: str, base: str | None = None) -> str:
    """The address that a click handler leads to: one it names, or the page with the identifier it passes."""
    import re

    text = " ".join((script or "").split())
    if not text or re.search(r"\bjf_view\s*\(", text, re.I):
        return ""  # such handlers post a form; a made-up address could not be verified
    for pattern in (r"https?://[^\s\"'()<>]+", r"/[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]+"):
        if found := re.search(pattern, text, re.I):
            return resolve_one(found.group(), page, base)
    if found := re.search(r"(?:articleNo|boardNo|nttNo|idx|no|wr_id|b_idx|seq|uid)\s*[:=,'\"]+\s*['\"]?(\d+)", text, re.I):
        return with_query(page, {"articleNo": found.group(1)})
    return ""


#: Click handlers of some sources, by the start of the source's id: the call, and the parameters that its arguments become.
_HANYANG = "_kr_ac_hanyang_bbs_web_portlet_BbsPortlet_"
SITE_HANDLERS = {
    "cau_": (r"goView\s*\(\s*['\"]?(\d+)['\"]?\s*\)", {"no": r"\1"}),
    "ewha_": (r"viewArticle\s*\(\s*['\"]?(\d+)['\"]?\s*\)", {"articleNo": r"\1"}),
    "hanyang_": (
        r"viewMessage\s*\(\s*['\"]?(\d+)['\"]?",
        {"p_p_id": "kr_ac_hanyang_bbs_web_portlet_BbsPortlet", "p_p_lifecycle": "0", "p_p_state": "normal", "p_p_mode": "view", f"{_HANYANG}action": "view_message", f"{_HANYANG}messageId": r"\1"},
    ),
    "uos_": (r"fnView\s*\(\s*['\"]?(\d+)['\"]?\s*,\s*['\"]?(\d+)['\"]?", {"sort": r"\1", "seq": r"\2", "identified": "anonymous"}),
}


def from_site(source_id: str | None, script: str | None, page: str) -> str:
    """The address that a click handler of a known source leads to, empty for others. Parameters that are there keep their place."""
    import re

    name, text = " ".join((source_id or "").split()).lower(), " ".join((script or "").split())
    for start, (call, values) in SITE_HANDLERS.items():
        if name.startswith(start) and (found := re.search(call, text, re.I | re.A)):
            url, new = urlsplit(page), {k: found.expand(v) for k, v in values.items()}
            query: dict = {}
            for at, (k, v) in enumerate(parse_qsl(url.query, keep_blank_values=True)):
                query.setdefault(k if k in new else (k, at), (k, new.get(k, v)))
            for k, v in new.items():
                query.setdefault(k, (k, v))
            path = re.sub(r"(?i)/(?:allList|list)\.do$", "/view.do", url.path) if start == "uos_" else url.path
            return urlunsplit(url._replace(path=path, query=urlencode(list(query.values()))))
    return ""


def with_query(url: str, values: dict[str, str]) -> str:
    found = urlsplit(url)
    query = [kv for kv in parse_qsl(found.query, keep_blank_values=True) if kv[0] not in values] + list(values.items())
    return urlunsplit(found._replace(query=urlencode(query)))


@batch_udf("string")
def resolve(value: pd.Series, page: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([resolve_one(*x) for x in zip(value, page, base, strict=True)])


@batch_udf("string")
def script_target(script: pd.Series, page: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([from_script(*x) for x in zip(script, page, base, strict=True)])
