"""Decisions over counters as ordered conditions: the first that holds wins. Inputs are columns; null counts are 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import clean_text
from .urls import normalise


def first_of(rules: list[tuple[Column, str]], otherwise: Column | str | None = None) -> Column:
    """The name of the first rule that holds."""
    named = [F.when(c, F.lit(name)) for c, name in rules]
    return F.coalesce(*named, F.lit(otherwise) if isinstance(otherwise, str) or otherwise is None else otherwise)


def flags(rules: list[tuple[Column, str]]) -> Column:
    """The names of all rules that hold, in their order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for c, name in rules)))


def count(x: Column) -> Column:
    return F.coalesce(x.cast("bigint"), F.lit(0))


def fetch_failure(status: Column, message: Column, code: Column) -> Column:
    """What went wrong with a request, by its status, the joined messages of its errors, and their codes."""
    m, c = F.lower(clean_text(message)), F.upper(clean_text(code))
    s = F.coalesce(status.cast("int"), F.lit(0))
    return first_of(
        [
            (s.isin(401, 403) | m.rlike("captcha|login|required|unauthorized|forbidden"), "AUTH_OR_CAPTCHA_REQUIRED"),
            ((s == 429) | m.rlike("rate.?limit|too many requests|blocked|bot"), "BOT_BLOCKED_OR_RATE_LIMITED"),
            (s.isin(404, 410), "URL_DEAD_HTTP_404_410"),
            (s >= 500, "SERVER_ERROR_5XX"),
            (m.rlike("timeout|aborted|terminated|socket|econnreset|etimedout"), "TIMEOUT_OR_CONNECTION_ABORTED"),
            (m.rlike("cert|tls|ssl|self.?signed|certificate|unable to verify") | c.rlike("CERT|TLS|SSL|UNABLE_TO_VERIFY"), "TLS_OR_CERTIFICATE_EXCEPTION"),
            (m.rlike("enotfound|getaddrinfo|dns"), "URL_DEAD_DNS"),
        ],
        "UNKNOWN_NEEDS_MANUAL_REVIEW",
    )


def access_profiles(c: dict[str, Column]) -> Column:
    """How a source can be read, as a set in a fixed order.

    Columns: adapter, charset, failure, selector (configured), selector_matches, links, valid_links, event_urls,
    pagination, detail_failures, manual_evidence, post_redirects, access_mode, browser_evidence, adapter_post, html.
    """
    charset = F.lower(clean_text(c["charset"]))
    mode, seen = F.lower(clean_text(c["access_mode"])), F.lower(clean_text(c["browser_evidence"]))
    posted = mode.isin("form_post_redirect", "post_redirect") | (count(c["post_redirects"]) > 0) | F.coalesce(c["adapter_post"], F.lit(False)) | seen.rlike(r"post\s*(?:->|redirect)|form_post_redirect|302\s*redirect")
    none_matched = count(c["selector_matches"]) == 0
    client = c["html"].rlike(r"(?i)__NEXT_DATA__|<div[^>]+id=[\"'](?:root|app)[\"']|ng-app|vue|react")
    failure = lambda name: F.coalesce(c["failure"] == name, F.lit(False))
    found = flags(
        [
            (clean_text(c["adapter"]) != "", "JSON_XHR_API"),
            ((charset != "") & ~charset.isin("utf-8", "utf8"), "LEGACY_CHARSET"),
            *((failure(x), x) for x in ("TLS_OR_CERTIFICATE_EXCEPTION", "BOT_BLOCKED_OR_RATE_LIMITED", "AUTH_OR_CAPTCHA_REQUIRED")),
            (count(c["detail_failures"]) > 0, "DETAIL_PAGE_UNREACHABLE"),
            ((count(c["manual_evidence"]) > 0) | (count(c["event_urls"]) > 0), "STATIC_HTML_EVENT_URL"),
            (posted, "FORM_POST_REDIRECT"),
            (count(c["pagination"]) > 0, "SERVER_RENDERED_WITH_PAGINATION"),
            (F.coalesce(client, F.lit(False)) & none_matched, "CLIENT_RENDERED_OR_JS_REQUIRED"),
            (none_matched & (clean_text(c["selector"]) != ""), "SOURCE_CONFIG_OR_SELECTOR_MISMATCH"),
            (count(F.coalesce(c["links"], c["valid_links"])) > 0, "STATIC_HTML_HREF"),
        ]
    )
    return F.when(F.size(found) == 0, F.array(F.lit("UNKNOWN_NEEDS_MANUAL_REVIEW"))).otherwise(found)


def primary_failure(c: dict[str, Column]) -> Column:
    """The one failure that explains a source's run; empty where none does.

    Columns: failure, empty_state, crawled, menu, has_selector, selector_matches, fallback, manual_evidence, links,
    valid_links, keyword_matches, candidates, leaks, detail_failures, samples, fetched, empty_details, verified, unverified,
    dated.
    """
    n = lambda k: count(c[k])
    is_set = lambda k: F.coalesce(c[k], F.lit(False))
    rules = [
        (is_set("empty_state") & (n("crawled") == 0), "ZERO_RECENT_NOTICES"),
        (is_set("menu"), "LIST_SELECTOR_MENU_CONTAMINATION"),
        (is_set("has_selector") & (n("selector_matches") == 0), "LIST_SELECTOR_ZERO_MATCHES"),
        (is_set("fallback") & (n("crawled") == 0), "CONFIG_OR_SELECTOR_MISMATCH"),
        ((n("manual_evidence") > 0) & (n("links") == 0), "MANUAL_BROWSER_NETWORK_REQUIRED"),
        ((n("crawled") > 0) & (n("links") == 0), "URL_RESOLUTION_FAILED"),
        ((n("links") > 0) & (n("valid_links") == 0), "URL_RESOLUTION_FAILED"),
        (n("crawled") == 0, "ZERO_RECENT_NOTICES"),
        ((n("keyword_matches") == 0) | (n("candidates") == 0), "FILTERED_OUT_BY_KEYWORD"),
        (n("leaks") > 0, "DETAIL_IDENTITY_UNVERIFIED"),
        (n("detail_failures") > 0, "DETAIL_FETCH_FAILED"),
        (n("samples") == 0, "DETAIL_URL_UNVERIFIED"),
        (n("fetched") == 0, "DETAIL_FETCH_FAILED"),
        (n("empty_details") > 0, "DETAIL_CONTENT_EMPTY_OR_BOILERPLATE"),
        ((n("verified") == 0) | (n("unverified") > 0), "DETAIL_IDENTITY_UNVERIFIED"),
        ((n("dated") == 0) & (n("candidates") == 0), "FILTERED_OUT_BY_DATE"),
    ]
    return F.coalesce(F.nullif(c["failure"], F.lit("")), first_of(rules, ""))


def source_decision(profiles: Column, failure: Column, candidates: Column, samples: Column, fetched: Column, verified: Column, leaks: Column) -> Column:
    """One of nine outcomes of a source."""
    f = F.coalesce(failure, F.lit(""))
    has = lambda *names: F.arrays_overlap(profiles, F.array(*map(F.lit, names)))
    none = count(candidates) == 0
    good = (f == "") & (count(samples) >= 1) & (count(fetched) >= 1) & (count(verified) >= 1) & (count(leaks) == 0)
    return first_of(
        [
            (f == "MANUAL_BROWSER_NETWORK_REQUIRED", "manual_review_required"),
            (f == "ADAPTER_REQUIRED", "adapter_required"),
            (f == "DETAIL_FETCH_FAILED", "list_supported_detail_failed"),
            (f.isin("DETAIL_URL_UNVERIFIED", "DETAIL_IDENTITY_UNVERIFIED", "DETAIL_CONTENT_EMPTY_OR_BOILERPLATE"), "list_supported_detail_unverified"),
            (good, "supported"),
            (has("AUTH_OR_CAPTCHA_REQUIRED", "BOT_BLOCKED_OR_RATE_LIMITED"), "manual_review_required"),
            (none & (f == "FILTERED_OUT_BY_KEYWORD"), "posts_found_no_scholarship"),
            (none & (f == "ZERO_RECENT_NOTICES"), "no_posts_detected"),
            (none & (f == "FILTERED_OUT_BY_DATE"), "valid_zero_candidates"),
            (has("JSON_XHR_API", "CLIENT_RENDERED_OR_JS_REQUIRED"), "adapter_required"),
            (f.isin("LIST_SELECTOR_ZERO_MATCHES", "LIST_SELECTOR_MENU_CONTAMINATION", "URL_RESOLUTION_FAILED", "CONFIG_OR_SELECTOR_MISMATCH"), "config_or_selector_fix"),
            (f == "", "list_supported_detail_unverified"),
        ],
        "manual_review_required",
    )


def quality_flags(body: Column, quality: Column) -> Column:
    t, q = clean_text(body), F.lower(clean_text(quality))
    empty = (t == "") | (q == "empty")
    return flags([(empty, "empty_body"), (~empty & ((F.length(t) < K.SHORT_BODY) | F.contains(q, F.lit("short"))), "short_body")])


def missing_required(title: Column, url: Column) -> Column:
    return flags([(clean_text(title) == "", "missing_title"), (normalise(url) == "", "missing_discovered_url")])


def missing_optional(canonical: Column, posted: Column) -> Column:
    from .dates import iso_head

    return flags([(normalise(canonical) == "", "missing_canonical_url"), (iso_head(posted).isNull(), "missing_published_at")])


def local_class(missing: Column, run_quality: Column, duplicate: Column, quality: Column) -> Column:
    unsafe = F.coalesce(run_quality == "unsafe_for_lifecycle_judgment", F.lit(False))
    return first_of(
        [(F.size(missing) > 0, "blocked_by_missing_required_field"), (unsafe, "needs_quality_review"), (F.coalesce(duplicate, F.lit(False)), "duplicate_within_input"), (F.size(quality) > 0, "needs_quality_review")],
        "new_candidate",
    )


def severity(changes: Column, safe: Column) -> Column:
    """The gravest of the changes; a source that is known to be unsafe makes everything unsafe."""
    has = lambda names: F.arrays_overlap(changes, F.array(*map(F.lit, names)))
    unsafe = has(K.UNSAFE_CHANGES) | ~F.coalesce(safe, F.lit(True))
    return first_of([(unsafe, "unsafe"), (has(K.HIGH_CHANGES), "high"), (has(K.MEDIUM_CHANGES), "medium")], "low")


def body_rank(quality: Column) -> Column:
    q = F.lower(clean_text(quality))
    return F.when(F.contains(q, F.lit("empty")), 0).when(F.contains(q, F.lit("short")), 1).when(q.rlike("full|detail|good"), 3).otherwise(2)


def run_changes(now: dict[str, Column], before: dict[str, Column]) -> Column:
    """What changed between two states of one notice; texts count only where both are there."""
    text = lambda k: F.coalesce((now[k] != "") & (before[k] != "") & (now[k] != before[k]), F.lit(False))
    other = lambda k: ~now[k].eqNullSafe(before[k])
    new, old = body_rank(now["body_quality"]), body_rank(before["body_quality"])
    found = flags(
        [
            (text("title"), "title_changed"),
            (text("published_at"), "published_at_changed"),
            (text("canonical_url"), "canonical_url_changed"),
            (text("content_hash"), "content_hash_changed"),
            (text("content_hash"), "body_changed"),
            (new > old, "body_quality_improved"),
            (new < old, "body_quality_degraded"),
            (other("asset_count"), "asset_count_changed"),
            (other("asset_fingerprint"), "asset_url_changed"),
            (other("warning_count"), "warning_count_changed"),
            (other("error_count"), "error_count_changed"),
        ]
    )
    return F.when(F.size(found) == 0, F.array(F.lit("unchanged_content"))).otherwise(found)


def existing_changes(now: dict[str, Column], stored: dict[str, Column], aliases: Column) -> Column:
    """What a stored notice lacks of the one read now: title, body (by hash, else by text), address, alias, assets."""
    filled = lambda x: F.coalesce(x, F.lit("")) != ""
    hashed = filled(now["content_hash"]) & filled(stored["content_hash"]) & (now["content_hash"] != clean_text(stored["content_hash"]))
    body = hashed | (filled(now["body_text"]) & (now["body_text"] != clean_text(stored["body_text"])))
    known = F.coalesce(F.array_contains(aliases, now["discovered_url"]), F.lit(False)) | now["discovered_url"].eqNullSafe(stored["canonical_url"])
    return flags(
        [
            (filled(now["title"]) & (now["title"] != clean_text(stored["title"])), "title_changed"),
            (body, "body_changed"),
            (filled(now["canonical_url"]) & filled(stored["canonical_url"]) & (now["canonical_url"] != stored["canonical_url"]), "canonical_url_changed"),
            (filled(now["discovered_url"]) & ~known, "url_alias_candidate"),
            (count(now["asset_count"]) != count(stored["asset_count"]), "asset_count_changed"),
        ]
    )


def existing_class(changes: Column) -> Column:
    only_alias = (F.size(changes) == 1) & F.array_contains(changes, "url_alias_candidate")
    return first_of([(F.size(changes) == 0, "unchanged_candidate"), (only_alias, "url_alias_candidate")], "changed_candidate")


def run_quality(given: Column, blocked: Column, timeouts: Column, http_errors: Column, mismatches: Column, cut_short: Column, fetched: Column, output: Column, weak: Column, never: Column) -> Column:
    """State of a source's run: the given one, or the first that its counters tell."""
    derived = first_of(
        [
            (blocked, "blocked"),
            ((count(timeouts) > 0) | (count(http_errors) > 0), "network_failed"),
            (count(mismatches) > 0, "selector_mismatch"),
            (F.coalesce(cut_short, F.lit(False)), "pagination_incomplete"),
            ((count(fetched) > 0) & (count(output) == 0), "degraded"),
            (count(weak) > 0, "partial"),
        ],
        "healthy",
    )
    own = F.nullif(F.lower(clean_text(given)), F.lit(""))
    return F.when(F.coalesce(never, F.lit(False)), "unsafe_for_lifecycle_judgment").otherwise(F.coalesce(own, derived))


def safe_for_changes(quality: Column) -> Column:
    return ~quality.isin(*K.UNSAFE_RUNS)


def safe_for_missing(quality: Column, cut_short: Column, blocked: Column) -> Column:
    return quality.isin("healthy", "partial") & ~F.coalesce(cut_short, F.lit(False)) & ~F.coalesce(blocked, F.lit(False))


def visibility(seen: Column, quality: Column, cut_short: Column, blocked: Column, safe: Column) -> Column:
    """What it means that a notice of the last run was or was not seen in this one. Null quality: no state of its source."""
    return first_of(
        [
            (seen, "still_visible"),
            (quality.isNull(), "needs_recheck"),
            (quality == "network_failed", "missing_but_source_fetch_failed"),
            ((quality == "pagination_incomplete") | F.coalesce(cut_short, F.lit(False)), "missing_but_pagination_incomplete"),
            ((quality == "blocked") | F.coalesce(blocked, F.lit(False)), "missing_but_source_blocked"),
            (~F.coalesce(safe, F.lit(False)) | (quality == "degraded"), "missing_but_source_degraded"),
        ],
        "potentially_missing",
    )


def reject_reason(title: Column, url: Column) -> Column:
    """Why a crawled row is no notice; null where it may be one."""
    from .urls import is_list

    t, u = clean_text(title), clean_text(url)
    return first_of(
        [
            (t == "", "empty_title"),
            (u == "", "empty_url"),
            (~u.rlike("(?i)^https?://"), "invalid_url"),
            (u.rlike("(?i)^http://"), "insecure_http_url"),
            (F.length(F.regexp_replace(t, r"\s+", "")) <= 6, "too_short_title"),
            (t.rlike(K.MENU_REJECT), "menu_like_title"),
            (is_list(u), "not_detail_notice_url"),
        ]
    )


def apply_blockers(marked: Column, title: Column, url: Column, quality: Column, body: Column, assets: Column, local: Column, found: Column, safe: Column) -> Column:
    """Reasons why a notice is not ready to be applied. A body of SHORT_BODY characters that is not called short is full."""
    q, t = F.lower(clean_text(quality)), clean_text(body)
    full = (t != "") & ~F.contains(q, F.lit("short")) & (F.length(t) >= K.SHORT_BODY)
    is_class = lambda name: F.coalesce(local == name, F.lit(False))
    return flags(
        [
            (~F.coalesce(marked, F.lit(False)), "controlled_fixture_marker_missing"),
            (clean_text(title) == "", "missing_title"),
            (normalise(url) == "", "missing_discovered_url"),
            (~full, "body_quality_not_full"),
            (count(assets) == 0, "asset_required_for_controlled_phase1"),
            *((is_class(x), x) for x in ("needs_quality_review", "blocked_by_missing_required_field", "blocked_by_schema")),
            (F.coalesce(F.size(found), F.lit(0)) > 0, "quality_flags_present"),
            (~F.coalesce(safe, F.lit(True)), "source_health_unsafe"),
        ]
    )


def dead_link(status: Column, message: Column) -> Column:
    """Category of a link that was tried: by its status, or by the error of the last try."""
    s, m = status.cast("int"), F.coalesce(message, F.lit(""))
    return first_of(
        [
            (s.isin(404, 410, 451), "dead_link_candidate"),
            (s.isin(403, 429), "blocked_or_rate_limited"),
            (s >= 500, "server_error"),
            (s.between(200, 399), "reachable"),
            (s.isNotNull(), "other_http"),
            (m.rlike("(?i)aborted|timeout"), "timeout_or_network"),
            (m.rlike("(?i)ENOTFOUND|DNS"), "dead_link_candidate"),
        ],
        "timeout_or_network",
    )


# What is advised for each decision.
ACTIONS = {
    "adapter_required": "Implement or repair a source adapter.",
    "list_supported_detail_unverified": "Review detail identity evidence before trusting this source as fully verified.",
    "list_supported_detail_failed": "Fix detail URL resolution or source access before trusting this source.",
    "manual_review_required": "Review access and network behavior manually.",
    "config_or_selector_fix": "Fix source selectors or URL pattern.",
    "posts_found_no_scholarship": "Crawler parsed posts, but no scholarship keyword candidate was found.",
    "no_posts_detected": "Crawler found no posts on the configured board; verify whether the board is empty or the URL is wrong.",
    "valid_zero_candidates": "No crawler change needed unless source content changed.",
}


def recommended_action(decision: Column, failure: Column) -> Column:
    """What to do next with a source."""
    lookup = F.create_map(*(F.lit(x) for kv in ACTIONS.items() for x in kv))
    network = (decision == "manual_review_required") & (failure == "MANUAL_BROWSER_NETWORK_REQUIRED")
    return F.when(network, "Collect browser Network evidence before implementing an adapter.").otherwise(F.coalesce(F.element_at(lookup, decision), F.lit("Supported by current crawler path.")))


def structure_bucket(has_selector: Column, framework: Column, anchors: Column, body_chars: Column, items: Column, links: Column) -> Column:
    """What a list page's structure says about its source's settings."""
    thin = F.coalesce(framework, F.lit(False)) | (count(anchors) < 5) | (count(body_chars) < 300)
    return first_of(
        [
            (has_selector & (count(items) == 0) & thin, "js_suspect"),
            (has_selector & (count(items) == 0), "selector_miss"),
            (has_selector & (count(links) == 0), "link_extract_fail"),
            (has_selector, "ok"),
            (thin, "js_suspect"),
        ],
        "fallback_scan",
    )


def valid_zero(page_ok: Column, boards: Column, empty_boards: Column, links: Column, scoped: Column) -> Column:
    """Whether a source without finds looks in the right place."""
    return first_of(
        [
            (~F.coalesce(page_ok, F.lit(False)), "needs_recheck_current_url_fetch_failed"),
            (count(boards) > 0, "better_scholarship_board_found"),
            (count(empty_boards) > 0, "empty_scholarship_board_found"),
            (count(links) > 0, "scholarship_link_seen_but_not_parseable_board"),
            (F.coalesce(scoped, F.lit(False)), "current_url_already_scholarship_scoped"),
        ],
        "current_notice_url_has_no_scholarship_candidates",
    )


def link_rank(text: Column, url: Column, board: str, info: str) -> Column:
    """How much a link promises to lead to the wanted board; `board` and `info` are patterns."""
    t, u = F.coalesce(text, F.lit("")), F.coalesce(url, F.lit(""))
    points = lambda c, n: F.when(c, n).otherwise(0)
    is_board = t.rlike(board) | u.rlike(board)
    return (
        points(t.rlike(r"(?i)장학\s*공지|scholarship\s*notice"), 40)
        + points(t.rlike("(?i)장학|scholarship"), 20)
        + points(is_board, 15)
        - points(t.rlike(info) & ~t.rlike(board), 20)
        + points(u.rlike(r"(?i)/(?:notice|board|bbs|article|news|list)(?![A-Za-z0-9_])"), 10)
        + points(u.rlike(r"(?i)[?&](?:board|bbs|menu|mid|category|cate|tab|code|id)="), 8)
    )


def tuned_selectors(c: dict[str, Column]) -> dict[str, Column]:
    """A source's settings with defaults where they are blank; boards of one kind get more of them."""
    board = F.contains(F.lower(clean_text(c["list_url"])), F.lit(".do"))
    blank = lambda x: clean_text(x) == ""
    default = lambda k, v, when: F.when(blank(c[k]) & when, F.lit(v)).otherwise(c[k])
    date = F.when(board & (blank(c["date_selector"]) | (clean_text(c["date_selector"]) == "td")), F.lit("td:last-child, .date, .board-date, .wr_date")).otherwise(c["date_selector"])
    return {
        "list_item_selector": default("list_item_selector", "tbody tr", board),
        "link_selector": default("link_selector", "a[href]", F.lit(True)),
        "title_selector": default("title_selector", "a[href]", board),
        "date_selector": date,
    }


def stage_events(status: dict[str, Column]) -> Column:
    """array<struct<stage,ordinal,status>>: one entry for each of the fixed stages; a stage without status was skipped."""
    rows = [F.struct(F.lit(s).alias("stage"), F.lit(i).alias("ordinal"), F.coalesce(status.get(s, F.lit(None).cast("string")), F.lit("skipped")).alias("status")) for i, s in enumerate(K.STAGES)]
    return F.array(*rows)
