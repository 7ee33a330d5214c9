"""Rules on single values: texts, dates, addresses, titles, HTML, JSON."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomspark.functions import arrays as A
from loomspark.functions import dates, details, documents, dom, identity, lists, urls
from loomspark.functions import decisions as D
from loomspark.functions import text as T


def one(spark, column, **values):
    """The column over one row of literals."""
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("rule", "given", "want"),
    [
        (T.clean_text, " a \t b\n", "a b"),
        (T.clean_text, None, ""),
        (T.offer_name, "2024학년도 1학기 [2024년] 좋은 이름 -", "좋은 이름"),
        (T.offer_name, "2024", "2024"),
        (T.list_title, "2024.01.02 Undergraduate Title hit 12 updated", "Title"),
        (T.list_title, "공지 새 글 제목 attach_file", "제목"),
        (T.identity_title, "[공지] The NOTICE: Big-Title!", "the big title"),
        (T.identity_title, "[장학 프로그램 소개] 장학", "장학 프로그램 소개 장학"),
        (T.strip_prefixes, "1. new 공통 제목: [일반공지] 공지 참 제목", "참 제목"),
        (T.first_segment, "제목 | 사이트 > x", "제목"),
        (T.name_stem, "컴퓨터공학과", "컴퓨터공학"),
        (T.name_stem, "기계 공학전공", "기계공학"),
        (T.name_variants, "컴퓨터학부(소프트웨어전공)", ["컴퓨터학부(소프트웨어전공)", "소프트웨어전공", "컴퓨터학부"]),
        (T.name_variants, "A/B", ["A/B", "A", "B"]),
        (T.reject_tag, "[Not_Ours] x", "not_ours"),
        (T.reject_tag, "마감됨", "expired"),
        (T.condition_pieces, "○ 다자녀 / [제한사항] 이미 받은 자 / 다자녀 ※자세한 사항은 첨부파일 또는 홈페이지 참고", ["다자녀", "[제한] 이미 받은 자"]),
        (T.condition_pieces, "해당없음", []),
        (T.number, "1,200 원", 1200.0),
        (T.number, "x", None),
        (T.phone, "02 123 45678", "021-234-5678"),
        (T.split_list, " a, ,b ", ["a", "b"]),
        (lambda c: T.flag(c, True), "No", False),
        (lambda c: T.flag(c, True), "?", True),
        (T.menu_title, "로그인", True),
        (lambda c: T.without_aliases(c, ["한국대 ", "한국"]), "한국대 물리학과", "물리학과"),
        (lambda c: T.department_of(c, ["한국대"]), "한국대 장학공지", None),
        (lambda c: T.department_of(c, ["한국대"]), "한국대 화학과(중앙)", "화학과"),
        (dates.iso_head, "2024-13-99T00:00", "2024-13-99"),
        (dates.iso_head, "2024/01/01", None),
        (urls.normalise, "HTTPS://A.Example.com#x", "https://a.example.com/"),
        (urls.normalise, "not an address", "not an address"),
        (urls.imported, "[here](https://x.example.com/a)", "https://x.example.com/a"),
        (urls.imported, "ttps://x.example.com/a", "https://x.example.com/a"),
        (urls.is_list, "https://x.example.com/notice/list?page=2", True),
        (urls.is_list, "https://x.example.com/notice/list?id=2", False),
        (urls.is_list, "https://x.example.com/notice/view?no=12", False),
        (urls.is_list, "http://[broken", False),
        (urls.likely_detail, "https://x.example.com/a/view.do?x=1", True),
        (urls.likely_detail, "https://x.example.com/main/view.do", False),
        (urls.likely_detail, "https://x.example.com/list?page=1", False),
        (A.grades, "1,2 2 9", [1, 2]),
        (A.level, "10.9", 10),
        (A.level, "11", None),
        (A.json_texts, '["a", "", " b"]', ["a", " b"]),
        (A.json_texts, "oops", []),
    ],
)
def test_rules(spark, rule, given, want):
    assert one(spark, rule(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(("given", "want"), [("posted 2024. 2. 30, 24.3.1", None), ("2024년 2월 29일", "2024-02-29"), ("24-03-01", "2024-03-01"), ("", None)])
def test_parse_date(spark, given, want):
    got = one(spark, dates.parse_date(F.lit(given)).cast("string"))
    assert got == want or (want is None and given.startswith("posted") and got == "2024-03-01")


@pytest.mark.parametrize(("born", "day", "age"), [("2004-02-29", "2023-02-28", 18), ("2004-02-29", "2023-03-01", 19), ("2000-05-05", "2020-05-05", 20), ("2000-05-06", "2020-05-05", 19)])
def test_age(spark, born, day, age):
    assert one(spark, dates.age_years(F.lit(born).cast("date"), F.lit(day).cast("date"))) == age


@pytest.mark.parametrize(("born", "age"), [("2000-03-02", 0), ("2001-02-28", 0), ("2001-03-01", -1), ("2004-02-29", -3), ("2017-03-24", -17), (None, None)])
def test_age_before_birth(spark, born, age):
    assert one(spark, dates.age_years(F.lit(born).cast("date"), F.lit("2000-03-01").cast("date"))) == age


def test_calendar(spark):
    day = lambda s: F.lit(s).cast("date")
    assert one(spark, dates.seoul_date(F.expr("TIMESTAMP_NTZ '2024-01-01 14:59:59'")).cast("string")) == "2024-01-01"
    assert one(spark, dates.seoul_date(F.expr("TIMESTAMP_NTZ '2024-01-01 15:00:00'")).cast("string")) == "2024-01-02"
    assert one(spark, dates.is_open(day("9999-12-31"), day("2024-01-01"))) and not one(spark, dates.is_open(day("2023-12-31"), day("2024-01-01")))
    assert one(spark, dates.period(day("2024-01-02"), F.lit(None).cast("date"))) == "2024/01/02 ~ —"
    assert one(spark, dates.period(None or F.lit(None).cast("date"), day("2099-12-31"))) == "상시모집"
    assert one(spark, dates.elapsed_ms(F.expr("TIMESTAMP '2024-01-01 00:00:01'"), F.expr("TIMESTAMP '2024-01-01 00:00:00'"))) == 0


def test_same_site(spark):
    pairs = [("https://www.a.example.com/x", "https://a.example.com", True), ("https://b.a.example.com", "https://a.example.com/", True), ("https://ba.example.com", "https://a.example.com", False), ("bad", "https://a.example.com", False)]
    for a, b, want in pairs:
        assert one(spark, urls.same_site(F.lit(a), F.lit(b))) is want


def test_resolve():
    page = "https://x.example.com/notice/list.do?page=1"
    assert urls.resolve_one("view.do?no=1", page) == "https://x.example.com/notice/view.do?no=1"
    assert urls.resolve_one("http://y.example.com/a", page) == "https://y.example.com/a"
    assert urls.resolve_one("/a", "http://x.example.com/") == "http://x.example.com/a"
    assert urls.resolve_one("http://old.example.com/a", page, None, frozenset({"old.example.com"})).startswith("http://")
    assert [urls.resolve_one(v, page) for v in ("#top", "javascript:go()", "", None)] == [""] * 4
    assert urls.from_script("go(/a/b?no=3", page) == "https://x.example.com/a/b?no=3"
    assert urls.from_script("open('no','77')", page) == "https://x.example.com/notice/list.do?page=1&articleNo=77"
    assert urls.from_script("jf_view(1, 2)", page) == ""


@pytest.mark.parametrize(
    ("title", "candidates", "mode"),
    [
        ("국가장학금 신청 안내", ["국가장학금 신청 안내"], "normalized_exact"),
        ("[공지] 국가장학금 신청", ["1. 국가장학금 신청"], "notice_prefix_stripped_exact"),
        ("국가장학금 신청", ["국가장학금 신청 | 대학 이름"], "detail_title_site_suffix_stripped"),
        ("국가장학금 신청", ["대학 이름 | 국가장학금 신청"], "detail_title_segment_match"),
        ("국가장학금 신청", ["국가장학금 신청 조회 12"], "detail_title_metadata_suffix_stripped"),
        ("국가장학금 신청 기간이...", ["국가장학금 신청 기간이 변경되었습니다"], "truncated_list_title_prefix"),
        ("학부 국가장학금 신청 updated", ["국가장학금 신청"], "list_metadata_stripped"),
        ("국가장학금 신청", ["학사 국가장학금 신청 updated"], "detail_metadata_stripped"),
        ("국가장학금 신청", ["아주 다른 글입니다"], "title_mismatch"),
        ("abc", ["abc"], "title_unavailable"),
        ("국가장학금 신청", ["a"], "detail_title_unavailable"),
    ],
)
def test_title_identity(title, candidates, mode):
    ok, _, got, _ = identity.verify(title, candidates)
    assert got == mode and ok == (mode not in ("title_mismatch", "title_unavailable", "detail_title_unavailable"))


def test_title_identity_doubts():
    assert identity.verify("긴 제목 앞 국가장학금 뒤 다른 말", ["국가장학금"], "긴 제목 앞 국가장학금 뒤 다른 말")[1] == "weak_raw_list_contains_detail_title"
    assert identity.verify("국가장학금 신청", ["다른 글입니다"], "", "contaminated")[1] == "list_title_not_clean"


BOARD = """<html><body><nav><ul><li><a href="/login">로그인</a></li></ul></nav><table><tbody>
<tr><td>1</td><td><a href="/notice/view.do?no=11">장학금 신청 안내</a></td><td class="date">2024.03.02</td></tr>
<tr><td>2</td><td><a href="/notice/view.do?no=12">학사 일정 변경</a></td><td class="date">2024.03.01</td></tr>
<tr><td>2</td><td><a href="/notice/view.do?no=12">학사 일정 변경</a></td><td class="date">2024.03.01</td></tr>
</tbody></table><div class="paging"><a href="?page=2">2</a></div></body></html>"""
SOURCE = {"list_url": "https://x.example.com/notice/list.do"}


def test_list_strategies():
    items, m = lists.parse_list(BOARD, SOURCE | {"list_item_selector": "tbody tr"})
    assert [x["url"][-2:] for x in items] == ["11", "12"] and m["strategy"] == "A_CONFIGURED_SELECTOR" and m["pagination"] == 1
    assert [x["parsed_date"] for x in items] == ["2024-03-02", "2024-03-01"] and [x["keyword_matched"] for x in items] == [True, False]
    items, m = lists.parse_list(BOARD, SOURCE | {"list_item_selector": ".gone"})
    assert len(items) == 2 and m["strategy"] == "B_COMMON_BOARD" and m["recovered"] and m["selector_matches"] == 0
    anchors = '<div class="post"><a href="/board/view?seq=5">등록금 지원 공고문</a> 2024-01-05</div><div><a href="/about">About us</a></div>'
    items, m = lists.parse_list(anchors, SOURCE)
    assert [x["url"] for x in items] == ["https://x.example.com/board/view?seq=5"] and m["strategy"] == "C_HEURISTIC_ANCHOR"


def test_list_evidence():
    menu = "<table><tbody>" + "<tr><td><a href='/x'>홈</a></td></tr>" * 4 + "</tbody></table>"
    items, m = lists.parse_list(menu, SOURCE | {"list_item_selector": "tr"})
    assert not items and m["menu"] and m["menu_rate"] == 1.0
    _, m = lists.parse_list("<table><tbody><tr><td colspan='3'>등록된 글이 없습니다</td></tr></tbody></table>", SOURCE)
    assert m["empty_state"]
    noisy = '<table><tbody><tr><td><a href="/v.do?no=1">안내 조회 12</a></td><td>2024.01.01</td></tr></tbody></table>'
    items, m = lists.parse_list(noisy, SOURCE | {"list_item_selector": "tr"})
    assert not items and m["contaminated"] == 1
    posted = '<form name="f" action="/b/view.do"><input type="hidden" name="boardId" value="3"><input type="hidden" name="csrf" value="x"></form><script>function view(n) { document.f.boardId.value = n;\n}</script><ul class="notice-list"><li><a href="#" onclick="view(42)">공지 하나입니다</a> 2024-01-01</li></ul>'
    items, _ = lists.parse_list(posted, SOURCE)
    assert [x["url"] for x in items] == ["https://x.example.com/b/view.do?boardId=42"]
    _, m = lists.parse_list('<ul class="notice-list"><li><a href="#" onclick="jf_view(1)">공지 하나입니다</a> 2024-01-01</li></ul>', SOURCE)
    assert m["manual_evidence"] == 1


def test_detail():
    page = """<html><head><title>장학 공지 | 대학</title><meta property="og:title" content="장학 공지 안내문"></head><body><header>x</header>
    <div class="view-title">장학 공지 안내문</div><div class="view-content"><p>""" + "본문 문장입니다. " * 20 + """</p>
    <figure><img src="a.png" alt="그림" width="300"><figcaption>설명</figcaption></figure><img src="pixel.gif" width="1"><img srcset="s.png 1x, l.png 2x"></div></body></html>"""
    d = details.parse_detail(page, "https://x.example.com/n/1", expected="장학 공지 안내문")
    assert d["title"] == "장학 공지 안내문" and d["body_selector"] == ".view-content" and d["body_quality"] == "clean"
    assert [i["url"] for i in d["images"]] == ["https://x.example.com/n/a.png", "https://x.example.com/n/l.png"] and d["images"][0]["caption"] == "설명"
    assert details.parse_detail("<p>short</p>")["body_quality"] == "empty_or_boilerplate" and details.parse_detail(None)["title"] == ""
    assert "본문" in details.dense_text(page) and details.dense_text("") == ""


def test_dom():
    root = dom.parse("<div id=a class='x y'><p>one<p>two<br><span data-k='Ab c'>three</span></div><div><p>four")
    assert [p.text() for p in root.find("#a > p")] == ["one", "two three"] or [p.text() for p in root.find("#a > p")] == ["one", "twothree"]
    assert len(root.find("div.x.y, [data-k*='ab' i]")) == 2 and not root.find("[data-k*='ab']") and root.first("div p:first-child").text() == "one"
    assert root.find("div > span") == [] and len(root.find("div span")) == 1
    assert len(dom.parse("<div>" * 5000 + "deep").first("div").text()) == 4


def test_free_json():
    cut = documents.cut({"token": "x", "a": {"b": {"c": 1}}, "list": list(range(9)), "long": "y" * 600, "body_html": "z" * 600})
    assert cut == {"a": {"b": "[truncated]"}, "list": [0, 1, 2, 3, 4], "long": "y" * 500 + "...", "body_html": "[truncated]"}
    blocks = json.dumps([{"content": [{"text": "a"}, {"text": "b"}], "children": [{"content": [{"text": "c"}]}]}, {"content": "no"}, 5])
    assert documents.plain(blocks) == "ab\nc" and documents.plain("plain") == "plain" and documents.plain("[broken") == "[broken"


def test_draft(spark):
    raw = json.dumps({"support_types": ["등록금", "bad"], "apply_end_date": "2024-05-01T00", "qual_gpa_min": "3.5", "qual_academic_year": [1, "2", "x"], "qual_income_level_max": 12, "contact": " ", "qual_major": ["a", ""]})
    d = one(spark, documents.draft(F.lit(raw), ("등록금",), ("재학",)))
    assert d["support_types"] == ["등록금"] and d["apply_end_date"] == "2024-05-01" and d["qual_gpa_min"] == 3.5 and d["qual_academic_year"] == [1, 2]
    assert d["qual_income_level_max"] is None and d["contact"] is None and d["qual_major"] == ["a"]
    assert one(spark, documents.settings({"a": F.lit(" "), "b": F.lit("x")})) == '{"b":"x"}' and one(spark, documents.settings({"a": F.lit("")})) is None


def test_drafts_are_dealt_out(spark, sf):
    """The query ran in as many tasks as the file has splits."""
    import __spark_entry__ as entry

    found = entry.queries()["drafts"](spark, sf)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_wildcards_stay_live(spark):
    assert one(spark, A.contains_either(F.lit("abc"), F.lit("a_c"))) and not one(spark, A.contains_either(F.lit("abc"), F.lit("a_d")))
    assert one(spark, A.allows(F.array(F.lit("a")), F.lit(None).cast("string"))) is False and one(spark, A.allows(F.lit(None).cast("array<string>"), F.lit("x"))) is True


def test_decisions(spark):
    assert one(spark, D.severity(F.array(F.lit("title_changed"), F.lit("body_changed")), F.lit(True))) == "high"
    assert one(spark, D.severity(F.array(F.lit("title_changed")), F.lit(False))) == "unsafe"
    assert one(spark, D.severity(F.array(F.lit("x")), F.lit(None).cast("boolean"))) == "low"
    assert one(spark, D.valid_zero(F.lit(True), F.lit(0), F.lit(1), F.lit(3), F.lit(False))) == "empty_scholarship_board_found"
    assert one(spark, D.recommended_action(F.lit("manual_review_required"), F.lit("MANUAL_BROWSER_NETWORK_REQUIRED"))).startswith("Collect browser")
    assert one(spark, D.recommended_action(F.lit("supported"), F.lit(""))) == "Supported by current crawler path."
    none = F.lit(None).cast("string")
    blockers = one(spark, D.apply_blockers(F.lit(True), F.lit("t"), F.lit("https://a.example.com/"), none, F.lit("b" * 80), F.lit(1), none, F.array().cast("array<string>"), F.lit(True)))
    assert blockers == []
    tuned = {k: one(spark, v) for k, v in D.tuned_selectors({k: F.lit(v) for k, v in {"list_url": "https://x.example.com/list.do", "list_item_selector": "", "link_selector": "", "title_selector": "h3", "date_selector": "td"}.items()}).items()}
    assert tuned == {"list_item_selector": "tbody tr", "link_selector": "a[href]", "title_selector": "h3", "date_selector": "td:last-child, .date, .board-date, .wr_date"}
    assert one(spark, D.link_rank(F.lit("장학공지"), F.lit("https://x.example.com/board/?menu=1"), "공지|board", "제도")) == 93


def test_title_quality(spark):
    q = lambda t, raw, own: one(spark, T.title_quality(F.lit(t), F.lit(raw), F.lit(own)))
    assert [q("", "x", True), q("제목 작성일", "제목", True), q("제목", "제목" + "긴 글 " * 40, False), q("제목", "제목", True)] == ["missing", "contaminated", "contaminated", "clean"]


def test_click_handlers_of_sources():
    page = "https://x.example.com/notice/list.do?page=1&no=4"
    assert urls.from_site("cau_main", "goView( '77' )", page) == "https://x.example.com/notice/list.do?page=1&no=77"
    assert urls.from_site("EWHA_1", "return viewArticle(12);", page) == page + "&articleNo=12"
    name = "kr_ac_hanyang_bbs_web_portlet_BbsPortlet"
    assert urls.from_site("hanyang_a", "viewMessage(5, 'x')", page) == f"{page}&p_p_id={name}&p_p_lifecycle=0&p_p_state=normal&p_p_mode=view&_{name}_action=view_message&_{name}_messageId=5"
    assert urls.from_site("uos_a", "fnView('1', '23')", page) == "https://x.example.com/notice/view.do?page=1&no=4&sort=1&seq=23&identified=anonymous"
    assert urls.from_site("other", "goView(77)", page) == "" and urls.from_site("cau_main", "viewArticle(12)", page) == "" and urls.from_site(None, None, page) == ""


def test_list_links_of_a_known_source():
    from loomspark.functions.lists import parse_list

    rows = "".join(f'<tr><td><a href="#" onclick="goView({n})">2024 scholarship notice number {n}</a></td><td>2024-03-0{n}</td></tr>' for n in (1, 2, 3))
    html = f"<html><body><table><tbody>{rows}</tbody></table></body></html>"
    source = {"source_id": "cau_main", "list_url": "https://x.example.com/notice/list.do"}
    assert [x["url"] for x in parse_list(html, source)[0]] == [f"https://x.example.com/notice/list.do?no={n}" for n in (1, 2, 3)]


def test_selectors_in_their_order():
    """Every selector of the tables is one that the tree understands, and the first that matches wins."""
    from loomspark.functions import selectors as S

    for table in (S.BOARDS, S.DETAIL_TITLES, S.DETAIL_BODIES, S.EXTRACTION_BODIES, (S.MENUS, S.PAGERS, S.CONTEXTS, S.LINKS, S.LIST_TITLES, S.EMPTY_STATES, S.EXPECTED_TITLES, S.CLUTTER)):
        for selector in table:
            assert all(tests for chain in dom.compiled(selector) for _, tests in chain), selector
    page = "<div class='bbs-view'><header class='top'><h2 class='t'>First here</h2></header></div><div id='bo_v_title'>Second here</div><div class='board-view-title-wrap'><h4>Third here</h4></div>"
    assert details.titles_of(dom.parse(page))[:3] == ["First here", "Third here", "Second here"]
    box = "<div class='board-write-box'><dl><dt>x</dt><dd>Of its type</dd><dd>second</dd></dl></div><table class='tbl-list_new'><tr><td colspan='2'>Wide cell</td></tr><tr><td colspan='2'>no</td></tr></table>"
    assert details.titles_of(dom.parse(box))[:2] == ["Wide cell", "Of its type"]
    assert dom.parse("<nav aria-label='Page numbers'>1</nav>").first(S.PAGERS) and not dom.parse("<a href='?PAGE=2'>2</a>").first(S.PAGERS)
    rows = "".join(f"<div style='height:85px;float:left'><a href='/view.do?no={n}'>Notice number {n}</a> 2024-01-0{n}</div>" for n in (1, 2))
    items, m = lists.parse_list(f"<div class='divbox'>{rows}</div>", SOURCE)
    assert (m["strategy"], m["n_items"]) == ("B_COMMON_BOARD", 2)
    item = "<div class='hyu-list-body-item' role='listitem'><a href='/view.do?no=7'><span class='txt_bx'><p>Inner title</p></span> more</a> 2024-01-01</div>"
    assert [x["title"] for x in lists.parse_list(item, SOURCE)[0]] == ["Inner title"]


def test_addresses_of_forms():
    page = "<form action='view.do'><input id='boardId'></form><ul class='notice-list'><li><a href='#' onclick=\"goView('42')\">Notice of a form</a> 2024-01-01</li></ul>"
    items, _ = lists.parse_list(page, SOURCE | {"list_url": "https://x.example.com/a/list.do?menu=3"})
    assert [x["url"] for x in items] == ["https://x.example.com/a/view.do?menu=3&boardId=42"]
    handler = "<script>function view(id){\n document.f.seq2.value = id; document.f.action = '/read';\n}</script><form name='f'><input name='seq2'><input type='hidden' name='k' value='v'><input type='hidden' name='csrf_token' value='no'><input name='mode'></form>"
    items, _ = lists.parse_list(handler + "<ul class='notice-list'><li><a href='javascript:view(9)'>Notice of a handler</a> 2024-01-01</li></ul>", SOURCE)
    assert [x["url"] for x in items] == ["https://x.example.com/read?k=v&seq2=9&mode=view"]
