"""Where pages keep lists, menus, titles, dates and bodies, in the order in which they are tried."""

BOARDS = (
    "table tbody tr",
    ".board-list-wrap > li",
    ".board-list li, .board_list li, .bbs-list li, .bbs_list li",
    ".notice-list li, .notice_list li, .noti-list li",
    ".board-item, .board_item, .notice-item, .notice_item",
    ".hyu-list-body-item[role='listitem']",
    ".tb-body > ul.clearfix",
    ".divbox div[style*='height:85px']",
    "article.post, article.notice, article.board-item",
)
MENUS = "header, nav, footer, aside, .gnb, .lnb, .snb, .navbar, .navigation, .menu, .breadcrumb, .quick-menu, .footer, .header"
PAGERS = ".pagination, .paging, .paginate, .page-navigation, nav[aria-label*='page' i], a[href*='page='], a[href*='pageNo='], a[href*='pageIndex=']"
CONTEXTS = "tr, li, article, .board-item, .board_item, .notice-item, .notice_item, .post-item, .post_item, .list-item, .list_item, .hyu-list-body-item[role='listitem']"
LINKS = "a[href], a[onclick], a[data-href], a[data-url], a[data-link]"
LIST_TITLES = (
    ".b-title, .board-title, .board_title, .bo_tit, .wr_subject, .list-title, .list_subject, .subject, .article-title, .post-title, .txtTitle, .txt_bx p, "
    ".tit_g .tit, .title.notice strong, .tit, h2, h3, h4"
)
DATES = (".date", ".board-date", ".regdate", ".write-date", ".created", ".time", "time", "td:last-child")
EMPTY_STATES = ".no-data_bbs, .no-data, .nodata, .no_data, .empty-list, .empty_list, table tbody td[colspan], [class*='no-result']"
KEYWORDS = ("장학", "장학금", "학자금", "등록금", "scholarship", "tuition", "financial aid", "fellowship", "grant")

DETAIL_TITLES = (
    ".bbs-view > header.top h2.t",
    ".bbs-view header.top h2.t",
    ".board-view-title-wrap h4",
    ".board-view-title-wrap h3",
    "#bo_v_title",
    "#em_title1",
    ".em_a_wrap_tit",
    ".bbs_view .tit em",
    ".bbs_view .tit strong",
    ".hyu-list-body-item h4",
    "table.tbl-list_new tr:first-child td[colspan]",
    ".board-view-heading .board-view-tit",
    ".board-view-tit",
    ".board-write-wrap .board-write-box dd:first-of-type",
    ".board-write-box dd:first-of-type",
    ".b-top-box .b-title",
    ".b-title",
    ".board_view .v_tit > strong",
    ".board_view .tit",
    ".artclViewTitle",
    ".artcl-view-title",
    ".article-title",
    ".board-view-title",
    ".board_view_title",
    ".view-title",
    ".view_title",
    ".board-title",
    ".board_title",
    ".bbs-title",
    ".subject",
    ".heading",
    ".text_wrap-title",
    "td .txt",
)
EXPECTED_TITLES = (
    "h1, h2, h3, h4, h5, h6, [class*='title' i], [class*='subject' i], [class*='tit' i], [id*='title' i], [id*='subject' i], [id*='tit' i], "
    "table td, table th, dt, dd, strong, p"
)
DETAIL_BODIES = (
    "article",
    "main article",
    "#DivContents",
    ".article-text",
    "#bo_v_con",
    ".board_view .v_con",
    ".board-view-box .fr-view",
    ".board-write-wrap .fr-view",
    ".artclView",
    ".artcl-view",
    ".board-view .content",
    ".board-view .view-content",
    ".view-content",
    ".view_cont",
    ".view-con",
    ".bbs_view",
    ".board_view",
    ".article-body",
    ".article-content",
    ".entry-content",
    ".post-content",
    ".bo_v_con",
    ".text_wrap",
    ".view_text",
    ".view-body",
    ".board-view-content",
    ".board_view_con",
    ".bbs-view-content",
    ".fr-view",
    ".xe_content",
    "#bbs_content",
    "#board_content",
    "#content .content",
    ".content",
    "main",
)
EXTRACTION_BODIES = (
    "article",
    "main",
    "#content",
    "#contents",
    "#bbs_content",
    ".content",
    ".contents",
    ".conts",
    ".board-view",
    ".board-view-content",
    ".board-content",
    ".board_view",
    ".board_view_con",
    ".view-content",
    ".view_cont",
    ".view-con",
    ".article-content",
    ".article_view",
    ".entry-content",
    ".post-content",
    ".fr-view",
    ".xe_content",
    ".bo_v_con",
    ".tbl_view",
)
#: Elements that are no part of any text.
CLUTTER = "script, style, nav, footer, header, aside, noscript"
#: Bodies that may hold the page's layout as well.
WIDE_BODIES = ("body", "main", ".content")

# Words that speak for a notice's text and for a menu.
BODY_WORDS = ("장학", "신청", "지원", "마감", "선발", "제출", "자격", "대상", "기간", "서류")
MENU_WORDS = ("사이트맵", "로그인", "검색", "메뉴", "학과소개", "공지사항", "전체공지", "rss")
SENTENCE_END = r"[.!?\n]|다\.|요\.|니다\."

# Fields that identify a notice in a form, and names of the field that says how to show it.
ID_FIELDS = ("boardId", "board_id", "articleId", "article_id", "postId", "post_id", "p_idx", "idx", "articleNo", "boardNo", "nttNo", "wr_id", "b_idx", "seq", "uid", "no")
MODE_FIELDS = ("p_mode", "mode")

# Attributes and addresses that look like a board's or a notice's.
BOARD_META = r"(?i)board|bbs|notice|noti|article|post|subject|title|list|view|wr_|bo_"
DETAIL_HREF = r"(?i)view|article|board|bbs|notice|post|read|detail|(?:mode|act|action)=view|articleNo=|boardNo=|nttNo=|idx=|no=\d+|wr_id=|b_idx=|seq=|uid="
DETAIL_CALL = r"(?i)\b(?:view|goView|jf_view|detail|read)\s*\("
MANUAL_CALL = r"(?i)\b(?:jf_view|view|goView|open|detail)\s*\("
FORM_CALL = r"(?i)\b(view|goView|detail|read)\s*\(\s*['\"]?(\d+)['\"]?"
EMPTY_TEXT = r"(?i)(?:데이터|게시물|공지|검색\s*결과|등록된\s*글).{0,15}(?:없습니다|없음)|no\s+(?:data|posts?|notices?|results?)"
TITLE_LABEL = r"(?i)^(?:제목|subject|title)$"
BOARD_READ = r"(?i)(?:게시판\s*읽기|board\s*(?:view|read))\s*\(\s*(.+?)\s*\)\s*(?:\||$)"
TITLE_PARTS = r"\s*(?:\||::| - | – | — )\s*"
DAY_PATTERNS = (
    r"(\d{4})\s*[./-]\s*(\d{1,2})\s*[./-]\s*(\d{1,2})",
    r"(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일",
    r"(\d{2})\s*[./-]\s*(\d{1,2})\s*[./-]\s*(\d{1,2})",
)
DAY_LIKE = r"\d{2,4}\s*[./-]\s*\d{1,2}\s*[./-]\s*\d{1,2}"
NO_IMAGE = r"(?i)spacer|tracking|pixel|blank\.gif"
