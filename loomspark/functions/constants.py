"""Words, codes and thresholds that results depend on. Nothing here is computed."""

TITLE_BADGES = (
    "notice", "new", "공지", "공고", "안내", "알림", "필독", "중요", "학부", "대학원", "일반", "장학", "행사", "세미나",
    "행사/세미나", "채용", "홍보", "모집", "수업", "학사", "입학", "졸업",
)
TITLE_STOP_WORDS = ("notice", "공지", "공지사항", "장학", "scholarship")
MENU_TITLES = (
    "home", "login", "logout", "sitemap", "english", r"view\s*more", "more", "메인", r"메인으로\s*이동", "홈", "로그인",
    "로그아웃", "사이트맵", "전체", "전체메뉴", "바로가기", "장학안내", "이전", "다음", "목록",
)
EMPTY_CONDITIONS = (
    "제한없음", "제한 없음", "해당없음", "해당 없음", "공고 미기재", "미정", "※ 기관확인필요",
    "※ 자세한 사항은 첨부파일 또는 홈페이지 참고", "자세한 사항은 첨부파일 또는 홈페이지 참고",
)

ALWAYS_OPEN = "9999-12-31"
ALWAYS_OPEN_YEAR = 2099

SPECIAL_INFO = (
    "다문화가정", "기초생활수급자", "차상위계층", "장애인(본인)", "장애인(가정)", "농어촌자녀", "보훈대상자", "조부모가정", "다자녀",
    "한부모가정", "학생가장", "북한이탈주민", "자립준비청년", "독립유공자후손", "공상자", "산재근로자 가정", "순직자유자녀",
)
SPECIAL_INFO_LEGACY = {"새터민": ("북한이탈주민",), "장애인": ("장애인(본인)", "장애인(가정)")}

ENROLLED, FRESHMAN, GRADUATING = "재학", "신입생", "졸업예정"
COUNTS_AS_GRADUATING = ("수료", "초과이수기", "졸업예정", "졸업")
GRADUATING_YEAR = 4
ENROLLMENT_STORAGE = {
    "재학": ("재학",), "휴학": ("휴학",), "수료/졸업유예": ("수료", "졸업예정"), "신입생": ("재학",),
    "초과이수기": ("수료", "졸업예정"), "수료": ("수료", "졸업예정"), "졸업예정": ("수료", "졸업예정"), "졸업": ("수료", "졸업예정"),
}
ENROLLMENT_FEED = {
    "enrolled": "재학", "prospective": "신입생", "freshman": "신입생", "leave": "휴학", "leave_of_absence": "휴학",
    "graduate_expected": "졸업예정", "graduated": "졸업",
}
BENEFITS = (("해외연수비", "해외|유학|연수|체재"), ("등록금", "등록금|학비"), ("생활비", "생활|체재"), ("연구비", "연구"), ("학업장려금", "학업|장려"))
OTHER_BENEFIT = "기타"

# A department's field: the first code one of whose words its name holds.
FIELD_RULES = {
    "교육": (
        "교육", "사범", "유아교육", "특수교육",
    ),
    "의약": (
        "의예", "의학", "의과", "치의", "치과", "한의", "간호", "약학", "제약", "보건", "수의", "재활", "물리치료", "작업치료", "임상", "치위생", "응급구조", "방사선", "의료", "한약", "바이오헬스",
    ),
    "예체능": (
        "음악", "미술", "디자인", "체육", "무용", "연극", "영화", "공연", "예술", "조소", "회화", "판화", "도예", "성악", "작곡", "기악", "국악", "관현악", "스포츠", "패션", "사진", "애니메이션", "만화", "뷰티",
        "실용음악", "조형", "공예", "연기", "모델", "영상디자인", "귀금속", "주얼리", "콘텐츠",
    ),
    "공학": (
        "공학", "컴퓨터", "소프트웨어", "전자", "전기", "기계", "건축", "토목", "신소재", "재료", "화공", "반도체", "항공", "조선", "자동차", "로봇", "정보통신", "데이터사이언스", "인공지능", "정보시스템", "시스템경영",
        "에너지", "금속", "세라믹", "섬유공학", "환경공", "도시공", "교통", "메카트로닉스", "융합전공", "스마트", "보안", "정보보호", "빅데이터", "게임", "IT", "ICT", "공과", "데이터과학", "배터리", "AI융합",
        "원자력", "디스플레이", "모빌리티", "디지털", "통신", "네트워크", "풀스택", "인프라", "정보대학",
    ),
    "자연": (
        "수학", "물리", "화학", "생물", "생명", "지구", "천문", "통계", "대기", "해양", "식품", "영양", "원예", "농", "축산", "임학", "산림", "자연", "지질", "환경", "의류", "주거", "소비자", "아동가족",
        "생활과학", "이과", "응용과학", "우주", "조경", "바이오", "인지과학", "뇌",
    ),
    "사회": (
        "경영", "경제", "무역", "회계", "금융", "세무", "법", "행정", "정치", "외교", "사회", "심리", "언론", "미디어", "광고", "홍보", "관광", "호텔", "부동산", "물류", "국제", "글로벌", "복지", "문헌정보",
        "커뮤니케이션", "지리", "군사", "경찰", "소방", "항공서비스", "비서", "조리", "외식", "도시행정", "정책", "정경", "상경", "창업", "비즈니스", "범죄",
    ),
    "인문": (
        "국어국문", "영어영문", "문학", "사학", "역사", "철학", "신학", "종교", "언어", "일어", "일본", "중어", "중국", "불어", "프랑스", "독어", "독일", "노어", "러시아", "서반아", "스페인", "아랍", "한문",
        "문예", "인문", "영문", "국문", "문화", "번역", "통역", "고고", "민속", "문과", "신과", "외국어", "어문", "한국어", "동양학", "불교",
    ),
}

STAGES = (
    "list_fetch", "list_decode", "list_parse", "notice_url_resolution", "pagination_check", "detail_fetch",
    "detail_content_extract", "candidate_filter", "final_result",
)
UNSAFE_RUNS = ("degraded", "blocked", "selector_mismatch", "network_failed", "pagination_incomplete", "unsafe_for_lifecycle_judgment")
UNSAFE_CHANGES = ("body_quality_degraded", "source_health_unsafe", "blocked_by_schema")
HIGH_CHANGES = ("body_changed", "content_hash_changed", "asset_url_changed")
MEDIUM_CHANGES = ("title_changed", "published_at_changed", "canonical_url_changed", "asset_count_changed")

LIST_QUERY_KEYS = ("page", "offset", "limit", "category", "keyfield", "key", "kind", "menuid", "type")
DETAIL_HINT = r"(?i)mode=view|act=view|articleNo=|boardNo=|nttNo=|idx=\d+|no=\d+|wr_id=\d+|b_idx=\d+|seq=\d+|artclView\.do|uid=\d+|mod=document|/\d{4,}(?:[/?#]|$)"
LIST_PATH = r"(?i)/(?:notice|notices|board|boards|list|lists|community|news|scholarship|scholarships)(?:/|\.do|\.php|\.asp|\.jsp)?$"
MENU_REJECT = r"(?i)(?:^|\s)(?:장학(?:금)?\s*(?:안내|지원|제도|FAQ)?|장학게시판|장학안내|장학공지|장학지원)\s*$|Scholarship\s*/?\s*Job|ScholarshipScholarship"

SHORT_BODY = 80
DAILY_DROP_RATIO, SUCCESS_DROP, QUALITY_DAYS, ERROR_STREAK, HEALTH_DAYS = 0.5, 0.2, 7, 3, 7

# Patterns of titles. They mean the same to Java and to Python: word edges are look-arounds over ASCII.
DAY = r"\d{4}[./-]\d{1,2}[./-]\d{1,2}"
LIST_TITLE_TRIMS = (
    r"(?i)^(?:\d{4}[./-]\d{1,2}[./-]\d{1,2}\s+)?(?:undergraduate|graduate)\s+",
    r"^(?:행사|공지|학사|장학)?\s*새\s*글\s+",
    r"(?i)\s+attach[_ ]?file$",
    r"(?i)\s+(?:hits?|views?)\s*\d+\s*(?:updated)?$",
    r"(?i)\s+new\s+\d{4}[./-]\d{1,2}[./-]\d{1,2}$",
)
TITLE_LAYERS = (
    r"^\d+[.)]\s*",
    r"(?i)^(?:new|n|신규)\s+",
    r"(?i)^(?:all|공통|국제|서울)\s+",
    r"(?i)^(?:제목|subject|title)\s*[:：]\s*",
    r"(?i)^\[[^\]]*(?:notice|공지|일반공지|장학|학사|학부)[^\]]*\]\s*",
    r"(?i)^(?:notice|공지|일반공지|장학공지|학사공지)\s+",
)
TITLE_SEGMENT = r"\s*(?:\||>|::| - | – | — )\s*"
TITLE_NOISE = r"(?i)(?<![A-Za-z0-9_])(?:views?|hits?|writer|author|created|updated|period|department)(?![A-Za-z0-9_])|조회\s*\d+|작성일|등록일|담당부서"
TITLE_DATE_RANGE = r"\d{4}[./-]\d{1,2}[./-]\d{1,2}\s*[~～-]"
TITLE_MENU = rf"(?i)^(?:{'|'.join(MENU_TITLES)})$"
LONG_TITLE, RAW_BEYOND_TITLE = 160, 60

# What may stand around a title without making it another one.
TITLE_SUFFIX = r"(?i)^(?:(?:대학원|학부|일반|공지|새 글|new|hit|views?|조회수?)\s*\d*\s*)+$"
BEFORE_LIST_TITLE = r"(?i)^(?:(?:\d{2,4}\s+){1,3}|undergraduate|graduate|대학원|학부|학사|행사|새 글|공지|일반공지|치과대학|대학\s*)+$"
AFTER_LIST_TITLE = r"(?i)^(?:안내|attach file|new|updated|hit|views?|조회수?|작성일|\d{1,4}\s*)+$"
BEFORE_DETAIL_TITLE = r"^(?:공지|일반공지|학사|학부|대학원)$"
AFTER_DETAIL_TITLE = r"(?i)^(?:updated|new|hit\s*\d*|views?\s*\d*)$"

# Offers' names: what is cut out of them, in this order.
OFFER_NAME_CUTS = (
    r"[12]\s*학기|(?:19|20)\d{2}\s*[-.]\s*[12]\s*학기?",
    r"(?:19|20)\d{2}\s*(?:년(?:도)?|학년도)?",
    r"[\[(（]\s*[\])）]",
    r"\s*[-–—|·,/]\s*$",
)
