"""Rules on single values as queries: inputs are made of the driver tables' own columns, and the SQL recomputes each rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import dates as DT
from ..functions import decisions as D
from ..functions import documents as J
from ..functions import text as T
from ..functions import urls as U
from ..operators import compare as C
from .registry import query, read


def said(key: str, *options: str) -> Column:
    """One of the texts, chosen by the key."""
    return F.get(F.array(*map(F.lit, options)), (F.col(key) % len(options)).cast("int"))


def said_sql(key: str, *options: str) -> str:
    listed = ", ".join("'" + x.replace("'", "''") + "'" for x in options)
    return f"([{listed}])[CAST({key} % {len(options)} AS INTEGER) + 1]"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").withColumn("id", F.col("p_partkey"))


CLEAN = r"trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g'))"

HEADS = ("", "2024-03-01 Undergraduate ", "graduate  ", "공지 새 글 ", "새글 ", "Undergraduates ")
TAILS = ("", " attach_file", " Views 12", " hit 3 updated", " new 2024.1.5", " new", " viewsx")
LISTED = f"concat({said_sql('p_partkey', *HEADS)}, p_name, '  ', p_brand, {said_sql('p_partkey // 7', *TAILS)})"
TRIMMED_SQL = (
    rf"regexp_replace(regexp_replace(regexp_replace({CLEAN.format('raw')}, '^(?:\d{{4}}[./-]\d{{1,2}}[./-]\d{{1,2}}\s+)?(?:undergraduate|graduate)\s+', '', 'i'), '^(?:행사|공지|학사|장학)?\s*새\s*글\s+', ''), '\s+attach[_ ]?file$', '', 'i')"
)


@query(
    rf"""WITH l AS (SELECT p_partkey AS id, {LISTED} AS raw FROM part)
SELECT id, trim(regexp_replace(regexp_replace({TRIMMED_SQL}, '\s+(?:hits?|views?)\s*\d+\s*(?:updated)?$', '', 'i'), '\s+new\s+\d{{4}}[./-]\d{{1,2}}[./-]\d{{1,2}}$', '', 'i')) AS title FROM l"""
)
def list_titles(spark, sf_dir):
    raw = F.concat(said("id", *HEADS), "p_name", F.lit("  "), "p_brand", F.get(F.array(*map(F.lit, TAILS)), F.expr(f"CAST(id DIV 7 % {len(TAILS)} AS INT)")))
    return parts(spark, sf_dir).select("id", T.list_title(raw).alias("title"))


MARKS = ("[공지]", "[Notice ]", "[ ]", "[장학]", "[Room 7]", "", "공지 scholarship")


@query(
    rf"""WITH t AS (SELECT p_partkey AS id, lower({CLEAN.format(f"concat({said_sql('p_partkey', *MARKS)}, ' ', p_name, ' - Scholarship ', p_brand)")}) AS t FROM part),
b AS (SELECT id, regexp_replace(t, '\[\s*(?:notice|new|공지|공고|안내|알림|필독|중요|학부|대학원|일반|장학|행사|세미나|행사/세미나|채용|홍보|모집|수업|학사|입학|졸업)?\s*\]', ' ', 'g') AS t FROM t),
w AS (SELECT id, list_filter(regexp_split_to_array(regexp_replace(t, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x NOT IN ('', 'notice', 'scholarship')) AS w FROM b)
SELECT id, array_to_string(w, ' ') AS title FROM w"""
)
def identity_titles(spark, sf_dir):
    return parts(spark, sf_dir).select("id", T.identity_title(F.concat(said("id", *MARKS), F.lit(" "), "p_name", F.lit(" - Scholarship "), "p_brand")).alias("title"))


LAYERED = ("1. New ", "[장학공지] 제목: ", "공지 ", "all new Subject : ", "", "3) 2) 1) ", "news ")


def layers_sql(x: str, passes: int) -> str:
    rules = (r"^\d+[.)]\s*", r"^(?:new|n|신규)\s+", r"^(?:all|공통|국제|서울)\s+", r"^(?:제목|subject|title)\s*[:：]\s*", r"^\[[^\]]*(?:notice|공지|일반공지|장학|학사|학부)[^\]]*\]\s*", r"^(?:notice|공지|일반공지|장학공지|학사공지)\s+")
    for _ in range(passes):
        for r in rules:
            x = f"regexp_replace({x}, '{r}', '', 'i')"
        x = f"trim({x})"
    return x


@query(
    rf"""WITH t AS (SELECT p_partkey AS id, concat({said_sql('p_partkey', *LAYERED)}, p_name, {said_sql('p_partkey // 7', ' | ', ' > ', ' - ', ':: ', ' ')}, p_brand) AS raw FROM part), c AS (SELECT id, {CLEAN.format("raw")} AS t FROM t),
one AS (SELECT id, t, {layers_sql("t", 1)} AS x FROM c), two AS (SELECT id, t, {layers_sql("x", 1)} AS x FROM one), three AS (SELECT id, t, {layers_sql("x", 1)} AS x FROM two)
SELECT id, {layers_sql("x", 1)} AS bare, regexp_split_to_array(t, '\s*(?:\||>|::| - | – | — )\s*')[1] AS first FROM three"""
)
def stripped_titles(spark, sf_dir):
    sep = F.get(F.array(*map(F.lit, (" | ", " > ", " - ", ":: ", " "))), F.expr("CAST(id DIV 7 % 5 AS INT)"))
    raw = F.concat(said("id", *LAYERED), "p_name", sep, "p_brand")
    return parts(spark, sf_dir).select("id", T.strip_prefixes(raw).alias("bare"), T.first_segment(raw).alias("first"))


UNITS = ("과", "부", "전공", " 대 학", "스쿨", "", "학과(야간)", "계열/자율")


@query(
    rf"""WITH u AS (SELECT p_partkey AS id, {CLEAN.format(f"concat(p_name, ' ', {said_sql('p_partkey', *UNITS)})")} AS n FROM part)
SELECT id, regexp_replace(regexp_replace(regexp_replace(n, '\s+', '', 'g'), '(?:전공|스쿨|계열|대학)$', ''), '[과부]$', '') AS stem,
  array_to_string(list_concat([n], CASE WHEN regexp_matches(n, '^.+?\([^)]+\)$') THEN [{CLEAN.format("regexp_extract(n, '^(.+?)\\(([^)]+)\\)$', 2)")}, {CLEAN.format("regexp_extract(n, '^(.+?)\\(([^)]+)\\)$', 1)")}] ELSE [] END,
    CASE WHEN contains(n, '/') THEN list_filter(list_transform(string_split(n, '/'), lambda x: trim(x)), lambda x: x <> '') ELSE [] END), ';') AS variants FROM u"""
)
def unit_stems(spark, sf_dir):
    n = F.concat("p_name", F.lit(" "), said("id", *UNITS))
    return parts(spark, sf_dir).select("id", T.name_stem(n).alias("stem"), F.array_join(T.name_variants(n), ";").alias("variants"))


@query(
    rf"""WITH s AS (SELECT s_suppkey AS id, concat({said_sql('s_suppkey', 'Seoul Univ  ', 'SU Seoul Univ ', 'SU', '')}, {said_sql('s_suppkey // 2', 'Law', 'Law (중앙)', '장학공지', 'Physics 합쳐진 듯 x')}, {said_sql('s_suppkey // 4', '', '(중앙)', ' ')}) AS n FROM supplier),
a AS (SELECT id, {CLEAN.format(r"regexp_replace(regexp_replace(n, '^Seoul Univ\s*', ''), '^SU\s*', '')")} AS plain, {CLEAN.format(r"regexp_replace(regexp_replace(" + CLEAN.format("n") + r", '^Seoul Univ\s*', ''), '^SU\s*', '')")} AS tidy FROM s),
d AS (SELECT id, plain, trim(regexp_replace(regexp_replace(tidy, '\(중앙\)', '', 'g'), '\s*합쳐진\s*듯.*$', '')) AS d FROM a)
SELECT id, plain, CASE WHEN d <> '' AND NOT regexp_matches(d, '장학공지|중앙') THEN d END AS department FROM d"""
)
def source_departments(spark, sf_dir):
    at = lambda step, *xs: F.get(F.array(*map(F.lit, xs)), F.expr(f"CAST(s_suppkey DIV {step} % {len(xs)} AS INT)"))
    n = F.concat(at(1, "Seoul Univ  ", "SU Seoul Univ ", "SU", ""), at(2, "Law", "Law (중앙)", "장학공지", "Physics 합쳐진 듯 x"), at(4, "", "(중앙)", " "))
    names = ["Seoul Univ", "SU"]
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), T.without_aliases(n, names).alias("plain"), T.department_of(n, names).alias("department"))


@query(
    rf"""WITH c AS (SELECT p_partkey AS id, concat('○ ', p_name, {said_sql('p_partkey', ' / ', ' ○ ', ' / [제한사항] ')}, p_brand, {said_sql('p_partkey // 3', ' / ' , ' / 해당없음 / ', ' ○ ')}, p_name) AS raw FROM part),
p AS (SELECT id, regexp_replace(replace(regexp_replace(raw, ' / \[제한(?:사항)?\]', chr(10) || '[제한] ', 'g'), ' / ', chr(10)), '○\s*', chr(10), 'g') AS v FROM c),
e AS (SELECT id, list_filter(list_transform(string_split(v, chr(10)), lambda x: regexp_replace({CLEAN.format("x")}, '^[\s/,;·]+|[\s/,;·]+$', '', 'g')), lambda x: x NOT IN ('', '해당없음')) AS v FROM p)
SELECT id, array_to_string(list_filter(v, lambda x, i: list_position(v, x) = i), ';') AS pieces FROM e"""
)
def condition_texts(spark, sf_dir):
    at = lambda step, *xs: F.get(F.array(*map(F.lit, xs)), F.expr(f"CAST(id DIV {step} % {len(xs)} AS INT)"))
    raw = F.concat(F.lit("○ "), "p_name", at(1, " / ", " ○ ", " / [제한사항] "), "p_brand", at(3, " / ", " / 해당없음 / ", " ○ "), "p_name")
    return parts(spark, sf_dir).select("id", F.array_join(T.condition_pieces(raw), ";").alias("pieces"))


@query(
    rf"""WITH r AS (SELECT p_partkey AS id, concat(p_type, ' ,, ', p_name, {said_sql('p_partkey', ',', '', ' , ')}) AS l, {said_sql('p_partkey', 'Yes', ' on', '0', 'N', '', 'maybe', 'TRUE ')} AS f, p_size AS n FROM part)
SELECT id, array_to_string(list_filter(list_transform(string_split(l, ','), lambda x: trim(x)), lambda x: x <> ''), ';') AS parts,
  CASE WHEN lower(trim(f)) IN ('1', 'true', 'yes', 'y', 'on') THEN true WHEN lower(trim(f)) IN ('0', 'false', 'no', 'n', 'off') THEN false ELSE n % 2 = 0 END AS flag FROM r"""
)
def split_values(spark, sf_dir):
    raw = F.concat("p_type", F.lit(" ,, "), "p_name", said("id", ",", "", " , "))
    own = said("id", "Yes", " on", "0", "N", "", "maybe", "TRUE ")
    flag = F.when(F.col("p_size") % 2 == 0, T.flag(own, True)).otherwise(T.flag(own, False))
    return parts(spark, sf_dir).select("id", F.array_join(T.split_list(raw), ";").alias("parts"), flag.alias("flag"))


@query(
    rf"""WITH t AS (SELECT p_partkey AS id, concat(p_name, {said_sql('p_partkey', '', ' views 3', ' 조회 12', ' 2024.1.1 ~', ' 작성일')}) AS t, p_size AS n FROM part), x AS (SELECT id, CASE WHEN n % 10 = 0 THEN '' ELSE t END AS t, repeat('ab ', n * 2) AS r, n % 3 = 0 AS own FROM t)
SELECT id, CASE WHEN t = '' THEN 'missing' WHEN regexp_matches(t, '\bviews?\b|조회\s*\d+|작성일', 'i') OR (NOT own AND regexp_matches(t, '\d{{4}}[./-]\d{{1,2}}[./-]\d{{1,2}}\s*[~～-]')) OR (NOT own AND length(trim(r)) > length(t) + 60) THEN 'contaminated' ELSE 'clean' END AS quality FROM x"""
)
def title_qualities(spark, sf_dir):
    n = F.col("p_size")
    title = F.when(n % 10 == 0, "").otherwise(F.concat("p_name", said("id", "", " views 3", " 조회 12", " 2024.1.1 ~", " 작성일")))
    return parts(spark, sf_dir).select("id", T.title_quality(title, F.expr("repeat('ab ', p_size * 2)"), n % 3 == 0).alias("quality"))


@query(
    rf"""WITH o AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d, o_orderkey % 5 AS k FROM orders),
v AS (SELECT id, d, CASE WHEN k = 0 THEN NULL ELSE d END AS a, CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN DATE '9999-12-31' ELSE d + 30 END AS e, concat({said_sql('id', '', ' ', 'x')}, strftime(d, '%Y-%m-%d'), 'T00:00') AS raw FROM o)
SELECT id, CASE WHEN regexp_matches(substr(trim(raw), 1, 10), '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN substr(trim(raw), 1, 10) END AS head,
  CASE WHEN year(e) >= 2099 THEN '상시모집' ELSE concat(coalesce(strftime(a, '%Y/%m/%d'), '—'), ' ~ ', coalesce(strftime(e, '%Y/%m/%d'), '—')) END AS period FROM v"""
)
def periods(spark, sf_dir):
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 5
    end = F.when(k == 1, None).when(k == 2, F.lit("9999-12-31").cast("date")).otherwise(F.date_add(day, 30))
    head = DT.iso_head(F.concat(said("o_orderkey", "", " ", "x"), day.cast("string"), F.lit("T00:00")))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), head.alias("head"), DT.period(F.when(k != 0, day), end).alias("period"))


@query("""WITH n AS (SELECT event_id, ts, lag(ts, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT event_id, greatest(epoch_us(ts) // 1000 - epoch_us(before) // 1000, 0) AS forward, greatest(epoch_us(before) // 1000 - epoch_us(ts) // 1000, 0) AS backward FROM n WHERE before IS NOT NULL""")
def elapsed(spark, sf_dir):
    from pyspark.sql import Window

    before = F.lag("ts", 2).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = read(spark, sf_dir, "events").withColumn("before", before).where(F.col("before").isNotNull())
    return rows.select("event_id", DT.elapsed_ms(F.col("before"), F.col("ts")).alias("forward"), DT.elapsed_ms(F.col("ts"), F.col("before")).alias("backward"))


@query(
    rf"""WITH v AS (SELECT p_partkey AS id, concat({said_sql('p_partkey', '', ' ', '1,')}, CAST(p_size - 5 AS VARCHAR), {said_sql('p_partkey // 3', '', '.9', '원')}) AS raw, [p_brand, ' ', p_type, concat(p_brand, ' '), ''] AS a, CASE WHEN p_size % 4 = 0 THEN ['  ', ''] END AS b FROM part),
l AS (SELECT *, floor(TRY_CAST(regexp_replace(raw, '[,\s원]', '', 'g') AS DOUBLE)) AS n, list_filter(list_transform(a, lambda x: trim(x)), lambda x: x <> '') AS t FROM v)
SELECT id, CASE WHEN n BETWEEN 0 AND 10 THEN CAST(n AS INTEGER) ELSE -1 END AS level, array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i), ';') AS filled, b IS NOT NULL AS blank FROM l"""
)
def levels(spark, sf_dir):
    raw = F.concat(said("id", "", " ", "1,"), (F.col("p_size") - 5).cast("string"), F.get(F.array(*map(F.lit, ("", ".9", "원"))), F.expr("CAST(id DIV 3 % 3 AS INT)")))
    own = A.distinct_filled(F.array("p_brand", F.lit(" "), "p_type", F.concat("p_brand", F.lit(" ")), F.lit("")))
    none = F.when(F.col("p_size") % 4 == 0, F.array(F.lit("  "), F.lit("")))
    return parts(spark, sf_dir).select("id", F.coalesce(A.level(raw), F.lit(-1)).alias("level"), F.array_join(own, ";").alias("filled"), (none.isNotNull() & A.distinct_filled(none).isNull()).alias("blank"))


@query(
    """WITH j AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN CAST(to_json([p_name, ' ', p_brand]) AS VARCHAR) WHEN 1 THEN 'none' WHEN 2 THEN p_name WHEN 3 THEN NULL ELSE CAST(to_json([p_type, NULL, '']) AS VARCHAR) END AS j, [concat(' ', p_type), p_brand, 'PROMO'] AS a FROM part)
SELECT id, CASE id % 5 WHEN 0 THEN concat(json_extract_string(j, '$[0]'), ';', json_extract_string(j, '$[2]')) WHEN 4 THEN json_extract_string(j, '$[0]') ELSE '' END AS texts, array_to_string(list_filter(list_transform(a, lambda x: trim(x)), lambda x: x IN ('PROMO', 'ECONOMY')), ';') AS allowed FROM j"""
)
def json_lists(spark, sf_dir):
    k = F.col("id") % 5
    raw = (
        F.when(k == 0, F.to_json(F.array("p_name", F.lit(" "), "p_brand")))
        .when(k == 1, F.to_json(F.struct(F.col("p_name").alias("a"))))
        .when(k == 2, F.col("p_name"))
        .when(k == 4, F.to_json(F.array("p_type", F.lit(None), F.lit(""))))
    )
    own = A.allowed(F.array(F.concat(F.lit(" "), "p_type"), "p_brand", F.lit("PROMO")), ("PROMO", "ECONOMY"))
    return parts(spark, sf_dir).select("id", F.array_join(A.json_texts(raw), ";").alias("texts"), F.array_join(own, ";").alias("allowed"))


@query(
    """SELECT p_partkey AS id, CASE WHEN p_size % 6 = 0 THEN NULL ELSE concat('{', array_to_string(list_filter([CASE WHEN p_size % 2 > 0 THEN concat('"row":"', p_name, '"') END, CASE WHEN p_size % 3 > 0 THEN concat('"date":"', p_brand, '"') END], lambda x: x IS NOT NULL), ','), '}') END AS settings FROM part"""
)
def parser_settings(spark, sf_dir):
    n = F.col("p_size")
    own = J.settings({"row": F.when(n % 2 > 0, F.col("p_name")).otherwise("  "), "date": F.when(n % 3 > 0, F.col("p_brand")), "none": F.lit("")})
    return parts(spark, sf_dir).select("id", own.alias("settings"))


@query(
    """SELECT p_partkey AS id, concat('{"name":"', p_name, '","list":[', array_to_string(list_transform(range(least(p_size, 5)), lambda x: CAST(x AS VARCHAR)), ','), '],"deep":{"one":"[truncated]"},"html":', CASE WHEN (length(p_name) + 1) * p_size - 1 > 500 THEN '"[truncated]"' ELSE concat('"', repeat(concat(p_name, ' '), p_size), '"') END,
  ',"long":"', substr(repeat(p_brand, p_size), 1, 500), CASE WHEN length(p_brand) * p_size > 500 THEN '...' ELSE '' END, '"}') AS cut FROM part"""
)
def cut_metadata(spark, sf_dir):
    deep = F.struct(F.struct(F.col("p_size").alias("two")).alias("one"), F.col("p_brand").alias("api_token"))
    whole = F.struct(
        F.col("p_name").alias("name"), F.expr("CASE WHEN p_size > 0 THEN sequence(0, p_size - 1) ELSE array() END").alias("list"), deep.alias("deep"), F.lit("x").alias("password"),
        F.expr("repeat(concat(p_name, ' '), p_size)").alias("html"), F.expr("repeat(p_brand, p_size)").alias("long"),
    )
    return parts(spark, sf_dir).select("id", J.cut_json(F.to_json(whole)).alias("cut"))


@query(
    """SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN concat(p_name, ' ', p_brand, chr(10), p_type, CASE WHEN p_size % 2 = 0 THEN concat(chr(10), p_brand) ELSE '' END) WHEN 1 THEN trim(concat(' ', p_name, ' ')) ELSE '' END AS text FROM part"""
)
def block_texts(spark, sf_dir):
    run = lambda *xs: F.array(*(F.struct(F.lit("text").alias("type"), F.col(x).alias("text")) for x in xs))
    child = F.when(F.col("p_size") % 2 == 0, F.array(F.struct(run("p_brand").alias("content"))))
    gap = F.struct(F.lit("text").alias("type"), F.lit(" ").alias("text"))
    first = F.struct(F.array(F.struct(F.lit("text").alias("type"), F.col("p_name").alias("text")), gap, F.struct(F.lit("text").alias("type"), F.col("p_brand").alias("text"))).alias("content"), F.lit(None).cast("array<struct<content:array<struct<type:string,text:string>>>>").alias("children"))
    second = F.struct(run("p_type").alias("content"), child.alias("children"))
    raw = F.when(F.col("id") % 3 == 0, F.to_json(F.array(first, second))).when(F.col("id") % 3 == 1, F.concat(F.lit(" "), "p_name", F.lit(" "))).otherwise(F.to_json(F.struct("p_name")))
    return parts(spark, sf_dir).select("id", J.plain_text(raw).alias("text"))


@query(
    """SELECT p_partkey AS id, p_name AS amount, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN p_type ELSE '' END AS kinds, CASE WHEN p_size % 2 = 0 THEN '2024-05-01' END AS day, CAST(p_size AS DOUBLE) AS chosen, CASE WHEN p_size - 1 <= 10 THEN CAST(p_size - 1 AS INTEGER) ELSE -1 END AS lowest, concat(p_brand, ';', p_name) AS majors, CAST(NULL AS VARCHAR) AS note FROM part"""
)
def drafts(spark, sf_dir):
    raw = F.to_json(
        F.struct(
            F.concat(F.lit(" "), "p_name").alias("support_amount_text"), F.array("p_type").alias("support_types"), F.when(F.col("p_size") % 2 == 0, "2024-05-01T09:00").otherwise("May 1").alias("apply_start_date"), F.col("p_size").alias("selection_count"),
            (F.col("p_size") - 1).alias("qual_income_level_min"), F.array("p_brand", F.lit(" "), "p_name").alias("qual_major"), F.lit("  ").alias("note"),
        )
    )
    # the text is a column of its own, as every field of the draft reads it; the table is small for the work that a row takes,
    # so its few splits are dealt out over all cores
    d = parts(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).select("id", raw.alias("raw")).select("id", J.draft(F.col("raw"), ("ECONOMY", "PROMO"), ("재학",)).alias("d"))
    join = lambda c: F.array_join(F.col(f"d.{c}"), ";")
    return d.select("id", F.col("d.support_amount_text").alias("amount"), join("support_types").alias("kinds"), F.col("d.apply_start_date").alias("day"), F.col("d.selection_count").alias("chosen"), F.coalesce("d.qual_income_level_min", F.lit(-1)).alias("lowest"), join("qual_major").alias("majors"), "d.note")


@query(
    rf"""WITH u AS (SELECT p_partkey AS id, concat({said_sql('p_partkey', '[a b](https://x.example.com/', ' ttps://x.example.com/', 'http://x.example.com/', 'ttp://x.example.com/')}, p_partkey, CASE WHEN p_partkey % 4 = 0 THEN ') more' ELSE '' END) AS raw,
  concat('https://x.example.com/list.do?', {said_sql('p_partkey // 4', 'category=', 'searchType=', 'page=', 'cate=1&no=')}, p_size) AS filtered FROM part)
SELECT id, CASE WHEN raw LIKE '[%' THEN regexp_extract(raw, '\((https?://[^)\s]+)\)', 1) ELSE regexp_replace(trim(raw), '^ttps?://', 'https://') END AS url, regexp_matches(filtered, '[?&](category|searchType|cate)=') AND NOT regexp_matches(filtered, '[?&]no=\d') AS category FROM u"""
)
def imported_urls(spark, sf_dir):
    raw = F.concat(said("id", "[a b](https://x.example.com/", " ttps://x.example.com/", "http://x.example.com/", "ttp://x.example.com/"), F.col("id").cast("string"), F.when(F.col("id") % 4 == 0, ") more").otherwise(""))
    filtered = F.concat(F.lit("https://x.example.com/list.do?"), F.get(F.array(*map(F.lit, ("category=", "searchType=", "page=", "cate=1&no="))), F.expr("CAST(id DIV 4 % 4 AS INT)")), F.col("p_size").cast("string"))
    return parts(spark, sf_dir).select("id", U.imported(raw).alias("url"), U.same_page_category(filtered, F.lit("https://x.example.com/list.do")).alias("category"))


@query(
    rf"""WITH c AS (SELECT p_partkey AS id, p_partkey % 5 AS k, p_partkey AS n FROM part)
SELECT id, CASE k WHEN 0 THEN concat('https://y.example.com/v?', n) WHEN 1 THEN concat('https://x.example.com/n/view/', n) WHEN 2 THEN concat('https://x.example.com/n/list.do?articleNo=', n) ELSE '' END AS url FROM c"""
)
def script_urls(spark, sf_dir):
    n, k = F.col("id").cast("string"), F.col("id") % 5
    script = (
        F.when(k == 0, F.concat(F.lit("open('https://y.example.com/v?"), n, F.lit("')")))
        .when(k == 1, F.concat(F.lit('go("/n/view/'), n, F.lit('")')))
        .when(k == 2, F.concat(F.lit("f(seq='"), n, F.lit("')")))
        .when(k == 3, F.concat(F.lit("jf_view("), n, F.lit(")")))
        .otherwise("")
    )
    page = F.lit("https://x.example.com/n/list.do")
    return parts(spark, sf_dir).select("id", U.script_target(script, page, page).alias("url"))


DECISIONS = ("adapter_required", "manual_review_required", "no_posts_detected", "valid_zero_candidates", "supported")
ADVICE_SQL = "CASE d " + " ".join(f"WHEN '{k}' THEN '{D.ACTIONS[k]}'" for k in DECISIONS[:-1]) + " ELSE 'Supported by current crawler path.' END"


@query(
    f"""WITH s AS (SELECT p_partkey AS id, {said_sql('p_partkey', *DECISIONS)} AS d, p_size % 3 = 0 AS n, p_size % 4 > 0 AS ok, p_size % 5 AS boards, p_size % 7 AS empties, p_size % 2 AS links, p_size % 11 = 0 AS scoped FROM part)
SELECT id, CASE WHEN d = 'manual_review_required' AND n THEN 'Collect browser Network evidence before implementing an adapter.' ELSE {ADVICE_SQL} END AS advice,
  CASE WHEN NOT ok THEN 'needs_recheck_current_url_fetch_failed' WHEN boards > 3 THEN 'better_scholarship_board_found' WHEN empties > 4 THEN 'empty_scholarship_board_found' WHEN links > 0 THEN 'scholarship_link_seen_but_not_parseable_board' WHEN scoped THEN 'current_url_already_scholarship_scoped' ELSE 'current_notice_url_has_no_scholarship_candidates' END AS zero FROM s"""
)
def advised_actions(spark, sf_dir):
    n = F.col("p_size")
    found = lambda m, least: F.when(n % m > least, 1).otherwise(0)
    zero = D.valid_zero(n % 4 > 0, found(5, 3), found(7, 4), found(2, 0), n % 11 == 0)
    return parts(spark, sf_dir).select("id", D.recommended_action(said("id", *DECISIONS), F.when(n % 3 == 0, "MANUAL_BROWSER_NETWORK_REQUIRED")).alias("advice"), zero.alias("zero"))


@query(
    rf"""WITH l AS (SELECT p_partkey AS id, concat({said_sql('p_partkey', '장학 공지 ', 'Scholarship ', '', '안내 ')}, p_name) AS t, concat('https://x.example.com/', {said_sql('p_partkey // 4', 'notice', 'boards', 'bbs/a', 'x')}, {said_sql('p_partkey // 16', '', '?menu=1', '?x=2')}) AS u FROM part)
SELECT id, CASE WHEN regexp_matches(t, '장학\s*공지|scholarship\s*notice', 'i') THEN 40 ELSE 0 END + CASE WHEN regexp_matches(t, '장학|scholarship', 'i') THEN 20 ELSE 0 END + CASE WHEN regexp_matches(t, '공지') OR regexp_matches(u, '공지') THEN 15 ELSE 0 END
  - CASE WHEN regexp_matches(t, '안내') AND NOT regexp_matches(t, '공지') THEN 20 ELSE 0 END + CASE WHEN regexp_matches(u, '/(notice|board|bbs|article|news|list)\b', 'i') THEN 10 ELSE 0 END + CASE WHEN regexp_matches(u, '[?&](board|bbs|menu|mid|category|cate|tab|code|id)=', 'i') THEN 8 ELSE 0 END AS points FROM l"""
)
def link_ranks(spark, sf_dir):
    at = lambda step, *xs: F.get(F.array(*map(F.lit, xs)), F.expr(f"CAST(id DIV {step} % {len(xs)} AS INT)"))
    text = F.concat(at(1, "장학 공지 ", "Scholarship ", "", "안내 "), "p_name")
    url = F.concat(F.lit("https://x.example.com/"), at(4, "notice", "boards", "bbs/a", "x"), at(16, "", "?menu=1", "?x=2"))
    return parts(spark, sf_dir).select("id", D.link_rank(text, url, "공지", "안내").alias("points"))


@query(
    """WITH s AS (SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'https://x.example.com/list.do' ELSE 'https://x.example.com/list' END AS u, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS i, CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_type END AS l, CASE p_size % 4 WHEN 0 THEN 'td' WHEN 1 THEN '' ELSE 'time' END AS d FROM part)
SELECT id, CASE WHEN i = '' AND u LIKE '%.do' THEN 'tbody tr' ELSE i END AS list_item_selector, CASE WHEN trim(l) = '' THEN 'a[href]' ELSE l END AS link_selector, CASE WHEN i = '' AND u LIKE '%.do' THEN 'a[href]' ELSE i END AS title_selector,
  CASE WHEN d IN ('td', '') AND u LIKE '%.do' THEN 'td:last-child, .date, .board-date, .wr_date' ELSE d END AS date_selector FROM s"""
)
def selector_defaults(spark, sf_dir):
    n = F.col("p_size")
    own = F.when(n % 3 == 0, "").otherwise(F.col("p_brand"))
    c = {"list_url": F.when(n % 2 == 0, "https://x.example.com/list.do").otherwise("https://x.example.com/list"), "list_item_selector": own, "link_selector": F.when(n % 5 == 0, " ").otherwise(F.col("p_type")), "title_selector": own, "date_selector": F.when(n % 4 == 0, "td").when(n % 4 == 1, "").otherwise("time")}
    return parts(spark, sf_dir).select("id", *(v.alias(k) for k, v in D.tuned_selectors(c).items()))


@query(
    """WITH v AS (SELECT p_partkey AS id, [p_type, p_brand, CASE WHEN p_type = 'PROMO' THEN 'ECONOMY' ELSE p_type END] AS a FROM part), r AS (SELECT id, a, list_transform(a, lambda x: CASE WHEN x = 'PROMO' THEN 'STANDARD' WHEN x = 'ECONOMY' THEN 'LOW' ELSE x END) AS b FROM v)
SELECT id, array_to_string(list_filter(b, lambda x, i: list_position(b, x) = i), ';') AS renewed, NOT list_has_any(a, ['PROMO', 'ECONOMY']) AS unrestricted FROM r"""
)
def renewed_values(spark, sf_dir):
    kind = F.col("p_type")
    own = F.array(kind, F.col("p_brand"), F.when(kind == "PROMO", "ECONOMY").otherwise(kind))
    return parts(spark, sf_dir).select("id", F.array_join(A.replace_values(own, {"PROMO": "STANDARD", "ECONOMY": "LOW"}), ";").alias("renewed"), A.only_unknown(own, ("PROMO", "ECONOMY")).alias("unrestricted"))


@query(
    """WITH n AS (SELECT p_partkey AS id, p_size AS n FROM part)
SELECT id, array_to_string(list_filter([CASE WHEN n % 2 = 0 THEN 'controlled_fixture_marker_missing' END, CASE WHEN n % 3 = 0 THEN 'missing_title' END, CASE WHEN n % 5 = 0 THEN 'missing_discovered_url' END, CASE WHEN n % 7 = 0 OR n * 4 < 80 THEN 'body_quality_not_full' END, CASE WHEN n % 4 = 0 THEN 'asset_required_for_controlled_phase1' END,
  CASE WHEN n % 6 = 0 THEN 'needs_quality_review' END, CASE WHEN n % 6 = 1 THEN 'blocked_by_missing_required_field' END, CASE WHEN n % 6 = 2 THEN 'blocked_by_schema' END, CASE WHEN n % 8 = 0 THEN 'quality_flags_present' END, CASE WHEN n % 9 = 0 THEN 'source_health_unsafe' END], lambda x: x IS NOT NULL), ';') AS blockers FROM n"""
)
def blockers(spark, sf_dir):
    n = F.col("p_size")
    local = F.when(n % 6 == 0, "needs_quality_review").when(n % 6 == 1, "blocked_by_missing_required_field").when(n % 6 == 2, "blocked_by_schema")
    found = D.apply_blockers(
        n % 2 > 0, F.when(n % 3 > 0, F.col("p_name")), F.when(n % 5 > 0, "https://x.example.com/1"), F.when(n % 7 == 0, "body_short").otherwise("full"), F.expr("repeat('가나다라', p_size)"), n % 4, local,
        F.when(n % 8 == 0, F.array(F.lit("x"))), n % 9 > 0,
    )
    return parts(spark, sf_dir).select("id", F.array_join(found, ";").alias("blockers"))


@query("""WITH n AS (SELECT DISTINCT concat(CASE WHEN p_size % 2 = 0 THEN '나' ELSE '가' END, p_type, p_size) AS name FROM part) SELECT name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS place FROM n""")
def collated_names(spark, sf_dir):
    names = read(spark, sf_dir, "part").select(F.concat(F.when(F.col("p_size") % 2 == 0, "나").otherwise("가"), "p_type", F.col("p_size").cast("string")).alias("name")).distinct()
    return C.collated(names, "name", place="place").withColumn("place", F.col("place").cast("int"))
