"""Text rules as Column expressions. White space, letters and word edges follow Unicode where the rule is about prose.

Java's \\b and \\s differ from what the rules mean: (?U) makes \\s Unicode, and word edges for the ASCII-only rules are
written as look-arounds over [A-Za-z0-9_].
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

LEFT, RIGHT = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


def sub(x: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(x, pattern, by)


def clean_text(x: Column) -> Column:
    """White space runs become one blank, none at the ends; null becomes empty."""
    return F.trim(sub(F.coalesce(x, F.lit("")), r"(?U)[\s﻿]+", " "))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first of several fields that is not blank, trimmed."""
    return F.coalesce(*map(blank_to_null, columns))


def offer_name(x: Column) -> Column:
    """Display name: semesters, years, emptied brackets and stray separators go; an emptied name stays as it was."""
    out = x
    for pattern in K.OFFER_NAME_CUTS:
        out = sub(out, pattern)
    out = sub(sub(out, r"\s{2,}", " "), r"^[\s\-–—|·,/]+|[\s\-–—|·,/]+$")
    return F.coalesce(blank_to_null(out), x)


def list_title(x: Column) -> Column:
    """A title from a list, without leading badges and trailing counters."""
    out = clean_text(x)
    for pattern in K.LIST_TITLE_TRIMS:
        out = sub(out, pattern)
    return F.trim(out)


def identity_title(x: Column) -> Column:
    """A title by which two pages are compared: lower case, known short badges in brackets and stop words gone."""
    badge = "|".join(K.TITLE_BADGES)
    out = sub(F.lower(clean_text(x)), rf"(?iu)\[\s*(?:{badge})?\s*\]", " ")
    out = sub(out, r"[^\p{L}\p{N}]+", " ")
    latin, other = ("|".join(w for w in K.TITLE_STOP_WORDS if w.isascii() == a) for a in (True, False))
    out = sub(out, f"(?i){LEFT}(?:{latin}){RIGHT}", " ")
    # the word edge of the rule knows ASCII only: a Hangul word has one where ASCII letters touch it
    return F.trim(sub(sub(out, f"(?<=[A-Za-z0-9_])(?:{other})(?=[A-Za-z0-9_])", " "), r"\s+", " "))


def strip_prefixes(x: Column, passes: int = 4) -> Column:
    """Leading badges go, layer by layer; each pass that changes nothing is the last, so running on is harmless."""
    out = clean_text(x)
    for _ in range(passes):
        for p in K.TITLE_LAYERS:
            out = sub(out, p)
        out = F.trim(out)
    return out


def first_segment(x: Column) -> Column:
    return F.element_at(F.split(clean_text(x), K.TITLE_SEGMENT, -1), 1)


def segments(x: Column) -> Column:
    return F.filter(F.transform(F.split(clean_text(x), K.TITLE_SEGMENT, -1), lambda s: identity_title(strip_prefixes(s))), lambda s: s != "")


def name_stem(x: Column) -> Column:
    """A department without its kind of unit: one of four suffixes, then a last letter that marks a department."""
    out = sub(sub(clean_text(x), r"\s+"), "(?:전공|스쿨|계열|대학)$")
    return sub(out, "[과부]$")


def name_variants(x: Column) -> Column:
    """A name, what its closing brackets hold, what stands before them, and its parts between slashes; each once, in order."""
    n = clean_text(x)
    inner, outer = (clean_text(F.regexp_extract(n, r"^(.+?)\(([^)]+)\)$", k)) for k in (2, 1))
    parts = F.when(F.contains(n, F.lit("/")), F.transform(F.split(n, "/"), clean_text)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(F.array(n, inner, outer), parts), lambda s: s != ""))


def without_aliases(x: Column, aliases: list[str]) -> Column:
    """Leading aliases go, one after the other in their order."""
    for a in aliases:
        x = sub(x, rf"^\Q{a}\E\s*")
    return clean_text(x)


def department_of(x: Column, aliases: list[str]) -> Column:
    """The department in a source's name; null where only a central notice board is left."""
    out = F.trim(sub(sub(without_aliases(clean_text(x), aliases), r"\(중앙\)"), r"\s*합쳐진\s*듯.*$"))
    return F.when((out != "") & ~out.rlike(r"장학공지|공지\(중앙\)|중앙"), out)


def slug_of(source_id: Column, fallback: Column) -> Column:
    own = F.lower(F.trim(F.coalesce(source_id, F.lit(""))))
    return F.when(F.contains(own, F.lit("_")), F.substring_index(own, "_", 1)).otherwise(F.lower(F.trim(F.coalesce(fallback, F.lit("")))))


def source_department(name: Column, level: Column, fallback: Column) -> Column:
    """A department source's own name, less its first word; other levels keep what they have."""
    given, own = (F.trim(F.coalesce(c, F.lit(""))) for c in (fallback, name))
    is_department = F.lower(F.trim(F.coalesce(level, F.lit("")))) == "department"
    rest = F.when(own.rlike(r"\s"), sub(own, r"^\S+\s+")).otherwise(own)
    return F.when(~is_department | (given != ""), given).otherwise(rest)


def source_priority(level: Column) -> Column:
    own = F.lower(F.trim(F.coalesce(level, F.lit(""))))
    return F.when(own == "university", 3).when(own == "college", 2).when(own == "department", 1).otherwise(0)


def group_of_path(path: Column, groups: list[str]) -> Column:
    """The group whose folder a file lies in, by the order of the groups; "unknown" where none fits."""
    p = F.lower(F.translate(path, "\\", "/"))
    return F.coalesce(*(F.when(F.contains(p, F.lit(f"/{g}/")), F.lit(g)) for g in groups), F.lit("unknown"))


def first_rule(x: Column, rules: dict[str, list[str]]) -> Column:
    """The first code one of whose keywords the text holds, white space aside; null where none does."""
    n = sub(F.coalesce(x, F.lit("")), r"(?U)\s+")
    return F.coalesce(*(F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(n, w)), F.lit(code)) for code, words in rules.items()))


def any_keyword(x: Column, keywords: list[str]) -> Column:
    low = F.lower(x)
    return F.exists(F.array(*(F.lit(k.lower()) for k in keywords)), lambda k: F.contains(low, k))


def keyword_hits(fields: dict[str, Column], keywords: list[str]) -> Column:
    """array<struct<field,keyword,start,end>>: the first place of each keyword in each field, counted from 0."""
    hits = []
    for field, x in fields.items():
        low = F.lower(x)
        for k in keywords:
            at = F.locate(k.lower(), low)
            hit = F.struct(F.lit(field).alias("field"), F.lit(k).alias("keyword"), (at - 1).alias("offset_start"), (at - 1 + len(k)).alias("offset_end"))
            hits.append(F.when(at > 0, hit))
    return F.array_compact(F.array(*hits))


def reject_tag(note: Column) -> Column:
    """What a reviewer's note says: a tag in leading brackets, or one of three phrases, or nothing."""
    n = clean_text(note)
    tag = F.regexp_extract(n, r"(?i)^\[([a-z0-9_]+)\]", 1)
    return (
        F.when(tag != "", F.lower(tag))
        .when(n.rlike("(?i)중복|duplicate"), "duplicate")
        .when(n.rlike(r"(?i)장학\s*아님|not\s*scholarship"), "not_scholarship")
        .when(n.rlike(r"(?i)기간\s*종료|마감|expired|closed"), "expired")
        .otherwise("untagged")
    )


def condition_pieces(x: Column) -> Column:
    """A free text of conditions as its pieces, in order, each once; a lone limit mark joins the piece behind it."""
    clean = lambda p: sub(sub(F.replace(sub(sub(F.trim(p), r"^○\s*"), r"^※\s*"), F.lit("[제한사항]"), F.lit("[제한]")), r"(?U)\s+", " "), r"^[\s/,;·]+|[\s/,;·]+$")
    useful = lambda p: (p != "") & ~p.isin(*K.EMPTY_CONDITIONS) & ~F.startswith(p, F.lit("자세한 사항은 첨부파일")) & ~F.startswith(p, F.lit("기관확인필요"))
    v = F.replace(F.trim(F.coalesce(x, F.lit(""))), F.lit("※자세한"), F.lit("※ 자세한"))
    v = sub(sub(v, r" / \[제한(?:사항)?\]", "\n[제한] "), " / ", "\n")
    v = sub(F.replace(v, F.lit("※ 자세한 사항은 첨부파일 또는 홈페이지 참고"), F.lit("")), r"○\s*", "\n")
    kept = F.filter(F.transform(F.split(v, "\n"), clean), useful)
    joined = F.aggregate(
        kept,
        F.array().cast("array<string>"),
        lambda a, p: F.when((F.size(a) > 0) & (F.element_at(a, -1) == "[제한]"), F.array_append(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.concat(F.lit("[제한] "), p))).otherwise(F.array_append(a, p)),
    )
    return F.when(useful(clean(F.coalesce(x, F.lit("")))), F.array_distinct(joined)).otherwise(F.array().cast("array<string>"))


def number(x: Column) -> Column:
    """A number with separators, blanks and currency mark taken out; an empty text is 0, as the rule has it."""
    digits = sub(x, r"(?U)[,\s원]")
    return F.when(digits == "", F.lit(0.0)).otherwise(digits.try_cast("double"))


def positive_int(x: Column) -> Column:
    """struct<status,value>: missing, invalid or ok. Only digits, from 1 to 2**53 - 1."""
    t = F.trim(F.coalesce(x, F.lit("")))
    value = F.when(t.rlike(r"^\d+$"), t.try_cast("bigint"))
    good = value.between(1, (1 << 53) - 1)
    status = F.when(t == "", "missing").when(F.coalesce(good, F.lit(False)), "ok").otherwise("invalid")
    return F.struct(status.alias("status"), F.when(good, value).alias("value"))


def phone(x: Column) -> Column:
    """Eleven or ten digits in groups; anything else as it was."""
    d = sub(x, r"\D")
    cut = lambda *at: F.concat_ws("-", *(F.substring(d, a, n) for a, n in at))
    return F.when(F.length(d) == 11, cut((1, 3), (4, 4), (8, 4))).when(F.length(d) == 10, cut((1, 3), (4, 3), (7, 4))).otherwise(x)


def labelled(parts: dict[str, Column], sep: str = "\n\n", form: str = "[%s]\n") -> Column:
    """Parts that are not blank under their labels."""
    return F.concat_ws(sep, *(F.concat(F.lit(form % k), blank_to_null(c)) for k, c in parts.items()))


def split_list(x: Column, pattern: str = ",") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), pattern), lambda t: F.trim(t)), lambda s: s != "")


def flag(x: Column, default: bool) -> Column:
    """A written yes or no; the default where it is blank or neither."""
    low = F.lower(F.trim(x))
    return F.when(low.isin("1", "true", "yes", "y", "on"), True).when(low.isin("0", "false", "no", "n", "off"), False).otherwise(default)


def title_quality(title: Column, raw: Column, own_node: Column) -> Column:
    """missing, contaminated or clean. own_node: the title is the whole text of its link or of a title element."""
    t, r = clean_text(title), clean_text(raw)
    longer = F.length(r) > F.length(t) + K.RAW_BEYOND_TITLE
    bad = t.rlike(K.TITLE_NOISE) | (t.rlike(K.TITLE_DATE_RANGE) & ~own_node) | (~own_node & longer) | ((F.length(t) > K.LONG_TITLE) & longer)
    return F.when(t == "", "missing").when(bad, "contaminated").otherwise("clean")


def menu_title(x: Column) -> Column:
    t = clean_text(x)
    return (F.length(t) <= 1) | t.rlike(K.TITLE_MENU)
