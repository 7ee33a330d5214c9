"""Array rules: restrictions that may be absent, membership, overlap, value maps, type guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import clean_text, number

NONE = "CAST(array() AS array<string>)"


def unrestricted(arr: Column) -> Column:
    """Null and empty restrict nothing."""
    return arr.isNull() | (F.size(arr) == 0)


def allows(arr: Column, *values: Column) -> Column:
    """No restriction, or one of the values is in it; a null value is in nothing."""
    return reduce(lambda a, v: a | F.coalesce(F.array_contains(arr, v), F.lit(False)), values, unrestricted(arr))


def overlaps(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def any_where(arr: Column, test) -> Column:
    return F.coalesce(F.exists(arr, test), F.lit(False))


def only_unknown(arr: Column, known: tuple[str, ...]) -> Column:
    """No element is one of the known values, so none restricts."""
    return F.forall(arr, lambda x: ~x.isin(*known))


def contains_either(a: Column, b: Column) -> Column:
    """One text holds the other, case aside; per cent signs and underscores in either stay wildcards."""
    like = lambda x, y: F.call_function("ilike", x, F.concat(F.lit("%"), y, F.lit("%")))
    return F.coalesce(like(a, b) | like(b, a), F.lit(False))


def ilike_any(x: Column, needles: Column) -> Column:
    return F.coalesce(F.exists(needles, lambda n: F.call_function("ilike", x, F.concat(F.lit("%"), n, F.lit("%")))), F.lit(False))


def null_if_empty(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def distinct_filled(arr: Column) -> Column:
    """Trimmed, without blanks and repeats, null when nothing is left."""
    return null_if_empty(F.array_distinct(F.filter(F.transform(arr, lambda t: F.trim(t)), lambda x: x != "")))


def expand(arr: Column, table: dict[str, tuple[str, ...]], keep_rest: bool = True) -> Column:
    """Each value becomes its values in the table, in order and once; others stay or go."""
    lookup = F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    one = lambda x: F.coalesce(F.element_at(lookup, x), F.array(x) if keep_rest else F.expr(NONE))
    return F.array_distinct(F.flatten(F.transform(arr, one)))


def split_known(arr: Column, known: tuple[str, ...] = K.SPECIAL_INFO, legacy: dict = K.SPECIAL_INFO_LEGACY) -> Column:
    """struct<matched,extra>: values of the list, old spellings renewed, and all others."""
    clean = F.filter(F.transform(arr, lambda t: F.trim(t)), lambda x: x != "")
    renewed = expand(clean, legacy)
    is_known = lambda x: x.isin(*known)
    return F.struct(F.filter(renewed, is_known).alias("matched"), F.filter(renewed, lambda x: ~is_known(x)).alias("extra"))


def replace_values(arr: Column, table: dict[str, str]) -> Column:
    return null_if_empty(expand(arr, {k: (v,) for k, v in table.items()}))


def stored_enrollment(arr: Column) -> Column:
    return expand(arr, K.ENROLLMENT_STORAGE, keep_rest=False)


def feed_enrollment(x: Column) -> Column:
    table = F.create_map(*(F.lit(v) for kv in K.ENROLLMENT_FEED.items() for v in kv))
    return F.array_compact(F.array(F.element_at(table, F.lower(clean_text(x)))))


def benefit_kinds(x: Column) -> Column:
    t = clean_text(x)
    found = F.array_compact(F.array(*(F.when(t.rlike(p), F.lit(k)) for k, p in K.BENEFITS)))
    return F.when((F.size(found) == 0) & (t != ""), F.array(F.lit(K.OTHER_BENEFIT))).otherwise(found)


def grades(x: Column) -> Column:
    """Years 1 to 6 in a text, each once."""
    parts = F.transform(F.split(clean_text(x), r"[,\s]+"), lambda p: p.try_cast("int"))
    return F.array_distinct(F.filter(parts, lambda n: n.between(1, 6)))


def majors(major: Column, category: Column) -> Column:
    pick = F.coalesce(F.nullif(clean_text(major), F.lit("")), F.nullif(clean_text(category), F.lit("")))
    return F.when(pick != "무관", F.filter(F.transform(F.split(pick, "[,/]"), lambda t: F.trim(t)), lambda s: s != ""))


def level(x: Column) -> Column:
    """A whole level from 0 to 10, else null."""
    n = F.floor(number(x))
    return F.when(n.between(0, 10), n).cast("int")


def json_texts(x: Column) -> Column:
    """The texts of a JSON list that are not blank; anything else is an empty list."""
    parsed = F.from_json(x, "array<string>")
    return F.coalesce(F.filter(parsed, lambda s: s.isNotNull() & (F.trim(s) != "")), F.expr(NONE))


def allowed(arr: Column, values: tuple[str, ...]) -> Column:
    """Trimmed texts that are in the list; null is an empty list."""
    kept = F.filter(F.transform(arr, lambda t: F.trim(t)), lambda x: x.isin(*values))
    return F.coalesce(kept, F.expr(NONE))
