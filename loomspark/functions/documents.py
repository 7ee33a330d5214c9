"""Free JSON: metadata cut to size, rich text made plain, settings without blanks, drafts made safe."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import allowed, level
from .dates import iso_head
from .text import blank_to_null, number
from .udfs import batch_udf

SECRET_KEY = re.compile("(?i)secret|token|key|password|authorization|cookie|env")
TEXT_KEY = re.compile("(?i)(?:html|body_html|content)$")
LONGEST_TEXT, LONGEST_LIST, MOST_KEYS, DEEPEST = 500, 5, 20, 2


def cut(value, depth: int = 0):
    """Long texts and lists shortened, what lies deeper than two levels and what may be secret left out."""
    if isinstance(value, str):
        return value[:LONGEST_TEXT] + "..." if len(value) > LONGEST_TEXT else value
    if value is None or isinstance(value, bool | int | float):
        return value
    if depth >= DEEPEST:
        return "[truncated]"
    if isinstance(value, list):
        return [cut(x, depth + 1) for x in value[:LONGEST_LIST]]
    kept = {k: v for k, v in list(value.items())[:MOST_KEYS] if not SECRET_KEY.search(k)}
    return {k: "[truncated]" if TEXT_KEY.search(k) and isinstance(v, str) and len(" ".join(v.split())) > LONGEST_TEXT else cut(v, depth + 1) for k, v in kept.items()}


def loaded(text: str | None):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


@batch_udf("string")
def cut_json(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if (x := loaded(t)) is None else json.dumps(cut(x), ensure_ascii=False, separators=(",", ":")))


def plain(value: str | None) -> str:
    """A block editor's JSON as lines, children behind their parents; any other text as it is."""
    text = (value or "").strip()
    blocks = loaded(text) if text[:1] in ("[", "{") else None
    if blocks is None:
        return text
    if not isinstance(blocks, list):
        return ""
    lines, todo = [], blocks[::-1]
    while todo:
        block = todo.pop()
        if isinstance(block, dict):
            content = block.get("content")
            line = "".join(c["text"] for c in content if isinstance(c, dict) and isinstance(c.get("text"), str)).strip() if isinstance(content, list) else ""
            lines += [line] if line else []
            children = block.get("children")
            todo += children[::-1] if isinstance(children, list) else []
    return "\n".join(lines)


@batch_udf("string")
def plain_text(value: pd.Series) -> pd.Series:
    return value.map(plain)


def settings(fields: dict[str, Column]) -> Column:
    """A JSON object of the fields that are not blank; null when none is."""
    filled = [blank_to_null(c).alias(k) for k, c in fields.items()]
    return F.nullif(F.to_json(F.struct(*filled)), F.lit("{}"))


def draft(raw: Column, supports: tuple[str, ...], statuses: tuple[str, ...]) -> Column:
    """A draft out of untrusted JSON: every field of its type or null, lists only of what is allowed."""
    get = lambda k: F.get_json_object(raw, f"$.{k}")
    texts = lambda k: F.coalesce(F.from_json(get(k), "array<string>"), F.array().cast("array<string>"))
    own = lambda k: F.filter(F.transform(texts(k), lambda t: F.trim(t)), lambda s: s != "")
    whole = F.filter(F.transform(texts("qual_academic_year"), lambda s: number(s).cast("int")), lambda n: n.isNotNull())
    return F.struct(
        blank_to_null(get("support_amount_text")).alias("support_amount_text"),
        allowed(texts("support_types"), supports).alias("support_types"),
        *(iso_head(get(k)).alias(k) for k in ("apply_start_date", "apply_end_date", "announcement_date")),
        *(number(get(k)).alias(k) for k in ("selection_count", "qual_gpa_min")),
        whole.alias("qual_academic_year"),
        allowed(texts("qual_enrollment_status"), statuses).alias("qual_enrollment_status"),
        own("qual_major").alias("qual_major"),
        *(level(get(k)).alias(k) for k in ("qual_income_level_min", "qual_income_level_max")),
        *(own(k).alias(k) for k in ("qual_special_info", "qual_extra_requirements", "required_documents")),
        *(blank_to_null(get(k)).alias(k) for k in ("apply_method", "contact", "note")),
    )
