"""Text and titles of HTML by patterns alone, as columns. Trees are parsed in `lists` and `details`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text


def strip_tags(html: Column) -> Column:
    """Text of HTML by patterns alone: no scripts, styles or tags, five entities resolved."""
    out = F.regexp_replace(html, r"(?is)<script(?![A-Za-z0-9_]).*?</script>|<style(?![A-Za-z0-9_]).*?</style>", " ")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    for pattern, by in (("(?i)&nbsp;", " "), ("(?i)&amp;", "&"), ("(?i)&lt;", "<"), ("(?i)&gt;", ">"), ("(?i)&quot;", '"')):
        out = F.regexp_replace(out, pattern, by)
    return clean_text(out)


def title_candidates(html: Column, most: int = 8) -> Column:
    """Titles by patterns alone: the document's, headings, and elements whose class says so; each once, in this order."""
    patterns = (
        r"(?is)<title(?![A-Za-z0-9_])[^>]*>(.*?)</title>",
        r"(?is)<h[1-3](?![A-Za-z0-9_])[^>]*>(.*?)</h[1-3]>",
        r"(?is)<[^>]+class=[\"'][^\"']*(?:title|subject|heading|view-title|board-title)[^\"']*[\"'][^>]*>(.*?)</[^>]+>",
    )
    found = F.concat(*(F.regexp_extract_all(html, F.lit(p), 1) for p in patterns))
    return F.slice(F.array_distinct(F.filter(F.transform(found, strip_tags), lambda t: t != "")), 1, most)
