"""Bytes of web pages as text."""

from __future__ import annotations

import re

import pandas as pd

from ..functions.udfs import batch_udf

ALIASES = {"ks_c_5601-1987": "cp949", "euc-kr": "cp949", "ms949": "cp949", "utf8": "utf-8"}


def decode(raw: bytes | None, header: str | None) -> tuple[str | None, str | None]:
    """Text and charset: the header's, the page's own, UTF-8 and Korean are tried in turn, each strictly; else UTF-8 with marks."""
    if raw is None:
        return None, None
    named = [re.search(r"charset=[\"']?([\w-]+)", header or "", re.I), re.search(rb"<meta[^>]+charset=[\"']?([\w-]+)", raw[:4096], re.I)]
    tried = [m.group(1).decode() if isinstance(m.group(1), bytes) else m.group(1) for m in named if m] + ["utf-8", "euc-kr"]
    for name in dict.fromkeys(n.lower() for n in tried):
        try:
            return raw.decode(ALIASES.get(name, name)).removeprefix("﻿"), name
        except (UnicodeDecodeError, LookupError):
            continue
    return raw.decode("utf-8", "replace"), "utf-8"


@batch_udf("text string, charset string")
def decoded(raw: pd.Series, header: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([decode(*x) for x in zip(raw, header, strict=True)], columns=["text", "charset"])
