from __future__ import annotations

import hashlib
from collections import Counter

import pytest

pytest.importorskip("loomspark.llm.line_dedup")
from loomspark.llm import line_dedup as L  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402

BLANK = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(texts: list, least: int = 10, ids: list | None = None) -> list:
    owners = [i if i is not None else f"nameless {t}" for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    seen = Counter(k for _, k in {(o, key(x)) for o, t in zip(owners, texts, strict=True) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def shared(spark):
    texts = [f"Every page SAYS this\n{prose(12, i)}\n  every page says this\t\r\nÉcole {i % 12}\n\n" for i in range(60)]
    texts += [f"nine times\n{i}" for i in range(9)] + [f" ten times\nÉ{i}" for i in range(10)] + ["\n".join(f"line {i % 40}" for i in range(3000))] + ["line 7\nline 8"] * 11
    return texts, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)


def test_query_against_brute_force(spark, tables, edges):
    texts, docs = shared(spark)
    out = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in Q.op3_line_dedup(spark, tables(documents=docs)).collect()}
    assert [out[i] for i in range(len(texts))] == brute(texts)
    assert sum(x[1] for x in out.values()) > 100


def test_bitmaps_are_small(spark):
    _, docs = shared(spark)
    rows = L.keep_bitmaps(docs).collect()
    assert len(rows) < docs.count() and all(0 not in [bin(~w).count("1") for w in r["keep"].values()] for r in rows)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "only here", "en", "s", 0)] * 12 + [(None, f"no id {i}\nshared by nulls", "en", "s", 0) for i in range(10)]
    out = L.drop_common_lines(spark.createDataFrame(rows, SCHEMA)).select("row.doc_id", "n_dropped", "kept").collect()
    assert sorted((r["doc_id"] or 0, r["n_dropped"]) for r in out) == [(0, 1)] * 10 + [(1, 0)] * 12


def test_an_id_is_one_document(spark, tables):
    """Ten texts under one id are one document; the query, its SQL and the definition agree."""
    import duckdb

    ids = [7] * 10 + [None] * 12 + [1, 2, 3, 4, 5, 6, 8, 9, 10, 11]
    texts = [f"shared by one id\nown {i}\nby all" for i in range(10)] + [f"nameless {i}\nby all\nby the nameless" for i in range(11)] + ["nameless 0\nby all\nby the nameless"]
    texts += ["by all\nby ten" if i != 4 else None for i in range(10)]
    sf = tables(documents=spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts, strict=True)], SCHEMA))
    got = sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in Q.op3_line_dedup(spark, sf).collect())
    assert got == sorted((i or 0, *x) for i, x in zip(ids, brute(texts, ids=ids), strict=True))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet/*.parquet')")
    assert got == sorted((i or 0, n, d, h) for i, n, d, h in con.execute(Q.LINES_SQL).fetchall())
    assert sum(d for _, _, d, _ in got) == 31 + 12
