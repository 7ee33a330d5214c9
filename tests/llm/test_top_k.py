from __future__ import annotations

import numpy as np
import pytest

pytest.importorskip("loomspark.llm.mih")
from loomspark.llm import mih  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list, k: int) -> set:
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v}
    wide = max((len(v) for _, v in good), default=0)
    bits = [(i, np.r_[np.array(v) > 0, np.zeros(wide - len(v), bool)]) for i, v in good]
    out = set()
    for i, a in bits:
        if i % 50 == 0:
            near = sorted({(int((a != b).sum()), j) for j, b in bits if j != i})[:k]
            out |= {(i, n + 1, j, d) for n, (d, j) in enumerate(near)}
    return out


def test_query_against_brute_force(spark, tables):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # one vector of many rows
    rows += [(5000, None), (5050, [1.0, None]), (None, rows[0][1]), (5100, []), (5150, [1.0, -1.0])]
    sf = tables(embeddings=spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    got = {(r["vec_id"], r["rank"], r["neighbour_id"], r["distance"]) for r in Q.op10_top_k(spark, sf).collect()}
    assert got == brute(rows, 10)


def test_few_rows_and_none(spark, tables):
    few = [(0, [1.0] * 64, 0), (50, [-1.0] * 64, 0)]
    assert Q.op10_top_k(spark, tables(embeddings=spark.createDataFrame(few, SCHEMA))).count() == 2
    assert Q.op10_top_k(spark, tables(embeddings=spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("dims", [65, 128, 300])
def test_wide_vectors(spark, tables, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims if i % 3 else dims - 7).tolist()) for i in range(300)] + [(1000 + i, [1.0] * dims) for i in range(30)]
    sf = tables(embeddings=spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    got = {(r["vec_id"], r["rank"], r["neighbour_id"], r["distance"]) for r in Q.op10_top_k(spark, sf).collect()}
    assert got == brute(rows, 10)


@pytest.mark.parametrize("words", [1, 2])
@pytest.mark.parametrize("n", [1, 3, 300, 5000])
def test_index_is_exact(n, words):
    rng = np.random.default_rng(n)
    codes = np.unique(rng.integers(0, 1 << 63, (n, words), dtype=np.uint64), axis=0)
    if words > 1:  # codes of which some are near each other, or the radii of random ones reach everything
        codes = np.unique(codes[rng.integers(0, max(1, n // 10), n)] ^ (np.uint64(1) << rng.integers(0, 63, (n, words), dtype=np.uint64)), axis=0)
    asked = np.concatenate([codes[:5], rng.integers(0, 1 << 63, (5, words), dtype=np.uint64)])
    q, c, d = mih.Index(codes).nearest(asked, np.ones(len(codes), np.int64), 7)
    for i, code in enumerate(asked):
        far = np.bitwise_count(codes ^ code).sum(1)
        true = np.sort(far)[:7]
        own = np.sort(d[q == i])
        assert (own[: len(true)] == true).all() and (own >= 0).all() and len(own) >= len(true)
        assert set(c[q == i].tolist()) == set(np.flatnonzero(far <= true[-1]).tolist())


def test_clashing_columns(spark, tables):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=64).tolist(), 0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("id", "code", "ids", "query", "distance", "rank", "shard", "block", "place")})
    got = {(r["vec_id"], r["rank"], r["neighbour_id"], r["distance"]) for r in Q.op10_top_k(spark, tables(embeddings=df)).collect()}
    assert got == brute([(i, v) for i, v, _ in rows], 10)
