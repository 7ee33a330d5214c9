from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

pytest.importorskip("loomspark.llm.simhash")
from loomspark.llm import queries as Q  # noqa: E402
from loomspark.llm import simhash as S  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402


def brute_fingerprint(text: str | None) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(links: set, nodes) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def edited(text: str, n: int, seed: int) -> str:
    rnd, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.random()}"
    return " ".join(words)


def test_bit_sliced_pairs():
    rng = np.random.default_rng(1)
    for width, radius in ((1, 3), (1, 0), (4, 39)):
        for _ in range(60):
            n = int(rng.integers(1, 50))
            fps = rng.integers(0, 1 << 63, (5, width), dtype=np.uint64)[rng.integers(0, 5, n)].copy()
            for i in range(n):
                for b in rng.integers(0, 64 * width, rng.integers(0, radius + 1)):
                    fps[i, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
            unit = np.sort(rng.integers(0, 3, n))
            got = {x for i, j in S.close_pairs(unit, fps, radius) for x in zip(i.tolist(), j.tolist(), strict=True)}
            want = {(i, j) for i in range(n) for j in range(i + 1, n) if unit[i] == unit[j] and np.bitwise_count(fps[i] ^ fps[j]).sum() <= radius}
            assert got == want
            member, leader = S.forest(unit, fps, radius)
            label = dict(zip(member.tolist(), leader.tolist(), strict=True))
            assert {i: label.get(i, i) for i in range(n)} == groups(want, range(n))


def test_keys_miss_no_pair(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        fp = rnd.getrandbits(64)
        other = fp
        for b in rnd.sample(range(64), rnd.randint(0, 3)):
            other ^= 1 << b
        rows.append((i, *(int(np.uint64(x).astype(np.int64)) for x in (fp, other))))
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "i long, a long, b long")
    assert df.where(~F.arrays_overlap(S.block_keys(F.col("a")), S.block_keys(F.col("b")))).count() == 0
    finer = lambda c: F.flatten(F.transform(S.block_keys(F.col(c)), lambda k: S.longer_keys(F.col(c), k)))
    assert df.where(~F.arrays_overlap(finer("a"), finer("b"))).count() == 0


@pytest.mark.parametrize("chunk", [4096, 8])
def test_query_against_brute_force(spark, tables, edges, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    rows = [(100 + i, edited(prose(200, i // 4), i % 4, i), "en", "s", 0) for i in range(120)] + [(300 + i, "a copy of copies", "en", "s", 0) for i in range(30)]
    docs = edges.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(rows, SCHEMA))
    out = Q.op8_simhash(spark, tables(documents=docs)).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = sorted({brute_fingerprint(t) for _, t in texts})
    near = {(a, b) for k, a in enumerate(fps) for b in fps[k + 1 :] if (a ^ b).bit_count() <= 3}
    root = groups(near, fps)
    least = {}
    for i, t in texts:
        if i is not None:
            r = root[brute_fingerprint(t)]
            least[r] = min(i, least.get(r, i))
    want = sorted((i if i is not None else -1, f"{brute_fingerprint(t):016x}", least.get(root[brute_fingerprint(t)], -1)) for i, t in texts)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"] if r["component_id"] is not None else -1) for r in out) == want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "u long, v long")
    out = {r["v"]: r["root"] for r in S.components(edges).collect()}
    assert out == {**{i: 0 for i in range(1, 201)}, 1001: 1000}


def jaccard(a: str, b: str) -> float:
    x, y = (set(zip(*(t.lower().split()[k:] for k in range(5)), strict=False)) for t in (a, b))
    return len(x & y) / len(x | y)


def test_sketches_tell_the_similarity():
    for i in range(20):
        a = prose(150 + 20 * i, i)
        b = edited(a, i, i)
        assert abs(S.resemblance(S.sketch(a, 5)[2], S.sketch(b, 5)[2]) - jaccard(a, b)) < (1e-9 if i < 5 else 0.1)
    assert S.resemblance(S.sketch("", 5)[2], S.sketch(None, 5)[2]) == 1.0 and S.resemblance(S.sketch("a", 5)[2], S.sketch("", 5)[2]) == 0.0


def test_similar_documents(spark):
    base = [prose(400, 50 + i) for i in range(25)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(base)] + [(100 + i, edited(t, 4, i), "en", "s", 0) for i, t in enumerate(base)] + [(200 + i, edited(t, 120, i), "en", "s", 0) for i, t in enumerate(base)]
    out = {r["doc_id"]: r["component_id"] for r in S.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = {i: t for i, t, *_ in rows}
    assert all(jaccard(texts[i], texts[100 + i]) >= 0.85 for i in range(25))
    assert sum(out[100 + i] == i for i in range(25)) >= 24
    assert all(out[i] == i and out[200 + i] == 200 + i for i in range(25))


def test_similarity_is_kept_to(spark):
    """Short texts have whole sketches: a pair links if and only if it reaches the similarity, but for missed bands."""
    rows = [(i, prose(120, 300 + i // 2) if i % 2 == 0 else edited(prose(120, 300 + i // 2), 1 + i // 2 % 6, i), "en", "s", 0) for i in range(120)]
    out = {r["doc_id"]: r["component_id"] for r in S.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    pairs = [(out[i] == out[i + 1], jaccard(rows[i][1], rows[i + 1][1])) for i in range(0, 120, 2)]
    assert not any(same for same, j in pairs if j < 0.8)
    near = [same for same, j in pairs if j >= 0.8]
    assert len(near) > 10 and sum(near) >= len(near) - 1


def test_long_texts_are_held_to_the_similarity_exactly(spark):
    """Sets far beyond any sketch: no pair at or above the similarity is missed, none below it links."""
    rows = []
    for i in range(60):
        text = prose(1200, 900 + i)
        rows += [(2 * i, text, "en", "s", 0), (2 * i + 1, edited(text, 20 + i % 14, i), "en", "s", 0)]
    out = {r["doc_id"]: r["component_id"] for r in S.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    truth = [jaccard(rows[i][1], rows[i + 1][1]) >= 0.8 for i in range(0, 120, 2)]
    assert 15 < sum(truth) < 45
    assert [out[i] == out[i + 1] for i in range(0, 120, 2)] == truth


def test_hot_buckets_settle_without_copying(spark, monkeypatch):
    """Edits of a few pages, far more than a chunk, chains and strangers among them: the groups are those of brute force, and
    the sets that units are given are few times the sets that there are."""
    monkeypatch.setattr(S, "CHUNK", 16)
    monkeypatch.setattr(S, "CHUNK_SET_BYTES", 16 * 8 * 150)
    monkeypatch.setattr(S, "STAR", 20)
    given = []
    real = S.dealt
    monkeypatch.setattr(S, "dealt", lambda keyed, sizes: given.append(real(keyed, sizes)) or given[-1])
    rnd, rows = random.Random(1), []
    for page in range(3):
        text = prose(150, 4000 + page)
        for k in range(90):
            if k % 10 == 9:
                text = edited(text, 2, k)  # the page itself moves on: a chain
            rows.append((len(rows), edited(text, rnd.choice([0, 1, 1, 2, 5]), 1000 * page + k), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc_id"]: r["component_id"] for r in S.similar_documents(docs).collect()}
    sets = {i: set(zip(*(t.lower().split()[k:] for k in range(5)), strict=False)) for i, t, *_ in rows}
    near = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    want = groups(near, range(len(rows)))
    assert out == want and 3 <= len(set(want.values())) < 200
    assert given[-1].count() < 5 * len(rows)


def test_radius_holds_for_unlike_sizes(spark):
    """One set inside the other, and sets of few shingles, where bits are not independent: all pairs at 0.8 are linked."""
    rnd, rows = random.Random(7), []
    words = [f"w{i}" for i in range(5000)]
    for n in (5, 6, 8, 10, 15, 24, 40, 100, 400):
        for _ in range(12):
            text = [rnd.choice(words) for _ in range(n + 4)]
            shorter = text[: max(5, int(np.ceil(0.8 * n)) + 4)]  # n shingles, and 0.8 of them
            rows += [(len(rows), " ".join(text), "en", "s", 0), (len(rows) + 1, " ".join(shorter), "en", "s", 0)]
    out = {r["doc_id"]: r["component_id"] for r in S.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(0, len(rows), 2):
        assert (out[i] == out[i + 1]) == (jaccard(rows[i][1], rows[i + 1][1]) >= 0.8)


@pytest.mark.parametrize("seed", range(5))
def test_forest_with_labels(seed):
    """Labels that are known join what they join, and no pair inside one is asked about."""
    rnd = np.random.default_rng(seed)
    n = 60
    unit = np.sort(rnd.integers(0, 3, n))
    fps = rnd.integers(0, 4, (n, 1)).astype(np.int64)
    known = rnd.integers(0, 12, n)
    asked = []
    member, leader = S.forest(unit, fps, 1, lambda x, y: asked.append((x, y)) or True, known)
    assert all(known[x] != known[y] for x, y in asked)
    close = {(i, j) for i in range(n) for j in range(i + 1, n) if unit[i] == unit[j] and int(fps[i, 0] ^ fps[j, 0]).bit_count() <= 1}
    same = {(i, j) for i in range(n) for j in range(i + 1, n) if unit[i] == unit[j] and known[i] == known[j]}
    found = set(zip(leader.tolist(), member.tolist(), strict=True)) | same
    assert groups(found, range(n)) == groups(close | same, range(n))


@pytest.mark.parametrize("shared", [S.SHARED, 64])
def test_verified_against_brute_force(monkeypatch, shared):
    """A large group of edits of one page around the similarity, among small units and sets that are empty or equal."""
    monkeypatch.setattr(S, "SHARED", shared)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    change = lambda n: np.unique(np.concatenate([rng.permutation(base)[n:], rng.integers(0, 1 << 63, n, dtype=np.uint64)]))
    units = [[change(3), change(90)], [change(int(n)) for n in rng.integers(0, 60, 150)], [base[:0], base[:0], base], [np.unique(base)] * 70 + [base[:0]]]
    unit = np.repeat(np.arange(len(units)), [len(x) for x in units])
    sets = np.empty(len(unit), object)
    sets[:] = [s for u in units for s in u]
    fps = np.zeros((len(unit), 1), np.uint64)
    pairs = [(i, j) for i in range(len(unit)) for j in range(i + 1, len(unit)) if unit[i] == unit[j]]
    jaccard = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b)) if len(np.union1d(a, b)) else 1.0
    near = {(i, j) for i, j in pairs if jaccard(sets[i], sets[j]) >= 0.8}
    i, j = S.verified(unit, fps, sets, 3, 0.8)
    nodes = range(len(unit))
    assert groups(set(zip(i.tolist(), j.tolist(), strict=True)), nodes) == groups(near, nodes)
    at = np.flatnonzero(unit == 1)
    may = S.overlap(sets[at], 0.8)
    said = {(a, b) for a, b in ((x - at[0], y - at[0]) for x, y in pairs if unit[x] == 1) if may(np.array([a]), np.array([b]))[0]}
    true = {(x - at[0], y - at[0]) for x, y in near if unit[x] == 1}
    assert true <= said and (shared == 64 or said == true)


def test_verified_without_rows():
    i, j = S.verified(np.zeros(0, int), np.zeros((0, 1), np.uint64), np.zeros(0, object), 3, 0.8)
    assert not len(i) and not len(j)
