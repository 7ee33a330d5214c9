"""Sharding: the curve against its definition, places against brute force, counts, pruning, skew."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("loomspark.llm.queries")
from loomspark.llm import hilbert as H  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402


def walk(point, bits: int) -> int:
    """Place on the curve by the transpose form of the algorithm: the rule undone bit by bit, no table."""
    x, n = list(point)[::-1], len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return sum(((x[i] >> b) & 1) << (b * n + n - 1 - i) for b in range(bits) for i in range(n))


def table_walk(point, bits: int) -> int:
    digits, nexts = H.states(len(point))
    state = place = 0
    for level in range(bits - 1, -1, -1):
        at = (state << len(point)) + sum(((v >> level) & 1) << i for i, v in enumerate(point))
        place, state = (place << len(point)) + digits[at], nexts[at]
    return place


@pytest.mark.parametrize("dims,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_is_one_walk(spark, dims, bits):
    points = list(itertools.product(range(1 << bits), repeat=dims))
    by = {table_walk(p, bits): p for p in points}
    assert sorted(by) == list(range(len(points)))
    assert all(sum(abs(a - b) for a, b in zip(by[i], by[i + 1], strict=True)) == 1 for i in range(len(points) - 1))
    df = spark.createDataFrame([tuple(p) for p in points], ", ".join(f"c{i} int" for i in range(dims)))
    got = df.select("*", H.curve([F.col(f"c{i}") for i in range(dims)], bits).alias("place")).collect()
    assert all(r["place"] == table_walk(r[:-1], bits) for r in got)


def test_same_shape_as_the_published_form():
    """Both are Hilbert curves: quadrants of every size are runs of both."""
    for bits in (2, 3):
        for form in (walk, table_walk):
            by = {form(p, bits): p for p in itertools.product(range(1 << bits), repeat=2)}
            for size in range(1, bits):
                for run in range(0, len(by), 4**size):
                    assert len({(by[i][0] >> size, by[i][1] >> size) for i in range(run, run + 4**size)}) == 1


def brute(rows: list[dict], dims: tuple[str, ...], bits: int, shards: int) -> dict:
    def cells(c):
        values = sorted(r[c] for r in rows if r[c] is not None)
        least = {}
        for v in sorted(set(values)):
            least.setdefault(int(values.index(v) / len(values) * (1 << bits)), v)
        return sorted((v, k) for k, v in least.items())

    cut = {c: cells(c) for c in dims}
    cell = lambda c, v: 0 if v is None else max(k for least, k in cut[c] if least <= v)
    key = lambda r: (table_walk([cell(c, r[c]) for c in dims], bits), xxhash.xxh64((r["text"] or "").encode(), seed=42).intdigest(), r["doc_id"] if r["doc_id"] is not None else -(10**9))
    signed = lambda k: (k[0], k[1] - (1 << 64) if k[1] >> 63 else k[1], k[2])
    ordered = sorted(rows, key=lambda r: signed(key(r)))
    n, out, seen = len(rows), [], {}
    for i, r in enumerate(ordered):
        s = i * shards // n
        out.append((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), s, seen.setdefault(s, 0)))
        seen[s] += 1
    return sorted(out, key=repr)


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = Q.op11_sharding(spark, sf).collect()
    want = brute([r.asDict() for r in docs.collect()], H.DIMENSIONS, H.BITS, 8)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got), key=repr) == want


@pytest.fixture(scope="module")
def many(spark):
    rnd = random.Random(4)
    rows = [(i, prose(rnd.randint(1, 30), i % 900), rnd.choice(["en", "de", "fr", None]), "hot" if i % 3 == 0 else f"s{rnd.randint(0, 30)}", rnd.randint(0, 5000)) for i in range(3000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7, "doc_id")


def test_counts_slots_and_files(spark, many, tmp_path):
    found = H.write(many, f"{tmp_path}/shards", 7).collect()
    assert max(r["n_rows"] for r in found) - min(r["n_rows"] for r in found) <= 1 and len(found) == 7
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.drop("_shard").exceptAll(many).count() == 0 and back.count() == 3000
    got = H.assign(many, 7).collect()
    for s in range(7):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_every_dimension_prunes(many):
    """A source, a language and a range of lengths open fewer shards than they would in a sort by one column only."""
    found = H.manifest(H.assign(many.where("lang IS NOT NULL"), 32, keep=H.DIMENSIONS), H.DIMENSIONS).collect()
    opened = lambda c, lo, hi: sum(r[f"min_{c}"] <= hi and r[f"max_{c}"] >= lo for r in found) / len(found)
    assert opened("lang", "de", "de") < 0.7
    assert opened("source", "s30", "s30") < 0.7
    assert opened("n_chars", 100, 200) < 0.7


def test_rows_alike_are_spread_and_counted(spark):
    rows = [(1, "same", "en", "s", 4)] * 1000 + [(2, None, None, None, None)] * 3
    got = H.assign(spark.createDataFrame(rows, SCHEMA), 8).collect()
    counts = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert sum(counts) == 1003 and max(counts) - min(counts) <= 1
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] == 2} == {(1, 0)}
