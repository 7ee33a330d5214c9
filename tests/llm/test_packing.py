from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("loomspark.llm.packing")
import public_tokenizers as tok  # noqa: E402

from loomspark.llm import packing as P  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402

FILES = (tok.path("byte_bpe_50k.json"), tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)


def brute_fullest(counts: dict[int, int], window: int) -> int:
    first = max(counts)
    sums, left = {first}, dict(counts)
    left[first] -= 1
    for length, n in left.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= window}
    return max(sums)


def test_fullest_is_fullest():
    rnd = random.Random(3)
    for _ in range(200):
        counts = {rnd.randint(1, 40): rnd.randint(1, 4) for _ in range(rnd.randint(1, 6))}
        window = rnd.randint(max(counts), 60)
        chosen = P.fullest(counts, window)
        assert sum(chosen) == brute_fullest(counts, window)
        assert all(chosen.count(x) <= counts[x] for x in chosen)


def test_places_are_gapless():
    rnd = random.Random(4)
    histogram = {rnd.randint(1, 2048): rnd.randint(1, 300) for _ in range(400)}
    places, seen = P.Places(P.plan(histogram)), {}
    for length, n in histogram.items():
        sequence, offset = places(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            seen.setdefault(s, []).append((o, length))
    for pieces in seen.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048


def test_ids_are_those_of_tokenizers():
    rnd = random.Random(5)
    letters = "abc ABC\n\t  '’.,0189éüñ漢字😀\x1c\x85\xa0"
    texts = ["", None, "<|endoftext|> a<|endoftext|>", "x" * 5000, " " * 3000, *("".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(400))]
    assert P.ids_of(texts, *FILES) == P.ids_of(texts, FILES[0], None, None)


def test_packing_is_whole(spark, tables):
    rows = [(i, prose(random.Random(i).randint(0, 900) if i % 7 else 4000, i), "en", "s", 0) for i in range(120)] + [(500 + i, "same text", "en", "s", 0) for i in range(80)]
    out = Q.op2_packing(spark, tables(documents=spark.createDataFrame(rows, SCHEMA))).toPandas()
    ids = {i: P.ids_of([t], FILES[0], None, None)[0] + [1] for i, t, *_ in rows}
    for doc, pieces in out.sort_values("start").groupby("doc_id"):
        own, at = ids[doc], 0
        for p in pieces.itertuples():
            assert p.start == at and p.doc_tokens == len(own)
            assert p.ids_crc32 == zlib.crc32(np.array(own[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(own)
    assert set(out.doc_id) == set(ids)
    padding = 0
    for _, pieces in out.sort_values("offset").groupby("sequence_id"):
        assert (pieces.offset.to_numpy() == np.r_[0, np.cumsum(pieces.length.to_numpy())[:-1]]).all()
        n = int(pieces.length.sum())
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding < 0.02 * sum(map(len, ids.values())) + 2048
