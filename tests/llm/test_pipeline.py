"""The pipeline against a brute-force version of every stage, in turn and as a whole."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("loomspark.llm.packing")
import public_tokenizers as tok  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402
from loomspark.llm import secrets  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402
from .test_line_dedup import key  # noqa: E402
from .test_simhash import edited, groups, jaccard  # noqa: E402


def corpus() -> list[tuple]:
    rnd = random.Random(21)
    token = lambda: "".join(rnd.choices("0123456789abcdef", k=40))
    base = [prose(150 + 10 * i, 400 + i) for i in range(30)]
    rows = [(i, f"{t}\nAll rights reserved {i % 2}" if i < 24 else t) for i, t in enumerate(base)]
    rows += [(100 + i, edited(t, 1 + i % 8, i)) for i, t in enumerate(base)]
    rows += [(200, base[0]), (201, base[0]), (None, base[1]), (7, prose(90, 999)), (300, None), (301, "123 !!"), (302, "")]
    rows += [(310 + i, f'{prose(60, 700 + i)} password = "{token()}" {prose(20, 800 + i)}') for i in range(4)]
    return [(i, t, "en" if k % 2 else "fr", "s", len(t or "")) for k, (i, t) in enumerate(rows)]


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text) of what the stages before packing leave."""
    kept = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    owners = [i if i is not None else f"nameless {t}" for i, t in kept]
    seen = Counter(k for _, k in {(o, key(x)) for o, (_, t) in zip(owners, kept, strict=True) for x in t.split("\n")} if k)
    kept = [(i, "\n".join(x for x in t.split("\n") if seen[key(x)] < 10)) for i, t in kept]
    near = {(a, b) for a in range(len(kept)) for b in range(a + 1, len(kept)) if kept[a][1] == kept[b][1] or jaccard(kept[a][1], kept[b][1]) >= 0.8}
    root = groups(near, range(len(kept)))
    first = {}
    for n, (i, _) in enumerate(kept):
        place = (i is None, i if i is not None else 0)
        if root[n] not in first or place < first[root[n]][0]:
            first[root[n]] = (place, n)
    kept = [kept[n] for n in sorted(n for _, n in first.values())]
    forest = secrets.ready(tok.path("byte_bpe_50k.tiktoken"))
    return [(i, secrets.masked(t, secrets.scan_texts([t], forest)[0], 0.5, secrets.MASK)) for i, t in kept]


def test_run_against_brute_force(spark, tables):
    rows = corpus()
    out = pipeline.run(spark, tables(documents=spark.createDataFrame(rows, SCHEMA))).collect()
    want = brute(rows)
    assert 30 < len(want) < 60 and sum(secrets.MASK in t for _, t in want) == 4
    tokens = Tokenizer.from_file(tok.path("byte_bpe_50k.json"))
    expected = Counter()
    for i, t in want:
        ids = [*tokens.encode(t, add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            expected[i, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == expected
    for places in (sorted((r["offset"], r["length"]) for r in out if r["sequence_id"] == s) for s in {r["sequence_id"] for r in out}):
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048


@pytest.mark.parametrize("n", [100, 1000, 5000])
def test_near_duplicates_are_found_at_any_length(spark, n):
    """No pair at 0.8 or above stays, no pair below it goes: recall and precision are 1 here at 100, 1,000 and 5,000 words."""
    rows = []
    for i in range(24):
        text = prose(n, 3000 + i)
        rows += [(2 * i, text, "en", "s", 0), (2 * i + 1, edited(text, max(1, n * (8 + i) // 900), i), "en", "s", 0)]
    out = {r["doc_id"] for r in dict(pipeline.STAGES)["near_dedup"](spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    close = [jaccard(rows[k][1], rows[k + 1][1]) >= 0.8 for k in range(0, len(rows), 2)]
    assert 3 < sum(close) < 24
    assert [2 * k + 1 not in out for k in range(24)] == close and all(2 * k in out for k in range(24))
