from __future__ import annotations

import hashlib
import random

import pytest

pytest.importorskip("loomspark.llm.bpe")
import public_tokenizers as tok  # noqa: E402
import tiktoken  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from loomspark.llm import bpe  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

OWN = bpe.Encoder(tok.path("byte_bpe_multi_50k.tiktoken"), tok.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_same_ids_and_round_trip(text):
    ids = OWN.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


def test_all_white_space():
    text = "".join(chr(c) + "a " for c in range(0x3100))
    assert OWN.encode(text) == THEIRS.encode_ordinary(text)


@pytest.mark.parametrize("n", [1, 4, 127, 130, 2000, 20000])
def test_long_words(n):
    rnd = random.Random(n)
    for text in ("a" * n, "aab" * n, "".join(rnd.choices("abet", k=n)), "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(n)), "é" * n, " " * n, "0" * n):
        assert OWN.encode(text) == THEIRS.encode_ordinary(text)


def test_both_ways_of_merging_agree(monkeypatch):
    """The vocabulary is proper, so all merges of a pair may be made at once; one at a time gives the same ids."""
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abetaé漢 1", k=rnd.randint(1, 300))) for _ in range(60)]
    together = [OWN.encode(t) for t in texts]
    assert OWN.rising
    monkeypatch.setattr(OWN, "rising", False)
    assert [OWN.encode(t) for t in texts] == together


def test_query(spark, tables, edges):
    out = {r["doc_id"]: r for r in Q.op5_bpe(spark, tables(documents=edges)).collect() if r["doc_id"] is not None}
    for row in edges.where("doc_id IS NOT NULL").collect():
        ids, got = THEIRS.encode_ordinary(row["text"] or ""), out[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_memory_is_bounded(monkeypatch):
    own = bpe.Encoder(tok.path("byte_bpe_multi_50k.tiktoken"), tok.PATTERN)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    for k in range(5):
        own.learn({f"word{k}{i}" for i in range(8)})
        assert len(own.known) <= 10
