from __future__ import annotations

import random
import re
from collections import Counter

import pytest

pytest.importorskip("loomspark.llm.repetition")
from loomspark.llm import queries as Q  # noqa: E402
from loomspark.llm import repetition as R  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_cover(words: list, k: int) -> int:
    windows = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    marked = set()
    for i in range(len(words) - k + 1):
        if windows[tuple(words[i : i + k])] > 1:
            marked |= set(range(i, i + k))
    return len(marked)


def brute_longest(words: list) -> int:
    best = 0
    for k in range(1, len(words)):
        if len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)}) < len(words) - k + 1:
            best = k
    return best


def test_spans_against_brute_force():
    rnd = random.Random(1)
    for _ in range(200):
        texts = [rnd.choices("abcdefghijkl"[: rnd.randint(1, 12)], k=rnd.randint(0, 50)) for _ in range(rnd.randint(0, 5))]
        m = R.measure(texts)
        for i, words in enumerate(texts):
            assert m["n_repeat_words"][i] == brute_cover(words, R.WINDOW)
            assert m["n_covered"][i] == brute_cover(words, R.MIN_REPEAT)
            assert m["longest_repeat"][i] == brute_longest(words)


def test_base_columns(spark, tables, edges):
    extra = [(100, (prose(12, 3) + "\n") * 6, "en", "s", 0), (101, prose(300, 4), "en", "s", 0), (102, "#a *b $c\nsame line\nsame line\n\n\n" * 2, "en", "s", 0)]
    docs = edges.select(*[c.split()[0] for c in SCHEMA.split(", ")]).unionByName(spark.createDataFrame(extra, SCHEMA))
    out = {r["doc_id"]: r for r in Q.op6_quality_rules(spark, tables(documents=docs)).collect()}
    for row in docs.where("doc_id IS NOT NULL").collect():
        text, got = row["text"] or "", out[row["doc_id"]]
        words, lines, seen, dup = WORD.findall(text), text.split("\n"), set(), 0
        for line in lines:
            dup += bool(WORD.search(line)) and line in seen
            seen.add(line)
        repeated = brute_cover(words, 8) if len(words) < 2000 else got["n_repeat_words"]
        assert (got["n_words"], got["word_chars"], got["n_symbols"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (got["n_dup_lines"], got["n_repeat_words"]) == (dup, repeated)
        assert got["base_failed"] == (len(words) < 20 or 100 * repeated > 30 * len(words))
        assert not (got["base_failed"] and got["kept"])
    assert out[101]["kept"] and not out[100]["kept"]


def test_a_long_passage_that_comes_twice(spark):
    """It is a small share of a long text, which the base rule lets through."""
    passage = prose(400, 77)
    rows = [(1, f"{prose(3000, 5, 9)} {passage} {prose(2500, 6, 8)} {passage}", "en", "s", 0), (2, f"{prose(3000, 5, 9)} {passage} {prose(2500, 6, 8)}", "en", "s", 0)]
    rows.append((3, rows[1][1] + " " + " ".join(passage.split()[:50]), "en", "s", 0))
    out = {r["doc_id"]: r for r in R.rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(r["base_failed"] for r in out.values())
    assert [out[i]["kept"] for i in (1, 2, 3)] == [False, True, True] and out[1]["longest_repeat"] >= 400
