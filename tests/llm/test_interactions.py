"""Filter audit: every order and step against plain counting, hot parts and copies, edges."""

from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
import pytest

pytest.importorskip("loomspark.llm.queries")
from loomspark.llm import interactions as I  # noqa: E402, E741
from loomspark.llm import queries as Q  # noqa: E402

from .conftest import EDGES, SCHEMA, prose  # noqa: E402

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def brute(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    rows = {}
    for doc, text, _, source, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        if len(words) < 200:
            fails += "A"
        if 100 * len(set(words)) < 50 * len(words):
            fails += "B"
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails += "C"
        if re.search("[#$%&*|]", text):
            fails += "D"
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, *_ in docs):
            fails += "E"
        rows.setdefault(source or "", []).append((fails, doc in good, doc in toxic))
    out = []
    for part, each in rows.items():
        worth = dict.fromkeys("ABCDE", 0)
        found = []
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                alive = [r for r in each if not before & set(r[0])]
                removed = [r for r in alive if f in r[0]]
                worth[f] += len(removed)
                found.append((part, order, step, len(alive) - len(removed), len(removed), sum(f in r[0] for r in each) - len(removed), sum(r[0] == f for r in each), sum(r[1] for r in removed), sum(r[2] for r in removed)))
        out += [(*x, worth[x[1][x[2] - 1]]) for x in found]
    return sorted(out)


def run(spark, tables, docs, labels):
    folder = tables(documents=spark.createDataFrame(docs, SCHEMA).repartition(3), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return sorted(tuple(r[c] for c in COLUMNS) for r in Q.op13_filter_audit(spark, folder).collect())


def test_edges_and_copies(spark, tables):
    rnd = random.Random(2)
    docs = list(EDGES)
    docs += [(100 + i, rnd.choice(["copy of all", prose(250, i % 7), prose(220, i).upper(), prose(30, i) + "#"]), "en", rnd.choice(["hot", "hot", "b", None]), 0) for i in range(120)]
    docs += [(100, "copy of all", "en", "b", 0), (100, "copy of all", "en", "hot", 0)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(90, 180)] + [(4, 1, 1), (None, 1, 1), (100, 1, 0), (100, 0, 1)]
    assert run(spark, tables, docs, labels) == brute(docs, labels)


def test_hot_part_and_many_parts(spark, tables):
    docs = [(i, "copy" if i % 3 == 0 else f"text {i}", "en", "hot" if i % 3 == 0 else f"p{i}", 0) for i in range(60)]
    assert run(spark, tables, docs, []) == brute(docs, [])


def test_empty(spark, tables):
    assert run(spark, tables, [], []) == []


@pytest.mark.parametrize("seed", range(10))
def test_packed_counts(seed):
    rnd = np.random.default_rng(seed)
    n, parts = int(rnd.integers(1, 700)), int(rnd.integers(1, 9))
    part = np.concatenate([np.arange(parts), rnd.integers(0, parts, n)])
    fails, good, toxic = rnd.integers(0, 32, len(part)), rnd.random(len(part)) < 0.5, rnd.random(len(part)) < 0.1
    got = I.subset_counts(part, fails, good, toxic, parts, 5)
    for p in range(parts):
        for s in range(32):
            own = (part == p) & (fails & s == 0)
            assert got[p, :, s].tolist() == [own.sum(), (own & good).sum(), (own & toxic).sum()]
