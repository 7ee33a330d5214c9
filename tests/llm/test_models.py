"""Held-out accuracy of the fitted operators, and what happens without anything to learn from."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("loomspark.llm.quality")
from loomspark.llm import langid as L  # noqa: E402
from loomspark.llm import quality as G  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

from .conftest import SCHEMA, prose  # noqa: E402


def junk(text: str, kind: int) -> str:
    words = text.split()
    return [" ".join(w.upper() + "!!" for w in words), " ".join(w + "###" for w in words), " | ".join(words), " ".join([words[0]] * 60 + [words[1]] * 40)][kind % 4]


def test_quality_held_out(spark, tables):
    rows = [(i, junk(prose(80, i), i) if i % 5 == 0 else prose(80 + i % 60, i), "en", "s", 0) for i in range(600)]
    labels = [(i, int(i % 5 > 0), 0) for i in range(600)]
    sf = tables(documents=spark.createDataFrame(rows, SCHEMA), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = {r["doc_id"]: r for r in Q.op1_quality(spark, sf).collect()}
    held = [i for i in out if out[i]["held_out"]]
    assert {i for i in out if zlib.crc32(str(i).encode()) % 3 == 1} == set(held)
    assert np.mean([out[i]["predicted"] == (i % 5 > 0) for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())


def naive_features(text: str | None) -> list[float]:
    """The features by their meaning, one at a time."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(G.FEATURES)
    n, lines = len(words), [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in raw)
    count = lambda chars: sum(raw.count(bytes([c])) for c in chars)
    pairs = [(a, b) for a, b in zip(words, words[1:], strict=False)]
    return [
        np.log(1 + n), sum(65 <= c <= 90 for c in raw) / max(1, letters), sum(48 <= c <= 57 for c in raw) / len(raw), count(b"#*$%&<>=^~{}[]_\\") / n, count(b"!?") / n, count(b"|") / n, sum(c >= 128 for c in raw) / len(raw),
        sum(map(len, words)) / n, np.log(1 + max(map(len, words))), len(set(words)) / n, max(words.count(w) for w in set(words)) / n, sum(a == b for a, b in pairs) / n, len(set(pairs)) / (n - 1) if n > 1 else 1.0,
        1 - len(set(lines)) / len(lines), sum(len(w) <= 3 for w in words) / n, np.log(1 + len(lines)),
    ]


def test_quality_against_tables_read_one_by_one(spark, edges):
    texts = [r["text"] for r in edges.collect()] + [junk(prose(60, i), i) for i in range(8)]
    rng = np.random.default_rng(3)
    x = np.concatenate([G.features([prose(30 + i, i) for i in range(80)]), G.features([junk(prose(30 + i, i), i) for i in range(80)])])
    model = G.Additive(x, (rng.random(160) < np.r_[np.full(80, 0.9), np.full(80, 0.1)]).astype(float), rounds=20)
    got = model(G.features(texts))
    for text, score in zip(texts, got, strict=True):
        own = naive_features(text)
        at = [sum(e < v for e in edges_) for edges_, v in zip(model.edges, own, strict=True)]
        total = model.base + sum(t[k] for t, k in zip(model.tables, at, strict=True)) + sum(t[at[a], at[b]] for (a, b), t in model.pairs.items())
        assert abs(1 / (1 + np.exp(-max(-30, min(30, total)))) - score) < 1e-9
    assert len(model.pairs) == G.PAIRS


def test_shallow_tree_takes_the_best_cuts():
    rng = np.random.default_rng(5)
    for _ in range(30):
        grad, hess = rng.normal(size=7), rng.random(7) + 0.1
        score = lambda a, b: grad[a:b].sum() ** 2 / (hess[a:b].sum() + G.SHRINK)
        first = max(range(1, 7), key=lambda c: score(0, c) + score(c, 7) - score(0, 7))
        value = G.split_leaves(grad, hess, leaves=2)
        if score(0, first) + score(first, 7) - score(0, 7) > 1e-9:
            assert np.allclose(value[:first], grad[:first].sum() / (hess[:first].sum() + G.SHRINK)) and np.allclose(value[first:], grad[first:].sum() / (hess[first:].sum() + G.SHRINK))


def test_quality_with_clashing_columns(spark, tables):
    rows = [(i, prose(40, i) if i % 2 else junk(prose(40, i), i), "en", "s", 0) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1.5) for c in ("_id", "_y", "x", "score", "quality", "held_out")})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(3, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").withColumns({c: F.lit("own") for c in ("text", "_id", "_y", "predicted")})
    out = Q.op1_quality(spark, tables(documents=docs, labels=labels))
    assert out.count() == 120 and out.columns == ["doc_id", "held_out", "score", "predicted"]


def test_quality_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(G.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = G.Additive(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert (((model(x[3000:]) >= 0.5) == y[3000:]).mean()) > 0.9


def test_quality_without_labels(spark, tables):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 0), (2, None, "en", "s", 0)], SCHEMA)
    out = Q.op1_quality(spark, tables(documents=docs, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))).collect()
    assert {r["score"] for r in out} == {0.5}


def test_language_held_out(spark, tables):
    rows = [(i, prose(60, i, vocab=i % 3), f"l{i % 3}", "s", 0) for i in range(300)] + [(900, "12 34", "l1", "s", 0), (901, None, None, "s", 0)]
    out = {r["doc_id"]: r for r in Q.op9_language_id(spark, tables(documents=spark.createDataFrame(rows, SCHEMA))).collect()}
    held = [i for i in range(300) if out[i]["held_out"]]
    assert {i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2} == set(held)
    assert np.mean([out[i]["lang_pred"] == f"l{i % 3}" for i in held]) > 0.98
    assert out[900]["lang_pred"] == out[901]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in out.values())


def naive_language(counts: list[tuple], text: str | None) -> tuple[str, float]:
    """Word first, then ever shorter n-grams, straight from the counts."""
    langs = sorted({lang for lang, _, _ in counts})
    words = [w for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()]
    if not words or not langs:
        return "und", 0.0

    def tables(k: int) -> dict:
        found: dict = {}
        for lang, w, n in counts:
            padded = f"^{w}$" if k > 1 else w
            for g in [w] if k == 0 else [padded[i : i + k] for i in range(len(padded) - k + 1)]:
                found.setdefault(g, dict.fromkeys(langs, 0.0))[lang] += n
        table = {g: {x: L.FLOOR + c for x, c in by.items()} for g, by in found.items()}
        sums = {x: sum(by[x] for by in table.values()) for x in langs}
        return {g: [np.log(by[x] / max(1, sums[x])) for x in langs] for g, by in table.items()}

    known = {k: tables(k) for k in range(L.LONGEST_GRAM + 1)}
    total = np.zeros(len(langs))
    for w in words:
        row = known[0].get(w)
        for k in range(L.LONGEST_GRAM, 0, -1):
            if row is not None:
                break
            padded = f"^{w}$" if k > 1 else w
            hits = [known[k][g] for i in range(len(padded) - k + 1) if (g := padded[i : i + k]) in known[k]]
            row = np.sum(hits, 0) / k * L.BACKOFF ** (L.LONGEST_GRAM + 1 - k) if hits else None
        if row is not None:
            total += np.array(row) - max(row)
    margin = (total.max() - sorted(total)[-2]) / np.sqrt(len(words))
    return langs[int(total.argmax())], float(margin / (1 + margin))


def made(counts: list[tuple]) -> "L.Model":
    """A model straight from (language, word, n)."""
    langs = sorted({lang for lang, _, _ in counts})

    def table(cut):
        seen: dict = {}
        for lang, w, n in counts:
            for g in cut(w):
                seen.setdefault(g, [0] * len(langs))[langs.index(lang)] += n
        return L.Table(L.hashed(seen), np.array(list(seen.values()), float).reshape(-1, len(langs)))

    return L.Model(langs, table(lambda w: [w]), {k: table(lambda w, k=k: L.grams(w, k)) for k in range(1, L.LONGEST_GRAM + 1)})


def test_language_against_a_naive_model():
    rnd = random.Random(8)
    counts = [(f"l{k}", w, rnd.randint(1, 9)) for k in range(3) for w in rnd.sample(prose(300, 0, vocab=k).lower().replace(".", "").split(), 40)]
    counts = list({(lang, w): (lang, w, n) for lang, w, n in counts}.values())
    model = made(counts)
    texts = [prose(rnd.randint(1, 30), i, vocab=i % 5) for i in range(60)] + ["zzz qqq", "12", None, "é", "ta"]
    for text, (lang, score) in zip(texts, model.predict(texts), strict=True):
        want, share = naive_language(counts, text)
        assert (lang == want or score < 1e-4) and abs(score - share) < 1e-4, text


def test_language_learns_every_word_of_its_sample(spark):
    words = [f"w{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100 % 10]}{'xyzuv'[i // 1000]}" for i in range(5000)]
    docs = spark.createDataFrame([(i, " ".join(words[50 * i : 50 * i + 50]), "l", "s", 0) for i in range(100)] + [(1000 + i, "q", f"rare {i}", "s", 0) for i in range(30)], SCHEMA)
    model = L.learn(docs)
    assert (model.words.find(L.hashed(words)) >= 0).all() and len(model.languages) == 31


def test_the_sample_is_bounded_by_rows_bytes_and_size(spark, monkeypatch):
    """One id on all rows is drawn row by row; long texts count by their bytes; a model beyond its bound is made of less."""
    words = ["".join(random.Random(i).choices("abcdefgh", k=9)) for i in range(4000)]
    docs = spark.createDataFrame([(7, " ".join(words[10 * i : 10 * i + 10]), "l", "s", 0) for i in range(400)], SCHEMA)
    known = lambda **k: int((L.learn(docs, **k).words.find(L.hashed(words)) >= 0).sum())
    assert known() == 4000
    assert 500 < known(sample_docs=100) < 1500
    assert 500 < known(sample_bytes=400 * 100 // 4) < 1500
    monkeypatch.setattr(L, "MODEL_BYTES", 100_000)
    assert 0 < known() < 3000


def test_counts_of_spark_and_of_python_agree(spark):
    counts = [("a", "tarota", 5), ("a", "é", 2), ("b", "ta", 3), ("b", "漢字語", 1), ("b", "x", 1)]
    df = spark.createDataFrame(counts, "lang string, word string, n long")
    each, want = L.gram_table(df), made(counts)
    found = [L.counted(df, F.col("word"), ["a", "b"])] + [L.counted(each.where(F.col("size") == k), F.col("gram"), ["a", "b"]) for k in range(1, L.LONGEST_GRAM + 1)]
    for one, other in zip(found, [want.words, *(want.grams[k] for k in range(1, L.LONGEST_GRAM + 1))], strict=True):
        assert one.keys.tolist() == other.keys.tolist() and np.allclose(one.logs, other.logs)


def test_language_backs_off_to_shorter_grams():
    model = made([("a", "tarota", 5), ("b", "milenmi", 5)])
    assert [x[0] for x in model.predict(["tarotatar", "milenx", None, "123"])] == ["a", "b", "und", "und"]
    assert model.words.find(L.hashed(["tarotatar"])).tolist() == [-1]
    none = L.Table(np.zeros(0, np.int64), np.zeros((0, 0)))
    assert L.Model([], none, dict.fromkeys(range(1, L.LONGEST_GRAM + 1), none)).predict(["anything"]) == [("und", 0.0)]


def test_scores_rank_texts_that_are_all_sure():
    model = made([("a", w, 9) for w in ("tarota", "sorve", "kadun")] + [("b", w, 9) for w in ("milenmi", "pelix", "lenmi")])
    scores = [s for _, s in model.predict([" ".join(["tarota"] * n) for n in (1, 10, 1000, 100_000)])]
    assert scores == sorted(set(scores)) and scores[-1] < 1
