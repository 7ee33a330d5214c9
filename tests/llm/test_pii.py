from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

pytest.importorskip("loomspark.llm.pii")
from loomspark.llm import pii  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

from .conftest import SCHEMA  # noqa: E402


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


digits = lambda m: re.sub("[^0-9]", "", m)
RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def brute(text: str | None) -> tuple[str, list[int]]:
    found = sorted((m.start(), r, k, m.end()) for r, (k, p, ok) in enumerate(RULES) for m in re.finditer(p, text or "") if ok(m.group()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in found), [sum(x[2] == k for x in found) for k, *_ in RULES]


def test_base_against_brute_force(spark, tables, edges):
    rnd = random.Random(1)
    bits = ["a@b.c", "x_y@mail.example.com", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-1234", "+12", "@", ".", " ", "é", "😀", "-", "0", "9" * 30, "\n", "_d@e.f", "00255.1.1.1"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 12))) for _ in range(400)] + ["1" * 50_000, "a" * 50_000 + "@", "9 " * 20_000]
    rows = [(100 + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    docs = edges.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(rows, SCHEMA))
    out = {r["doc_id"]: r for r in Q.op7_pii(spark, tables(documents=docs)).collect()}
    for i, t in [(r["doc_id"], r["text"]) for r in docs.where("doc_id IS NOT NULL").collect()]:
        spans, counts = brute(t)
        got = out[i]
        assert [got[f"n_{k}"] for k, *_ in RULES] == counts, t[:80]
        assert got["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert [s for s in got["spans"].split(",") if s and not s.startswith("term")] == [s for s in spans.split(",") if s]


WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def corpus():
    """Letters in which names stand far from their addresses; near copies that share rare words with an address."""
    rnd = random.Random(3)
    common = [f"common{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rare = [f"rare{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    people = ["Quimby", "O'Brien", "Jean-Luc", "Lee", "jdoe42", "Zoë", "Ann", "Bo"]
    rows = []
    for i in range(700):
        words = [rnd.choice(rare) if rnd.random() < 0.05 else rnd.choice(common) for _ in range(70)]
        who = i // 12 if i % 12 < 3 else None
        if who is not None and who < len(people):
            words[2] = people[who] + ","
            words.append(f"P{who}.X+tag{i}@corp.example.com" if i % 2 else f"p{who}.x@corp.example.com")
            if who % 2:
                words += [rnd.choice(common), f"+1 (499) 555-650{who} {rnd.choice(common)} 1.2.3.{who} {rnd.choice(common)}"]
        if i == 99:
            words.append("Quimby was here: quimby, é QUIMBY; not quimbyx")
        if i % 9 == 4:
            words.append("mail help@corp.example.com")
        if i % 9 in (5, 6, 7):
            words.append("mail write help")
        rows.append((i, " ".join(words), "en", "s", 0))
    single = rows[7][1] + " only@one.example unique"
    rows += [(1000 + k, single + f" end{k}", "en", "s", 0) for k in range(6)] + [(2000 + k, "copy of Zanzibar z@z.example 5", "en", "s", 0) for k in range(40)]
    return rows


def normal(kind: str, found: str) -> str:
    if kind == "email":
        return "email:" + re.sub(r"\+[^@]*@", "@", found.lower())
    return kind + ":" + (".".join(str(int(x)) for x in found.split(".")) if kind == "ip" else digits(found))


def brute_terms(texts: list[str]) -> dict[str, float]:
    """Shares by definition, over every pair of entity and word."""
    texts = sorted(set(texts))
    n, holders, terms = len(texts), {}, {}
    windows = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (t.lower().split() for t in texts)]
    for i, t in enumerate(texts):
        for kind, p, ok in RULES:
            for m in re.finditer(p, t):
                if ok(m.group()):
                    holders.setdefault(normal(kind, m.group()), set()).add(i)
        for w in {x.lower() for x in WORD.findall(t)}:
            if len(w) >= 2:
                terms.setdefault(w, set()).add(i)
    out: dict[str, float] = {}
    for own in holders.values():
        for w, at in terms.items():
            both = sorted(own & at)
            if any(not windows[a] & windows[b] for k, a in enumerate(both) for b in both[k + 1 :]):
                share, p = 0.0, len(own) / n
                if p < 1:
                    share = 1 - math.log((len(both) + p) / (len(at) + 1)) / math.log(p)
                if share >= pii.DISCLOSURE:
                    out[w] = max(out.get(w, 0), share)
    return out


def brute_spans(text: str, terms: dict[str, float]) -> list[tuple]:
    base = [(m.start(), r, k, m.end(), m.group()) for r, (k, p, ok) in enumerate(RULES) for m in re.finditer(p, text) if ok(m.group())]
    words = [(m.start(), 4, "term", m.end(), m.group()) for m in WORD.finditer(text) if m.group().lower() in terms]
    return sorted(base + [w for w in words if not any(w[0] < b[3] and b[0] < w[3] for b in base)])


def brute_clean(text: str, spans: list[tuple], terms: dict[str, float]) -> str:
    merged: list[list] = []
    for a, _, kind, b, found in spans:
        shape = "[number]" if any(map(str.isnumeric, found)) else "[name]" if found[:1].isupper() else "[word]"
        instead = f"[{kind}]" if kind != "term" else "" if terms[found.lower()] >= pii.REMOVE else shape
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, instead])
    for a, b, instead in reversed(merged):
        text = text[:a] + instead + text[b:]
    return text


def test_disclosing_terms_against_brute_force(spark):
    rows = corpus()
    terms = brute_terms([t for _, t, *_ in rows])
    assert {"quimby", "o'brien", "jean-luc", "lee", "jdoe42", "zoë", "ann", "bo"} <= set(terms)
    assert not {"unique", "only", "zanzibar", "write", "mail", "help"} & set(terms)
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {r["doc_id"]: r for r in pii.report(docs).collect()}
    clean = {r["doc_id"]: r["clean"] for r in pii.sanitise(docs).select("row.doc_id", "clean").collect()}
    for i, text, *_ in rows:
        spans = brute_spans(text, terms)
        assert out[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, k, b, _ in spans), text
        assert out[i]["n_term"] == sum(x[2] == "term" for x in spans)
        assert clean[i] == brute_clean(text, spans, terms)
        assert out[i]["sanitised_sha256"] == hashlib.sha256(clean[i].encode()).hexdigest()
    assert sum(r["n_term"] for r in out.values()) >= 3 * 8 + 3
    assert "[name]" in clean[0] and "Quimby" not in clean[0] and "quimby," not in clean[99] and "quimbyx" in clean[99]


def test_names_behind_other_addresses(spark):
    """A term counts wherever it stands in a text: far from its entity, with other entities in between."""
    filler = lambda i: " ".join(f"w{i}x{k}" for k in range(200))
    rows = [(i, f"Dear Marlowe, {filler(i)} a{i}@b.example {filler(1000 + i)} chandler@la.example", "en", "s", 0) for i in range(4)]
    rows += [(100 + i, filler(2000 + i) + " dear all", "en", "s", 0) for i in range(300)]
    out = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(out[i].startswith("term:5:12,") and out[i].count("term") == 1 for i in range(4))


def test_many_near_copies_disclose_nothing(spark):
    """Sixty texts that are edits of one share an address and all their rare words; one letter of its own does not."""
    rnd = random.Random(5)
    base = [f"rare{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(2):
            words[rnd.randrange(120)] = f"own{i}x{rnd.random()}"
        rows.append((i, " ".join(words) + " mail hidden@one.example", "en", "s", 0))
    rows += [(100 + i, " ".join(f"f{i}x{k}" for k in range(60)), "en", "s", 0) for i in range(300)]
    assert all(r["n_term"] == 0 for r in pii.report(spark.createDataFrame(rows, SCHEMA)).collect())
    rows.append((500, " ".join(f"other{k}" for k in range(60)) + " rare7 hidden@one.example", "en", "s", 0))
    out = {r["doc_id"]: r["n_term"] for r in pii.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[500] == 1 and sum(out[i] == 1 for i in range(60)) >= 57 and out[100] == 0


def test_sanitise(spark, edges):
    assert pii.sanitise(edges).count() == edges.count()
    text = ("é" * 5000 + " a@b.example ") * 3 + "4111 1111 1111 1111" + "x" * 9000
    docs = spark.createDataFrame([(1, text, "en", "s", 0), (1, None, "en", "s", 0), (1, "1.2.3.4@b.example", "en", "s", 0)], SCHEMA)
    out = {r["clean"] for r in pii.sanitise(docs).collect()}
    assert out == {brute_clean(text, brute_spans(text, {}), {}), None, "[email]"}
