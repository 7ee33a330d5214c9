"""Operators over tables: NULL logic of matching, trees, states, files, streams."""

from __future__ import annotations

import random
import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomspark.operators import bitmaps as B
from loomspark.operators import containment as K
from loomspark.operators import engagement as E
from loomspark.operators import guarded
from loomspark.operators import listing as L
from loomspark.operators import matching as M
from loomspark.operators import notices as N
from loomspark.operators import ranks
from loomspark.operators import reports as R
from loomspark.operators import tree
from loomspark.operators import writes as W
from loomspark.sources import adapters, charset, files, sqldump
from loomspark.streaming import views

PROFILE = {
    "id": "long", "university_name": "string", "school_name": "string", "school_location": "string", "school_category": "string", "admission_type": "string", "enrollment_status": "string", "academic_year": "int",
    "gpa": "double", "gpa_last_semester": "double", "income_level": "int", "household_size": "int", "gender": "string", "birth_date": "date", "address": "string", "nationality": "string", "special_info": "array<string>",
    "parent_occupation": "array<string>", "military_status": "string", "department": "string", "department_name": "string", "college_name": "string", "double_major_name": "string", "double_major_department": "string",
    "double_major_college_name": "string", "org_unit_id": "long", "double_major_org_unit_id": "long", "field_code": "string", "double_field_code": "string", "semester": "int", "credits_last_semester": "int",
    "parents_cohabitation": "boolean", "parent_address": "string",
}
OFFER = {
    "id": "long", "is_verified": "boolean", "apply_end_date": "date", "qual_university": "array<string>", "qual_school_location": "array<string>", "qual_school_category": "array<string>", "qual_admission_type": "array<string>",
    "qual_enrollment_status": "array<string>", "qual_academic_year": "array<int>", "qual_major": "array<string>", "qual_field_codes": "array<string>", "qual_gpa_min": "double", "qual_gpa_last_semester_min": "double",
    "qual_income_level_min": "int", "qual_income_level_max": "int", "qual_household_size_max": "int", "qual_gender": "string", "qual_age_min": "int", "qual_age_max": "int", "qual_region": "array<string>", "qual_nationality": "string",
    "qual_special_info": "array<string>", "qual_parent_occupation": "array<string>", "qual_military_status": "string", "is_targeted": "boolean", "target_hit": "boolean", "qual_min_academic_year": "int", "qual_min_semester": "int",
    "qual_credits_last_semester_min": "int", "qual_parents_cohabitation": "boolean", "qual_parent_region": "array<string>",
}


def frame(spark, types: dict, rows: list[dict]):
    return spark.createDataFrame([tuple(r.get(k) for k in types) for r in rows], ", ".join(f"{k} {t}" for k, t in types.items()))


OPEN = {"is_verified": True, "apply_end_date": date(9999, 12, 31)}


def passes(spark, profile: dict, offer: dict, version: str = M.NEWEST) -> bool:
    found = M.match(frame(spark, PROFILE, [{"id": 1} | profile]), frame(spark, OFFER, [{"id": 1} | OPEN | offer]), "2024-03-01", version)
    return found.count() == 1


CASES = [
    ({}, {}, True),
    ({}, {"is_verified": None}, False),
    ({}, {"apply_end_date": date(2024, 2, 29)}, False),
    ({}, {"apply_end_date": date(2024, 3, 1)}, True),
    ({}, {"qual_university": []}, True),
    ({}, {"qual_university": ["U"]}, False),
    ({"school_name": "U"}, {"qual_university": ["U"]}, True),
    ({"enrollment_status": "신입생"}, {"qual_enrollment_status": ["재학"]}, True),
    ({"enrollment_status": "재학", "academic_year": 1}, {"qual_enrollment_status": ["신입생"]}, True),
    ({"enrollment_status": "재학", "academic_year": 2}, {"qual_enrollment_status": ["신입생"]}, False),
    ({"enrollment_status": "재학", "academic_year": 4}, {"qual_enrollment_status": ["졸업예정"]}, True),
    ({"enrollment_status": "수료"}, {"qual_enrollment_status": ["졸업예정"]}, True),
    ({}, {"qual_enrollment_status": ["재학"]}, False),
    ({"gpa": 3.0}, {"qual_gpa_min": 3.0}, True),
    ({}, {"qual_gpa_min": 3.0}, False),
    ({"income_level": 0}, {"qual_income_level_max": 5}, False),
    ({"income_level": 5}, {"qual_income_level_max": 5}, True),
    ({"income_level": 2}, {"qual_income_level_max": 5, "qual_income_level_min": 3}, False),
    ({"birth_date": date(2004, 2, 29)}, {"qual_age_min": 20}, True),
    ({"birth_date": date(2004, 3, 2)}, {"qual_age_min": 20}, False),
    ({}, {"qual_age_max": 20}, False),
    ({"address": "Seoul Gangnam"}, {"qual_region": ["seoul"]}, True),
    ({"special_info": ["다자녀"]}, {"qual_special_info": ["다자녀", "x"]}, True),
    ({}, {"qual_special_info": ["x"]}, False),
    ({"department": "컴퓨터공학과"}, {"qual_major": ["컴퓨터공학"]}, True),
    ({"department": "100%"}, {"qual_major": ["1000 units"]}, True),
    ({"department": "물리학과"}, {"qual_major": ["컴퓨터공학"]}, False),
    ({"field_code": "공학"}, {"qual_field_codes": ["공학"], "qual_major": ["none"]}, True),
    ({"field_code": "공학", "department": "a"}, {"qual_field_codes": ["자연"], "qual_major": ["a"]}, False),
    ({"org_unit_id": 5}, {"is_targeted": True, "target_hit": False, "qual_major": ["a"]}, False),
    ({"org_unit_id": 5}, {"is_targeted": True, "target_hit": True}, True),
    ({"department": "a"}, {"is_targeted": True, "target_hit": False, "qual_major": ["a"]}, True),
]


def test_matching(spark):
    """Each case's profile against its offer, all in one run."""
    profiles = frame(spark, PROFILE, [{"id": i} | p for i, (p, _, _) in enumerate(CASES)])
    offers = frame(spark, OFFER, [{"id": i} | OPEN | s for i, (_, s, _) in enumerate(CASES)])
    found = {r["id"] for r in M.match(profiles, offers, "2024-03-01", on=[("id", "id")]).select("p.id").collect()}
    assert found == {i for i, (_, _, want) in enumerate(CASES) if want}


def test_index_finds_the_same_pairs(spark):
    profiles = frame(spark, PROFILE, [{"id": i, "university_name": f"U{i % 4}" if i % 5 else None, "school_name": f"U{i % 3}" if i % 2 else None, "gender": "FM"[i % 2]} for i in range(40)])
    offers = frame(spark, OFFER, [OPEN | {"id": i, "qual_university": [None, [], ["U1"], ["U0", "U1", "U0"], ["U9"]][i % 5], "qual_gender": ["F", None][i % 2]} for i in range(30)])
    pairs = lambda **k: sorted((r["a"], r["b"]) for r in M.match(profiles, offers, "2024-03-01", **k).select(F.col("p.id").alias("a"), F.col("s.id").alias("b")).collect())
    assert pairs() == pairs(index=()) and len(pairs()) > 100
    assert pairs(on=[("gender", "qual_gender")]) == pairs(index=(), on=[("gender", "qual_gender")])


def test_index_of_all_predicates_with_a_hot_value(spark, monkeypatch):
    """Random profiles, a third of them alike in most values, and offers with any restrictions: the pairs that pass every
    predicate, by an equi join alone, whose keys have few profiles each."""
    monkeypatch.setattr(M, "CHUNK", 17)
    rnd = random.Random(11)
    some = lambda *x: rnd.choice([None, *x])
    def person(i):
        hot = i % 3 == 0
        return {
            "id": i, "university_name": "U0" if hot else some("U0", "U1", "U2"), "school_name": some("U1", "U3"), "school_location": some("A", "B"), "school_category": some("c", "d"), "admission_type": some("x", "y"),
            "enrollment_status": "재학" if hot else some("재학", "신입생", "졸업예정", "휴학", "수료"), "academic_year": 1 if hot else some(1, 2, 3, 4, 5), "gpa": 3.0 if hot else some(1.5, 2.5, 3.0, 4.2), "gpa_last_semester": some(2.0, 3.1),
            "income_level": some(0, 1, 5, 10), "household_size": some(1, 4, 7), "gender": some("F", "M"), "birth_date": some(date(2000, 2, 29), date(2004, 3, 2), date(1980, 1, 1)), "address": some("Seoul", "Busan"), "nationality": some("KR", "X"),
            "special_info": some([], ["s1"], ["s1", "s2"]), "parent_occupation": some(["o1"], ["o2", "o3"]), "military_status": some("done"), "department": some("math", "law"),
        }
    def offer(i):
        rare = lambda *x: rnd.choice([None] * 4 + list(x))
        return OPEN | {
            "id": i, "qual_university": rare([], ["U0"], ["U1", "U3", "U1"], ["U9"]), "qual_school_location": rare(["A"], ["A", "B"]), "qual_school_category": rare(["c"]), "qual_admission_type": rare(["x", "y"]),
            "qual_enrollment_status": rare(["재학"], ["신입생", "휴학"], ["졸업예정"]), "qual_academic_year": rare([1, 2], [4]), "qual_major": rare(["math"]), "qual_gpa_min": rare(2.5, 3.0, 9.0), "qual_gpa_last_semester_min": rare(2.1),
            "qual_income_level_min": rare(0, 2), "qual_income_level_max": rare(4, 8), "qual_household_size_max": rare(3), "qual_gender": rare("F"), "qual_age_min": rare(20, 30), "qual_age_max": rare(25), "qual_region": rare(["seo"]),
            "qual_nationality": rare("KR"), "qual_special_info": rare(["s2", "s9"], ["s1"]), "qual_parent_occupation": rare(["o1", "o3"]), "qual_military_status": rare("done"),
        }
    profiles, offers = frame(spark, PROFILE, [person(i) for i in range(150)]), frame(spark, OFFER, [offer(i) for i in range(120)])
    every = M.explain(profiles.select(F.struct("*").alias("p")).join(offers.select(F.struct("*").alias("s"))), "2024-03-01")
    want = sorted((r["p"]["id"], r["s"]["id"]) for r in every.collect() if all(v for k, v in r.asDict().items() if k.startswith("ok_")))
    found = M.match(profiles, offers, "2024-03-01")
    assert sorted((r["p"]["id"], r["s"]["id"]) for r in found.collect()) == want and len(want) > 300
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bitmaps_find_what_the_pairs_do(spark, monkeypatch):
    """Counts by predicate and pairs are those of a look at every pair, over several blocks and chunks, and no step of the plan
    has a row for each pair: the join of both tables did."""
    monkeypatch.setattr(B, "BITS", 400)
    monkeypatch.setattr(B, "CHUNK", 9)
    profiles = frame(spark, PROFILE, [{"id": i, "gender": [None, "F", "M"][i % 3], "gpa": [None, 1.0, 2.5, 4.0][i % 4], "school_location": [None, "A"][i % 2], "birth_date": date(1990 + i % 20, 2, 28)} for i in range(50)])
    offers = frame(
        spark, OFFER,
        [{"id": i, "is_verified": i % 7 > 0, "apply_end_date": date(9999, 12, 31), "qual_gender": [None, "F", "X"][i % 3], "qual_gpa_min": [None, 2.0][i % 2], "qual_school_location": [None, [], ["A", "B"]][i % 3], "qual_age_max": [None, 25][i // 5 % 2]} for i in range(40)],
    )
    every = M.explain(profiles.select(F.struct("*").alias("p")).join(offers.select(F.struct("*").alias("s"))), "2024-03-01").collect()
    names = [f"ok_{n}" for n in M.VERSIONS[M.NEWEST]]
    found = B.explained(profiles, offers, "2024-03-01", "id")
    want = sorted((r["p"]["id"], r["s"]["id"]) for r in every if all(r[n] for n in names))
    assert found.first().asDict() == {n: sum(r[n] for r in every) for n in names} | {"matched": len(want)} and len(want) > 100
    assert sorted(map(tuple, B.pairs(profiles, offers, "2024-03-01", "id", "id").collect())) == want
    assert B.explained(profiles.limit(0), offers, "2024-03-01", "id").first()["matched"] == 0


def test_pairs_of_lists_are_those_of_rows(spark, monkeypatch):
    """Short runs and lists, small blocks, offers that ask the same, repeated rows and rows without a key: all pairs, each once."""
    for name, value in (("BLOCK", 13), ("RUN", 4), ("LIST", 3), ("AT_ONCE", 10), ("CHUNK", 20)):
        monkeypatch.setattr(B, name, value)
    profiles = frame(spark, PROFILE, [{"id": None if i == 5 else i // 2, "gender": [None, "F", "M"][i % 3], "gpa": [None, 1.0, 2.5, 4.0][i % 4]} for i in range(50)])
    offers = frame(spark, OFFER, [OPEN | {"id": None if i == 7 else i // 2, "qual_gender": [None, "F", "X"][i % 3], "qual_gpa_min": [None, 2.0][i // 20 % 2]} for i in range(60)])
    every = M.explain(profiles.select(F.struct("*").alias("p")).join(offers.select(F.struct("*").alias("s"))), "2024-03-01").collect()
    want = [(r["p"]["id"], r["s"]["id"]) for r in every if all(r[f"ok_{n}"] for n in M.VERSIONS[M.NEWEST])]
    assert sorted(map(tuple, B.pairs(profiles, offers, "2024-03-01", "id", "id").collect()), key=repr) == sorted(want, key=repr) and len(want) > 1000


def test_pairs_take_little_disk(spark, tmp_path):
    """Offers that ask the same share a short run of profiles: a file held the whole list of profiles for each offer, 32 MB here."""
    profiles, offers = (spark.range(n).select("id", *(F.lit(side.get(k)).cast(t).alias(k) for k, t in types.items() if k != "id")) for n, types, side in ((80_000, PROFILE, {}), (100, OFFER, OPEN)))
    B.pairs(profiles, offers, "2024-03-01", "id", "id").write.parquet(out := str(tmp_path / "pairs"))
    assert spark.read.parquet(out).count() == 8_000_000
    assert sum(x.stat().st_size for x in Path(out).glob("*.parquet")) < 4_000_000


def test_versions(spark):
    assert passes(spark, {}, {"qual_special_info": ["free text"]}, "optimised") and not passes(spark, {}, {"qual_special_info": ["다자녀"]}, "optimised")
    assert passes(spark, {"academic_year": 2, "semester": 1}, {"qual_min_academic_year": 2}, "admission_types") and not passes(spark, {"academic_year": 1}, {"qual_min_academic_year": 2}, "admission_types")
    assert not passes(spark, {"credits_last_semester": 11}, {"qual_credits_last_semester_min": 12}, "onboarding_fields")
    assert all(set(v) <= set(M.REGISTRY) for v in M.VERSIONS.values())


def test_explain_names_the_reason(spark):
    p, s = frame(spark, PROFILE, [{"id": 1}]), frame(spark, OFFER, [{"id": 1, "qual_gender": "F"} | OPEN])
    row = M.explain(p.select(F.struct("*").alias("p")).join(s.select(F.struct("*").alias("s"))), "2024-03-01").first()
    assert [k for k, v in row.asDict().items() if k.startswith("ok_") and not v] == ["ok_gender"]


def test_selection_keeps_the_first_items_only(spark, monkeypatch):
    """Ties share a place, rows without reasons decide; no more items than the limit are kept, where all were ranked before."""
    kept = []
    monkeypatch.setattr(N, "written", lambda df: kept.append(df.count()) or df)
    rows = [(i, i // 2, [] if i % 3 else ["x"]) for i in range(30)] + [(1, 99, []), (50, None, []), (None, 0, []), (29, None, [])]
    df = spark.createDataFrame(rows, "item int, at int, reasons array<string>")
    firsts = {}
    for item, at, why in rows:
        if item is not None and at is not None and not why:
            firsts[item] = min(at, firsts.get(item, at))
    inside = set(sorted(set(firsts.values()))[:4])
    want = [(i, at, ["max_items_limit_reached"] if not why and i in firsts and firsts[i] not in inside else why) for i, at, why in rows]
    got = N.selected(df, "item", "at", "reasons", 4).collect()
    assert sorted(((r["item"], r["at"], r["reasons"]) for r in got), key=repr) == sorted(want, key=repr)
    assert kept and max(kept) < 10 < len(firsts)


def test_tree(spark):
    nodes = spark.createDataFrame([(1, None, "a", None), (2, 1, "b", "B"), (3, 2, "c", None), (7, 8, "x", None), (8, 7, "y", None)], "id long, parent long, name string, code string")
    found = {r["id"]: r["path_ids"] for r in tree.paths(nodes, "id", "parent").collect()}
    assert found == {1: [1], 2: [1, 2], 3: [1, 2, 3]}  # a cycle has no path
    assert {r["id"]: r["code"] for r in tree.deepest_code(tree.paths(nodes, "id", "parent"), "id", "code").collect()} == {2: "B", 3: "B"}
    nodes.where("id < 7").createOrReplaceTempView("_n")
    assert {r["id"]: r["path_ids"] for r in spark.sql(tree.paths_sql("_n", "id", "parent")).collect()} == found


def test_targets(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "profile long, offer long")
    out = M.with_targets(pairs, "profile", "offer", spark.createDataFrame([(10, 5)], "offer long, unit long"), spark.createDataFrame([(1, 10)], "profile long, offer long"))
    assert {(r["profile"], r["offer"]): (r["is_targeted"], r["target_hit"]) for r in out.collect()} == {(1, 10): (True, True), (1, 11): (False, False), (2, 10): (True, False)}


def test_pages_are_a_partition(spark):
    items = spark.range(103).withColumn("k", F.col("id") % 7)
    order = [F.asc("k"), F.asc("id")]
    seen = [r["id"] for p in range(1, 7) for r in L.page(items, p, 20, *order).orderBy("rn").collect()]
    assert len(seen) == len(set(seen)) == 103
    assert L.page(items, None, 500, *order).count() == 50 and L.page(items, -3, 0, *order).count() == 1


def test_names_in_texts(spark):
    items = spark.createDataFrame([(1, "at the big school", None), (2, "elsewhere", ["x"]), (3, "nowhere", []), (4, None, None), (5, "an BIG-SCHOOL", None), (6, "ab", None), (7, "zq", None)], "id long, text string, limits array<string>")
    names = spark.createDataFrame([("Big School",), ("big_school",), ("other",), (" ",), ("a%b",)], "name string")
    assert {r["id"] for r in L.on_campus(items, "limits", ["text"], names, "name").where("is_campus").collect()} == {1, 2, 5, 6}
    assert sorted(r["id"] for r in L.without_names(items, F.col("text"), names, "name").collect()) == [2, 3, 4, 5, 6, 7]
    anything = spark.createDataFrame([("__",), ("%%%",)], "name string")
    assert {r["id"] for r in L.on_campus(items, "limits", ["text"], anything, "name").where("is_campus").collect()} == {1, 2, 3, 5, 6, 7}


def test_names_by_their_rarest_run(spark, monkeypatch):
    """10,000 names of one ending: beyond the automaton's bound no key has over a hundredth of the pairs; both ways agree."""
    rnd = random.Random(3)
    syllable = [chr(0xAC00 + 28 * i) for i in range(60)]
    names = sorted({"".join(rnd.choices(syllable, k=3)) + "대학교" for _ in range(10_000)})
    texts = [f"{rnd.choice(names)[: rnd.choice([3, 6])]} 공지 {i}" for i in range(3000)] + ["대학교", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    known = spark.createDataFrame([(n,) for n in names], "name string")
    want = [i for i, t in enumerate(texts) if t and any(n in t for n in names)]
    by = lambda: sorted(r["id"] for r in K.marked(rows, [F.col("text")], known, "name", False, "hit").where("hit").collect())
    assert 100 < len(want) < 3000 and by() == want
    monkeypatch.setattr(K, "MOST_NAMES", 100)
    assert by() == want
    keys, lengths = K.rarest_keys(rows, "text", known, "name", False)
    pairs = [r["n"] for r in K.grams(rows, "text", lengths).join(keys, "_gram").groupBy("_gram").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(pairs) <= 0.01 * sum(pairs)


@pytest.mark.parametrize("bound", [0, 1000])
def test_wild_names_either_way(spark, monkeypatch, bound):
    monkeypatch.setattr(K, "MOST_NAMES", bound)
    rnd = random.Random(bound)
    texts = ["".join(rnd.choices("ab c", k=rnd.randint(0, 9))) for _ in range(200)] + [None]
    names = ["a%b", "b_a", "c", "abc%", "%", "zz", "ca_%bb", "aaaa"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for taken in ([0, 1, 7], [2], [4], [3, 5, 6], []):
        known = spark.createDataFrame([(names[i],) for i in taken], "name string")
        pattern = [re.compile(re.escape(names[i]).replace("%", ".*").replace("_", "."), re.S) for i in taken]
        got = {r["id"] for r in K.marked(rows, [F.col("text")], known, "name", True, "hit").where("hit").collect()}
        assert got == {i for i, t in enumerate(texts) if t is not None and any(p.search(t) for p in pattern)}


def test_longest_held_in_a_hot_group(spark):
    rnd = random.Random(4)
    words = ["red", "Redder", "blue", "b_ue", "re%", "green tea", "tea", ""]
    rows = [(i, rnd.choice(["red tea", "RED", "green tea red", "blue", "te", None, "%"]), rnd.choice(["x", "x", "y", None]), rnd.choice([*words, None]), "l" * rnd.randint(1, 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, name string, grp string, word string, label string")
    out = K.longest_held(df.select("id", "name", "grp"), "id", "name", df.select(F.col("id").alias("other"), "word", "label", "grp"), "other", "word", "label", ["grp"])
    like = lambda x, y: re.search("(?is)" + "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in y), x) is not None
    want = {}
    for i, name, g, *_ in rows:
        found = [(-len(label), j, label) for j, _, h, w, label in rows if g is not None and g == h and i != j and None not in (name, w) and (like(name, w) or like(w, name))]
        if found:
            want[i] = min(found)[1:]
    assert {r["id"]: (r["other"], r["label"]) for r in out.collect()} == want


def test_deep_trees(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)] + [(100, 101), (101, 100), (102, 101)]
    found = {r["id"]: r["path_ids"] for r in tree.paths(spark.createDataFrame(chain, "id long, parent long"), "id", "parent").collect()}
    assert found == {i: list(range(i + 1)) for i in range(40)}
    rounds = []
    real = tree.written
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tree, "written", lambda df: rounds.append(1) or real(df))
        long = spark.createDataFrame([(i, i - 1 if i else None) for i in range(3000)], "id long, parent long")
        assert {r["id"]: r["n"] for r in tree.paths(long, "id", "parent").select("id", F.size("path_ids").alias("n")).collect()} == {i: i + 1 for i in range(3000)}
    assert len(rounds) <= 13


def test_moved_subtrees(spark):
    nodes = [(1, None, "r"), (2, 1, "a"), (3, 2, "b"), (4, 3, "c"), (5, 1, "d"), (6, None, "s")]
    pathed = tree.paths(spark.createDataFrame(nodes, "id long, parent long, name string"), "id", "parent", "name")
    for child, to in ((2, 5), (3, 6), (2, None), (5, 4)):
        now = tree.moved(pathed, "id", "parent", child, to)
        again = tree.paths(now.drop("path_ids", "path_names"), "id", "parent", "name")
        assert sorted(map(tuple, now.collect())) == sorted(map(tuple, again.collect()))
    with pytest.raises(ValueError, match="cycle"):
        tree.moved(pathed, "id", "parent", 2, 4)


def splice(rows: list, ads: list) -> list:
    out = list(rows)
    for place, key in sorted(ads):
        out.insert(max(0, min(place - 1, len(out))), key)
    return out


def test_ads(spark):
    rows = [("a", i, i, False, None) for i in range(5)] + [("a", 10, 10, True, 2), ("a", 11, 11, True, 2), ("a", 12, 12, True, 99), ("a", 13, 13, True, None), ("b", 0, 20, True, 1)]
    out = L.place_ads(spark.createDataFrame(rows, "list string, position long, id long, ad boolean, place int"), "list", "position", "id", "ad", "place").orderBy("list", "position").collect()
    assert [r["id"] for r in out if r["list"] == "a"] == splice([0, 1, 2, 3, 4, 13], [(2, 10), (2, 11), (99, 12)])
    assert [r["id"] for r in out if r["list"] == "b"] == [20]


@pytest.mark.parametrize("seed", range(3))
def test_ads_in_any_lists(spark, seed):
    """Many advertisements that ask for the same places, beyond the end, in lists without rows: as put in one by one."""
    rnd = random.Random(seed)
    rows, want = [], {}
    for name in ("a", "b", None, "only ads"):
        base = [] if name == "only ads" else [(i, i) for i in range(rnd.randint(0, 25))]
        ads = [(rnd.choice([1, 2, 2, 3, 9, 40]), 100 + i) for i in range(rnd.randint(1, 14))]
        rows += [(name, p, k, False, None) for p, k in base] + [(name, 0, k, True, p) for p, k in ads]
        want[name] = splice([k for _, k in base], ads)
    out = L.place_ads(spark.createDataFrame(rows, "list string, position long, id long, ad boolean, place int"), "list", "position", "id", "ad", "place").collect()
    for name, ids in want.items():
        assert [(r["position"], r["id"]) for r in sorted(out, key=lambda r: r["position"]) if r["list"] == name] == list(enumerate(ids))


def test_places_without_one_task(spark):
    """Places, ranks with ties and running sums as a window over all rows would give them; hot groups take several tasks."""
    rnd = random.Random(8)
    rows = [(i, rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice("xyz"), rnd.randint(0, 5)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, k int, s string, w int").repartition(5, "id")
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[0]))
    got = {r["id"]: r["place"] for r in ranks.placed(df, F.asc("k"), F.asc("s"), F.asc("id")).collect()}
    assert got == {r[0]: i + 1 for i, r in enumerate(order)}
    keys = [(r[1], r[2]) for r in order]
    assert {r["id"]: r["place"] for r in ranks.ranked(df, ["k", "s"]).collect()} == {r[0]: keys.index(k) + 1 for r, k in zip(order, keys, strict=True)}
    distinct = list(dict.fromkeys(keys))
    assert {r["id"]: r["place"] for r in ranks.ranked(df, ["k", "s"], dense=True).collect()} == {r[0]: distinct.index(k) + 1 for r, k in zip(order, keys, strict=True)}
    sums, total = ranks.sums_before(df, ["k", "s", "id"], "w")
    assert total == sum(r[3] for r in rows)
    assert {r["id"]: r["before"] for r in sums.collect()} == {r[0]: sum(x[3] for x in order[:i]) for i, r in enumerate(order)}
    within = ranks.placed_within(df, ["k"], F.asc("s"), F.asc("id"))
    assert {r["id"]: r["place"] for r in within.collect()} == {r[0]: 1 + sum(x[1] == r[1] for x in order[:i]) for i, r in enumerate(order)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept, _, _ = ranks.in_ranges(df, [F.col("k"), F.col("id")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert kept.where("k = 1").select("_part").distinct().count() > 1  # half of the rows
    assert ranks.placed(df.limit(0), F.asc("id")).count() == 0
    alike = spark.createDataFrame([(1,)] * 500, "k int").repartition(4)
    assert sorted(r["place"] for r in ranks.placed(alike, F.asc("k")).collect()) == list(range(1, 501))


def test_views_of_long_histories(spark, monkeypatch):
    """One key with most views, a second apart, and others: pointers and folds count the same views as one pass would."""
    monkeypatch.setattr(E, "LONG", 60)
    rnd = random.Random(2)
    rows = [("hot", 1000 + i) for i in range(700)] + [("hot", 1000 + rnd.randint(0, 900)) for _ in range(50)] + [(None, 5 * i) for i in range(90)] + [(rnd.choice("abc"), rnd.randint(0, 5000)) for _ in range(120)] + [("hot", None)]
    df = spark.createDataFrame([(k, None if t is None else datetime.fromtimestamp(t)) for k, t in rows], "k string, ts timestamp")
    for seconds in (1, 7, 300):
        want = {}
        for k in {k for k, _ in rows}:
            last, n, times = None, 0, sorted(t for x, t in rows if x == k and t is not None)
            for t in times:
                if last is None or t - last >= seconds:
                    last, n = t, n + 1
            want[k] = (len(times), n)
        assert {r["k"]: (r["n_views"], r["n_counted"]) for r in E.spaced_views(df, ["k"], "ts", seconds).collect()} == want


def test_clean_is_idempotent(spark):
    rows = [(1, "s", "장학금 신청 안내문", "https://x.example.com/v?no=1"), (2, "s", "장학금 신청 안내문", "https://x.example.com/v?no=1"), (3, "s", "장학금 안내", "https://x.example.com/v?no=2"), (4, "s", "긴 제목입니다 여기", "http://x.example.com/v?no=2"), (5, "s", "", ""), (6, "t", "장학금 신청 안내문", "https://x.example.com/v?no=1")]
    df = spark.createDataFrame(rows, "id long, source string, title string, url string")
    out = {r["id"]: r["reason"] for r in N.classify(df, "source", "title", "url", "id").collect()}
    assert out == {1: None, 2: "duplicate_notice", 3: "too_short_title", 4: "insecure_http_url", 5: "empty_title", 6: None}
    kept = N.classify(df, "source", "title", "url", "id").where("reason IS NULL").drop("reason")
    assert N.classify(kept, "source", "title", "url", "id").where("reason IS NOT NULL").count() == 0


def test_alerts_and_streaks(spark):
    days = spark.createDataFrame([(date(2024, 1, d), n) for d, n in ((1, 10), (2, 0), (3, 20), (4, 4))], "day date, n long")
    assert [(r["recent_median"], r["is_drop"]) for r in R.drop_alerts(days, "day", "n").orderBy("day").collect()] == [(0.0, False), (10.0, True), (10.0, False), (15.0, True)]
    log = spark.createDataFrame([("a", d, e) for d, e in ((1, "x"), (2, ""), (3, "y"), (4, "z"), (5, "w"))] + [("b", 5, "x")], "s string, d int, e string")
    assert [tuple(r) for r in R.error_streaks(log, "s", "d", "e").collect()] == [("a", 3, "w")]


def test_marts_replace_their_days(spark, tmp_path):
    path = str(tmp_path / "mart")
    W.overwrite_days(spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, n int"), path, "day")
    W.overwrite_days(spark.createDataFrame([("d2", 5)], "day string, n int"), path, "day")
    assert sorted((r["day"], r["n"]) for r in spark.read.parquet(path).collect()) == [("d1", 1), ("d2", 5)]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    W.run_log(spark, path, "r1", lambda: spark.range(1))
    with pytest.raises(ValueError):
        W.run_log(spark, path, "r2", lambda: (_ for _ in ()).throw(ValueError("no")))
    assert {(r["run_id"], r["status"]) for r in spark.read.parquet(path).collect()} == {("r1", "success"), ("r2", "failure")}


def test_csv_round_trip(spark, tmp_path):
    rows = [("a,b", 'say "x"', "two\nlines"), ("é", None, "z"), (" ", "", "")]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    files.write_csv(df, str(tmp_path / "out"), [F.desc("p")])
    raw = next((tmp_path / "out").glob("part-*")).read_bytes()
    assert raw.startswith("﻿p,q,r\r\n".encode()) and b'"say ""x"""' in raw
    back = files.read_csv(spark, str(tmp_path / "out")).collect()
    assert sorted((r["p"], r["q"] or "", r["r"]) for r in back) == [("a,b", 'say "x"', "two\nlines"), ("é", "", "z")]


def test_packed_documents_have_the_shapes_of_files(spark, sf, tmp_path, monkeypatch):
    """Documents many to a file: a folder with a file for each of them took longer the more there were."""
    import __spark_entry__ as entry

    texts = [files.BOM + '{"collector_output_version": 2, "sources": [1]}', '{"sources":[]}', ' {"perSource":[]}', '{"sources": {}}', "[]", "no JSON"]
    (tmp_path / "each").mkdir()
    for i, t in enumerate(texts):
        (tmp_path / "each" / f"{i}").write_text(t)
    spark.createDataFrame([(f"x/{i}", t) for i, t in enumerate(texts)], "path string, value string").write.json(str(tmp_path / "packed"))
    named = lambda df: {r["path"].rsplit("/", 1)[1]: r["shape"] for r in df.collect()}
    assert named(files.detect_packed_shapes(spark, str(tmp_path / "packed"))) == named(files.detect_shapes(spark, str(tmp_path / "each"))) and len(texts) == 6
    monkeypatch.setattr(files, "workspace", lambda _: str(tmp_path / "query"))
    assert entry.queries()["document_shapes"](spark, sf).count() > len(list((tmp_path / "query").rglob("part-*")))


def test_exchanged_files_in_parts(spark, tmp_path):
    """Many parts in order, each with its header; a Word document in parts, the head first and the end last."""
    df = spark.range(400).select((400 - F.col("id")).alias("id"), F.concat(F.lit("a,"), F.col("id").cast("string")).alias("t")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_csv(df, str(tmp_path / "csv"), [F.asc("id")])
        files.write_word(df, str(tmp_path / "word"), "T & x", [F.desc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [p.read_text() for p in sorted((tmp_path / "csv").glob("part-*")) if p.stat().st_size]
    assert len(parts) > 1 and all(p.startswith("\ufeffid,t\n") for p in parts)
    assert [int(x.split(",")[0]) for p in parts for x in p.splitlines()[1:]] == list(range(1, 401))
    assert sorted((int(r["id"]), r["t"]) for r in files.read_csv(spark, str(tmp_path / "csv")).collect()) == [(i, f"a,{400 - i}") for i in range(1, 401)]
    text = "".join(p.read_text() for p in sorted((tmp_path / "word").glob("part-*")))
    assert text.startswith("\ufeff<!DOCTYPE html>") and text.rstrip().endswith("</html>") and "<h1>T &amp; x</h1>" in text
    assert [int(x) for x in re.findall(r"<tr><td>(\d+)</td>", text)] == list(range(400, 0, -1))
    files.write_csv(df.limit(0), str(tmp_path / "none"))
    assert files.read_csv(spark, str(tmp_path / "none")).count() == 0


def test_run_documents(spark, tmp_path):
    doc = '{"run":{"run_key":"k"},"sources":[{"source_key":" S1 ","items":[{"title":"a","assets":[{"source_url":"u"}]},{"title":"b"}]},{"source_key":"s2","items":[]}]}'
    (tmp_path / "d.json").write_text(doc)
    path = str(tmp_path / "d.json")
    rows = files.run_items(files.read_json(spark, path, files.RUN_DOCUMENT)).collect()
    assert [(r["source_key"], r["item_index"], r["item"]["title"]) for r in rows] == [("s1", 0, "a"), ("s1", 1, "b")]
    shapes = {"synthetic-compatible": doc, "collector-output": '{"collector_output_version":1,"sources":[]}', "collector-report": '{"newNotices":[]}', "candidate-list": '[{"title":"x"}]'}
    (tmp_path / "shapes").mkdir()
    for name, text in shapes.items():
        (tmp_path / "shapes" / f"{name}.json").write_text(text)
    found = {r["path"].rsplit("/", 1)[1]: r["shape"] for r in files.detect_shapes(spark, str(tmp_path / "shapes")).collect()}
    assert found == {f"{name}.json": name for name in shapes}


def test_reports_by_day(spark, tmp_path):
    root = str(tmp_path / "r")
    for d in (1, 2, 3):
        files.write_report(spark.createDataFrame([(d,)], "n int"), root, date(2024, 1, d))
    assert sorted(r["n"] for r in files.read_last_days(spark, root, "n int", 2).collect()) == [2, 3]
    assert spark.read.schema("n int").json(f"{root}/latest").first()["n"] == 3


def test_feed(spark):
    page = lambda *ids: '{"notices":[' + ",".join(f'{{"_id":"{i}","title":" t{i} ","createdAt":"2024-01-{i:02d}T00:00:00Z"}}' for i in ids) + "]}"
    bodies = [("s", 1, page(1, 2)), ("s", 2, page(2, 3)), ("s", 3, page(1)), ("s", 4, page(9)), ("t", 1, '{"notices":[{"_id":"5"}, {"_id":"6","title":"u"}]}')]
    feed = spark.createDataFrame([(k, "https://x.example.com/list?c=1", n, b) for k, n, b in bodies], "source_key string, list_url string, page int, body string")
    rows = lambda **k: sorted(r["id"] for r in adapters.feed_items(feed, adapters.adapter(" Hanyang_IS"), **k).collect())
    assert rows() == ["1", "2", "3", "6"]  # page 3 brought nothing new, so page 4 was not read; a title is needed
    assert rows(as_of="2024-01-03", lookback_days=1) == ["2", "3"] and rows(as_of="2024-01-03", lookback_days=1, keep_undated=True) == ["2", "3", "6"] and rows(cap=1) == ["1", "6"]
    first = adapters.feed_items(feed, adapters.ADAPTERS["hanyang_is"]).where("id = '1'").first()
    assert (first["url"], first["title"]) == ("https://x.example.com/notices/1", "t1")


def test_adapters(spark):
    get = lambda name, body, **k: [tuple(r) for r in adapters.feed_items(spark.createDataFrame([("s", "https://x.example.com/a/list.do", 1, body, {"MENU_ID": "7", "SITE_NO": ""})], "source_key string, list_url string, page int, body string, f map<string,string>"), adapters.adapter(name), **k).select("id", "title", "url", "date_text", "content").collect()]
    portal = '{"data":{"list":[{"BBS_SEQ":5,"SUBJECT":"a","WRITE_DT":"2024.01.02","CATEGORY_NM1":"c","WRITER_NM":"w"},{"BBS_SEQ":6,"SUBJECT":"b","LINK_URL_YN":"y","LINK_URL":"http://z.example.com/q"}]}}'
    assert get("cau_portal", portal, form="f") == [("5", "a", "https://x.example.com/cms/FR_CON/BoardView.do?MENU_ID=7&BBS_SEQ=5", "2024.01.02", "[c] w"), ("6", "b", "https://z.example.com/q", None, "")]
    assert get("korea_medicine", '{"list":[{"articleNo":3,"title":"t","createdDt":1704067200000,"content":"x"}]}', as_of="2024-01-02", lookback_days=3) == [("3", "t", "https://x.example.com/kr/college/notice/view.do?articleNo=3", "1704067200000", "x")]
    assert get("yonsei_communication", '[{"id":"k","title":"t","date":"2024-01-01","contentfile":"f"}]') == [("k", "t", "https://x.example.com/notice.html?id=k", "2024-01-01", "f")]
    assert get("cau_artech", '{"data":{"newsList":[{"id":1,"title":"t","updatedAt":"2024-01-01"}]}}')[0][2] == "https://x.example.com/news/1" and adapters.adapter("none") is None
    page = spark.createDataFrame([("s", "https://x.example.com/a/list.do", 1, "<a href='?act=view&uid=1'>One (Jan 2, 2024)</a><a href='?act=list'>no</a><a href='?act=view&amp;uid=2'>Two</a>")], "source_key string, list_url string, page int, body string")
    found = adapters.feed_items(adapters.links_as_json(page, "body"), adapters.ADAPTERS["yonsei_uic"], as_of="2024-01-10", keep_undated=True).select("title", "url", "date_text").collect()
    assert [tuple(r) for r in found] == [("One", "https://x.example.com/a/list.do?act=view&uid=1", "Jan 2, 2024"), ("Two", "https://x.example.com/a/list.do?act=view&uid=2", None)]


def test_sql_dump(spark, tmp_path):
    (tmp_path / "d.sql").write_text("""-- x
    insert into public.offers (id, name, tags) values (1, 'it''s; (ok), fine', ARRAY['a','b']::text[]), (2, NULL, '{}'::jsonb);
    INSERT INTO offers (id, extra) VALUES (3, 'e');
    insert into other (id) values (9);""")
    rows = sqldump.read_dump(spark, str(tmp_path), "offers", ["id", "name", "extra"]).orderBy("ordinal").collect()
    assert [(r["id"], r["name"], r["extra"]) for r in rows] == [("1", "it's; (ok), fine", None), ("2", None, None), ("3", None, "e")]


@pytest.mark.parametrize("size", [350, 1 << 20])
def test_sql_dump_in_splits(spark, tmp_path, size):
    """Quotes, brackets, line ends and whole statements inside values across the cuts: as one scan of each file."""
    rnd = random.Random(size)
    texts = ["plain", "it''s", "a (b, c", "two\nlines", "x'');\ninsert into offers (id) values (''no'');\ny", ""]
    for f in range(3):
        parts = ["-- don''t mind\n" if f else ""]
        for i in range(50):
            rows = ", ".join(f"({i}, '{rnd.choice(texts)}', ARRAY['a','{k}'])" for k in range(rnd.randint(1, 3)))
            parts.append(f"{rnd.choice(['', '  '])}INSERT INTO {rnd.choice(['offers', 'other'])} (id, name, tags)\nVALUES\n{rows};{rnd.choice([chr(10), chr(10), ' '])}")
        (tmp_path / f"{f}.sql").write_text("".join(parts) + ("insert into offers (id, name) values (1, 'never closed" if f == 2 else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = sorted((r["path"].rsplit("/", 1)[1], r["ordinal"], r["table_name"], sorted(r["fields"].items())) for r in sqldump.dump_rows(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(f"{f}.sql", k, t, sorted(x.items())) for f in range(3) for k, (t, x) in enumerate(sqldump.statements((tmp_path / f"{f}.sql").read_text())[0])]
    assert got == sorted(want) and len(want) > 150


def test_charsets(spark):
    assert charset.decode("한글".encode("cp949"), "text/html; charset=euc-kr") == ("한글", "euc-kr")
    assert charset.decode('<meta charset="euc-kr">한글'.encode("cp949"), None)[1] == "euc-kr"
    assert charset.decode("한글".encode(), "text/html; charset=latin-none") == ("한글", "utf-8") and charset.decode(None, None) == (None, None)
    df = spark.createDataFrame([(bytearray("한글".encode("cp949")), "charset=ks_c_5601-1987")], "raw binary, header string")
    assert df.select(charset.decoded("raw", "header").alias("d")).first()["d"]["text"] == "한글"


def test_streams_agree_with_batches(spark, tmp_path):
    from loomspark.operators import engagement as E

    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    rows = [(i, at(10, i), 1, "view", 1.0, "{}") for i in range(0, 30, 2)] + [(100, at(16), 2, "click", 1.0, "{}"), (101, at(16), 2, "click", 1.0, "{}")]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, views.EVENT).coalesce(1).write.parquet(src)
    stream = views.read_events(spark, src)
    counted = views.spaced_views(stream.where("event_type = 'view'").select("user_id", F.lit(1).alias("item"), "ts"), 300)
    counted.writeStream.format("memory").queryName("_counted").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start().awaitTermination()
    batch = E.spaced_views(spark.read.parquet(src).where("event_type = 'view'"), ["user_id"], "ts", 300).first()
    assert spark.table("_counted").count() == batch["n_counted"] == 5
    day = stream.withColumn("day", F.to_date(F.col("ts") + F.expr("INTERVAL 9 HOURS")))
    views.write_mart(views.counts_of_days(day, "day", {"n_views": "view", "n_clicks": "click"}), str(tmp_path / "mart"), str(tmp_path / "c2")).awaitTermination()
    mart = {str(r["day"]): (r["n_events"], r["n_views"], r["n_clicks"]) for r in spark.read.parquet(str(tmp_path / "mart")).collect()}
    assert mart == {"2024-01-01": (15, 15, 0), "2024-01-02": (2, 0, 2)}
    fresh = views.new_items(stream.select("user_id", "ts"), "user_id", "ts", "30 days")
    fresh.writeStream.format("memory").queryName("_fresh").outputMode("append").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("_fresh").count() == 2


def test_states(spark):
    log = spark.createDataFrame([(1, 1, "promote"), (1, 2, "reject"), (2, 1, "reject"), (2, 2, "restore"), (3, 1, "restore")], "id long, at long, do string")
    assert {r["id"]: r["status"] for r in W.review_states(log, "id", "at", "do").collect()} == {1: "promoted", 2: "new", 3: "new"}


def test_changed_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    assert [r["id"] for r in W.changed(old, new, ["id"], ["v"]).collect()] == [2]


def test_guarded_apply(spark, tmp_path):
    """A failure between two tables leaves the old state; the rerun takes over what was staged; untouched partitions stay; a
    version can be had back; staged rows that were changed are found out."""
    types = {"a": ("part", "id long, part string"), "b": ("part", "id long, part string")}
    store = guarded.Store(spark, str(tmp_path), types)
    frame_of = lambda *rows: spark.createDataFrame(list(rows), "id long, part string")
    rows = lambda t: sorted((r["id"], r["part"] or "") for r in store.table(t).collect())
    assert rows("a") == [] and store.apply("r1", {"a": frame_of((1, "x"), (2, "y/ z")), "b": frame_of((1, None))}) == 1
    before = store.manifest()
    with pytest.raises(Exception, match="lost"):
        store.apply("r2", {"a": frame_of((3, "x")), "b": frame_of((4, "w")).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))})
    assert store.manifest() == before and rows("a") == [(1, "x"), (2, "y/ z")] and rows("b") == [(1, "")]
    staged = {p: p.stat().st_mtime_ns for p in (tmp_path / "staged" / "r2" / "a").rglob("*.parquet")}
    with pytest.raises(ValueError, match="too many"):
        store.apply("r2", {"a": frame_of((3, "x")), "b": frame_of((4, "w"))}, [lambda tables: "too many" if tables["a"].count() == 2 else None])
    assert store.manifest() == before
    assert store.apply("r2", {"a": frame_of((99, "x")), "b": frame_of((4, "w"))}) == 2  # what was staged is taken over
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "staged" / "r2" / "a").rglob("*.parquet")} == staged
    assert rows("a") == [(2, "y/ z"), (3, "x")] and rows("b") == [(1, ""), (4, "w")]
    assert store.manifest()["a"]["y/ z"] == before["a"]["y/ z"]
    assert store.roll_back(1) == 3 and rows("a") == [(1, "x"), (2, "y/ z")]
    note = store.stage("r3", "a", frame_of((5, "x")))
    with pytest.raises(ValueError, match="not what was written"):
        store.verify("a", {"x": [note["x"][0], 1, "0"]})


def test_upsert_of_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, n int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, n int")
    assert sorted(map(tuple, W.upsert(old, new, ["k"], "n").collect())) == [(1, "a", 0), (2, "d", 2), (3, "e", 1)]
