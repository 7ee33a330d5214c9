"""Texts that hold one of many names: a condition that no equal key expresses.

Names that fit in memory, which is counted first, become one automaton (Aho-Corasick) that goes to every task once; each text
is read once, where it is, and nothing is shuffled. A set of names beyond that bound meets the texts by keys: of the runs of
GRAM characters in a name the one that the fewest texts have, by count. Names that all end alike, or that share all but one
word, so get keys of their own, and the pairs that meet are the fewest that one key a name allows.

Texts and names are lower case. In wild names per cent signs and underscores are wildcards; the longest run between them is
looked for, and the pattern decides.
"""

from __future__ import annotations

import importlib.util
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names, and characters of all of them, that an automaton is made of at most; it takes some hundred bytes a character.
MOST_NAMES, MOST_CHARS = 200_000, 2 << 20
#: Characters of a name by which the texts that may hold it are found.
GRAM = 4
WILD = r"[%_\\]"


def bounded(names: DataFrame, name: str) -> list[str] | None:
    """The different names, or None where they are too many for one automaton, or its library is not here."""
    own = names.select(F.col(name).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    n, chars = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length("_name")), F.lit(0))).first()
    if n > MOST_NAMES or chars > MOST_CHARS or importlib.util.find_spec("ahocorasick") is None:
        return None
    return [r[0] for r in own.collect()]


def holds(spark, names: list[str], wild: bool) -> Callable[[Column], Column]:
    """A test of texts: whether they hold one of the names. False for a null text."""
    shared = spark.sparkContext.broadcast([(n, max(re.split(WILD, n), key=len) if wild else n) for n in names])

    def candidates(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton, anywhere, by_part = ahocorasick.Automaton(), [], {}
        for name, part in shared.value:
            if part:
                by_part.setdefault(part, []).append(name)
            else:
                anywhere.append(name)
        for part, own in by_part.items():
            automaton.add_word(part, own)
        automaton.make_automaton()

        def of(text: str | None) -> list[str] | None:
            if text is None:
                return None
            found = set(anywhere)
            for _, own in automaton.iter(text) if by_part else ():
                found.update(own)
                if not wild:
                    break
            return list(found)

        for each in texts:
            yield each.map(of, na_action=None) if len(each) else pd.Series([], dtype=object)

    ask = F.pandas_udf(candidates, "array<string>")

    def test(text: Column) -> Column:
        found = ask(text)
        hit = F.exists(found, lambda n: F.call_function("ilike", text, F.concat(F.lit("%"), n, F.lit("%")))) if wild else F.size(found) > 0
        return F.coalesce(hit, F.lit(False))

    return test


def runs_of(text: Column, n: int | Column) -> Column:
    """All runs of n characters of a text."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(F.char_length(text) >= n, F.transform(F.sequence(F.lit(1), F.char_length(text) - n + 1), lambda i: F.substring(text, i, n)))


def rarest_keys(texts: DataFrame, text: str, names: DataFrame, name: str, wild: bool) -> tuple[DataFrame, list[int]]:
    """(_name, _gram): for each different name the run of GRAM characters (of its longest literal part; the part itself where it
    is shorter) that the fewest texts have; names whose runs some text lacks altogether are in none. And the lengths of keys."""
    own = names.select(F.col(name).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    longest = F.reduce(F.split("_name", WILD), F.lit(""), lambda a, x: F.when(F.char_length(x) > F.char_length(a), x).otherwise(a))
    own = own.withColumn("_part", longest if wild else F.col("_name"))
    own = own.withColumn("_size", F.least(F.char_length("_part"), F.lit(GRAM)))
    each = own.select("_name", F.explode(F.when(F.col("_size") == 0, F.array(F.lit(""))).otherwise(F.array_distinct(runs_of(F.col("_part"), F.col("_size"))))).alias("_gram"))
    lengths = sorted(r[0] for r in own.select("_size").distinct().collect())  # 0 to GRAM
    seen = grams(texts, text, lengths).join(each.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a run that no text has rules its name out; the others keep their rarest
    counted = each.join(seen, "_gram", "left").groupBy("_name").agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"), F.min(F.coalesce("_n", F.lit(0))).alias("_n"))
    return counted.where("_n > 0").select("_name", "_gram"), lengths


def grams(texts: DataFrame, text: str, lengths: list[int]) -> DataFrame:
    """(_text, _gram): the different runs of these lengths of each text."""
    runs = [F.array(F.lit("")) if n == 0 else runs_of(F.col("_text"), n) for n in lengths]
    return texts.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).select("_text", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*runs))))).alias("_gram"))


def texts_with(texts: DataFrame, text: str, names: DataFrame, name: str, wild: bool) -> DataFrame:
    """(_text): the different texts that hold one of the names, by an equi join on each name's rarest run."""
    own = texts.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    keys, lengths = rarest_keys(own, "_text", names, name, wild)
    if not lengths:
        return own.limit(0)
    hit = F.call_function("ilike", F.col("_text"), F.concat(F.lit("%"), "_name", F.lit("%"))) if wild else F.contains("_text", F.col("_name"))
    return grams(own, "_text", lengths).join(keys, "_gram").where(hit).select("_text").distinct()


def marked(rows: DataFrame, texts: list[Column], names: DataFrame, name: str, wild: bool, mark: str) -> DataFrame:
    """Rows with a boolean column `mark`: one of their texts (lower case) holds one of the names (lower case)."""
    known = bounded(names, name)
    if known is not None:
        test = holds(rows.sparkSession, known, wild)
        hit = F.lit(False)
        for t in texts:
            hit = hit | test(t)
        return rows.withColumn(mark, hit)
    hit = F.lit(False)
    for i, t in enumerate(texts):
        found = texts_with(rows.select(t.alias("_low")), "_low", names, name, wild).select(F.col("_text").alias(f"_text{i}"))
        rows = rows.withColumn(f"_low{i}", t).join(found, F.col(f"_low{i}") == F.col(f"_text{i}"), "left")
        hit = hit | F.col(f"_text{i}").isNotNull()
    return rows.withColumn(mark, hit).drop(*(f"_{k}{i}" for k in ("text", "low") for i in range(len(texts))))


def held_pairs(texts: DataFrame, text: str, needles: DataFrame, needle: str, by: list[str]) -> DataFrame:
    """(by, _text, _needle): texts and needles of one group where the text holds the needle, case aside, wildcards live.

    They meet by the group and the needle's rarest run, so a group that holds a third of all rows is many keys.
    """
    own = texts.select(*by, F.col(text).alias("_text"), F.lower(text).alias("_low")).where(F.col("_low").isNotNull()).distinct()
    wanted = needles.select(*by, F.col(needle).alias("_needle"), F.lower(needle).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    keys, lengths = rarest_keys(own.select("_low").distinct(), "_low", wanted, "_name", True)
    runs = [F.array(F.lit("")) if n == 0 else runs_of(F.col("_low"), n) for n in lengths] or [F.array(F.lit(""))]
    cut = own.select(*by, "_text", F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*runs))))).alias("_gram"))
    met = cut.join(wanted.join(keys, "_name").drop("_name"), [*by, "_gram"])
    return met.where(F.call_function("ilike", F.col("_text"), F.concat(F.lit("%"), "_needle", F.lit("%")))).select(*by, "_text", "_needle")


def longest_held(left: DataFrame, left_id: str, name: str, right: DataFrame, right_id: str, word: str, label: str, by: list[str]) -> DataFrame:
    """(left_id, right_id, label): for each row of the left the row of the right, of its group and not itself, whose word is in
    its name or the other way round; of several the one with the longest label, then the smallest id.

    Names and words are matched as different values, not as rows, and of each value only the two best rows go on: one of them is
    not the row itself.
    """

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_r"))
        return rows.withColumn("_nth", nth).where("_nth <= 2").drop("_nth")

    rank = F.struct((-F.length(label)).alias("a"), F.col(right_id).alias("b"), F.col(label).alias("c"))
    words = best(right.where(F.col(word).isNotNull()).select(*by, F.col(word).alias("_word"), rank.alias("_r")), *by, "_word")
    ways = held_pairs(left, name, words, "_word", by).toDF(*by, "_text", "_word")
    ways = ways.unionByName(held_pairs(words, "_word", left, name, by).toDF(*by, "_word", "_text"))
    found = best(ways.distinct().join(words, [*by, "_word"]).select(*by, "_text", "_r").distinct(), *by, "_text")
    pairs = left.select(left_id, *by, F.col(name).alias("_text")).join(found, [*by, "_text"]).where(F.col(left_id) != F.col("_r.b"))
    return pairs.groupBy(left_id).agg(F.min("_r").alias("_r")).select(left_id, F.col("_r.b").alias(right_id), F.col("_r.c").alias(label))
