"""Language by words first: known words by their log frequency per language, unseen words by ever shorter n-grams.

Words and n-grams are counted in Spark, by their 64-bit hashes; what the driver gets are Arrow columns, a row for each word or
n-gram with its counts in all languages. The model is those hashes in order and a matrix of log frequencies: a look-up is a binary
search in numpy. It is made of a sample of documents that is bounded in documents and in bytes, and its own size is checked
before it goes out to the tasks: a model that is too large is made again of half the sample.

Cases: null texts and texts without a letter are `und` with score 0; with nothing to learn from, every text is `und`;
texts are taken whole; repeated rows and ties (the first language in order wins) are handled like any other; rows of one id are
drawn by their texts, each on its own; other columns, whatever their names, are carried or left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_texts, materialise, short_batches

#: Documents of each language to learn from, documents in all and bytes of their texts in all, however many languages there are
#: (each has its share of both); and bytes of the model, which is larger only where nearly all words are different.
SAMPLE_DOCS, SAMPLE_ALL, SAMPLE_BYTES = 2000, 40_000, 128 << 20
MODEL_BYTES = 192 << 20
LONGEST_GRAM, BACKOFF, FLOOR = 4, 0.7, 0.5
UNKNOWN = "und"
REMEMBERED = 300_000
WORD = regex.compile(r"\p{L}+")
SEED = 42  # that of Spark's xxhash64


def grams(word: str, size: int) -> list[str]:
    padded = f"^{word}$" if size > 1 else word
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


def hashed(texts: Iterable[str]) -> np.ndarray:
    """XXH64 as signed longs, as Spark has them."""
    return np.fromiter((xxhash.xxh64_intdigest(t.encode(), SEED) for t in texts), np.uint64).view(np.int64)


class Table:
    """Log frequencies per language: a row of the matrix for each hash, in ascending order of the hashes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, seen = keys[order], counts[order] + FLOOR
        self.logs = np.log(seen / np.maximum(seen.sum(0), 1)).astype(np.float32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


class Model:
    """Tables of words and of n-grams of each size, with the languages in the order of their columns."""

    def __init__(self, languages: list[str], words: Table, by_size: dict[int, Table]):
        self.languages, self.words = languages, words
        self.grams = {k: by_size[k] for k in range(LONGEST_GRAM, 0, -1)}
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(languages)))

    def scores(self, words: list[str]) -> np.ndarray:
        """A row per word: its scores per language, less the best, since only the differences tell languages apart.

        A known word has its own row. Any other is scored by its n-grams of the longest size of which one is known; each
        step down discounts what they say.
        """
        out = np.zeros((len(words), len(self.languages)))
        at = self.words.find(hashed(words))
        out[at >= 0] = self.words.logs[at[at >= 0]]
        open_ = np.flatnonzero(at < 0)
        for k, table in self.grams.items():
            if not len(open_):
                break
            own = [grams(words[i], k) for i in open_]
            word = np.repeat(np.arange(len(open_)), [len(x) for x in own])
            rows = table.find(hashed(g for x in own for g in x))
            word, rows = word[rows >= 0], rows[rows >= 0]
            hit = np.unique(word)
            if len(hit):
                sums = np.add.reduceat(table.logs[rows].astype(float), np.searchsorted(word, hit))
                out[open_[hit]] = sums / k * BACKOFF ** (LONGEST_GRAM + 1 - k)
            open_ = np.delete(open_, hit)
        return out - out.max(1, keepdims=True) if len(words) else out

    def remember(self, words: set[str]) -> None:
        """Give new words their rows; the memory starts afresh when it is full."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(words)
        n = len(self.known)
        while n + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[n : n + len(new)] = self.scores(new)
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text. The score is m / (1 + m) of the margin m: how far the best language's log odds are
        above the next one's, over the square root of the number of words, because words of one text depend on each other. So it
        ranks texts however sure they are; it is no probability. With one language it is 1."""
        counts = [Counter(WORD.findall(t.lower())) if t else Counter() for t in texts]
        if self.languages:
            self.remember(set().union(*counts))
        out = []
        for words in counts:
            if not words or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            at = list(map(self.known.__getitem__, words))
            total = np.fromiter(words.values(), float, len(words)) @ self.rows[at]
            best = int(total.argmax())
            if len(total) == 1:
                out.append((self.languages[best], 1.0))
                continue
            margin = (total[best] - np.partition(total, -2)[-2]) / np.sqrt(words.total())
            out.append((self.languages[best], float(margin / (1 + margin))))
        return out


def counted(rows: DataFrame, key: Column, languages: list[str]) -> Table:
    """The table of hashes of `key`, from rows with lang and n: a row for each hash with its counts in all languages."""
    lang = F.array_position(F.lit(languages), F.col("lang")) - 1
    each = rows.groupBy(F.xxhash64(key).alias("key"), lang.cast("int").alias("lang")).agg(F.sum("n").alias("n")).toArrow()
    keys, at = np.unique(each.column(0).to_numpy(), return_inverse=True)
    counts = np.zeros((len(keys), len(languages)))
    np.add.at(counts, (at, each.column(1).to_numpy()), each.column(2).to_numpy())
    return Table(keys, counts)


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, sample_all: int = SAMPLE_ALL, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model of about sample_docs documents of each language (sample_all and sample_bytes of all), chosen by a hash of id and
    text."""
    short_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes"))
    # a row for each language; of more languages than documents may be learned from, those with the most
    found = sorted(map(tuple, sizes.orderBy(F.desc("n"), "lang").limit(sample_all).collect()))
    languages = [k for k, _, _ in found]
    docs, size = min(sample_docs, sample_all / max(1, len(found))), sample_bytes / max(1, len(found))
    shares = {k: min(docs / n, size / max(1, b)) for k, n, b in found}
    if not languages:
        none = Table(np.zeros(0, np.int64), np.zeros((0, 0)))
        return Model([], none, dict.fromkeys(range(1, LONGEST_GRAM + 1), none))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.get(F.lit([shares[k] for k in languages]), F.array_position(F.lit(languages), F.col("lang")).cast("int") - 1)
    while True:
        counts = materialise(word_counts(rows.where(draw < share)).groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
        each = materialise(gram_table(counts), "grams")
        keys = counts.select("word").distinct().count() + each.select("size", "gram").distinct().count()
        if keys * (8 + 4 * len(languages)) <= MODEL_BYTES:
            break
        share = share / 2
    return Model(languages, counted(counts, F.col("word"), languages), {k: counted(each.where(F.col("size") == k), F.col("gram"), languages) for k in range(1, LONGEST_GRAM + 1)})


def word_counts(chosen: DataFrame) -> DataFrame:
    """(lang, word, n) of texts, batch by batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                by: dict[str, Counter] = {}
                for language, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by.setdefault(language, Counter()).update(WORD.findall(t.lower()))
                flat = [(k, w, n) for k, c in by.items() for w, n in c.items()]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    return chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n bigint")


def gram_table(counts: DataFrame) -> DataFrame:
    """(size, lang, gram, n) of the n-grams of 1 to LONGEST_GRAM characters in counted words; from 2 on their ends show."""
    # characters first: a substring costs as much as what lies before it, and a word can be long
    cut = lambda k: f"transform(sequence(0, greatest(0, size(c{k}) - {k})), i -> struct({k} AS size, concat({', '.join(f'get(c{k}, i + {m})' for m in range(k))}) AS gram))"
    padded = [f"regexp_extract_all({'word' if k == 1 else chr(39).join(('concat(', '^', ', word, ', '$', ')'))}, '(?s).', 0) AS c{k}" for k in range(1, LONGEST_GRAM + 1)]
    each = counts.selectExpr("lang", "n", *padded).selectExpr("lang", "n", f"explode(concat({', '.join(map(cut, range(1, LONGEST_GRAM + 1)))})) AS g")
    return each.where("g.gram IS NOT NULL").groupBy("g.size", "lang", "g.gram").agg(F.sum("n").alias("n"))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, lang_pred and score. The model is bounded by its sample, so it may go with the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: list) -> list:
        found = shared.value.predict(texts)
        return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]

    return map_texts(docs, work, "lang_pred string, score double", *keep, text=text)


def filter_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language the model names, with all their columns: texts pass through once and are not joined again."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, at):
                found = shared.value.predict(part.column(at).to_pylist())
                yield part.filter(pa.array([x[0] != UNKNOWN for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
