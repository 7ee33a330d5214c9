"""Quality as a generalised additive model with pairwise interactions.

Boosting goes round the features, one shallow tree each, so that every feature and every chosen pair ends as a lookup
table over its bins. A score is the sum of table entries, put through the logistic function.

Cases: null and empty texts have features like any text (all zero) and get a score; with no labelled rows, or rows of one
label only, every score is the smoothed share of label 1; texts are taken whole; repeated rows score alike; of several
labels of one id the largest counts, of pairs that gain alike the first; an empty table gives no rows; other columns are not
read, so no name clashes.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, map_texts

#: Labelled rows to learn from (chosen by a hash of the id): the model's bound.
SAMPLE_ROWS = 20_000
BINS, ROUNDS, RATE, PAIRS, PAIR_ROUNDS, LEAVES, SHRINK = 32, 120, 0.15, 8, 60, 4, 5.0

FEATURES = (
    "log_words", "upper_share", "digit_share", "symbol_rate", "exclaim_rate", "pipe_rate", "other_byte_share", "mean_word",
    "log_longest_word", "distinct_share", "top_word_share", "echo_share", "distinct_pair_share", "dup_line_share", "short_word_share", "log_lines",
)
UPPER, LETTER, DIGIT, SYMBOL, EXCLAIM, PIPE, OTHER = range(7)
CLASSES = np.zeros((7, 256), np.uint8)
CLASSES[UPPER, 65:91] = CLASSES[LETTER, 65:91] = CLASSES[LETTER, 97:123] = CLASSES[DIGIT, 48:58] = CLASSES[OTHER, 128:] = 1
CLASSES[SYMBOL, list(b"#*$%&<>=^~{}[]_\\")] = CLASSES[EXCLAIM, list(b"!?")] = CLASSES[PIPE, ord("|")] = 1


def features(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text."""
    raw = [t.encode() if t else b"" for t in texts]
    out = np.zeros((len(raw), len(FEATURES)))
    for i, b in enumerate(raw):
        words = b.split()
        n = len(words)
        if not n:
            continue
        seen = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
        upper, letter, digit, symbol, exclaim, pipe, other = (CLASSES @ seen).tolist()
        sizes = np.fromiter(map(len, words), np.int64, n)
        counts = Counter(words)
        lines = [x for x in b.split(b"\n") if x.strip(BLANKS.encode())]
        pairs = len(set(zip(words, words[1:], strict=False))) if n > 1 else 1
        echo = sum(map(bytes.__eq__, words, words[1:]))
        out[i] = (
            np.log1p(n), upper / max(1, letter), digit / len(b), symbol / n, exclaim / n, pipe / n, other / len(b), sizes.mean(),
            np.log1p(sizes.max()), len(counts) / n, max(counts.values()) / n, echo / n, pairs / max(1, n - 1), 1 - len(set(lines)) / len(lines), (sizes <= 3).mean(), np.log1p(len(lines)),
        )
    return out


def split_leaves(grad: np.ndarray, hess: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values of a shallow tree over ordered bins: the best cut, again and again, of any of its leaves."""
    parts, value = [(0, len(grad))], np.zeros(len(grad))
    g, h = np.r_[0, np.cumsum(grad)], np.r_[0, np.cumsum(hess)]
    score = lambda a, b: a * a / (b + SHRINK)
    while len(parts) < leaves:
        best = (1e-9, None)
        for lo, hi in parts:
            cut = np.arange(lo + 1, hi)
            if len(cut):
                gain = score(g[cut] - g[lo], h[cut] - h[lo]) + score(g[hi] - g[cut], h[hi] - h[cut]) - score(g[hi] - g[lo], h[hi] - h[lo])
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), (lo, int(cut[k]), hi)), key=lambda x: x[0])
        if best[1] is None:
            break
        lo, cut, hi = best[1]
        parts = [p for p in parts if p != (lo, hi)] + [(lo, cut), (cut, hi)]
    for lo, hi in parts:
        value[lo:hi] = (g[hi] - g[lo]) / (h[hi] - h[lo] + SHRINK)
    return value


def split_quadrants(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best pair of cuts of a table of bins by bins into four."""
    corner = lambda x: np.cumsum(np.cumsum(x, 0), 1)
    g, h = corner(grad), corner(hess)
    whole = lambda x: (x, x[:, -1:] - x, x[-1:] - x, x[-1, -1] - x[:, -1:] - x[-1:] + x)
    gain = sum(a * a / (b + SHRINK) for a, b in zip(whole(g), whole(h), strict=True))
    i, j = np.unravel_index(gain[:-1, :-1].argmax(), (len(grad) - 1, grad.shape[1] - 1)) if min(grad.shape) > 1 else (0, 0)
    value = np.zeros_like(grad)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            value[rows, cols] = grad[rows, cols].sum() / (hess[rows, cols].sum() + SHRINK)
    return float(gain[i, j]), value


class Additive:
    """Bin edges, a table per feature, a table per pair."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS):
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        if len(np.unique(y)) < 2:
            return
        bins = self.bins(x)
        score = np.full(len(y), self.base)
        for _ in range(rounds):
            for k, table in enumerate(self.tables):
                grad, hess = self.slopes(y, score)
                step = RATE * split_leaves(np.bincount(bins[k], grad, len(table)), np.bincount(bins[k], hess, len(table)))
                table += step
                score += step[bins[k]]
        grad, hess = self.slopes(y, score)
        gains = {p: split_quadrants(*self.crossed(bins, p, grad, hess))[0] for p in combinations(range(len(bins)), 2) if min(len(self.tables[k]) for k in p) > 1}
        for p in sorted(gains, key=lambda p: (-gains[p], p))[:pairs]:
            self.pairs[p] = np.zeros((len(self.tables[p[0]]), len(self.tables[p[1]])))
        for _ in range(PAIR_ROUNDS):
            for p, table in self.pairs.items():
                _, value = split_quadrants(*self.crossed(bins, p, *self.slopes(y, score)))
                table += RATE * value
                score += RATE * value[bins[p[0]], bins[p[1]]]

    @staticmethod
    def slopes(y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    def crossed(self, bins: list[np.ndarray], pair: tuple[int, int], *weights: np.ndarray) -> list[np.ndarray]:
        a, b = pair
        shape = len(self.tables[a]), len(self.tables[b])
        at = bins[a] * shape[1] + bins[b]
        return [np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in weights]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = self.base + sum(t[b] for t, b in zip(self.tables, bins, strict=True))
        for (a, b), table in self.pairs.items():
            total = total + table[bins[a], bins[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Additive:
    """A model from about sample_rows labelled documents. Labels with a null id or value, or without a document, don't count."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).alias("_y"))
    share = sample_rows / max(1, rows.count())
    draw = F.pmod(F.xxhash64(F.lit("quality"), "_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where(draw < min(1.0, share))  # sample_rows rows or so, whatever the input: small enough to broadcast
    joined = docs.select(id_col, text).join(F.broadcast(chosen), F.col(id_col) == F.col("_id"))

    def work(texts: list) -> list:
        return [pa.array(list(features(texts)), pa.list_(pa.float64()))]

    found = map_texts(joined, work, "x array<double>", "_y", text=text).toPandas()
    x = np.array(found["x"].tolist()).reshape(len(found), len(FEATURES))
    order = np.lexsort(x.T)  # the rows' order must not matter
    return Additive(x[order], found["_y"].to_numpy(float)[order])


def score(docs: DataFrame, model: Additive, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, score and predicted."""

    def work(texts: list) -> list:
        p = model(features(texts)) if texts else np.zeros(0)
        return [p, (p >= 0.5).astype(np.int32)]

    return map_texts(docs, work, "score double, predicted int", *keep, text=text)
