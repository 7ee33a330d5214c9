"""Quality rules on repetition: a suffix array over a text's words, its longest-common-prefix intervals, and their spans.

Cases: null, empty and blank texts have no words (base_failed, not kept); texts are taken whole; suffixes of different
texts never compare equal, so texts can share one array; ties and repeated rows are handled like any other; an empty table
gives no rows; other columns are not read, so no name clashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BLANKS, map_texts, words_of

SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, BASE_PERCENT = 8, 20, 30
#: The method's own limits: fraction of words under repeats of at least MIN_REPEAT words, and words of the longest repeat. The
#: latter is a number, not a share: a share large enough to matter would have failed the base rule before. It is the length of
#: a passage that no text repeats by chance or as a refrain.
MIN_REPEAT, MOST_COVERED, LONGEST_WORDS = 4, 0.35, 50


def suffix_ranks(rank: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... items, until all are told apart.

    A rank is the number of suffixes with a smaller prefix, which leaves room for a group to split. Doubling works on the
    suffixes that still share their prefix; one that is alone keeps its rank.
    """
    n = len(rank)
    levels, step = [rank.astype(np.int32)], 1
    open_ = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(open_):
        rank = levels[-1]
        after = open_ + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        order = np.lexsort((second, rank[open_]))
        at, b = open_[order], second[order]
        a = rank[at]
        place = np.arange(len(at))
        head = np.r_[True, a[1:] != a[:-1]]
        new = head | np.r_[True, b[1:] != b[:-1]]
        first = np.maximum.accumulate(np.where(head, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        fresh = rank.copy()
        fresh[at] = a + (start - first)
        levels.append(fresh)
        sizes = np.diff(np.r_[np.flatnonzero(new), len(at)])
        open_ = at[np.repeat(sizes, sizes) > 1]
        step *= 2
    return levels


def lcp_of(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Items that suffixes i and j have in common at their start."""
    n = len(levels[0])
    i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = np.minimum(i, n - 1), np.minimum(j, n - 1)
        same = (i < n) & (j < n) & (levels[k][a] == levels[k][b])
        i, j, out = i + (same << k), j + (same << k), out + (same << k)
    return out


def repeats(texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the texts, in order: the longest repeat (of the words that follow) that starts there; text starts.

    Neighbours in the suffix array bound the LCP intervals: a suffix's longest repeat is the larger LCP with its two
    neighbours, which is the depth of the deepest interval that holds it.
    """
    starts = np.cumsum([0, *map(len, texts)])
    n = int(starts[-1])
    if not n:
        return np.zeros(0, np.int64), starts
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for words in texts for w in words), np.int64, n)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    keys = text * (len(seen) + 1) + ids
    order = np.argsort(keys, kind="stable")
    heads = np.r_[True, keys[order][1:] != keys[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    levels = suffix_ranks(rank)
    last = levels[-1]
    array = np.argsort(last, kind="stable")
    lcp = np.zeros(n + 1, np.int64)
    lcp[1:n] = lcp_of(levels, array[:-1], array[1:])
    longest = np.empty(n, np.int64)
    longest[array] = np.maximum(lcp[:-1], lcp[1:])
    return longest, starts


def covered(longest: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Per text: words under the union of the spans of repeats of at least `least` words."""
    n = len(longest)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    under = np.r_[0, np.cumsum(np.cumsum(edge[:n]) > 0)]
    return under[starts[1:]] - under[starts[:-1]]


def measure(texts: list[list]) -> dict[str, np.ndarray]:
    """Per text: words under repeats of WINDOW and of MIN_REPEAT words, and words of the longest repeat."""
    longest, starts = repeats(texts)
    most = np.maximum.reduceat(np.r_[longest, 0], starts[:-1]) if len(texts) else np.zeros(0, np.int64)
    return {
        "n_repeat_words": covered(longest, starts, WINDOW),
        "n_covered": covered(longest, starts, MIN_REPEAT),
        "longest_repeat": np.where(np.diff(starts) > 0, most, 0),
    }


def duplicate_lines(text: str) -> int:
    seen, count = set(), 0
    for line in text.split("\n"):
        if line in seen:
            count += bool(line.strip(BLANKS))
        else:
            seen.add(line)
    return count


def rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text", most_covered: float = MOST_COVERED, longest_words: int = LONGEST_WORDS) -> DataFrame:
    """A row per row: the counts, base_failed, and kept: not base_failed and within both limits on repetition."""

    def work(texts: list) -> list:
        words = [words_of(t) for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        m = measure(words)
        failed = (n < LEAST_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * n)
        far = m["longest_repeat"] > longest_words
        kept = ~failed & (m["n_covered"] <= most_covered * n + 1e-9) & ~far
        chars = [len(t) - sum(map(t.count, BLANKS)) if t else 0 for t in texts]
        symbols = [sum(map(t.count, SYMBOLS)) if t else 0 for t in texts]
        lines = [duplicate_lines(t) if t else 0 for t in texts]
        counts = [n, chars, symbols, lines, m["n_repeat_words"], failed, kept, m["n_covered"], m["longest_repeat"]]
        return [pa.array(x, pa.bool_() if x is failed or x is kept else pa.int64()) for x in counts]

    schema = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, n_covered bigint, longest_repeat bigint"
    return map_texts(docs, work, schema, id_col, text=text)
