"""Byte-level BPE with public rank files: padded numpy matrices merge many words at once; ids decode back to bytes.

Words of similar length are rows of one matrix. Each round every row merges its pair of lowest rank, the leftmost and, from
there on, each further one of the same pair that does not overlap: the order in which one merge at a time would take them,
as long as what a merge makes new pairs of ranks above it. Vocabularies without that property merge the leftmost alone.

Cases: null and empty texts have no ids; texts and words of any length are taken whole (a matrix of long words has fewer
rows); repeated rows are encoded alike; an empty table gives no rows; other columns are not read, so no name clashes.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_texts

#: White_Space of Unicode, which \s means in the pattern: the regex module's own \s differs in a few control characters.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Words whose ids a worker remembers, and cells of a matrix.
REMEMBERED, CELLS = 400_000, 1 << 20
NONE = np.int64(1) << 40


def pattern_of(source: str) -> regex.Pattern:
    return regex.compile(source.replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]").replace("\\S", f"[^{SPACE}]"))


class PairTable:
    """Open-addressing hash table from a pair of ids to the rank of the merged token."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.mask = (1 << max(4, (4 * len(pairs)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks = np.full(self.mask + 1, NONE, np.int64)
        keys = np.array([a << 20 | b for a, b in pairs], np.int64)
        ranks = np.array(list(pairs.values()), np.int64)
        at = self.slot(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several for one slot the last one stays
            done = self.keys[at] == keys
            self.ranks[at[done]] = ranks[done]
            keys, ranks, at = keys[~done], ranks[~done], (at[~done] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).view(np.int64) & self.mask

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where either id is a pad (-1) or the pair does not merge."""
        keys = left << 20 | right
        at = self.slot(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        at, rest = at.ravel()[open_] if at.ndim > 1 else at[open_], keys.ravel()[open_]
        for _ in range(self.probes):
            if not len(open_):
                break
            at = (at + 1) & self.mask
            seen = self.keys[at]
            hit = seen == rest
            out.ravel()[open_[hit]] = self.ranks[at[hit]]
            more = ~hit & (seen >= 0)
            open_, at, rest = open_[more], at[more], rest[more]
        out[(left < 0) | (right < 0)] = NONE
        return out


class Encoder:
    """Ids of a rank file; rank is id."""

    def __init__(self, rank_path: str, pattern: str):
        with open(rank_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {v: k for k, v in self.ranks.items()}
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if (a := self.ranks.get(token[:cut])) is not None and (b := self.ranks.get(token[cut:])) is not None:
                    pairs[a, b] = rank
        self.table = PairTable(pairs)
        self.rising = False
        self.rising = self.is_proper()
        self.pattern = pattern_of(pattern)
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def is_proper(self) -> bool:
        """Whether every token is two parts just before its own merge. Then a merge never makes a pair that can still meet a
        lower rank: up to there the bytes of that pair would have merged as they do alone."""
        longer = sorted((t for t in self.ranks if len(t) > 1), key=len)
        for k in range(0, len(longer), 4096):
            part = longer[k : k + 4096]
            if any(len(ids) != 2 for ids in self.matrix(part, np.array([self.ranks[t] for t in part], np.int64))):
                return False
        return True

    def matrix(self, words: list[bytes], below: np.ndarray | None = None) -> list[list[int]]:
        """Ids of words of similar length. Each round every open row merges its pair of lowest rank; pads move out. `below`
        gives ranks at which the rows stop."""
        n, width = len(words), max(map(len, words))
        ids = np.full((n, width + 1), -1, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        ids[:, :-1][np.arange(width) < sizes[:, None]] = flat
        out: list[list[int] | None] = [None] * n
        row = np.arange(n)
        ranks = self.table(ids[:, :-1], ids[:, 1:])
        while len(row):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(row)), at]
            over = best >= (NONE if below is None else below[row])
            if over.any():
                for r, x in zip(row[over].tolist(), ids[over].tolist(), strict=True):
                    out[r] = x[: x.index(-1)]
                keep = ~over
                row, ids, ranks, at, best = row[keep], ids[keep], ranks[keep], at[keep], best[keep]
                if not len(row):
                    break
            lowest = ranks == best[:, None]
            if self.rising and np.count_nonzero(lowest) > len(row):
                ids, ranks = self.merge_all(ids, ranks, lowest, best)
            else:
                ids, ranks = self.merge_first(ids, ranks, at, best)
        return out

    def merge_first(self, ids: np.ndarray, ranks: np.ndarray, at: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One merge a row, at `at`."""
        lanes = np.arange(len(ids))
        ids[lanes, at] = best
        shift = np.arange(ids.shape[1] - 1) > at[:, None]
        ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
        ids[:, -1] = -1
        ranks[:, :-1] = np.where(shift[:, :-1], ranks[:, 1:], ranks[:, :-1])
        ranks[:, -1] = NONE
        ranks[lanes, at] = self.table(ids[lanes, at], ids[lanes, at + 1])
        before = np.maximum(at - 1, 0)
        ranks[lanes, before] = np.where(at > 0, self.table(ids[lanes, before], ids[lanes, before + 1]), ranks[lanes, before])
        if ids.shape[1] > 4 and (ids[:, -3] < 0).all():
            ids, ranks = np.ascontiguousarray(ids[:, :-1]), np.ascontiguousarray(ranks[:, :-1])
        return ids, ranks

    def merge_all(self, ids: np.ndarray, ranks: np.ndarray, lowest: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every merge of the row's pair, from the left; of pairs that overlap (a run of one id) every other one."""
        n, width = lowest.shape
        place = np.arange(width)
        run = place - np.maximum.accumulate(np.where(lowest, -1, place), axis=1) - 1
        hit = lowest & (run % 2 == 0)
        ids[:, :-1][hit] = np.broadcast_to(best[:, None], hit.shape)[hit]
        stay = np.ones(ids.shape, bool)
        stay[:, 1:] = ~hit
        left = stay.sum(1)
        valid = int((stay & (ids >= 0)).sum(1).max())
        wide = max(4, valid + 1)
        within = np.arange(ids.shape[1]) < left[:, None]
        packed, made, kept = np.full(ids.shape, -1, np.int64), np.zeros(ids.shape, bool), np.full(ids.shape, NONE, np.int64)
        packed[within] = ids[stay]
        made[within] = np.pad(hit, ((0, 0), (0, 1)))[stay]
        kept[within] = np.pad(ranks, ((0, 0), (0, 1)), constant_values=NONE)[stay]
        wide = min(wide, ids.shape[1])
        ids, made, ranks = packed[:, :wide].copy(), made[:, : wide - 1], kept[:, : wide - 1].copy()
        fresh = made.copy()
        fresh[:, :-1] |= made[:, 1:]
        r, c = np.nonzero(fresh)
        ranks[r, c] = self.table(ids[r, c], ids[r, c + 1])
        return ids, ranks

    def encode_words(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode() for w in words]
        out: list[list[int]] = [[]] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            buckets.setdefault((len(w) + 3) // 4, []).append(i)
        for size, at in buckets.items():
            rows = min(8192, max(1, CELLS // max(1, 4 * size)))
            for k in range(0, len(at), rows):
                part = at[k : k + rows]
                for i, ids in zip(part, self.matrix([raw[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def learn(self, words: set[str]) -> None:
        """Remember the words' number of ids, the ids as text and the bytes they decode to."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(words)
        for w, ids in zip(new, self.encode_words(new), strict=True):
            self.known[w] = (len(ids), ",".join(map(str, ids)), self.decode(ids))

    def encode(self, text: str | None) -> list[int]:
        found = self.pattern.findall(text or "")
        made = dict(zip(u := list(dict.fromkeys(found)), self.encode_words(u), strict=True))
        return [i for w in found for i in made[w]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(rank_path: str, pattern: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(rank_path, pattern)


def digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row: id, n_tokens, ids_sha256, decoded_sha256."""

    def work(texts: list) -> list:
        enc = encoder(rank_path, pattern)
        split = [enc.pattern.findall(t) if t else [] for t in texts]
        enc.learn(set().union(*split))
        known = enc.known
        counts, ids, decoded = [], [], []
        for words in split:
            found = [known[w] for w in words]
            counts.append(sum(x[0] for x in found))
            ids.append(hashlib.sha256(",".join([x[1] for x in found]).encode()).hexdigest())
            decoded.append(hashlib.sha256(b"".join([x[2] for x in found])).hexdigest())
        return [counts, ids, decoded]

    return map_texts(docs, work, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", id_col, text=text)


def token_ids(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids array<int>)."""
    import pyarrow as pa

    def work(texts: list) -> list:
        enc = encoder(rank_path, pattern)
        return [pa.array([enc.encode(t) for t in texts], pa.list_(pa.int32()))]

    return map_texts(docs, work, "ids array<int>", id_col, text=text)
