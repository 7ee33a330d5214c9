"""SimHash near-duplicates: bit-sliced comparison of fingerprints that share a block, then connected components.

Cases: a null, empty or blank text has fingerprint zero and links like any other; a text of fewer words than a shingle is
one shingle; repeated rows give as many rows; a null id is carried and never becomes a component id unless it is alone;
rows that share an id are rows of their own; ties go to the smallest id; an empty table gives no rows; other columns are
carried inside a struct where they are carried at all, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialise, release

BITS, BLOCKS, RADIUS = 64, 4, 3
#: Fingerprints of one bucket that are compared in one go, and bytes of shingle hashes that come with them; larger buckets
#: are compared chunk by chunk.
CHUNK, CHUNK_SET_BYTES = 4096, 32 << 20


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64 bits; one is set where over half of the shingles' XXH64 have it set."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in shingles), dtype=np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp): a row per row, fp as a signed long."""

    def work(texts: list) -> list:
        return [np.array([fingerprint(t, width, seed) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, work, "fp bigint", id_col, text=text)


def block_keys(fp: Column) -> Column:
    """16 keys of 28 bits and a table number: two fingerprints within RADIUS share one key at least.

    Three differing bits leave one of four 16-bit blocks equal, and one of four 12-bit parts of the other 48 bits.
    """
    keys = []
    for i in range(BLOCKS):
        block = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        rest = fp.bitwiseAND(F.lit((1 << 16 * i) - 1)) if i else F.lit(0).cast("bigint")
        if i < 3:
            rest = rest.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 16 * (i + 1)), 16 * i))
        for j in range(BLOCKS):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((i * BLOCKS + j) << 28).cast("bigint") + F.shiftleft(block, 12) + part)
    return F.array(*keys)


def longer_keys(fp: Column, key: Column) -> Column:
    """Four keys of nine bits more for a key: of what it leaves over, 36 bits, two fingerprints within RADIUS share a part.

    Keys are hashes; two that fall together only bring strangers into one bucket, where their distance tells them apart.
    """
    block, part = (F.shiftrightunsigned(key, 28) / BLOCKS).cast("int"), (F.shiftrightunsigned(key, 28) % BLOCKS).cast("int")
    cut = lambda x, at, width: [x.bitwiseAND(F.lit((1 << at) - 1)).bitwiseOR(F.shiftleft(F.shiftrightunsigned(x, at + width), at)) if at + width < 64 else x.bitwiseAND(F.lit((1 << at) - 1))][0]
    choose = lambda n, xs: F.coalesce(*(F.when(n == k, x) for k, x in enumerate(xs)))
    rest = choose(block, [cut(fp, 16 * i, 16) for i in range(BLOCKS)])
    left = choose(part, [cut(rest, 12 * j, 12).bitwiseAND(F.lit((1 << 36) - 1)) for j in range(BLOCKS)])
    return F.array(*(F.xxhash64(key, F.lit(p), F.shiftrightunsigned(left, 9 * p).bitwiseAND(F.lit(511))) for p in range(4)))


def close_pairs(unit: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of equal unit and at most `radius` differing bits; units lie together. fps: rows of 64-bit words.

    Bit planes are vertical: bit i of plane b is bit b of fingerprint i. For a lag s, plane ^ (plane >> s) holds one bit of
    the distance of every pair (i, i + s); carry-save counters add the planes up, and a lag is left as soon as no pair is
    within the radius.
    """
    n = len(fps)
    as_int = lambda bits: int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    spread = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(n, -1), axis=1, bitorder="little")
    varied = np.flatnonzero((spread != spread[:1]).any(0)) if n else []
    planes = [as_int(spread[:, b]) for b in varied]
    tops = (radius + 1).bit_length()
    for lag in range(1, n):
        same = unit[lag:] == unit[:-lag]
        if not same.any():
            return
        alive = as_int(same)
        counters = [0] * tops
        for at, plane in enumerate(planes):
            carry = (plane ^ (plane >> lag)) & alive
            for k in range(tops):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
                if not carry:
                    break
            if at >= radius:
                alive &= ~(carry | over(counters, radius))
                if not alive:
                    break
        if alive:
            at = np.flatnonzero(np.unpackbits(np.frombuffer(alive.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little"))
            yield at, at + lag


def over(counters: list[int], radius: int) -> int:
    """Where the vertical counters hold more than radius."""
    more, equal = 0, -1
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def forest(
    unit: np.ndarray,
    fps: np.ndarray,
    radius: int = RADIUS,
    verify: Callable[[int, int], bool] | None = None,
    known: np.ndarray | None = None,
    may: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Index links (member, representative) that span the groups of close fingerprints in each unit.

    With `verify`, a close pair links only if that agrees; pairs that are linked already are not asked about, nor are those
    with the same `known` label, nor those that `may` rules out, which takes many pairs at once. Once every unit is one group,
    no further pair can matter.
    """
    label = np.arange(len(fps))
    if known is not None:
        _, first, same = np.unique(np.stack([unit, known]), axis=1, return_index=True, return_inverse=True)
        label = first[same.reshape(-1)]
    start = label.copy()
    apart = len(np.unique(label)) - len(np.unique(unit))
    for i, j in close_pairs(unit, fps, radius) if apart else ():
        if not apart:
            break
        i, j = i[m := label[i] != label[j]], j[m]
        if may is not None and len(i):
            i, j = i[m := may(i, j)], j[m]
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            a, b = x, y
            while label[a] != a:
                a = label[a]
            while label[b] != b:
                b = label[b]
            if a != b and (verify is None or verify(x, y)):
                label[max(a, b)] = min(a, b)
                apart -= 1
        while (label[label] != label).any():
            label = label[label]
    at = np.flatnonzero(label != start)
    return at, label[at]


def load_of(similarity: float | None) -> Column:
    """The share of a chunk that a vertex takes."""
    return F.lit(1.0 / CHUNK) if similarity is None else F.greatest(F.lit(1.0 / CHUNK), F.col("set_bytes") / F.lit(float(CHUNK_SET_BYTES)))


def dealt(keyed: DataFrame, sizes: DataFrame) -> DataFrame:
    """(key, unit, v, label): the units of its key, pairs of chunks, in which each vertex is compared.

    A key within one chunk is one unit. A larger one is cut along the labels: a label beyond one chunk has chunks of its own,
    which never meet each other, since all of it is linked already; the vertices of small labels share chunks, which meet all.
    So a group that is one label but for a few meets those few, and is not copied once for each of its own chunks.
    """
    if sizes.where("chunks > 1").isEmpty():
        return keyed.join(sizes.select("key"), "key").select("key", F.lit(0).cast("bigint").alias("unit"), "v", "label")
    whole = keyed.join(sizes.where("chunks <= 1").select("key"), "key").select("key", F.lit(0).cast("bigint").alias("unit"), "v", "label")
    large = keyed.join(sizes.where("chunks > 1").select("key"), "key")
    labels = large.groupBy("key", "label").agg(F.sum("load").alias("load"))
    rest = labels.where("load <= 1").groupBy("key").agg(F.ceil(F.sum("load")).cast("int").alias("parts"))
    own = labels.where("load > 1").select("key", "label", F.ceil("load").cast("int").alias("own_parts"))
    spread = lambda n: F.pmod(F.xxhash64("v"), n.cast("bigint")).cast("string")
    placed = large.join(own, ["key", "label"], "left").join(rest, "key", "left")
    at = F.when(F.col("own_parts").isNull(), F.concat(F.lit("rest/"), F.pmod(F.xxhash64("label"), F.col("parts").cast("bigint")).cast("string"))).otherwise(F.concat("label", F.lit("/"), spread(F.col("own_parts"))))
    placed = placed.select("key", "v", "label", at.alias("at"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1).cast("array<string>")).alias("i")
    chunks = own.select("key", F.col("label").alias("of"), numbers(F.col("own_parts"))).select("key", "of", F.concat("of", F.lit("/"), "i").alias("at"))
    chunks = chunks.unionByName(rest.select("key", F.lit(None).cast("bigint").alias("of"), numbers(F.col("parts"))).select("key", "of", F.concat(F.lit("rest/"), "i").alias("at")))
    other = chunks.select("key", F.col("of").alias("of2"), F.col("at").alias("at2"))
    # each chunk with every other but those of its own label; chunks of small labels also with themselves
    meets = chunks.join(other, "key").where("(of IS NULL AND of2 IS NULL) OR NOT (of <=> of2)")
    meets = meets.select("key", "at", F.xxhash64(F.least("at", "at2"), F.greatest("at", "at2")).alias("unit"))
    return whole.unionByName(placed.join(meets, ["key", "at"]).select("key", "unit", "v", "label"))


def links(distinct: DataFrame, held: DataFrame | None = None, radius: int = RADIUS, similarity: float | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """(u, v): links that join all fingerprints of one key within `radius` into their components.

    distinct: v (vertex), keys array<bigint>, for a similarity also set_bytes; maybe `label`, which vertices share that are
    linked already. held: v and words array<bigint> (its fingerprint), for a similarity also `shingles`, the whole set of
    shingle hashes to which pairs within the radius are held; without it v is the fingerprint. Only vertices whose keys are
    shared take their words along. sizes: (key, n, chunks) of the keys that are shared, where that is known.
    """
    labelled = "label" in distinct.columns
    keyed = distinct.select("v", (F.col("label") if labelled else F.col("v")).alias("label"), F.explode("keys").alias("key"), load_of(similarity).alias("load"))
    sized = lambda df: materialise(df.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("load").alias("chunks")).where("n > 1"), "bucket-sizes")
    sizes = sized(keyed) if sizes is None else sizes
    if held is None:
        # a bucket beyond one chunk is split by longer keys, of which again no close pair misses all
        hot = sizes.where(F.col("n") > CHUNK).select("key")
        if not hot.isEmpty():
            again = keyed.join(hot, "key", "left_semi").select("v", "label", F.explode(longer_keys(F.col("v"), F.col("key"))).alias("key"), "load")
            keyed = keyed.join(hot, "key", "left_anti").select("v", "label", "key", "load").unionByName(again)
            sizes = sized(keyed)
    shared = dealt(keyed, sizes)
    wide = shared.withColumn("words", F.array("v")) if held is None else shared.join(held, "v")
    columns = ["key", "unit", "v", "label", "words"] + ["shingles"] * (similarity is not None)
    units = wide.select(*columns).repartition("key", "unit").sortWithinPartitions("key", "unit", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[np.ndarray] = []

        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            edge = np.zeros(len(columns[0]), bool)
            for c in columns[:2]:
                edge[1:] |= c[1:] != c[:-1]
            unit, known = np.cumsum(edge), columns[3] if labelled else None
            if similarity is None:
                i, j = forest(unit, columns[4], radius, None, known)
            else:
                i, j = verified(unit, columns[4], columns[5], radius, similarity, known)
            return pa.RecordBatch.from_arrays([pa.array(columns[2][i]), pa.array(columns[2][j])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]]
            rows.append(batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            if similarity is not None:
                rows.append(sets_of(batch.column(5)))
            rows = [np.concatenate(x) for x in zip(left, rows, strict=True)] if left else rows
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield found([c[:cut] for c in rows])
            left = [c[cut:] for c in rows]
        if left:
            yield found(left)

    return units.mapInArrow(compare, "u bigint, v bigint")


def sets_of(column: pa.Array) -> np.ndarray:
    """Shingle sets, as they were written."""
    sets = np.empty(len(column), object)
    sets[:] = [np.frombuffer(x, np.uint64) for x in column.to_pylist()]
    return sets


#: Members from which a unit has a bitmap of its shared shingles, and how many of those have a bit.
LARGE, SHARED = 64, 4096


def verified(unit: np.ndarray, fps: np.ndarray, sets: np.ndarray, radius: int, similarity: float, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Like `forest`, of pairs whose whole sets resemble each other so much. Large units go one at a time: in a group whose
    fingerprints are all close and whose sets mostly are not similar, every pair is asked about, and bitmaps answer that."""
    starts = np.flatnonzero(np.diff(unit, prepend=unit[:1] - 1))
    large = np.diff(starts, append=len(unit)) > LARGE
    cuts = starts[large | np.append(True, large[:-1])] if len(starts) else starts
    links = []
    for a, b in pairwise([*cuts, len(unit)]):
        own = sets[a:b]
        verify = lambda x, y, own=own: similar(own[x], own[y], similarity)
        may = overlap(own, similarity) if b - a > LARGE and unit[a] == unit[b - 1] else None
        i, j = forest(unit[a:b], fps[a:b], radius, verify, None if known is None else known[a:b], may)
        links.append((i + a, j + a))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*links, strict=True) if links else ([], [])))


def overlap(sets: np.ndarray, similarity: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether pairs of sets can resemble each other so much, for many pairs at once; it never says no where they do.

    The shingles that most of the sets share have a bit each, so AND and popcount give what two sets have of them in common.
    Of other shared ones a pair has at most as many as the set with fewer, of shingles in one set alone none.
    """
    sizes = np.array([len(x) for x in sets])
    every = np.sort(np.concatenate(list(sets))) if sizes.sum() else np.zeros(0, np.uint64)
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    times, values = np.diff(first, append=len(every)), every[first]
    shared, times = values[times > 1], times[times > 1]
    often = np.sort(shared[np.argsort(-times, kind="stable")[:SHARED]])
    words, other = np.zeros((len(sets), -(-len(often) // 64)), np.uint64), np.zeros(len(sets), np.int64)

    def places(of: np.ndarray, x: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(of, x), max(len(of) - 1, 0))
        return at[of[at] == x] if len(of) else at[:0]

    for k, x in enumerate(sets):
        bits = np.zeros(words.shape[1] * 64, bool)
        bits[at := places(often, x)] = True
        words[k] = np.packbits(bits, bitorder="little").view(np.uint64)
        other[k] = len(places(shared, x)) - len(at) if len(shared) > len(often) else 0

    def may(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        common = np.bitwise_count(words[i] & words[j]).sum(1, dtype=np.int64) + np.minimum(other[i], other[j])
        return common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9

    return may


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex but the roots: alternating large and small stars until the links stay as they are."""

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select("u", "v")
        if large:
            both = both.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.where("u != v").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = materialise(edges.where("u != v").distinct(), "links")
    mark = state(now)
    while mark[0]:
        before, now = now, materialise(star(star(now, True), False), "links")
        release(before)
        if (new := state(now)) == mark:
            break
        mark = new
    return now.select(F.col("u").alias("v"), F.col("v").alias("root"))


def grouped(own: DataFrame, edges: DataFrame, vertex: str, id_col: str) -> DataFrame:
    """own with component_id (the smallest id that links reach) and component_size."""
    ids = own.groupBy(F.col(vertex).alias("v")).agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("copies"))
    roots = components(edges)
    placed = ids.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    whole = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("component_size"))
    by_vertex = placed.select("v", "root").join(whole, "root").select(F.col("v").alias(vertex), "component_id", "component_size")
    return own.join(by_vertex, vertex)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """A row per row: id, fp, component_id, component_size. Fingerprints within `radius` (3 at most) link, none is missed."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must be 0 to {RADIUS}")
    own = materialise(fingerprints(docs, id_col, text, width), "fingerprints")
    vertices = own.select(F.col("fp").alias("v")).distinct()
    distinct = materialise(vertices, "distinct").select("v", block_keys(F.col("v")).alias("keys"))
    return grouped(own, links(distinct, None, radius), "fp", id_col).select(id_col, "fp", "component_id", "component_size")


#: For similarities: words of a longer fingerprint, and bands of least hashes that choose what is compared. A band holds a
#: pair at 0.8 with probability 0.41, so all of them miss 5 of 100 million.
LONG_WORDS, BANDS, BAND_ROWS = 4, 32, 4
_MIX = np.random.default_rng(20240229).integers(1, 1 << 63, (2, BANDS * BAND_ROWS + LONG_WORDS), dtype=np.uint64) | np.uint64(1)


def scramble(h: np.ndarray, ks: slice) -> np.ndarray:
    """Several independent 64-bit hashes of each hash, a row for each of them."""
    x = (h ^ _MIX[0, ks, None]) * _MIX[1, ks, None]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def shingle_set(text: str | None, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of the different shingles, in order; a text of fewer words is one shingle, a text without words has none."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in shingles), dtype=np.uint64))


def vertex(h: np.ndarray) -> int:
    """A hash of a whole set, as a signed long."""
    x = xxhash.xxh64_intdigest(h.tobytes())
    return x - (1 << 64) if x >> 63 else x


def sketch(text: str | None, width: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """LONG_WORDS * 64 fingerprint bits, a hash for each band, and the shingle set itself. Without words all bits are zero."""
    h = shingle_set(text, width, seed)
    if not len(h):
        return np.zeros(LONG_WORDS, np.uint64), np.zeros(BANDS, np.uint64), h
    ones, low = np.zeros((LONG_WORDS, BITS), np.int64), np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 2048):
        part = h[at : at + 2048]
        bits = np.unpackbits(scramble(part, slice(0, LONG_WORDS)).view(np.uint8).reshape(LONG_WORDS, -1, 8), axis=2, bitorder="little")
        ones += bits.sum(1, dtype=np.int64)
        low = np.minimum(low, scramble(part, slice(LONG_WORDS, None)).min(1))
    fp = np.packbits(2 * ones > len(h), axis=1, bitorder="little").view(np.uint64)[:, 0]
    return fp, np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(low.reshape(BANDS, BAND_ROWS))], np.uint64), h


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two ordered sets; two empty ones are equal."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two ordered sets resemble each other so much; sizes that are too different tell without a look inside."""
    return min(len(a), len(b)) >= similarity * max(len(a), len(b)) - 1e-9 and resemblance(a, b) >= similarity


def reach_of(similarity: float, spread: float = 6.0) -> int:
    """Bits within which fingerprints of two sets of this Jaccard similarity differ: so many standard deviations above the
    mean of the worst case.

    For large sets of one size, which differ most, a bit differs with the probability that the angle gives. The votes of
    small sets can tie, which may put it higher, so those are counted out; from MANY on the two agree closely.
    """
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    p = max([p, *(odds_of(c, a, b) for c in range(1, MANY) for a in range(c) for b in range(a, c) if c >= similarity * (c + a + b) - 1e-9)])
    n = LONG_WORDS * BITS
    return int(np.ceil(n * p + spread * np.sqrt(n * p * (1 - p))))


#: Shingles in common below which the odds of a differing bit are counted out.
MANY = 48


def odds_of(common: int, a: int, b: int) -> float:
    """Probability that a bit of two fingerprints differs: sets with so many shingles in common and of their own."""
    ones = lambda n: np.array([comb(n, k) / 2.0**n for k in range(n + 1)])
    c = np.arange(common + 1)[:, None]
    up = lambda own: ((2 * (c + np.arange(own + 1)) > common + own) * ones(own)).sum(1)
    x, y = up(a), up(b)
    return float((ones(common) * (x * (1 - y) + y * (1 - x))).sum())


def row_key(id_col: str, text: str) -> list[Column]:
    """128 bits that tell rows apart by id and text, null ids and texts included."""
    both = F.struct(F.col(id_col).isNull(), F.col(text).isNull(), F.col(id_col), F.col(text))
    return [F.xxhash64(both).alias("k1"), F.xxhash64(F.lit("second"), both).alias("k2")]


ROW = ["k1", "k2"]


def similar_rows(docs: DataFrame, similarity: float = 0.8, width: int = 5, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, k1, k2, v) of each row, and (u, v): links that join the vertices of a component. A vertex is a set of shingles.

    A radius of three bits stands for a far higher similarity, so fingerprints are longer here, and what is compared bit by
    bit are the documents that share a band of least hashes. Both only choose: documents that reach each other within the
    radius are a group, and within a group the whole shingle sets decide every link. Equal texts always link.
    """
    longs = lambda xs: pa.array([list(x.view(np.int64)) for x in xs], pa.list_(pa.int64()))

    def work(texts: list) -> list:
        fps, bands, sets = zip(*(sketch(t, width) for t in texts), strict=True)
        return [[vertex(h) for h in sets], longs(fps), longs(bands), pa.array([h.nbytes for h in sets], pa.int64())]

    def whole(texts: list) -> list:
        sets = [shingle_set(t, width) for t in texts]
        return [[vertex(h) for h in sets], pa.array([h.tobytes() for h in sets], pa.binary())]

    if not 0.8 <= similarity <= 1:
        raise ValueError("similarity must be 0.8 to 1: the bands are made for no less")
    rows = docs.select(F.col(id_col).alias("id"), *row_key(id_col, text), F.col(text).alias("text"))
    own = materialise(map_texts(rows, work, "v bigint, words array<bigint>, bands array<bigint>, set_bytes bigint", "id", *ROW), "sketches")
    # copies come down to one row before they meet anything: all of them have one set, so which of them stands for it does not
    # matter, and a set may be that of a third of all rows
    one = own.groupBy("v").agg(F.min(F.struct(*ROW)).alias("of"), F.first("words").alias("words"), F.first("bands").alias("bands"), F.first("set_bytes").alias("set_bytes"))
    one = materialise(one.select("v", "words", "bands", "set_bytes", "of.*"), "vertices")

    def sets(vertices: DataFrame, label: str) -> DataFrame:
        """(v, words, shingles) of some vertices, from their texts."""
        texts = rows.join(one.join(vertices, "v", "left_semi").select(F.col("v").alias("vertex"), "words", *ROW), ROW)
        held = map_texts(texts.select("vertex", "words", "text"), whole, "v bigint, shingles binary", "vertex", "words").where("v = vertex")
        return materialise(held.select("v", "words", "shingles").dropDuplicates(["v"]), label)

    radius = reach_of(similarity)
    keyed = one.select("v", F.col("bands").alias("keys"), "set_bytes")
    buckets = keyed.select("v", F.explode("keys").alias("key"), load_of(similarity).alias("load"))
    sizes = materialise(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("load").alias("load")).where("n > 1"), "buckets")
    hot = sizes.where("load > 1").select("key")
    sure = None
    if not hot.isEmpty():
        sure, labels = settled(materialise(buckets.join(hot, "key").select("key", "v"), "hot-buckets"), lambda those: sets(those, "hot-shingles"), similarity)
        keyed = keyed.join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    near = links(keyed, one.select("v", "words"), radius, sizes=sizes.select("key", "n", (F.col("n") / CHUNK).alias("chunks")))
    near = components(near if sure is None else near.unionByName(sure))
    groups = materialise(near.union(near.select("root", "root")).distinct().toDF("v", "root"), "groups")
    members = keyed.drop("keys").join(groups, "v").withColumn("keys", F.array("root"))
    found = links(members, sets(groups, "shingles"), radius, similarity)
    return own.select("id", *ROW, "v"), found if sure is None else found.unionByName(sure)


#: Rounds in which the members of very large buckets are held against one of them (a round costs the components of its links,
#: and the first two settle nearly all), and members that are held to one at a time.
ROUNDS, STAR = 2, 1024


def settled(members: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: float) -> tuple[DataFrame, DataFrame]:
    """(u, v): true links among the members (key, v) of buckets beyond one chunk; (v, label): what they join. `sets` gives
    (v, shingles) of vertices.

    Most such buckets are copies of one page with small changes. In a round each bucket has a pivot, and each vertex, with its
    whole set, is held to one pivot of its buckets with which it is not linked yet. A bucket whose members are all linked,
    over whatever vertices, is done. What is left after the rounds are links that cross labels, for `links` to find; so
    nothing is lost, but a bucket of a million edits of one page has been through one shuffle of its sets, not through one for
    each of its chunks.
    """
    held = sets(members.select("v").distinct())
    labels, found = members.select("v", F.col("v").alias("label")).distinct(), None
    for turn in range(ROUNDS):
        at = members.join(labels, "v")
        pivots = at.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(F.struct("v", "label"), F.xxhash64("v", F.lit(turn))).alias("pivot"))
        pivots = pivots.where("low <> high").select("key", F.col("pivot.v").alias("pivot"), F.col("pivot.label").alias("taken"))
        asked = at.join(pivots, "key").where("label <> taken").groupBy("v").agg(F.min("pivot").alias("pivot"))
        more = materialise(star_links(materialise(asked, "asked"), held, similarity), "star-links")
        if more.isEmpty():
            break
        found = more if found is None else materialise(found.unionByName(more), "sure-links")
        roots = components(found)
        labels = materialise(members.select("v").distinct().join(roots, "v", "left").select("v", F.coalesce("root", "v").alias("label")), "labels")
    return (members.sparkSession.createDataFrame([], "u bigint, v bigint") if found is None else found), labels


def star_links(asked: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """(u, v) of the pairs (v, pivot) whose sets resemble each other so much. A pivot's members are dealt out in parts, each
    with a copy of the pivot's set at its head; of the others none is held longer than it takes."""
    parts = asked.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("bigint").alias("parts"))
    own = asked.join(parts, "pivot").select("pivot", F.pmod(F.xxhash64("v"), F.col("parts")).alias("part"), F.lit(1).alias("kind"), "v")
    heads = parts.select("pivot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), F.col("pivot").alias("v"))
    rows = own.unionByName(heads).join(held.select("v", "shingles"), "v")
    stars = rows.select("pivot", "part", "kind", "v", "shingles").repartition("pivot", "part").sortWithinPartitions("pivot", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            found = []
            for pivot, kind, v, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), sets_of(batch.column(4)), strict=True):
                if not kind:
                    head = own
                elif similar(head, own, similarity):
                    found.append((v, pivot))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return stars.mapInArrow(run, "u bigint, v bigint")


def similar_documents(docs: DataFrame, similarity: float = 0.8, width: int = 5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row: id, component_id (the smallest id that links reach), component_size, linked at a Jaccard similarity of
    word shingles (see `similar_rows`)."""
    own, found = similar_rows(docs, similarity, width, id_col, text)
    return grouped(own, found, "v", "id").select(F.col("id").alias(id_col), "component_id", "component_size")


def keep_one(docs: DataFrame, similarity: float = 0.8, width: int = 5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, rows without an id last, and of rows with one
    id that of the smallest hash. Rows that share an id and differ in text are different rows; rows alike in both are one."""
    own, found = similar_rows(docs, similarity, width, id_col, text)
    roots = components(found)
    first = own.groupBy("v").agg(F.min(F.struct(F.col("id").isNull(), "id", *ROW)).alias("first"))
    placed = first.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    stay = placed.groupBy("root").agg(F.min("first").alias("first")).select(*(F.col(f"first.{k}").alias(k) for k in ROW))
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), *row_key(id_col, text))
    kept = rows.join(stay, ROW, "left_semi").groupBy(*ROW).agg(F.first("row").alias("row"))
    return kept.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
