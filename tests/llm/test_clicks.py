"""Expiring click deduplication: the stream against a fold in plain Python, late rows, hot clicks, restarts."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest

pytest.importorskip("loomspark.llm.queries")
from loomspark.llm import clicks as C  # noqa: E402
from loomspark.llm import queries as Q  # noqa: E402

SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
EPOCH = datetime(1970, 1, 1)


def micros(t: datetime) -> int:
    return (t - EPOCH) // timedelta(microseconds=1)


def copies_of(rows: list) -> list[tuple]:
    """(batch, click, hour, hash) of every copy."""
    made = []
    for click, ts, arrived, client, kind, value, props in rows:
        if click is None or arrived is None:
            continue
        for j in range(click % 3 + 1):
            c = zlib.crc32(f"{click}:{j}".encode())
            hour = micros(arrived) // 3_600_000_000 + 6 * j * (c % 10)
            show = lambda x: "" if x is None else str(x)
            cents = None if value is None else math.floor(100 * value + 0.5)
            text = "|".join(map(show, (client, kind, cents, None if ts is None else micros(ts), props, c % 3)))
            made.append((hour + c // 10 % 200, click, hour, hashlib.sha256(text.encode()).hexdigest()))
    if not made:
        return []
    low, high = min(m[0] for m in made), max(m[0] for m in made)
    return [((m[0] - low) * 12 // (high - low + 1), *m[1:]) for m in made]


def played(copies: list[tuple], batches: int = 12) -> list[tuple]:
    """(click, start, closed, repeats, conflicts, crc, hash), row by row as the rules say."""
    by, out, windows, newest = defaultdict(list), [], {}, None
    for b, *row in copies:
        by[b].append(tuple(row))
    for b in range(batches):
        rows = [r for r in by[b] if newest is None or r[1] >= newest - 48]
        for click, hour, digest in sorted(rows):
            w = windows.get(click)
            if w and hour <= w[1] + 72:
                w[2] += 1
                if digest != w[5]:
                    w[3] += 1
                    w[4] += zlib.crc32(digest.encode())
            else:
                if w:
                    out.append((w[0], w[1], b, *w[2:]))
                windows[click] = [click, hour, 0, 0, 0, digest]
        newest = max([r[1] for r in by[b]] + ([] if newest is None else [newest]), default=newest)
        for click, w in list(windows.items()):
            if b == batches - 1 or (newest is not None and w[1] + 72 < newest - 48):
                out.append((w[0], w[1], b, *w[2:]))
                del windows[click]
    return sorted(out)


def shown(df) -> list[tuple]:
    return sorted((r["click_id"], r["start_hour"], r["closed_batch"], r["n_repeats"], r["n_conflicts"], r["conflict_crc"], r["hash"]) for r in df.collect())


def query(spark, tables, rows):
    return Q.op12_click_dedup(spark, tables(clicks=spark.createDataFrame(rows, SCHEMA)))


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/clicks.parquet").select(*(c.split()[0] for c in SCHEMA.split(", "))).collect()]
    want = played(copies_of(rows))
    assert len({w[2] for w in want}) > 6
    assert shown(Q.op12_click_dedup(spark, sf)) == want


def test_hot_clicks_and_edges(spark, tables, monkeypatch):
    """A third of all rows has one click; it is thinned. Nulls everywhere, rows alike, ties of the hour."""
    monkeypatch.setattr(C, "BUSY_ROWS", 200)
    monkeypatch.setattr(C, "BUCKET_ROWS", 300)
    rnd, start = random.Random(5), datetime(2024, 1, 1)
    at = lambda: start + timedelta(hours=rnd.randint(0, 900), seconds=rnd.randint(0, 3599))
    rows = [(7 if i % 3 == 0 else rnd.randint(0, 300), at(), at(), rnd.choice([1, 2, None]), rnd.choice(["a", "b", None]), rnd.choice([1.0, 0.005, None]), rnd.choice(["{}", None, "x|y"])) for i in range(1500)]
    rows += [(8, start, start, 1, "a", 1.0, "{}")] * 40 + [(None, start, start, 1, "a", 1.0, "{}"), (9, start, None, 1, "a", 1.0, "{}"), (10, None, start, None, None, None, None)]
    want = played(copies_of(rows))
    assert shown(query(spark, tables, rows)) == want


def test_empty(spark, tables):
    assert query(spark, tables, []).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_fold(seed):
    """Windows open before, rows standing for several, rows that open nothing: against one row after the other."""
    rnd = random.Random(seed)
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(4)]
    before = {c: [c, rnd.randint(0, 100), 1, 0, 0, rnd.choice(digests)] for c in rnd.sample(range(8), 4)}
    rows = [(rnd.randint(0, 7), rnd.randint(0, 300), rnd.choice(digests), rnd.randint(1, 3)) for _ in range(rnd.randint(1, 60))]
    want, windows = [], {c: list(w) for c, w in before.items()}
    for click, hour, digest, n in sorted(rows):
        for _ in range(n):
            w = windows.get(click)
            if w and hour <= w[1] + 72:
                w[2] += 1
                w[3] += digest != w[5]
                w[4] += zlib.crc32(digest) * (digest != w[5])
            else:
                if w:
                    want.append(tuple(w))
                windows[click] = [click, hour, 0, 0, 0, digest]
    held = np.array([(w[0], w[1], np.void(w[5]), w[2], w[3], w[4]) for w in sorted(before.values())], C.WINDOW)
    click, hour, n = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 3))
    crc = np.array([zlib.crc32(r[2]) * r[3] for r in rows], np.int64)
    closed, after = C.fold(held, click, hour, np.frombuffer(b"".join(r[2] for r in rows), "V32"), np.ones(len(rows), bool), n, crc)
    plain = lambda a: sorted((int(w["click"]), int(w["start"]), int(w["repeats"]), int(w["conflicts"]), int(w["crc"]), bytes(w["digest"])) for w in a)
    assert plain(closed) == sorted(want)
    assert plain(after) == sorted(tuple(w) for w in windows.values())
