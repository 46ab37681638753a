from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import vectorcodes as v
from tallywatch.llm.common import ready
from tests.llm.helpers import collected

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, l string"


def brute(rows, entries=256, rounds=4):
    """The same by plain loops over rows of (vec_id, vector, label)."""
    kept = [(i, [float(np.float32(x)) for x in e], l) for i, e, l in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    width = -(-max((len(e) for _, e, _ in kept), default=0) // 4) * 4
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[max(-v.BOUND, min(v.BOUND, math.floor(1024 * x))) for x in e] + [0] * (width - len(e)) for _, e, _ in kept]
    wide = width // 4
    parts = [[x[p * wide: (p + 1) * wide] for x in ints] for p in range(4)]
    books = [[list(x) for x in part[:entries]] for part in parts]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            members = {}
            for x in parts[p]:
                members.setdefault(nearest(books[p], x)[1], []).append(x)
            for i, xs in members.items():
                books[p][i] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [[nearest(books[p], parts[p][r]) for p in range(4)] for r in range(len(kept))]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, l), e in zip(kept, errors):
        by_label[l] = by_label.get(l, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in f), e, by_label[r[2]], sha) for r, f, e in zip(kept, found, errors)), key=repr)


def table(spark, rows):
    return ready(spark).createDataFrame([(i, e, l, "c", "e", "l") for i, e, l in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_loops(spark, seed):
    rnd = random.Random(seed)
    common = [rnd.gauss(0, 0.2) for _ in range(12)]
    rows = [(rnd.randrange(10**6), common if rnd.random() < 0.3 else [rnd.gauss(0, 0.2) for _ in range(12)], rnd.choice([1, 1, 1, 2, 3, None]))
            for _ in range(900)]
    rows += [(None, common, 1), (5, None, 1), (6, [None] * 12, 1), (7, [math.inf] * 12, 1), (8, [math.nan] * 12, 2), (9, common, 2), (9, common, 2)]
    assert sorted(collected(v.digests(table(spark, rows))), key=repr) == brute(rows)


def test_odd_lengths_and_wide_components(spark):
    rows = [(1, [0.5] * 6, 1), (2, [0.25] * 5, 1), (3, [], None), (4, [1e30] * 6, 2), (5, [-1e30] * 6, 2), (6, [3e38] * 3, 2)]
    assert sorted(collected(v.digests(table(spark, rows))), key=repr) == brute(rows)


def test_empty_and_few(spark):
    assert collected(v.digests(table(spark, []))) == []
    assert sorted(collected(v.digests(table(spark, [(3, [], None)])))) == brute([(3, [], None)])
    assert sorted(collected(v.digests(table(spark, [(1, [1.0, 2.0, 3.0, 4.0], 1)])))) == brute([(1, [1.0, 2.0, 3.0, 4.0], 1)])


def test_slices_find_the_nearest_of_ties_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (256, 8))
    centres[100:110] = centres[20]
    index = v.Slices(centres)
    parts = np.concatenate([centres[rng.integers(0, 256, 3000)] + rng.integers(-40, 40, (3000, 8)), rng.integers(-5000, 5000, (200, 8))])
    code, error = index.nearest(parts, 60)
    squares = ((parts[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (code == squares.argmin(axis=1)).all() and (error == squares.min(axis=1)).all()
    assert index.compared < 256 * len(parts) / 8


def test_hot_label_is_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(v, "HOT_LABELS", 4)
    coded = ready(spark).createDataFrame([(i, 1 if i < 60 else i if i < 80 else None, "00", i) for i in range(100)], "vec_id long, label int, code string, error long")
    sums = {}
    for i in range(100):
        sums[1 if i < 60 else i if i < 80 else None] = sums.get(1 if i < 60 else i if i < 80 else None, 0) + i
    found = collected(v.with_label_errors(coded).select("vec_id", "label", "label_error"))
    assert len(found) == 100 and all(e == sums[l] for _, l, e in found)


def test_long_sums_are_held(spark):
    coded = ready(spark).createDataFrame([(i, 1, "00", 2**62) for i in range(3)], "vec_id long, label int, code string, error long")
    assert v.with_label_errors(coded).select(F.max("label_error")).first()[0] == 2**63 - 1
