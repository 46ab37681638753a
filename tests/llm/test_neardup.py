from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tallywatch.llm import neardup as n
from tallywatch.llm.common import ready
from tallywatch.llm.shingles import sets_of
from tests.llm.helpers import collected, empty_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i: i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def roots(rows, k, percent):
    """A number of each row's component; None for rows that are linked with nothing."""
    sets = [shingles(t, k) if i is not None else set() for i, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, left in enumerate(sets):
        for y in range(x + 1, len(sets)):
            both = len(left & sets[y])
            if left and sets[y] and 100 * both >= percent * (len(left) + len(sets[y]) - both):
                group[root(y)] = root(x)
    return [root(x) if own else None for x, own in enumerate(sets)]


def brute(rows, k, percent):
    """Rows are documents; a component's number is its smallest id."""
    found, least = roots(rows, k, percent), {}
    for (i, _), r in zip(rows, found):
        least[r] = i if r is None else min(i, least.get(r, i))
    out = []
    for (i, t), r in zip(rows, found):
        c = i if r is None else least[r]
        out.append((i, len(shingles(t, k)), c, i == c))
    return out


def family(rnd, first, size, words, edits):
    base = [rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randint(0, 60)) for _ in range(words)]
    for i in range(size):
        own = base[:]
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"x{rnd.randint(0, 9999)}"
        yield first + i, " ".join(own).title()


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(n, "MEET", 8)
    rnd = random.Random(k)
    more = [x for f in range(6) for x in family(rnd, 100 * (f + 1), 40, rnd.choice([20, 80, 200]), rnd.choice([1, 4, 8]))]
    more += [(900 + i, more[i][1]) for i in range(0, 60, 3)]
    docs = odd_docs(ready(spark), more)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(collected(n.near_duplicates(docs, k, percent)), key=repr) == sorted(brute(rows, k, percent), key=repr)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, np.uint64) * np.uint64(2)
    a, b = np.sort(pool[:2000]), np.sort(pool[500:2500])
    both = np.unique(np.concatenate([a, b]))
    held = [n.registers(s, np.array([0, len(s)]))[0] for s in (a, b, both)]
    assert (n.merged(held[0], held[1]) == held[2]).all()
    found = n.similarity(*(np.array([x]) for x in ((held[0] > held[1]).sum(), (held[0] < held[1]).sum(), 2000.0, 2000.0)))[0]
    assert abs(found - 1500 / 2500) < 0.12


def test_shingles_equal_brute_force():
    rnd = random.Random(2)
    texts = ["", " ", "a", "a b", "a b c", "A B\x0bC d", "é É ß x", *(" ".join(rnd.choices("ab", k=rnd.randint(0, 12))) for _ in range(50))]
    for k in (1, 3, 5):
        assert [len(s) for s in sets_of(texts, k)] == [len(shingles(t, k)) for t in texts]


def test_empty(spark):
    assert collected(n.near_duplicates(empty_docs(ready(spark)))) == []


@pytest.mark.parametrize("similarity,stated", [(0.8, 3.1e-6), (0.85, 1e-8)])
def test_chance_to_miss_a_pair_at_the_threshold(similarity, stated):
    same = np.arange(n.REGISTERS + 1)
    differ = n.REGISTERS - same
    sizes = np.full(len(same), 1000.0)
    dropped = same[n.similarity(differ - differ // 2, differ // 2, sizes, sizes) < n.least_estimate(similarity)]
    left_out = sum(math.comb(n.REGISTERS, k) * similarity**k * (1 - similarity) ** (n.REGISTERS - k) for k in dropped.tolist())
    unbanded = (1 - similarity**n.ROWS) ** n.BANDS
    assert left_out < unbanded and left_out + unbanded < stated


def test_texts_under_one_id_are_linked_each_by_itself(spark):
    """Document 5 has two texts, 9 is a near copy of the second, 3 of the first; 20 has 30 texts, each near another document."""
    rnd = random.Random(4)
    pair = lambda: list(t for _, t in family(rnd, 0, 2, 120, 2))
    one, two = pair(), pair()
    rows = [(5, one[0]), (5, two[0]), (9, two[1]), (3, one[1]), (5, two[0])]
    for i in range(30):
        a, b = pair()
        rows += [(20, a), (100 + i, b)] if i % 2 else [(20, a), (10 + i // 4, b)]
    rows += [(None, one[0]), (5, ""), (5, None)]
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string")
    assert sorted(collected(n.near_duplicates(docs, 5, 80)), key=repr) == sorted(brute(rows, 5, 80), key=repr)
