from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallywatch.llm import packing as p
from tallywatch.llm.common import ready
from tests.llm.helpers import collected, empty_docs, odd_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def used(plan, capacity):
    counts = {}
    for filling, often in plan:
        assert sum(s * n for s, n in filling) <= capacity
        for s, n in filling:
            counts[s] = counts.get(s, 0) + n * often
    return counts


def optimum(sizes, capacity):
    """Fewest bins by exhaustive search."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_small_plans_are_best():
    for seed in range(60):
        rnd = random.Random(seed)
        sizes = sorted((rnd.randint(1, 29) for _ in range(rnd.randint(1, 9))), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        plan = p.bin_completion(dict(counts), 30)
        assert used(plan, 30) == counts
        assert sum(n for _, n in plan) == optimum(sizes, 30)


def test_large_plans_are_whole_and_no_worse_than_best_fit():
    for seed, n in itertools.product(range(3), (100, 20_000)):
        rnd = random.Random(seed)
        counts = {}
        for _ in range(n):
            s = rnd.choice([rnd.randint(1, 1023), rnd.randint(300, 700)])
            counts[s] = counts.get(s, 0) + 1
        fit, plan = p.best_fit(counts), p.bin_completion(dict(counts))
        assert used(fit, 1024) == counts == used(plan, 1024)
        assert sum(n for _, n in plan) <= sum(n for _, n in fit)


def test_ids_equal_the_library():
    library, encode = Tokenizer.from_file(PATH), p.encoder(PATH)
    rnd = random.Random(1)
    texts = ["", "a<|endoftext|>b", "  x\n\n y\t", "日本語 😀", *("".join(rnd.choices("ab é\n1.'s", k=40)) for _ in range(200))]
    assert [encode(t).tolist() for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_packs_every_token_once(spark):
    docs = odd_docs(ready(spark), [(100 + i, "some words " * (i * 7 % 900)) for i in range(150)])
    rows = [r.asDict() for r in p.pack(docs).collect()]
    library = Tokenizer.from_file(PATH)
    wanted = []
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        for i, (start, length) in enumerate(p.cuts(len(ids))):
            wanted.append((r.doc_id, i, start, length, zlib.crc32(np.array(ids[start: start + length], "<u4").tobytes())))
    assert sorted((tuple(r[c] for c in p.COLUMNS[:5]) for r in rows), key=repr) == sorted(wanted, key=repr)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        ends = 0
        for offset, length in sorted(held):
            assert offset == ends
            ends += length
        assert ends <= 1024


def test_cuts():
    assert p.cuts(1) == [(0, 1)] and p.cuts(1024) == [(0, 1024)] and p.cuts(2050) == [(0, 2), (2, 1024), (1026, 1024)]


def test_empty(spark):
    assert collected(p.pack(empty_docs(ready(spark)))) == []
