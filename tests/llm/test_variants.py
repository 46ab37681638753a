from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tallywatch.llm import variants as v
from tallywatch.llm.common import ready
from tests.llm.helpers import DOC_SCHEMA, collected, empty_docs, odd_docs


def brute_words(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs):
    words = brute_words(docs)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def table(spark, docs):
    return ready(spark).createDataFrame([(i, t, None, "s", 0, "r", 1, 2, "x") for i, t in docs], DOC_SCHEMA).repartition(3)


def texts(seed):
    """Words of few letters, so that many are near, in chains of growing frequency."""
    rnd = random.Random(seed)
    docs = [(i, w) for w, n in (("abcdefg", 7), ("abcdefgh", 45), ("abcdefghi", 280), ("zabcdefgh", 280)) for i in range(n)]
    for i in range(40):
        base = "".join(rnd.choice("abÀé") for _ in range(rnd.randrange(6, 9)))
        for n in (5, 26, 140):
            at, c = rnd.randrange(len(base) + 1), rnd.choice("abÀé")
            base = rnd.choice([base[:at] + c + base[at:], base[:at] + c + base[at + 1:], base[:at] + base[at + 1:] if len(base) > 6 else base])
            docs += [(rnd.randrange(10**6), " ".join([base if k % 2 else base.upper()] * 5)) for k in range(n // 5)]
    return docs


@pytest.mark.parametrize("seed, group", [(1, 20_000), (2, 3)])
def test_equals_brute_force(spark, seed, group):
    docs = texts(seed)
    want = brute(docs)
    assert sorted(collected(v.variants(table(spark, docs), group))) == want
    assert any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in want)


def test_acceptor_is_minimal_and_exact():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 9))) for _ in range(300)})
    start, states, stack = v.acceptor(words), {}, []
    stack = [(start, "")]
    read = []
    while stack:
        state, text = stack.pop()
        states[id(state)] = state
        read += [text] * state.final
        stack += [(s, text + c) for c, s in state.arcs.items()]
    assert sorted(read) == words
    rights = Counter(tuple(sorted(v._both(s, s))) for s in states.values())
    assert max(rights.values()) == 1


@pytest.mark.parametrize("seed", range(5))
def test_composition_gives_all_pairs(seed):
    rnd = random.Random(seed)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 7))) for _ in range(150)})
    want = {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}
    assert {frozenset(p) for p in v.composed(v.acceptor(words))} == want


def test_deleted_code_points(spark):
    """Whole words, short runs, and runs of which a code point goes, at any place."""
    docs = [(i, "Wörterbuch kurz wörterbuch Straßen÷zug abcdef\u0101ghijklm aBcDeFg") for i in range(1500)]
    assert sorted(collected(v.vocabulary(table(spark, docs)))) == sorted(brute_words(docs).items())


def test_odd_and_empty(spark):
    docs = odd_docs(ready(spark), [(40, "repeated word " * 6)] * 2)
    assert sorted(collected(v.variants(docs))) == brute([(d.doc_id, d.text) for d in docs.collect()])
    assert collected(v.variants(empty_docs(spark))) == []
