from __future__ import annotations

import hashlib
import math
import random
import re
import time

import numpy as np

from tallywatch.llm import personal as p
from tallywatch.llm.common import ready
from tests.llm.helpers import collected, empty_docs, odd_docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


PASSES = {
    "email": lambda h: True,
    "ip": lambda h: all(int(x) <= 255 for x in h.split(".")),
    "card": lambda h: 16 <= len(re.sub("[ -]", "", h)) <= 19 and luhn(re.sub("[ -]", "", h)),
    "phone": lambda h: 8 <= len(re.sub("[^0-9]", "", h)) <= 15,
}


def brute(text):
    return [(k, m.start(), m.end()) for k, pattern in PATTERNS.items() for m in re.finditer(pattern, text) if PASSES[k](m[0])]


def card(rnd, good=True):
    digits = "".join(rnd.choices("0123456789", k=15))
    last = next(d for d in "0123456789" if luhn(digits + d) == good)
    return rnd.choice(["", " ", "-"]).join(re.findall(".{1,4}", digits + last))


def corpus(seed):
    rnd = random.Random(seed)
    number = lambda: str(rnd.randint(0, 300))
    makers = [
        lambda: f"{rnd.choice('abc')}.{number()}@mail{number()}.example.com", lambda: ".".join(number() for _ in range(rnd.randint(3, 6))),
        lambda: card(rnd), lambda: card(rnd, False), lambda: f"+1 ({number()}) 555-{rnd.randint(0, 99999)}", lambda: "é😀 " + number(),
        lambda: "".join(rnd.choices("0123456789 -.@+()ab", k=rnd.randint(1, 40))), lambda: "x@y.zz_a@b.cc", lambda: "00012.0001.000.0255", lambda: "plain words",
    ]
    return [(100 + i, rnd.choice([" ", "\n", "", "é"]).join(rnd.choice(makers)() for _ in range(rnd.randint(0, 9)))) for i in range(300)]


def test_base_spans_equal_brute_force(spark):
    more = [*corpus(1), (900, "1" * 100_000), (901, "1 " * 20_000 + "1"), (902, "a" * 100_000 + "@"), (903, "a." * 20_000 + "@b" + ".c" * 20_000)]
    docs = odd_docs(ready(spark), more)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    wanted = []
    for i, text in texts:
        found = brute(text)
        wanted.append((i, *(sum(k == x for x, _, _ in found) for k in PATTERNS), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()))
    rows = collected(p.spans(docs))
    assert sorted((r[:6] for r in rows), key=repr) == sorted(wanted, key=repr)
    spans = {r[5]: set(r[6].split(",")) for r in rows}
    for _, text in texts:
        base = [f"{k}:{a}:{b}" for k, a, b in brute(text)]
        assert spans[hashlib.sha256(",".join(base).encode()).hexdigest()] >= set(base)


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 20, (3000, 3))
    y = ((x[:, 0] > 9) & (x[:, 2] < 7)).astype(float)
    check = np.arange(3000) % 5 == 0
    model = p.Trees.fit(x, y, np.ones(3000), ["a", "b", "c"], check)

    def margin(row, node):
        while isinstance(node, tuple):
            node = node[2] if row["abc".index(node[0])] < node[1] else node[3]
        return node

    margins = np.array([model.bias + sum(margin(r, t) for t in model.trees) for r in x])
    chosen = margins >= model.threshold - 1e-9
    assert y[check & chosen].mean() >= p.PRECISION and chosen[y == 1].mean() > 0.95
    assert np.isinf(p.Trees.fit(x, np.zeros(3000), np.ones(3000), ["a", "b", "c"], check).threshold)


def test_proposals_are_added_above_the_threshold(spark):
    docs = ready(spark).createDataFrame([(1, "write to jo [at] example [dot] org or call 0049 30 1234567 today")], "doc_id long, text string")
    all_in = p.Trees([], 1.0, 0.0)
    (row,) = p.find(docs, all_in).collect()
    text = docs.first().text
    assert [text[s.start: s.end] for s in row.all_email] == ["jo [at] example [dot] org"] and row.base_email == []
    assert [text[s.start: s.end] for s in row.all_phone] == ["0049 30 1234567"]


def test_redaction(spark):
    docs = odd_docs(ready(spark), [(50, "é mail a@b.cc now +1 (504) 555-2652, 1.2.3.4!"), (51, "a@1.2.3.4 end")])
    found = {r.doc_id: r.text for r in p.redact(docs).collect()}
    assert found[50] == "é mail [EMAIL] now [PHONE], [IP]!" and found[51] == "[EMAIL] end" and found[2] == ""
    assert p.redact(docs).columns == docs.columns and p.redact(docs).count() == docs.count()
    assert collected(p.redact(empty_docs(spark))) == [] and collected(p.spans(empty_docs(spark))) == []


def replaced(text, spans):
    """The text with spans (start, end, kind) replaced, overlapping ones by the first's kind."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out.append(text[at:start] + f"[{kind.upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_very_many_matches_in_long_texts(spark):
    """Texts of up to 700 KB full of matches, next to each other and far apart, take seconds and come out right."""
    rnd = random.Random(6)
    dense = "\n".join(f"user{rnd.randrange(10**6)}@mail{rnd.randrange(99)}.example.com" for _ in range(20_000))
    mixed = " é ".join(rnd.choice([f"10.0.{rnd.randrange(256)}.{rnd.randrange(300)}", card(rnd), card(rnd, False), f"+1 (504) 555-{rnd.randrange(9999):04d}", "a@b.cc",
                                   "word " * rnd.randrange(900)]) for _ in range(300))
    glued = "x@y.zz_" * 3000
    texts = {1: dense, 2: mixed, 3: glued, 4: "a@1.2.3.4" * 500, 5: "é" * 9000 + " a@b.cc " + "é" * 9000}
    docs = ready(spark).createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    start = time.monotonic()
    found = {r.doc_id: r for r in p.find(docs, p.Trees([], 0.0, math.inf)).collect()}
    for i, text in texts.items():
        want = brute(text)
        for k in PATTERNS:
            assert [(s.start, s.end) for s in found[i][f"base_{k}"]] == [(a, b) for x, a, b in want if x == k], (i, k)
    every = {r.doc_id: [(s.start, s.end, k) for k in PATTERNS for s in r[f"all_{k}"]] for r in p.find(docs).collect()}
    assert sum(map(len, every.values())) > 20_000
    redacted = {r.doc_id: r.text for r in p.redact(docs).collect()}
    assert all(redacted[i] == replaced(t, every[i]) for i, t in texts.items())
    assert time.monotonic() - start < 120


def test_added_spans_of_planted_spellings(spark):
    """Odd spellings of addresses and numbers among texts of base ones: how many the trees add, and how many of those are planted."""
    rnd = random.Random(8)
    docs, planted = [], {}
    for i in range(400):
        base = rnd.choice([f"mail to a{i}@mail.example.com", f"call +1 (504) 555-{i:04d} today", f"host 10.0.{i % 256}.7", f"pay by card {card(rnd)}", f"version 1.{i}.{i}.400", "1234-" * 4 + str(i)])
        odd = rnd.choice([f"jo{i} [at] example [dot] org", f"10[.]0[.]{i % 256}[.]9", f"phone 0049 30 12{i:05d}", None, None])
        head = f"contact {base} or " if odd else f"plain {base} end"
        docs.append((i, head + (odd or "")))
        if odd:
            at = len(head) + (6 if odd.startswith("phone") else 0)
            planted[i] = (at, len(head) + len(odd))
    found = p.find(ready(spark).createDataFrame(docs, "doc_id long, text string")).collect()
    added = {(r.doc_id, s.start, s.end) for r in found for k in PATTERNS for s in r[f"all_{k}"] if s not in r[f"base_{k}"]}
    hits = {(i, *span) for i, span in planted.items()}
    right, recall = sum(any(d == i and a < e and s < b for i, s, e in hits) for d, a, b in added), sum(
        any(d == i and a < e and s < b for d, a, b in added) for i, s, e in hits) / len(hits)
    print("added", len(added), "precision", right / max(1, len(added)), "recall", recall)
    assert not added or right / len(added) >= 0.9


def _scored(model, rows, names):
    """Margins of rows of features."""
    def margin(row, node):
        while isinstance(node, tuple):
            node = node[2] if row[names.index(node[0])] < node[1] else node[3]
        return node

    return np.array([model.bias + sum(margin(r, t) for t in model.trees) for r in rows])


def _many(spark, n):
    """Short texts with an address or number each; of the addresses more and more fail with the id."""
    rnd = random.Random(9)
    makers = [lambda i: f"host 10.0.{rnd.randrange(256)}.{rnd.randrange(200, 270 + 200 * i // n)}", lambda i: f"mail a{i}@mail.example.com",
              lambda i: f"pay by card {card(rnd, rnd.random() < 0.5)}", lambda i: f"call +1 (504) 555-{i:04d} {rnd.choice(['', '1234'])}"]
    rows = [(None if i % 97 == 0 else i, rnd.choice(makers)(i)) for i in range(n)]
    return ready(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_trees_learn_from_every_document(spark, monkeypatch):
    """Each proposal on a base match of 24,000 documents counts; sums on the executors fit the same trees."""
    docs, names, seen = _many(spark, 24_000), list(p.FEATURES), []
    fit = p.Trees.fit
    monkeypatch.setattr(p.Trees, "fit", lambda x, y, weight, *rest: seen.append((x, weight)) or fit(x, y, weight, *rest))
    model = p.fit(docs)
    ((x, weight),) = seen
    for kind in ("email", "ip"):
        tried = sum(len(re.findall(PATTERNS[kind], r.text)) for r in docs.where(f"text rlike '{'@' if kind == 'email' else '^host'}'").collect())
        assert weight[x[:, names.index("kind")] == p.KINDS.index(kind)].sum() == tried > 5000
    apart = p.fit(docs, collected=0)
    assert len(seen) == 1 and math.isfinite(model.threshold) and abs(model.threshold - apart.threshold) < 1e-6
    assert np.allclose(_scored(model, x, names), _scored(apart, x, names), atol=1e-6)


def test_trees_on_executors_without_both_labels(spark):
    docs = ready(spark).createDataFrame([(1, "mail a@b.cc"), (2, None)], "doc_id long, text string")
    assert all(math.isinf(p.fit(d, collected=-1).threshold) for d in (docs, empty_docs(spark), docs.where("doc_id = 2")))
