from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywatch.llm import fingerprints as f
from tallywatch.llm.common import ready
from tests.llm.helpers import collected, empty_docs, odd_docs


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"], blacklist_characters="\n"), max_size=40), min_size=1, max_size=8), st.randoms())
def test_order_of_paragraphs_does_not_matter_and_sums_add_up(paragraphs, rnd):
    shuffled = paragraphs[:]
    rnd.shuffle(shuffled)
    whole = f.Fingerprint.of_text("\n".join(paragraphs))
    assert whole == f.Fingerprint.of_text("\n".join(shuffled))
    first, rest = f.Fingerprint.of_text(paragraphs[0]), f.Fingerprint.of([p.encode() for p in paragraphs[1:]])
    assert whole == first + rest and whole - first == rest
    assert str(f.Fingerprint.parse(str(whole))) == str(whole)
    assert whole.likeness(whole) == 1.0


def test_other_texts_have_other_fingerprints():
    texts = ["", "a", "a\n", "\na\n", "a\na", "ab", "a b"]
    assert len({str(f.Fingerprint.of_text(t)) for t in texts}) == len(texts) - 0 and f.Fingerprint.of_text("a\n") == f.Fingerprint.of_text("\na")


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (f.Fingerprint.of_text(t) for t in (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b), round(a.likeness(b), 9), round(a.likeness(c), 9)))
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_query_equals_brute_force(spark, partitions):
    rnd = random.Random(5)
    more = [(i, "\n".join("".join(rnd.choices("abc ", k=rnd.randint(0, 60))) for _ in range(rnd.randint(1, 6)))) for i in range(100, 160, 2)]
    docs = odd_docs(ready(spark), more)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in collected(f.fingerprint(docs))]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    wanted = brute([(r.doc_id, r.text or "") for r in docs.collect()])
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_empty_and_single(spark):
    assert collected(f.fingerprint(empty_docs(ready(spark)))) == []
    (row,) = collected(f.fingerprint(odd_docs(spark).where("doc_id = 1")))
    assert row[6] == 1.0
