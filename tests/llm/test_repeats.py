from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tallywatch.llm import repeats as r
from tallywatch.llm.common import ready
from tests.llm.helpers import collected, empty_docs, odd_docs


def brute(rows):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for a in range(len(raw) - 49):
            w = raw[a: a + 50]
            first[w] = min(first.get(w, r._NO_ID), r._NO_ID if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for a in range(len(raw) - 49):
            if first[raw[a: a + 50]] < (r._NO_ID if i is None else i):
                gone[a: a + 50] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdeé", k=rnd.randint(1, 7))) for _ in range(300)]
    passages = [" ".join(rnd.choices(words, k=rnd.randint(8, 60))) for _ in range(6)]
    out = []
    for i in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(rnd.choices(words, k=rnd.randint(1, 40))) for _ in range(rnd.randint(1, 5))]
        if rnd.random() < 0.2:
            parts = [rnd.choice("xy") * rnd.randint(1, 400)] + parts
        out.append((100 + i, " ".join(parts)))
    return out + [(300, out[3][1]), (301, out[4][1][:200] + "#" + out[4][1][200:]), (302, "ab" * 300), (303, "ab" * 300 + "c" + "ab" * 200)]


@pytest.mark.parametrize("hot", [2, 4096])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(r, "HOT", hot)
    monkeypatch.setattr(r, "PART_BYTES", 4000)
    monkeypatch.setattr(r, "INDEX_SEGMENTS", 50)
    docs = odd_docs(ready(spark), corpus(hot)).where("doc_id IS NULL OR doc_id <> 5 AND doc_id <> 6")
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    assert sorted(collected(r.removals(docs)), key=repr) == sorted(brute(rows), key=repr)


def test_long_texts_and_texts_without_repeats(spark):
    docs = odd_docs(ready(spark))
    found = {x.doc_id: x.text for x in r.without_repeats(docs).collect() if x.doc_id is not None}
    assert found[6] == "" and found[5] == docs.where("doc_id = 5").first().text and found[2] == ""
    assert r.without_repeats(docs).columns == docs.columns and r.without_repeats(docs).count() == docs.count()


def test_index_equals_brute_force():
    for seed in range(25):
        rnd = random.Random(seed)
        base = bytes(rnd.choices(b"abcd ", k=400))
        sources = []
        for _ in range(rnd.randint(1, 30)):
            at = rnd.randint(0, 300)
            s = bytearray(base[at: at + rnd.randint(50, 84)])
            if rnd.random() < 0.5:
                s[rnd.randrange(len(s))] = ord("z")
            sources.append(bytes(s))
        docs = np.array([rnd.randint(0, 50) for _ in sources])
        index = r.RunLengthIndex(sources, docs)
        queries = [*sources[:5], *(base[a: a + 84] for a in (0, 20, 200, 300)), b"q" * 60, base[:40] + b"q" + base[41:84]]
        for query, row in zip(queries, index.stream(queries)):
            for i in range(len(query)):
                string = query[i: i + 50]
                assert row[i] == min([int(d) for s, d in zip(sources, docs) if len(string) == 50 and string in s], default=r._NO_ID)


def test_empty(spark):
    assert collected(r.removals(empty_docs(ready(spark)))) == []
    assert collected(r.without_repeats(empty_docs(spark))) == []


def test_texts_without_id_whose_short_hashes_collide(spark):
    """Texts without an id that Spark's 32-bit hash can't tell apart are cut each by itself."""
    from pyspark.sql import functions as F

    rnd = random.Random(9)
    shared = "".join(rnd.choices("abcdefgh ", k=90))
    numbered = ready(spark).range(200_000).select(F.concat(F.lit(shared), F.sha2(F.col("id").cast("string"), 256), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int"))).alias("text"))
    pairs = numbered.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").collect()
    assert pairs
    texts = [t for p in pairs for t in p.texts]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(5, shared)], "doc_id long, text string")
    found = {(x.n_bytes, x.n_removed, x.kept_sha256) for x in r.removals(docs).collect() if x.doc_id is None}
    want = {(len(t), 90, hashlib.sha256(t[90:].encode()).hexdigest()) for t in texts}
    assert found == want
