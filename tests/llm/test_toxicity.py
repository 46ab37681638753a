from __future__ import annotations

import random
import zlib

import numpy as np

from tallywatch.llm import toxicity as t
from tallywatch.llm.common import ready
from tests.llm.helpers import collected, empty_docs, odd_docs

BAD = ("wretchful", "scumbrel", "vilenous")


def corpus(n, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefghilmnorstu", k=rnd.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        toxic = rnd.random() < 0.3
        text = rnd.choices(words, k=rnd.randint(5, 200)) + (rnd.choices(BAD, k=rnd.randint(1, 3)) if toxic else [])
        rnd.shuffle(text)
        out.append((i, " ".join(text), int(toxic)))
    return out


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(900)
    docs = odd_docs(ready(spark), [(1000 + i, text) for i, text, _ in rows])
    labels = spark.createDataFrame(
        [(1000 + i, 1, y, "z") for i, _, y in rows] + [(None, 1, 1, "z"), (1000, 1, None, "z"), (999999, 0, 1, "z")], "doc_id long, quality int, toxic int, text string")
    found = collected(t.toxicity(docs, labels))
    assert len(found) == docs.count()
    truth = {1000 + i: y for i, _, y in rows}
    mine = [(p, truth[i]) for i, h, _, p in found if h and i in truth]
    assert all(h == held(i) for i, h, _, _ in found if i is not None)
    assert sum(p == y for p, y in mine) >= 0.97 * len(mine)
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, _, s, p in found)
    # The held-out labels teach nothing.
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) AS toxic", "text")
    assert sorted(collected(t.toxicity(docs, flipped)), key=repr) == sorted(found, key=repr)


def test_misspelt_words_share_vectors():
    rows = corpus(900)
    model = t.SubwordSoftmax.fit([sorted(t.words_of(x)) for _, x, _ in rows], np.array([y for _, _, y in rows]), 0.3)
    clean = "the plain words of this text are harmless"
    assert model.score(f"{clean} wretchfull") > model.score(f"{clean} grumbled")
    assert model.score(f"{clean} scumbrel") >= 0.5 > model.score(clean)


def test_without_labels_and_empty(spark):
    docs, none = odd_docs(ready(spark)), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(s < 0.01, p) for _, _, s, p in collected(t.toxicity(docs, none))} == {(True, 0)}
    assert collected(t.toxicity(empty_docs(spark), none)) == []
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert t.toxicity(docs, one).count() == docs.count()


def test_letters_behind_the_fortieth_count():
    rows = corpus(900)
    model = t.SubwordSoftmax.fit([sorted(t.words_of(x)) for _, x, _ in rows], np.array([y for _, _, y in rows]), 0.3)
    for n in (30, 40, 41, 55, 200):
        assert model.score("a" * n + "scumbrel") > model.score("a" * n + "grumbles"), n
        assert model.score("a" * n + "scumbrel" + "a" * n) > model.score("a" * (2 * n + 8)), n


def test_pieces_cover_long_runs():
    rnd = random.Random(3)
    for n in (39, 40, 41, 60, 61, 79, 80, 81, 500):
        run = "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(n))
        pieces = t.words_of(f"1 {run}.")
        assert all(len(p) <= t.LETTERS for p in pieces)
        assert all(any(run[i: i + t.OVERLAP] in p for p in pieces) for i in range(n - t.OVERLAP + 1))
        assert n > t.LETTERS or pieces == {run}


def test_buckets_are_the_same_in_any_company():
    words = ["a", "", "scumbrel", "ža", "日本語", "x" * 40, "ab"]
    together = t.buckets_of(words)
    for i, w in enumerate(words):
        place, bucket = t.buckets_of([w])
        assert sorted(together[1][together[0] == i]) == sorted(bucket) and set(place) == {0}
        marked = f"<{w}>"
        assert len(bucket) == 1 + sum(len(marked) - n + 1 for n in t.SIZES if n < len(marked))
    shared = [set(t.buckets_of([w])[1]) for w in ("wretchful", "wretchfull")]
    assert len(shared[0] & shared[1]) > 0.6 * len(shared[0])


def test_scores_are_the_same_in_any_batch(monkeypatch):
    model = t.SubwordSoftmax(np.random.default_rng(1).normal(size=(t.BUCKETS, 2)).astype(np.float32), -0.3)
    texts = [x for _, x, _ in corpus(60)] + ["", "12 34", "x" * 90]
    want = model.scores(texts).tolist()
    monkeypatch.setattr(t, "KEPT", 50)
    monkeypatch.setattr(t, "AT_ONCE", 7)
    monkeypatch.setattr(t, "CHARACTERS", 900)
    again = t.SubwordSoftmax(model.margins, model.bias)
    assert [again.score(x) for x in reversed(texts)][::-1] == want
    assert t.SubwordSoftmax(model.margins, model.bias).scores(texts).tolist() == want
    assert again.scores([]).tolist() == []


def test_repeated_and_long_labelled_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(t, "WORDS", 30)
    rows = corpus(400)
    docs = ready(spark).createDataFrame([(i, x) for i, x, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    once = t.fit(docs, labels)
    repeated = docs.union(docs.where("doc_id = 1").crossJoin(spark.range(10_000)).select("doc_id", "text"))
    again = t.fit(repeated, labels)
    assert (again.margins == once.margins).all() and again.bias == once.bias
