"""Toxicity: bags of subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word (a run of letters, lower-cased; long runs are cut into overlapping words) is the mean of the vectors of its character n-grams and of itself, all
hashed to buckets, so that unseen misspellings share most of a known word's vectors. A text is the weighted mean of
its distinct words; a linear softmax over it gives the probability of label 1. A word's weight is the exponential of
a linear function of its vector, else a few telling words drown in a long text. Embeddings, weights and softmax are
fitted together by gradient descent on a bounded sample of labelled rows, part of which chooses epoch and threshold.
The fitted model is two numbers for each bucket, since margin and weight are linear in the embeddings: that table
has a fixed size and goes to every worker. A worker hashes the new words of a whole batch at once, and adds up a text's
words as whole numbers (2^-20), so that their order doesn't matter.

The sample is bounded in rows (``SAMPLE``) and in words of a row (``WORDS``). Words are counted and numbered by the executors; the
driver gets the words that teach something, and numbers.

Null and empty texts, and texts without letters, get the score of an empty bag. Labels that are null, or whose row
has no document, teach nothing; of several labels of one id the largest counts, of several texts the smallest. Without labelled rows of both
kinds every score is the share of label 1 (0 without any). Repeated rows get repeated results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import mixed, saved

WORD = re.compile(r"[^\W\d_]+")
#: Labelled rows of each label that the model is fitted on, at most: the smallest by a hash of doc_id.
SAMPLE = 3000
#: Distinct words of a sampled text that the model is fitted on, at most: the smallest by crc32. Scores read whole texts.
WORDS = 4000
#: Longest word; buckets, embedding width, n-gram sizes.
LETTERS, BUCKETS, WIDTH, SIZES = 40, 1 << 18, 8, (3, 4, 5, 6, 7)
#: Letters that the pieces of a longer run share: more than an n-gram less one, so each n-gram stands whole in a piece.
OVERLAP = LETTERS // 2
EPOCHS, STEP, DECAY = 80, 0.5, 1e-4
#: Sampled texts that a word must stand in to teach something, and the largest logarithm of a word's weight in the mean.
LEAST, LOUD = 5, 8.0
#: Words whose margin a worker keeps, words hashed at once, characters of texts scored at once, and the unit in which words are added up.
KEPT, AT_ONCE, CHARACTERS, UNIT = 200_000, 20_000, 1 << 20, 1 << 20


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The place of a word in the list, and a bucket, for each of its n-grams and for itself."""
    points = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    of_point = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(points))  # points from here to the word's end
    factor = np.uint64(0x9E3779B97F4A7C15)
    places, hashes = [], []
    gram = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):  # gram: the hash of the n points from here, wrapping around behind the last
        gram = gram * factor + np.roll(points, 1 - n) + np.uint64(1)
        if n in SIZES:
            at = np.nonzero((left >= n) & (sizes[of_point] > n))[0]
            places.append(of_point[at])
            hashes.append(gram[at])
    powers = np.cumprod(np.full(int(sizes.max(initial=0)), factor, np.uint64))
    place = np.arange(len(points)) - np.repeat(starts, sizes)
    if len(words):
        places.append(np.arange(len(words)))
        hashes.append(np.add.reduceat((points + np.uint64(1)) * powers[place], starts) + np.uint64(1))
    return np.concatenate(places), (mixed(np.concatenate(hashes)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def words_of(text: str) -> set[str]:
    """Runs of letters; longer ones than LETTERS, as in scripts without spaces, in overlapping pieces that cover all of them."""
    found = set(WORD.findall(text.lower()))
    long = [w for w in found if len(w) > LETTERS]
    if long:
        found.difference_update(long)
        step = LETTERS - OVERLAP
        found.update(w[i: i + LETTERS] for w in long for i in range(0, len(w) - OVERLAP, step))
    return found


class SubwordSoftmax:
    """margins: of each bucket, its share of a word's log-odds of label 1 and of the logarithm of the word's weight."""

    def __init__(self, margins: np.ndarray, bias: float):
        self.margins, self.bias = margins, bias
        self._forget()

    def __reduce__(self):
        return SubwordSoftmax, (self.margins, self.bias)

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._sums = np.zeros((0, 2), np.int64)

    def _learn(self, words: list[str]) -> None:
        """Weighted log-odds and weight of new words, in units."""
        for at in range(0, len(words), AT_ONCE):
            some = words[at: at + AT_ONCE]
            of_word, bucket = buckets_of(some)
            count = np.bincount(of_word, minlength=len(some))
            margin, loud = (np.bincount(of_word, self.margins[bucket, k], minlength=len(some)) / count for k in (0, 1))
            weight = np.exp(np.clip(loud, -LOUD, LOUD))
            self._known.update(zip(some, range(len(self._known), len(self._known) + len(some))))
            self._sums = np.concatenate([self._sums, np.rint(np.stack([margin * weight, weight], axis=1) * UNIT).astype(np.int64)])

    def scores(self, texts: list[str]) -> np.ndarray:
        """Scores of the texts, some of them at a time."""
        sizes = np.cumsum([len(t) for t in texts])
        found, done = [np.zeros(0)], 0
        while done < len(texts):
            end = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + CHARACTERS, "right")))
            found.append(self._scores(texts[done:end]))
            done = end
        return np.concatenate(found)

    def _scores(self, texts: list[str]) -> np.ndarray:
        bags = [words_of(t) for t in texts]
        words = list(chain.from_iterable(bags))
        new = [w for w in dict.fromkeys(words) if w not in self._known]
        if len(self._known) + len(new) > KEPT:
            self._forget()
            new = list(dict.fromkeys(words))
        self._learn(new)
        index = np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))
        ends = np.cumsum([len(b) for b in bags], dtype=np.int64)
        total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(self._sums[index], axis=0)])
        odds, weights = (total[ends] - total[ends - [len(b) for b in bags]]).T
        margin = self.bias + odds / np.maximum(weights, 1)
        return 1 / (1 + np.exp(-np.clip(margin, -500.0, 500.0)))

    def score(self, text: str) -> float:
        return float(self.scores([text])[0])

    @classmethod
    def fit(cls, bags: list[list[str]], labels: np.ndarray, share: float) -> SubwordSoftmax:
        """From lists of distinct words; share: of label 1 among all labelled rows."""
        frequency = Counter(w for bag in bags for w in bag)
        vocabulary = sorted(w for w, n in frequency.items() if n >= LEAST)
        number = {w: i for i, w in enumerate(vocabulary)}
        known = [np.array([number[w] for w in bag if w in number], np.int32) for bag in bags]
        return cls.fit_numbered(vocabulary, known, np.array([len(b) for b in bags]), labels, share)

    @classmethod
    def fit_numbered(cls, vocabulary: list[str], known: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, share: float) -> SubwordSoftmax:
        """known: of each text, the places of its words in the vocabulary; sizes: how many distinct words it has. The
        sample's labels are weighted to the share."""
        if not len(labels) or labels.min() == labels.max():
            return cls(np.zeros((BUCKETS, 2), np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
        if not len(vocabulary):
            return cls(np.zeros((BUCKETS, 2), np.float32), float(np.log(share / (1 - share))))
        bags, grams = range(len(known)), range(len(vocabulary))
        flat = np.concatenate(known)
        known_sizes = np.array([len(b) for b in known])
        parts = [buckets_of(vocabulary[at: at + AT_ONCE]) for at in range(0, len(vocabulary), AT_ONCE)]
        of_word = np.concatenate([words + i * AT_ONCE for i, (words, _) in enumerate(parts)])
        gram_sizes = np.bincount(of_word, minlength=len(vocabulary))
        used, gram = np.unique(np.concatenate([buckets for _, buckets in parts]), return_inverse=True)
        of_bag = np.repeat(np.arange(len(bags)), known_sizes)
        per_gram = (1 / gram_sizes)[of_word]

        def pooled(index: np.ndarray, into: np.ndarray, weight: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
            return np.stack([np.bincount(into, weight * values[index, d], minlength=n) for d in range(values.shape[1])], axis=1)

        draw = np.random.default_rng(11)
        embedding = draw.uniform(-1 / WIDTH, 1 / WIDTH, (len(used), WIDTH))
        softmax, bias, attention = draw.uniform(-1, 1, (WIDTH, 2)) / WIDTH, np.zeros(2), np.zeros(WIDTH)
        balance = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
        target = np.stack([labels == 0, labels == 1], axis=1).astype(float)
        parameters = [embedding, softmax, bias, attention]
        speeds = [np.zeros_like(x) for x in parameters]
        check = np.arange(len(bags)) % 5 == 4  # these rows only choose the epoch and the threshold
        weight = np.where(check, 0, balance)
        others = np.maximum(sizes - known_sizes, 0) + (sizes == 0)  # words that teach nothing weigh 1
        best, kept = np.inf, None
        for epoch in range(EPOCHS):
            words = pooled(gram, of_word, per_gram, embedding, len(grams))
            loud = words @ attention
            heavy = np.exp(np.clip(loud, -LOUD, LOUD))[flat]
            per_word = heavy / (np.bincount(of_bag, heavy, minlength=len(bags)) + others)[of_bag]
            texts = pooled(flat, of_bag, per_word, words, len(bags))
            z = texts @ softmax + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            loss = -(np.log(np.maximum(p[check], 1e-12)) * target[check] * balance[check, None]).sum()
            if loss < best:
                best, kept = loss, [*(x.copy() for x in parameters), z[:, 1] - z[:, 0]]
            off = (p - target) * weight[:, None]
            pull = off @ softmax.T
            raised = -(texts * pull).sum(axis=1)[of_bag]
            for d in range(WIDTH):  # a width at a time: the sample's words times the width would fill the driver
                raised += words[flat, d] * pull[of_bag, d]
            raised *= per_word * (np.abs(loud) < LOUD)[flat]
            raised = np.bincount(flat, raised, minlength=len(grams))
            down = pooled(of_bag, flat, per_word, pull, len(grams)) + raised[:, None] * attention
            slopes = [pooled(of_word, gram, per_gram, down, len(used)), texts.T @ off, off.sum(axis=0), words.T @ raised]
            for x, g, v in zip(parameters, slopes, speeds):
                v *= 0.8
                v += 0.2 * g / (np.abs(g).max() + 1e-12)  # the whole slope is scaled, so that rare words move little
                x -= STEP * (1 - epoch / EPOCHS) * v + DECAY * x
        embedding, softmax, bias, attention, z = kept
        out = np.zeros((BUCKETS, 2), np.float32)
        out[used, 0], out[used, 1] = embedding @ (softmax[:, 1] - softmax[:, 0]), embedding @ attention
        return cls(out, float(bias[1] - bias[0]) - _threshold(z[check], labels[check], share))


def _threshold(margins: np.ndarray, labels: np.ndarray, share: float) -> float:
    """The margin at which the harmonic mean of precision and recall is best, midway to the next lower one."""
    order = np.argsort(-margins, kind="stable")
    hits = np.cumsum(labels[order] == 1) / max(1, (labels == 1).sum()) * share
    errors = np.cumsum(labels[order] == 0) / max(1, (labels == 0).sum()) * (1 - share)
    quality = 2 * hits / (hits + errors + share)
    if not len(order):
        return 0.0
    i = int(quality.argmax())
    return float((margins[order][i] + margins[order][min(i + 1, len(order) - 1)]) / 2)


def _bags(docs: DataFrame) -> DataFrame:
    """doc_id, toxic, size (distinct words) and the words of each text, at most WORDS."""
    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [sorted(words_of(t)) for t in batch.column("text").to_pylist()]
            sizes = pa.array([len(b) for b in bags], pa.int32())
            bags = [b if len(b) <= WORDS else sorted(b, key=lambda w: (zlib.crc32(w.encode()), w))[:WORDS] for b in bags]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), sizes, pa.array(bags, pa.list_(pa.string()))], ["doc_id", "toxic", "size", "words"])

    return docs.mapInArrow(bag, "doc_id long, toxic int, size int, words array<string>")


def _numbered(bags: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The bags with the places of their words in the vocabulary instead of words."""
    sent = bags.sparkSession.sparkContext.broadcast(vocabulary)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {w: i for i, w in enumerate(sent.value)}
        for batch in batches:
            known = [[places[w] for w in bag if w in places] for bag in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "toxic", "size")), pa.array(known, pa.list_(pa.int32()))], ["doc_id", "toxic", "size", "known"])

    return bags.mapInArrow(number, "doc_id long, toxic int, size int, known array<int>")


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> SubwordSoftmax:
    """Fit on the labelled rows whose crc32(doc_id as text) mod 5 isn't 0."""
    labels = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    )
    counts = {row["toxic"]: row["count"] for row in labels.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = [labels.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # At most twice the sample's rows: a bounded table.
    texts = texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    # Repeated ids are brought together before any exchange.
    bags = saved(_bags(texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))))
    words = bags.select(F.explode("words").alias("word")).groupBy("word").count().where(f"count >= {LEAST}").select("word")
    vocabulary = sorted(words.toArrow()["word"].to_pylist())
    found = _numbered(bags, vocabulary).orderBy("doc_id").toArrow()
    known = [x.values.to_numpy() for x in found["known"]]
    return SubwordSoftmax.fit_numbered(vocabulary, known, found["size"].to_numpy(), found["toxic"].to_numpy(), share)


def score(docs: DataFrame, model: SubwordSoftmax) -> DataFrame:
    """All columns of docs, score and predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = F.coalesce("text", F.lit(""))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(texts.tolist()), dtype=float)

    return docs.withColumn("score", scored(text)).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
