"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is what stands between line feeds, white space and all; an empty text is one empty paragraph.
Each paragraph hashes to a wide vector of two parts: lanes drawn from SHAKE-128 of its bytes, summed
modulo 2^32, which decide equality, and a signed count of its 12-byte windows over lanes modulo 2^16, whose
angle estimates how much two documents share. Vectors add up, so the order of paragraphs doesn't matter and
paragraphs are put in or taken out by adding or subtracting theirs.

Null texts count as empty. Rows follow one another by doc_id, rows without one first, rows of one id by text;
the one after the last is the first (itself in a table of one row). An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANES, LIKENESS, WINDOW = 64, 256, 12
_NO_ID = -(1 << 63)


class Fingerprint:
    """Sums of paragraph vectors; supports + and - with other fingerprints."""

    __slots__ = ("exact", "like")

    def __init__(self, exact: np.ndarray, like: np.ndarray):
        self.exact, self.like = exact, like

    @classmethod
    def of(cls, paragraphs: Iterable[bytes]) -> Fingerprint:
        paragraphs = list(paragraphs)
        if not paragraphs:
            return cls(np.zeros(LANES, np.uint32), np.zeros(LIKENESS, np.uint16))
        drawn = np.frombuffer(b"".join(hashlib.shake_128(p).digest(4 * LANES) for p in paragraphs), "<u4").reshape(-1, LANES)
        return cls(drawn.sum(axis=0, dtype=np.uint32), _windows(paragraphs, drawn))

    @classmethod
    def of_text(cls, text: str) -> Fingerprint:
        return cls.of(text.encode().split(b"\n"))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.like + other.like)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.like - other.like)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool((self.exact == other.exact).all() and (self.like == other.like).all())

    __hash__ = None

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the cosine of the window counts, 0 at least."""
        if self == other:
            return 1.0
        a, b = self.like.view(np.int16).astype(float), other.like.view(np.int16).astype(float)
        size = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0

    def __str__(self) -> str:
        return base64.b64encode(self.exact.astype("<u4").tobytes() + self.like.astype("<u2").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        return cls(np.frombuffer(raw[: 4 * LANES], "<u4").astype(np.uint32), np.frombuffer(raw[4 * LANES:], "<u2").astype(np.uint16))


def _windows(paragraphs: list[bytes], drawn: np.ndarray) -> np.ndarray:
    """Signed counts of the windows inside paragraphs; a shorter paragraph counts as one window."""
    short = np.array([len(p) < WINDOW for p in paragraphs])
    hashes = drawn[short, 0].astype(np.uint64) << np.uint64(32) | drawn[short, 1]
    raw = b"\n".join(p for p in paragraphs if len(p) >= WINDOW)
    if raw:
        n = len(raw) - WINDOW + 1
        first = np.ndarray((n,), "<u8", raw, 0, (1,)).astype(np.uint64)
        rest = np.ndarray((n,), "<u4", raw, 8, (1,)).astype(np.uint64)
        h = first * np.uint64(0x9E3779B97F4A7C15) ^ (rest + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        breaks = np.cumsum(np.concatenate([[0], np.frombuffer(raw, np.uint8) == 10]), dtype=np.int64)
        hashes = np.concatenate([hashes, h[breaks[WINDOW:] == breaks[:-WINDOW]]])
    counts = np.bincount((hashes >> np.uint64(55)).astype(np.int64), minlength=2 * LIKENESS)
    return (counts[0::2] - counts[1::2]).astype(np.uint16)


def spliced(text: str, other: str) -> str:
    """The last floor(n / 2) characters replaced by the first as many of the other text."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


class _Row:
    """A row, and its fingerprint as the sum of the paragraphs before the cut and those the cut touches."""

    __slots__ = ("cut", "doc_id", "tail", "text", "whole")

    def __init__(self, doc_id: int, text: str):
        self.doc_id, self.text = doc_id, text
        self.cut = text.rfind("\n", 0, len(text) - len(text) // 2) + 1
        self.tail = Fingerprint.of_text(text[self.cut:])
        self.whole = Fingerprint.of_text(text[: self.cut - 1]) + self.tail if self.cut else self.tail

    def result(self, after: _Row) -> tuple:
        """The edited text's fingerprint by taking out the paragraphs that the edit touches and putting in the new ones."""
        edited = spliced(self.text, after.text)
        new = self.whole - self.tail + Fingerprint.of_text(edited[self.cut:])
        return (
            None if self.doc_id == _NO_ID else self.doc_id, len(self.text), hashlib.sha256(edited.encode()).hexdigest(),
            str(self.whole), str(new), self.whole.likeness(new), self.whole.likeness(after.whole),
        )


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, copied, key, text): each meets the next; the first copied row is the next of a bucket's last."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    kinds = [kinds[x.split()[1]] for x in SCHEMA.split(", ")]
    bucket, before = None, None
    for batch in batches:
        out = []
        for own, copied, key, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "copied", "key", "text"))):
            if own != bucket:
                bucket, before = own, None
            if copied and before is None:
                continue
            row = _Row(key, text)
            if before is not None:
                out.append(before.result(row))
            before = None if copied else row
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text edited with the next one's beginning.

    Rows go to buckets of consecutive ids, cut at quantiles; the first rows of a bucket also go to the bucket before.
    """
    from pyspark.ml.feature import Bucketizer  # slow to import, and not needed by the workers

    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = F.col("key").cast("double").alias("place")
    steps = [i / n for i in range(1, n)]
    cuts = sorted(set(docs.select(place).approxQuantile("place", steps, 0.25 / n))) if steps else []
    if cuts:
        bucketed = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="place", outputCol="bucket").transform
    else:
        bucketed = lambda df: df.withColumn("bucket", F.lit(0.0))
    docs = bucketed(docs.withColumn("place", place)).withColumn("bucket", F.col("bucket").cast("int")).drop("place")
    firsts = docs.groupBy("bucket").agg(F.min("key").alias("first")).orderBy("bucket").collect()  # a row for each bucket
    into = [(row["first"], firsts[i - 1]["bucket"]) for i, row in enumerate(firsts)]
    into = spark.createDataFrame(into, "key long, target int")
    copies = F.array_compact(F.array(
        F.struct("bucket", F.lit(0).alias("copied")),
        F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("bucket"), F.lit(1).alias("copied")))))
    return (
        docs.join(F.broadcast(into), "key", "left").withColumn("at", F.explode(copies))
        .select("at.bucket", "at.copied", "key", "text")
        .repartition(n, "bucket").sortWithinPartitions("bucket", "copied", "key", "text")
        .mapInArrow(_neighbours, SCHEMA)
    )
