"""Vector codes: product quantization in whole numbers, with nearest entries found by slicing and intersecting bitmasks.

Components become floor(1024 * x). A vector is cut into ``PARTS`` equal parts, each with a codebook of at most
``ENTRIES`` entries, started from the smallest ids and moved by rounds of assigning and averaging.

For each dimension of a part, ``Slices`` holds the entries' coordinates in order, and for each place in that order a
mask of the entries before it (uint64 words). The entries within a radius of a part in one dimension are a range of
that order, so their mask is the mask at its end without the mask at its start; the AND over all dimensions leaves the
entries that lie within the radius in every dimension. No entry at a distance up to the radius is missing from these
candidates, so the nearest one is found for certain once its distance is within the radius. Where it isn't, the radius
becomes that distance; where there are no candidates, the radius doubles. The initial radius is that which held the
nearest entry of most parts so far.

Each round is one pass over the table: a task sends its counts and sums of each entry (entries x dimensions, whatever its rows),
which are added up by entry, and the driver holds codebooks only. Rows are held by a task a batch at a time.

Rows whose vector is null or holds null or non-finite components are dropped. Vectors shorter than the longest one are
filled up with zeros, as are all where the length isn't a multiple of ``PARTS``; empty vectors are kept. Components
beyond +-2^25 (+-32,768 before scaling) are held there, so that distances stay within 64 bits. Rows that share an id are rows of their own; the
codebook starts with them in order of id (nulls last) and vector. Sums of errors beyond 64 bits are held at 2^63 - 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import saved

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components are held within this bound: squared distances of 2,000 dimensions stay within 63 bits.
BOUND = 1 << 25
#: Rows compared at once, and labels that may be sent to every task: those with over 1 / HOT_LABELS of all rows.
SLICE_ROWS, HOT_LABELS = 1024, 4096


class Slices:
    """The index over one codebook: (entries, dimensions) whole numbers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        words = -(-n // 64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(entries, order, axis=0).T.copy()
        #: prefixes[d, i]: mask of the i entries with the smallest coordinates in dimension d.
        self.prefixes = np.zeros((width, n + 1, words), np.uint64)
        for i in range(n):
            at = order[i]
            self.prefixes[:, i + 1] = self.prefixes[:, i]
            self.prefixes[np.arange(width), i + 1, at // 64] |= np.uint64(1) << (at % 64).astype(np.uint64)
        self.everything = self.prefixes[0, n] if width else (~np.zeros(words, np.uint64))
        self.compared = self.looked = 0

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of all entries within the row's radius in every dimension, ordered by row and entry."""
        masks = np.tile(self.everything, (len(parts), 1))
        for d, (ordered, prefix) in enumerate(zip(self.coordinates, self.prefixes)):
            first = np.searchsorted(ordered, parts[:, d] - radius, "left")
            last = np.searchsorted(ordered, parts[:, d] + radius, "right")
            masks &= prefix[last] ^ prefix[first]
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little", count=len(self.entries))
        return np.nonzero(bits)

    def nearest(self, parts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, the lowest index among equals, and its squared distance."""
        code, least = np.zeros(len(parts), np.int64), np.full(len(parts), -1, np.int64)
        if not parts.shape[1]:
            return code, least + 1
        radius, waiting = np.full(len(parts), max(1, start), np.int64), np.arange(len(parts))
        while len(waiting):
            row, entry = self.candidates(parts[waiting], radius[waiting])
            apart = parts[waiting[row]] - self.entries[entry]
            squares = np.einsum("ij,ij->i", apart, apart)
            self.compared += len(row)
            self.looked += len(waiting)
            best = np.lexsort((entry, squares, row))
            best = best[np.unique(row[best], return_index=True)[1]]
            found = waiting[row[best]]
            code[found], least[found] = entry[best], squares[best]
            sure = np.zeros(len(parts), bool)
            sure[found] = least[found] <= radius[found] * radius[found]
            grown = radius[waiting] * 2
            bound = np.sqrt(np.maximum(least[waiting], 0).astype(float)).astype(np.int64) + 1
            radius[waiting] = np.where(least[waiting] >= 0, bound, grown)
            waiting = waiting[~sure[waiting]]
        return code, least


class Codebooks:
    """parts: an array (entries, dimensions) for each part."""

    def __init__(self, parts: list[np.ndarray]):
        self.parts = parts
        self.slices = [Slices(p) for p in parts]
        self.radius = [0] * len(parts)

    def __reduce__(self):
        return Codebooks, (self.parts,)

    @property
    def width(self) -> int:
        return sum(p.shape[1] for p in self.parts)

    def sha256(self) -> str:
        """Of all components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for p in self.parts for x in p.ravel().tolist()).encode()).hexdigest()

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of each vector's parts, and their squared distances, as (vectors, parts)."""
        code, error = np.zeros((len(vectors), len(self.parts)), np.int64), np.zeros((len(vectors), len(self.parts)), np.int64)
        width = self.width // len(self.parts)
        for at in range(0, len(vectors), SLICE_ROWS):
            here = slice(at, at + SLICE_ROWS)
            for i, index in enumerate(self.slices):
                code[here, i], error[here, i] = index.nearest(vectors[here, i * width: (i + 1) * width], self.radius[i])
                self.radius[i] = int(np.sqrt(np.quantile(error[here, i], 0.75))) + 1 if len(error[here]) else self.radius[i]
        return code, error


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows of ``width`` whole numbers, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    scaled = np.clip(np.floor(values * float(SCALE)), -BOUND, BOUND).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    if (sizes == width).all():
        return scaled.reshape(len(column), width)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(scaled)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = scaled
    return out


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector (doubles) of the rows that take part."""
    vector = "transform(embedding, x -> CAST(x AS DOUBLE))"
    odd = "exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    label = "label" if "label" in embeddings.columns else "CAST(NULL AS INT) AS label"
    return (embeddings.selectExpr("CAST(vec_id AS BIGINT) AS vec_id", label, f"{vector} AS vector")
            .where(f"vector IS NOT NULL AND NOT {odd}"))


def _started(rows: DataFrame) -> Codebooks:
    width = rows.selectExpr("max(size(vector)) AS w").first().w or 0
    width = -(-width // PARTS) * PARTS
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vector").toArrow()
    matrix = np.concatenate([whole_numbers(c, width) for c in first["vector"].chunks] or [np.zeros((0, width), np.int64)])
    return Codebooks([np.ascontiguousarray(part) for part in np.split(matrix, PARTS, axis=1)])


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry moved to the mean of its parts, rounded down."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    wide = books.width // PARTS
    names = [f"s{d}" for d in range(wide)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        count = np.zeros((PARTS, ENTRIES), np.int64)
        total = np.zeros((PARTS, ENTRIES, wide), np.int64)
        for batch in batches:
            vectors = whole_numbers(batch.column(0), books.width)
            code, _ = books.codes(vectors)
            for i in range(PARTS):
                count[i] += np.bincount(code[:, i], minlength=ENTRIES)
                np.add.at(total[i], code[:, i], vectors[:, i * wide: (i + 1) * wide])
        part, entry = np.nonzero(count)
        columns = [part, entry, count[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "n", *names])

    schema = ", ".join(f"{c} long" for c in ("part", "entry", "n", *names))
    exact = [F.expr(f"sum(CAST({c} AS DECIMAL(38,0)))").alias(c) for c in ("n", *names)]
    parts = [p.copy() for p in books.parts]
    # One row for each entry of each part.
    for row in rows.select("vector").mapInArrow(sums, schema).groupBy("part", "entry").agg(*exact).collect():
        parts[row.part][row.entry] = [int(row[c]) // int(row.n) for c in names]
    sent.unpersist()
    return Codebooks(parts)


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of all rows after so many rounds."""
    books = _started(rows)
    for _ in range(rounds):
        books = _moved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error of every row."""
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            code, error = books.codes(whole_numbers(batch.column("vector"), books.width))
            texts = pa.array([bytes(c).hex() for c in code.astype(np.uint8)], pa.string())
            columns = [batch.column("vec_id"), batch.column("label"), texts, pa.array(error.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(coded, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error: errors summed over equal labels, nulls together.

    Labels are added up before any exchange. Sums of labels with many rows, at most HOT_LABELS of them, go to every
    task; rows of the others meet their sum under the label, so no label fills a task.
    """
    label = "coalesce(to_json(struct(label)), '')"
    total = "CAST(least(sum(CAST(error AS DECIMAL(38,0))), 9223372036854775807) AS BIGINT)"
    sums = saved(coded.groupBy(F.expr(label).alias("l")).agg(F.expr("count(*) AS n"), F.expr(f"{total} AS label_error")))
    limit = (sums.agg(F.sum("n")).first()[0] or 0) / HOT_LABELS
    hot = sums.where(f"n > {limit}").selectExpr("l", "label_error AS hot_error")
    cold = sums.where(f"n <= {limit}").selectExpr("l AS cold", "label_error AS cold_error")
    joined = coded.withColumn("l", F.expr(label)).join(F.broadcast(hot), "l", "left")
    key = "CASE WHEN hot_error IS NULL THEN l ELSE concat('row ', coalesce(vec_id, 0)) END"
    return (joined.withColumn("cold", F.expr(key)).join(cold, "cold", "left")
            .withColumn("label_error", F.expr("coalesce(hot_error, cold_error)")).drop("l", "cold", "hot_error", "cold_error"))


def digests(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that takes part."""
    rows = vectors_of(embeddings)
    books = fit(rows)
    coded = saved(encode(rows, books))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
