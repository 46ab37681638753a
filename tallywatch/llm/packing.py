"""Packing of tokenized documents into sequences by bin completion.

Documents are tokenized whole, once; a document of more than a sequence is cut into full pieces, the first of which
may be shorter. Full pieces are sequences of their own. All others matter by their length alone, so the driver
gets only the count of each length (fewer rows than a sequence has tokens) and plans how many sequences hold which
lengths: best fit gives an incumbent; branch and bound completes one sequence after the other around the longest
piece left, trying undominated fillings from the fullest on, and turns back where the waste so far rules out a
plan with fewer sequences. A filling is used as often as the counts allow, so the plan's size doesn't grow with the
table. Pieces find their place by their rank among pieces of the same length.

Null texts count as empty: a document of its end token alone. Repeated rows are packed each. An empty table gives
no rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import saved, texts_of

CAPACITY, END = 1024, 2
#: Steps that branch and bound takes beyond the first dive, and fillings tried at a step.
NODES, BRANCHES = 4000, 4


@functools.cache
def encoder(path: str):
    """text -> token ids of a byte-level BPE file of the tokenizers library, as an array.

    tiktoken merges by the same ranks, several times faster. Special tokens in a text are found as there.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def encode(text: str) -> np.ndarray:
        if cut is None or not any(s in text for s in special):
            return np.array(encoding.encode_ordinary(text), "<u4")
        parts = [[special[p]] if p in special else encoding.encode_ordinary(p) for p in cut.split(text)]
        return np.concatenate([np.array(p, "<u4") for p in parts])

    return encode


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece of n tokens."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(i, capacity) for i in range(head, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode(text), np.uint32(END)).astype("<u4")
                out += [(doc_id, i, a, n, zlib.crc32(ids[a: a + n].tobytes())) for i, (a, n) in enumerate(cuts(len(ids), capacity))]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = texts_of(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


#: A plan: fillings, as ((length, copies), ...), and in how many sequences each is used.
Plan = list[tuple[tuple[tuple[int, int], ...], int]]


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best fit by descending length; bins of equal content are one group."""
    groups: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}  # by room left
    for size in sorted(counts, reverse=True):
        left = counts[size]
        rooms = sorted(r for r in groups if r >= size)
        opened: list[tuple[int, tuple[tuple[tuple[int, int], ...], int]]] = []
        for room in [*rooms, capacity]:
            fit = room // size
            held = groups.pop(room, []) if room in rooms else [((), -(-left // fit))]
            for content, bins in held:
                full = min(bins, left // fit)
                if full:
                    opened.append((room - fit * size, (content + ((size, fit),), full)))
                left, bins = left - full * fit, bins - full
                if left and bins:
                    opened.append((room - left * size, (content + ((size, left),), 1)))
                    left, bins = 0, bins - 1
                if bins and content:
                    opened.append((room, (content, bins)))
            if not left and room != capacity:
                break
        for room, group in opened:
            groups.setdefault(room, []).append(group)
    return [g for held in groups.values() for g in held]


def fillings(counts: dict[int, int], room: int, most: int) -> Iterator[tuple[tuple[int, int], ...]]:
    """Undominated sets of lengths for the room, fullest first, longer lengths first; `most` of them at most.

    A set is dominated if a length of it can give way to a longer one that is left, or another length still fits.
    """
    sizes = [s for s in sorted(counts, reverse=True) if s <= room and counts[s] > 0]
    mask = (1 << (room + 1)) - 1
    sums = [1] * (len(sizes) + 1)  # sums that the lengths from here on can make, as bits
    for i in range(len(sizes) - 1, -1, -1):
        bits, copies, step = sums[i + 1], min(counts[sizes[i]], room // sizes[i]), 1
        while copies:
            step = min(step, copies)
            bits |= (bits << (step * sizes[i])) & mask
            copies, step = copies - step, step * 2
        sums[i] = bits
    given = 0
    for total in range(sums[0].bit_length() - 1, -1, -1):
        if not sums[0] >> total & 1:
            continue
        slack = room - total
        todo = [(0, total, ())]
        while todo:
            i, rest, chosen = todo.pop()
            if not rest:
                used = dict(chosen)
                free = [s for s in sizes if counts[s] > used.get(s, 0)]
                if not any(s <= slack for s in free) and not any(0 < s - y <= slack for y in used for s in free):
                    given += 1
                    yield chosen
                    if given == most:
                        return
                continue
            if i == len(sizes):
                continue
            size = sizes[i]
            for n in range(min(counts[size], rest // size) + 1):  # most copies are popped first
                if sums[i + 1] >> (rest - n * size) & 1:
                    todo.append((i + 1, rest - n * size, chosen + (((size, n),) if n else ())))
            if len(todo) > 10_000:
                break


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Few sequences for so many pieces of each length; no more than best fit needs."""
    counts = {s: n for s, n in counts.items() if n > 0}
    best = best_fit(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    least = max(-(-total // capacity), sum(n for s, n in counts.items() if 2 * s > capacity))
    bins = sum(n for _, n in best)
    path: Plan = []
    tries: list[Iterator] = []

    def step() -> Iterator:
        """Fillings around the longest piece left, with how often they can be used."""
        largest = max(counts)
        counts[largest] -= 1
        found = list(fillings(counts, capacity - largest, BRANCHES))
        counts[largest] += 1
        for rest in found:
            filling = dict(rest)
            filling[largest] = filling.get(largest, 0) + 1
            often = min(counts[s] // n for s, n in filling.items())
            yield tuple(sorted(filling.items(), reverse=True)), often
        return

    def use(filling, often, sign) -> None:
        for s, n in filling:
            counts[s] = counts.get(s, 0) - sign * n * often
            if not counts[s]:
                del counts[s]

    waste = 0
    first_dive = True
    if bins > least and counts:
        tries.append(step())
        while tries and bins > least and (first_dive or nodes > 0):
            nodes -= not first_dive
            chosen = next(tries[-1], None)
            if chosen is None:
                tries.pop()
                if path:
                    filling, often = path.pop()
                    use(filling, often, -1)
                    waste -= often * (capacity - sum(s * n for s, n in filling))
                first_dive = False
                continue
            filling, often = chosen
            lost = often * (capacity - sum(s * n for s, n in filling))
            if waste + lost > (bins - 1) * capacity - total:  # no better than the incumbent
                first_dive = False
                continue
            use(filling, often, 1)
            path.append(chosen)
            waste += lost
            if counts:
                tries.append(step())
                continue
            first_dive = False
            bins, best = sum(n for _, n in path), list(path)
            path.pop()
            use(filling, often, -1)
            waste -= lost
    return best


def _places(plan: Plan) -> dict[int, np.ndarray]:
    """By length: rows of first rank, first sequence, copies in a sequence, place of the first copy."""
    taken: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for filling, often in plan:
        at = 0
        for size, copies in filling:
            out.setdefault(size, []).append((taken.get(size, 0), sequence, copies, at))
            taken[size] = taken.get(size, 0) + copies * often
            at += size * copies
        sequence += often
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


def ranked(rows: DataFrame) -> DataFrame:
    """Adds rank, from 0, among rows of the same length, without bringing these together: by buckets and their counts."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy("length", "bucket").agg(F.count("*").alias("own"))
        .select("length", "bucket", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("inside", F.row_number().over(inside))
    return rows.join(counts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside") - 1).drop("bucket", "before", "inside")


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    cut = saved(pieces(docs, path or public_tokenizers.path("byte_bpe_50k.json"), capacity))
    short = cut.where(F.col("length") < capacity)
    counts = {row["length"]: row["count"] for row in short.groupBy("length").count().collect()}  # fewer than `capacity` rows
    plan = bin_completion(counts, capacity)
    places, bins = _places(plan), sum(n for _, n in plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                own = length == size
                rows = places[int(size)]
                first, base, copies, at = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1].T
                sequence[own] = base + (rank[own] - first) // copies
                offset[own] = at + (rank[own] - first) % copies * size
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in COLUMNS[:5]), pa.array(sequence), pa.array(offset)], list(COLUMNS))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    whole = cut.where(F.col("length") == capacity).withColumn("sequence_id", F.monotonically_increasing_id() + bins).withColumn("offset", F.lit(0).cast("long"))
    return ranked(short).select(*COLUMNS[:5], "rank").mapInArrow(place, schema).union(whole.select(*COLUMNS))
