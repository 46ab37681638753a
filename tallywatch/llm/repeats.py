"""Removal of byte strings that an earlier document holds, by run-length indexes over the repetitive part.

A 50-byte string is repeated if it also starts in a document with a smaller id. Every string picks the smallest hash of
its 16-byte grams; consecutive strings with the same pick are one segment, and equal strings are found under equal
picks alone. Segments are dealt out by their pick as hashes. Where the whole segment recurs, it is covered at once;
where different segments share a pick (at the rims of a repeat), their bytes are fetched and meet in an index: a
run-length compressed Burrows-Wheeler transform, sorted by 50 bytes, with text positions sampled at the ends of runs.
Segments without a string whose hash another
document shares stay out of it. Segments of later documents stream through it backwards as matching statistics, jumping at a mismatch to the nearer
sampled run end; where 50 bytes match, the smallest document among the equal ones decides. Picks of very many
different segments don't meet in one index: their strings are grouped by hash with partial aggregates instead.

Matches never cross documents, and strings are judged on the input. Null texts count as empty. Documents without an id
come behind all others; rows of one id aren't earlier than each other. Repeated rows get the same result each. A text is known
by its id and a 64-bit hash, so that only different texts without an id could be mixed up, n of them with a chance of n^2 / 2^65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import mixed, released, rowed, saved, unrowed, utf8
from tallywatch.llm.shingles import chunked, powers

#: Bytes of a string and of a gram, strings in a segment at most, bytes of a byte that UTF-8 doesn't use.
LENGTH, GRAM, STOP = 50, 16, 0xFF
SPAN = LENGTH - GRAM + 1
#: Text bytes behind one part of the segment hashes, segments in one index, and segments of a pick that meet in one.
PART_BYTES, INDEX_SEGMENTS, HOT = 10 << 20, 20_000, 4096
_NO_ID = (1 << 63) - 1
_FIELDS = (("pick", "<u4"), ("body", "<i8"), ("whole", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("run", "u1"))


def segments(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Of many texts: each segment's text number, first byte in it, count of strings, pick and hash of its bytes."""
    n = len(data)
    raw = np.concatenate([data, np.zeros(LENGTH + 16, np.uint8)])
    word = np.ndarray((n + GRAM,), "<u8", raw.data, 0, (1,)).astype(np.uint64)
    least = mixed(word[:n] * np.uint64(0x9E3779B97F4A7C15) + mixed(word[8: n + 8] ^ np.uint64(0xC2B2AE3D27D4EB4F)))
    have = 1
    while have * 2 <= SPAN:  # the least hash of 2, 4, ... grams from each byte on
        least[: n - have] = np.minimum(least[: n - have], least[have:])
        have *= 2
    if have < SPAN:
        more = SPAN - have
        least[: n - more] = np.minimum(least[: n - more], least[more:])
    last = np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
    many = last - offsets[:-1]
    at = np.repeat(offsets[:-1] - np.cumsum(many) + many, many) + np.arange(many.sum())
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(at)))
    pieces = -(-run // SPAN)  # equal grams can make a run longer
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = at[np.repeat(first, pieces)] + inner * SPAN
    run = np.minimum(np.repeat(run, pieces) - inner * SPAN, SPAN)
    up, down = powers(n)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)])
    whole = mixed((total[start + run + LENGTH - 1] - total[start]) * down[start] + run.astype(np.uint64))
    text = np.searchsorted(offsets, start, "right") - 1
    return {"text": text, "start": start - offsets[text], "run": run, "pick": least[start], "whole": whole}


class RunLengthIndex:
    """Sources joined by bytes that no text holds: runs of the transform, samples at run ends, smallest document of equal strings."""

    def __init__(self, sources: list[bytes], docs: np.ndarray):
        stop = bytes([STOP])
        text = np.frombuffer(stop.join(sources) + stop * (LENGTH + 16), np.uint8)
        n = len(text) - LENGTH - 15
        sizes = np.array([len(s) + 1 for s in sources])
        self.text = text
        padded = np.concatenate([text, np.full(LENGTH + 16, STOP, np.uint8)])
        big = np.ndarray((n + LENGTH + 16,), ">u8", padded.data, 0, (1,)).astype(np.uint64)
        rank = np.unique(big, return_inverse=True)[1].astype(np.int64)
        for step in (8, 16, LENGTH - 32):  # ranks of the first 16, 32 and 50 bytes
            rank = _ranked_on(rank, step)
        equal, width = rank[:n], LENGTH
        while len(np.unique(rank[:n])) < n and width < len(rank):  # and of whole suffixes
            rank, width = _ranked_on(rank, width), width * 2
        order = np.argsort(rank[:n], kind="stable")
        rank = equal
        self.equal = np.cumsum(np.append(0, rank[order][1:] != rank[order][:-1]))
        owner = np.append(np.repeat(docs, sizes)[: n - 1], _NO_ID)[:n]
        self.smallest = np.minimum.reduceat(owner[order], np.flatnonzero(np.append(True, self.equal[1:] != self.equal[:-1])))
        before = text[order - 1]
        before[order == 0] = STOP
        head = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.starts, self.heads = head, before[head]
        ends = np.append(head[1:], n)
        self.first, self.last = order[head], order[ends - 1]  # sampled positions
        self.ends = ends
        counts = np.bincount(before, minlength=256)
        self.below = np.cumsum(counts) - counts
        by = np.argsort(self.heads, kind="stable")  # runs of each byte, in order
        self.runs = by
        self.of_byte = np.searchsorted(self.heads[by], np.arange(257))
        sizes = (ends - head)[by]
        total = np.cumsum(sizes) - sizes
        own = np.zeros(len(head), np.int64)
        own[by] = total - (total[np.minimum(self.of_byte[self.heads[by]], len(by) - 1)] if len(by) else 0)
        self.before = own  # of each run: bytes like its own in earlier runs

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal bytes from two text positions on, up to LENGTH."""
        steps = np.arange(LENGTH)
        n = len(self.text) - 1
        differ = self.text[np.minimum(a[:, None] + steps, n)] != self.text[np.minimum(b[:, None] + steps, n)]
        return np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)

    def stream(self, queries: list[bytes]) -> np.ndarray:
        """For each query and byte: the smallest document that holds the 50 bytes from there on, or _NO_ID."""
        wide = max(map(len, queries))
        found = np.full((len(queries), wide), _NO_ID)
        sizes = np.array([len(q) for q in queries])
        matrix = np.frombuffer(b"".join(q.rjust(wide, bytes([STOP])) for q in queries), np.uint8).reshape(-1, wide)
        place = np.zeros(len(queries), np.int64)  # in suffix order
        point = np.full(len(queries), self.first[0])  # in the text
        length = np.zeros(len(queries), np.int64)
        for column in range(wide - 1, -1, -1):
            live = np.flatnonzero(sizes >= wide - column)
            byte = matrix[live, column]
            low, high = self.of_byte[byte], self.of_byte[byte.astype(np.int64) + 1]
            known = low < high
            length[live[~known]] = 0  # a byte that no source holds
            live, byte, low, high = (x[known] for x in (live, byte, low, high))
            run = np.searchsorted(self.starts, place[live], "right") - 1
            off = self.heads[run] != byte
            # The next run of the byte, and the one before it, in its own list.
            nearest = np.flatnonzero(off)
            if len(nearest):
                follow = _search(self.runs, run[nearest], low[nearest], high[nearest])
                has_next, has_last = follow < high[nearest], follow > low[nearest]
                after = self.runs[np.minimum(follow, high[nearest] - 1)]
                ahead = self.runs[np.maximum(follow - 1, low[nearest])]
                own = live[nearest]
                down = np.where(has_next, self._common(point[own], self.first[after]), -1)
                up = np.where(has_last, self._common(point[own], self.last[ahead]), -1)
                take = down >= up
                run[nearest] = np.where(take, after, ahead)
                place[own] = np.where(take, self.starts[after], self.ends[ahead] - 1)
                point[own] = np.where(take, self.first[after], self.last[ahead])
                length[own] = np.minimum(length[own], np.maximum(down, up))
            place[live] = self.below[byte] + self.before[run] + place[live] - self.starts[run]
            point[live] -= 1
            length[live] = np.minimum(length[live] + 1, LENGTH)
            hit = live[length[live] >= LENGTH]
            found[hit, column - wide + sizes[hit]] = self.smallest[self.equal[place[hit]]]
        return found


def _ranked_on(rank: np.ndarray, step: int) -> np.ndarray:
    """Ranks by an entry and the one `step` further on."""
    after = np.full(len(rank), rank.max() + 1)
    after[: max(len(rank) - step, 0)] = rank[step:]
    return np.unique(rank * (rank.max() + 2) + after, return_inverse=True)[1].astype(np.int64)


def _search(runs: np.ndarray, value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """First index in runs[low:high] with a larger entry, by bisection of all at once."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        right = open_ & (runs[np.minimum(middle, len(runs) - 1)] <= value)
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """part, data: the segments' columns behind their count, for each part and batch."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            doc, body = (batch.column(c).to_numpy() for c in ("doc", "body"))
            held = []
            for a, b in chunked(offsets):
                if offsets[b] - offsets[a] >= LENGTH:
                    found = segments(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                    text = found.pop("text") + a
                    held.append(found | {"doc": doc[text], "body": body[text]})
            if not held:
                continue
            every = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            part = every["pick"] % np.uint64(parts)
            every["pick"] = every["pick"] >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            cut = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
            columns = [every[c][order].astype(kind) for c, kind in _FIELDS]
            out = [b"".join(x[i:j].tobytes() for x in columns) for i, j in zip(cut, np.append(cut[1:], len(order)))]
            for i in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[order][cut][i: i + 64].astype(np.int64)), pa.array(out[i: i + 64], pa.binary())], ["part", "data"])

    return docs.mapInArrow(deal, "part long, data binary")


def _unpacked(blobs: list[bytes]) -> dict[str, np.ndarray]:
    width = sum(np.dtype(k).itemsize for _, k in _FIELDS)
    out: dict[str, list[np.ndarray]] = {c: [] for c, _ in _FIELDS}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for c, kind in _FIELDS:
            out[c].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {c: np.concatenate(x) for c, x in out.items()}


def _by_part(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int, dict[str, list]]]:
    """Rows sorted by part, a part at a time."""
    part, held = None, {c: [] for c in names}
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in names}
        own = batch.column("part").to_pylist()
        for i, p in enumerate(own):
            if p != part:
                if part is not None:
                    yield part, held
                part, held = p, {c: [] for c in names}
            for c in names:
                held[c].append(columns[c][i])
    if part is not None:
        yield part, held


_JUDGED = "doc long, body long, start int, length int, pick long, rivals int, source boolean, query boolean"


def _judged(dealt: DataFrame, parts: int) -> DataFrame:
    """Covered segments (rivals 0), and those to compare: kinds of segment that share a pick with others, in several documents."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in _by_part(batches, ("data",)):
            x = _unpacked(held["data"])
            order = np.lexsort((x["start"], x["doc"], x["run"], x["whole"], x["pick"]))
            x = {c: v[order] for c, v in x.items()}
            new_pick = np.append(True, x["pick"][1:] != x["pick"][:-1])
            new = new_pick | np.append(True, (x["whole"][1:] != x["whole"][:-1]) | (x["run"][1:] != x["run"][:-1]))
            kind = np.cumsum(new) - 1
            leads = np.flatnonzero(new)
            covered = x["doc"] > x["doc"][leads][kind]
            pick = np.cumsum(new_pick)[leads] - 1  # of each kind
            starts = np.flatnonzero(np.append(True, pick[1:] != pick[:-1]))
            lead = x["doc"][leads]
            kinds = np.diff(np.append(starts, len(leads)))[pick]
            least, most = np.minimum.reduceat(lead, starts)[pick], np.maximum.reduceat(lead, starts)[pick]
            # The first of a kind is a source for later documents; all in its document ask for earlier ones.
            asked = np.flatnonzero(~covered & (least < most)[kind] & (new | (lead > least)[kind]))
            own = kind[asked]
            rivals = kinds[own]
            source, query = new[asked] & (lead < most)[own], (lead > least)[own]
            rows = np.concatenate([np.flatnonzero(covered), asked])
            plain = np.zeros(len(rows) - len(asked), bool)
            yield pa.RecordBatch.from_arrays([
                pa.array(x["doc"][rows]), pa.array(x["body"][rows]), pa.array(x["start"][rows]),
                pa.array(x["run"][rows].astype(np.int32) + LENGTH - 1),
                pa.array(x["pick"][rows].astype(np.int64) * parts + part),
                pa.array(np.concatenate([plain.astype(np.int32), rivals.astype(np.int32)])),
                pa.array(np.concatenate([plain, source])), pa.array(np.concatenate([plain, query])),
            ], ["doc", "body", "start", "length", "pick", "rivals", "source", "query"])

    return dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(judge, _JUDGED)


def _fetched(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """asked with the bytes of each segment."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            rows = batch.column("rows")
            many = np.diff(rows.offsets.to_numpy())
            flat = rows.flatten()
            start, length = (flat.field(c).to_numpy() for c in ("start", "length"))
            at = np.repeat(offsets[:-1], many) + start
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("doc").to_numpy(), many)), pa.array(np.repeat(batch.column("body").to_numpy(), many)),
                *(flat.field(c) for c in ("start", "pick", "rivals", "source", "query")),
                pa.array([raw[a: a + n] for a, n in zip(at.tolist(), length.tolist())], pa.binary()),
            ], ["doc", "body", "start", "pick", "rivals", "source", "query", "bytes"])

    rows = asked.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "length", "pick", "rivals", "source", "query")).alias("rows"))
    return docs.dropDuplicates(["doc", "body"]).join(rows, ["doc", "body"]).mapInArrow(
        cut, "doc long, body long, start int, pick long, rivals int, source boolean, query boolean, bytes binary")


def _sharing(segments_: list[bytes], docs: np.ndarray) -> np.ndarray:
    """Segments of which a string has the hash of one in another document's: the others need no index."""
    sizes = np.array([len(s) for s in segments_])
    data = np.frombuffer(b"".join(segments_), np.uint8)
    first, many = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
    own = np.repeat(np.arange(len(sizes)), many)
    at = np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)
    up, down = powers(len(data))
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    found = mixed((total[at + LENGTH] - total[at]) * down[at])
    order = np.argsort(found, kind="stable")
    lead = np.flatnonzero(np.append(True, found[order][1:] != found[order][:-1]))
    holder = docs[own[order]]
    apart = np.minimum.reduceat(holder, lead) < np.maximum.reduceat(holder, lead)
    out = np.zeros(len(sizes), bool)
    out[own[order][np.repeat(apart, np.diff(np.append(lead, len(order))))]] = True
    return out


_COVERED = "doc long, body long, start int, length int"


def _matched(fetched: DataFrame, indexes: int) -> DataFrame:
    """Covered stretches of the queries, by an index over the sources of each part."""
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc", "body", "start", "source", "query", "bytes")
        for _, held in _by_part(batches, names):
            doc, body, start = (np.array(held[c], np.int64) for c in ("doc", "body", "start"))
            shared = _sharing(held["bytes"], doc)
            source, query = (np.flatnonzero(np.array(held[c]) & shared) for c in ("source", "query"))
            if not len(source) or not len(query):
                continue
            index = RunLengthIndex([held["bytes"][i] for i in source], doc[source])
            for i in range(0, len(query), 8192):
                own = query[i: i + 8192]
                row, column = np.nonzero(index.stream([held["bytes"][j] for j in own]) < doc[own][:, None])
                lead = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (column[1:] != column[:-1] + 1)) if len(row) else [])
                many = np.diff(np.append(lead, len(row)))
                at = own[row[lead]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc[at]), pa.array(body[at]), pa.array((start[at] + column[lead]).astype(np.int32)),
                    pa.array((many + LENGTH - 1).astype(np.int32))], ["doc", "body", "start", "length"])

    part = F.pmod(F.xxhash64("pick"), F.lit(indexes))
    return fetched.withColumn("part", part).repartition(indexes, "part").sortWithinPartitions("part").mapInArrow(match, _COVERED)


def _hashed(fetched: DataFrame) -> DataFrame:
    """Covered strings of picks with very many kinds, by the smallest document of each string's hash."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (doc, body, start + i, digest[:8], digest[8:])
                for doc, body, start, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "body", "start", "bytes")))
                for i in range(len(raw) - LENGTH + 1)
                for digest in [hashlib.blake2b(raw[i: i + LENGTH], digest_size=16).digest()]
            ]
            low, high = (np.frombuffer(b"".join(x[k] for x in out), "<i8") for k in (3, 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.int32()), pa.array(low), pa.array(high)], ["doc", "body", "start", "low", "high"])

    every = fetched.mapInArrow(strings, "doc long, body long, start int, low long, high long")
    least = every.groupBy("low", "high").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    return every.join(least, ["low", "high"]).where("doc > least").select("doc", "body", "start", F.lit(LENGTH).alias("length"))


def covered(docs: DataFrame) -> DataFrame:
    """doc, body, spans (start, length) of stretches of repeated strings; docs: doc, body, text."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    judged = saved(_judged(_dealt(docs, parts), parts))
    released(spark)
    asked = judged.where("rivals > 0")
    n = asked.count()
    fetched = saved(_fetched(docs, asked))
    released(spark)
    rows = judged.where("rivals = 0").select("doc", "body", "start", "length")
    rows = rows.union(saved(_matched(fetched.where(F.col("rivals") <= HOT), max(1, -(-n // INDEX_SEGMENTS)))))
    rows = rows.union(_hashed(fetched.where(F.col("rivals") > HOT)))
    return saved(rows.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "length")).alias("spans")))


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(text).alias("body"), text.alias("text"), *more)


def kept_parts(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside all spans, and the number of maximal removed runs."""
    out, at, end, runs = [], 0, -1, 0
    for start, length in sorted(spans):
        if start > end:
            runs += 1
            out.append(raw[at:start])
        end = max(end, start + length)
        at = end
    out.append(raw[at:])
    return b"".join(out), runs


def _spans_of(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    rows = batch.column("spans")
    for row in rows:
        yield list(zip(row.values.field("start").to_pylist(), row.values.field("length").to_pylist())) if row.is_valid else []


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = _keyed(docs)
    found = covered(docs)
    released(docs.sparkSession)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), _spans_of(batch)):
                raw = text.encode()
                left, runs = kept_parts(raw, spans)
                out.append((None if doc == _NO_ID else doc, len(raw), len(raw) - len(left), runs, hashlib.sha256(left).hexdigest()))
            kinds = (pa.int64(),) * 4 + (pa.string(),)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return docs.join(found, ["doc", "body"], "left").mapInArrow(remove, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes cut out of their texts; characters of which bytes remain alone go too."""
    found = covered(_keyed(docs))
    released(docs.sparkSession)
    rows = rowed(docs).select("row", "text", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("body"))
    rows = rows.join(found, ["doc", "body"], "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                kept_parts(text.encode(), spans)[0].decode("utf-8", "ignore") if spans else text
                for text, spans in zip(batch.column("text").to_pylist(), _spans_of(batch))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return unrowed(rows.mapInArrow(cut, rows.select("row", "text").schema), docs)
