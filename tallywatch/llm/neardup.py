"""Near-duplicate groups by SetSketch registers.

A document's set is its distinct word shingles. Each register keeps, on an exponentially spaced and truncated
scale, the smallest of the exponential variates that a hash gives the elements: registers of a union are the
larger of the two (`merged`), and equal ones grow more likely with similarity. Documents of equal sets are one
class. Bands of registers bring classes into buckets; in each bucket all members meet its centre, the member that
meets most others over all buckets, and thereafter only members of still different components meet, in blocks.
Pairs that the joint likelihood of their registers puts far below the threshold are left out, the others are
confirmed on the full sets. Components follow from the confirmed links.

A pair at the threshold is missed with a chance below 3.1e-6 (similarity 0.8) or 1e-8 (0.85): 3.04e-6 or 7.1e-9 that
none of 32 bands of 5 registers is equal, and 2.0e-9 or 2.9e-9 that its estimate is ERRORS below the threshold. Null texts count as empty; documents without words, or without an id, are linked with nothing and are
components of their own. Repeated rows are equal sets. Rows that share an id are documents of their own: each text is linked by
itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import mixed, released, saved, utf8
from tallywatch.llm.shingles import chunked, sets_of, shingle_sets

#: Registers in a band, bands; base and rate of the scale, largest register value less one.
ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
BASE, RATE, Q = 1.001, 20.0, (1 << 16) - 2
#: Members of a bucket that meet at once, and standard errors of the estimate below the threshold that still count.
MEET, ERRORS = 256, 6.5

_draw = np.random.default_rng(7)
_FACTORS = _draw.integers(0, 1 << 31, (REGISTERS, 2), np.uint32) * np.uint32(2) + np.uint32(1)


def registers(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of registers for each set; zeros for an empty one."""
    out = np.zeros((len(at) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    low, high, starts = found.astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32), at[full]
    least = np.empty((REGISTERS, len(full)), np.uint32)
    for i, (a, b) in enumerate(_FACTORS):
        least[i] = np.minimum.reduceat(low * a + high * b, starts)
    variates = -np.log1p(-(least.T.astype(float) + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1.0 - np.log(variates) / math.log(BASE)), 0, Q + 1).astype(np.uint16)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def similarity(above: np.ndarray, below: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sets of n and m elements, of which so many registers are above and below."""
    share_n, share_m = n / (n + m), m / (n + m)
    same = REGISTERS - above - below

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        over, under = chance(share_n - share_m * j), chance(share_m - share_n * j)
        log = lambda x: np.log(np.maximum(x, 1e-300))
        return above * log(over) + below * log(under) + same * log(1 - over - under)

    low, high = np.zeros(len(n)), np.minimum(share_n / share_m, share_m / share_n)
    for _ in range(40):  # the likelihood has one maximum
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        up = likelihood(a) < likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


def least_estimate(threshold: float) -> float:
    return threshold - ERRORS * math.sqrt(threshold * (1 - threshold) / REGISTERS)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, body (hash of the text), n (set size), a and b (hash of the set), registers."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for x, y in chunked(offsets):
                found, at = shingle_sets(data[offsets[x]: offsets[y]], offsets[x: y + 1] - offsets[x], k)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(found ^ np.uint64(seed)), dtype=np.uint64)]) for seed in (1, 2)]
                held = registers(found, at)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[x:y], batch.column("body")[x:y], pa.array(np.diff(at), pa.int64()),
                    *(pa.array((s[at[1:]] - s[at[:-1]]).view(np.int64)) for s in sums),
                    pa.array([r.tobytes() for r in held], pa.binary()),
                ], ["doc_id", "body", "n", "a", "b", "registers"])

    docs = _bodies(docs)
    return docs.mapInArrow(sketch, "doc_id long, body long, n long, a long, b long, registers binary")


def _bodies(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("body"), text.alias("text"))


def _likely(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of pairs with both set sizes and registers, those that may reach the threshold."""
    least = least_estimate(threshold)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("registers_u", "registers_v"))
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("n_u", "n_v"))
            near = similarity((a > b).sum(axis=1), (a < b).sum(axis=1), n, m) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(near)) for c in ("u", "v", "meets")], ["u", "v", "meets"])

    return pairs.mapInArrow(keep, "u long, v long, meets long")


def _confirmed(pairs: DataFrame, bodies: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold. bodies: id, text."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            us, vs = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            good = []
            for u, left, right in zip(us, batch.column("text_u"), sets_of(batch.column("text_v").to_pylist(), k)):
                if u != held:
                    held, own = u, sets_of([left.as_py()], k)[0]
                both = len(np.intersect1d(own, right, assume_unique=True))
                good.append(100 * both >= percent * (len(own) + len(right) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, ok in zip(y, good) if ok], pa.int64()) for y in (us, vs)], ["u", "v"])

    sides = [bodies.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}")) for x in "uv"]
    return pairs.join(sides[1], "v").join(sides[0], "u").mapInArrow(check, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of all ids in links (u, v); a saved table."""
    both = saved(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct())
    labels = saved(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("v"), "component"), "v")
            .groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("over"))
        labels = saved(
            lower.join(jump, "component", "left")
            .select("id", "was", F.least("component", F.coalesce("over", "component")).alias("component")))
        if labels.where("component <> was").isEmpty():
            return labels.select("id", "component")
        labels = labels.select("id", "component")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends aren't in one component yet."""
    sides = [labels.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}")) for x in "uv"]
    pairs = pairs.join(sides[1], "v", "left").join(sides[0], "u", "left")
    return pairs.where("coalesce(of_u, u) <> coalesce(of_v, v)").select("u", "v")


def _cross_links(members: DataFrame, labels: DataFrame, classes: DataFrame, bodies: DataFrame, k: int, percent: int) -> DataFrame:
    """Confirmed links between members of one bucket that are in different components.

    Members of the largest component of a bucket meet the others only; both are dealt out in blocks, each block of
    members with each block of others, and only links leave a block. A pair is tried in the first band that both share.
    """
    threshold = percent / 100
    least = least_estimate(threshold)
    members = members.select("key", "band", "id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    largest = (
        members.groupBy("key", "component").count()
        .groupBy("key").agg(F.max(F.struct("count", "component")).alias("most"), F.sum("count").alias("all"), F.count("*").alias("parts"))
        .where("parts > 1").select("key", F.col("most.component").alias("main"), "all", (F.col("all") - F.col("most.count")).alias("rest"))
    )
    blocks = lambda n: F.ceil(F.col(n) / MEET)
    span = lambda n: F.sequence(F.lit(0).cast("long"), blocks(n) - 1)
    home = lambda n: F.array(F.pmod(F.xxhash64("id"), blocks(n)))
    other = F.col("component") != F.col("main")
    one = lambda role, i, j: F.transform(i, lambda x: F.transform(j, lambda y: F.struct(F.lit(role).alias("other"), x.alias("i"), y.alias("j"))))
    places = F.flatten(F.concat(one(0, home("all"), span("rest")), F.when(other, one(1, span("all"), home("rest"))).otherwise(F.array())))
    members = saved(members.join(largest, "key").select("key", "band", "id", "component", F.explode(places).alias("at")))
    groups = (
        members.join(classes.select("id", "n", "registers").join(bodies, "id"), "id")
        .groupBy("key", "band", "at.i", "at.j")
        .agg(F.collect_list(F.struct("id", "component", "n", "at.other", "registers", "text")).alias("rows"))
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for band, group in zip(batch.column("band").to_pylist(), batch.column("rows")):
                rows = group.values
                held = np.frombuffer(b"".join(rows.field("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                ids, part, n, other = (np.array(rows.field(c).to_pylist(), np.int64) for c in ("id", "component", "n", "other"))
                homes, others = np.flatnonzero(other == 0), np.flatnonzero(other == 1)
                tried = []
                for o in others:
                    h = homes[((held[homes] == held[o]).sum(axis=1) >= (least - 0.1) * REGISTERS) & (part[homes] != part[o])]
                    h = h[np.minimum(n[h], n[o]) * 100 >= np.maximum(n[h], n[o]) * percent]
                    bands = (held[h].reshape(-1, BANDS, ROWS) == held[o].reshape(BANDS, ROWS)).all(axis=2)
                    h = h[bands.argmax(axis=1) == band]
                    tried.append(np.stack([h, np.full(len(h), o)]))
                h, o = np.concatenate([*tried, np.zeros((2, 0), np.int64)], axis=1)
                if not len(h):
                    continue
                near = similarity((held[h] > held[o]).sum(axis=1), (held[h] < held[o]).sum(axis=1), n[h].astype(float), n[o].astype(float)) >= least
                h, o = h[near], o[near]
                used = np.unique(np.concatenate([h, o])).tolist()
                sets = dict(zip(used, sets_of([rows.field("text")[x].as_py() for x in used], k)))
                for x in np.unique(o).tolist():
                    own, near = sets[x], h[o == x]
                    every = np.concatenate([sets[y] for y in near.tolist()])
                    found = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
                    both = np.add.reduceat(found, np.concatenate([[0], np.cumsum(n[near])[:-1]]), dtype=np.int64)
                    near = near[100 * both >= percent * (n[near] + n[x] - both)]
                    us += np.minimum(ids[near], ids[x]).tolist()
                    vs += np.maximum(ids[near], ids[x]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return groups.mapInArrow(meet, "u long, v long").distinct()


def _named(classes: DataFrame) -> DataFrame:
    """Adds id, a number of each class of its own: its smallest document, but for further classes of that document a
    number above all ids (below 2^62)."""
    shared = saved(classes.groupBy("doc").agg(F.count("*").alias("classes"), F.min(F.struct("a", "b")).alias("own")).where("classes > 1"))
    named = F.expr("CASE WHEN own IS NULL OR own = struct(a, b) THEN doc ELSE 4611686018427387904L + (a & 4611686018427387903L) END")
    return saved(classes.join(shared, "doc", "left").withColumn("id", named).drop("classes", "own"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links from a Jaccard similarity of percent / 100."""
    return grouped(docs, k, percent).select("doc_id", "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The same, with body (hash of the text) and component (a number of the row's own component, also where two components
    have the same smallest id; null for rows that are linked with nothing by definition)."""
    spark, threshold = docs.sparkSession, percent / 100
    rows = saved(sketches(docs, k))
    classes = saved(
        rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("a", "b")
        .agg(F.min(F.struct("doc_id", "body")).alias("first"), F.max("n").alias("n"), F.min("registers").alias("registers"))
        .select("a", "b", F.col("first.doc_id").alias("doc"), F.col("first.body").alias("body"), "n", "registers"))
    classes = _named(classes)
    bands = classes.select("id", "n", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * 2 * ROWS + 1, F.lit(2 * ROWS))))).alias("band", "key"))
    buckets = bands.groupBy("key", "band").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(bands.join(buckets, ["key", "band"]))
    meets = members.groupBy("id").agg(F.sum("size").alias("meets"))
    centres = members.join(meets, "id").groupBy("key").agg(F.max(F.struct("meets", (-F.col("id")).alias("u"), "n")).alias("centre"))
    met = (
        members.join(centres, "key").select((-F.col("centre.u")).alias("u"), F.col("id").alias("v"), "centre.meets", F.col("centre.n").alias("n_u"), F.col("n").alias("n_v"))
        .where("u <> v").where(F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent)
        .groupBy("u", "v", "n_u", "n_v").agg(F.max("meets").alias("meets"))
    )
    held = [classes.select(F.col("id").alias(x), F.col("registers").alias(f"registers_{x}")) for x in "uv"]
    met = saved(_likely(met.join(held[1], "v").join(held[0], "u"), threshold))
    asked = members.select("id").distinct().join(classes.select("id", "doc", "body"), "id")
    bodies = saved(
        _bodies(docs).withColumnRenamed("doc_id", "doc").join(asked, ["doc", "body"]).groupBy("id").agg(F.min("text").alias("text")))
    # First each member and its chief centre, then centres of other components, then members of other components.
    chief = met.groupBy("v").agg(F.max_by("u", F.struct("meets", -F.col("u"))).alias("u")).select("u", "v")
    links = saved(_confirmed(chief, bodies, k, percent))
    labels = components(links)
    links = links.union(saved(_confirmed(_apart(met.select("u", "v"), labels), bodies, k, percent)))
    released(spark)
    links = links.union(saved(_cross_links(members, components(links), classes, bodies, k, percent)))
    found = classes.join(components(links), "id", "left").select("a", "b", "id", "doc", F.coalesce("component", "id").alias("component"))
    # Classes named otherwise than by their document: it may be the smallest that is reachable.
    others = saved(found.where("id <> doc").groupBy("component").agg(F.min("doc").alias("smallest")))
    found = found.join(others, "component", "left").select("a", "b", "component", F.least("component", "smallest").alias("component_id"))
    return (
        rows.select("doc_id", "body", "n", F.when(F.expr("n > 0 AND doc_id IS NOT NULL"), F.col("a")).alias("a"), "b").join(found, ["a", "b"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "body", "component")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
