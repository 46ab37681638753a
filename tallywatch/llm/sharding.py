"""Sharding by a two-pass external shuffle, in DataFrame operations only.

First pass: a seeded hash of each record's place in its table scatters the records uniformly into buckets that fit in
memory; the exchange on the bucket holds them. Second pass: each bucket is put in order of those places, shuffled by
Fisher and Yates (Spark's ``shuffle``) and written to the shared folder. All buckets one after the other are one random
order of the table, and it is cut into shards of consecutive records: the law is ``rows``, as shard sizes are at most
one record apart. A record's place, not its content, is hashed: copies of one record scatter like any others, so no
text or id can fill a bucket.

The number of buckets follows from the size of the whole table, so a bucket holds about ``BUCKET`` bytes at any scale,
and a record longer than that has a bucket's memory nearly to itself. Offsets of buckets are prefix sums in two levels:
of buckets within a group, and of groups. The written buckets are read for what follows, so a lost executor can't deal
records differently once buckets are written; before, ``docs`` has to be a table that is read in the same order again
(as files are), not the result of an exchange.

Null texts stay null, with size 1 and the crc of nothing. Ids may be null or repeat; each row is a record. Columns of
any name and type pass through in ``record``. An empty table has no rows in any shard; with fewer records than shards
the last shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import saved

#: Bytes that a bucket holds on average, and what a record counts besides its text.
BUCKET, RECORD = 16 << 20, 64
SHARDS, SEED = 8, 20_240_517
#: Buckets in a group of the prefix sums.
GROUP = 4096

SIZE = "octet_length(coalesce(text, '')) + 1L"


def _buckets(docs: DataFrame, bucket_bytes: int) -> int:
    total = docs.selectExpr(f"sum({SIZE} + {RECORD}) AS n").first().n or 0
    return max(1, -(-total // bucket_bytes))


def shuffled(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET) -> DataFrame:
    """The records of docs in a random order: bucket, place (in the bucket, from 0), record (a row of docs).

    The table is written bucket by bucket to the shared folder.
    """
    buckets = _buckets(docs, bucket_bytes)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record")
    dealt = docs.select(whole, F.monotonically_increasing_id().alias("at")).selectExpr(
        f"pmod(xxhash64({int(seed)}L, at), {buckets}L) AS bucket", "at", "record")
    in_memory = (
        dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "at")
        .groupBy("bucket").agg(F.collect_list("record").alias("records"))
    )
    # The generator of shuffle() runs on from bucket to bucket of a partition: their order is fixed too.
    in_order = in_memory.sortWithinPartitions("bucket").select("bucket", F.shuffle("records", seed).alias("records"))
    return saved(in_order.select("bucket", F.posexplode("records").alias("place", "record")))


def _offsets(counts: DataFrame) -> DataFrame:
    """bucket, n to bucket, before: records in earlier buckets."""
    grouped = counts.selectExpr("bucket", "n", f"bucket div {GROUP} AS part")
    within = grouped.selectExpr(
        "*", "sum(n) OVER (PARTITION BY part ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS inner")
    parts = grouped.groupBy("part").agg(F.sum("n").alias("n")).selectExpr(
        "part", "sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS outer")
    return within.join(parts, "part").selectExpr("bucket", "inner + outer AS before")


def shards(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET) -> DataFrame:
    """record (a row of docs), shard (from 0), slot (from 0 in the shard) of every row of docs."""
    rows = shuffled(docs, seed, bucket_bytes)
    counts = saved(rows.groupBy("bucket").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    size, larger = divmod(total, n_shards)
    edge = larger * (size + 1)  # the first shards hold one record more
    # Written first: the files' size tells Spark whether the offsets may be broadcast.
    placed = rows.join(saved(_offsets(counts)), "bucket").selectExpr("record", "before + place AS nth")
    shard = f"CASE WHEN nth < {edge}L THEN nth div {size + 1}L ELSE {larger}L + (nth - {edge}L) div {max(size, 1)}L END"
    slot = f"CASE WHEN nth < {edge}L THEN nth % {size + 1}L ELSE (nth - {edge}L) % {max(size, 1)}L END"
    return placed.selectExpr("record", f"CAST({shard} AS INT) AS shard", f"{slot} AS slot")


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET) -> None:
    """One folder ``shard=`` of Parquet files for each shard, records in order of ``slot`` in each file."""
    rows = shards(docs, n_shards, seed, bucket_bytes)
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return shards(docs).selectExpr(
        "CAST(record.doc_id AS BIGINT) AS doc_id", f"{SIZE.replace('text', 'record.text')} AS size",
        "crc32(CAST(coalesce(record.text, '') AS BINARY)) AS text_crc32", "'rows' AS law", "shard", "slot",
        "CAST(NULL AS INT) AS grown_shard")
