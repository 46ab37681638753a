from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywatch.llm import sharding as s
from tallywatch.llm.common import ready
from tests.llm.helpers import DOC_SCHEMA, collected, empty_docs, odd_docs


def laid_out(rows, n_shards):
    """shard -> records in slot order, after checking that slots have no gaps and sizes are at most one apart."""
    out = {i: [] for i in range(n_shards)}
    for record, shard, slot in rows:
        out[shard].append((slot, record))
    sizes = [len(v) for v in out.values()]
    assert max(sizes) - min(sizes) <= 1
    for v in out.values():
        v.sort(key=lambda x: x[0])
        assert [slot for slot, _ in v] == list(range(len(v)))
    return {i: [r for _, r in v] for i, v in out.items()}


@pytest.mark.parametrize("n_shards", [3, 50])
def test_every_row_once_in_shards_of_equal_count(spark, n_shards):
    docs = odd_docs(ready(spark), [(9, "copy")] * 40)
    rows = collected(s.shards(docs, n_shards, bucket_bytes=2000))
    laid_out(rows, n_shards)
    assert Counter(tuple(r) for r, _, _ in rows) == Counter(tuple(r) for r in docs.collect())


def test_digests_equal_python(spark):
    docs = odd_docs(ready(spark))
    rows = collected(s.digests(docs))
    want = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs.collect())
    assert Counter(r[:3] for r in rows) == want
    assert {r[3] for r in rows} == {"rows"} and {r[6] for r in rows} == {None}
    laid_out([(r[0], r[4], r[5]) for r in rows], 8)


def test_repeats_itself_and_depends_on_the_seed(spark, tmp_path):
    docs = ready(spark).range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(3).coalesce(3)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    order = [[r[0].doc_id for r in sorted(collected(s.shards(docs, 4, seed, 4096)), key=lambda r: r[1:])] for seed in (1, 1, 2)]
    assert order[0] == order[1] != order[2]
    assert sorted(order[0]) == list(range(500))


def test_order_is_uniform(spark):
    """Every record is equally likely in every tenth of the order, whichever bucket holds it."""
    docs = ready(spark).range(1000).selectExpr("id AS doc_id", "'x' AS text")
    seen, runs = Counter(), 4
    for seed in range(runs):
        for record, _, slot in collected(s.shards(docs, 1, seed, 8000)):
            seen[record.doc_id // 100, slot // 100] += 1
    expected = runs * 10
    assert sum((seen[i, j] - expected) ** 2 / expected for i in range(10) for j in range(10)) < 160  # 81 degrees of freedom


def test_hot_text_spreads_over_buckets(spark):
    docs = ready(spark).createDataFrame([(7, "same text " * 20, None, None, 0, None, 0, 0, None)] * 600, DOC_SCHEMA)
    counts = [r["count"] for r in s.shuffled(docs, bucket_bytes=16_000).groupBy("bucket").count().collect()]
    assert len(counts) >= 9 and max(counts) < 2.5 * min(counts)


def test_offsets_over_groups_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(s, "GROUP", 3)
    counts = ready(spark).createDataFrame([(b, b + 1) for b in range(11) if b != 4], "bucket long, n long")
    found = dict(collected(s._offsets(counts)))
    at = 0
    for b in (b for b in range(11) if b != 4):
        assert found[b] == at
        at += b + 1


def test_written_shards(spark, tmp_path):
    docs = odd_docs(ready(spark))
    s.write_shards(docs, f"{tmp_path}/out", 3, bucket_bytes=2000)
    rows = spark.read.parquet(f"{tmp_path}/out").select("record", "shard", "slot")
    laid_out(collected(rows), 3)
    assert rows.count() == docs.count()


def test_empty(spark):
    assert collected(s.digests(empty_docs(ready(spark)))) == []


def test_no_python_workers(spark):
    plan = s.digests(odd_docs(ready(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert s.shuffled(odd_docs(spark)).select(F.max("place")).first()[0] is not None
