"""Heavy keys by a sketch, and ids that loads share."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from dataclasses import replace

import pytest

import synth
from helpers import NOW
from tallywatch import schemas
from tallywatch.config import HOT_IDS
from tallywatch.operators import known_ids
from tallywatch.operators.checks import DEFAULT_CHECKS
from tallywatch.operators.duplicates import mark
from tallywatch.operators.heavy import heavy_keys
from tallywatch.plans import daily
from tallywatch.sources.tables import Tables

DAY = dt.date(2025, 3, 1)
OPEN = daily.Settings(checks=tuple(replace(c, threshold_pct=100.0) for c in DEFAULT_CHECKS), id_index=known_ids.IdIndex(pages=8, folders=4))


@pytest.mark.parametrize("seed, at_most", [(1, 3), (2, 25), (3, 400)])
def test_heavy_keys_equal_counting(spark, seed, at_most):
    draw = random.Random(seed)
    keys = [draw.choice(["a", "b", f"c{draw.randrange(6)}", f"d{draw.randrange(60)}", f"e{draw.randrange(5000)}", None]) for _ in range(20_000)]
    draw.shuffle(keys)
    found = heavy_keys(spark.createDataFrame([(k, 1) for k in keys], "customer_id string, n long").repartition(7), "customer_id", at_most).collect()
    present = Counter(k for k in keys if k is not None)
    assert {(r.customer_id, r.n) for r in found} == {(k, n) for k, n in present.items() if n * at_most > sum(present.values())}


def test_heavy_keys_of_nothing(spark):
    assert heavy_keys(spark.createDataFrame([], "customer_id string"), "customer_id", 5).collect() == []
    with pytest.raises(ValueError):
        heavy_keys(spark.range(1), "id", 10**6)


def test_hot_ids_are_bounded(spark):
    """More repeated ids above the limit than may be broadcast: still every row is marked."""
    ids = spark.range(HOT_IDS + 500).selectExpr("concat('T', id) AS transaction_id", "id AS ingest_seq")
    copies = ids.selectExpr("transaction_id", "CAST(2 AS BIGINT) AS copies")
    marked = mark(ids, copies, "twice", hot_copies=1)
    assert marked.where("twice").count() == HOT_IDS + 500
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan


def _load(spark, n, seed, ids):
    rows = synth.transactions(spark.range(1, n + 1).selectExpr("id AS n"), NOW, seed).select(*schemas.FIELDS)
    return rows.selectExpr(*[f"{ids} AS {f}" if f == "transaction_id" else f for f in schemas.FIELDS])


@pytest.mark.parametrize("scope", [daily.LOAD_ONLY, daily.AFTER_EARLIER])
def test_ids_of_earlier_loads_are_repeated(spark, tmp_path, scope):
    tables, settings = Tables(spark, str(tmp_path)), replace(OPEN, scope=scope)
    number = "CAST(substring(transaction_id, 4) AS INT)"
    shared = f"CASE WHEN {number} % 10 = 0 THEN transaction_id WHEN {number} % 10 = 1 THEN NULL WHEN {number} % 10 = 2 THEN '' ELSE concat('B', transaction_id) END"
    first = daily.run_day(tables, _load(spark, 300, 1, "transaction_id"), DAY, NOW, settings)
    second = daily.run_day(tables, _load(spark, 300, 2, shared), DAY + dt.timedelta(days=1), NOW + dt.timedelta(days=1), settings)
    name = "uniqueness.duplicate_transaction_id"
    counts = [o.issues.where(f"check_name = '{name}'").first().affected_row_count for o in (first, second)]
    assert counts == [0, 30]
    held = {r.transaction_id for r in second.clean.collect()}
    assert not any(i and not i.startswith("B") for i in held)
    # The earlier load again: the later one doesn't count for it, and its ids are replaced.
    again = daily.run_day(tables, _load(spark, 300, 1, "concat('A', transaction_id)"), DAY, NOW, settings)
    assert again.issues.where(f"check_name = '{name}'").first().affected_row_count == 0
    third = daily.run_day(tables, _load(spark, 300, 2, shared), DAY + dt.timedelta(days=1), NOW + dt.timedelta(days=1), settings)
    assert third.issues.where(f"check_name = '{name}'").first().affected_row_count == 0


def test_filter_spares_lookups(spark, tmp_path):
    tables, index = Tables(spark, str(tmp_path)), known_ids.IdIndex(pages=4, folders=4)
    loads = [spark.range(a, a + 3000).selectExpr("concat('T', id) AS transaction_id", "id AS ingest_seq") for a in (0, 3000, 5990)]
    found = []
    for i, load in enumerate(loads):
        date = DAY + dt.timedelta(days=i)
        ids = known_ids.record(tables, load, date, index)
        found.append({r.transaction_id for r in known_ids.seen_before(tables, ids, date, index).collect()})
    assert found == [set(), set(), {f"T{i}" for i in range(5990, 6000)}]
    looked_up = tables.read(known_ids.CANDIDATES, known_ids.LOAD, DAY + dt.timedelta(days=2)).count()
    assert 10 <= looked_up < 150
