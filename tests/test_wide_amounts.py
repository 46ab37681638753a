"""Flags that don't depend on the plan, and amounts as wide as their type."""

from __future__ import annotations

import pytest

from helpers import row, table
from tallywatch.config import HotKeyPolicy
from tallywatch.plans import scoring, state
from tallywatch.plans.history import split_for


def customers(amounts, n, base):
    return [row(f"T{c}-{i}", f"{10 + i}:00:00", customer_id=f"C{c}", amount=str(base + c * 7 + a), ingest_seq=c * 10 + i)
            for c in range(n) for i, a in enumerate(amounts)]


def flagged(scores):
    return sorted(r.transaction_id for r in scores.where("triggered_rules LIKE '%amount_anomaly%'").collect())


@pytest.mark.parametrize("base", [10, 123_456])
def test_z_of_exactly_three_is_no_anomaly_in_any_plan(spark, base):
    for last, expected in ((7, 0), (8, 60)):
        rows = customers([0, 0, 0, 4, last], 60, base)
        tx = table(spark, rows)
        split = split_for(tx, HotKeyPolicy(min_rows=2, max_blocks=1000, samples_per_block=1))
        assert split is not None
        before = state.amounts(table(spark, [r for r in rows if r["transaction_id"][-1] in "01"]))
        rest = table(spark, [r for r in rows if r["transaction_id"][-1] not in "01"])
        plans = [flagged(scoring.score(tx)), flagged(scoring.score(tx, split=split)), flagged(scoring.score(rest, state=before))]
        assert [len(p) for p in plans] == [expected] * 3


@pytest.mark.parametrize("amounts", [
    ["3E+19"] * 5, ["1", "2", "3", "2", "2E+17"], ["10", "10", "10", "10.000000001", "1E+12"], ["9E+28"] * 14 + ["5"],
])
def test_large_amounts_are_scored(spark, amounts):
    rows = [row(f"T{i}", f"{i + 5:02d}:30:00", customer_id="C", amount=f"{__import__('decimal').Decimal(a):f}", ingest_seq=i) for i, a in enumerate(amounts)]
    rows += [row("X", "10:00:00", customer_id="other", ingest_seq=999)]
    scores = {r.transaction_id: r for r in scoring.score(table(spark, rows)).collect()}
    assert len(scores) == len(rows)
    if len(amounts) == 5 and amounts[-1] != "3E+19":
        assert "std devs above C's rolling average of" in scores["T4"].reasons
    split = split_for(table(spark, rows), HotKeyPolicy(min_rows=2, max_blocks=1000, samples_per_block=1))
    again = {r.transaction_id: r.fraud_risk_score for r in scoring.score(table(spark, rows), split=split).collect()}
    assert again == {k: r.fraud_risk_score for k, r in scores.items()}
