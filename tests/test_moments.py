"""Exact totals, and z-scores at and next to their limit, in every plan."""

from __future__ import annotations

import random
from decimal import Decimal
from fractions import Fraction

import pytest

from helpers import row, table
from tallywatch.config import HotKeyPolicy, RuleLimits
from tallywatch.functions import moments
from tallywatch.operators.rules import BASELINE, unusual_amount
from tallywatch.plans import scoring, state
from tallywatch.plans.history import split_for

NANO = 10 ** 9


def exactly(before, x, limit):
    """Is x over limit sample deviations above the mean? All in fractions."""
    n, total, squares = len(before), sum(before), sum(b * b for b in before)
    spread, over = n * squares - total * total, n * x - total
    return n >= 2 and over > 0 and spread > 0 and over * over * (n - 1) > Fraction(str(limit)) ** 2 * n * spread


def amounts_of(draw):
    kind = draw.choice(["cents", "equal", "large", "tiny", "mixed", "signed", "next"])
    n = draw.randrange(6, 14)
    if kind == "cents":
        return [draw.randrange(1, 9000) * 10 ** 7 for _ in range(n)]
    if kind == "equal":
        return [draw.choice([10 ** 8 + 1, 10 ** 37 + 1])] * n + [10 ** 37 + 2]
    if kind == "large":
        return [draw.randrange(10 ** 36, 10 ** 38) for _ in range(n)]
    if kind == "tiny":
        return [10 ** 17 + draw.randrange(3) for _ in range(n)]
    if kind == "mixed":
        return [draw.randrange(1, 10 ** draw.randrange(1, 38)) for _ in range(n)]
    if kind == "signed":
        return [draw.choice([-1, 1]) * draw.randrange(1, 10 ** draw.randrange(1, 38)) for _ in range(n)]
    # 0, 0, 0, 4 and a last amount at three deviations from their mean, off by a unit or not, at any level.
    level, unit = draw.choice([0, 10 ** 9, 10 ** 17, 10 ** 30]), draw.choice([1, 10 ** 7, 10 ** 9])
    return [level + unit * a for a in (0, 0, 0, 4)] + [level + unit * 7 + draw.choice([-1, 0, 1])]


def customers(seed, n):
    draw = random.Random(seed)
    return {f"C{c:03d}": amounts_of(draw) for c in range(n)}


def rows_of(histories):
    return [row(f"{c}-{i:02d}", f"2025-03-01T{i:02d}:00:00", customer_id=c, amount=f"{Decimal(f'{x}E-9'):f}", ingest_seq=k * 100 + i)
            for k, (c, xs) in enumerate(histories.items()) for i, x in enumerate(xs)]


@pytest.mark.parametrize("limit", [3, 1.7])
def test_every_plan_compares_exactly(spark, limit):
    histories = customers(11, 100)
    limits = RuleLimits(sigma_over=limit)
    rows = rows_of(histories)
    tx = table(spark, rows)
    split = split_for(tx, HotKeyPolicy(min_rows=2, max_blocks=10_000, samples_per_block=1))
    assert split is not None
    early = [r["transaction_id"][-2:] < "03" for r in rows]
    before = state.amounts(table(spark, [r for r, e in zip(rows, early) if e]))
    rest = table(spark, [r for r, e in zip(rows, early) if not e])

    def shown(df):
        # Exactly the same digits of the score and of the mean, however they were put together.
        shows = [unusual_amount(limits), moments.Z, moments.MEAN, moments.TOTAL, "n_prior"]
        return {r[0]: tuple(r)[1:] for r in df.selectExpr("transaction_id", *[f"{e} AS e{i}" for i, e in enumerate(shows)]).collect()}

    whole = shown(scoring.features(tx, {BASELINE}, limits))
    for c, xs in histories.items():
        for i, x in enumerate(xs):
            flagged, z, mean, total, n = whole[f"{c}-{i:02d}"]
            assert flagged == (i >= limits.min_history and exactly(xs[:i], x, limit)), (c, i)
            assert n == i and (total is None or Fraction(total) * NANO == sum(xs[:i]))
            assert (total is None) == (abs(sum(xs[:i])) >= 10 ** 38)
            if i and sum(xs[:i]):
                assert mean == pytest.approx(sum(xs[:i]) / i / NANO, rel=1e-12) or min(xs[:i]) < 0
            if flagged:
                assert z > limit * (1 - 1e-12)
    assert sum(v[0] for v in whole.values()) > 10
    if limit != 3:
        return
    assert shown(scoring.features(tx, {BASELINE}, limits, split)) == whole
    after = shown(scoring.features(rest, {BASELINE}, limits, state=before))
    assert after == {t: whole[t] for t in after}
    split = split_for(rest, HotKeyPolicy(min_rows=2, max_blocks=10_000, samples_per_block=1))
    assert shown(scoring.features(rest, {BASELINE}, limits, split, before)) == after


def test_a_billionth_above_three_deviations(spark):
    """z of 3, of about 3 + 1e-9 and 3 - 1e-9: only the one above is flagged."""
    histories = {f"{d:+d}": [10 ** 9 * a for a in (0, 0, 0, 4)] + [7 * 10 ** 9 + d * 2] for d in (-1, 0, 1)}
    scores = scoring.score(table(spark, rows_of(histories)))
    found = {r.transaction_id for r in scores.where("triggered_rules LIKE '%amount_anomaly%'").collect()}
    assert found == {"+1-04"}


def test_digits_of_squares(spark):
    draw = random.Random(2)
    values = [0, 1, -1, 10 ** 38 - 1, 1 - 10 ** 38, *(draw.randrange(-10 ** w, 10 ** w) for w in range(1, 39) for _ in range(3))]
    df = moments.measured(table(spark, [row(str(i), amount=f"{Decimal(f'{v}E-9'):f}") for i, v in enumerate(values)] + [row("none", amount=None)]))
    for r in df.collect():
        if r.transaction_id == "none":
            assert {r[c] for c in moments.X + moments.XX} == {None}
        else:
            v = values[int(r.transaction_id)]
            assert sum(r[c] * moments.BASE ** i for i, c in enumerate(moments.X)) == v
            assert sum(r[c] * moments.BASE ** i for i, c in enumerate(moments.XX)) == v * v
            assert all(abs(r[c]) <= 10 * moments.BASE for c in moments.X + moments.XX)
