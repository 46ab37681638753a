"""The seven checks, quarantine, gate and summary on hand-built tables."""

from __future__ import annotations

import pytest

from helpers import AT, row, table
from tallywatch.operators import quarantine, report
from tallywatch.operators.checks import CRITICAL, DEFAULT_CHECKS, WARNING, Check, by_name, with_thresholds

MISSING = "completeness.missing_customer_id"
REQUIRED = "completeness.missing_required_fields"
COPIES = "uniqueness.duplicate_transaction_id"
AMOUNT = "validity.negative_or_zero_amount"
CURRENCY = "validity.invalid_currency_code"
FUTURE = "consistency.future_dated_transaction"
COUNTRY = "consistency.currency_country_mismatch"


def issues(spark, rows, checks=DEFAULT_CHECKS):
    return {r.check_name: r for r in report.report(table(spark, rows), AT, checks).collect()}


CASES = {
    "missing_customer": (MISSING, [row("TXN1", customer_id=""), row("TXN2")], ["TXN1"]),
    "customer_clean": (MISSING, [row("TXN1"), row("TXN2")], []),
    "missing_amount": (REQUIRED, [row("TXN1", amount=None), row("TXN2")], ["TXN1"]),
    "missing_time": (REQUIRED, [row("TXN1", ts=None), row("TXN2")], ["TXN1"]),
    "empty_id": (REQUIRED, [row(""), row("TXN2")], [""]),
    "duplicate_ids": (COPIES, [row("TXN1"), row("TXN1"), row("TXN2")], ["TXN1", "TXN1"]),
    "unique_ids": (COPIES, [row("TXN1"), row("TXN2")], []),
    "null_ids_are_no_copies": (COPIES, [row(None), row(None), row(""), row("")], []),
    "non_positive": (AMOUNT, [row("TXN1", amount="-50.00"), row("TXN2", amount="0"), row("TXN3", amount="20.00"),
                              row("TXN4", amount=None)], ["TXN1", "TXN2"]),
    "bad_currency": (CURRENCY, [row("TXN1", currency="XYZ"), row("TXN2"), row("TXN3", currency="usd"),
                                row("TXN4", currency=""), row("TXN5", currency=None)], ["TXN1", "TXN3", "TXN4"]),
    "future": (FUTURE, [row("TXN1", ts="2099-01-01T00:00:00"), row("TXN2"), row("TXN3", ts="2025-03-02T00:00:00")], ["TXN1"]),
    "mismatch": (COUNTRY, [row("TXN1", currency="EUR"), row("TXN2"), row("TXN3", country="BR"), row("TXN4", currency=None),
                           row("TXN5", currency="usd"), row("TXN6", country=None, currency="EUR"),
                           row("TXN7", currency="")], ["TXN1", "TXN5", "TXN7"]),
}


@pytest.fixture(scope="module")
def all_cases(spark):
    """All cases in one table, ids set apart by case; the rows each check affects."""
    rows = [{**r, "transaction_id": r["transaction_id"] and f"{case}.{r['transaction_id']}"}
            for case, (_, part, _) in CASES.items() for r in part]
    raw = table(spark, rows).cache()
    found = {c.name: {r.ingest_seq for r in quarantine.affected(raw, c, AT).collect()} for c in DEFAULT_CHECKS}
    counts = {r.check_name: (r.affected_row_count, r.total_row_count) for r in report.report(raw, AT).collect()}
    return rows, found, counts


@pytest.mark.parametrize("case", CASES)
def test_affected_rows(all_cases, case):
    _, found, _ = all_cases
    name, part, expected = CASES[case]
    first = sum(len(CASES[c][1]) for c in list(CASES)[:list(CASES).index(case)])
    hit = [part[s - first]["transaction_id"] for s in sorted(found[name]) if first <= s < first + len(part)]
    assert hit == expected


def test_report_counts_the_affected_rows(all_cases):
    rows, found, counts = all_cases
    assert counts == {name: (len(seqs), len(rows)) for name, seqs in found.items()}


def test_report_layout_and_severities(spark):
    found = issues(spark, [row("TXN1"), row("TXN2")])
    assert set(found) == {MISSING, REQUIRED, COPIES, AMOUNT, CURRENCY, FUTURE, COUNTRY}
    assert {n for n, r in found.items() if r.severity == WARNING} == {CURRENCY, COUNTRY}
    assert [found[n].threshold_pct for n in (MISSING, REQUIRED, COPIES, AMOUNT, CURRENCY, FUTURE, COUNTRY)] == [
        2.0, 1.0, 0.1, 1.0, 0.5, 0.3, 1.0]
    assert all(r.passed and r.affected_pct == 0.0 for r in found.values())


def test_empty_batch_passes(spark):
    found = issues(spark, [])
    assert len(found) == 7 and all(r.passed and r.affected_pct == 0.0 and r.total_row_count == 0 for r in found.values())


def _counts(spark, total, *affected):
    columns = ", ".join(f"{a}L AS a{i}" for i, a in enumerate(affected))
    return spark.range(1).selectExpr(f"{total}L AS total", columns) if len(affected) == 1 else spark.sql(
        f"SELECT {total}L AS total, {columns}")


def test_golden_percentages(spark):
    """Known counts of a 5,015-row load."""
    order = (MISSING, REQUIRED, COUNTRY, FUTURE, COPIES, CURRENCY, AMOUNT)
    counts = _counts(spark, 5015, 47, 47, 71, 16, 30, 25, 32)
    found = report.results(counts, tuple(by_name(n) for n in order), []).collect()
    assert [r.affected_pct for r in found] == [0.937, 0.937, 1.416, 0.319, 0.598, 0.499, 0.638]
    assert [r.passed for r in found] == [True, True, False, False, False, True, True]


def test_threshold_compares_the_unrounded_share(spark):
    found = report.results(_counts(spark, 1_000_000, 1004), (by_name(COPIES),), []).first()
    assert found.affected_pct == 0.1 and not found.passed


def _gate(spark, *rows):
    data = [(f"c{i}", s, a, 100, float(a), 1.0, a <= 1) for i, (s, a) in enumerate(rows)]
    schema = "check_name string, severity string, affected_row_count long, total_row_count long, affected_pct double, " \
             "threshold_pct double, passed boolean"
    return report.gate(spark.createDataFrame(data, schema)).first()


def test_gate(spark):
    failed = _gate(spark, (CRITICAL, 50), (WARNING, 50))
    assert not failed.all_critical_passed and failed.next_step == "dq_fail_alert"
    passed = _gate(spark, (CRITICAL, 0), (WARNING, 50))
    assert passed.all_critical_passed and passed.next_step == "run_fraud_scoring"
    assert (passed.critical_passed, passed.critical_total) == (1, 1)
    assert not _gate(spark, (WARNING, 0)).all_critical_passed


MIXED = [
    row("TXN1"), row("TXN2", customer_id=None), row("TXN3", status=""), row("TXN4"), row("TXN4"), row(None),
    row(None), row("TXN5", currency="XYZ"), row("TXN6", amount="-1"), row("TXN7", ts="2099-01-01T00:00:00"),
    row("TXN8", amount=None), row("TXN9", ts=None), row("TXN2"),
]


@pytest.mark.parametrize("hot_copies", [1_000_000, 1])
def test_clean_keeps_trusted_rows(spark, hot_copies):
    """Ids above the hot limit take the broadcast branch; the rows are the same."""
    kept = quarantine.clean(table(spark, MIXED), AT, hot_copies).collect()
    assert sorted(r.transaction_id or "" for r in kept) == ["", "", "TXN1", "TXN3", "TXN5"]
    by_id = quarantine.clean_by_id(table(spark, MIXED), AT, hot_copies=hot_copies).collect()
    assert sorted(r.transaction_id or "" for r in by_id) == ["", "", "TXN1", "TXN5"]


def test_an_id_that_looks_like_a_row_key(spark):
    """Rows without an id join under 'row <sequence>', which may also be somebody's id."""
    raw = table(spark, [row(None), row("row 0"), row("row 0"), row("TXN1")])
    kept = quarantine.clean(raw, AT).collect()
    assert sorted(r.ingest_seq for r in kept) == [0, 3]


def test_quarantine_reasons_cover_every_unscored_row(spark):
    raw = table(spark, MIXED)
    reasons = {(r.transaction_id, r.ingest_seq): r.failed_checks for r in quarantine.quarantine(raw, AT).collect()}
    kept = {r.ingest_seq for r in quarantine.clean(raw, AT).collect()}
    assert {s for _, s in reasons} | kept == set(range(len(MIXED)))
    assert reasons["TXN2", 1] == f"{MISSING};{REQUIRED};{COPIES}"
    assert reasons["TXN2", 12] == COPIES
    assert reasons["TXN6", 8] == AMOUNT


def test_flagged_ids_and_summary(spark):
    raw = table(spark, MIXED)
    flagged = {(r.transaction_id, r.severity) for r in quarantine.flagged_ids(raw, AT).collect()}
    assert flagged == {(t, CRITICAL) for t in ("TXN2", "TXN3", "TXN4", "TXN6", "TXN7", "TXN8", "TXN9")} | {("TXN5", WARNING)}
    found = report.summary(raw, AT).first()
    assert found.asDict() == dict(total_rows=13, checks_run=7, dimensions_run=4, quarantined_ids=7, warning_only_ids=1,
                                  clean_rows=5)


def test_report_by_batch_counts_copies_within_the_date(spark):
    rows = [row("TXN1"), row("TXN1", ts="2025-02-28T10:00:00"), row("TXN2"), row("TXN2")]
    found = report.report_by_batch(table(spark, rows), AT).where(f"check_name = '{COPIES}'").collect()
    assert {str(r.batch_date): (r.affected_row_count, r.total_row_count) for r in found} == {
        "2025-03-01": (2, 3), "2025-02-28": (0, 1)}


def test_custom_check_and_thresholds(spark):
    big = Check("validity.big", WARNING, 10.0, "amount > 60")
    found = issues(spark, [row("TXN1", amount="70"), row("TXN2")], (*DEFAULT_CHECKS, big))
    assert found["validity.big"].affected_pct == 50.0 and not found["validity.big"].passed
    loose = with_thresholds((big,), {"validity.big": 60.0})
    assert issues(spark, [row("TXN1", amount="70"), row("TXN2")], loose)["validity.big"].passed
    with pytest.raises(KeyError):
        with_thresholds(DEFAULT_CHECKS, {"nope": 1.0})
