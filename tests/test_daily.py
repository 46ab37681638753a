"""Files in, tables out: the gated daily run and its synthetic input."""

from __future__ import annotations

import datetime as dt
import gzip
from dataclasses import replace

import pytest

import synth
from helpers import NOW
from tallywatch import schemas
from tallywatch.operators.checks import DEFAULT_CHECKS, with_thresholds
from tallywatch.plans import curated, daily, scoring
from tallywatch.sources.files import load_path, read_csv, read_parquet, rejected_csv, typed, write_csv
from tallywatch.sources.tables import Tables

DAY = dt.date(2025, 3, 1)
LOOSE = daily.Settings(checks=with_thresholds(DEFAULT_CHECKS, {c.name: 10.0 for c in DEFAULT_CHECKS}))
HEADER = "transaction_id,customer_id,amount,currency,merchant,country,transaction_ts,status\n"


def test_csv_values_that_do_not_parse_are_missing(spark, tmp_path):
    path = load_path(str(tmp_path), DAY)
    folder = tmp_path / "transactions" / DAY.isoformat()
    folder.mkdir(parents=True)
    (folder / "transactions.csv").write_text(
        HEADER
        + "TXN1,CUST1,12.50,USD,Amazon,US,2025-03-01T10:00:00,success\n"
        + "TXN2,,abc,USD,Amazon,US,bad,success\n"
        + "TXN3,CUST1,1e1,USD,Amazon,US,2025-03-01T02:00:00+05:30,failed\n")
    found = {r.transaction_id: r for r in typed(read_csv(spark, path), DAY, NOW, wall_clock=True).collect()}
    assert float(found["TXN1"].amount) == 12.5 and found["TXN1"].wall_clock_hour == 10
    assert found["TXN2"].amount is None and found["TXN2"].transaction_ts is None and not found["TXN2"].customer_id
    assert float(found["TXN3"].amount) == 10.0 and found["TXN3"].wall_clock_hour == 2
    assert len({r.ingest_seq for r in found.values()}) == 3
    hour = typed(read_csv(spark, path), DAY, NOW).selectExpr("transaction_id", "hour(transaction_ts) AS h").collect()
    assert {r.transaction_id: r.h for r in hour}["TXN3"] == 20


def test_csv_is_read_by_header_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "status,extra,customer_id,transaction_id,merchant\n"
        'success,x,CUST1,TXN1,"Joe ""The"" Shop"\n'
        'success,x,CUST1,TXN2,"a ""x"", b"\n'
        'success,x,CUST1,TXN3,"two\nlines"\n'
        "success,x,CUST1\n"
        "success,x,CUST1,TXN5,Shop,ninth\n")
    path = str(tmp_path / "t.csv")
    found = {r.transaction_id: r for r in read_csv(spark, path).collect()}
    assert [found[f"TXN{i}"].merchant for i in (1, 2, 3)] == ['Joe "The" Shop', 'a "x", b', "two\nlines"]
    assert len(found) == 3 and found["TXN1"].amount is None and list(found["TXN1"].asDict()) == list(schemas.FIELDS)
    assert sorted(r.line for r in rejected_csv(spark, path).collect()) == ["success,x,CUST1", "success,x,CUST1,TXN5,Shop,ninth"]


def test_csv_files_of_one_folder_have_their_own_headers(spark, tmp_path):
    folder = tmp_path / "a load"
    folder.mkdir()
    (folder / "a.csv").write_text("transaction_id,customer_id,merchant\nTXN1,CUST1,Shop\n")
    (folder / "b.csv").write_text("merchant,transaction_id,status,customer_id\nMall,TXN2,failed,CUST2\n")
    (folder / "c.csv").write_text("\ntransaction_id,customer_id,merchant\nTXN3,CUST3,Fair\n")
    (folder / "d.csv").write_text("")
    with gzip.open(folder / "e.csv.gz", "wt") as f:
        f.write('"further\ncolumn",merchant,transaction_id\nx,Kiosk,TXN4\n')
    found = sorted((r.transaction_id, r.customer_id, r.merchant, r.status) for r in read_csv(spark, str(folder)).collect())
    assert found == [("TXN1", "CUST1", "Shop", None), ("TXN2", "CUST2", "Mall", "failed"), ("TXN3", "CUST3", "Fair", None), ("TXN4", None, "Kiosk", None)]


def test_broken_lines_are_checked_and_kept(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        HEADER
        + "TXN1,CUST1,12.50,USD,Amazon,US,2025-03-01T10:00:00,success\n"
        + "TXN2,CUST1,12.50\n"
        + "TXN3,CUST1,12.50,USD,Amazon,US,2025-03-01T10:00:00,success,ninth\n")
    found = {r.transaction_id: r for r in read_csv(spark, str(path), keep_broken=True).collect()}
    assert sorted(found) == ["TXN1", "TXN2", "TXN3"]
    assert found["TXN2"].amount == "12.50" and found["TXN2"].currency is None and found["TXN3"].status == "success"
    tables = Tables(spark, str(tmp_path / "t"))
    outcome = daily.run_csv(tables, str(path), DAY, NOW, LOOSE)
    assert {r.total_row_count for r in outcome.issues.collect()} == {3}
    assert [r.line for r in tables.read("rejected_lines", daily.LOAD, DAY).where("transaction_id = 'TXN2'").collect()] == ["TXN2,CUST1,12.50"]


def test_csv_round_trip(spark, tmp_path):
    rows = [("TXN1", 'He said "hi", twice'), ("TXN2", "two\nlines"), ("TXN3", "plain, with comma")]
    df = spark.createDataFrame(rows, "transaction_id string, merchant string")
    write_csv(df, str(tmp_path / "out"))
    assert sorted((r.transaction_id, r.merchant) for r in read_csv(spark, str(tmp_path / "out")).collect()) == rows


def test_large_partitions_get_numbers(spark):
    fields = ", ".join(f"CAST(id AS STRING) AS {f}" if f == "transaction_id" else f"'' AS {f}" for f in schemas.FIELDS)
    rows = spark.range(0, 17_500_000, 1, 1).selectExpr(*fields.split(", "))
    found = typed(rows, DAY, NOW).selectExpr("min(ingest_seq) AS lo", "max(ingest_seq) AS hi").first()
    assert found.hi - found.lo == 17_499_999
    later = typed(rows.limit(1), DAY + dt.timedelta(days=1), NOW).first().ingest_seq
    assert later > found.hi


def test_failed_rerun_leaves_no_scores(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    whole, bad = _synthetic(spark, 300)
    assert daily.run_day(tables, whole.select(*schemas.FIELDS), DAY, NOW).passed
    assert tables.read("fraud_bucket_distribution").selectExpr("sum(n) AS n").first().n == 300
    assert not daily.run_day(tables, bad.select(*schemas.FIELDS), DAY, NOW).passed
    assert tables.read_or_empty("fraud_scores", schemas.FRAUD_SCORES).count() == 0 and tables.read("fraud_bucket_distribution").count() == 0


def test_rescored_days_count_once(spark, tmp_path):
    tables, settings = Tables(spark, str(tmp_path)), replace(LOOSE, scope=daily.AFTER_EARLIER)
    whole, later = _synthetic(spark, 40)[0].select(*schemas.FIELDS), _synthetic(spark, 40, 7)[0].select(*schemas.FIELDS)
    later = later.selectExpr(*[f"concat('L', {f}) AS {f}" if f == "transaction_id" else f for f in schemas.FIELDS])
    next_day = DAY + dt.timedelta(days=1)
    daily.run_day(tables, whole, DAY, NOW, settings)
    daily.run_day(tables, later, next_day, NOW + dt.timedelta(days=1), settings)
    assert tables.read("fraud_bucket_distribution").selectExpr("sum(n) AS n").first().n == 80
    kpis = tables.read("published_kpis").first()
    assert (kpis.transactions_scored, kpis.critical_total) == (80, curated.latest(tables.read("dq_issues")).where("severity = 'critical'").count())
    # An old date again: later loads stay out of its folder.
    daily.run_day(tables, whole, DAY, NOW, settings)
    old = tables.read("fraud_scores", "run_date", DAY)
    assert old.where("transaction_id LIKE 'L%'").isEmpty()


def _synthetic(spark, n, seed=42):
    whole = synth.transactions(spark.range(1, n + 1).selectExpr("id AS n"), NOW, seed)
    return whole, synth.with_defects(whole, NOW, seed)


def test_synthetic_rows_are_repeatable_and_defective(spark):
    whole, bad = _synthetic(spark, 5000)
    assert whole.count() == 5000 and bad.count() == 5015
    share = bad.selectExpr("avg(int(customer_id IS NULL)) AS c", "avg(int(amount < 0)) AS a", "avg(int(currency = 'XYZ')) AS x",
                           "avg(int(status = 'failed')) AS f", "count(DISTINCT transaction_id) AS ids",
                           "count(DISTINCT country) AS countries", "min(abs(amount)) AS lo", "max(abs(amount)) AS hi").first()
    assert 0.005 < share.c < 0.016 and 0.002 < share.a < 0.009 and 0.003 < share.x < 0.01 and 0.04 < share.f < 0.06
    assert share.ids == 5000 and share.countries == 8
    assert 7.3 < share.lo and share.hi < 404
    assert bad.exceptAll(_synthetic(spark, 5000)[1]).count() == 0
    assert whole.exceptAll(_synthetic(spark, 5000, seed=1)[0]).count() > 4000


def test_daily_runs(spark, tmp_path):
    """A passing day, a failing day, and the passing day again."""
    tables = Tables(spark, str(tmp_path))
    _, bad = _synthetic(spark, 2000)
    first = daily.run_day(tables, bad.select(*schemas.FIELDS), DAY, NOW, LOOSE)
    assert first.passed and first.next_step == "run_fraud_scoring"
    assert first.scores.schema.fieldNames() == schemas.FRAUD_SCORES.fieldNames()
    assert first.issues.schema.fieldNames() == schemas.DQ_ISSUES.fieldNames()
    assert first.scores.count() == first.clean.count()

    raw = tables.read("transactions_raw", daily.LOAD, DAY)
    kept, held = first.clean, tables.read("transactions_quarantined", daily.RUN, DAY)
    untouched = raw.join(kept, "ingest_seq", "left_anti").join(held, "ingest_seq", "left_anti")
    assert raw.count() == 2015 and untouched.count() == 0

    next_day, later = DAY + dt.timedelta(days=1), NOW + dt.timedelta(days=1)
    second = daily.run_day(tables, bad.select(*schemas.FIELDS), next_day, later)
    assert not second.passed and second.next_step == "dq_fail_alert" and second.scores is None
    breached = {r.check_name for r in tables.read("dq_alerts", daily.RUN, next_day).collect()}
    assert breached == {r.check_name for r in second.issues.where("severity = 'critical' AND NOT passed").collect()}
    assert breached and tables.read("dq_alerts", daily.RUN, DAY).count() == 0

    trend = {str(r.run_date): r.pass_rate for r in tables.read("dq_health_trend").collect()}
    assert trend["2025-03-02"] == 1.0 and trend["2025-03-03"] < 1.0
    buckets = tables.read("fraud_bucket_distribution")
    assert {str(r.run_date) for r in buckets.collect()} == {"2025-03-02"}
    total = buckets.groupBy().sum("n").first()[0]

    daily.run_day(tables, bad.select(*schemas.FIELDS), DAY, NOW, LOOSE)
    assert tables.read("dq_issues").count() == 14
    assert tables.read("fraud_bucket_distribution").groupBy().sum("n").first()[0] == total

    newest = curated.latest(tables.read("dq_issues"))
    assert newest.count() == 7 and newest.where("passed").count() < 7


def test_all_loads_are_checked_together(spark, tmp_path):
    """The same ids in two loads are no repeats within a load, but are across loads."""
    tables, settings = Tables(spark, str(tmp_path)), replace(LOOSE, scope=daily.ALL_LOADS)
    whole = _synthetic(spark, 50)[0].select(*schemas.FIELDS)
    first = daily.run_day(tables, whole, DAY, NOW, settings)
    second = daily.run_day(tables, whole, DAY + dt.timedelta(days=1), NOW + dt.timedelta(days=1), settings)
    name = "uniqueness.duplicate_transaction_id"
    found = [o.issues.where(f"check_name = '{name}'").first() for o in (first, second)]
    assert [(r.affected_row_count, r.total_row_count) for r in found] == [(0, 50), (100, 100)]
    assert first.passed and not second.passed and second.clean.count() == 0


def test_failing_first_day_leaves_empty_distribution(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    _, bad = _synthetic(spark, 500)
    assert not daily.run_day(tables, bad.select(*schemas.FIELDS), DAY, NOW).passed
    assert tables.read("fraud_bucket_distribution").count() == 0
    assert tables.read("dq_health_trend").count() == 1


def test_curated_views(spark):
    scores = spark.createDataFrame([("a", "Low", 0, 1), ("b", "Low", 24, 2)],
                                   "transaction_id string, risk_bucket string, fraud_risk_score long, ingest_seq long")
    assert [tuple(r) for r in curated.bucket_distribution_filled(scores).collect()] == [("Low", 2), ("Medium", 0), ("High", 0)]
    no_checks = spark.createDataFrame([], schemas.DQ_ISSUES)
    found = curated.kpis(no_checks, scores).first()
    assert (found.overall_status, found.transactions_scored, found.high_risk, found.critical_total) == ("PASS", 2, 0, 0)


def test_csv_sink_replaces(spark, tmp_path):
    path = str(tmp_path / "scores")
    df = spark.createDataFrame([("a", 1)], "transaction_id string, fraud_risk_score long")
    write_csv(df, path)
    write_csv(df.where("false"), path)
    assert spark.read.option("header", True).csv(path).count() == 0
    parquet = str(tmp_path / "p")
    _synthetic(spark, 10)[0].write.parquet(parquet)
    assert read_parquet(spark, parquet).columns == list(schemas.FIELDS)


def _recounted(tables):
    """The curated tables made anew from all that is stored."""
    scores = curated.current(tables.read("fraud_scores").withColumnRenamed("run_date", "run"))
    buckets = curated.bucket_distribution(scores, "to_date(run_ts)")
    issues = tables.read("dq_issues")
    return ({tuple(r) for r in buckets.collect()}, {tuple(r) for r in curated.health_trend(issues, "to_date(run_ts)").collect()},
            tuple(curated.kpis(curated.latest(issues), scores).first()))


def _stored(tables):
    return ({tuple(r) for r in tables.read("fraud_bucket_distribution").collect()}, {tuple(r) for r in tables.read("dq_health_trend").collect()},
            tuple(tables.read("published_kpis").first()))


def test_curated_tables_are_kept_up_to_date(spark, tmp_path):
    """Rows without an id, with an empty one, and ids that loads share: each row counts once, as recomputing counts it."""
    tables, settings = Tables(spark, str(tmp_path)), replace(LOOSE, scope=daily.AFTER_EARLIER)

    def load(day, n, seed, lost):
        rows = _synthetic(spark, n, seed)[0].select(*schemas.FIELDS)
        ids = f"CASE WHEN pmod(hash(transaction_id), 5) = 0 THEN NULL WHEN pmod(hash(transaction_id), 5) = 1 THEN '' ELSE concat('{day}', transaction_id) END"
        return rows.selectExpr(*[f"{ids if lost else f} AS {f}" if f == "transaction_id" else f for f in schemas.FIELDS])

    checks = [replace(c, threshold_pct=100.0) for c in DEFAULT_CHECKS]
    settings = replace(settings, checks=tuple(checks))
    for day, n, seed, lost in ((0, 60, 1, True), (1, 50, 2, True), (2, 40, 3, False), (1, 45, 4, True), (2, 40, 3, False)):
        daily.run_day(tables, load(day, n, seed, lost), DAY + dt.timedelta(days=day), NOW + dt.timedelta(days=day, hours=seed), settings)
    stored = _stored(tables)
    assert stored == _recounted(tables)
    loads = [tables.read("transactions_clean", daily.RUN, DAY + dt.timedelta(days=d)).count() for d in range(3)]
    assert sum(r[2] for r in stored[0]) >= sum(loads) > 100
    without = curated.current(tables.read("fraud_scores")).where("transaction_id IS NULL OR transaction_id = ''").count()
    assert without > 30


def test_late_rows_cost_no_state_for_each_day(spark, tmp_path):
    """A row of 1970 comes late; states come from snapshots and added days, and scores equal scoring everything."""
    tables = Tables(spark, str(tmp_path))
    settings = replace(LOOSE, scope=daily.AFTER_EARLIER, snapshot_runs=2, checks=tuple(replace(c, threshold_pct=100.0) for c in DEFAULT_CHECKS))
    rows = _synthetic(spark, 240, 5)[0].select(*schemas.FIELDS)
    rows = rows.selectExpr(*[f"concat('CUST', pmod(hash(transaction_id), 4)) AS {f}" if f == "customer_id" else f for f in schemas.FIELDS]).cache()
    last = NOW + dt.timedelta(days=9)

    def load(day):
        some = rows.where(f"pmod(xxhash64(transaction_id), 5) = {day}")
        when = f"transaction_ts + INTERVAL {day} DAY"
        if day == 3:
            when = f"CASE WHEN pmod(hash(transaction_id), 7) = 0 THEN TIMESTAMP'1970-01-01 00:00:09' ELSE {when} END"
        return some.selectExpr(*[f"{when} AS {f}" if f == "transaction_ts" else f for f in schemas.FIELDS])

    for day in (0, 1, 2, 3, 4, 4):
        outcome = daily.run_day(tables, load(day), DAY + dt.timedelta(days=day), last, settings)
    shown = ("ingest_seq", "fraud_risk_score", "triggered_rules", "reasons")
    whole = tables.read("transactions_clean").drop("run_date")
    want = {r[0]: tuple(r) for r in scoring.score(whole).select(*shown).collect()}
    got = {r[0]: tuple(r) for r in outcome.scores.select(*shown).collect()}
    assert got and got == {k: want[k] for k in got}
    assert any("amount_anomaly" in r[2] for r in got.values()) or any(r[2] for r in got.values())
    snapshots = tables.days("customer_state", "run_date")
    assert 1 <= len(snapshots) <= 3
    assert _stored(tables)[0] == _recounted(tables)[0]


def test_a_lost_write_leaves_the_former_rows(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    first = spark.range(10)
    tables.write(first, "numbers")
    failing = spark.range(0, 100, 1, 8).selectExpr("CASE WHEN id = 99 THEN raise_error('lost') ELSE id END AS id").selectExpr("CAST(id AS BIGINT) AS id")
    with pytest.raises(Exception, match="lost"):
        tables.write(failing, "numbers")
    assert tables.read("numbers").count() == 10
    assert tables.write(tables.read("numbers").where("id < 5"), "numbers").count() == 5
    assert tables.write(tables.read("numbers").where("id < 2"), "numbers").count() == 2
    kept = sorted(p.name for p in (tmp_path / "numbers").iterdir() if p.is_dir())
    assert kept == ["v=1", "v=2"]


def test_a_run_leaves_csv(spark, tmp_path):
    """Issues, clean rows and scores as CSV; a failed run of the same date leaves no scores."""
    tables, settings = Tables(spark, str(tmp_path / "t")), replace(LOOSE, csv_folder=str(tmp_path / "csv"))
    whole, bad = _synthetic(spark, 80)
    first = daily.run_day(tables, whole.select(*schemas.FIELDS), DAY, NOW, settings)

    def read(name):
        return spark.read.option("header", True).csv(f"{tmp_path}/csv/{DAY.isoformat()}/{name}")

    assert read("dq_issues").count() == 7 and read("transactions_clean").count() == first.clean.count() == 80
    scores = read("fraud_scores")
    assert scores.columns == ["transaction_id", "customer_id", "amount", "fraud_risk_score", "risk_bucket", "triggered_rules", "reasons", "run_ts"]
    assert {r.transaction_id: int(r.fraud_risk_score) for r in scores.collect()} == {r.transaction_id: r.fraud_risk_score for r in first.scores.collect()}
    assert read_csv(spark, f"{tmp_path}/csv/{DAY.isoformat()}/transactions_clean").count() == 80
    daily.run_day(tables, bad.select(*schemas.FIELDS), DAY, NOW, replace(settings, checks=DEFAULT_CHECKS))
    assert read("fraud_scores").count() == 0
