"""CSV files cut anywhere: the records are those that one task reads."""

from __future__ import annotations

import csv
import io
import random

import pytest

from tallywatch.schemas import FIELDS
from tallywatch.sources.csv_records import lines, records
from tallywatch.sources.files import csv_rows, read_csv


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that records cross them."""
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield cut
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def _field(draw):
    kind = draw.randrange(9)
    if kind == 0:
        return "".join(draw.choice('a"\n,\r ') for _ in range(draw.randrange(1, 30)))
    if kind == 1:
        return "\n" * draw.randrange(1, 4) + '"quoted"\nlines ' * draw.randrange(1, 40)
    if kind == 2:
        return ""
    return "".join(draw.choice("abcdefgh é") for _ in range(draw.randrange(1, 12))).strip()


def _text(draw, n, end):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end, quoting=draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    names = list(FIELDS)
    draw.shuffle(names)
    writer.writerow(names)
    rows = [{f: _field(draw) for f in names} for _ in range(n)]
    for i, r in enumerate(rows):
        r["transaction_id"] = f"T{i}"
        writer.writerow([r[f] for f in names])
    return out.getvalue(), rows


@pytest.mark.parametrize("seed, size, end", [(1, 300, "\n"), (2, 1500, "\r\n"), (3, 64, "\n")])
def test_splits_give_the_records_of_one_task(spark, tmp_path, small_splits, seed, size, end):
    draw = random.Random(seed)
    folder, want = tmp_path / "load", []
    folder.mkdir()
    for i in range(3):
        text, rows = _text(draw, (60, 1, 25)[i], end)
        (folder / f"{i}.csv").write_bytes(text.encode())
        want += [tuple(r[f] or None for f in FIELDS) for r in rows]
    (folder / "plain.csv").write_text("transaction_id,status\nP1,ok\nP2,ok\n")
    want += [tuple({"transaction_id": p, "status": "ok"}.get(f) for f in FIELDS) for p in ("P1", "P2")]
    small_splits(size)
    found = read_csv(spark, str(folder))
    assert lines(spark, str(folder)).rdd.getNumPartitions() > 4
    assert sorted((tuple(x or None for x in r) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_quotes_inside_plain_fields_open_nothing(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_text('transaction_id,merchant,status\nT1,5" disk,ok\nT2,"a\n""b""\nc",ok\nT3,6" disk,"x"\nT4,,"say ""hi""\n, all"\n')
    small_splits(12)
    found = {r.transaction_id: (r.merchant, r.status) for r in read_csv(spark, str(path)).collect()}
    assert found == {"T1": ('5" disk', "ok"), "T2": ('a\n"b"\nc', "ok"), "T3": ('6" disk', "x"), "T4": (None, 'say "hi"\n, all')}


def test_long_fields_and_many_quotes(spark, tmp_path, small_splits):
    """A field over many splits, with very many doubled quotes and line feeds."""
    long = ('""' * 20_000 + "\n") * 3 + "x" * 200_000
    (tmp_path / "t.csv").write_text(f'transaction_id,merchant\nT1,"{long}"\nT2,b\n')
    small_splits(10_000)
    found = {r.transaction_id: r.merchant for r in read_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert found == {"T1": long.replace('""', '"'), "T2": "b"}


def test_empty_files_and_unclosed_quotes(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    (tmp_path / "none" / "b.csv").write_text("\n\n")
    assert csv_rows(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "open.csv").write_text('transaction_id,merchant\nT1,a\nT2,"never closed\nT3,b\n')
    assert records(spark, str(tmp_path / "open.csv")).count() == 3


def test_headers_are_found_without_the_driver_opening_files(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i:02d}.csv").write_text(("merchant,transaction_id" if i % 2 else "﻿transaction_id,merchant") + f"\n{f'M,T{i}' if i % 2 else f'T{i},M'}\n", encoding="utf-8")
    found = {r.transaction_id: r.merchant for r in read_csv(spark, str(tmp_path)).collect()}
    assert found == {f"T{i}": "M" for i in range(30)}
