"""Records of CSV files whose quoted fields may hold line feeds, read by many tasks a file.

Files are read as lines, in splits. A line alone doesn't tell whether it starts inside a quoted field, but it tells what
follows in either case: what it does to the state (outside or inside quotes) is one of four functions, keep, flip, set
or clear. Those of all lines of a split make one function again, so a prefix over the few splits of a file gives the
state at the start of each, and a running pass over the split's lines the state of every line. A line outside quotes starts
a record; lines inside belong to the record before, also where that began in another split. Only records of several
lines are brought together. Where no line leaves a quote open, which a first look tells, lines are records as they are.

Quotes are doubled inside quoted fields; a quote inside an unquoted field is a plain character.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.columns import quoted

_INSIDE = '[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:"{_INSIDE}"[^,"]*+|[^,"][^,]*+)?,)*+'
#: Does a line end inside quotes, if it starts outside them, or inside?
OPENS = f'^{_FIELDS}"{_INSIDE}$'
STAYS = f'^{_INSIDE}(?:$|"[^,"]*+,{_FIELDS}"{_INSIDE}$)'

_UP_TO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block (start of the split), at (order in the split), line (without its line feed)."""
    return spark.read.option("lineSep", "\n").text(path).selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS at", "value AS line")


def _state(start: str, fixed: str, flips: str) -> str:
    """The state after some functions: flips count from the last one that set or cleared it, or else from the start."""
    return f"CASE WHEN {fixed} IS NULL THEN ({start} + {flips}) % 2 ELSE ({fixed}.state + {flips} - {fixed}.flips) % 2 END"


def _with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``starts``: does a record start with the line?, and ``closed``: does it end outside quotes?"""
    in_block = "PARTITION BY file, block ORDER BY at"
    known = rows.selectExpr("*", f"CAST(line RLIKE {quoted(OPENS)} AS INT) AS o", f"CAST(line RLIKE {quoted(STAYS)} AS INT) AS s").selectExpr(
        "file", "block", "at", "line", "o", "s", f"sum(CAST(o > s AS INT)) OVER ({in_block} {_UP_TO}) AS flips"
    ).selectExpr("*", f"last(CASE WHEN o = s THEN struct(o AS state, flips) END, true) OVER ({in_block} {_UP_TO}) AS fixed")
    # One row a split: the function of all its lines.
    whole = known.groupBy("file", "block").agg(F.max_by("flips", "at").alias("flips"), F.max_by("fixed", "at").alias("fixed"))
    by_file = "PARTITION BY file ORDER BY block"
    whole = whole.selectExpr(
        "file", "block", "CASE WHEN fixed IS NULL THEN flips % 2 ELSE 0 END AS flip",
        f"CASE WHEN fixed IS NOT NULL THEN {_state('0', 'fixed', 'flips')} END AS made",
    ).selectExpr("*", f"sum(flip) OVER ({by_file} {_UP_TO}) AS flips").selectExpr(
        "file", "block", f"lag(flips, 1, 0) OVER ({by_file}) AS flips",
        f"last(CASE WHEN made IS NOT NULL THEN struct(made AS state, flips) END, true) OVER ({by_file} {_BEFORE}) AS fixed",
    ).selectExpr("file", "block", f"{_state('0', 'fixed', 'flips')} AS entry")
    stated = known.join(whole, ["file", "block"]).selectExpr(
        "file", "block", "at", "line", "entry", f"{_state('entry', 'fixed', 'flips')} AS after")
    return stated.selectExpr(
        "file", "block", "at", "line", "after = 0 AS closed", f"lag(after, 1, entry) OVER ({in_block}) = 0 AS starts")


def _joined(stated: DataFrame) -> DataFrame:
    """Records of the lines: one line each, or several under the place of the first."""
    single = stated.where("starts AND closed").select("file", "block", "at", F.col("line").alias("record"))
    parts = stated.where("NOT (starts AND closed)").selectExpr(
        "*", "last(CASE WHEN starts THEN at END, true) OVER (PARTITION BY file, block ORDER BY at "
             f"{_UP_TO}) AS first")
    # Lines at the head of a split go to the last record that an earlier split opened.
    opened = parts.where("starts").groupBy("file", "block").agg(F.max("at").alias("last"))
    heads = parts.where("first IS NULL").select("file", "block").distinct()
    carried = heads.join(opened, ["file", "block"], "full").selectExpr(
        "file", "block", *[f"last({c}, true) OVER (PARTITION BY file ORDER BY block {_BEFORE}) AS {n}"
                           for c, n in (("CASE WHEN last IS NOT NULL THEN block END", "from_block"), ("last", "from_at"))])
    placed = parts.join(carried, ["file", "block"], "left").selectExpr(
        "file", "CASE WHEN first IS NULL THEN from_block ELSE block END AS r_block", "coalesce(first, from_at) AS r_at", "block", "at", "line")
    several = placed.groupBy("file", "r_block", "r_at").agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("lines"))
    return single.unionByName(several.selectExpr(
        "file", "r_block AS block", "r_at AS at", "array_join(transform(lines, x -> x.line), '\\n') AS record"))


def records(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """file, block, at, record: every record of the files, not empty, without the line end; ordered in a file by block and at."""
    found = lines(spark, path)
    open_files = found.where(f"line RLIKE {quoted(OPENS)}").select("file").distinct() if multi_line else None
    if open_files is None or open_files.isEmpty():
        found = found.withColumnRenamed("line", "record")
    else:
        plain = found.join(open_files, "file", "left_anti").withColumnRenamed("line", "record")
        found = plain.unionByName(_joined(_with_starts(found.join(open_files, "file", "left_semi"))))
    return found.selectExpr("file", "block", "at", r"regexp_replace(record, '\\r$', '') AS record").where("record <> ''")
