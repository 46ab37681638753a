"""The tables of the daily runs: Parquet below one root, replaced by committed versions.

Each run owns one folder per table (``load_date=`` or ``run_date=``). What a write replaces stays readable until the
new rows are complete: a write goes to a hidden folder, and only a rename makes that the next version (``v=``). Readers
take the highest version of each folder. A job that is lost midway leaves the former version, and a hidden folder that
the next write removes. The version before the current one is kept for those who still read it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

DATE = "transaction_date"
VERSION, STAGED = "v", "_staged-"


class Tables:
    """The tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # -- folders and versions ------------------------------------------------------
    def path(self, name: str, key: str = "", value: dt.date | None = None) -> str:
        return f"{self.root}/{name}" + (f"/{key}={value.isoformat()}" if value else "")

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, pattern: str) -> list[str]:
        """Folders that match, without their scheme's root."""
        p, fs = self._hadoop(pattern)
        return [s.getPath().toString() for s in fs.globStatus(p) or [] if s.isDirectory()]

    def versions(self, name: str, key: str = "", value: dt.date | None = None) -> dict[str, str]:
        """The folder of the current version by the folder it belongs to: one entry per run."""
        path = self.path(name, key, value)
        newest: dict[str, tuple[int, str]] = {}
        for pattern in ([f"{path}/{VERSION}=*"] if value else [f"{path}/{VERSION}=*", f"{path}/*=*/{VERSION}=*"]):
            for folder in self._listed(pattern):
                owner, _, number = folder.rpartition(f"/{VERSION}=")
                newest[owner] = max(newest.get(owner, (-1, "")), (int(number), folder))
        return {owner: folder for owner, (_, folder) in newest.items()}

    def days(self, name: str, key: str) -> list[dt.date]:
        """The dates that a table has folders for, in order."""
        return sorted(dt.date.fromisoformat(owner.rpartition("=")[2]) for owner in self.versions(name) if f"/{key}=" in owner)

    def values(self, name: str, key: str, value: dt.date, column: str) -> list[dt.date]:
        """The dates for which a run's folder has folders of ``column``, in order."""
        current = self.versions(name, key, value).values()
        return sorted(dt.date.fromisoformat(f.rpartition("=")[2]) for v in current for f in self._listed(f"{v}/{column}=[0-9]*"))

    def drop(self, name: str, key: str, value: dt.date) -> None:
        p, fs = self._hadoop(self.path(name, key, value))
        fs.delete(p, True)

    # -- reading ---------------------------------------------------------------------
    def read(self, name: str, key: str = "", value: dt.date | None = None, schema: T.StructType | None = None) -> DataFrame:
        """A table, or one run's folder of it. It may hold no files at all, which only the ``schema`` makes readable."""
        folders = sorted(self.versions(name, key, value).values())
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        if not folders:
            return reader.parquet(self.path(name, key, value))
        found = reader.option("basePath", folders[0] if value else self.path(name)).parquet(*folders)
        return found.drop(VERSION)

    def read_or_none(self, name: str, key: str = "", value: dt.date | None = None) -> DataFrame | None:
        """The table, or None where it does not exist or holds no files."""
        try:
            return self.read(name, key, value)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        found = self.read_or_none(name)
        return self.spark.createDataFrame([], schema) if found is None else found

    # -- writing ---------------------------------------------------------------------
    def write(self, df: DataFrame, name: str, key: str = "", value: dt.date | None = None, by: tuple[str, ...] = ()) -> DataFrame:
        """Replace a table, or one run's folder of it, and read it back; ``by`` are the columns that make folders.

        ``df`` may read what it replaces.
        """
        path = self.path(name, key, value)
        staged = f"{path}/{STAGED}{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*by) if by else df.write
        writer.parquet(staged)
        self._commit(path, staged)
        return self.read(name, key, value, df.schema if by else None)

    def _commit(self, path: str, staged: str) -> None:
        numbers = sorted(int(f.rpartition("=")[2]) for f in self._listed(f"{path}/{VERSION}=*"))
        (source, fs), (target, _) = self._hadoop(staged), self._hadoop(f"{path}/{VERSION}={numbers[-1] + 1 if numbers else 0}")
        if not fs.rename(source, target):
            raise OSError(f"{staged} could not become {target}")
        for number in numbers[:-1]:
            fs.delete(self._hadoop(f"{path}/{VERSION}={number}")[0], True)
        for lost in self._listed(f"{path}/{STAGED}*"):
            fs.delete(self._hadoop(lost)[0], True)

    def compact(self, name: str, key: str, value: dt.date, order: tuple[str, ...], target_bytes: int = 128 << 20) -> bool:
        """Rewrite a run's folder into files of about ``target_bytes``, sorted, where it has more files than that takes: at
        most one more for each date. The former files stay readable until the new ones are committed. Was there anything to do?
        """
        size = files = 0
        for folder in self.versions(name, key, value).values():
            p, fs = self._hadoop(folder)
            summary = fs.getContentSummary(p)
            size, files = size + summary.getLength(), files + sum(1 for _ in self._files(p, fs))
        wanted = max(1, -(-size // target_bytes))
        dates = self.values(name, key, value, DATE)
        if files <= wanted + len(dates):
            return False
        rows = self.read(name, key, value)
        sorted_rows = rows.repartitionByRange(wanted, *order).sortWithinPartitions(*order)
        self.write(sorted_rows, name, key, value, by=(DATE,) if dates else ())
        return True

    @staticmethod
    def _files(path, fs):
        found = fs.listFiles(path, True)
        while found.hasNext():
            name = found.next().getPath().getName()
            if name.startswith("part-"):
                yield name

    def write_dated(self, df: DataFrame, name: str, key: str, value: dt.date) -> DataFrame:
        """One run's folder, split by transaction date: few files for each date, several for a large one."""
        dated = _with_date(df)
        order = [c for c in (DATE, "ingest_seq") if c in dated.columns]
        return self.write(dated.repartitionByRange(*order), name, key, value, by=(DATE,))

    def write_clustered(self, df: DataFrame, name: str, key: str, value: dt.date) -> DataFrame:
        """The same, clustered by customer in time order. The ranges are sampled and
        end in the unique sequence, so a large date or customer spans several files."""
        order = (DATE, "customer_id", "transaction_ts", "ingest_seq")
        clustered = _with_date(df).repartitionByRange(*order).sortWithinPartitions(*order)
        return self.write(clustered, name, key, value, by=(DATE,))


def _with_date(df: DataFrame) -> DataFrame:
    return df if DATE in df.columns else df.selectExpr("*", f"to_date(transaction_ts) AS {DATE}")
