"""Tables as sets of Parquet files named by a manifest: changes rewrite the files that hold touched keys and keep all others."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.operators import merge


class FileTable:
    """A table below a path: data/<batch>/part-*, and manifests/<version>, each a small table of the files that are live in it.

    A change writes new files first and becomes visible when its manifest is renamed into place, under a name that must be free: of two writers one fails, and one that
    dies leaves files that no manifest names. Readers take the newest manifest; older ones stay readable."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = spark.createDataFrame([], schema).schema

    def _fs(self, path: str):  # noqa: ANN202
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, at = self._fs(f"{self.path}/manifests")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()) if fs.exists(at) else []

    def files(self, version: int | None = None) -> list[str]:
        """Live files of a version, by their place below the table's path."""
        found = self.versions()
        if not found:
            return []
        return sorted(r["file"] for r in self.spark.read.schema("file string").parquet(f"{self.path}/manifests/{found[-1] if version is None else version}").collect())

    def read(self, version: int | None = None) -> DataFrame:
        live = self.files(version)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in live]) if live else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame) -> list[str]:
        """The rows of df as new files of a batch of its own."""
        batch = f"data/{uuid.uuid4().hex}"
        df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.path}/{batch}")
        fs, at = self._fs(f"{self.path}/{batch}")
        names = (s.getPath().getName() for s in fs.listStatus(at) if s.getLen())
        return [f"{batch}/{n}" for n in names if n.startswith("part-")]

    def _commit(self, files: list[str]) -> int:
        found = self.versions()
        version = found[-1] + 1 if found else 0
        staged = f"{self.path}/staged-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(f,) for f in sorted(files)], "file string").coalesce(1).write.parquet(staged)
        fs, at = self._fs(staged)
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{version}")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(at, target):
            fs.delete(at, True)
            raise RuntimeError(f"version {version} has been written by someone else")
        return version

    def append(self, df: DataFrame) -> int:
        """df as further files."""
        return self._commit(self.files() + self._write(df))

    def touched(self, keys: DataFrame, on: list[str]) -> list[str]:
        """Live files with a row of one of the keys. Only the key columns are read; Parquet statistics skip row groups where the keys are few enough for a filter to be pushed."""
        live = self.files()
        if not live:
            return []
        rows = self.read().select(*on, F.col("_metadata.file_path").alias("_file")).join(keys.select(*on).distinct(), on, "left_semi")
        names = {f.rpartition("/")[2]: f for f in live}
        return sorted(names[r["_file"].rpartition("/")[2]] for r in rows.select("_file").distinct().collect())

    def upsert(self, df: DataFrame, on: list[str]) -> tuple[int, list[str]]:
        """Rows of df in place of those with their keys, or added. Returns the version and the files that were replaced.

        Files with touched keys are read and written anew, their other rows with them; all others stay as they are, byte by byte. Of several rows of df with one key one is taken, the greatest; null keys
        are never equal, so such rows are added. Without rows nothing is written."""
        fresh = df.select(*self.schema.names)
        pick = Window.partitionBy(*on).orderBy(*[F.desc_nulls_last(c) for c in self.schema.names])
        nulls = " or ".join(f"`{c}` is null" for c in on)
        fresh = fresh.where(f"not ({nulls})").withColumn("_n", F.row_number().over(pick)).where("_n = 1").drop("_n").unionByName(fresh.where(nulls))
        old = self.touched(fresh, on)
        if not old and fresh.isEmpty():
            return (self.versions() or [-1])[-1], []
        held = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in old]) if old else self.spark.createDataFrame([], self.schema)
        new = self._write(held.join(fresh.select(*on), on, "left_anti").select(*self.schema.names).unionByName(fresh))
        return self._commit([f for f in self.files() if f not in set(old)] + new), old


def sessions_to_rescan(stored: DataFrame, calendar: DataFrame, names: DataFrame, until: str, canonical: str, n: int, date: str = "date", ticker: str = "ticker") -> DataFrame:
    """(date, canonical): the last n sessions of the calendar up to a date, and whether every name is there with a close of the canonical source.

    A session without rows is not canonical; without names all are."""
    days = calendar.select(date).distinct().where(F.col(date) <= F.lit(until).cast("date")).orderBy(F.desc(date)).limit(n)
    want = names.select(ticker).distinct().count()
    good = stored.join(days, date, "left_semi").join(names.select(ticker).distinct(), ticker, "left_semi").where((F.col("source") == canonical) & F.col("close").isNotNull())
    good = good.groupBy(date).agg(F.count_distinct(ticker).alias("_n"))
    return days.join(good, date, "left").select(date, (F.coalesce("_n", F.lit(0)) >= want).alias("canonical"))


def repaired(stored: DataFrame, fresh: DataFrame, rescan: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """The rows to write after a rescan: of sessions that are not canonical, fresh rows that are new or outrank the stored one or, of equal rank, have another close. Canonical sessions are skipped whole.

    A fresh row without a close changes nothing. ranks: authority of each source; others have 0."""
    open_ = rescan.where("not canonical").select("date")
    new = fresh.join(open_, "date", "left_semi").where("close is not null")
    old = stored.join(open_, "date", "left_semi").select("ticker", "date", F.col("close").alias("_close"), F.when(F.col("close").isNull(), -1).otherwise(merge.priority("source", ranks)).alias("_rank"))
    met = new.withColumn("_new", merge.priority("source", ranks)).join(old, ["ticker", "date"], "left")
    keep = F.col("_rank").isNull() | (F.col("_new") > F.col("_rank")) | ((F.col("_new") == F.col("_rank")) & ~F.col("close").eqNullSafe(F.col("_close")))
    return met.where(keep).select(*fresh.columns)
