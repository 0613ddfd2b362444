"""Feature snapshots: one Parquet table per group of columns, partitioned by month, read by date or by a range of dates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "yyyy-MM"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which the cluster shares; a temporary one only in a local session without that setting."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="barloom-")
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_groups(features: DataFrame, path: str, groups: dict[str, list[str]], once_per_date: tuple[str, ...] = ("macro",)) -> None:
    """Write each group's columns of features (ticker, date, ...) below path; a group of `once_per_date` has one row per date, that of the first ticker."""
    for group, columns in groups.items():
        if group in once_per_date:
            out = features.groupBy("date").agg(F.min_by(F.struct(*columns), "ticker").alias("m")).select("date", "m.*")
        else:
            out = features.select("ticker", "date", *columns)
        month = F.date_format("date", MONTH)
        # a month meets in as many tasks as its size asks for; the rebalance hint leaves that to adaptive execution
        out.withColumn("month", month).hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{path}/{group}")


def read_range(spark: SparkSession, path: str, group: str, first: str, last: str) -> DataFrame:
    """The group's rows from first to last, both included; months outside are not read, missing dates are no error."""
    months = F.col("month").between(first[:7], last[:7])
    return spark.read.parquet(f"{path}/{group}").where(months & F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).drop("month")


def read_date(spark: SparkSession, path: str, group: str, day: str) -> DataFrame:
    return read_range(spark, path, group, day, day)


def latest_date(spark: SparkSession, path: str, group: str) -> DataFrame:
    """One row with the newest date, found in the newest month alone."""
    t = spark.read.parquet(f"{path}/{group}")
    newest = t.agg(F.max("month")).first()[0]
    return t.where(F.col("month") == newest).agg(F.max("date").alias("date"))


def delta(table: DataFrame, after: str, until: str) -> DataFrame:
    """Rows of dates in (after, until]; that there are none at all is an error."""
    found = table.where((F.col("date") > F.lit(after).cast("date")) & (F.col("date") <= F.lit(until).cast("date")))
    if found.isEmpty():
        raise ValueError(f"no rows after {after} until {until}")
    return found
