"""The market tables, derived from the supplied ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str, step: int) -> DataFrame:
    """A table dealt by a key over partitions of about `step` bytes of its files, so that what one task sorts stays the same as the table grows.

    Partitions chosen by the size of compressed shuffle blocks hold ever more of the rows that come of them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    size = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(path).getLength()
    least = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read(spark, sf_dir, name).repartition(max(least, -(-size // step)), key)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: one row per (ticker, date) from the day's trades, in order of their keys.

    Trades are dealt by ticker, so bars need no further shuffle or sort for windows over a ticker's dates."""
    t = dealt(spark, sf_dir, "lineitem", "l_suppkey", 4 << 20).select(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("amount"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return t.groupBy("ticker", "date").agg(F.min_by("price", F.struct("seq", "price")).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", F.struct("seq", "price")).alias("close"), F.sum("qty").alias("volume"), (F.sum("amount") / F.sum("qty")).alias("vwap"))


def _mean(x: str) -> Column:
    """The mean of prices. Their sum is exact, in decimals, so that it does not depend on the order in which partial sums meet: two passes over the same rows give equal values, to the last bit."""
    return F.sum(F.col(x).cast("decimal(28,10)")).cast("double") / F.count(x)


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market series: the mean order value of each date."""
    return read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(_mean("o_totalprice").alias("spy"))


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of one (user, day) by source, for merges and agreement gates: event types stand for sources."""
    e = read(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 500).alias("ticker"), F.to_date("ts").alias("date"), F.col("event_type").alias("source")).agg(F.max_by("value", "event_id").alias("close"), F.max("event_id").alias("run"))


#: Order priorities stand for macro series.
SERIES = {"1-URGENT": "VIX", "2-HIGH": "VIX3M", "3-MEDIUM": "TNX", "4-NOT SPECIFIED": "IRX", "5-LOW": "GLD"}


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro series (series_id, date, value): the mean order value of a priority on a date; not every series has every date."""
    name = F.coalesce(*[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in SERIES.items()])
    return read(spark, sf_dir, "orders").groupBy(name.alias("series_id"), F.to_date("o_orderdate").alias("date")).agg((_mean("o_totalprice") / 10000).alias("value"))
