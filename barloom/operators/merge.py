"""Merges by source authority, incremental inserts, freshness and gap detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority(source: str, ranks: dict[str, int]) -> Column:
    """Authority of a source; unknown ones have none."""
    return F.coalesce(*[F.when(F.col(source) == s, F.lit(r)) for s, r in ranks.items()], F.lit(0))


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_by_authority(new: DataFrame, prior: DataFrame, ranks: dict[str, int], keys: tuple[str, ...] = ("ticker", "date"), value: str = "close", source: str = "source") -> DataFrame:
    """The better of new and prior per key, and how it came about (status).

    A null value has less authority than any source; ties go to the new row; a key that only one side has is kept. Both sides hold one row per key."""
    k = list(keys)
    both = new.withColumn("_new", F.lit(1)).unionByName(prior.withColumn("_new", F.lit(0)))
    both = both.withColumn("_p", F.when(F.col(value).isNull(), F.lit(-1)).otherwise(priority(source, ranks)))
    w = Window.partitionBy(*k)
    both = both.withColumns({"_sides": F.count(F.lit(1)).over(w), "_best_new": F.max(F.when(F.col("_new") == 1, F.col("_p"))).over(w), "_best_old": F.max(F.when(F.col("_new") == 0, F.col("_p"))).over(w)})
    out = keep_last(both, k, [F.desc("_p"), F.desc("_new")])
    status = F.when(F.col("_best_old").isNull(), "new").when(F.col("_best_new").isNull(), "retained").when(F.col("_best_new") < F.col("_best_old"), "downgrade_blocked").otherwise("overwritten")
    return out.withColumn("status", status).drop("_new", "_p", "_sides", "_best_new", "_best_old")


def upsert(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of base and delta, delta's where both have a key."""
    both = base.withColumn("_load", F.lit(0)).unionByName(delta.withColumn("_load", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, keys, [F.desc("_load")]).drop("_load")


def insert_absent(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """base and those rows of new whose key it does not have; of new rows with one key any one that is equal in all columns."""
    return base.unionByName(new.dropDuplicates(keys).join(base.select(*keys).distinct(), keys, "left_anti"))


def sessions(bars: DataFrame) -> DataFrame:
    """The calendar: each date with its ordinal. A calendar has some thousands of rows, so one task numbers it."""
    return bars.select("date").distinct().withColumn("session", F.row_number().over(Window.orderBy("date")))


def freshness(bars: DataFrame, limit: int = 3) -> DataFrame:
    """Last date of each ticker, its age in sessions, and whether it is stale."""
    cal = sessions(bars)
    last = bars.groupBy("ticker").agg(F.max("date").alias("date"))
    newest = cal.agg(F.max("session").alias("newest"))
    df = last.join(cal, "date").crossJoin(F.broadcast(newest))  # one row
    age = F.col("newest") - F.col("session")
    return df.select("ticker", F.col("date").alias("last_date"), age.alias("age"), (age > limit).alias("stale"))


def missing_sessions(bars: DataFrame, since: str) -> DataFrame:
    """Per ticker, sessions of the calendar after `since` and within its own range that it lacks: their number, first and last."""
    span = bars.groupBy("ticker").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    cal = sessions(bars).where(F.col("date") >= F.lit(since).cast("date"))
    have = bars.join(cal, "date").groupBy("ticker").agg(F.count(F.lit(1)).alias("have"), F.min("session").alias("s0"), F.max("session").alias("s1"))
    return span.join(have, "ticker").select("ticker", "have", (F.col("s1") - F.col("s0") + 1 - F.col("have")).alias("missing"))


def watermarks(docs: DataFrame, marks: DataFrame, key: str, ts: str, slack: float = 1.1, longest: int = 30) -> DataFrame:
    """Keys with rows newer than their mark: how many, and the days to look back, the span and a tenth more."""
    df = docs.join(marks, key, "left").where(F.col("mark").isNull() | (F.col(ts) > F.col("mark")))
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("outstanding"), F.max(ts).alias("newest"), F.max("mark").alias("mark"))
    days = F.datediff("newest", "mark")
    return g.select(key, "outstanding", F.least(F.lit(longest), F.coalesce(F.floor(days * slack) + 1, F.lit(longest))).cast("int").alias("lookback_days"))
