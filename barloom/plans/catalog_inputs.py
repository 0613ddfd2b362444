"""Corporate actions derived from the given tables, shared by several queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.sources import tables


def splits(spark, d):  # noqa: ANN001, ANN201
    """Two splits of each seventh ticker, on dates in its history: sizes and days follow from the ticker."""
    t = tables.read(spark, d, "supplier").where("s_suppkey % 7 = 0").select(F.col("s_suppkey").alias("ticker"), F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return t.select("ticker", F.expr("date_add(date'1994-01-01', cast(ticker % 50 * 10 + k * 400 as int))").alias("ex_date"), F.lit(1.0).alias("split_from"), (F.col("k") + F.col("ticker") % 3).cast("double").alias("split_to"))


def dividends(spark, d):  # noqa: ANN001, ANN201
    t = tables.read(spark, d, "supplier").where("s_suppkey % 5 = 0").select(F.col("s_suppkey").alias("ticker"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k"))
    return t.select("ticker", F.expr("date_add(date'1993-01-01', cast(ticker % 30 + k * 180 as int))").alias("ex_date"), (F.col("k") * 3.0).alias("cash_amount"))
