"""Data-quality gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.windows import by_ticker, lag


def flags(**rules) -> F.Column:  # noqa: ANN003
    """The names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def row_gate(bars: DataFrame, move: float = 0.5, spike: float = 10.0, window: int = 20) -> DataFrame:
    """Anomalies of each bar against its history, and whether one of them blocks it."""
    prior = by_ticker().rowsBetween(-window, -1)
    # median does not take a frame; percentile does
    usual = F.percentile(F.when(F.col("volume") > 0, F.col("volume")), 0.5).over(prior)
    df = bars.withColumns({"_c": lag("close", 1), "_m": usual})
    block = flags(high_below_low=F.col("high") < F.col("low"), close_out_of_range=(F.col("close") > F.col("high")) | (F.col("close") < F.col("low")), nonpositive_close=F.col("close") <= 0, negative_volume=F.col("volume") < 0)
    warn = flags(large_move=F.abs(F.col("close") / F.col("_c") - 1) > move, zero_volume=F.col("volume") == 0, volume_spike=F.col("volume") > spike * F.col("_m"))
    df = df.withColumns({"blocking": block, "warnings": warn}).drop("_c", "_m")
    return df.withColumn("blocked", F.size("blocking") > 0)


def series_gate(bars: DataFrame, move: float = 0.5, gap_days: int = 5) -> DataFrame:
    """Per ticker: bars, anomalies of each kind, and the first five dates of large moves."""
    df = bars.withColumns({"_c": lag("close", 1), "_d": lag("date", 1)})
    big = F.coalesce(F.abs(F.col("close") / F.col("_c") - 1) > move, F.lit(False))
    df = df.withColumn("_nth", F.when(big, F.sum(big.cast("int")).over(by_ticker())))
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int"))
    return df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("bars"), count(F.col("high") < F.col("low")).alias("bad_range"), count(F.col("close") <= 0).alias("nonpositive"), count(big).alias("large_moves"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_nth") <= 5, F.date_format("date", "yyyy-MM-dd")))), ",").alias("first_moves"),
        count(F.col("volume") == 0).alias("zero_volume"), count(F.datediff("date", "_d") > gap_days).alias("gaps"),
    )


def source_agreement(quotes: DataFrame, tolerance_bps: float = 7.5) -> DataFrame:
    """Per (ticker, date): spread of the sources' closes in basis points, status, and the mean where two or more agree.

    With positive prices the largest pairwise spread is that of the extremes."""
    ok = F.when(F.col("close") > 0, F.col("close"))
    g = quotes.groupBy("ticker", "date").agg(F.count(ok).alias("sources"), F.min(ok).alias("lo"), F.max(ok).alias("hi"), F.avg(ok).alias("mean"))
    bps = (F.col("hi") - F.col("lo")) / F.col("lo") * 1e4
    status = F.when(F.col("sources") == 0, "no_data").when(F.col("sources") == 1, "provisional").when(bps <= tolerance_bps, "agreed").otherwise("quarantine")
    return g.select("ticker", "date", "sources", bps.alias("spread_bps"), status.alias("status"), F.when(F.col("sources") == 1, F.col("mean")).when(bps <= tolerance_bps, F.col("mean")).alias("value"))


def field_gate(df: DataFrame, ids: list[str], specs: list[tuple[str, float, float]]) -> DataFrame:
    """Violations per row and field of a spec of (field, least, most): not a number, or out of range."""
    long = df.select(*ids, *[F.col(f).cast("double").alias(f) for f, _, _ in specs]).unpivot(ids, [f for f, _, _ in specs], "field", "x")
    lo = F.coalesce(*[F.when(F.col("field") == f, F.lit(float(a))) for f, a, _ in specs])
    hi = F.coalesce(*[F.when(F.col("field") == f, F.lit(float(b))) for f, _, b in specs])
    kind = F.when(F.isnan("x") | (F.abs("x") == float("inf")), "not_finite").when(F.col("x") < lo, "below").when(F.col("x") > hi, "above")
    return long.withColumn("violation", kind).where("violation is not null")


def drift(expected: DataFrame, present: DataFrame, key: str = "ticker") -> DataFrame:
    """Keys that only one of two sets has."""
    a, b = expected.select(key).distinct(), present.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).union(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def quote_sanity(bars: DataFrame, jump: float = 0.4, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Opens far from the close before, and closes out of proportion to it."""
    p = F.lag("close").over(Window.partitionBy("ticker").orderBy("date"))
    return bars.select("ticker", "date", (F.abs(F.col("open") / p - 1) > jump).alias("jumped"), ((F.col("close") / p < low) | (F.col("close") / p > high)).alias("off_scale"))
