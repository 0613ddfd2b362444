"""Macro series beside the bars: alignment, levels and slopes, sector-relative momentum, regime products, calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.windows import change, lag, safe


def aligned(calendar: DataFrame, series: DataFrame, names: list[str]) -> DataFrame:
    """One column per series: on each date of the calendar its newest value on or before it.

    series: series_id, date, value. The window has no key, but its rows are dates: some thousands, however large the panel."""
    wide = series.groupBy("date").pivot("series_id", names).agg(F.max("value"))
    both = wide.join(calendar.select("date").distinct().withColumn("_in", F.lit(True)), "date", "full")
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("date", "_in", *[F.last(n, ignorenulls=True).over(w).alias(n) for n in names]).where("_in").drop("_in")


def macro_features(frame: DataFrame) -> DataFrame:
    """Levels, slopes and momentum of an aligned frame (VIX, VIX3M, TNX, IRX, GLD); slopes and momentum are 0 where unknown."""
    w = Window.orderBy("date")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return frame.select(
        "date", (F.col("VIX") / 20).alias("vix_level"), (F.col("TNX") / 10).alias("yield_10y"), ((F.col("TNX") - F.col("IRX")) / 10).alias("yield_curve_slope"),
        zero((F.col("VIX") - F.col("VIX3M")) / 20).alias("vix_term_slope"), zero(change("GLD", 5, w)).alias("gold_mom_5d"),
        ((F.col("VIX3M") - F.col("VIX")) / F.greatest("VIX", F.lit(1.0))).alias("vix_term_ratio"),
    )


def sector_relative(bars: DataFrame, sector_of: DataFrame, etf: DataFrame, market: DataFrame, prefix: str = "sector_vs_spy") -> DataFrame:
    """Momentum of a ticker's sector series less the market's over 5, 10 and 20 of its sessions; 0 for a ticker without a sector.

    sector_of: ticker, sector; etf: sector, date, etf; market: date, spy."""
    df = bars.select("ticker", "date").join(sector_of, "ticker", "left").join(etf, ["sector", "date"], "left").join(market, "date", "left")
    cols = {f"{prefix}_{n}d": F.when(F.col("sector").isNull(), F.lit(0.0)).otherwise(change("etf", n) - change("spy", n)) for n in (5, 10, 20)}
    return df.withColumns(cols).select("ticker", "date", *cols)


def first_known(table: DataFrame, columns: list[str], out: str) -> DataFrame:
    """The first of the columns that is neither null nor empty."""
    return table.withColumn(out, F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns]))


def regime_products(features: DataFrame, frame: DataFrame, market: DataFrame) -> DataFrame:
    """Products of momentum and volume trend with the distance of volatility from its base, and of sector strength with the market's 20-session trend.

    features: ticker, date, momentum_5d, volume_trend, sector_vs_spy_5d."""
    trend = market.withColumn("trend", F.coalesce(change("spy", 20, Window.orderBy("date")), F.lit(0.0))).select("date", "trend")
    df = features.join(frame.select("date", (F.col("VIX") / 20 - 1).alias("_v")), "date", "left").join(trend, "date", "left")
    return df.select("ticker", "date", (F.col("momentum_5d") * F.col("_v")).alias("mom5d_x_vix"), ((F.col("volume_trend") - 1) * F.col("_v")).alias("vol_trend_x_vix"), (F.col("sector_vs_spy_5d") * F.coalesce("trend", F.lit(0.0))).alias("sector_x_trend"))


def largest_moves(bars: DataFrame) -> DataFrame:
    """Each ticker's largest absolute move from one row to the next."""
    r = bars.select("ticker", F.abs(change("close", 1)).alias("move"))
    return r.groupBy("ticker").agg(F.max("move").alias("largest_move"), F.count("move").alias("moves"))


def year_on_year(monthly: DataFrame) -> DataFrame:
    """Change against the value 12 rows before, in percent (month, value per series_id)."""
    w = Window.partitionBy("series_id").orderBy("month")
    return monthly.withColumn("yoy_pct", safe(F.col("value"), lag("value", 12, w)) * 100 - 100)


def labelled_history(series: DataFrame, about: DataFrame, derived: dict[str, str]) -> DataFrame:
    """The long history (date, series_id, label, value, units, frequency) of the series that `about` (series_id, label, units, frequency) describes, and of derived ones.

    derived: name of a series of year-on-year changes -> the monthly series they are made of: in percent with two digits, against the value 12 values before, none where that
    is missing or 0. A series that `about` does not describe is left out; about is a short list, sent to all tasks only if Spark finds it small."""
    w = Window.partitionBy("series_id").orderBy("date")
    of = F.coalesce(*[F.when(F.col("series_id") == base, F.lit(name)) for name, base in derived.items()])
    change = F.round((F.col("value") / F.nullif(F.lag("value", 12).over(w), F.lit(0.0)) - 1) * 100, 2)
    made = series.where(F.col("series_id").isin(list(derived.values()))).select(of.alias("series_id"), "date", change.alias("value")).where("value is not null")
    return series.select("series_id", "date", "value").union(made).join(about, "series_id").select("date", "series_id", "label", "value", "units", "frequency")


def snapshot(series: DataFrame, names: list[str]) -> DataFrame:
    """The newest value of each series, its date, and the slope TNX - IRX in basis points, in one row."""
    last = series.where(F.col("series_id").isin(names)).groupBy("series_id").agg(F.max_by("value", "date").alias("value"), F.max("date").alias("date"))
    one = last.agg(F.max("date").alias("as_of"), *[F.max(F.when(F.col("series_id") == n, F.col("value"))).alias(n.lower()) for n in names])
    return one.withColumn("slope_bps", (F.col("tnx") - F.col("irx")) * 100)


def upcoming(events: DataFrame, day: str, horizon: int) -> DataFrame:
    """Per kind the next date on or after the day, and how many fall within the horizon (kind, date)."""
    ahead = events.where(F.col("date") >= F.lit(day).cast("date"))
    return ahead.groupBy("kind").agg(F.min("date").alias("next_date"), F.sum((F.datediff("date", F.lit(day).cast("date")) <= horizon).cast("int")).cast("long").alias("within"))
